"""The ledger, predictions and model names that the registered queries read.

All of it derives from whole test tables (see FIXTURES.md); dates are relative
to ``AS_OF``, never to the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele import configure, schemas
from clientele.functions.money import half_up
from clientele.session import written
from clientele.sources.ledger import Ledger, conform

AS_OF = dt.date(2001, 8, 1)
CREDIT = 1_000_000_000


# Columns that the fixtures read; a given schema saves the job that infers one.
_SCHEMAS = {
    "customer": "c_custkey long, c_nationkey int, c_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, "
                "l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "events": "ts timestamp_ntz, user_id long, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 1-2 of an order flagged R become returns on a credit document."""
    lines = (table(spark, sf_dir, "lineitem")
             .selectExpr("*", "l_returnflag = 'R' AND l_linenumber <= 2 AS back",
                         "CAST(l_extendedprice AS DECIMAL(12,2)) AS price")
             .selectExpr("*", "CAST(price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS off")
             .selectExpr(
                 "l_orderkey * 10 + l_linenumber AS Id",
                 f"IF(back, {CREDIT} + l_orderkey * 2 + l_linenumber % 2, l_orderkey) AS DocumentId",
                 "IF(back, l_orderkey, NULL) AS SalesOrderId",
                 "IF(l_partkey % 20 = 0, 'P', 'I') || CAST(l_partkey AS STRING) AS ItemId",
                 "IF(back, -price, price) AS AmountWithoutVat",
                 "IF(back, -off, off) AS DiscountAmountWithoutVat",
                 "l_shipdate AS __ts_ms"))
    return conform(lines, schemas.DOCUMENT_LINE)


def ledger_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order, a later version of every fifth, and two credit documents."""
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "'c' || CAST(c_custkey AS STRING) || '@example.com' AS BillToEmail",
        "element_at(array('DKK', 'EUR', 'SEK', 'USD'), c_nationkey % 4 + 1) AS CurrencyCode")
    versions = f"""inline(array_compact(array(
        named_struct('Id', o_orderkey, 'created', 0, 'changed', 0),
        IF(o_orderkey % 5 = 0, named_struct('Id', o_orderkey, 'created', 0, 'changed', 3), NULL),
        named_struct('Id', {CREDIT} + o_orderkey * 2, 'created', 45, 'changed', 45),
        named_struct('Id', {CREDIT + 1} + o_orderkey * 2, 'created', 30, 'changed', 30))))"""
    documents = (table(spark, sf_dir, "orders")
                 .join(customer, F.expr("o_custkey = c_custkey"))
                 .selectExpr("BillToEmail", "CurrencyCode", "o_orderdate", versions)
                 .selectExpr("Id", "Id AS OrderId", "BillToEmail", "CurrencyCode",
                             "o_orderdate + make_dt_interval(created) AS CreatedOn",
                             "o_orderdate + make_dt_interval(changed) AS __ts_ms"))
    return conform(documents, schemas.DOCUMENT)


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate per currency and day in use; USD has none on the 13th."""
    days = (ledger_documents(spark, sf_dir)
            .selectExpr("CurrencyCode", "to_date(CreatedOn) AS Date")
            .where("NOT (CurrencyCode = 'USD' AND day(Date) = 13)").distinct())
    return conform(days.selectExpr("*", """CASE CurrencyCode WHEN 'DKK' THEN 1.0000
        WHEN 'EUR' THEN 0.1340 + 0.0001 * month(Date) WHEN 'SEK' THEN 1.4500 + 0.0010 * month(Date)
        ELSE 0.1450 + 0.0002 * month(Date) END AS Rate"""), schemas.EXCHANGE_RATES)


def ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """The rates are a stored table, as in any ledger, so that Spark knows their size."""
    return Ledger(ledger_lines(spark, sf_dir), ledger_documents(spark, sf_dir),
                  written(fx_rates(spark, sf_dir), "rates"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as training rows: a short, dense history."""
    return (table(spark, sf_dir, "events").where("event_type = 'purchase'")
            .selectExpr("CAST(user_id AS STRING) AS userId", "to_date(ts) AS order_date",
                        "value AS order_value"))


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "orders")
            .selectExpr("o_custkey", "CAST(o_totalprice AS DECIMAL(12,2)) AS price",
                        f"to_date(o_orderdate) > add_months(DATE '{AS_OF}', -6) AS lately")
            .groupBy("o_custkey")
            .agg(F.expr("sum(price) AS spent"), F.expr("count(*) AS orders"),
                 F.expr("sum(price) FILTER (WHERE lately) AS spent_lately"))
            .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")))


def existing_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction table of all buyers; short histories have no forecast."""
    return _customer_orders(spark, sf_dir).selectExpr(
        "'c' || CAST(c_custkey AS STRING) AS userId",
        "CAST(spent + CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS clv",
        "IF(orders > 3, orders / 40D, NULL) AS churn_probability",
        "c_acctbal AS predicted_value_next_6_month",
        "CAST(spent AS DOUBLE) AS current_total_revenue")


def new_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshly scored rows of the buyers of the last half year, every row twice."""
    return _customer_orders(spark, sf_dir).where("spent_lately IS NOT NULL").select(
        F.expr("'c' || CAST(c_custkey AS STRING) AS userId"),
        F.expr("CAST(spent + spent_lately AS DOUBLE) AS clv"),
        F.expr("orders / 25D AS churn_probability"),
        half_up(F.expr("c_acctbal / 2")).alias("predicted_value_next_6_month"),
        F.expr("CAST(spent AS DOUBLE) AS current_total_revenue"),
        F.expr("explode(array(1, 2)) AS copy")).drop("copy")


def model_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as in a model folder: dated, undated, and with an impossible month."""
    return table(spark, sf_dir, "orders").selectExpr("""concat(
        IF(o_orderkey % 7 = 0, 'archive/', ''), 'clv_model_',
        element_at(array('BGNBD', 'PARETO', 'ggf'), CAST(o_orderkey % 3 + 1 AS INT)), '_',
        CASE o_orderkey % 11 WHEN 0 THEN 'latest' WHEN 1 THEN '2024-13-01'
             ELSE date_format(o_orderdate, 'yyyy-MM-dd') END, '.pkl') AS file""").distinct()
