"""Which customers are worth scoring, and their training rows and revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import ScoringConfig
from clientele.functions.dates import as_date, months_before, period_start
from clientele.functions.money import exact
from clientele.operators.joins import semi_join

_DEFAULT = ScoringConfig()


def countable(value: str = "order_value") -> Column:
    """Orders that count towards eligibility, fully refunded ones included."""
    return F.col(value) >= 0


def trainable(value: str = "order_value") -> Column:
    """Orders that become training rows."""
    return F.col(value) > 0


def recent(as_of: dt.date | Column | None, cfg: ScoringConfig = _DEFAULT) -> Column:
    """Strictly after the same day ``recent_months`` ago."""
    return F.col("order_date") > months_before(as_date(as_of, cfg.business_zone), cfg.recent_months)


def order_counts(values: DataFrame, as_of: dt.date | None = None,
                 cfg: ScoringConfig = _DEFAULT) -> DataFrame:
    """Orders per customer, ever and recently, in one aggregate."""
    return (values.where(countable())
            .groupBy("userId")
            .agg(F.count("order_date").alias("orders_all_time"),
                 F.count_if(recent(as_of, cfg)).alias("orders_recent")))


def eligible_customers(values: DataFrame, as_of: dt.date | None = None,
                       cfg: ScoringConfig = _DEFAULT) -> DataFrame:
    """Customers with enough orders ever and recently."""
    return (order_counts(values, as_of, cfg)
            .where(F.col("userId").isNotNull() & _enough(cfg))
            .select("userId"))


def _enough(cfg: ScoringConfig) -> Column:
    return ((F.col("orders_all_time") >= cfg.min_orders)
            & (F.col("orders_recent") >= cfg.min_recent_orders))


def changed_customers(documents: DataFrame, as_of: dt.date | None = None,
                      cfg: ScoringConfig = _DEFAULT) -> DataFrame:
    """Customers with any document version changed since the day before."""
    since = F.date_sub(as_date(as_of, cfg.business_zone), cfg.changed_days)
    return (documents.where(F.to_date("__ts_ms") >= since)
            .select(F.col("BillToEmail").alias("userId")).distinct())


def distinct_orders(values: DataFrame) -> DataFrame:
    """One row per (order, customer, day, value), with how many rows it stands for."""
    return (values.groupBy("OrderId", "userId", "order_date", "order_value")
            .agg(F.count(F.lit(1)).alias("copies")))


def training_rows(values: DataFrame, as_of: dt.date | None = None,
                  cfg: ScoringConfig = _DEFAULT, changed: DataFrame | None = None,
                  newest_first: bool = False) -> DataFrame:
    """Training rows of eligible customers: (userId, order_date, order_value).

    Repeats of one order vanish; equal orders of one day stay.  ``changed``
    keeps only those customers (the daily set).
    """
    rows = distinct_orders(values).where(trainable()).drop("copies")
    rows = semi_join(rows, eligible_customers(values, as_of, cfg), ["userId"])
    if changed is not None:
        rows = semi_join(rows, changed, ["userId"])
    rows = rows.select("userId", "order_date", "order_value")
    return rows.orderBy(F.desc("order_date")) if newest_first else rows


def customer_revenue(train: DataFrame, ordered: bool = False) -> DataFrame:
    """Past revenue per customer, summed exactly."""
    revenue = train.groupBy("userId").agg(
        F.sum(exact(F.col("order_value"))).cast("double").alias("current_total_revenue"))
    return revenue.orderBy("userId") if ordered else revenue


def customer_profiles(values: DataFrame, frequency: str = "M", as_of: dt.date | None = None,
                      cfg: ScoringConfig = _DEFAULT) -> DataFrame:
    """Everything the scoring needs about each eligible customer, without a join.

    Two aggregates, by (customer, period) and by customer, give eligibility,
    revenue and the purchase history at once.  Both combine on the map side, and
    the first spreads a heavy customer over its periods.
    """
    worth = F.when(trainable(), exact(F.col("order_value")))
    # Orders without a date do not count towards eligibility.
    dated = F.when(F.col("order_date").isNotNull(), F.col("copies")).otherwise(0)
    by_period = (
        distinct_orders(values.where(countable() & F.col("userId").isNotNull()))
        .groupBy("userId", period_start(F.col("order_date"), frequency).alias("period"))
        .agg(F.sum(dated).alias("orders"),
             F.sum(F.when(recent(as_of, cfg), F.col("copies")).otherwise(0)).alias("recent_orders"),
             F.sum(worth).alias("amount")))
    bought = F.when(F.col("amount").isNotNull(), F.col("period"))
    return (by_period.groupBy("userId")
            .agg(F.sum("orders").alias("orders_all_time"),
                 F.sum("recent_orders").alias("orders_recent"),
                 F.count("amount").alias("periods"),
                 F.min(bought).alias("first_period"),
                 F.max(bought).alias("last_period"),
                 F.sum("amount").alias("revenue"),
                 F.min_by("amount", bought).alias("first_amount"))
            .where(_enough(cfg) & (F.col("periods") > 0))
            .drop("orders_all_time", "orders_recent"))
