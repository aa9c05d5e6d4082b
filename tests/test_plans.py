"""The shape of the physical plans."""

import re

import pytest

from checks.queries import QUERIES
from conftest import SF_DIR


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["order_values", "training_weekly", "revenue_weekly",
                                  "segmented_daily", "segmented_weekly"])
def test_sql_side_is_native(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan and "Arrow" not in plan
    for bad in ("Window", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_orders_and_returns_share_their_scans(spark):
    plan = _final_plan(QUERIES["order_values"](spark, SF_DIR))
    assert "ReusedExchange" in plan
    # Lines are scanned once for the versions and once for the amounts, not per role.
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 2


def test_filters_reach_the_scan(spark, tmp_path):
    from checks import fixtures
    from clientele.operators.orders import signed_lines
    fixtures.ledger_lines(spark, SF_DIR).write.parquet(str(tmp_path / "lines"))
    plan = _plan(signed_lines(spark.read.parquet(str(tmp_path / "lines"))))
    pushed = re.search(r"PushedFilters: \[(.*)", plan).group(1)
    assert "IsNotNull(ItemId)" in pushed and "AmountWithoutVat" in pushed


@pytest.mark.parametrize("name", ["training_daily", "revenue_daily"])
def test_daily_sets_scan_the_lines_once_more_at_most(spark, name):
    """Candidate lines are a table of their own by then; only the versions of their ids are read."""
    whole = QUERIES[name](spark, SF_DIR)
    whole.collect()
    text = _plan(whole)
    for plan in (text.split("== Initial Plan ==")[0], text.split("== Initial Plan ==")[-1]):
        assert len(re.findall(r"FileScan parquet \[l_", plan)) <= 2


def test_small_rate_table_is_broadcast(spark, tmp_path):
    from checks import fixtures
    from clientele.operators import orders
    fixtures.fx_rates(spark, SF_DIR).write.parquet(str(tmp_path / "rates"))
    rates = spark.read.parquet(str(tmp_path / "rates"))
    data = fixtures.ledger(spark, SF_DIR)
    plan = _plan(orders.convert(orders.local_orders(orders.movements(data.lines, data.documents)),
                                rates, "order_revenue", "order_date"))
    assert re.search(r"BroadcastHashJoin \[CurrencyCode", plan)


def test_hot_key_is_split(spark):
    """A key with most of the rows becomes several tasks in the version join."""
    from clientele.operators.versions import pick_versions
    saved = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
        df = (spark.range(60_000, numPartitions=8).selectExpr(
            "IF(id % 3 = 0, -1, id) AS k", "CAST(id AS STRING) AS v",
            "timestamp_seconds(id DIV 60000) AS __ts_ms"))
        chosen = pick_versions(df, "k", "first")
        assert chosen.count() == 60_000
        assert "skewed" in _final_plan(chosen)
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_hot_customer_is_split_without_salts(spark):
    """The rows of one customer in a semi join become several tasks, and the list of customers is not repeated."""
    from clientele.operators.joins import semi_join
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = spark.range(60_000, numPartitions=8).selectExpr("IF(id % 3 = 0, -1, id) AS userId", "CAST(id AS STRING) AS v")
        kept = semi_join(df, spark.range(-1, 30_000).selectExpr("id AS userId"), ["userId"])
        assert kept.count() == 20_000 + 20_000
        plan = _final_plan(kept)
        assert "skewed" in plan and "Generate" not in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["rfm_month", "revenue_weekly", "training_newest_first"])
def test_a_condition_on_customers_keeps_one_plan_for_orders_and_returns(spark, name, monkeypatch):
    """A filter on the orders' customer that reached the heads made a second scan and shuffle of all lines' amounts."""
    from checks import queries
    kept = []
    monkeypatch.setattr(queries, "written", lambda df, name: kept.append(df) or df)
    df = QUERIES[name](spark, SF_DIR)
    plan = _final_plan(kept[0] if kept else df)
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(order_key#\d+L?, role", re.sub(r"ReusedExchange.*", "", plan))) == 1


def test_bounds_of_versions_are_not_shuffled_again(spark):
    """First and last seconds are joined where they were aggregated; as rows of (key, role, second) they moved twice."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = _final_plan(QUERIES["order_values"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(_key" not in plan
    assert re.search(r"hashpartitioning\(DocumentId#\d+L?, \d", plan) and "role, 4" not in plan


def test_orders_stay_where_their_document_versions_are_chosen(spark):
    """Document heads moved twice, by order id and by document id, and the sums of orders once more than here."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = _final_plan(QUERIES["order_revenue_local"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"Exchange hashpartitioning\((\w+?)#", re.sub(r"ReusedExchange.*", "", plan))
    # The sums of the lines, and the bounds of the versions.
    assert moved.count("OrderId") == 2
    # The chosen lines and the heads.
    assert moved.count("DocumentId") == 2 and "order_key" not in moved


def test_daily_job_computes_the_amounts_of_its_ledger_once(spark, monkeypatch):
    """The base and the daily run each computed the amounts of all orders."""
    from clientele.operators import orders
    calls, movements = [], orders.movements
    monkeypatch.setattr(orders, "movements", lambda *args: calls.append(1) or movements(*args))
    assert QUERIES["run_daily"](spark, SF_DIR).count() > 0
    assert len(calls) == 1
