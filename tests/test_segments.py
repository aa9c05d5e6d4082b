"""Segments, the merge, the registry, exports and the published table."""

import datetime as dt

import pytest
from ledgers import rows
from pyspark.sql import functions as F

from checks.parameters import BG, GG, PARETO
from clientele import schemas
from clientele.functions.labels import churn_segment, clv_segment, without_nan
from clientele.operators.fitting import Fit
from clientele.operators.segments import (
    clv_percentiles, clv_quantiles, merge_and_segment, merged_predictions, segment)
from clientele.sources import models
from clientele.sources.predictions import (
    PredictionTable, StaleBase, export_name, read_csv, read_staged, stage, write_csv)

NAN = float("nan")


def _predictions(spark, data):
    return spark.createDataFrame([(u, c, p, 1.0, 2.0) for u, c, p in data], schemas.PREDICTION)


@pytest.mark.parametrize("clv, label", [
    (9.0, "Lowest 25% Customers"), (10.0, "Low Medium Value"), (15.0, "Low Medium Value"),
    (20.0, "Low Medium Value"), (20.1, "High Medium Value"), (30.0, "High Medium Value"),
    (30.1, "Top 25% Customers"), (None, ""), (NAN, "")])
def test_value_borders(spark, clv, label):
    df = spark.createDataFrame([(clv,)], "clv double")
    cuts = F.array(F.lit(10.0), F.lit(20.0), F.lit(30.0))
    assert df.select(clv_segment(without_nan(F.col("clv")), cuts)).first()[0] == label


@pytest.mark.parametrize("churn, label", [
    (0.2499, "Low Risk"), (0.25, "Medium Risk"), (0.70, "Medium Risk"), (0.7001, "High Risk"),
    (None, ""), (NAN, "")])
def test_risk_borders(spark, churn, label):
    df = spark.createDataFrame([(churn,)], "p double")
    assert df.select(churn_segment(without_nan(F.col("p")))).first()[0] == label


def test_percentiles_skip_missing_values(spark):
    df = _predictions(spark, [(str(i), float(i), 0.1) for i in range(1, 101)] + [("n", None, 0.1), ("m", NAN, 0.1)])
    assert tuple(clv_percentiles(df).first()) == (25.0, 50.0, 75.0)
    boundaries = clv_quantiles(df).first()[0]
    assert len(boundaries) == 101 and boundaries[0] == 1.0 and boundaries[100] == 100.0
    labels = {r["userId"]: r["clv_segment"] for r in segment(df).collect()}
    assert labels["n"] == labels["m"] == "" and labels["1"] == "Lowest 25% Customers"


@pytest.mark.parametrize("value", ["CAST(id AS DOUBLE)", "CAST(id * 7919 % 300000 AS DOUBLE)",
                                   "CAST(id % 7 AS DOUBLE)", "IF(id % 3 = 0, 5D, CAST(id * id AS DOUBLE))",
                                   "-exp(id / 10000D)"])
def test_percentiles_are_exact_at_any_size(spark, value):
    df = spark.range(300_000).selectExpr("CAST(id AS STRING) AS userId", f"{value} AS clv")
    ordered = sorted(r[0] for r in df.select("clv").collect())
    expected = tuple(ordered[max(1, -(-len(ordered) * p // 100)) - 1] for p in (25, 50, 75))
    assert tuple(clv_percentiles(df).first()) == expected


def test_segmenting_nothing(spark):
    assert segment(spark.createDataFrame([], schemas.PREDICTION)).isEmpty()


@pytest.fixture(scope="module")
def two_sides(spark):
    return (_predictions(spark, [("A", 1.0, 0.1), ("B", 2.0, 0.2), (None, 9.0, 0.2)]),
            _predictions(spark, [("B", 20.0, 0.3), ("C", 30.0, 0.4), ("C", 30.0, 0.4)]))


def test_merge(two_sides):
    found = rows(merged_predictions(*two_sides).select("userId", "clv"))
    assert found == [("A", 1.0), ("B", 20.0), ("C", 30.0), (None, 9.0)]


def test_merging_twice_changes_nothing(two_sides):
    existing, new = two_sides
    once = merged_predictions(existing, new)
    assert rows(merged_predictions(once, new)) == rows(once)


def test_every_row_gets_one_label(two_sides):
    merged = merge_and_segment(*two_sides)
    counts = merged.groupBy("clv_segment").count().agg(F.sum("count")).first()[0]
    assert counts == merged.count() == 4


def test_newest_models(spark):
    names = spark.createDataFrame(
        [("clv_model_BGNBD_2024-05-01.pkl",), ("clv_model_ggf_2024-05-08.pkl",),
         ("clv_model_BGNBD_2024-05-08.pkl",), ("clv_model_BGNBD_2024-13-01.pkl",),
         ("clv_model_latest.pkl",), ("other_2025-01-01.pkl",), ("clv_model_x/y_2025-01-01.pkl",)],
        "file string")
    flat = models.with_prefix(names, "clv_model", "/")
    assert rows(models.newest_models(flat).select("file")) == [
        ("clv_model_BGNBD_2024-05-08.pkl",), ("clv_model_ggf_2024-05-08.pkl",)]
    assert models.with_prefix(names, "clv_model").count() == 6


def test_registry(spark, tmp_path):
    path, day = str(tmp_path / "models"), dt.date(2024, 5, 1)
    models.save_models(spark, path, [Fit(PARETO, 5, -1.0, 2, True), Fit(GG, 5, -1.0, 2, True)], day)
    assert models.latest_models(models.read_models(spark, path)) == (PARETO, GG)
    later = dt.date(2024, 5, 8)
    models.save_models(spark, path, [Fit(BG, 5, -1.0, 2, True), Fit(GG, 5, -1.0, 2, True)], later)
    assert models.latest_models(models.read_models(spark, path)) == (BG, GG)
    # On one date the later name wins; saving again replaces.
    models.save_models(spark, path, [Fit(PARETO, 7, -1.0, 2, True)], later)
    models.save_models(spark, path, [Fit(PARETO, 8, -1.0, 2, True)], later)
    registry = models.read_models(spark, path)
    assert registry.count() == 5
    assert models.latest_models(registry) == (PARETO, GG)
    assert models.latest_models(registry, model_type="BGNBD") == (BG, GG)
    with pytest.raises(LookupError):
        models.latest_models(registry, prefix="other")
    # Models of another prefix on the same day are other models.
    models.save_models(spark, path, [Fit(BG, 9, -1.0, 2, True), Fit(GG, 9, -1.0, 2, True)], later,
                       frequency="W", prefix="other")
    assert models.read_models(spark, path).count() == 7
    assert models.latest_models(models.read_models(spark, path)) == (PARETO, GG)
    assert models.latest_models(models.read_models(spark, path), "other", frequency="w") == (BG, GG)
    with pytest.raises(LookupError, match="frequency M"):
        models.latest_models(models.read_models(spark, path), "other", frequency="M")


def test_csv(spark, tmp_path):
    path = str(tmp_path / export_name(dt.date(2024, 5, 1)))
    assert path.endswith("daily_predictions_20240501")
    df = _predictions(spark, [("å", 1.25, NAN), ("b", None, 0.5)])
    assert write_csv(df, path) == 2
    expected = [("b", None, 0.5, 1.0, 2.0), ("å", 1.25, None, 1.0, 2.0)]
    assert rows(read_csv(spark, path)) == expected
    assert rows(read_csv(spark, path, schema=None)) == expected


def test_staging_replaces(spark, tmp_path):
    path = str(tmp_path / "staging")
    assert stage(_predictions(spark, [("a", 1.0, 0.1), ("b", 1.0, 0.1)]), path) == 2
    assert stage(_predictions(spark, [("c", 1.0, 0.1)]), path) == 1
    assert rows(read_staged(spark, path).select("userId")) == [("c",)]


def test_published_table_reads_what_it_replaces(spark, tmp_path, two_sides):
    existing, new = two_sides
    table = PredictionTable(spark, str(tmp_path / "table"))
    assert table.current().isEmpty() and not table.has("one")
    assert table.publish(segment(existing), "one") == 3
    assert table.publish(merge_and_segment(table.current(), new), "two") == 4
    assert rows(table.current().select("userId", "clv")) == [
        ("A", 1.0), ("B", 20.0), ("C", 30.0), (None, 9.0)]
    # A refresh of a version that is no longer the current one changes nothing.
    with pytest.raises(StaleBase):
        table.publish(segment(new), "late", base=1)
    assert table.newest() == ("two", 2) and table.current().count() == 4
    # A version that was written but never logged is not seen.
    segment(new).write.parquet(str(tmp_path / "table" / "versions" / "three"))
    assert table.current().count() == 4 and table.has("two") and not table.has("three")


def test_sketches_merge_within_their_error(spark):
    """Ranks of the sketched boundaries of 60,000 values in parts, and exact ones of few."""
    from clientele.operators.segments import SKETCH_SIZE, sketched_percentiles, value_sketch
    values = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 1000 == 0, F.lit(float("nan"))).otherwise((F.col("id") * 7919 % 60_013).cast("double"))
        .alias("clv"))
    parts = [value_sketch(values.where(F.col("clv") % 3 == i)) for i in range(3)] + [value_sketch(values.limit(0))]
    sketches = parts[0]
    for part in parts[1:]:
        sketches = sketches.unionByName(part)
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    known = sorted(r[0] for r in values.where("NOT isnan(clv)").collect())
    for share, bound in zip(shares, sketched_percentiles(sketches, shares)):
        rank = sum(v <= bound for v in known) / len(known)
        assert abs(rank - share) <= 4 / SKETCH_SIZE + 1 / len(known)
    few = spark.createDataFrame([(float(i),) for i in range(1, 8)] + [(None,)], "clv double")
    assert sketched_percentiles(value_sketch(few), (0.25, 0.5, 0.75, 1.0)) == [2.0, 4.0, 6.0, 7.0]
    assert sketched_percentiles(value_sketch(few.limit(0)), (0.5,)) == [None]


def test_approximate_refresh_cuts_by_stored_sketches(spark, tmp_path):
    """A daily refresh takes the kept rows' values from the sketch that was stored with their version."""
    from clientele.plans.jobs import refresh
    from clientele.sources.predictions import PredictionTable

    def batch(low, high, add):
        return spark.range(low, high).selectExpr(
            "CAST(id AS STRING) AS userId", f"CAST(id + {add} AS DOUBLE) AS clv", "0.5D AS churn_probability",
            "1.0D AS predicted_value_next_6_month", "2.0D AS current_total_revenue")

    tables = [PredictionTable(spark, str(tmp_path / name)) for name in ("sketched", "exact")]
    for table, approximate in zip(tables, (True, False)):
        refresh(table, batch(0, 1000, 0), "weekly", "first", approximate=approximate)
        refresh(table, batch(1000, 1400, 0), "daily", "second", approximate=approximate)
    # Nothing was replaced and few values were sketched, so both are exact.
    sketched, exact = (sorted(map(tuple, t.current().collect())) for t in tables)
    assert sketched == exact and len(exact) == 1400
    refresh(tables[0], batch(0, 20, 5000), "daily", "third", approximate=True)
    labels = {r["clv_segment"]: r["n"] for r in tables[0].current().groupBy("clv_segment")
              .agg(F.count("*").alias("n")).collect()}
    assert len(labels) == 4 and all(abs(n - 350) <= 25 for n in labels.values())
