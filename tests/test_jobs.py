"""The two jobs and the stream, on a small ledger with known customers."""

import datetime as dt

import pytest
from ledgers import AS_OF, document, ledger, line, rate, rows

from checks.parameters import BG, GG
from clientele import ScoringConfig, schemas
from clientele.operators.cohort import changed_customers, customer_profiles
from clientele.operators.fitting import Fit
from clientele.operators.orders import order_values
from clientele.operators.rfm import rfm_summary
from clientele.operators.scoring import predict
from clientele.operators.segments import segment
from clientele.plans import datasets, jobs
from clientele.session import input_bytes, intermediates, sized_shuffles, written
from clientele.sources.ledger import read_ledger
from clientele.sources.models import read_models, save_models
from clientele.sources.predictions import PredictionTable, read_csv
from clientele.streaming.incremental import document_stream, start_scoring

END = dt.date(2024, 6, 1)


@pytest.fixture(scope="module")
def book(spark):
    """Twelve customers, each with an order in some of the past months; two changed yesterday."""
    lines, documents, rates, key = [], [], [], 0
    for c in range(12):
        for month in range(1, 7):
            if (c + month) % 3 == 0 and c % 4 != 0:
                continue
            key += 1
            day = f"2024-{month:02d}-{c + 1:02d}"
            changed = AS_OF - dt.timedelta(days=1) if (c, month) in ((3, 4), (5, 5)) else None
            lines.append(line(key, key, 50 + 10 * c + month, day))
            documents.append(document(key, f"c{c}", day, changed=changed))
            rates.append(rate(day))
    return ledger(spark, lines, documents, rates)


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def test_weekly_then_daily(spark, book, place):
    table = PredictionTable(spark, place("table"))
    scored = jobs.run_weekly(spark, book, place("models"), table, place("staging"), as_of=AS_OF,
                             export=place("exports"))
    assert scored.count() == 12
    exported = read_csv(spark, place(f"exports/weekly_predictions_{AS_OF:%Y%m%d}"))
    assert rows(exported) == rows(scored)
    fitted = {r["model_type"]: r for r in read_models(spark, place("models")).collect()}
    assert set(fitted) == {"BGNBD", "ggf"} and fitted["ggf"]["n_customers"] == 12
    before = {r["userId"]: r for r in table.current().collect()}
    daily = jobs.run_daily(spark, book, place("models"), table, place("staging"), as_of=AS_OF,
                           observation_end=END)
    assert {r["userId"] for r in daily.collect()} == {"c3", "c5"}
    after = {r["userId"]: r for r in table.current().collect()}
    # The same models and the same end of observation: the fresh scores equal the old ones.
    assert after == before


def test_pareto_weekly(spark, book, place):
    table = PredictionTable(spark, place("table"))
    cfg = ScoringConfig(model_type="PARETO")
    jobs.run_weekly(spark, book, place("models"), table, place("staging"), cfg, AS_OF)
    churn = [r["churn_probability"] for r in table.current().collect()]
    assert len(churn) == 12 and all(0 <= p <= 1 for p in churn)


def test_nobody_to_score(spark, book, place):
    table = PredictionTable(spark, place("table"))
    late = dt.date(2030, 1, 1)
    assert jobs.run_daily(spark, book, place("models"), table, place("staging"), as_of=late).isEmpty()
    assert jobs.run_weekly(spark, book, place("models"), table, place("staging"), as_of=late).isEmpty()
    assert table.published().isEmpty()


def test_stream_equals_batch_and_replays_safely(spark, book, place):
    for name, df in zip(("lines", "rates"), (book.lines, book.rates)):
        df.write.parquet(place(name))
    book.documents.where("OrderId % 2 = 0").coalesce(1).write.mode("append").parquet(place("documents"))
    book.documents.where("OrderId % 2 = 1").coalesce(1).write.mode("append").parquet(place("documents"))
    save_models(spark, place("models"), [Fit(BG, 0, 0.0, 0, True), Fit(GG, 0, 0.0, 0, True)], AS_OF)
    table = PredictionTable(spark, place("table"))

    def opened():
        return read_ledger(spark, place("lines"), place("documents"), place("rates"))

    def run(progress):
        start_scoring(document_stream(spark, place("documents"), files_per_batch=1), opened,
                      place("models"), table, place("staging"), place(progress),
                      as_of=AS_OF, observation_end=END).awaitTermination()

    run("first")
    profiles = customer_profiles(order_values(*book), "M", AS_OF)
    expected = predict(datasets.scoring_rows(profiles, observation_end=END), BG, GG)
    assert rows(table.current().select(expected.columns)) == rows(expected)
    versions = rows(table.published().select("version"))
    assert len(versions) == 2
    run("first")  # nothing new
    assert rows(table.published().select("version")) == versions
    # A lost checkpoint scores all batches again, with the same result.
    run("again")
    assert rows(table.current().select(expected.columns)) == rows(expected)


def test_stream_with_a_new_checkpoint_loses_nothing(spark, book, place):
    """A second file arrives, and the stream starts over with another checkpoint and batch size."""
    for name, df in zip(("lines", "rates"), (book.lines, book.rates)):
        df.write.parquet(place(name))
    save_models(spark, place("models"), [Fit(BG, 0, 0.0, 0, True), Fit(GG, 0, 0.0, 0, True)], AS_OF)
    table = PredictionTable(spark, place("table"))

    def opened():
        return read_ledger(spark, place("lines"), place("documents"), place("rates"))

    def run(progress):
        start_scoring(document_stream(spark, place("documents")), opened, place("models"), table,
                      place("staging"), place(progress), as_of=AS_OF, observation_end=END).awaitTermination()

    book.documents.where("OrderId % 2 = 0").coalesce(1).write.mode("append").parquet(place("documents"))
    run("first")
    few = rows(table.current())
    book.documents.where("OrderId % 2 = 1").coalesce(1).write.mode("append").parquet(place("documents"))
    run("second")
    expected = predict(datasets.scoring_rows(customer_profiles(order_values(*book), "M", AS_OF),
                                             observation_end=END), BG, GG)
    assert few != rows(table.current())
    assert rows(table.current().select(expected.columns)) == rows(expected)


def test_daily_training_equals_weekly_for_the_changed(spark, book):
    changed = [r["userId"] for r in changed_customers(book.documents, AS_OF).collect()]
    daily = datasets.training_set(book, "daily", AS_OF)
    weekly = datasets.training_set(book, "weekly", AS_OF)
    assert rows(daily) == rows(weekly.where(weekly["userId"].isin(changed)))


def test_unknown_mode(book):
    with pytest.raises(ValueError):
        datasets.training_set(book, "hourly", AS_OF)


def test_output_schemas(spark, book):
    def types(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    train, revenue = datasets.load_training(book, "weekly", AS_OF)
    assert types(train.schema) == types(schemas.TRAIN)
    assert types(revenue.schema) == types(schemas.REVENUE)
    assert types(rfm_summary(train, "M").schema) == types(schemas.RFM)
    customers = datasets.scoring_rows(customer_profiles(order_values(*book), "M", AS_OF))
    scored = predict(customers, BG, GG)
    assert types(scored.schema) == types(schemas.PREDICTION)
    assert types(segment(scored).schema) == types(schemas.SEGMENTED)


def test_shuffles_grow_with_the_input(spark, tmp_path):
    spark.range(10_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert 10_000 < input_bytes(df) < 10_000_000
    # Rows from Python have no known size.
    assert input_bytes(spark.createDataFrame([(1,)], "x int")) < 10_000_000
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with sized_shuffles(spark, df) as partitions:
        assert partitions == configured
    # A plain range claims the size of its rows, here some 100 TB.
    with sized_shuffles(spark, spark.range(12_500_000_000_000)) as partitions:
        assert partitions == 186_265 and spark.conf.get(key) == "186265"
    assert spark.conf.get(key, None) == before
    unknown = spark.createDataFrame([(1,)], "x int")
    with sized_shuffles(spark, unknown, unknown=100 * 512 * 1024 ** 2) as partitions:
        assert partitions in (configured, 100)


def test_jobs_leave_the_session_as_it_was(spark, book, place):
    table = PredictionTable(spark, place("table"))
    jobs.run_weekly(spark, book, place("models"), table, place("staging"), as_of=AS_OF)
    before = dict(spark.sparkContext.getConf().getAll()), spark.sql("SET").collect()
    jobs.run_daily(spark, book, place("models"), table, place("staging"), as_of=AS_OF,
                   observation_end=END, export=place("exports"), view="scores")
    assert (dict(spark.sparkContext.getConf().getAll()), spark.sql("SET").collect()) == before
    exported = spark.read.option("header", True).csv(place("exports") + "/daily_predictions_20240615")
    assert rows(exported.select("userId")) == [("c3",), ("c5",)]
    assert spark.table("scores").count() == 12


def test_intermediates_go_with_the_job(spark):
    with intermediates(spark):
        path = written(spark.range(3), "gone").inputFiles()[0].rpartition("/")[0]
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_unconverged_models_are_not_published(spark, place):
    """Five equal customers leave the value model without an optimum."""
    lines, documents, rates, key = [], [], [], 0
    for c in range(5):
        for month in (1, 3, 5):
            key += 1
            day = f"2024-{month:02d}-10"
            lines.append(line(key, key, 100, day))
            documents.append(document(key, f"c{c}", day))
            rates.append(rate(day))
    same = ledger(spark, lines, documents, sorted(set(rates)))
    table = PredictionTable(spark, place("table"))
    with pytest.raises(ArithmeticError, match="converge"):
        jobs.run_weekly(spark, same, place("models"), table, place("staging"),
                        ScoringConfig(penalizer=0.0), AS_OF)
    assert table.published().isEmpty()
