"""Registered queries: name -> (Spark query, SQL for comparison or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import oracle as sql
from checks.parameters import BG, GG, PARETO
from clientele import ScoringConfig
from clientele.functions.labels import churn_segment, without_nan
from clientele.operators import cohort, orders, rfm, segments, versions
from clientele.operators.fitting import Fit, fit_bgnbd, fit_gamma_gamma, fit_pareto_nbd
from clientele.operators.scoring import discounted_purchases, lifetime_value, predict
from clientele.plans import datasets, jobs
from clientele.session import shared_path, written
from clientele.sources import models, predictions
from clientele.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CFG = ScoringConfig()


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = sql.query(oracle)
        return fn
    return add


# Ledger and versions

@register("ledger_lines", "SELECT * FROM ledger_lines")
def ledger_lines(spark, sf):
    return fx.ledger_lines(spark, sf)


@register("ledger_documents", "SELECT * FROM ledger_documents")
def ledger_documents(spark, sf):
    return fx.ledger_documents(spark, sf)


@register("fx_rates", "SELECT * FROM fx_rates")
def fx_rates(spark, sf):
    return fx.fx_rates(spark, sf)


_LINE = "Id, DocumentId, SalesOrderId, ItemId, AmountWithoutVat, DiscountAmountWithoutVat, __ts_ms"


@register("version_first", f"SELECT {_LINE} FROM line_versions WHERE sec = oldest")
def version_first(spark, sf):
    return versions.pick_versions(fx.ledger_lines(spark, sf), "Id", "first")


@register("version_last", f"SELECT {_LINE} FROM line_versions WHERE sec = newest")
def version_last(spark, sf):
    return versions.pick_versions(fx.ledger_lines(spark, sf), "Id", "last")


@register("version_last_single", "SELECT Id, max(__ts_ms) AS __ts_ms FROM ledger_lines GROUP BY Id")
def version_last_single(spark, sf):
    return versions.pick_versions(fx.ledger_lines(spark, sf), "Id", "last",
                                  ties="one").select("Id", "__ts_ms")


# Order values

def _moves(spark, sf):
    data = fx.ledger(spark, sf)
    return orders.movements(data.lines, data.documents)


def _values(spark, sf, returns="per_date"):
    return orders.order_values(*fx.ledger(spark, sf), returns=returns)


@register("order_revenue_local", "SELECT * FROM sold")
def order_revenue_local(spark, sf):
    return orders.local_orders(_moves(spark, sf))


@register("order_revenue_base", "SELECT * FROM sold_base")
def order_revenue_base(spark, sf):
    return orders.convert(orders.local_orders(_moves(spark, sf)), fx.fx_rates(spark, sf),
                          "order_revenue", "order_date")


@register("returns_local", "SELECT * FROM sent_back")
def returns_local(spark, sf):
    return orders.local_returns(_moves(spark, sf))


@register("returns_base", "SELECT * FROM sent_back_base")
def returns_base(spark, sf):
    return orders.convert(orders.local_returns(_moves(spark, sf)), fx.fx_rates(spark, sf),
                          "return_amount", "return_date")


@register("order_values", "SELECT * FROM net")
def order_values(spark, sf):
    return _values(spark, sf)


@register("order_values_total_returns", "SELECT * FROM net_total")
def order_values_total_returns(spark, sf):
    return _values(spark, sf, "total")


# Cohort, training rows, revenue

@register("cohort_counts", "SELECT * FROM counts")
def cohort_counts(spark, sf):
    return cohort.order_counts(_values(spark, sf), fx.AS_OF)


@register("eligible_customers", "SELECT * FROM eligible")
def eligible_customers(spark, sf):
    return cohort.eligible_customers(_values(spark, sf), fx.AS_OF)


@register("changed_customers", "SELECT * FROM touched")
def changed_customers(spark, sf):
    return cohort.changed_customers(fx.ledger_documents(spark, sf), fx.AS_OF)


@register("training_weekly", "SELECT * FROM train")
def training_weekly(spark, sf):
    return datasets.training_set(fx.ledger(spark, sf), "weekly", fx.AS_OF)


@register("training_newest_first", "SELECT * FROM train ORDER BY order_date DESC")
def training_newest_first(spark, sf):
    return datasets.training_set(fx.ledger(spark, sf), "weekly", fx.AS_OF, newest_first=True)


@register("training_daily", "SELECT * FROM train_daily")
def training_daily(spark, sf):
    return datasets.training_set(fx.ledger(spark, sf), "daily", fx.AS_OF)


def _revenue_sql(train: str) -> str:
    return f"SELECT userId, round(CAST(sum(CAST(order_value AS DECIMAL(30,10))) AS DOUBLE), 6) AS current_total_revenue FROM {train} GROUP BY userId ORDER BY userId"


def _revenue(df: DataFrame) -> DataFrame:
    """The engines turn an exact decimal into doubles that may differ in the last bit."""
    return df.withColumn("current_total_revenue", F.round("current_total_revenue", 6))


@register("revenue_weekly", _revenue_sql("train"))
def revenue_weekly(spark, sf):
    return _revenue(datasets.revenue_per_customer(fx.ledger(spark, sf), "weekly", fx.AS_OF, ordered=True))


@register("revenue_daily", _revenue_sql("train_daily"))
def revenue_daily(spark, sf):
    return _revenue(datasets.revenue_per_customer(fx.ledger(spark, sf), "daily", fx.AS_OF, ordered=True))


@register("revenue_from_training", _revenue_sql("train"))
def revenue_from_training(spark, sf):
    return _revenue(datasets.load_training(fx.ledger(spark, sf), "weekly", fx.AS_OF)[1])


# Purchase histories

_RFM_SQL = """SELECT userId, frequency, round(recency, 6) AS recency, round(T, 6) AS T,
              round(monetary_value, 6) AS monetary_value FROM {}"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("userId", "frequency", *[
        F.round(c, 6).alias(c) for c in df.columns if c not in ("userId", "frequency")])


def _train(spark, sf) -> DataFrame:
    """Training rows, written once for the operators that read them more than once."""
    return written(datasets.training_set(fx.ledger(spark, sf), "weekly", fx.AS_OF), "train")


@register("rfm_month", _RFM_SQL.format("month_rfm"))
def rfm_month(spark, sf):
    return _rounded(rfm.rfm_summary(_train(spark, sf), "M"))


@register("rfm_week", _RFM_SQL.format("week_rfm"))
def rfm_week(spark, sf):
    return _rounded(rfm.rfm_summary(fx.purchases(spark, sf), "W"))


@register("rfm_day", _RFM_SQL.format("day_rfm"))
def rfm_day(spark, sf):
    return _rounded(rfm.rfm_summary(fx.purchases(spark, sf), "D"))


@register("rfm_filtered", _RFM_SQL.format("day_repeat"))
def rfm_filtered(spark, sf):
    return _rounded(rfm.repeat_buyers(rfm.rfm_summary(fx.purchases(spark, sf), "D")))


@register("rfm_with_revenue", """SELECT userId, frequency, round(recency, 6) AS recency, round(T, 6) AS T,
          round(monetary_value, 6) AS monetary_value, round(current_total_revenue, 6) AS current_total_revenue
          FROM month_repeat""")
def rfm_with_revenue(spark, sf):
    train = _train(spark, sf)
    return _rounded(rfm.with_revenue(rfm.repeat_buyers(rfm.rfm_summary(train, "M")),
                                     cohort.customer_revenue(train)))


def _customers(spark, sf, mode="weekly", data=None, moves=None):
    """Histories of the scorable customers, from the join-free profiles.

    The profiles are written first, as in the jobs: the end of the observation
    is a second look at them.
    """
    profiles = cohort.customer_profiles(
        datasets.scoped_values(data or fx.ledger(spark, sf), mode, fx.AS_OF, moves=moves), "M", fx.AS_OF)
    return datasets.scoring_rows(written(profiles, "profiles"))


@register("scoring_rows", """SELECT userId, frequency, round(recency, 6) AS recency, round(T, 6) AS T,
          round(monetary_value, 6) AS monetary_value, round(current_total_revenue, 6) AS current_total_revenue
          FROM month_repeat""")
def scoring_rows(spark, sf):
    return _rounded(_customers(spark, sf))


# Scores with published parameters

def _scores(name: str, column: Callable[[], Column], formula: str, digits: int = 6) -> None:
    @register(name, f"SELECT userId, round({formula}, {digits}) AS {name} FROM month_repeat")
    def score(spark, sf):
        return _customers(spark, sf).select("userId", F.round(column(), digits).alias(name))


_scores("p_alive_bgnbd", BG.p_alive, sql.bg_alive())
_scores("expected_purchases_bgnbd", lambda: BG.expected_purchases(6.0), sql.bg_purchases(6.0))
_scores("p_alive_pareto", PARETO.p_alive, sql.pareto_alive())
_scores("expected_purchases_pareto", lambda: PARETO.expected_purchases(6.0),
        sql.pareto_purchases(6.0))
_scores("expected_average_value", GG.expected_average_value, sql.average_value(), 4)


@register("discounted_purchases", "SELECT userId, round(forecast / average, 6) AS discounted_purchases FROM "
          f"(SELECT userId, forecast FROM month_scored) JOIN (SELECT userId, {sql.average_value()} AS average "
          "FROM month_repeat) USING (userId)")
def discounted(spark, sf):
    return _customers(spark, sf).select(
        "userId", F.round(discounted_purchases(BG), 6).alias("discounted_purchases"))


@register("lifetime_value", "SELECT userId, round(forecast, 2) AS lifetime_value FROM month_scored")
def lifetime(spark, sf):
    return _customers(spark, sf).select(
        "userId", F.round(lifetime_value(BG, GG), 2).alias("lifetime_value"))


@register("predictions", "SELECT * FROM month_predicted")
def predictions_(spark, sf):
    return predict(_customers(spark, sf), BG, GG)


def _inputs(df: DataFrame, family) -> list[Column]:
    return [F.col(c) for c in family.inputs]


def _likelihood(name: str, model, formula: str) -> None:
    @register(name, f"SELECT userId, round({formula}, 6) AS {name} FROM month_repeat")
    def likelihood(spark, sf):
        params = vars(model)
        return _customers(spark, sf).select("userId", F.round(model.log_likelihood(
            params, model.constant(**params), *[F.col(c) for c in model.inputs]), 6).alias(name))


_likelihood("log_likelihood_bgnbd", BG, sql.bg_log_likelihood())
_likelihood("log_likelihood_pareto", PARETO, sql.pareto_log_likelihood())
_likelihood("log_likelihood_gamma_gamma", GG, sql.gg_log_likelihood())


# Segments and the merge

_PERCENTILES = ", ".join(f"quantile_disc(clv, {p / 100}) AS p{p}" for p in (25, 50, 75))


@register("clv_percentiles", f"SELECT {_PERCENTILES} FROM known")
def clv_percentiles(spark, sf):
    return segments.clv_percentiles(fx.existing_predictions(spark, sf))


_BOUNDARIES = ("SELECT unnest(range(0, 101)) AS boundary, unnest(quantile_disc(clv, "
               f"[{', '.join(str(i / 100) for i in range(101))}])) AS clv FROM known")


def _boundaries(quantiles: DataFrame) -> DataFrame:
    return quantiles.select(F.posexplode("percentiles").alias("boundary", "clv"))


@register("clv_quantiles", _BOUNDARIES)
def clv_quantiles(spark, sf):
    return _boundaries(segments.clv_quantiles(written(fx.existing_predictions(spark, sf), "known")))


@register("clv_percentiles_by_sketch", f"SELECT {_PERCENTILES} FROM (FROM known UNION ALL FROM fresh)")
def clv_percentiles_by_sketch(spark, sf):
    """Cuts of two batches from their sketches, which are exact up to their size."""
    sketches = (segments.value_sketch(fx.existing_predictions(spark, sf))
                .unionByName(segments.value_sketch(fx.new_predictions(spark, sf))))
    return spark.createDataFrame([tuple(segments.sketched_percentiles(sketches, segments.CUTS))],
                                 "p25 double, p50 double, p75 double")


@register("clv_segments", f"SELECT userId, {sql.value_label('known')} AS clv_segment FROM known")
def clv_segments(spark, sf):
    return segments.segment(fx.existing_predictions(spark, sf)).select("userId", "clv_segment")


@register("churn_segments",
          f"SELECT userId, {sql.RISK_LABEL} AS churn_probability_segment FROM known")
def churn_segments(spark, sf):
    return fx.existing_predictions(spark, sf).select(
        "userId", churn_segment(without_nan(F.col("churn_probability")))
        .alias("churn_probability_segment"))


@register("segmented_weekly", sql.segmented("fresh"))
def segmented_weekly(spark, sf):
    return segments.segment(fx.new_predictions(spark, sf))


@register("kept_predictions", "SELECT * FROM kept")
def kept_predictions(spark, sf):
    return segments.kept_predictions(fx.existing_predictions(spark, sf),
                                     fx.new_predictions(spark, sf))


@register("merged_predictions", "SELECT * FROM merged")
def merged_predictions(spark, sf):
    return segments.merged_predictions(fx.existing_predictions(spark, sf),
                                       fx.new_predictions(spark, sf))


@register("segmented_daily", sql.segmented("merged"))
def segmented_daily(spark, sf):
    return segments.merge_and_segment(fx.existing_predictions(spark, sf),
                                      fx.new_predictions(spark, sf))


@register("segmented_scores", sql.segmented("month_predicted"))
def segmented_scores(spark, sf):
    return segments.segment(written(predict(_customers(spark, sf), BG, GG), "scored"))


# Registry, exports, published table

@register("model_name_dates", "SELECT * FROM file_dates")
def model_name_dates(spark, sf):
    return models.name_dates(fx.model_names(spark, sf))


@register("models_with_prefix", "SELECT file FROM files WHERE file LIKE 'archive/clv_model_BGNBD%'")
def models_with_prefix(spark, sf):
    return models.with_prefix(fx.model_names(spark, sf), "archive/clv_model_BGNBD")


@register("models_in_folder", "SELECT file FROM files WHERE file LIKE 'a%' AND instr(file, '/') = 0 "
          "UNION ALL SELECT file FROM files WHERE file LIKE 'c%' AND instr(file, '/') = 0")
def models_in_folder(spark, sf):
    return models.with_prefix(fx.model_names(spark, sf), "", "/")


@register("newest_models", "SELECT * FROM file_dates WHERE date = (SELECT max(date) FROM file_dates)")
def newest_models(spark, sf):
    return models.newest_models(fx.model_names(spark, sf))


@register("csv_roundtrip", "SELECT * FROM known")
def csv_roundtrip(spark, sf):
    path = shared_path(spark, predictions.export_name(fx.AS_OF))
    predictions.write_csv(fx.existing_predictions(spark, sf), path)
    return predictions.read_csv(spark, path)


@register("csv_detected_schema", "SELECT * FROM known")
def csv_detected_schema(spark, sf):
    path = shared_path(spark, predictions.export_name(fx.AS_OF))
    predictions.write_csv(fx.existing_predictions(spark, sf), path)
    return predictions.read_csv(spark, path, schema=None)


@register("published_table", sql.segmented("merged"))
def published_table(spark, sf):
    """Two refreshes: the second reads the table that it replaces."""
    table = predictions.PredictionTable(spark, shared_path(spark, "published"))
    jobs.refresh(table, fx.existing_predictions(spark, sf), "weekly", "first")
    jobs.refresh(table, fx.new_predictions(spark, sf), "daily", "second")
    return table.current()


# Fits

def _fitted(spark, result: Fit) -> DataFrame:
    """One row per parameter of the fitted model, to four decimals."""
    rows = [(name, round(value, 4), result.n_customers, round(result.log_likelihood / result.n_customers, 4),
             result.converged) for name, value in vars(result.model).items()]
    return spark.createDataFrame(rows, "parameter string, value double, n_customers long, "
                                       "mean_log_likelihood double, converged boolean")


def _fits(name: str, fit) -> None:
    @register(name, sql.fitted(name.removeprefix("fit_"), CFG.penalizer))
    def fitted(spark, sf):
        customers = written(_customers(spark, sf), "histories")
        return _fitted(spark, fit(customers, CFG.penalizer))


_fits("fit_bgnbd", fit_bgnbd)
_fits("fit_pareto_nbd", fit_pareto_nbd)
_fits("fit_gamma_gamma", fit_gamma_gamma)


# Jobs

def _published_models(spark, path: str) -> str:
    """A registry holding the published parameters, for jobs that only score."""
    models.save_models(spark, path, [Fit(BG, 0, 0.0, 0, True), Fit(GG, 0, 0.0, 0, True)], fx.AS_OF)
    return path


@register("run_weekly", "SELECT * REPLACE (round(clv, 1) AS clv, round(predicted_value_next_6_month, 1) AS "
          f"predicted_value_next_6_month) FROM ({sql.segmented('weekly_predicted')})")
def run_weekly(spark, sf):
    """The weekly job: both searches for parameters end within rounding, so money is compared to a tenth."""
    work = shared_path(spark, "weekly")
    table = predictions.PredictionTable(spark, f"{work}/table")
    jobs.run_weekly(spark, fx.ledger(spark, sf), f"{work}/models", table, f"{work}/staging",
                    CFG, fx.AS_OF)
    return table.current().withColumns({c: F.round(c, 1) for c in ("clv", "predicted_value_next_6_month")})


def _weekly_base(spark, sf, work: str, data=None, moves=None) -> predictions.PredictionTable:
    table = predictions.PredictionTable(spark, f"{work}/table")
    jobs.refresh(table, predict(_customers(spark, sf, "weekly", data, moves), BG, GG), "weekly", "base")
    return table


@register("run_daily", sql.segmented("refreshed"))
def run_daily(spark, sf):
    """The daily job on a table scored before, with the published parameters.

    Both read one ledger, so its amounts are computed once.
    """
    work, data = shared_path(spark, "daily"), fx.ledger(spark, sf)
    moves = written(orders.movements(data.lines, data.documents), "movements")
    table = _weekly_base(spark, sf, work, data, moves)
    jobs.run_daily(spark, data, _published_models(spark, f"{work}/models"), table,
                   f"{work}/staging", CFG, fx.AS_OF, moves=moves)
    return table.current()


@register("stream_scoring", sql.segmented("refreshed"))
def stream_scoring(spark, sf):
    """The daily job as a stream: the documents changed since yesterday arrive as files."""
    work = shared_path(spark, "stream")
    data = fx.ledger(spark, sf)
    table = _weekly_base(spark, sf, work)
    registry = _published_models(spark, f"{work}/models")
    (data.documents.where(F.to_date("__ts_ms") >= F.date_sub(F.lit(fx.AS_OF), 1))
     .write.parquet(f"{work}/arrivals"))
    incremental.start_scoring(
        incremental.document_stream(spark, f"{work}/arrivals"), lambda: data, registry, table,
        f"{work}/staging", f"{work}/progress", CFG, fx.AS_OF).awaitTermination()
    return table.current()
