"""Model registry: one row per fitted model, parameters as a map."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.config import BGNBD, GAMMA_GAMMA, PARETO, check_frequency
from clientele.functions.dates import embedded_date
from clientele.operators.bgnbd import BgNbd
from clientele.operators.fitting import Fit
from clientele.operators.gammagamma import GammaGamma
from clientele.operators.pareto import ParetoNbd
from clientele.schemas import MODEL

_FAMILIES = {BGNBD: BgNbd, PARETO: ParetoNbd, GAMMA_GAMMA: GammaGamma}


def model_name(prefix: str, model_type: str, fitted_on: dt.date) -> str:
    return f"{prefix}_{model_type}_{fitted_on:%Y-%m-%d}"


def save_models(spark: SparkSession, path: str, fits: list[Fit], fitted_on: dt.date,
                frequency: str = "M", penalizer: float = 0.0,
                prefix: str = "clv_model") -> None:
    """Add fitted models to the registry; a model of the same name is replaced."""
    rows = [(model_name(prefix, f.model.type_tag, fitted_on), frequency,
             {k: float(v) for k, v in vars(f.model).items()}, float(penalizer), f.n_customers,
             float(f.log_likelihood), f.steps, f.converged, fitted_on, f.model.type_tag)
            for f in fits]
    (spark.createDataFrame(rows, MODEL).coalesce(1).write
     .partitionBy("fitted_on", "model_type", "model_name")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL).parquet(path)


def with_prefix(names: DataFrame, prefix: str, delimiter: str | None = None,
                column: str = "file") -> DataFrame:
    """Entries whose name starts with the prefix; with a delimiter, none from deeper folders."""
    found = names.where(F.col(column).startswith(prefix))
    if delimiter:
        rest = F.substring(F.col(column), F.lit(len(prefix) + 1), F.length(F.col(column)))
        found = found.where(~F.contains(rest, F.lit(delimiter)))
    return found


def name_dates(names: DataFrame, column: str = "file") -> DataFrame:
    return names.withColumn("date", embedded_date(F.col(column)))


def newest_models(names: DataFrame, column: str = "file") -> DataFrame:
    """All entries of the latest date in any name; undated ones never count."""
    dated = name_dates(names, column)
    return dated.where(F.col("date") == dated.agg(F.max("date")).scalar())


def latest_models(models: DataFrame, prefix: str = "clv_model",
                  model_type: str | None = None,
                  frequency: str | None = None) -> tuple[BgNbd | ParetoNbd, GammaGamma]:
    """Purchase and value model of the newest date in the registry.

    With ``frequency`` only models that were fitted to periods of that length count.

    When both purchase models share that date the later name wins, unless
    ``model_type`` says which one to take.
    """
    named = with_prefix(models, prefix, column="model_name")
    if frequency is not None:
        named = named.where(F.col("frequency") == check_frequency(frequency))
    newest = newest_models(named, "model_name")
    by_type = {row["model_type"]: row for row in newest
               .groupBy("model_type").agg(F.max_by("params", "model_name").alias("params"),
                                          F.max("model_name").alias("model_name")).collect()}
    wanted = [model_type] if model_type else [BGNBD, PARETO]
    found = [by_type[t] for t in wanted if t in by_type]
    if not found or GAMMA_GAMMA not in by_type:
        periods = f" for frequency {frequency}" if frequency else ""
        raise LookupError(f"no complete set of models named {prefix}*{periods} in the registry")
    purchase = max(found, key=lambda row: row["model_name"])
    return (_FAMILIES[purchase["model_type"]](**purchase["params"]),
            GammaGamma(**by_type[GAMMA_GAMMA]["params"]))
