"""The weekly fit-and-score job and the daily scoring job."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from clientele.config import ScoringConfig
from clientele.functions.dates import today
from clientele.operators.cohort import customer_profiles
from clientele.operators.fitting import fit, fit_gamma_gamma, purchase_model
from clientele.operators.scoring import predict
from clientele.operators.segments import (
    COLUMNS, CUTS, merged_predictions, segment, sketched_percentiles, value_sketch)
from clientele.plans.datasets import scoped_values, scoring_rows
from clientele.schemas import PREDICTION
from clientele.session import configure, intermediates, sized_shuffles, written
from clientele.sources.ledger import Ledger
from clientele.sources.models import latest_models, read_models, save_models
from clientele.sources.predictions import (
    PredictionTable, export_name, read_staged, stage, write_csv)

_DEFAULT = ScoringConfig()
_LOG = logging.getLogger(__name__)


def business_day(spark: SparkSession, as_of: dt.date | None, cfg: ScoringConfig) -> dt.date:
    """The given day, or today in the business zone, fixed once for the whole job."""
    if as_of is not None:
        return as_of
    return spark.range(1).select(today(cfg.business_zone)).first()[0]


def refresh(table: PredictionTable, new: DataFrame, mode: str, version: str,
            view: str | None = None, approximate: bool = False) -> int:
    """Publish a new version: replaced by ``new`` (weekly) or merged with it (daily).

    Rows are written before they are labelled, so that the cuts and the labels read the
    written rows.  A daily refresh fails if another one was published since it read the table.

    With ``approximate`` the cuts come from mergeable sketches: that of ``new``, and for a daily refresh the one stored
    with the version that is replaced.  The kept rows are then read once, to be labelled.  Besides the
    sketch's own error, shares are off by the share of the rows that ``new`` replaces at most.
    """
    current, base = table.newest()
    if mode not in ("weekly", "daily"):
        raise ValueError(f"mode must be weekly or daily, not {mode!r}")
    if approximate:
        new = written(new.select(*COLUMNS), "scored")
        sketches = value_sketch(new)
        if mode == "daily" and current is not None:
            sketches = sketches.unionByName(table.sketch(current))
        rows = new if mode == "weekly" else merged_predictions(table.current(), new)
        labelled = segment(rows, sketched_percentiles(sketches, CUTS))
        return table.publish(labelled, version, base if mode == "daily" else None, view)
    if mode == "weekly":
        return table.publish(segment(written(new.select(*COLUMNS), "scored")), version, view=view)
    merged = written(merged_predictions(table.current(), new), "merged")
    return table.publish(segment(merged), version, base, view)


def _version(mode: str, day: dt.date) -> str:
    return f"{mode}-{day:%Y%m%d}-{uuid.uuid4().hex[:8]}"


def run_weekly(spark: SparkSession, ledger: Ledger, registry: str, table: PredictionTable,
               staging: str, cfg: ScoringConfig = _DEFAULT, as_of: dt.date | None = None,
               observation_end: dt.date | None = None, view: str | None = None,
               export: str | None = None) -> DataFrame:
    """Fit both models on all eligible customers, score them, and replace the table.

    Returns the scored batch.  Without customers nothing is written.  When a fit does not
    converge it raises, before anything is saved, unless the configuration allows that.  ``export`` names a
    folder that also gets the batch as a date-stamped CSV.
    """
    day = business_day(configure(spark), as_of, cfg)
    with (sized_shuffles(spark, ledger.lines, ledger.documents, unknown=cfg.unknown_bytes),
          intermediates(spark)):
        profiles = written(customer_profiles(scoped_values(ledger, "weekly", day, cfg),
                                             cfg.frequency, day, cfg), "profiles")
        customers = written(scoring_rows(profiles, cfg, observation_end), "histories")
        if customers.isEmpty():
            return spark.createDataFrame([], PREDICTION)
        fits = [fit(purchase_model(cfg.model_type), customers, cfg.penalizer),
                fit_gamma_gamma(customers, cfg.penalizer)]
        if not cfg.allow_unconverged:
            for one in fits:
                one.require_convergence()
        save_models(spark, registry, fits, day, cfg.frequency, cfg.penalizer, cfg.model_prefix)
        version = _version("weekly", day)
        new = _staged(spark, predict(customers, fits[0].model, fits[1].model, cfg), staging, version)
        refresh(table, new, "weekly", version, view, cfg.approximate_cuts)
        _export(new, export, day, "weekly_predictions")
        return new


def _export(batch: DataFrame, folder: str | None, day: dt.date, prefix: str) -> None:
    if folder is not None:
        rows = write_csv(batch, f"{folder.rstrip('/')}/{export_name(day, prefix)}")
        _LOG.info("exported %d rows", rows)


def run_daily(spark: SparkSession, ledger: Ledger, registry: str, table: PredictionTable,
              staging: str, cfg: ScoringConfig = _DEFAULT, as_of: dt.date | None = None,
              observation_end: dt.date | None = None, model_type: str | None = None,
              export: str | None = None, view: str | None = None,
              moves: DataFrame | None = None) -> DataFrame:
    """Score the recently changed customers with the newest models and merge them in.

    Returns the scored batch.  Without changed customers nothing is written.  ``export`` names a
    folder that also gets the batch as a date-stamped CSV.  ``moves``, the ledger's amounts as another job of the
    day has written them (``movements``), saves computing them again.
    """
    day = business_day(configure(spark), as_of, cfg)
    with (sized_shuffles(spark, ledger.lines, ledger.documents, unknown=cfg.unknown_bytes),
          intermediates(spark)):
        profiles = written(customer_profiles(scoped_values(ledger, "daily", day, cfg, moves),
                                             cfg.frequency, day, cfg), "profiles")
        new = score_and_merge(spark, profiles, registry, table, staging, _version("daily", day),
                              cfg, observation_end, model_type, view)
        if not new.isEmpty():
            _export(new, export, day, "daily_predictions")
        return new


def _staged(spark: SparkSession, scored: DataFrame, staging: str, version: str) -> DataFrame:
    """The batch in a staging folder of its own, so that no other job writes to it."""
    path = f"{staging.rstrip('/')}/{version}"
    rows = stage(scored, path)
    _LOG.info("staged %d rows for %s", rows, version)
    return read_staged(spark, path)


def score_and_merge(spark: SparkSession, profiles: DataFrame, registry: str,
                    table: PredictionTable, staging: str, version: str,
                    cfg: ScoringConfig = _DEFAULT, observation_end: dt.date | None = None,
                    model_type: str | None = None, view: str | None = None) -> DataFrame:
    """Score these profiles with the newest models, stage them, and merge them into the table."""
    customers = scoring_rows(profiles, cfg, observation_end)
    if customers.isEmpty():
        return spark.createDataFrame([], PREDICTION)
    purchases, value = latest_models(read_models(spark, registry), cfg.model_prefix, model_type,
                                     cfg.frequency)
    new = _staged(spark, predict(customers, purchases, value, cfg), staging, version)
    refresh(table, new, "daily", version, view, cfg.approximate_cuts)
    return new
