"""The data sets a user asks for by name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.config import ScoringConfig
from clientele.operators.cohort import (
    changed_customers, customer_profiles, customer_revenue, training_rows)
from clientele.operators.orders import order_values
from clientele.operators.rfm import history, repeat_buyers
from clientele.sources.ledger import Ledger

_DEFAULT = ScoringConfig()


def scoped_values(ledger: Ledger, mode: str = "weekly", as_of: dt.date | None = None,
                  cfg: ScoringConfig = _DEFAULT, moves: DataFrame | None = None) -> DataFrame:
    """Order values of all customers (weekly) or of the recently changed ones (daily).

    ``moves`` as in ``order_values``.
    """
    if mode == "weekly":
        return order_values(*ledger, returns=cfg.returns, moves=moves)
    if mode == "daily":
        changed = changed_customers(ledger.documents, as_of, cfg)
        return order_values(*ledger, returns=cfg.returns, customers=changed, moves=moves)
    raise ValueError(f"mode must be weekly or daily, not {mode!r}")


def training_set(ledger: Ledger, mode: str = "weekly", as_of: dt.date | None = None,
                 cfg: ScoringConfig = _DEFAULT, newest_first: bool = False) -> DataFrame:
    return training_rows(scoped_values(ledger, mode, as_of, cfg), as_of, cfg,
                         newest_first=newest_first)


def load_training(ledger: Ledger, mode: str = "weekly", as_of: dt.date | None = None,
                  cfg: ScoringConfig = _DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Training rows and revenue per customer; the second derives from the first."""
    train = training_set(ledger, mode, as_of, cfg)
    return train, customer_revenue(train)


def revenue_per_customer(ledger: Ledger, mode: str = "weekly", as_of: dt.date | None = None,
                         cfg: ScoringConfig = _DEFAULT, ordered: bool = False) -> DataFrame:
    """Revenue of eligible customers, by the aggregate that also decides who is eligible."""
    profiles = customer_profiles(scoped_values(ledger, mode, as_of, cfg), cfg.frequency, as_of, cfg)
    revenue = profiles.select("userId", F.col("revenue").cast("double")
                              .alias("current_total_revenue"))
    return revenue.orderBy("userId") if ordered else revenue


def scoring_rows(profiles: DataFrame, cfg: ScoringConfig = _DEFAULT,
                 observation_end: dt.date | None = None) -> DataFrame:
    """Purchase history and revenue of the customers that the models can score."""
    described = history(profiles, cfg.frequency, observation_end)
    return repeat_buyers(described).select(
        "userId", "frequency", "recency", "T", "monetary_value",
        F.col("revenue").cast("double").alias("current_total_revenue"))
