"""Scores of a customer: churn probability, forecast and lifetime value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import ScoringConfig, horizon
from clientele.functions.labels import without_nan
from clientele.functions.money import half_even
from clientele.operators.bgnbd import BgNbd
from clientele.operators.gammagamma import GammaGamma
from clientele.operators.pareto import ParetoNbd

PurchaseModel = BgNbd | ParetoNbd


def discounted_purchases(model: PurchaseModel, months: int = 6, discount_rate: float = 0.01,
                         frequency: str = "M") -> Column:
    """Expected purchases of each month ahead, discounted from that month's end.

    The monthly increments are summed by parts, so that each month costs one
    evaluation of the model instead of two.
    """
    factors = [(1.0 + discount_rate) ** -i for i in range(1, months + 1)]
    weights = [f - g for f, g in zip(factors, factors[1:] + [0.0], strict=True)]
    return model.purchases([horizon(frequency, i) for i in range(1, months + 1)], weights)


def lifetime_value(model: PurchaseModel, value: GammaGamma, months: int = 6,
                   discount_rate: float = 0.01, frequency: str = "M") -> Column:
    """Discounted value of the purchases expected over the horizon."""
    return (value.expected_average_value()
            * discounted_purchases(model, months, discount_rate, frequency))


def predict(customers: DataFrame, model: PurchaseModel, value: GammaGamma,
            cfg: ScoringConfig = ScoringConfig(), transactions: bool = False) -> DataFrame:
    """Predictions from purchase histories with ``current_total_revenue``.

    One row-wise select: every score is computed on the customer's own row.
    ``transactions`` adds the expected number of purchases over the horizon.
    """
    revenue = F.col("current_total_revenue")
    scored = customers.select(
        "userId", "current_total_revenue",
        (1.0 - model.p_alive()).alias("churn"),
        lifetime_value(model, value, cfg.months, cfg.discount_rate, cfg.frequency)
        .alias("forecast"),
        *([model.expected_purchases(horizon(cfg.frequency, cfg.months)).alias("purchases")]
          if transactions else []))
    outputs = [
        without_nan(half_even(revenue + F.col("forecast"), 2)).alias("clv"),
        without_nan(half_even(F.col("churn"), 4)).alias("churn_probability"),
        without_nan(half_even(F.col("forecast"), 2)).alias("predicted_value_next_6_month"),
        half_even(revenue, 2).alias("current_total_revenue")]
    if transactions:
        outputs.append(without_nan(F.col("purchases")).alias("predicted_transactions_next_6_month"))
    return scored.select("userId", *outputs)
