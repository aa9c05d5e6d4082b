"""Pareto/NBD purchase model (Schmittlein, Morrison and Colombo, Management Science 33(1), 1987)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.config import PARETO
from clientele.functions.jets import Jet, log_hyp2f1_one
from clientele.functions.special import gammaln, hyp2f1_one, ln, power_difference


def _log_term(b, c, small, large, small_power, large_power, t):
    """ln of 2F1(1, b; c; 1 - (small+t)/(large+t)) (small+t)^small_power (large+t)^large_power."""
    z = (large - small) / (large + t)
    return (np.log(hyp2f1_one(b, c, z)) + small_power * np.log(small + t)
            + large_power * np.log(large + t))


def _log_dead_odds(frequency: pd.Series, recency: pd.Series, age: pd.Series, r: pd.Series,
                   alpha: pd.Series, s: pd.Series, beta: pd.Series) -> pd.Series:
    """ln of the odds that the customer has left: s/(r+s+x) (alpha+T)^(r+x) (beta+T)^s A0.

    A0's two hypergeometric terms are taken in Euler's form, whose factors stay
    positive; the roles of alpha and beta swap when alpha is the larger.
    """
    x, tx, T, r, alpha, s, beta = (
        v.to_numpy(float) for v in (frequency, recency, age, r, alpha, s, beta))
    n = r + x
    swapped = alpha > beta
    small, large = np.minimum(alpha, beta), np.maximum(alpha, beta)
    b = np.where(swapped, n, s + 1.0)
    powers = (np.where(swapped, -s, 1.0 - n), np.where(swapped, -n, -s - 1.0))
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        first = _log_term(b, n + s + 1.0, small, large, *powers, tx)
        last = _log_term(b, n + s + 1.0, small, large, *powers, T)
        log_a0 = first + np.log(-np.expm1(np.minimum(last - first, 0.0)))
        odds = (np.log(s) - np.log(n + s) + n * np.log(alpha + T) + s * np.log(beta + T) + log_a0)
    return pd.Series(odds)


def _dead_odds_column(*inputs: Column) -> Column:
    return F.pandas_udf(_log_dead_odds, "double")(*inputs)


@dataclass(frozen=True)
class ParetoNbd:
    """Fitted parameters; the methods are columns over frequency, recency and T."""

    r: float
    alpha: float
    s: float
    beta: float

    type_tag: ClassVar[str] = PARETO
    inputs: ClassVar[tuple[str, ...]] = ("frequency", "recency", "T")
    times: ClassVar[tuple[str, ...]] = ("recency", "T")
    rates: ClassVar[tuple[str, ...]] = ("alpha", "beta")

    @staticmethod
    def constant(r: float, alpha: float, s: float, beta: float) -> float:
        """The part of the log-likelihood that is the same for every customer."""
        return r * ln(alpha) + s * ln(beta) - gammaln(r)

    @staticmethod
    def log_likelihood(p, constant, frequency: Column, recency: Column, T: Column) -> Column:
        """ln L of one customer; ``p`` maps parameter names to columns or numbers."""
        r, alpha, s, beta = (_column(p[k]) for k in ("r", "alpha", "s", "beta"))
        rate = r + frequency
        odds = _dead_odds_column(frequency, recency, T, r, alpha, s, beta)
        gone = F.greatest(odds, F.lit(0.0)) + F.log1p(F.exp(-F.abs(odds)))
        return (constant + gammaln(rate) - rate * F.log(alpha + T) - s * F.log(beta + T) + gone)

    @staticmethod
    def by_frequency(p: dict[str, Jet], frequency: np.ndarray) -> Jet:
        """The part of ln L that depends on the frequency alone."""
        r = p["r"]
        return (r + frequency).gammaln() - r.gammaln() + r * p["alpha"].log() + p["s"] * p["beta"].log()

    @staticmethod
    def row_total(p: dict[str, Jet], frequency: np.ndarray, recency: np.ndarray, T: np.ndarray,
                  weight: np.ndarray) -> np.ndarray:
        """The weighted sum of the rest of ln L over some rows, and its derivatives (numpy: the hypergeometric
        sums run to a tolerance).
        """
        r, alpha, s, beta = (p[n] for n in ("r", "alpha", "s", "beta"))

        def alive(x, age) -> Jet:
            return -((r + x) * (alpha + age).log()) - s * (beta + age).log()

        # Who bought in the last instant is alive: A0 is zero for all parameters.
        now = recency >= T
        total = alive(frequency[now], T[now]).total(weight[now])
        x, tx, age, weight = frequency[~now], recency[~now], T[~now], weight[~now]
        if not len(x):
            return total
        n = r + x
        swapped = bool(alpha.value > beta.value)
        small, large = (beta, alpha) if swapped else (alpha, beta)
        b = n if swapped else s + 1.0
        powers = (-s, -n) if swapped else (1.0 - n, -s - 1.0)

        def log_term(t) -> Jet:
            z = (large - small) / (large + t)
            return (log_hyp2f1_one(b, n + s + 1.0, z) + powers[0] * (small + t).log() + powers[1] * (large + t).log())

        first, last = log_term(tx), log_term(age)
        odds = (s.log() - (n + s).log() + n * (alpha + age).log() + s * (beta + age).log()
                + first + (last - first).log_one_less_exp())
        return total + (alive(x, age) + odds.softplus()).total(weight)

    def p_alive(self) -> Column:
        odds = _dead_odds_column(F.col("frequency"), F.col("recency"), F.col("T"),
                                 *(F.lit(v) for v in (self.r, self.alpha, self.s, self.beta)))
        return 1.0 / (1.0 + F.exp(odds))

    def purchases(self, horizons: Sequence[float], weights: Sequence[float]) -> Column:
        """Sum over horizons t of weight times expected purchases until t."""
        x, age = F.col("frequency"), F.col("T")
        grown = F.lit(0.0)
        for t, w in zip(horizons, weights, strict=True):
            grown = grown + float(w) * power_difference(
                (self.beta + age) / (self.beta + age + float(t)), self.s - 1.0)
        return (self.r + x) * (self.beta + age) / (self.alpha + age) * grown * self.p_alive()

    def expected_purchases(self, t: float) -> Column:
        return self.purchases([t], [1.0])


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
