"""BG/NBD purchase model (Fader, Hardie and Lee, Marketing Science 24(2), 2005)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.config import BGNBD
from clientele.functions.jets import Jet
from clientele.functions.special import gammaln, hyp2f1_tail, ln, power_difference


@dataclass(frozen=True)
class BgNbd:
    """Fitted parameters; the methods are columns over frequency, recency and T."""

    r: float
    alpha: float
    a: float
    b: float

    type_tag: ClassVar[str] = BGNBD
    inputs: ClassVar[tuple[str, ...]] = ("frequency", "recency", "T")
    times: ClassVar[tuple[str, ...]] = ("recency", "T")
    rates: ClassVar[tuple[str, ...]] = ("alpha",)

    @staticmethod
    def constant(r: float, alpha: float, a: float, b: float) -> float:
        """The part of the log-likelihood that is the same for every customer."""
        return r * ln(alpha) - gammaln(r) + gammaln(a + b) - gammaln(b)

    @staticmethod
    def log_likelihood(p, constant, frequency: Column, recency: Column, T: Column) -> Column:
        """ln L of one customer; ``p`` maps parameter names to columns or numbers."""
        x, rate = frequency, p["r"] + frequency
        alive = -rate * F.log(p["alpha"] + T)
        dead = (ln(p["a"]) - F.log(p["b"] + F.greatest(x, F.lit(1.0)) - 1.0)
                - rate * F.log(p["alpha"] + recency))
        top = F.greatest(alive, dead)
        either = top + F.log(F.exp(alive - top) + F.exp(dead - top))
        return (constant + gammaln(rate) + gammaln(p["b"] + x) - gammaln(p["a"] + p["b"] + x)
                + F.when(x > 0, either).otherwise(alive))

    @staticmethod
    def by_frequency(p: dict[str, Jet], frequency: np.ndarray) -> Jet:
        """The part of ln L that depends on the frequency alone."""
        r, alpha, a, b, x = p["r"], p["alpha"], p["a"], p["b"], frequency
        return ((r + x).gammaln() - r.gammaln() + r * alpha.log() + (a + b).gammaln() + (b + x).gammaln()
                - b.gammaln() - (a + b + x).gammaln())

    @staticmethod
    def row_derivatives(p: dict[str, Column], frequency: Column, recency: Column,
                        T: Column) -> tuple[list[dict[str, Column]], dict[tuple, Column]]:
        """The rest of ln L, ln(e^A + e^D): A is that of a customer who is alive, D of one who left after the last purchase.

        Columns to add one after the other, and from them the value and its derivatives, named by no, one
        and two parameters.
        """
        x, r, alpha = frequency, p["r"], p["alpha"]
        rate, old, seen, left, odds, share, none = (F.col(f"_{n}") for n in (
            "rate", "old", "seen", "left", "odds", "share", "none"))
        steps = [
            {"_rate": r + x, "_old": 1.0 / (alpha + T), "_seen": 1.0 / (alpha + recency), "_none": F.lit(0.0),
             "_left": 1.0 / (p["b"] + F.greatest(x, F.lit(1.0)) - 1.0)},
            {"_log_old": F.log(old), "_log_seen": F.log(seen)},
            {"_odds": F.log(p["a"] * left) + rate * (F.col("_log_seen") - F.col("_log_old"))},
            {"_share": F.when(x > 0, 1.0 / (1.0 + F.exp(-odds))).otherwise(0.0)}]
        alive = {("r",): F.col("_log_old"), ("alpha",): -rate * old, ("r", "alpha"): -old,
                 ("alpha", "alpha"): rate * old * old}
        dead = {("r",): F.col("_log_seen"), ("alpha",): -rate * seen, ("a",): 1.0 / p["a"], ("b",): -left,
                ("r", "alpha"): -seen, ("alpha", "alpha"): rate * seen * seen, ("a", "a"): -1.0 / (p["a"] * p["a"]),
                ("b", "b"): left * left}
        either = F.greatest(odds, none) + F.log1p(F.exp(-F.abs(odds)))
        out = {(): rate * F.col("_log_old") + F.when(x > 0, either).otherwise(0.0)}
        names = ("r", "alpha", "a", "b")
        steps.append({f"_{n}_apart": dead[(n,)] - alive.get((n,), none) for n in names})
        for n in names:
            out[(n,)] = alive.get((n,), none) + share * F.col(f"_{n}_apart")
        for i, n in enumerate(names):
            for m in names[i:]:
                here = alive.get((n, m), none)
                out[(n, m)] = (here + share * (dead.get((n, m), none) - here)
                               + share * (1.0 - share) * F.col(f"_{n}_apart") * F.col(f"_{m}_apart"))
        return steps, out

    def p_alive(self) -> Column:
        x, recency, age = F.col("frequency"), F.col("recency"), F.col("T")
        odds = (self.a / (self.b + x - 1.0)
                * F.pow((self.alpha + age) / (self.alpha + recency), self.r + x))
        return F.when(x > 0, 1.0 / (1.0 + odds)).otherwise(1.0)

    def purchases(self, horizons: Sequence[float], weights: Sequence[float]) -> Column:
        """Sum over horizons t of weight times expected purchases until t.

        With Euler's transformation the factors shrink to
        E = (c / (a-1)) (1 - (1-z)^(a-1) 2F1(a+b-1-r, a-1; c; z)) P(alive),
        c = a+b+x-1 and z = t / (alpha+T+t).
        """
        r, alpha, a, b = self.r, self.alpha, self.a, self.b
        steps, share = [float(t) for t in horizons], [float(w) for w in weights]

        @F.pandas_udf("double")
        def series(frequency: pd.Series, age: pd.Series) -> pd.Series:
            t = np.array(steps)[:, None]
            z = t / (alpha + age.to_numpy(float)[None, :] + t)
            tail = hyp2f1_tail(a + b - 1.0 - r, a - 1.0,
                               a + b - 1.0 + frequency.to_numpy(float)[None, :], z)
            return pd.Series(np.array(share) @ ((1.0 - z) ** (a - 1.0) * tail))

        x, age = F.col("frequency"), F.col("T")
        grown = F.lit(0.0)
        for t, w in zip(steps, share, strict=True):
            grown = grown + w * power_difference((alpha + age) / (alpha + age + t), a - 1.0)
        return (a + b - 1.0 + x) * (grown - series(x, age)) * self.p_alive()

    def expected_purchases(self, t: float) -> Column:
        return self.purchases([t], [1.0])
