"""Gamma-Gamma model of the value per purchase (Fader and Hardie, 2013)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.config import GAMMA_GAMMA
from clientele.functions.jets import Jet
from clientele.functions.special import gammaln, ln


@dataclass(frozen=True)
class GammaGamma:
    """Fitted parameters; the methods are columns over frequency and monetary_value."""

    p: float
    q: float
    v: float

    type_tag: ClassVar[str] = GAMMA_GAMMA
    inputs: ClassVar[tuple[str, ...]] = ("frequency", "monetary_value")
    times: ClassVar[tuple[str, ...]] = ()
    rates: ClassVar[tuple[str, ...]] = ()

    @staticmethod
    def constant(p: float, q: float, v: float) -> float:
        """The part of the log-likelihood that is the same for every customer."""
        return q * ln(v) - gammaln(q)

    @staticmethod
    def log_likelihood(p, constant, frequency: Column, monetary_value: Column) -> Column:
        """ln L of one customer; ``p`` maps parameter names to columns or numbers."""
        x, m = frequency, monetary_value
        shape = p["p"] * x
        return (constant + gammaln(shape + p["q"]) - gammaln(shape) - F.log(m)
                + shape * F.log(m * x) - (shape + p["q"]) * F.log(x * m + p["v"]))

    @staticmethod
    def frequency_sums() -> dict[str, Column]:
        """What the terms without a product of parameters and values sum to, for one pass over the rows."""
        x, m = F.col("frequency"), F.col("monetary_value")
        return {"log_value": F.sum(F.col("weight") * F.log(m)),
                "log_total": F.sum(F.col("weight") * x * F.log(m * x))}

    @staticmethod
    def by_frequency(p: dict[str, Jet], frequency: np.ndarray) -> Jet:
        """The part of ln L that depends on the frequency alone."""
        shape = p["p"] * frequency
        return (shape + p["q"]).gammaln() - shape.gammaln() - p["q"].gammaln() + p["q"] * p["v"].log()

    @staticmethod
    def by_sums(p: dict[str, Jet], log_value: float, log_total: float) -> Jet:
        """The part of the summed ln L that the sums of ``frequency_sums`` give."""
        return p["p"] * log_total - log_value

    @staticmethod
    def row_derivatives(p: dict[str, Column], frequency: Column,
                        monetary_value: Column) -> tuple[list[dict[str, Column]], dict[tuple, Column]]:
        """The rest of ln L, -(px + q) ln(xm + v): one logarithm for each row.

        Columns to add one after the other, and from them the value and its derivatives, named by no, one
        and two parameters.
        """
        x, shape, part, log = frequency, F.col("_shape"), F.col("_part"), F.col("_log")
        steps = [{"_shape": p["p"] * x + p["q"], "_part": 1.0 / (x * monetary_value + p["v"])},
                 {"_log": F.log(part)}]
        return steps, {(): shape * log, ("p",): x * log, ("q",): log, ("v",): -shape * part,
                       ("p", "v"): -x * part, ("q", "v"): -part, ("v", "v"): shape * part * part}

    def expected_average_value(self) -> Column:
        """Expected value per purchase given the customer's history.

        The population mean p v / (q-1) and its weight (q-1) / (px+q-1) are
        multiplied out, so that q = 1 is no special case.
        """
        shape = self.p * F.col("frequency")
        return (self.p * self.v + shape * F.col("monetary_value")) / (shape + self.q - 1.0)
