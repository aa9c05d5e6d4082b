"""Maximum likelihood over all customers, as a short series of Spark aggregates.

The customers stay distributed.  Each Newton step is one pass over the rows: the value, the gradient and
the Hessian of the log-likelihood are sums of one aggregate, analytic and inside generated code for BG/NBD and
Gamma-Gamma, by forward-mode derivatives in numpy for the hypergeometric terms of Pareto/NBD.  Only these
sums (10 or 15 numbers) reach the driver, which takes the step in log-parameters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import BGNBD, PARETO
from clientele.functions.jets import pairs, variables
from clientele.operators.bgnbd import BgNbd
from clientele.operators.gammagamma import GammaGamma
from clientele.operators.pareto import ParetoNbd

PURCHASE_MODELS = {BGNBD: BgNbd, PARETO: ParetoNbd}

_SHORTER = (0.5, 0.25, 0.1, 0.03, 0.01)
_MAX_STEPS = 100
# What another step would gain, relative to the objective, when the search ends.
_TOLERANCE = 1e-14
# Lowest log-parameter.  A likelihood may rise as a parameter goes to zero, and then has no maximum.
_FLOOR = math.log(1e-8)
# Least curvature that a step reckons with.
_FLATTEST = 1e-12
# Largest slope, in log-parameters and relative to the objective, of a converged fit.
_LEVEL = 1e-5


@dataclass(frozen=True)
class Fit:
    """A fitted model and how the search ended."""

    model: BgNbd | ParetoNbd | GammaGamma
    n_customers: int
    log_likelihood: float
    steps: int
    converged: bool

    def require_convergence(self) -> Fit:
        if not self.converged:
            raise ArithmeticError(f"the fit of {self.model} did not converge in {self.steps} steps")
        return self


def purchase_model(model_type: str):
    """Model class by type tag; an unknown tag is an error."""
    try:
        return PURCHASE_MODELS[model_type]
    except KeyError:
        raise ValueError(f"model type must be one of {sorted(PURCHASE_MODELS)}, "
                         f"not {model_type!r}") from None


def sufficient_rows(rfm: DataFrame, family) -> DataFrame:
    """Distinct model inputs with their number of customers: the likelihood needs no more."""
    return (rfm.groupBy(*family.inputs).agg(F.count(F.lit(1)).alias("weight")))


def summed_likelihood(family) -> Column:
    """Aggregate column: weighted log-likelihood at the parameters in columns ``_name``."""
    one = family.log_likelihood({f.name: F.col(f"_{f.name}") for f in fields(family)},
                                F.col("_constant"), *[F.col(c) for c in family.inputs])
    # An undefined logarithm is NULL, which a sum would skip; NaN spoils it as it should.
    return F.sum(F.col("weight") * F.coalesce(one, F.lit(math.nan))).alias("total")


def likelihoods(rows: DataFrame, family, vectors: list[dict[str, float]],
                summed: Column | None = None) -> list[float]:
    """Total log-likelihood of the weighted rows at each parameter vector, in one job.

    ``summed`` is the family's aggregate column, for callers that come here often.
    """
    # One SQL text instead of a column object per number.
    candidates = ", ".join(
        f"named_struct('_k', {k}, '_constant', {family.constant(**v)!r}D, "
        + ", ".join(f"'_{n}', {float(x)!r}D" for n, x in v.items()) + ")"
        for k, v in enumerate(vectors))
    sums = (rows.select(*family.inputs, "weight", F.expr(f"inline(array({candidates}))"))
            .groupBy("_k").agg(summed_likelihood(family) if summed is None else summed)
            .collect())
    totals = [math.nan] * len(vectors)
    for row in sums:
        totals[row["_k"]] = row["total"]
    return totals


@dataclass(frozen=True)
class Slopes:
    """A function's value, gradient and Hessian at a point."""

    value: float
    gradient: np.ndarray
    hessian: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray, variables: int) -> Slopes:
        """From the value, the gradient and the pairs of the Hessian, one after the other."""
        hessian = np.zeros((variables, variables))
        for (i, j), value in zip(pairs(variables), sums[1 + variables:]):
            hessian[i, j] = hessian[j, i] = value
        return cls(float(sums[0]), np.asarray(sums[1:1 + variables], float), hessian)

    def finite(self) -> bool:
        return bool(math.isfinite(self.value) and np.isfinite(self.gradient).all() and np.isfinite(self.hessian).all())


class Likelihood:
    """The summed log-likelihood of weighted rows, with its derivatives by the parameters.

    The terms that depend on the frequency alone are summed over the distinct frequencies, of which
    there are no more than periods; a pass over the rows sums the rest, value and all derivatives in one aggregate.
    """

    def __init__(self, rows: DataFrame, family):
        self.rows, self.family = rows, family
        self.names = [f.name for f in fields(family)]
        extra = family.frequency_sums() if hasattr(family, "frequency_sums") else {}
        counts = (rows.groupBy("frequency").agg(F.sum("weight").alias("weight"),
                                                *[c.alias(n) for n, c in extra.items()]).collect())
        self._frequency = np.array([r["frequency"] for r in counts], float)
        self._weight = np.array([r["weight"] for r in counts], float)
        self._extra = {n: math.fsum(r[n] for r in counts) for n in extra}
        self._native = hasattr(family, "row_derivatives")
        if self._native:
            self._steps, self._derivatives = family.row_derivatives({n: F.col(f"_{n}") for n in self.names},
                                                                    *[F.col(c) for c in family.inputs])
            # An undefined logarithm is NULL, which a sum would skip; NaN spoils it as it should.
            self._sums = [F.sum(F.col("weight") * F.coalesce(c, F.lit(math.nan))).alias("_".join(("sum", *place)))
                          for place, c in self._derivatives.items()]
        #: All customers, and their purchases.
        self.total = int(self._weight.sum())
        self.purchases = float(self._frequency @ self._weight)

    def slopes(self, points: list[np.ndarray]) -> list[Slopes]:
        """Value, gradient and Hessian at each point, in one pass over the rows."""
        rows = self._summed_natively(points) if self._native else self._summed_in_numpy(points)
        found = []
        for point, rest in zip(points, rows, strict=True):
            p = dict(zip(self.names, variables(point), strict=True))
            sums = rest + self.family.by_frequency(p, self._frequency).total(self._weight)
            if self._extra:
                sums = sums + self.family.by_sums(p, **self._extra).total(np.ones(1))
            found.append(Slopes.of(sums, len(point)))
        return found

    def _places(self) -> list[tuple]:
        return [(), *[(n,) for n in self.names],
                *[(self.names[i], self.names[j]) for i, j in pairs(len(self.names))]]

    def _summed_natively(self, points: list[np.ndarray]) -> list[np.ndarray]:
        # Parameters are data of one literal, so the code that Spark generates is the same for all points.
        candidates = ", ".join(
            f"named_struct('_k', {k}, " + ", ".join(f"'_{n}', {float(v)!r}D" for n, v in zip(self.names, point)) + ")"
            for k, point in enumerate(points))
        rows = self.rows.select(*self.family.inputs, "weight", F.expr(f"inline(array({candidates}))"))
        for step in self._steps:
            rows = rows.withColumns(step)
        found = rows.groupBy("_k").agg(*self._sums).collect()
        out = [np.full(len(self._places()), math.nan) for _ in points]
        for row in found:
            own = dict(zip(self._derivatives, row[1:]))
            out[row["_k"]] = np.array([own.get(p, 0.0) for p in self._places()])
        return out

    def _summed_in_numpy(self, points: list[np.ndarray]) -> list[np.ndarray]:
        family, names, size = self.family, self.names, len(self._places())

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(points), size))
            for batch in batches:
                *inputs, weight = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
                with np.errstate(all="ignore"):
                    for k, point in enumerate(points):
                        total[k] += family.row_total(dict(zip(names, variables(point))), *inputs, weight)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(points)), pa.int32()), *map(pa.array, total.T)],
                ["_k", *[f"s{i}" for i in range(size)]])

        columns = ", ".join(f"s{i} double" for i in range(size))
        found = (self.rows.select(*family.inputs, "weight").mapInArrow(sums, f"_k int, {columns}")
                 .groupBy("_k").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(size)]).collect())
        out = {row["_k"]: np.array(row[1:], float) for row in found}
        return [out[k] for k in range(len(points))]


def fit(family, rfm: DataFrame, penalizer: float = 0.0, time_scale: float | None = 10.0) -> Fit:
    """Fit a model family to purchase histories.

    Maximises the mean log-likelihood less ``penalizer`` times the sum of squared
    parameters.  With ``time_scale`` times are scaled so that the oldest customer's
    age has that value, and rate parameters are scaled back afterwards.  No parameter goes below 1e-8 (before that):
    customers who never leave would send some of them to zero.
    """
    rows = sufficient_rows(rfm, family).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        oldest = rows.agg(F.max("T")).first()[0] if family.times else None
        scale = time_scale / oldest if time_scale and oldest else 1.0
        likelihood = Likelihood(rows.withColumns({c: F.col(c) * scale for c in family.times}), family)
        total, names = likelihood.total, likelihood.names
        if not total:
            raise ValueError("no customers to fit the model to")

        def objective(points: list[np.ndarray]) -> list[Slopes]:
            """By the logarithms of the parameters."""
            found = []
            for point, slopes in zip(points, likelihood.slopes([np.exp(p) for p in points]), strict=True):
                p, squares = np.exp(point), penalizer * np.exp(2.0 * point)
                gradient = -slopes.gradient * p / total
                hessian = np.diag(gradient + 4.0 * squares) - slopes.hessian * np.outer(p, p) / total
                found.append(Slopes(squares.sum() - slopes.value / total, gradient + 2.0 * squares, hessian))
            return found

        theta, best, steps, converged = _newton(objective, np.zeros(len(names)))
        params = dict(zip(names, np.exp(theta).tolist(), strict=True))
        # Scaling the times multiplies a density by the scale for each purchase.
        log_likelihood = (total * (penalizer * np.exp(2.0 * theta).sum() - best)
                          + (likelihood.purchases * math.log(scale) if family.times else 0.0))
        for name in family.rates:
            params[name] /= scale
        model = family(**params)
        if not math.isfinite(log_likelihood):
            raise ArithmeticError(f"the likelihood is not finite at {model}")
        return Fit(model, total, float(log_likelihood), steps, converged)
    finally:
        rows.unpersist()


def _newton(objective, theta: np.ndarray) -> tuple[np.ndarray, float, int, bool]:
    """Damped Newton search above the floor: the place, its value, the steps and whether the slope vanished.

    A step costs one pass: value and derivatives at the full step, and where small parameters go down, also with
    these at the floor.  Only where neither is better, shorter steps are tried, together in one more pass.
    """
    here = objective([theta])[0]
    for step in range(1, _MAX_STEPS + 1):
        if not here.finite():
            return theta, here.value, step, False
        size = max(1.0, abs(here.value))
        free = (theta > _FLOOR) | (here.gradient < 0)
        gradient = np.where(free, here.gradient, 0.0)
        hessian = np.where(np.outer(free, free), here.hessian, np.diag(~free))
        curvature, axes = np.linalg.eigh(hessian)
        # Away from the optimum the surface may bend the wrong way: flip and bound it.
        bent = np.maximum(np.abs(curvature), _FLATTEST)
        move = -axes @ np.clip((axes.T @ gradient) / bent, -2.0, 2.0)
        level = bool(np.abs(gradient).max() <= _LEVEL * size)
        gain = -gradient @ move
        if level and curvature.min() > 0 and gain < _TOLERANCE * size:
            # The error left after a Newton step goes with the square of the step: below rounding now.
            return np.maximum(theta + move, _FLOOR), here.value - gain / 2.0, step, True
        full = np.maximum(theta + move, _FLOOR)
        sinking = (theta < -1.0) & (move < -0.3) & (full > _FLOOR)
        points = [full] + ([np.where(sinking, _FLOOR, full)] if sinking.any() else [])
        best, there = _least(objective, points)
        # Below rounding a step counts as no worse.
        if not there.value < here.value + 1e-13 * size:
            points = [np.maximum(theta + s * move, _FLOOR) for s in _SHORTER]
            best, there = _least(objective, points)
            if not there.value < here.value:
                return theta, here.value, step, level
        theta, here = points[best], there
    return theta, here.value, _MAX_STEPS, False


def _least(objective, points: list[np.ndarray]) -> tuple[int, Slopes]:
    """The best of some points: its number and slopes there."""
    found = objective(points)
    best = int(np.argmin([f.value if f.finite() else math.inf for f in found]))
    if not found[best].finite():
        return best, Slopes(math.inf, found[best].gradient, found[best].hessian)
    return best, found[best]


def fit_bgnbd(rfm: DataFrame, penalizer: float = 0.0, time_scale: float | None = 10.0) -> Fit:
    return fit(BgNbd, rfm, penalizer, time_scale)


def fit_pareto_nbd(rfm: DataFrame, penalizer: float = 0.0, time_scale: float | None = 10.0) -> Fit:
    return fit(ParetoNbd, rfm, penalizer, time_scale)


def fit_gamma_gamma(rfm: DataFrame, penalizer: float = 0.0) -> Fit:
    return fit(GammaGamma, rfm, penalizer, None)
