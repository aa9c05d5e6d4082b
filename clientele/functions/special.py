"""Special functions that Spark SQL lacks.

``gammaln`` is a native column.  The two hypergeometric sums run to a tolerance,
which a column cannot do; they are numpy helpers for use inside Arrow functions
(measured 12 times faster than a higher-order ``aggregate`` of fixed length).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the asymptotic series of ln gamma.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_SHIFT = 8
_TOLERANCE = 1e-16
_MAX_TERMS = 20_000
_MAX_DEPTH = 2_000_000


def ln(value: Column | float):
    return F.log(value) if isinstance(value, Column) else math.log(value)


def gammaln(z: Column | float):
    """ln gamma of a positive number, by the asymptotic series at z + 8."""
    if not isinstance(z, Column):
        return math.lgamma(z)
    product = z
    for i in range(1, _SHIFT):
        product = product * (z + float(i))
    y = z + float(_SHIFT)
    inverse = 1.0 / (y * y)
    tail = F.lit(_STIRLING[-1])
    for coefficient in reversed(_STIRLING[:-1]):
        tail = tail * inverse + coefficient
    return ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + tail / y
            - F.log(product))


def power_difference(base: Column, exponent: float) -> Column:
    """(1 - base ** exponent) / exponent, with its limit -ln(base) at zero."""
    if abs(exponent) < 1e-9:
        return -F.log(base)
    return -F.expm1(exponent * F.log(base)) / exponent


def hyp2f1_tail(upper: float, lower: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """(2F1(upper, lower; c; z) - 1) / lower, finite at lower = 0, for 0 <= z < 1.

    Up to z = 1/2, and for large c, the defining series is summed.  From there the function g is carried on by Taylor series
    of its differential equation
    z (1-z) g'' + (c - (upper+lower+1) z) g' - upper lower g = upper,
    none longer than half the distance to 1, so that any z < 1 is reached in a few dozen of them.  Every value
    stops by its own terms and is the same whatever values it is computed with; one
    that does not reach the tolerance raises an error.
    """
    c, z = np.broadcast_arrays(np.asarray(c, float), np.asarray(z, float))
    shape = z.shape
    c, z = c.ravel(), z.ravel()
    c = np.where(np.abs(c) < 1e-12, 1e-12, c)
    # Where c is much larger than both others the series is short for every z.
    at = np.where(c - upper - lower > 10.0, z, np.minimum(z, 0.5))
    value, slope = _tail_series(upper, lower, c, at)
    todo = np.flatnonzero(at < z)
    while len(todo):
        here = at[todo]
        # A large c bends the equation's other solution strongly, which rounding errors follow.
        longest = np.minimum((1.0 - here) / 2.0, here * np.minimum(0.5, 8.0 / np.abs(c[todo])))
        step = np.minimum(z[todo] - here, longest)
        value[todo], slope[todo] = _tail_step(upper, lower, c[todo], here, step, value[todo], slope[todo])
        at[todo] = np.where(z[todo] - here <= longest, z[todo], here + step)
        todo = todo[at[todo] < z[todo]]
    return value.reshape(shape)


def _tail_series(upper: float, lower: float, c: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The function and its slope by the defining series."""
    term = upper / c * np.ones_like(z)  # of the slope; times z / n it is the function's
    value, slope, power = term * z, term.copy(), z.copy()
    open_ = np.ones(z.shape, bool)
    for n in range(1, _MAX_TERMS):
        term = term * ((upper + n) * (lower + n) / n) / (c + n)
        power_before = power.copy()
        power = power * z
        more, steeper = term * power / (n + 1.0), term * power_before
        value, slope = np.where(open_, value + more, value), np.where(open_, slope + steeper, slope)
        open_ &= ~((np.abs(steeper) <= _TOLERANCE * np.abs(slope)) & (np.abs(more) <= _TOLERANCE * np.abs(value))
                   & (n > _settled(upper, lower, c)))
        if not open_.any():
            return value, slope
    raise ArithmeticError("a hypergeometric series did not reach its tolerance")


def _settled(upper: float, lower: float, c: np.ndarray) -> np.ndarray:
    """Number of terms after which the ratio of two terms stays below about z."""
    return np.abs(upper) + np.abs(lower) + np.abs(np.minimum(c, 0.0))


def _tail_step(upper, lower, c, z, step, value, slope) -> tuple[np.ndarray, np.ndarray]:
    """The function and its slope at z + step, from those at z; step <= (1 - z) / 2 and z >= 1/2."""
    width = z * (1.0 - z)
    before, last = value, slope
    total, steep, power = value + slope * step, slope.copy(), step.copy()
    open_ = np.ones(z.shape, bool)
    small = np.zeros(z.shape, int)
    for k in range(_MAX_TERMS):
        source = upper if k == 0 else 0.0
        new = (source + (k * (k - 1.0) + (upper + lower + 1.0) * k + upper * lower) * before
               - ((1.0 - 2.0 * z) * (k + 1.0) * k + (c - (upper + lower + 1.0) * z) * (k + 1.0)) * last
               ) / (width * (k + 2.0) * (k + 1.0))
        steeper = (k + 2.0) * new * power
        power = power * step
        more = new * power
        total, steep = np.where(open_, total + more, total), np.where(open_, steep + steeper, steep)
        done = (np.abs(more) <= _TOLERANCE * np.abs(total)) & (np.abs(steeper) <= _TOLERANCE * np.abs(steep))
        small = np.where(done, small + 1, 0)
        open_ &= small < 3
        if not open_.any():
            return total, steep
        before, last = last, new
    raise ArithmeticError("a Taylor series did not reach its tolerance")


def hyp2f1_one(b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """2F1(1, b; c; z) for c > 1 and 0 <= z < 1, by Gauss' continued fraction.

    The depth of each value follows from its z: a level gains the factor
    (1 + sqrt(1-z)) / (1 - sqrt(1-z)).  Values so close to 1 that they need more than
    ``_MAX_DEPTH`` levels raise an error.
    """
    b, c, z = np.broadcast_arrays(np.asarray(b, float), np.asarray(c, float), np.asarray(z, float))
    root = np.sqrt(np.maximum(1.0 - z, 1e-300))
    gain = np.log1p(root) - np.log(np.maximum(1.0 - root, 1e-300))
    depth = np.where(np.isfinite(gain), 37.0 / gain, 0.0) + 8
    if np.max(depth, initial=0.0) > _MAX_DEPTH:
        raise ArithmeticError("a continued fraction would need too many levels")
    depth = depth.astype(int)
    c = c - 1.0
    value = c + depth
    for k in range(int(np.max(depth, initial=0)), 0, -1):
        n = k // 2
        u = (b + n) * (c + n) if k % 2 else n * (c - b + n)
        value = np.where(k <= depth, (c + (k - 1)) - u * z / value, value)
    return c / value
