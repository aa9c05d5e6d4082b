"""Values with all first and second derivatives, for many rows at once (numpy, forward mode).

A jet carries its value, its gradient and the upper triangle of its Hessian by a few variables.  Arrays have
a last axis of rows; a variable itself has one row, which broadcasts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

# Coefficients of the asymptotic series of ln gamma.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_SHIFT = 8


def pairs(variables: int) -> list[tuple[int, int]]:
    """Places of the Hessian that a jet keeps, in order."""
    return [(i, j) for i in range(variables) for j in range(i, variables)]


class Jet:
    """``value`` (rows), ``gradient`` (variables, rows) and ``hessian`` (pairs, rows)."""

    __slots__ = ("value", "gradient", "hessian")
    # Arrays leave arithmetic with a jet to the jet.
    __array_ufunc__ = None

    def __init__(self, value: np.ndarray, gradient: np.ndarray, hessian: np.ndarray):
        self.value, self.gradient, self.hessian = value, gradient, hessian

    def _upper(self) -> tuple[list[int], list[int]]:
        left, right = zip(*pairs(len(self.gradient)))
        return list(left), list(right)

    def mapped(self, value, slope, bend) -> Jet:
        """A function of this jet, by its value and its first two derivatives here."""
        i, j = self._upper()
        return Jet(value, slope * self.gradient,
                   slope * self.hessian + bend * (self.gradient[i] * self.gradient[j]))

    def __add__(self, other) -> Jet:
        if isinstance(other, Jet):
            return Jet(self.value + other.value, self.gradient + other.gradient, self.hessian + other.hessian)
        return Jet(self.value + other, self.gradient, self.hessian)

    __radd__ = __add__

    def __neg__(self) -> Jet:
        return Jet(-self.value, -self.gradient, -self.hessian)

    def __sub__(self, other) -> Jet:
        return self + (-other)

    def __rsub__(self, other) -> Jet:
        return -self + other

    def __mul__(self, other) -> Jet:
        if not isinstance(other, Jet):
            return Jet(self.value * other, self.gradient * other, self.hessian * other)
        i, j = self._upper()
        a, b = self.gradient, other.gradient
        return Jet(self.value * other.value, self.value * b + other.value * a,
                   self.value * other.hessian + other.value * self.hessian + a[i] * b[j] + a[j] * b[i])

    __rmul__ = __mul__

    def reciprocal(self) -> Jet:
        inverse = 1.0 / self.value
        return self.mapped(inverse, -inverse ** 2, 2.0 * inverse ** 3)

    def __truediv__(self, other) -> Jet:
        return self * (other.reciprocal() if isinstance(other, Jet) else 1.0 / other)

    def log(self) -> Jet:
        inverse = 1.0 / self.value
        return self.mapped(np.log(self.value), inverse, -inverse ** 2)

    def log_one_less_exp(self) -> Jet:
        """ln(1 - exp(this)) of negative values."""
        left = -np.expm1(self.value)
        odds = np.exp(self.value) / left
        return self.mapped(np.log(left), -odds, -odds / left)

    def softplus(self) -> Jet:
        """ln(1 + exp(this))."""
        size = np.exp(-np.abs(self.value))
        share = np.where(self.value > 0, 1.0, size) / (1.0 + size)
        return self.mapped(np.maximum(self.value, 0.0) + np.log1p(size), share, size / (1.0 + size) ** 2)

    def gammaln(self) -> Jet:
        return self.mapped(*gammaln_derivatives(self.value))

    def total(self, weight: np.ndarray) -> np.ndarray:
        """Weighted sums over the rows: the value, the gradient, the Hessian's pairs."""
        rows = np.broadcast_shapes(self.value.shape, weight.shape)
        return np.array([np.dot(np.broadcast_to(a, rows), weight)
                         for a in (self.value, *self.gradient, *self.hessian)])


def variables(values: Sequence[float]) -> list[Jet]:
    """The variables themselves, at these values."""
    count = len(values)
    unit = np.eye(count)
    return [Jet(np.array([float(v)]), unit[i][:, None], np.zeros((len(pairs(count)), 1)))
            for i, v in enumerate(values)]


def gammaln_derivatives(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln gamma, digamma and trigamma of positive numbers, by their asymptotic series at z + 8."""
    z = np.asarray(z, float)
    steps = z + np.arange(_SHIFT).reshape(-1, *[1] * z.ndim)
    y = z + _SHIFT
    value = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) - np.log(steps).sum(axis=0)
    slope = np.log(y) - 0.5 / y - (1.0 / steps).sum(axis=0)
    bend = 1.0 / y + 0.5 / y ** 2 + (1.0 / steps ** 2).sum(axis=0)
    for k, coefficient in enumerate(_STIRLING):
        power = 2 * k + 1
        value = value + coefficient / y ** power
        slope = slope - power * coefficient / y ** (power + 1)
        bend = bend + power * (power + 1) * coefficient / y ** (power + 2)
    return value, slope, bend


# Below this z the defining series is shorter than the continued fraction, and dividing by z would lose digits.
_SMALL = 0.1
_SERIES_TERMS = 22
_MAX_DEPTH = 2_000_000


def log_hyp2f1_one(b: Jet, c: Jet, z: Jet) -> Jet:
    """ln 2F1(1, b; c; z) for c > 1 and 0 <= z < 1.

    The derivatives by b and c are carried through Gauss' continued fraction; those by z follow from the
    function's differential equation z (1-z) F' = b z F - (c-1) (F-1).
    """
    rows = np.broadcast_shapes(b.value.shape, c.value.shape, z.value.shape)
    at = [np.broadcast_to(v.value, rows) for v in (b, c, z)]
    found = np.empty((10, *rows))
    small = at[2] < _SMALL
    for mask, method in ((small, _by_series), (~small, _by_fraction)):
        if mask.any():
            found[:, mask] = method(*(v[mask] for v in at))
    value, by, two = found[0], found[1:4] / found[0], found[4:] / found[0]
    i, j = zip(*pairs(3))
    return _composed([b, c, z], np.log(value), by, two - by[list(i)] * by[list(j)])


def _composed(inner: list[Jet], value: np.ndarray, by: np.ndarray, two: np.ndarray) -> Jet:
    """A function of several jets, by its own first and second derivatives."""
    gradient = sum(by[k] * jet.gradient for k, jet in enumerate(inner))
    hessian = sum(by[k] * jet.hessian for k, jet in enumerate(inner))
    left, right = inner[0]._upper()
    for (k, m), own in zip(pairs(len(inner)), two):
        a, b = inner[k].gradient, inner[m].gradient
        product = a[left] * b[right]
        if k != m:
            product = product + a[right] * b[left]
        hessian = hessian + own * product
    return Jet(value, gradient, hessian)


def _by_series(b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """F and its derivatives by (b, c, z, bb, bc, bz, cc, cz, zz), by the defining series."""
    out = np.zeros((10, len(z)))
    term, db, dc, dbb, dbc, dcc = np.ones_like(z), *np.zeros((5, len(z)))  # of the coefficient of z ** n
    power, last, older = np.ones_like(z), np.zeros_like(z), np.zeros_like(z)  # z to the power of n, n - 1, n - 2
    for n in range(_SERIES_TERMS):
        before, twice = n * last, n * (n - 1) * older
        out += np.array([term * power, db * power, dc * power, term * before, dbb * power, dbc * power, db * before,
                         dcc * power, dc * before, term * twice])
        up, down = b + n, 1.0 / (c + n)
        factor, fb, fc = up * down, down, -up * down ** 2
        term, db, dc, dbb, dbc, dcc = (
            term * factor, db * factor + term * fb, dc * factor + term * fc, dbb * factor + 2 * db * fb,
            dbc * factor + db * fc + dc * fb - term * down ** 2, dcc * factor + 2 * dc * fc + 2 * term * up * down ** 3)
        older, last, power = last, power, power * z
    return out


def _by_fraction(b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """As ``_by_series``, by the continued fraction; each value to a depth that follows from its z."""
    root = np.sqrt(np.maximum(1.0 - z, 1e-300))
    gain = np.log1p(root) - np.log(np.maximum(1.0 - root, 1e-300))
    depth = 45.0 / gain + 12
    if np.max(depth) > _MAX_DEPTH:
        raise ArithmeticError("a continued fraction would need too many levels")
    depth = depth.astype(int)
    order = np.argsort(-depth, kind="stable")
    b, c, z, depth = b[order], c[order] - 1.0, z[order], depth[order]
    # The level's value and its derivatives by b, c, bb, bc, cc.
    v, vb, vc, vbb, vbc, vcc = c + depth, *np.zeros((5, len(z)))
    vc = vc + 1.0
    open_ = np.searchsorted(-depth, -np.arange(depth[0], 0, -1), side="right")
    for k, m in zip(range(depth[0], 0, -1), open_):
        n = k // 2
        own = slice(0, m)
        if k % 2:
            ub, uc, ubc = c[own] + n, b[own] + n, 1.0
            u = ub * uc
        else:
            ub, uc, ubc = -float(n), float(n), 0.0
            u = n * (c[own] - b[own] + n)
        # q = z u / v
        over = 1.0 / v[own]
        q = u * over
        qb, qc = (ub - q * vb[own]) * over, (uc - q * vc[own]) * over
        qbb = -(2.0 * qb * vb[own] + q * vbb[own]) * over
        qbc = (ubc - qb * vc[own] - qc * vb[own] - q * vbc[own]) * over
        qcc = -(2.0 * qc * vc[own] + q * vcc[own]) * over
        v[own] = (c[own] + (k - 1)) - z[own] * q
        vb[own], vc[own] = -z[own] * qb, 1.0 - z[own] * qc
        vbb[own], vbc[own], vcc[own] = -z[own] * qbb, -z[own] * qbc, -z[own] * qcc
    # F = c / v (c is one less than the function's).
    over = 1.0 / v
    f = c * over
    fb, fc = -f * vb * over, (1.0 - f * vc) * over
    fbb = -(2.0 * fb * vb + f * vbb) * over
    fbc = -(fb * vc + fc * vb + f * vbc) * over
    fcc = -(2.0 * fc * vc + f * vcc) * over
    width = 1.0 / (z * (1.0 - z))
    slope = b * z - c
    fz = (slope * f + c) * width
    fzz = (b * f + (slope - (1.0 - 2.0 * z)) * fz) * width
    fbz = (z * f + slope * fb) * width
    fcz = (slope * fc - f + 1.0) * width
    out = np.empty((10, len(z)))
    out[:, order] = np.array([f, fb, fc, fz, fbb, fbc, fbz, fcc, fcz, fzz])
    return out
