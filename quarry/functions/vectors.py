"""Vector functions over ``array<float|double>`` columns, as higher-order
function expressions (no Python in the hot path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_vector(values) -> Column:
    """A literal array<double> (for a small fixed query vector)."""
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    """dot product."""
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def sq_length(a) -> Column:
    """squared length (no square root, as in the reference)."""
    return _sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double")))


def sq_distance(a, b) -> Column:
    """Sum of squared differences."""
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)))


def euclidean(a, b) -> Column:
    """L2 distance."""
    return F.sqrt(sq_distance(a, b))


def rbf(a, b, gamma: float = 10.0) -> Column:
    """exp(-gamma * squared distance)."""
    return F.exp(F.lit(-gamma) * sq_distance(a, b))


def pearson_distance(a, b) -> Column:
    """1 - r; 0 when the denominator is 0."""
    a, b = _c(a), _c(b)
    n = F.size(a).cast("double")
    s1 = _sum(F.transform(a, lambda x: x.cast("double")))
    s2 = _sum(F.transform(b, lambda x: x.cast("double")))
    q1 = sq_length(a)
    q2 = sq_length(b)
    p = dot(a, b)
    num = p - s1 * s2 / n
    den = F.sqrt(F.greatest((q1 - s1 * s1 / n) * (q2 - s2 * s2 / n), F.lit(0.0)))
    return F.when(den == 0, F.lit(0.0)).otherwise(F.lit(1.0) - num / den)


def tanimoto(a, b) -> Column:
    """1 - |both non-zero| / |either non-zero|; null on empty union."""
    pairs = F.zip_with(_c(a), _c(b), lambda x, y: F.struct((x != 0).alias("x"), (y != 0).alias("y")))
    c1 = F.size(F.filter(pairs, lambda p: p["x"]))
    c2 = F.size(F.filter(pairs, lambda p: p["y"]))
    sh = F.size(F.filter(pairs, lambda p: p["x"] & p["y"]))
    return F.lit(1.0) - F.try_divide(sh.cast("double"), (c1 + c2 - sh).cast("double"))


def gaussian(d, sigma: float = 10.0) -> Column:
    """exp(-d^2 / (2 sigma^2))."""
    return F.exp(-F.pow(_c(d), 2) / F.lit(2.0 * sigma * sigma))


def inverse_weight(d, num: float = 1.0, const: float = 0.1) -> Column:
    """num / (d + const)."""
    return F.lit(num) / (_c(d) + F.lit(const))


def subtract_weight(d, const: float = 1.0) -> Column:
    """max(const - d, 0)."""
    return F.greatest(F.lit(const) - _c(d), F.lit(0.0))


def tanh(x) -> Column:
    """the response of a node."""
    return F.tanh(x)


def dtanh(y) -> Column:
    """the derivative of tanh, from its value."""
    y = F.col(y) if isinstance(y, str) else y
    return F.lit(1.0) - y * y
