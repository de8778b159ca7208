"""Vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPS = 1e-10  # keeps a zero vector finite


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column | str) -> Column:
    """``v`` divided by its length, as doubles."""
    v = _col(v)
    # as the element of an array the length is worked out once, not for every place
    length = F.array(norm(v) + F.lit(_EPS))
    return F.get(F.transform(length, lambda n: F.transform(v, lambda x: x.cast("double") / n)), F.lit(0))


def has_dim(v: Column | str, dim: int) -> Column:
    """True when the vector has the expected width; null vectors do not."""
    return F.coalesce(F.size(_col(v)) == dim, F.lit(False))
