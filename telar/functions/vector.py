"""Vectors as arrays: exact arithmetic in the JVM, guarded for zero, NaN and unequal lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    """Sum of products; null for unequal lengths."""
    return F.when(F.size(a) == F.size(b), F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))


def dot_truncated(a: Column, b: Column) -> Column:
    """Of the common length of both."""
    n = F.least(F.size(a), F.size(b))
    return dot(F.slice(a, 1, n), F.slice(b, 1, n))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null for a zero vector, NaN or unequal lengths, so no threshold lets it pass."""
    s = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.when(~F.isnan(s), s)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - cosine_similarity(a, b)


def l2_normalize(v: Column) -> Column:
    """Unit length; a zero vector stays. The length is bound once a vector: inside the function of its elements it would be computed for each."""
    bound = F.array(F.struct(_doubles(v).alias("v"), norm(v).alias("n")))
    return F.transform(bound, lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x / s["n"])).otherwise(s["v"]))[0]


def fit_dimension(v: Column, n: int) -> Column:
    """The first n values; null if there are fewer."""
    return F.when(F.size(v) >= n, F.slice(v, 1, n))


def to_literal(v: Column, digits: int = 8) -> Column:
    """Text form ``[0.10000000,...]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: F.format_string(f"%.{digits}f", x.cast("double"))), ","), F.lit("]"))


def from_literal(c: Column) -> Column:
    """Parse ``[..]`` or ``{..}``; null if a value is no number."""
    v = F.transform(F.split(F.regexp_replace(c, r"[\[\]{}\s]", ""), ","), lambda x: x.try_cast("double"))
    return F.when(~F.exists(v, lambda x: x.isNull()), v)
