"""Column functions on vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.text import let


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero, null or of another size."""
    size = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size)


def l2_normalised(v: Column) -> Column:
    """The vector at length 1 as floats; a zero vector stays. Its norm is computed once, not for each component."""
    return let(norm(v), lambda n: F.when(n > 0, F.transform(doubles(v), lambda x: x / n)).otherwise(doubles(v))).cast("array<float>")


def usable(v: Column) -> Column:
    """The vector, or null if it is empty."""
    return F.when(F.size(v) > 0, v)


def written(v: Column) -> Column:
    """As vector tables take it: [a,b,c]."""
    return F.concat(F.lit("["), F.array_join(v.cast("array<string>"), ","), F.lit("]"))
