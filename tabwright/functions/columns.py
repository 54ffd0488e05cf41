"""Scalar building blocks, as Spark column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from math import log
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnLike) -> Column:
    """Empty text becomes null; everything else is kept."""
    return F.when(_col(c) != "", _col(c))


def to_double(c: ColumnLike) -> Column:
    """Cast to double; blank or malformed text becomes null instead of an error."""
    return _col(c).try_cast("double")


def binary_label(c: ColumnLike, positive: str) -> Column:
    """1.0 where the value equals ``positive``, 0.0 otherwise, nulls included."""
    return F.when(_col(c) == positive, F.lit(1.0)).otherwise(F.lit(0.0))


def bucket(c: ColumnLike, upper_bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first closed upper bound that holds the value.

    The last label takes what exceeds every bound, and nulls.
    """
    if not upper_bounds or len(labels) != len(upper_bounds) + 1:
        raise ValueError("bucket needs at least one bound, and one label more than bounds")
    if list(upper_bounds) != sorted(upper_bounds):
        raise ValueError("bucket bounds must ascend")
    value = _col(c)
    expr = F.when(value <= upper_bounds[0], F.lit(labels[0]))
    for bound, label in list(zip(upper_bounds, labels))[1:]:
        expr = expr.when(value <= bound, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def count_matching(columns: Sequence[ColumnLike], values: Iterable[str]) -> Column:
    """How many of ``columns`` hold one of ``values``; null counts as no match."""
    wanted = list(values)
    return reduce(add, [F.when(_col(c).isin(wanted), F.lit(1)).otherwise(F.lit(0)) for c in columns])


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike, fallback: ColumnLike) -> Column:
    """numerator / denominator where the denominator is positive, else ``fallback``."""
    return F.when(_col(denominator) > 0, _col(numerator) / _col(denominator)).otherwise(_col(fallback))


def digest(salt: str | int, *keys: ColumnLike) -> Column:
    """Lower-case hexadecimal MD5 of salt and keys: never null, the same on any layout."""
    return F.md5(F.concat_ws("|", F.lit(str(salt)), *[_col(k).cast("string") for k in keys]))


def unit_uniform(salt: str | int, *keys: ColumnLike) -> Column:
    """Repeatable uniform draw in [0, 1) from the first 32 bits of the digest."""
    return F.conv(F.substring(digest(salt, *keys), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def pick(uniform: Column, choices: Sequence) -> Column:
    """One of ``choices``, each with equal chance."""
    options = F.array(*[F.lit(c) for c in choices])
    return F.element_at(options, F.floor(uniform * F.lit(float(len(choices)))).cast("int") + 1)


def log_uniform(uniform: Column, low: float, high: float, places: int = 9) -> Column:
    """A draw whose logarithm is uniform between those of ``low`` and ``high``."""
    start, width = log(low), log(high) - log(low)
    return F.round(F.exp(F.lit(start) + uniform * F.lit(width)), places)


def weight_for(label: ColumnLike, weights: Mapping[float, float]) -> Column:
    """The sample weight of a row's class, from fitted scalars."""
    return F.when(_col(label) == 1.0, F.lit(weights[1.0])).otherwise(F.lit(weights[0.0]))
