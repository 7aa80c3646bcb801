"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """``name`` as one back-quoted identifier (names here hold ``-``, spaces and dots)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def interpolate(low: Column, high: Column, fraction: Column) -> Column:
    """The value ``fraction`` of the way from ``low`` to ``high``."""
    between = low * (1 - fraction) + high * fraction
    return F.when((fraction == 0) | (low == high), low).otherwise(between)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", also: Column | None = None
) -> DataFrame:
    """Equi-join under which a null key meets a null key, as in GROUP BY.

    ``also`` is a further condition over the other columns, whose names must differ
    between the sides. The keys come from ``left``.
    """
    theirs = {k: f"_right_{k}" for k in keys}
    on = reduce(lambda a, b: a & b, (col(k).eqNullSafe(col(t)) for k, t in theirs.items()), F.lit(True))
    if also is not None:
        on = on & also
    return left.join(right.withColumnsRenamed(theirs), on, how).drop(*theirs.values())
