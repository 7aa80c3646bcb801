"""Statistics of a series by calendar period."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.functions.columns import col, rounded
from metricspark.functions.temporal import with_period

STATS = {"avg": F.avg, "min": F.min, "max": F.max}
_KEYS = ("zone", "ts")


def metrics_of(series: DataFrame) -> list[str]:
    return [c for c in series.columns if c not in _KEYS]


def period_stats(
    series: DataFrame,
    parts: Sequence[str],
    *,
    metrics: Iterable[str] | None = None,
    stats: Sequence[str] = ("avg", "min", "max"),
    by: Sequence[str] = ("zone",),
    digits: int | None = 6,
    name: str = "{metric}_{stat}",
    drop_invalid: bool = False,
) -> DataFrame:
    """``stats`` of every metric for each (``by``, ``parts``) group; averages are rounded.

    One scan and one exchange serve all zones and metrics. Each task first reduces
    its rows to one partial row per group, so a zone with most of the rows ships
    no more data than any other. Nulls do not count; a group whose time could not
    be read has null parts.
    """
    frame = with_period(series, *parts, drop_invalid=drop_invalid)
    aggregates = [
        rounded(STATS[stat](col(m)), digits if stat == "avg" else None).alias(
            name.format(metric=m, stat=stat)
        )
        for m in (metrics or metrics_of(series))
        for stat in stats
    ]
    return frame.groupBy(*by, *parts).agg(*aggregates)


def diurnal_profile(series: DataFrame, **options) -> DataFrame:
    """Mean of every metric by hour of day over the whole series: 24 rows a zone."""
    return period_stats(series, ["hour"], stats=["avg"], name="{metric}", **options)


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per metric: ``(ids..., metric, value)``.

    Use it on a profile, after the aggregate: there it multiplies 24 rows a zone,
    not the readings.
    """
    return df.unpivot([col(i) for i in ids], [col(m) for m in metrics], "metric", "value")


def distinct_points(df: DataFrame, columns: Sequence[str], *, approx: bool = False, lg_k: int = 12) -> DataFrame:
    """Number of distinct combinations of ``columns``, a null being a value of its own.

    ``approx`` is one pass without a shuffle of the values: a sketch of at most ``2**lg_k``
    bytes a task, with a relative standard error of about ``0.83 / sqrt(2**lg_k)``.
    """
    if approx:
        from metricspark.operators.states import distinct_sketches, merged_distinct

        return merged_distinct(distinct_sketches(df, columns, lg_k=lg_k))
    return (
        df.select(*(col(c) for c in columns))
        .distinct()
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )
