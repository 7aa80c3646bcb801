"""Statistics kept up to date: small mergeable states by group, stored batch by batch.

A state holds what a statistic needs and no readings, so a batch of any size adds a few
rows, and a question about any range of batches, days or zones merges states and never
reads the readings again.

* ``period_states`` and ``merged_stats``: sums, counts, minima and maxima, exact.
* ``quantile_sketches`` and ``sketch_quantiles``: KLL sketches; the rank of an answer is off by at
  most about ``2.3 / k**0.9`` of the rows with 99 % confidence (1.65 % at k = 200, 0.21 % at 2,000).
* ``distinct_sketches`` and ``merged_distinct``: HLL sketches; the relative standard error
  is about ``0.83 / sqrt(2**lg_k)`` (1.3 % at lg_k = 12).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.functions.columns import col, quote, rounded
from metricspark.functions.temporal import with_period
from metricspark.operators.quantiles import QUARTILES, quantile_name
from metricspark.operators.stats import metrics_of

_STATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def period_states(series: DataFrame, parts: Sequence[str], *, metrics: Sequence[str] | None = None, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Sum, count, minimum and maximum of every metric for each (``by``, ``parts``) group."""
    aggregates = [
        make(col(m)).alias(f"{m}_{state}") for m in (metrics or metrics_of(series)) for state, make in _STATES.items()
    ]
    return with_period(series, *parts).groupBy(*map(col, by), *parts).agg(*aggregates)


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of several batches as one for each group of ``keys``, which may be fewer than before."""
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    names = [c for c in states.columns if c.rpartition("_")[2] in merge and f"{c.rpartition('_')[0]}_count" in states.columns]
    return states.groupBy(*map(col, keys)).agg(*(merge[c.rpartition("_")[2]](col(c)).alias(c) for c in names))


def merged_stats(
    states: DataFrame,
    keys: Sequence[str],
    *,
    stats: Sequence[str] = ("avg", "min", "max"),
    digits: int | None = 6,
    name: str = "{metric}_{stat}",
) -> DataFrame:
    """``period_stats`` of all readings that went into ``states``."""
    merged = merged_states(states, keys)
    metrics = [c.removesuffix("_count") for c in merged.columns if c.endswith("_count")]
    values = {
        "avg": lambda m: rounded(F.try_divide(col(f"{m}_sum"), col(f"{m}_count")), digits),
        "min": lambda m: col(f"{m}_min"),
        "max": lambda m: col(f"{m}_max"),
    }
    return merged.select(*map(col, keys), *(values[s](m).alias(name.format(metric=m, stat=s)) for m in metrics for s in stats))


def quantile_sketches(series: DataFrame, by: Sequence[str], value: str, *, k: int = 2_000) -> DataFrame:
    """(``by``, ``sketch``, ``n_rows``): one binary KLL sketch of the readings of each group; nulls and NaN do not count."""
    known = series.where(col(value).isNotNull() & ~F.isnan(col(value).cast("double")))
    sketch = F.expr(f"kll_sketch_agg_double(cast({quote(value)} as double), {int(k)})")
    return known.groupBy(*map(col, by)).agg(sketch.alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], *, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Approximate quantiles for each group of ``by``, from the stored sketches of its parts."""
    merged = sketches.groupBy(*map(col, by)).agg(F.expr("kll_merge_agg_double(sketch)").alias("_s"), F.sum("n_rows").alias("n_rows"))
    picked = (F.expr(f"kll_sketch_get_quantile_double(_s, {float(p)!r}D)").alias(quantile_name(p)) for p in probs)
    return merged.select(*map(col, by), "n_rows", *picked)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, lg_k: int = 12) -> DataFrame:
    """(``by``, ``sketch``): one binary HLL sketch of the combinations of ``columns``, a null being a value of its own."""
    # a length before each value keeps combinations apart
    parts = (F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in (col(c).cast("string") for c in columns))
    return df.groupBy(*map(col, by)).agg(F.hll_sketch_agg(F.concat(*parts), F.lit(lg_k)).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, ``n_distinct``): the approximate number of combinations in all parts of each group."""
    merged = sketches.groupBy(*map(col, by)).agg(F.hll_union_agg("sketch").alias("_s"))
    return merged.select(*map(col, by), F.coalesce(F.hll_sketch_estimate("_s"), F.lit(0)).cast("long").alias("n_distinct"))
