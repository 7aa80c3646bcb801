"""Quantiles with linear interpolation, of small profiles and of raw readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricspark.functions.columns import col, interpolate, null_safe_join, rounded
from metricspark.session import ensure_checkpoint_dir

QUARTILES = (0.25, 0.5, 0.75)

BROADCAST_TARGETS = 100_000
# Sketches that one task merges, whatever the number of scan tasks.
SKETCH_GROUPS = 256
# Distinct readings that one task sorts for a running count.
WINDOW_VALUES = 1_000_000
SPLITS = 64


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def quantile_summary(
    profile: DataFrame,
    by: Sequence[str],
    *,
    value: str = "value",
    probs: Sequence[float] = QUARTILES,
    digits: int | None = 6,
) -> DataFrame:
    """min, ``probs`` quantiles and max of ``value`` for each group.

    For profiles, whose groups are small by construction (24 hours, 12 months):
    the aggregate holds a group's distinct values. For readings use
    ``series_quantiles``.
    """
    quantiles = F.percentile(col(value), F.array(*(F.lit(float(p)) for p in probs)))
    summary = profile.groupBy(*(col(b) for b in by)).agg(
        F.min(col(value)).alias("min"), quantiles.alias("_q"), F.max(col(value)).alias("max")
    )
    return summary.select(
        *(col(b) for b in by),
        "min",
        *(rounded(F.col("_q")[i], digits).alias(quantile_name(p)) for i, p in enumerate(probs)),
        "max",
    )


def series_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    *,
    probs: Sequence[float] = QUARTILES,
    digits: int | None = 6,
    approx: bool = False,
    accuracy: int = 10_000,
    buckets: int = 1024,
    window_values: int = WINDOW_VALUES,
) -> DataFrame:
    """Quantiles of raw readings for each group, exact whatever the group's size.

    ``approx`` is one pass with a bounded sketch per group. The exact form reads
    the two columns three times, the first two at once, and never holds a group in
    one task:

    1. ``buckets`` - 1 cut points are taken from one sketch over all readings, which
       is merged in two levels. As they split the readings evenly, a (group, bucket)
       pair holds no more than about 1/``buckets`` of all rows, apart from repeats of
       one value.
    2. Counting readings per (group, bucket) tells in which bucket each wanted
       rank lies. Partial counts keep this exchange small.
    3. Only the readings of those buckets are counted per distinct value. Buckets
       with more than ``window_values`` distinct ones are split and counted again
       until there is none; then a running count gives the value at the rank.

    The cut points only steer the work: any choice gives the same, exact result.
    """
    if not probs or not all(0 <= p <= 1 for p in probs):
        raise ValueError(f"probabilities must lie between 0 and 1: {list(probs)}")
    keys = [f"_k{i}" for i in range(len(by))]
    values = df.select(
        *(col(b).alias(k) for b, k in zip(by, keys, strict=True)), col(value).cast("double").alias("_v")
    )
    if approx:
        sketch = F.percentile_approx("_v", [float(p) for p in probs], accuracy)
        found = values.groupBy(*keys).agg(sketch.alias("_q"))
        picked = [F.col("_q")[i] for i in range(len(probs))]
    else:
        found, picked = _exact(values, keys, probs, buckets, window_values)
    return found.select(
        *(F.col(k).alias(b) for b, k in zip(by, keys, strict=True)),
        *(rounded(q, digits).alias(quantile_name(p)) for q, p in zip(picked, probs, strict=True)),
    )


def _sketch(parts: int) -> str:
    return f"kll_sketch_agg_double(_v, {min(8 * parts, 65_535)})"


def _quantiles_of(sketch: str, parts: int) -> str:
    probs = ", ".join(f"{i / parts!r}D" for i in range(1, parts))
    return f"kll_sketch_get_quantile_double({sketch}, array({probs}))"


def _cut_points(values: DataFrame, buckets: int) -> list[float]:
    known = values.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    grouped = known.withColumn("_g", F.spark_partition_id() % SKETCH_GROUPS).groupBy("_g")
    sketches = grouped.agg(F.expr(_sketch(buckets)).alias("_s"), F.count(F.lit(1)).alias("_rows"))
    merged = sketches.agg(F.expr("kll_merge_agg_double(_s)").alias("_m"), F.sum("_rows").alias("_rows"))
    row = merged.select(F.expr(f"case when _rows > 0 then {_quantiles_of('_m', buckets)} end").alias("cuts")).first()
    finite = (c for c in row["cuts"] or [] if abs(c) != float("inf"))
    return [float("-inf"), *sorted(set(finite) or {0.0}), float("inf")]


def _split(hits: DataFrame, targets: DataFrame, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cuts the buckets of ``hits`` in ``SPLITS``; keeps those in which the wanted ranks lie."""
    finite = hits.where(~F.isnan("_v") & (F.abs("_v") < float("inf")))
    cuts = finite.groupBy(*place).agg(F.expr(_sketch(SPLITS)).alias("_s")).select(
        *place, F.expr(_quantiles_of("_s", SPLITS)).alias("_cuts")
    )
    placed = null_safe_join(hits, cuts, place, "left").withColumn(
        "_sub", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_v"))), F.lit(0))
    ).drop("_cuts")
    running = Window.partitionBy(*place).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*place, "_sub").agg(F.sum("_times").alias("_rows"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
    inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_rows"))
    deeper = F.concat_ws("/", "_bucket", "_sub")
    found = null_safe_join(targets, counts, place, "left", also=inside)
    targets = found.select(
        *(F.when(F.col("_sub").isNull(), F.col(c)).otherwise(deeper).alias(c) if c == "_bucket" else F.col(c) for c in place),
        "_i",
        "_side",
        "_fraction",
        (F.col("_rank") - F.coalesce("_before", F.lit(0))).alias("_rank"),
    ).checkpoint()
    hits = placed.withColumn("_bucket", deeper).drop("_sub")
    return null_safe_join(hits, targets.select(*place).distinct(), place, "left_semi"), targets


def _exact(values: DataFrame, keys: list[str], probs: Sequence[float], buckets: int, window_values: int):
    # handleInvalid="keep" gives NaN the last bucket, which is also its sort order.
    bucketed = Bucketizer(
        splits=_cut_points(values, buckets), inputCol="_v", outputCol="_bucket", handleInvalid="keep"
    ).transform(values)
    bucketed = bucketed.withColumn("_bucket", F.col("_bucket").cast("int"))

    group = Window.partitionBy(*keys)
    running = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.count("_v").alias("_rows"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(running), F.lit(0)),
                "_n": F.sum("_rows").over(group),
            }
        )
    )

    # Each quantile lies between two neighbouring ranks (counted from 0).
    def wanted(i: int, p: float, side: str):
        position = (F.col("_n") - 1) * F.lit(float(p))
        rank = F.floor(position) if side == "low" else F.ceil(position)
        return F.struct(
            F.lit(i).alias("_i"),
            F.lit(side).alias("_side"),
            rank.alias("_rank"),
            (position - F.floor(position)).alias("_fraction"),
        )

    ranks = F.array(*(wanted(i, p, s) for i, p in enumerate(probs) for s in ("low", "high")))
    # A group without any value keeps its row, and ends with null quantiles.
    targets = (
        counts.select("*", F.inline(ranks))
        .where(
            (F.col("_n") == 0)
            | ((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_rows")))
        )
        .select(*keys, F.col("_bucket").cast("string").alias("_bucket"), "_i", "_side", "_fraction", (F.col("_rank") - F.col("_before")).alias("_rank"))
    )

    # The targets are few, but how few depends on the number of groups. They are
    # counted before they are broadcast; very many groups leave it to a plain join.
    ensure_checkpoint_dir(values.sparkSession)
    targets = targets.checkpoint()
    place = [*keys, "_bucket"]
    needed = targets.select(*place).distinct()
    if targets.count() <= BROADCAST_TARGETS:
        needed = F.broadcast(needed)
    hits = bucketed.where(F.col("_v").isNotNull()).withColumn("_bucket", F.col("_bucket").cast("string"))
    hits = null_safe_join(hits, needed, place, "left_semi")
    hits = hits.groupBy(*place, "_v").agg(F.count(F.lit(1)).alias("_times"))
    while True:
        hits = hits.checkpoint()
        most = hits.groupBy(*place).count().agg(F.max("count")).first()[0] or 0
        if most <= window_values:
            break
        hits, targets = _split(hits, targets, place)
    per_value = Window.partitionBy(*place).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.withColumn("_from", F.coalesce(F.sum("_times").over(per_value), F.lit(0)))

    at_rank = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_times"))
    found = null_safe_join(targets, hits, place, "left", also=at_rank)

    def pick(i: int, side: str):
        return F.max(F.when((F.col("_i") == i) & (F.col("_side") == side), F.col("_v")))

    def fraction(i: int):
        return F.max(F.when(F.col("_i") == i, F.col("_fraction")))

    result = found.groupBy(*keys).agg(
        *(
            interpolate(pick(i, "low"), pick(i, "high"), fraction(i)).alias(f"_q{i}")
            for i in range(len(probs))
        )
    )
    return result, [F.col(f"_q{i}") for i in range(len(probs))]
