"""Operator 10: mixing sources to target weights, with DataFrame functions only.

1. Sources, in code-point order with null last, get the weights 3, 1, 2, 3, 1, 2, ...
   and share 150 % of all words. A target stops at twice its source's words; the
   excess goes to the others by weight until none is above. Ordered by words per
   weight, the capped sources come first, so one pass of running sums over the
   sources finds the common level.
2. A target is so many whole epochs and a rest. Every document has a hash-random
   key, made of its id and its text; within a source, documents sorted by key are taken once more while the
   running sum of words stays within the rest. Rows that repeat id and text are one row
   with their number, however many they are. Key ranges cut a source, also one
   that holds most rows, into as many buckets as the number of rows asks for; the running sum is that
   within the bucket plus the sums of the buckets before it, in two levels.
3. Documents are taken whole. The one that crosses the budget is taken too when
   this brings the source nearer to its target.

Defined cases: a null text has size 0; a null source is a source of its own; a
source without words has the target 0; an empty table gives no rows; of rows that share
source, id and text as many are taken as the budget holds, whichever they are; null and repeated ids with
different texts have different keys; sources need no minimum of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metricspark.llm.common import WORD_PATTERN
from metricspark.session import work_path

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
# Key buckets of two levels; a hot source's rows spread over all of them. The inner ones
# are at least so many, and more where a bucket would hold more rows of a source than this.
OUTER_BUCKETS = 64
INNER_BUCKETS = 64
BUCKET_ROWS = 250_000
KEY_DIGITS = 15


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A hash-random number below 2^60, the same in every run."""
    parts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (doc_id, text))
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, target) for every source in ``sizes`` (source, size, rows).

    There is one row per source, never one per document, in these windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).cast("long").alias("source_size"))
    given = F.array(*[F.lit(w) for w in weights])
    weighed = totals.withColumn(
        "weight", F.element_at(given, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * MOST_EPOCHS
    levels = weighed.select(
        "*",
        (
            (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
    )
    # the first source whose cap is not below its share sets the level of all after it
    common = F.min(F.when(F.col("level") * F.col("weight") <= cap, F.struct(F.col("source_size") / F.col("weight"), "level"))).over(every)
    return levels.select(
        "source",
        "source_size",
        F.least(cap.cast("double"), F.coalesce(common["level"], F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def take_counts(keyed: DataFrame, targets: DataFrame, inner_buckets: int = INNER_BUCKETS) -> DataFrame:
    """Adds source_size, target, ``epochs`` (how often each of the rows is taken) and ``again`` (how many once more).

    ``keyed`` has source, size, mix_key, ``tie`` (which orders equal keys) and ``rows``,
    the number of equal rows that it stands for.
    """
    outer_width = (1 << (4 * KEY_DIGITS)) // OUTER_BUCKETS
    inner_width = -(-outer_width // inner_buckets)
    cut = keyed.withColumns(
        {
            "_outer": F.floor(F.col("mix_key") / F.lit(outer_width)).cast("int"),
            "_inner": F.floor(F.col("mix_key") % F.lit(outer_width) / F.lit(inner_width)).cast("int"),
        }
    )
    inner = cut.groupBy("source", "_outer", "_inner").agg(F.sum(F.col("size") * F.col("rows")).alias("_sum"))
    outer = inner.groupBy("source", "_outer").agg(F.sum("_sum").alias("_sum"))
    earlier = (Window.unboundedPreceding, -1)
    outer = outer.select(
        "source",
        "_outer",
        F.coalesce(
            F.sum("_sum").over(Window.partitionBy("source").orderBy("_outer").rowsBetween(*earlier)), F.lit(0)
        ).alias("_outer_start"),
    )
    inner = inner.select(
        "source",
        "_outer",
        "_inner",
        F.coalesce(
            F.sum("_sum").over(Window.partitionBy("source", "_outer").orderBy("_inner").rowsBetween(*earlier)),
            F.lit(0),
        ).alias("_inner_start"),
    )

    def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
        on = left["source"].eqNullSafe(right["source"])
        for key in keys:
            on = on & (left[key] == right[key])
        return on

    offsets = inner.join(outer, same(inner, outer, ["_outer"])).select(
        inner["source"], inner["_outer"], "_inner", (F.col("_inner_start") + F.col("_outer_start")).alias("_start")
    )
    offsets = offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).select(
        offsets["source"], "_outer", "_inner", "_start", "source_size", "target"
    )
    within = (
        Window.partitionBy("source", "_outer", "_inner")
        .orderBy("mix_key", "tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = cut.withColumn("_run", F.sum(F.col("size") * F.col("rows")).over(within))
    placed = summed.join(offsets, same(summed, offsets, ["_outer", "_inner"])).select(
        *[summed[c] for c in keyed.columns],
        "source_size",
        "target",
        (F.col("_start") + F.col("_run") - summed["size"] * summed["rows"]).alias("_before"),
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - epochs * F.col("source_size")
    # a row is taken once more when over half of it lies within the rest; of equal rows, one after the other
    half = F.col("size") / 2
    fitting = F.floor((rest - F.col("_before") - half) / F.nullif("size", F.lit(0))) + 1
    again = F.when((F.col("_before") + half > rest) | (rest <= 0), 0).otherwise(F.least(F.col("rows"), F.coalesce(fitting, F.col("rows"))))
    return placed.select(*keyed.columns, "source_size", "target", epochs.cast("int").alias("epochs"), again.cast("long").alias("again"))


def _keyed(documents: DataFrame) -> DataFrame:
    """The narrow rows that decide, rows equal in source, id and text being one."""
    narrow = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
        mix_key().alias("mix_key"),
        F.xxhash64("doc_id", "text").alias("tie"),
    )
    return narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("rows"))


def _counted(documents: DataFrame) -> DataFrame:
    """``take_counts`` of the documents; the texts are read once, to count their words."""
    spark = documents.sparkSession
    path = work_path(spark, "mix-keys")
    _keyed(documents).write.parquet(path)
    keyed = spark.read.parquet(path)
    return take_counts(keyed, source_targets(keyed), max(INNER_BUCKETS, -(-keyed.count() // (OUTER_BUCKETS * BUCKET_ROWS))))


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, mix_key, tie, source_size, target, copies of every document."""
    each = _counted(documents).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.col("epochs") + (F.col("_row") <= F.col("again")).cast("int")
    return each.select("doc_id", "source", "size", "mix_key", "tie", "source_size", "target", copies.alias("copies"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, all its columns kept.

    A source's budget is kept as its whole epochs and the last key taken once more, with the
    number of its rows that are; one row per source, so that the texts need no shuffle. Only where
    some of several equal rows are taken are those rows stored and numbered: within the task that
    read them, and by the tasks' numbers of rows, so that their number may be any.
    """
    spark = documents.sparkSession
    counted = _counted(documents)
    cuts = counted.groupBy(F.col("source").alias("_source")).agg(
        F.max("epochs").alias("_epochs"),
        F.max(F.when(F.col("again") > 0, F.struct("mix_key", "tie"))).alias("_last"),
        F.max_by(F.when(F.col("again") < F.col("rows"), F.col("again")), F.when(F.col("again") > 0, F.struct("mix_key", "tie"))).alias("_some"),
    )
    path = work_path(spark, "mix-cuts")
    cuts.write.parquet(path)
    cuts = spark.read.parquet(path)
    own = documents.withColumn("_place", F.struct(mix_key().alias("mix_key"), F.xxhash64("doc_id", "text").alias("tie")))
    joined = own.join(cuts, own["source"].cast("string").eqNullSafe(cuts["_source"]))
    at_cut = F.coalesce((F.col("_place") == F.col("_last")) & F.col("_some").isNotNull(), F.lit(False))
    whole = joined.where(~at_cut).withColumn("_copies", F.col("_epochs") + F.coalesce(F.col("_place") <= F.col("_last"), F.lit(False)).cast("int"))

    path = work_path(spark, "mix-border")
    border = joined.where(at_cut).withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    border.write.parquet(path)
    border = spark.read.schema(border.schema).parquet(path)
    tasks = border.groupBy(F.col("_source").alias("_s"), F.col("_task").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_s").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_s", "_t", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = border.withColumn("_row", F.row_number().over(Window.partitionBy("_source", "_task").orderBy("_at")))
    numbered = numbered.join(tasks, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_task") == F.col("_t")))
    part = numbered.withColumn("_copies", F.col("_epochs") + (F.col("_start") + F.col("_row") <= F.col("_some")).cast("int"))

    names = [f"`{c}`" for c in documents.columns]
    taken = whole.select(*names, "_copies").unionByName(part.select(*names, "_copies"))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies")))).where(F.col("_copy") > 0).select(*names)


def mix_result(documents: DataFrame) -> DataFrame:
    return mix(documents).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )
