"""K-means over entity points: scaling, choice of k by silhouette, assignment, profiles."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from metricspark.functions.columns import col
from metricspark.session import ensure_checkpoint_dir

# The seed and the upper bound of the published k sweep.
SEED = 30
MAX_K = 30

# Centers are looked up with a broadcast join up to this many bytes; a model with
# more leaves the choice of join to the optimizer.
BROADCAST_CENTER_BYTES = 8 << 20
# Clusters of similar norm that a row is compared with at a time when the silhouette is taken.
CLUSTER_CHUNK = 500


# --- features -----------------------------------------------------------------


def assemble_features(
    df: DataFrame, features: Sequence[str], *, output: str = "features_raw", handle_invalid: str = "error"
) -> DataFrame:
    """Collect numeric columns in a vector; a null or NaN is an error, or its row is skipped."""
    return VectorAssembler(
        inputCols=list(features), outputCol=output, handleInvalid=handle_invalid
    ).transform(df)


def scale_features(df: DataFrame, *, vector: str = "features_raw", output: str = "features") -> DataFrame:
    """Divide each feature by its sample deviation over all rows, without centering."""
    scaler = StandardScaler(inputCol=vector, outputCol=output, withStd=True, withMean=False)
    return scaler.fit(df).transform(df)


# --- points ready for fitting ---------------------------------------------------


@dataclass(frozen=True)
class PreparedPoints:
    """Distinct points with their number of repeats, scaled, kept for many passes.

    ``frame`` is ``(_x0.., _w, features)``: scaled features, weight, vector.
    ``factors`` are the reciprocal sample deviations over all original rows, 0 for a
    constant feature, and ``means`` the means over them.
    """

    frame: DataFrame
    features: tuple[str, ...]
    factors: tuple[float, ...]
    means: tuple[float, ...]
    n_distinct: int
    n_rows: int
    partitions: int

    @property
    def columns(self) -> list[str]:
        return [f"_x{i}" for i in range(len(self.features))]


@contextmanager
def prepare_points(
    df: DataFrame,
    features: Sequence[str],
    *,
    order: str = "input",
    handle_invalid: str = "error",
    rows_per_partition: int = 250_000,
) -> Iterator[PreparedPoints]:
    """Reduce ``df`` to its distinct points and keep them for the fits within the block.

    K-means and the silhouette depend only on how often each point occurs, so
    every pass after this one runs over distinct points with weights: however many
    rows share a value, they cost one row. The points are checkpointed, so that a
    lost executor does not bring back the scan, and stored for the passes.

    What k-means finds depends on the order and partitioning of its input. Both
    are fixed here: as many partitions as the number of points asks for, filled by
    hash, and sorted by first appearance in ``df`` (``order="input"``) or by value
    (``order="value"``, the same for every layout of ``df``).
    """
    if order not in ("input", "value"):
        raise ValueError(f"unknown order {order!r}")
    raw = [f"_r{i}" for i in range(len(features))]
    points = df.select(*(col(f).cast("double").alias(r) for f, r in zip(features, raw, strict=True)))
    if handle_invalid == "skip":
        points = points.where(reduce(lambda a, b: a & b, (F.col(r).isNotNull() & ~F.isnan(r) for r in raw)))
    elif handle_invalid != "error":
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    if order == "input":
        points = points.withColumn("_seen", F.monotonically_increasing_id())
        keep = [F.min("_seen").alias("_seen")]
    else:
        keep = []
    points = points.groupBy(*raw).agg(F.count(F.lit(1)).alias("_w"), *keep)

    ensure_checkpoint_dir(df.sparkSession)
    points = points.checkpoint()

    n_distinct, n_rows, factors, means = _scaling(points, raw, features)
    partitions = max(1, math.ceil(n_distinct / rows_per_partition))
    names = [f"_x{i}" for i in range(len(features))]
    sort_by = ["_seen"] if order == "input" else raw
    fixed = (
        points.repartition(partitions, *raw)
        .sortWithinPartitions(*sort_by)
        .select(
            *((F.col(r) * F.lit(f)).alias(x) for r, f, x in zip(raw, factors, names, strict=True)),
            F.col("_w").cast("double").alias("_w"),
        )
    )
    ready = assemble_features(fixed, names, output="features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield PreparedPoints(ready, tuple(features), tuple(factors), tuple(means), n_distinct, n_rows, partitions)
    finally:
        ready.unpersist()


def _scaling(points: DataFrame, raw: Sequence[str], features: Sequence[str]):
    """Counts, and per feature the factor that brings the rows to unit sample deviation, and the mean."""
    weight = F.col("_w")
    total = F.sum(weight)
    first = points.agg(
        F.count(F.lit(1)).alias("distinct"),
        total.alias("rows"),
        *(F.count(F.when(F.col(r).isNull() | F.isnan(r), 1)).alias(f"bad_{r}") for r in raw),
        *((F.sum(weight * F.col(r)) / F.sum(F.when(F.col(r).isNotNull(), weight))).alias(f"mean_{r}") for r in raw),
    ).first()
    bad = [f for f, r in zip(features, raw, strict=True) if first[f"bad_{r}"]]
    if bad:
        raise ValueError(f"null or NaN in features {bad}; handle_invalid='skip' leaves such rows out")
    n_rows = first["rows"] or 0
    means = [first[f"mean_{r}"] or 0.0 for r in raw]
    if n_rows < 2:
        return first["distinct"], n_rows, [0.0] * len(raw), means
    squares = points.agg(
        *(F.sum(weight * F.pow(F.col(r) - F.lit(first[f"mean_{r}"]), 2.0)).alias(r) for r in raw)
    ).first()
    deviations = [math.sqrt(squares[r] / (n_rows - 1)) for r in raw]
    return first["distinct"], n_rows, [1.0 / d if d else 0.0 for d in deviations], means


# --- silhouette ----------------------------------------------------------------


def silhouette(
    df: DataFrame,
    features: Sequence[str],
    cluster: str,
    *,
    labelling: str | None = None,
    weight: str | None = None,
    chunk: int = CLUSTER_CHUNK,
) -> DataFrame:
    """Mean silhouette with squared Euclidean distance: ``(<labelling>, n_clusters, silhouette)``.

    ``labelling`` tells apart several clusterings of the same points, all scored in
    the same passes. A row with weight w stands for w equal rows; a row without
    a cluster does not count. One cluster alone scores null.

    The mean distance from a row to a cluster follows from the cluster's count, sum
    and sum of squares, so one pass makes these sums, which are checkpointed. It is never
    less than the square of the gap between the row's norm and that of the cluster's
    center. So clusters are put in chunks of at least ``chunk`` by the norm of their
    centers, and a row looks for its nearest other cluster in the chunk of its own one
    first; only chunks whose norms come nearer to the row's than the distance found
    are looked at then. They are few where norms tell clusters apart, and all in the
    worst case, for the same result.
    """
    rows = df.where(col(cluster).isNotNull()).select(
        (col(labelling) if labelling else F.lit(0)).alias("_l"),
        col(cluster).alias("_c"),
        (col(weight) if weight else F.lit(1.0)).alias("_w"),
        *(col(f).alias(f"_x{i}") for i, f in enumerate(features)),
    )
    names = [f"_x{i}" for i in range(len(features))]
    x = [F.col(c) for c in names]
    w = F.col("_w")
    norm = _total(v * v for v in x)
    sums = rows.groupBy("_l", "_c").agg(
        F.sum(w).cast("double").alias("n"), F.sum(w * norm).alias("norm"), *(F.sum(w * v).alias(f"s{i}") for i, v in enumerate(x))
    )
    entry = F.struct(
        F.col("_c").alias("id"),
        F.col("n"),
        (F.col("norm") / F.col("n")).alias("norm"),
        F.array(*(F.col(f"s{i}") / F.col("n") for i in range(len(x)))).alias("mean"),
    )
    measured = sums.select("_l", "_c", entry.alias("_mine")).withColumn(
        "_size", F.sqrt(_total(F.pow(F.col("_mine.mean")[i], 2.0) for i in range(len(x))))
    )
    label = Window.partitionBy("_l")
    ensure_checkpoint_dir(df.sparkSession)
    clusters = (
        measured.withColumn("_k", F.count(F.lit(1)).over(label).cast("int"))
        .withColumn("_place", F.row_number().over(label.orderBy("_size", "_c")) - 1)
        .withColumn("_chunk", F.floor(F.col("_place") / F.greatest(F.lit(chunk), F.ceil(F.sqrt("_k")))).cast("int"))
        .drop("_place")
        .checkpoint()
    )
    found = clusters.agg(F.count(F.lit(1)), F.coalesce(F.max("_chunk"), F.lit(0))).first()
    small = found[0] * 8 * (len(x) + 6) <= BROADCAST_CENTER_BYTES
    # without labels the label is one constant and no key to join by
    by = ["_l"] if labelling else []

    def meet(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        right = right.select(F.col(key).alias("_key"), F.col("_l").alias("_t"), *(c for c in right.columns if c not in (key, "_l")))
        on = reduce(lambda a, b: a & b, (F.col("_l").eqNullSafe(F.col("_t")) for _ in by), F.col(key) == F.col("_key"))
        return left.join(F.broadcast(right) if small else right, on).drop("_key", "_t")

    def distance(c: Column) -> Column:
        cross = _total(v * c["mean"][i] for i, v in enumerate(x))
        # Rounding may leave a tiny negative where the distance is zero.
        return F.greatest(norm + c["norm"] - cross * 2, F.lit(0.0))

    def nearest(entries: Column) -> Column:
        return F.array_min(F.transform(F.filter(entries, lambda c: c["id"] != F.col("_c")), distance))

    def score(frame: DataFrame) -> DataFrame:
        n, own, other = F.col("_mine.n"), F.col("_own"), F.col("_other")
        # The mean over the rest of the own cluster leaves out the row itself.
        rest = frame.withColumn("_own", distance(F.col("_mine")) * F.try_divide(n, n - 1))
        value = F.when((n == 1) | (own == other), 0.0).otherwise(F.try_divide(other - own, F.greatest(own, other)))
        return rest.select("_l", "_w", "_k", value.alias("_score"))

    chunks = clusters.groupBy("_l", "_chunk").agg(
        F.collect_list("_mine").alias("_clusters"), F.min("_size").alias("_low"), F.max("_size").alias("_high")
    )
    placed = meet(rows, clusters.select("_l", "_c", "_mine", "_k", "_chunk"), "_c")
    if not found[1]:
        scored = score(meet(placed, chunks.select("_l", "_chunk", "_clusters"), "_chunk").withColumn("_other", nearest(F.col("_clusters"))))
    else:
        whole = label.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        edges = chunks.withColumns({"_lows": F.collect_list("_low").over(whole), "_highs": F.collect_list("_high").over(whole)})
        # kept, as all that follows reads the distance found several times
        home = (
            meet(placed, edges.drop("_low", "_high"), "_chunk")
            .withColumn("_other", nearest(F.col("_clusters")))
            # a little more than the distance found, for what rounding may take from it
            .withColumn("_reach", F.sqrt(F.col("_other") + (norm + F.col("_other")) * 1e-12))
            .withColumn("_from", F.when(F.col("_other").isNull(), 0).otherwise(F.size(F.filter("_highs", lambda v: v < F.sqrt(norm) - F.col("_reach")))))
            .withColumn("_to", F.when(F.col("_other").isNull(), F.size("_lows")).otherwise(F.size(F.filter("_lows", lambda v: v <= F.sqrt(norm) + F.col("_reach")))))
            .drop("_clusters", "_lows", "_highs", "_reach")
            .checkpoint()
        )
        # a sequence runs downwards where its end comes first
        all_within = F.when(F.col("_to") > F.col("_from"), F.sequence("_from", F.col("_to") - 1)).otherwise(F.array().cast("array<int>"))
        further = F.array_remove(all_within, F.col("_chunk"))
        closed = home.where(F.size(further) == 0)
        open_rows = home.select("*", F.posexplode(further).alias("_at", "_next")).drop("_from", "_to", "_chunk")
        met = meet(open_rows, chunks.select("_l", F.col("_chunk").alias("_next"), "_clusters"), "_next")
        # equal rows look at the same chunks, so they may be folded into one
        folded = met.groupBy("_l", "_c", "_mine", "_k", *names).agg(
            F.sum(F.when(F.col("_at") == 0, w)).alias("_w"), F.least(F.min("_other"), F.min(nearest(F.col("_clusters")))).alias("_other")
        )
        scored = score(closed).unionByName(score(folded))
    result = scored.groupBy(F.col("_l").alias(labelling or "_l")).agg(
        F.max("_k").alias("n_clusters"),
        (F.sum(w * F.when(F.col("_k") > 1, F.col("_score"))) / F.sum(w)).alias("silhouette"),
    )
    return result if labelling else result.drop("_l")


def _total(terms: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


# --- fitting -------------------------------------------------------------------


@dataclass(frozen=True)
class ClusterModel:
    """A fitted model together with the scaling it was fitted under."""

    kmeans: KMeansModel
    features: tuple[str, ...]
    factors: tuple[float, ...]
    means: tuple[float, ...]

    @property
    def n_clusters(self) -> int:
        return len(self.kmeans.clusterCenters())

    def centers(self, spark: SparkSession) -> DataFrame:
        """One row per center, in the original units: ``(cluster_id, center_<feature>..)``.

        A constant feature has no scale to undo; its center is its one value.
        """
        schema = T.StructType(
            [T.StructField("cluster_id", T.IntegerType())]
            + [T.StructField(f"center_{f}", T.DoubleType()) for f in self.features]
        )
        rows = [
            (i, *(float(v / f) if f else m for v, f, m in zip(center, self.factors, self.means, strict=True)))
            for i, center in enumerate(self.kmeans.clusterCenters())
        ]
        return spark.createDataFrame(rows, schema)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``cluster_id``, the nearest center by the scaled features."""
        scaled = {f"_x{i}": col(f).cast("double") * F.lit(s) for i, (f, s) in enumerate(self._scales())}
        kept = [col(c) for c in df.columns]
        vectors = assemble_features(df.withColumns(scaled), list(scaled), output=self.kmeans.getFeaturesCol())
        return self.kmeans.transform(vectors).select(
            *kept, F.col(self.kmeans.getPredictionCol()).alias("cluster_id")
        )

    def _scales(self) -> list[tuple[str, float]]:
        return list(zip(self.features, self.factors, strict=True))

    def assign(self, df: DataFrame, *, digits: int = 2) -> DataFrame:
        """Add ``cluster_id``, the rounded center and the distance to it."""
        return distance_to_center(
            self.predict(df), self.centers(df.sparkSession), self.features, digits=digits, n_centers=self.n_clusters
        )


def distance_to_center(
    assigned: DataFrame,
    centers: DataFrame,
    features: Sequence[str],
    *,
    digits: int = 2,
    n_centers: int | None = None,
) -> DataFrame:
    """Look up each row's center and add ``center_<feature>..`` and ``distance_from_center``.

    A row whose cluster has no center gets center 0. The distance is taken to the
    rounded center. The lookup is a broadcast join where the centers are known to
    take few bytes.
    """
    if n_centers is not None and n_centers * 8 * (len(features) + 1) <= BROADCAST_CENTER_BYTES:
        centers = F.broadcast(centers)
    joined = assigned.join(centers, "cluster_id", "left")
    names = [f"center_{f}" for f in features]
    located = joined.withColumns({c: F.round(F.coalesce(col(c), F.lit(0.0)), digits) for c in names})
    gaps = [col(f) - col(c) for f, c in zip(features, names, strict=True)]
    if len(gaps) == 1:
        distance = F.abs(gaps[0])
    else:
        distance = F.sqrt(reduce(lambda a, b: a + b, (g * g for g in gaps)))
    return located.select(
        *(col(c) for c in assigned.columns),
        *(col(c) for c in names),
        F.round(distance, digits).alias("distance_from_center"),
    )


def fit_kmeans(points: PreparedPoints, k: int, *, seed: int = SEED) -> ClusterModel:
    """K-means with the library's defaults, by the same solver for any number of points."""
    estimator = KMeans(featuresCol="features", weightCol="_w", k=k, seed=seed, solver="row")
    return ClusterModel(estimator.fit(points.frame), points.features, points.factors, points.means)


@dataclass(frozen=True)
class KSweep:
    """Scores of every k tried, best first chosen at the lowest k among equals."""

    scores: DataFrame
    best_k: int
    model: ClusterModel


def sweep_k(
    points: PreparedPoints,
    *,
    min_k: int = 2,
    max_k: int = MAX_K,
    seed: int = SEED,
    parallelism: int = 8,
) -> KSweep:
    """Fit k-means for each k up to the number of distinct points and score the silhouette.

    Every k starts from the library's own first centers, ``parallelism`` of them chosen
    side by side. From there all k go on together: one pass a round finds each point's
    nearest center for every k that has not settled, and one pass scores them all. The rules are
    those of the library's fit (nearest center, the first of equals; an empty cluster keeps
    its center; 20 rounds or no center moving over 1e-4), and the chosen k is fitted by it.
    Returns the scores ``(k, n_clusters, silhouette, wssse)``, the last being the
    points' squared distance to their final centers, and the model of the best k.
    """
    top = min(max_k, points.n_distinct)
    if points.n_distinct < 2:
        raise ValueError(f"clustering needs at least 2 distinct points, found {points.n_distinct}")
    if top < min_k:
        raise ValueError(f"no k between {min_k} and {top}")
    spark = points.frame.sparkSession

    def first_centers(k: int) -> np.ndarray:
        start = KMeans(featuresCol="features", weightCol="_w", k=k, seed=seed, solver="row", maxIter=0)
        return np.array(start.fit(points.frame).clusterCenters())

    ks = list(range(min_k, top + 1))
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(ks)))) as pool:
        starts = dict(zip(ks, pool.map(inheritable_thread_target(spark)(first_centers), ks), strict=True))

    # Few points make few partitions, which is right for choosing centers side by side;
    # a pass for all k is one job and spreads over all cores.
    spread = points.frame.select(*points.columns, "_w")
    if points.partitions < spark.sparkContext.defaultParallelism:
        spread = spread.repartition(spark.sparkContext.defaultParallelism)
    spread = spread.persist(StorageLevel.MEMORY_AND_DISK)
    quality = {}
    try:
        for batch in _batches(ks):
            settled = settle_centers(spread, points.columns, {k: starts[k] for k in batch})
            quality |= _scored_centers(spread, points.columns, settled)
    finally:
        spread.unpersist()

    best = max((k for k in ks if quality[k][1] is not None), key=lambda k: quality[k][1], default=None)
    if best is None:
        raise ValueError("no k gave two or more clusters")
    scores = spark.createDataFrame([(k, *quality[k]) for k in ks], "k int, n_clusters int, silhouette double, wssse double")
    return KSweep(scores, best, fit_kmeans(points, best, seed=seed))


# Rows compared with all centers at a time.
ROWS_AT_A_TIME = 2_048


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Points and weights, some rows at a time; the weight is the last column."""
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
            *x, w = (c[start : start + ROWS_AT_A_TIME] for c in columns)
            yield np.column_stack(x), w


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centers."""
    return sum((x[:, i, None] - centers[None, :, i]) ** 2 for i in range(x.shape[1]))


def _cluster_sums(frame: DataFrame, columns: Sequence[str], centers: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For every k and cluster: weight, squared distance to the center, weighted norm and sums of its points.

    One pass for all k; a task sends one row a cluster, and the driver reads as many.
    """
    names = ["weight", "cost", "norm", *(f"s{i}" for i in range(len(columns)))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(names), len(c))) for k, c in centers.items()}
        for x, w in _pieces(batches):
            norm = (x**2).sum(1)
            for k, some in centers.items():
                gaps = _squared(x, some)
                nearest = gaps.argmin(1)
                values = (w, w * gaps[np.arange(len(x)), nearest], w * norm, *(w * x[:, i] for i in range(x.shape[1])))
                for total, value in zip(totals[k], values):
                    total += np.bincount(nearest, value, len(some))
        sizes = [len(c) for c in centers.values()]
        both = np.concatenate(list(totals.values()), axis=1)
        ids = [pa.array(np.repeat(list(centers), sizes).astype(np.int32)), pa.array(np.concatenate([np.arange(n) for n in sizes]).astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, both)], names=["k", "cluster", *names])

    schema = "k int, cluster int, " + ", ".join(f"{n} double" for n in names)
    summed = frame.mapInArrow(add, schema).groupBy("k", "cluster").agg(*(F.sum(n).alias(n) for n in names)).collect()
    out = {k: np.zeros((len(c), len(names))) for k, c in centers.items()}
    for row in summed:
        out[row["k"]][row["cluster"]] = row[2:]
    return out


def settle_centers(
    frame: DataFrame, columns: Sequence[str], starts: dict[int, np.ndarray], *, rounds: int = 20, tolerance: float = 1e-4
) -> dict[int, np.ndarray]:
    """Lloyd's steps for several k at once, each until its centers settle."""
    settled, moving = dict(starts), set(starts)
    for _ in range(rounds):
        if not moving:
            break
        for k, sums in _cluster_sums(frame, columns, {k: settled[k] for k in sorted(moving)}).items():
            before, filled = settled[k], sums[:, 0] > 0
            after = before.copy()
            after[filled] = sums[filled, 3:] / sums[filled, :1]
            settled[k] = after
            if (((after - before) ** 2).sum(1) <= tolerance**2).all():
                moving.discard(k)
    return settled


def _scored_centers(frame: DataFrame, columns: Sequence[str], centers: dict[int, np.ndarray]) -> dict[int, tuple]:
    """``(n_clusters, silhouette, wssse)`` for every k, in two passes."""
    known = {}
    for k, sums in _cluster_sums(frame, columns, centers).items():
        filled = sums[:, 0] > 0
        weight, means = sums[filled, 0], sums[filled, 3:] / sums[filled, :1]
        spread = np.maximum(sums[filled, 2] / weight - (means**2).sum(1), 0)
        # the clusters that hold points, and where each of the centers stands among them
        known[k] = weight, means, spread, np.cumsum(filled) - 1, sums[:, 1].sum()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(known, 0.0)
        for x, w in _pieces(batches):
            for k, (weight, means, spread, place, _) in known.items():
                if len(weight) < 2:
                    continue
                mine = place[_squared(x, centers[k]).argmin(1)]
                mean = _squared(x, means) + spread
                at, n = np.arange(len(x)), weight[mine]
                # the mean over the rest of the own cluster leaves out the row itself
                own = mean[at, mine] * n / np.maximum(n - 1, 1)
                mean[at, mine] = np.inf
                other = mean.min(1)
                alike = (n == 1) | (own == other)
                totals[k] += (w * np.where(alike, 0, (other - own) / np.where(alike, 1, np.maximum(own, other)))).sum()
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.float64())], names=["k", "score"])

    scores = dict(frame.mapInArrow(score, "k int, score double").groupBy("k").agg(F.sum("score")).collect())
    return {
        k: (len(weight), float(scores[k] / weight.sum()) if len(weight) > 1 else None, float(cost))
        for k, (weight, _, _, _, cost) in known.items()
    }


def _batches(ks: Sequence[int], clusters: int = 2_000) -> Iterator[list[int]]:
    """Split ``ks`` so that the clusters scored together stay few."""
    batch: list[int] = []
    for k in ks:
        if batch and sum(batch) + k > clusters:
            yield batch
            batch = []
        batch.append(k)
    yield batch


def cluster_profile(assigned: DataFrame, feature: str, *, cluster: str = "cluster_id", digits: int = 6) -> DataFrame:
    """Number of members and min, mean and max of ``feature`` per cluster."""
    return assigned.groupBy(col(cluster)).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(col(feature)).alias("min"),
        F.round(F.avg(col(feature)), digits).alias("mean"),
        F.max(col(feature)).alias("max"),
    )
