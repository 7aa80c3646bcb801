"""Operator 3: document fingerprints from content-defined chunks.

A gear hash over the last 32 bytes is computed at every byte of a text. A chunk ends
where the hash has enough zero bits: more of them before the normal size is reached,
fewer after it, never before ``LEAST`` and always at ``MOST`` bytes. Boundaries
depend on nearby bytes only, so an insertion shifts them along and leaves the chunks
elsewhere as they were. A fingerprint is the set of the chunks' digests with their
lengths; likeness is the length of the shared chunks over that of the smaller set.

The query compares each document with an edited text that holds the beginning of the
next one. Documents are dealt into ranges of ``doc_id``, sorted in each; the first
document of a range is sent along with the range before it as well, so the texts are
shuffled once and no task holds more than its range.

Defined cases: null and empty texts have the empty fingerprint; two empty sets are
alike (1), an empty and another one are not (0); rows that share a ``doc_id`` are
ordered by text; a single document is its own next one; null ids come last; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.common import bound_batches, replace_columns

LEAST, NORMAL, MOST = 16, 48, 256
HARD_BITS, EASY_BITS = 7, 4
WINDOW = 32
# The gear table: one fixed random number for each byte value.
GEAR = np.random.default_rng(20_240_101).integers(0, 1 << 32, 256, dtype=np.uint32)

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


# ---- one text ---------------------------------------------------------------


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: sum of gear[b] << age over the last 32 bytes.

    Windows of 1, 2, 4, ... bytes are joined, five steps for the whole window.
    """
    h = GEAR.take(data)
    width = 1
    while width < WINDOW:
        joined = h.copy()
        joined[width:] += h[:-width] << np.uint32(width)
        h, width = joined, 2 * width
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where chunks end (exclusive), the last at the end of the data."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear_hashes(np.frombuffer(data, np.uint8))
    easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0)
    hard = easy[h[easy] >> np.uint32(32 - HARD_BITS) == 0]
    easy, hard = (easy + 1).tolist(), (hard + 1).tolist()
    easy.append(n + MOST)
    hard.append(n + MOST)
    ends, at, e, k = [], 0, 0, 0
    while n - at > LEAST:
        # the first hard cut from LEAST on below NORMAL, else the first easy one from there
        while hard[k] < at + LEAST:
            k += 1
        cut = hard[k]
        if cut >= at + NORMAL:
            while easy[e] < at + NORMAL:
                e += 1
            cut = min(easy[e], at + MOST)
        at = min(cut, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> np.ndarray:
    """Sorted distinct numbers: 48 bits of digest, 16 of length."""
    data = text.encode("utf-8", "surrogatepass")
    digest, start, found = xxhash.xxh3_64_intdigest, 0, set()
    for end in chunk_ends(data):
        found.add(digest(data[start:end]) & ~0xFFFF | (end - start))
        start = end
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def weight(chunks: np.ndarray) -> int:
    return int((chunks & np.uint64(0xFFFF)).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Length of shared chunks over that of the smaller set: containment, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = weight(np.intersect1d(a, b, assume_unique=True))
    return shared / min(weight(a), weight(b))


def as_string(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def edited(text: str, following: str) -> str:
    """The last third replaced by as many first code points of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


# ---- on Spark ---------------------------------------------------------------


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of every text."""

    @F.arrow_udf(T.StringType())
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([as_string(chunk_set(t)) for t in texts.to_pylist()], pa.string())

    return replace_columns(df, {out: prints(F.coalesce(F.col(text).cast("string"), F.lit("")))})


def with_next(documents: DataFrame, visit: Callable[[list[tuple]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Runs ``visit`` over (doc_id, text, next text) of all documents, by descending id.

    There are as many ranges as shuffle partitions. What comes to the driver is one
    bound and one largest id for each.
    """
    bound_batches(documents.sparkSession)
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    shares = [i / parts for i in range(1, parts)]
    known = own.select("doc_id").where(F.col("doc_id").isNotNull())
    bounds = np.array(sorted(known.approxQuantile("doc_id", shares, 1 / (8 * parts)) if shares else []))

    @F.arrow_udf(T.IntegerType())
    def range_of(ids: pa.Array) -> pa.Array:
        # range 0 holds the largest ids; nulls lie in the last
        found = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False))
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(np.where(known, found, len(bounds)).astype(np.int32))

    placed = own.withColumn("range", range_of("doc_id"))
    heads = sorted(tuple(r) for r in placed.groupBy("range").agg(F.max("doc_id")).collect())
    # each range gets the first document of the one after it; the last gets the first of all
    follow = [(heads[(i + 1) % len(heads)][1], heads[i][0]) for i in range(len(heads))]
    follow = F.broadcast(spark.createDataFrame(follow, "head long, target int"))
    guests = (
        own.join(follow, own["doc_id"].eqNullSafe(follow["head"]))
        .groupBy("target")
        .agg(F.min("text").alias("text"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("target").alias("range"), F.lit(1).alias("guest"))
    )
    rows = placed.withColumn("guest", F.lit(0)).unionByName(guests)
    dealt = rows.repartitionById(max(parts, len(bounds) + 1), "range").sortWithinPartitions(
        "range", "guest", F.col("doc_id").desc_nulls_last(), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            ready = []
            for doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "guest"))):
                if before is not None:
                    ready.append((*before, text))
                before = None if guest else (doc_id, text)
            yield from visit(ready)

    return dealt.mapInArrow(run, schema)


def _compare(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    last_text, last_set = None, None
    for start in range(0, len(rows), 1_000):
        out = []
        for doc_id, text, following in rows[start : start + 1_000]:
            own = last_set if last_text == text else chunk_set(text)
            last_text, last_set = following, chunk_set(following)
            changed = edited(text, following)
            other = chunk_set(changed)
            sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            near = likeness(own, other), likeness(own, last_set)
            out.append((doc_id, len(text), sha, as_string(own), as_string(other), *near))
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def fingerprint_result(documents: DataFrame) -> DataFrame:
    if documents.limit(1).count() == 0:
        return documents.sparkSession.createDataFrame([], RESULT)
    return with_next(documents, _compare, RESULT)
