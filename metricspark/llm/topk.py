"""Operator 2: exact top-k inner products over an impact-ordered index, score at a time.

Vectors are turned into integers and indexed in blocks, one file each in the shared folder.
A block has a posting segment for every dimension and value that occur together, zeros left
out: the local numbers of the vectors that hold this value there. Segments stand by descending
impact, which is the value's magnitude, and are stored in ``LEVELS`` parts of about equally many
postings, with the length of what each vector holds in later parts. The plain
vectors are a part of their own.

A search takes a block of queries to a block of the index and reads part after part. Every
segment adds the queries' components times its value to the accumulators of its vectors.
After a part, a candidate's score lies within |query| * |its components not read yet| of its
accumulator. The k-th best lower bound, or the k-th best score of blocks before, is what a
candidate must reach. When few can still reach it, that is proof enough: no further part is read,
and just those candidates are scored again exactly, from the plain vectors. Otherwise the
last part is read and every accumulator is a score. Blocks of queries and groups of index blocks are dealt to
tasks; each task keeps k rows a query, and a rank over these gives the result.

Defined cases: vectors that are null or hold null or non-finite components take no
part, nor do rows without an id; shorter vectors count as filled up with zeros; rows
with a query's id are its own and no candidates; ties go to the smaller id, and rows
repeated in full each count as candidates but ask once; different vectors of one id
ask one after another, and their best rows are ranked together; scores must fit in 64 bits; an empty table gives no rows.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metricspark.llm.common import bound_batches
from metricspark.llm.wavelet import open_folder
from metricspark.session import work_path

SCALE = 64
K = 20
QUERY_EVERY = 20
BLOCK_VECTORS = 4_096
BLOCK_QUERIES = 1_024
LEVELS = 6  # parts of a block's postings, by descending impact
FEW = 0.02  # share of candidates that are scored again rather than reading on
LISTED = "path string, vectors long"
FOUND = "query_id long, vec_id long, score long"


def quantise(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and ``floor(scale * x)`` of those, filled with zeros."""
    lists = vectors.to_pylist()
    good, rows = [], []
    for v in lists:
        row = None if v is None or None in v else np.floor(np.array(v, np.float64) * scale)
        good.append(row is not None and bool(np.isfinite(row).all()))
        if good[-1]:
            rows.append(row)
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return np.array(good, bool), out


def pack(ids: np.ndarray, values: np.ndarray) -> bytes:
    top = int(np.abs(values).max(initial=0))
    kind = next(k for k, most in ((np.int8, 127), (np.int16, 32_767), (np.int32, 2**31 - 1), (np.int64, 2**63 - 1)) if top <= most)
    out = io.BytesIO()
    np.savez(out, ids=ids, values=values.astype(kind))
    return out.getvalue()


def unpack(path: str) -> tuple[np.ndarray, np.ndarray]:
    files, name = open_folder(path)
    with files.open_input_file(name) as file, np.load(io.BytesIO(file.read())) as held:
        return held["ids"], held["values"].astype(np.int64)


def pack_index(ids: np.ndarray, values: np.ndarray, levels: int = LEVELS) -> bytes:
    """A block of the index: ``ids``, ``values``, and for each level its segments and rest lengths."""
    size = np.abs(values)
    found = np.sort(size[size > 0])[::-1]
    # the least impact of each level; all postings of one impact share a level
    least = np.unique(found[np.linspace(0, len(found) - 1, levels + 1).astype(int)[1:]])[::-1] if len(found) else np.zeros(0, np.int64)
    parts, most = {}, None
    for i, low in enumerate(least.tolist()):
        vector, dimension = np.nonzero((size >= low) & ((size < most) if most else True))
        value = values[vector, dimension]
        order = np.lexsort((vector, value, dimension, -np.abs(value)))
        vector, dimension, value = vector[order], dimension[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], (dimension[1:] != dimension[:-1]) | (value[1:] != value[:-1]))))
        parts[f"segments{i}"] = np.column_stack([dimension[first], value[first], first, np.append(first[1:], len(vector))])
        parts[f"postings{i}"] = vector.astype(np.int32)
        later = np.where(size < low, values, 0).astype(np.float64)
        parts[f"rest{i}"] = np.sqrt((later**2).sum(1)) * (1 + 1e-9)
        most = low
    out = io.BytesIO()
    np.savez(out, ids=ids, values=values, width=np.array(values.shape[1]), levels=np.array(len(least)), **parts)
    return out.getvalue()


class Best:
    """The best k of each query so far: higher score first, then smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.vec = np.zeros(0, np.int64)
        self.floor = np.full(queries, -np.inf)  # the k-th score, once there are k

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        query, score, vec = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        first = np.searchsorted(query, query, side="left")
        rank = np.arange(len(query)) - first
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[query[last]] = score[last]
        self.query, self.score, self.vec = query[keep], score[keep], vec[keep]


def search_block(best: Best, query_ids: np.ndarray, queries: np.ndarray, block) -> tuple[int, int]:
    """Adds a block's candidates to ``best``; returns how many postings were read and how many scores taken exactly.

    ``block`` is the open file: each of its arrays is read when it is asked for.
    """
    ids, levels, width = block["ids"], int(block["levels"]), int(block["width"])
    by_dimension = np.ascontiguousarray(queries[:, :width].T)
    if width > len(by_dimension):  # queries are shorter: zeros add nothing
        by_dimension = np.pad(by_dimension, ((0, width - len(by_dimension)), (0, 0)))
    length = np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
    first_rest = block["rest0"].max(initial=0) if levels else 0
    # scores and sums on the way are at most this; most fit in 32 bits
    reach = 2.0 * float(np.abs(queries).sum(1).max(initial=0)) * float(np.abs(block["segments0"][:, 1]).max(initial=0)) if levels else 0
    kind = np.int32 if max(reach, first_rest) < 1 << 31 else np.int64
    by_dimension = by_dimension.astype(kind)
    have = np.zeros((len(ids), len(queries)), kind)
    mine = np.nonzero(ids[:, None] == query_ids[None, :])
    possible, read = None, 0
    for level in range(max(levels, 1)):
        if levels:
            postings = block[f"postings{level}"]
            for dimension, value, a, b in block[f"segments{level}"].tolist():
                have[postings[a:b]] += by_dimension[dimension] * value
            read += len(postings)
            slack = block[f"rest{level}"][:, None] * length[None, :] + np.abs(have) * 1e-12
        else:
            slack = np.zeros(have.shape)
        lower = have - slack
        lower[mine] = -np.inf
        need = best.floor
        if len(ids) > best.k:
            need = np.maximum(need, np.partition(lower, len(ids) - best.k, axis=0)[len(ids) - best.k])
        # proof: what stays below the k-th best lower bound cannot enter
        possible = have + slack >= need[None, :]
        possible[mine] = False
        if possible.mean() <= FEW:
            break
    x, q = np.nonzero(possible)
    values = np.asarray(block["values"]) if len(x) else None
    for at in range(0, len(q), 1 << 18):
        a, b = q[at : at + (1 << 18)], x[at : at + (1 << 18)]
        shared = min(width, queries.shape[1])
        exact = np.einsum("ij,ij->i", queries[a, :shared].astype(np.int64), values[b, :shared].astype(np.int64))
        keep = exact >= best.floor[a]
        best.add(a[keep], exact[keep], ids[b[keep]])
    return read, len(q)


def write_blocks(vectors: DataFrame, folder: str, size: int, packed: Callable[[np.ndarray, np.ndarray], bytes] = pack) -> DataFrame:
    """Writes (vec_id, embedding) rows in blocks; returns the list of finished files."""
    bound_batches(vectors.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        attempt, done, held_ids, held = uuid.uuid4().hex, 0, [], []

        def close() -> pa.RecordBatch:
            nonlocal done, held_ids, held
            width = max(v.shape[1] for v in held)
            values = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in held])
            name = f"{attempt}-{done:05d}.npz"
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(packed(np.concatenate(held_ids), values))
            count, done, held_ids, held = len(values), done + 1, [], []
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], names=["path", "vectors"])

        for batch in batches:
            for start in range(0, batch.num_rows, size):
                some = batch.slice(start, size)
                good, values = quantise(some.column(1))
                if good.any():
                    held_ids.append(some.column(0).to_numpy(zero_copy_only=False)[good].astype(np.int64))
                    held.append(values)
                if sum(map(len, held)) >= size:
                    yield close()
        if held:
            yield close()

    known = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    )
    known.mapInArrow(write, LISTED).write.mode("overwrite").parquet(f"{folder}/list")
    return vectors.sparkSession.read.schema(LISTED).parquet(f"{folder}/list")


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the best ``k`` rows for every query."""
    spark = vectors.sparkSession
    folder = work_path(spark, "topk")
    index = write_blocks(vectors, f"{folder}/index", BLOCK_VECTORS, pack_index)
    asked = vectors.where(F.col("vec_id") % query_every == 0).select("vec_id", "embedding").distinct()
    queries = write_blocks(asked, f"{folder}/queries", BLOCK_QUERIES)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = index.groupBy(F.pmod(F.xxhash64("path"), F.lit(tasks)).alias("group")).agg(F.collect_list("path").alias("blocks"))
    # names of files only: every block of queries goes to every group of index blocks
    dealt = queries.select(F.col("path").alias("queries"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long"))).alias("group"))
    pairs = dealt.join(groups, "group").repartition(2 * tasks, "queries", "group")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, blocks in zip(*(batch.column(c).to_pylist() for c in ("queries", "blocks"))):
                query_ids, wanted = unpack(place)
                best = Best(len(query_ids), k)
                for block in sorted(blocks):
                    files, name = open_folder(block)
                    with files.open_input_file(name) as file, np.load(file) as parts:
                        search_block(best, query_ids, wanted, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[best.query]), pa.array(best.vec), pa.array(best.score)],
                    names=["query_id", "vec_id", "score"],
                )

    found = pairs.select("queries", "blocks").mapInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
