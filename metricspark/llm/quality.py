"""Operator 9: a factorisation machine scores the quality of documents.

Features of a text are its hashed words (tf weights of unit length) and statistics
of its structure, cut into ranges. The machine's score is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

which takes all pairwise interactions of rank ``RANK`` in time linear in the number
of features. A sigmoid makes it a probability.

Fitting: a bounded sample (``SAMPLE_ROWS``, the rows of least hash) of the labelled
training rows; its features, not its texts, go to the driver, where AdaGrad fits the
model. Scoring streams all texts through the model, which has a fixed size.

Defined cases: null and empty texts have structure features only and get a score;
texts of any length are read whole; without any label every score is 0.5; with one
kind of label only, the fit holds that kind; extra columns are kept by
``score_quality``; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.common import bounded_rows, crc_bucket, hash_sample, replace_columns

SAMPLE_ROWS = 6_000
WORD_BUCKETS = 1 << 16
RANK = 6
EPOCHS = 8
BATCH = 64
RATE = 0.08
DECAY = 1e-6
THRESHOLD = 0.7
SEED = 17

# ---- features ---------------------------------------------------------------

# Statistics of a text's structure and the edges of their ranges.
EDGES = {
    "chars": (1, 20, 50, 100, 200, 400, 1000, 3000, 10_000, 30_000),
    "word_length": (2, 3, 4, 5, 6, 7, 8, 10, 14),
    "symbols": (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2),
    "upper": (0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5),
    "digits": (0.002, 0.01, 0.03, 0.08, 0.2),
    "distinct": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "top_share": (0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5),
    "line_words": (2, 4, 8, 15, 30, 60, 120),
    "lines_distinct": (0.1, 0.3, 0.5, 0.7, 0.9, 0.99),
    "lone": (0.001, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4),
    "stops": (0.005, 0.01, 0.02, 0.04, 0.08, 0.15),
    "runs": (0.0005, 0.005, 0.02, 0.05, 0.1, 0.2),
}
NAMES = list(EDGES)
OFFSETS = np.cumsum([0, *[len(e) + 1 for e in EDGES.values()]])
FEATURES = WORD_BUCKETS + int(OFFSETS[-1])
SIZES = np.array([len(e) for e in EDGES.values()])
TABLE = np.full((len(EDGES), max(SIZES)), np.inf)
for _row, _edges in enumerate(EDGES.values()):
    TABLE[_row, : len(_edges)] = _edges

_LETTERS = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalpha() or b >= 128)
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_ALNUM = _LETTERS + _DIGITS + _SPACE
_RUN = re.compile(rb"[^A-Za-z0-9\s\x80-\xff]{2,}")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text, in time linear in its length."""
    data = text.encode(errors="replace")
    words = data.split()
    n, count = len(data), Counter(words)
    distinct = list(count)
    tf = np.fromiter(count.values(), np.float32, len(distinct))
    total = max(len(words), 1)
    symbols = len(data.translate(None, _ALNUM))
    letters = n - len(data.translate(None, _LETTERS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    runs = len(_RUN.findall(data))
    stats = np.array(
        [
            n,
            letters / total,
            symbols / max(n, 1),
            (n - len(data.translate(None, _UPPER))) / max(letters, 1),
            (n - len(data.translate(None, _DIGITS))) / max(n, 1),
            len(distinct) / total,
            float(tf.max(initial=0)) / total,
            total / max(len(lines), 1),
            len(set(lines)) / max(len(lines), 1),
            sum(count[w] for w in (b"|", b"-", b"*", b"#", b"=", b"+", b"/") if w in count) / total,
            data.count(b". ") / total,
            runs / total,
        ]
    )
    # NaN-free by construction; the place among the edges picks the feature
    ranges = (stats[:, None] >= TABLE).sum(1)
    structure = WORD_BUCKETS + OFFSETS[:-1] + ranges
    hashed = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) & (WORD_BUCKETS - 1)
    weight = np.log1p(tf)
    norm = math.sqrt(float(weight @ weight)) or 1.0
    values = np.concatenate([weight / norm, np.full(len(NAMES), 1 / math.sqrt(len(NAMES)))])
    return np.concatenate([hashed, structure]).astype(np.int32), values.astype(np.float32)


# ---- the model --------------------------------------------------------------


class FactorisationMachine:
    """Second-order machine; ``first`` and ``factors`` share one fixed-size array."""

    def __init__(self, size: int = FEATURES, rank: int = RANK, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.bias = 0.0
        self.table = np.concatenate(
            [np.zeros((size, 1)), random.normal(0, 0.05, (size, rank))], axis=1
        ).astype(np.float32)

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of texts whose features lie one behind the other from ``starts`` on."""
        rows = self.table[index] * value[:, None]
        sums = np.add.reduceat(rows, starts)
        squares = np.add.reduceat((rows[:, 1:] ** 2).sum(1), starts)
        return self.bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """AdaGrad on the logistic loss; both labels weigh the same in all."""
        random = np.random.default_rng(seed)
        positive = labels.mean()
        weight = np.where(labels > 0, 0.5 / max(positive, 1e-3), 0.5 / max(1 - positive, 1e-3))
        gathered = np.full(self.table.shape, 1e-4, np.float32)
        bias_gathered = 1e-4
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                sizes = np.array([len(rows[i][0]) for i in some])
                index = np.concatenate([rows[i][0] for i in some])
                value = np.concatenate([rows[i][1] for i in some])
                starts = np.cumsum(sizes) - sizes
                taken = self.table[index]
                scaled = taken * value[:, None]
                sums = np.add.reduceat(scaled, starts)
                squares = np.add.reduceat((scaled[:, 1:] ** 2).sum(1), starts)
                raw = self.bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)
                error = (sigmoid(raw) - labels[some]) * weight[some]
                each = np.repeat(error, sizes)[:, None] * value[:, None]
                inner = np.repeat(sums, sizes, axis=0) - scaled
                inner[:, 0] = 1
                gradient = (each * inner).astype(np.float32)
                unique, where = np.unique(index, return_inverse=True)
                step = np.zeros((len(unique), self.table.shape[1]), np.float32)
                np.add.at(step, where, gradient)
                step = step / len(some) + DECAY * self.table[unique]
                gathered[unique] += step**2
                self.table[unique] -= RATE * step / np.sqrt(gathered[unique])
                change = float(error.mean())
                bias_gathered += change**2
                self.bias -= RATE * change / math.sqrt(bias_gathered)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# ---- on Spark ---------------------------------------------------------------

_PAIR = T.StructType([T.StructField("index", T.BinaryType()), T.StructField("value", T.BinaryType())])


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sample_labelled(documents: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and ``label`` of the ``rows`` labelled documents of least hash."""
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("_label"))
    picked = hash_sample(known, F.xxhash64("doc_id", "_label"), rows, known.count() // 2)
    # at most ``rows`` rows of two numbers: a proven bound; the join may have more, where ids repeat
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def fit_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Fits on labels as given; callers leave held-out rows out of ``labels``."""

    @F.arrow_udf(_PAIR)
    def featurize(texts: pa.Array) -> pa.Array:
        pairs = [features(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([a.tobytes() for a, _ in pairs], pa.binary()), pa.array([b.tobytes() for _, b in pairs], pa.binary())],
            names=["index", "value"],
        )

    sample = sample_labelled(documents, labels, label, rows)
    found = sample.select("doc_id", "_label", F.xxhash64("text").alias("_hash"), featurize(_text("text")).alias("f"))
    got = bounded_rows(found, ["doc_id", "_label", "_hash"], rows).collect()
    got.sort(key=lambda r: (r["doc_id"], r["_label"], r["_hash"]))
    model = FactorisationMachine()
    if got:
        pairs = [(np.frombuffer(r["f"]["index"], np.int32), np.frombuffer(r["f"]["value"], np.float32)) for r in got]
        model.fit(pairs, np.array([float(r["_label"]) for r in got]))
    else:
        model.table[:] = 0
    return model


def score_quality(documents: DataFrame, model: FactorisationMachine, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the probability of label 1. The model is a broadcast of fixed size."""
    shared = documents.sparkSession.sparkContext.broadcast((model.bias, model.table))

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        machine = FactorisationMachine.__new__(FactorisationMachine)
        machine.bias, machine.table = shared.value
        scores = []
        for start in range(0, len(texts), 256):
            pairs = [features(t) for t in texts.slice(start, 256).to_pylist()]
            sizes = np.array([len(a) for a, _ in pairs])
            raw = machine.raw(np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs]), np.cumsum(sizes) - sizes)
            scores.append(sigmoid(raw))
        return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

    return replace_columns(documents, {out: score(_text(text))})


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(crc_bucket("doc_id", 4) != 2)


def quality_result(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_quality(documents, training_labels(labels))
    scored = score_quality(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (crc_bucket("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
