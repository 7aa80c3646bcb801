"""Operator 6: a linear-chain conditional random field tags toxic words.

Labels mark documents, so token labels come first: in a bounded sample of labelled
training documents, word features that occur in several distinct sentences of toxic
documents and (almost) never elsewhere make a token of a toxic document a toxic one.
Counting distinct sentences keeps copies of one document from making all its words
look toxic.

The field has two states over the words of a sentence, with weights for the word, its
beginnings and ending and its neighbours, and for the transitions; AdaGrad fits it by
forward-backward marginals on the driver. Scoring runs forward-backward over every
sentence of every whole text, all sentences of a batch in step; a long sentence is one chain,
whose segments of ``SEGMENT`` words are first summed up as 2 x 2 matrices. A document's score comes from the expected
number of toxic words and the surest of them by a logistic function fitted on the
whole texts of the sampled documents, of which Spark sends two numbers each; spans are the runs of words with a marginal of at least a half.

Bounds, for the fit of the token weights only: ``SAMPLE_ROWS`` documents of each label, and of a sampled
text the ``CHAINS_PER_ROW`` sentences of least hash.

Defined cases: null and empty texts hold one blank token and get the score of a text
without toxic words; without labels of both kinds every score is 0; texts of any
length are read whole; repeated rows get equal scores; extra columns are kept and
those with an output's name are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.common import Memo, bound_batches, bounded_rows, crc_bucket, hash_sample, replace_columns

SAMPLE_ROWS = 2_500  # of each label
CHAINS_PER_ROW = 40
SEGMENT = 64
BUCKETS = 1 << 18
LEAST_SENTENCES = 4
LEAST_PURITY = 0.97
LEAST_EVIDENCE = 14.0  # nats
EPOCHS = 14
BATCH_CHAINS = 2_000
RATE = 0.3
DECAY = 3e-4
OTHERS = 3  # sampled sentences without toxic words for each one with
MEMO_WORDS = 250_000
SUSPECTED = 0.2  # words below do not add to a document's score, however many they are
BREAK = "\x00"
LIMIT = 25.0
WORD = re.compile(r"\S+")
EDGES = re.compile(r"^\W+|\W+$")


# ---- words and their features -----------------------------------------------


def tokens(text: str) -> list[str]:
    """The words, a break for every line end and one before the text."""
    return [BREAK, *text.replace(BREAK, "�").replace("\n", f" {BREAK} ").split()]


def ends_chain(word: str) -> bool:
    return word == BREAK or word[-1] in ".!?"


def core(word: str) -> str:
    low = word.lower()
    if low.isalnum():
        return low
    low = low.strip(".,;:!?()\"'")  # most need no more than this
    return low if low.isalnum() else EDGES.sub("", low)


# checksums go on from that of a feature's kind
WHOLE = zlib.crc32(b"w")
BEGINNINGS = [(k, zlib.crc32(b"p%d" % k)) for k in (3, 4, 5, 6)]
ENDINGS = [(k, zlib.crc32(b"s%d" % k)) for k in (3, 4)]


def own_features(word: str, crc32=zlib.crc32) -> list[int]:
    """Buckets of the word itself, the first, and of its beginnings and endings."""
    low = core(word)
    data, n, top = low.encode(errors="replace"), len(low), BUCKETS - 1
    found = [crc32(data, WHOLE) & top]
    if len(data) == n:  # a byte for every character
        found += [crc32(data[:k], kind) & top for k, kind in BEGINNINGS if n >= k]
        found += [crc32(data[-k:], kind) & top for k, kind in ENDINGS if n > k]
    else:
        found += [crc32(low[:k].encode(errors="replace"), kind) & top for k, kind in BEGINNINGS if n >= k]
        found += [crc32(low[-k:].encode(errors="replace"), kind) & top for k, kind in ENDINGS if n > k]
    return found


def chain_starts(ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where chains begin: after an ending word, and at a document's first."""
    starts = np.zeros(len(ends), bool)
    starts[1:] = ends[:-1]
    starts[first] = True
    return np.flatnonzero(starts)


# ---- the field --------------------------------------------------------------


class LinearChain:
    """Two states; all weights are log-odds of state 1 but the transitions."""

    def __init__(self):
        self.bias = -4.0
        self.own = np.zeros(BUCKETS)
        self.left = np.zeros(BUCKETS)  # by the word before
        self.right = np.zeros(BUCKETS)  # by the word after
        self.move = np.zeros((2, 2))
        self.calibration = np.array([-6.0, 1.0])
        self.fitted = False

    def messages(self, emission: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratios of state 1 to state 0: forward with the emission, and backward."""
        n = len(emission)
        phi = np.exp(np.clip(emission, -LIMIT, LIMIT))
        a = np.exp(self.move)
        lengths = np.diff([*starts, n])
        pieces = -(-lengths // SEGMENT)
        index = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(starts, pieces) + SEGMENT * index
        size = np.minimum(SEGMENT, np.repeat(starts + lengths, pieces) - begin)
        enter, leave = np.zeros(len(begin)), np.ones(len(begin))
        cut = np.flatnonzero(np.repeat(pieces > 1, pieces))  # segments of long chains
        if len(cut):
            enter[cut], leave[cut] = self._carry(phi, a, pieces[pieces > 1], begin[cut], size[cut])
        order = np.argsort(-size, kind="stable")
        begin, size, enter, leave, index = (x[order] for x in (begin, size, enter, leave, index))
        forward, backward = np.empty_like(phi), np.ones_like(phi)
        longest = int(size[0]) if len(size) else 0
        active = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest)]
        ratio = np.where(index == 0, 1.0, (a[0, 1] + a[1, 1] * enter) / (a[0, 0] + a[1, 0] * enter))
        for t in range(longest):
            at = begin[: active[t]] + t
            if t:
                ratio = ratio[: active[t]]
                ratio = phi[at] * (a[0, 1] + a[1, 1] * ratio) / (a[0, 0] + a[1, 0] * ratio)
            else:
                ratio = phi[at] * ratio
            forward[at] = ratio
        backward[begin + size - 1] = leave
        for t in range(longest - 2, -1, -1):
            at = begin[: active[t + 1]] + t
            ahead = phi[at + 1] * backward[at + 1]
            backward[at] = (a[1, 0] + a[1, 1] * ahead) / (a[0, 0] + a[0, 1] * ahead)
        return forward, backward

    @staticmethod
    def _carry(phi, a, pieces, begin, size) -> tuple[np.ndarray, np.ndarray]:
        """The ratios that enter and leave the segments of long chains.

        A segment maps the ratio before it to that at its end, and backwards, by a fraction
        of two linear terms: a 2 x 2 matrix, made for all segments in step. Then the ratios
        go from segment to segment.
        """
        last = np.cumsum(pieces) - 1
        first = last - pieces + 1
        order = np.argsort(-size, kind="stable")
        place = begin[order]
        longest = int(size[order[0]])
        active = [int(np.searchsorted(-size[order], -t, side="left")) for t in range(longest)]
        opening = np.zeros(len(begin), bool)
        opening[first] = True
        opening = np.flatnonzero(opening[order])

        def scaled(matrix: np.ndarray) -> np.ndarray:
            return matrix / matrix.max((0, 1))

        def unordered(matrix: np.ndarray) -> np.ndarray:
            out = np.empty_like(matrix)
            out[:, :, order] = matrix
            return out

        def identity() -> np.ndarray:
            return np.repeat(np.eye(2)[:, :, None], len(begin), 2)

        # a word's matrix is that of the move, with a row (backwards: a column) times its phi
        ahead = identity()
        for t in range(longest):
            now = ahead[:, :, : active[t]]
            made = np.array([a[1, 1] * now[0] + a[0, 1] * now[1], a[1, 0] * now[0] + a[0, 0] * now[1]])
            if not t:  # the first word of a chain has no ratio before it
                made[:, 0, opening] = 0
                made[:, 1, opening] = 1
            made[0] *= phi[place[: active[t]] + t]
            ahead[:, :, : active[t]] = scaled(made)
        behind = identity()
        for t in range(longest - 2, -1, -1):
            now = behind[:, :, : active[t + 1]]
            told = now[0] * phi[place[: active[t + 1]] + t + 1]
            behind[:, :, : active[t + 1]] = scaled(np.array([a[1, 1] * told + a[1, 0] * now[1], a[0, 1] * told + a[0, 0] * now[1]]))
        ahead, behind = unordered(ahead), unordered(behind)

        def apply(matrix: np.ndarray, value: np.ndarray) -> np.ndarray:
            return (matrix[0, 0] * value + matrix[0, 1]) / (matrix[1, 0] * value + matrix[1, 1])

        enter, leave = np.zeros(len(begin)), np.ones(len(begin))
        for j in range(1, int(pieces.max())):
            at = first[pieces > j] + j
            enter[at] = apply(ahead[:, :, at - 1], enter[at - 1])
            at = last[pieces > j] - j + 1  # from the end, what its first word tells the segment before
            told = phi[begin[at]] * apply(behind[:, :, at], leave[at])
            leave[at - 1] = (a[1, 0] + a[1, 1] * told) / (a[0, 0] + a[0, 1] * told)
        return enter, leave

    def fit(self, chains: list[tuple[list[list[int]], list[int], np.ndarray]]) -> None:
        """Chains as (own features, word hash, label) per word."""
        random = np.random.default_rng(5)
        gathered = [np.full(BUCKETS, 1e-3) for _ in range(3)]
        gathered_move, gathered_bias = np.full((2, 2), 1e-3), 1e-3
        for _ in range(EPOCHS):
            order = random.permutation(len(chains))
            for low in range(0, len(order), BATCH_CHAINS):
                some = [chains[i] for i in order[low : low + BATCH_CHAINS]]
                sizes = np.array([len(c[1]) for c in some])
                starts = np.cumsum(sizes) - sizes
                own = [f for c in some for f in c[0]]
                where = np.repeat(np.arange(len(own)), [len(f) for f in own])
                flat = np.array([x for f in own for x in f])
                word = np.concatenate([c[1] for c in some])
                label = np.concatenate([c[2] for c in some]).astype(float)
                inner = np.ones(len(word), bool)
                inner[starts] = False
                follows = np.flatnonzero(inner)  # words with one before in their chain
                emission = self.bias + np.bincount(where, self.own[flat], len(own))
                emission[follows] += self.left[word[follows - 1]]
                emission[follows - 1] += self.right[word[follows]]
                forward, backward = self.messages(emission, starts)
                odds = forward * backward
                error = odds / (1 + odds) - label
                steps = (
                    np.bincount(flat, error[where], BUCKETS),
                    np.bincount(word[follows - 1], error[follows], BUCKETS),
                    np.bincount(word[follows], error[follows - 1], BUCKETS),
                )
                for weights, step, total in zip((self.own, self.left, self.right), steps, gathered):
                    step = np.where(step != 0, step + DECAY * weights, 0)
                    total += step**2
                    weights -= RATE * step / np.sqrt(total)
                before, ahead = forward[follows - 1], np.exp(np.clip(emission[follows], -LIMIT, LIMIT)) * backward[follows]
                pair = np.exp(self.move)[:, :, None] * np.array([[np.ones_like(ahead), ahead], [before, before * ahead]])
                expected = (pair / pair.sum((0, 1))).sum(2)
                seen = np.zeros((2, 2))
                np.add.at(seen, (label[follows - 1].astype(int), label[follows].astype(int)), 1)
                step = expected - seen
                gathered_move += step**2
                self.move -= RATE * step / np.sqrt(gathered_move)
                gathered_bias += float(error.sum()) ** 2
                self.bias -= RATE * float(error.sum()) / gathered_bias**0.5
        self.fitted = True

    def calibrate(self, stats: np.ndarray, labels: np.ndarray, share: float) -> None:
        """Logistic regression of document labels on ``document_inputs``, by Newton steps.

        ``share`` is that of label 1 among all labelled rows; the sample is weighed to it.
        """
        x = document_inputs(stats)
        weight = np.where(labels > 0, share / labels.mean(), (1 - share) / (1 - labels.mean()))
        theta = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            slope = x.T @ (weight * (p - labels)) + 0.1 * theta
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(theta))
            theta -= np.linalg.solve(curve, slope)
        self.calibration = theta

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(stats))
        return 1 / (1 + np.exp(-np.clip(document_inputs(stats) @ self.calibration, -30, 30)))


def document_inputs(stats: np.ndarray) -> np.ndarray:
    """A constant, and one measure that grows with both statistics of ``Tagger.tag``."""
    total, most = stats[:, 0], np.clip(stats[:, 1], 1e-6, 1 - 1e-6)
    return np.column_stack([np.ones(len(stats)), np.log(total + 0.1) + 0.02 * np.log(most / (1 - most))])


class Numbers(dict):
    """Numbers words in the order they are met in; ``new`` lists those not looked at yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Tagger:
    """Runs a field over texts; what a word contributes is worked out once per word."""

    def __init__(self, field: LinearChain):
        self.field = field
        self.number = Numbers()
        self.parts = np.zeros((4, MEMO_WORDS + 1))  # own, left, right, ends

    def _learn(self) -> None:
        """Works out the parts of all new words at once."""
        words, self.number.new = self.number.new, []
        if not words:
            return
        if len(self.number) > self.parts.shape[1]:
            self.parts = np.pad(self.parts, ((0, 0), (0, len(self.number) - self.parts.shape[1])))
        features = [own_features(word) for word in words]
        sizes = np.fromiter(map(len, features), np.int64, len(features))
        flat = np.fromiter(chain.from_iterable(features), np.int64, sizes.sum())
        begin = np.cumsum(sizes) - sizes
        f, h = self.field, flat[begin]
        known = len(self.number) - len(words)
        self.parts[:, known : len(self.number)] = (
            np.add.reduceat(f.own[flat], begin), f.left[h], f.right[h], [ends_chain(w) for w in words]
        )
        if BREAK in self.number and self.number[BREAK] >= known:
            self.parts[:, self.number[BREAK]] = (-LIMIT, 0, 0, 1)

    def marginals(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Odds of toxic for all words of all texts, and where each text begins."""
        if len(self.number) > MEMO_WORDS:
            self.number.clear()
        words = list(chain.from_iterable(split))
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self._learn()
        sizes = np.array([len(words) for words in split])
        first = np.cumsum(sizes) - sizes
        own, left, right, ends = self.parts[:, ids]
        starts = chain_starts(ends > 0, first)
        inner = np.ones(len(ids), bool)
        inner[starts] = False
        follows = np.flatnonzero(inner)
        emission = self.field.bias + own
        emission[follows] += left[follows - 1]
        emission[follows - 1] += right[follows]
        forward, backward = self.field.messages(emission, starts)
        return forward * backward, first

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Per text the inputs of its score, and its spans in characters."""
        split = [tokens(t) for t in texts]
        odds, first = self.marginals(split)
        sure = odds / (1 + odds)
        suspected = np.where(sure >= SUSPECTED, np.log1p(odds), 0)
        stats = np.column_stack([np.add.reduceat(suspected, first), np.maximum.reduceat(sure, first)])
        spans = []
        for text, words, begin, most in zip(texts, split, first, stats[:, 1]):
            spans.append([])
            if most < 0.5:
                continue
            real = [i for i, w in enumerate(words) if w != BREAK]
            last = None
            for i, match in zip(real, WORD.finditer(text)):
                if odds[begin + i] < 1:
                    continue
                if last is not None and last == i - 1:
                    spans[-1][-1] = (spans[-1][-1][0], match.end())
                else:
                    spans[-1].append(match.span())
                last = i
        return stats, spans


# ---- on Spark ---------------------------------------------------------------


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sampled_texts(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, _label, _hash, text): up to ``rows`` training documents of each label, those of least hash.

    There are more rows where ids repeat; what is collected of them is bounded.
    """
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("_label"))

    def pick(label: int) -> DataFrame:
        own = known.where(F.col("_label") == label)
        return hash_sample(own, F.xxhash64("doc_id"), rows, own.count() // 2)

    # at most 2 x ``rows`` rows of two numbers: a proven bound
    picked = F.broadcast(pick(0).unionByName(pick(1)))
    return documents.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "_label", F.xxhash64("text").alias("_hash"), _text("text").alias("text"))


def sampled_sentences(sample: DataFrame) -> DataFrame:
    """Adds ``sentences``: those of a text, up to a bound those of least hash."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            words = tokens(text)
            ends = np.array([ends_chain(w) for w in words])
            at = chain_starts(ends, np.array([0]))
            chains = {" ".join(words[a:b]) for a, b in zip(at, [*at[1:], len(words)])} - {BREAK}
            out.append(sorted(chains, key=lambda c: (zlib.crc32(c.encode(errors="replace")), c))[:CHAINS_PER_ROW])
        return pa.array(out, pa.list_(pa.string()))

    return sample.select("doc_id", "_label", "_hash", cut("text").alias("sentences"))


def label_tokens(rows: list[tuple[int, list[str]]]) -> list[tuple[list[list[int]], np.ndarray, np.ndarray]]:
    """Training chains with token labels from (document label, sentences) rows."""
    toxic = {s for label, sentences in rows if label for s in sentences}
    clean = {s for label, sentences in rows if not label for s in sentences}
    toxic -= clean
    seen = [Counter(), Counter()]
    for kind, group in ((0, clean), (1, toxic)):
        for sentence in group:
            seen[kind].update(set(sentence.split(" ")))
    words = Memo(own_features, len(seen[0]) + len(seen[1]) + 1)
    count: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for kind in (0, 1):
        for word, n in seen[kind].items():
            for f in words[word]:
                count[f][kind] += n
    # a feature is sure when the share of toxic documents' sentences among its own is
    # near 1 and would not come about by chance at these numbers of sentences
    share = len(toxic) / max(len(toxic) + len(clean), 1)
    sure = set()
    for f, (no, yes) in count.items():
        purity = yes / (yes + no * share / max(1 - share, 1e-9))
        own = yes / (yes + no)
        evidence = yes * np.log(own / share) + (no * np.log((1 - own) / (1 - share)) if no else 0) if own > share else 0
        if yes >= LEAST_SENTENCES and purity >= LEAST_PURITY and evidence >= LEAST_EVIDENCE:
            sure.add(f)
    marked = {w for w in seen[1] if any(f in sure for f in words[w])}
    found, others = [], []
    for kind, group in ((1, toxic), (0, clean)):
        for sentence in sorted(group):
            parts = sentence.split(" ")
            label = np.array([int(kind and w in marked) for w in parts])
            (found if label.any() else others).append((parts, label))
    random = np.random.default_rng(3)
    keep = random.permutation(len(others))[: OTHERS * max(len(found), 1_000)]
    return [
        ([words[w] for w in parts], np.array([words[w][0] for w in parts]), label)
        for parts, label in found + [others[i] for i in keep]
    ]


def fit_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> LinearChain:
    texts = sampled_texts(documents, labels, label, rows)
    keys = ["doc_id", "_label", "_hash"]
    sample = bounded_rows(sampled_sentences(texts), keys, 2 * rows).collect()
    sample.sort(key=lambda r: tuple(r[k] for k in keys))
    field = LinearChain()
    kinds = {r["_label"] for r in sample}
    if len(kinds) < 2:
        return field
    field.fit(label_tokens([(r["_label"], r["sentences"]) for r in sample]))
    measured = texts.select(*keys, _tagged(texts, field, "text")["stats"].alias("stats"))
    stats = bounded_rows(measured, keys, 2 * rows).select("_label", "stats.*").toPandas()
    share = labels.where(F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    field.calibrate(stats[["total", "most"]].to_numpy(), stats["_label"].to_numpy(float), share)
    return field


_STATS = T.StructType([T.StructField(c, T.DoubleType()) for c in ("total", "most")])
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_TAGGED = T.StructType([T.StructField("stats", _STATS), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(_SPAN))])


def _tagged(documents: DataFrame, field: LinearChain, text: str) -> Column:
    """A struct (stats, score, spans) of every whole text; the field is a broadcast of fixed size."""
    shared = documents.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf(_TAGGED)
    def tag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(shared.value)
        place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for texts in batches:
            measured, spans = [np.zeros((0, 2))], []
            for start in range(0, len(texts), 200):
                stats, found = tagger.tag(texts.slice(start, 200).to_pylist())
                measured.append(stats)
                spans += [[{"start": a, "end": b} for a, b in s] for s in found]
            stats = np.concatenate(measured)
            numbers = pa.StructArray.from_arrays([pa.array(stats[:, 0]), pa.array(stats[:, 1])], names=["total", "most"])
            yield pa.StructArray.from_arrays([numbers, pa.array(tagger.field.scores(stats), pa.float64()), pa.array(spans, place)], names=["stats", "score", "spans"])

    return tag(_text(text))


def score_toxicity(documents: DataFrame, field: LinearChain, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Adds a struct (stats, score, spans)."""
    bound_batches(documents.sparkSession)
    return replace_columns(documents, {out: _tagged(documents, field, text)})


def toxicity_result(documents: DataFrame, labels: DataFrame) -> DataFrame:
    field = fit_toxicity(documents, labels.where(crc_bucket("doc_id", 5) != 0))
    scored = score_toxicity(documents.select("doc_id", "text"), field)
    score = F.col("toxicity")["score"]
    spans = F.transform(F.col("toxicity")["spans"], lambda s: F.concat_ws(":", s["start"], s["end"]))
    return scored.select(
        "doc_id",
        (crc_bucket("doc_id", 5) == 0).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        F.concat_ws(",", spans).alias("spans"),
    )
