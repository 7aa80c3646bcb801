"""Operator 7: personal data by fixed patterns and a skip-chain conditional random field.

The patterns of four kinds (email, ip, card, phone) give the base spans; each is
matched in time linear in the text. The field reads the words that hold a digit or
an ``@`` (all others are known to be outside) and labels them with a kind or none. A
word's potentials come from its shape and its neighbours; neighbouring words share
transition potentials, and distant words of one document share skip potentials: words
of equal form (the same letters and digits, whatever stands between) and words of similar
form (one character more, less or another, or the same last ``TAIL`` digits). Of a form with many
mentions each is linked to one hub node, and so are the forms of a group of similar ones,
so evidence at one mention reaches all others in two steps while a document's edges grow
with its words. Loopy message passing runs over the graphs of a whole batch at once, until the messages
settle, and makes labels consistent across a document.

The field learns from the base spans of a bounded sample of distinct texts; a hub has the label of
most of its members there. It adds spans of words whose marginal for one kind is at least
``SURE`` and which lie outside the base spans; base spans always stay. What looks like a kind but often
fails its pattern in the sample is not added.

Bounds, for the fit only: ``SAMPLE_ROWS`` texts, and of a text with more than ``WORDS_PER_ROW``
such words the runs of ``RUN`` words of least hash; a word's first 200 characters. Forms of over
``LONG_FORM`` characters are alike when equal, and never similar.

Defined cases: null and empty texts have no spans; texts of any length are read
whole; repeated rows get equal spans; without any base span in the sample the field
adds nothing; other columns are kept, and one with the output's name is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricspark.llm.common import Memo, bound_batches, hash_sample, replace_columns

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 3_000
WORDS_PER_ROW, RUN = 200, 20
LONG_FORM, TAIL = 64, 8
BUCKETS = 1 << 14
LABELS = len(KINDS) + 1  # 0 is none
NO_FEATURE = BUCKETS  # of hubs
MOST_ROUNDS, SETTLED = 200, 1e-3
DAMPING = 0.3
EPOCHS = 60
RATE = 0.2
SURE = 0.95

# ---- base patterns ----------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole, so an address can only start where a run does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern with the local part in front: it must reach up to the ``@``."""
    end = 0
    for match in _DOMAIN.finditer(text):
        at = start = match.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            end = match.end()
            yield start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, by start and kind."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---- words and their graph --------------------------------------------------

_WORD = re.compile(r"\S+")
_HOLDS = re.compile(r"[0-9@]")
_EDGE = " \t\n.,;:!?\"'()[]{}<>|*#$%&"


def shape(word: str) -> str:
    """Runs of digits by their length, other letters as ``a``, signs as they are."""
    out = re.sub(r"[^\W\d_]+", "a", word)
    out = re.sub(r"[0-9]+", lambda m: f"<{min(len(m[0]), 20)}>", out)
    return out[:60]


def coarse(word: str) -> str:
    return re.sub(r"<\d+>", "9", shape(word))


def _hash(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}{value}".encode(errors="replace")) & (BUCKETS - 1)


def word_features(word: str) -> tuple[int, int, int, int]:
    own = word.strip(_EDGE)
    digits = sum(c.isdigit() for c in own)
    return (_hash("s", shape(own)), _hash("c", coarse(word)), _hash("d", f"{min(digits, 20)}{'@' in own}{own[:1] == '+'}"), _hash("l", shape(word)[:6]))


def words_of(text: str) -> list[tuple[int, int, int]]:
    """(place among the words, start, end) of those with a digit or ``@``."""
    if not _HOLDS.search(text):
        return []
    return [(i, m.start(), m.end()) for i, m in enumerate(_WORD.finditer(text)) if _HOLDS.search(m[0])]


def sampled_words(text: str) -> list[tuple[int, int, int]]:
    """The words to learn from: all, or in a text with very many the runs of least hash, in their order."""
    words = words_of(text)
    if len(words) <= WORDS_PER_ROW:
        return words
    runs = [words[i : i + RUN] for i in range(0, len(words), RUN)]
    chosen = sorted(range(len(runs)), key=lambda i: (_hash("r", f"{i}:{text[runs[i][0][1] : runs[i][0][2]][:200]}"), i))[: WORDS_PER_ROW // RUN]
    return [w for i in sorted(chosen) for w in runs[i]]


def likeness_key(word: str) -> str:
    return re.sub(r"[\W_]+", "", word).lower()


def similar_forms(keys: list[str]) -> list[list[str]]:
    """Groups of forms that are similar, one to the next: those that share a form less one character, or a tail of digits."""
    group = {k: k for k in keys}

    def top(k: str) -> str:
        while group[k] != k:
            group[k] = group[group[k]]
            k = group[k]
        return k

    holder: dict[str, str] = {}
    for key in keys:
        digits = re.sub("[^0-9]+", "", key)
        blocks = [f"d{digits[-TAIL:]}"] if len(digits) >= TAIL else []
        if 6 <= len(key) <= LONG_FORM:
            blocks += [f"v{key}", *(f"v{key[:i]}{key[i + 1 :]}" for i in range(len(key)))]
        for block in blocks:
            group[top(key)] = top(holder.setdefault(block, key))
    found: dict[str, list[str]] = {}
    for key in keys:
        found.setdefault(top(key), []).append(key)
    return [g for g in found.values() if len(g) > 1]


class Graph:
    """Nodes and edges of many documents, for message passing in one go."""

    def __init__(self):
        self.features: list[tuple[int, ...]] = []
        self.source: list[int] = []
        self.target: list[int] = []
        self.kind: list[int] = []  # 0: neighbours, 1: alike, 2: similar
        self.hubs: list[tuple[int, list[int]]] = []  # and what is linked to them
        self.memo = Memo(word_features, 50_000)
        self.beside = Memo(lambda w: _hash("b", coarse(w)), 50_000)

    def add(self, places: list[int], words: list[str]) -> list[int]:
        """Adds a document; returns the nodes of its words."""
        first, mentions = len(self.features), {}
        for k, (place, word) in enumerate(zip(places, words)):
            before = words[k - 1] if k and places[k - 1] == place - 1 else ""
            after = words[k + 1] if k + 1 < len(words) and places[k + 1] == place + 1 else ""
            self.features.append((*self.memo[word], self.beside[before], (self.beside[after] * 31 + 7) & (BUCKETS - 1)))
            if before:
                self._edge(first + k - 1, first + k, 0)
            key = likeness_key(word)
            if len(key) >= 4:
                mentions.setdefault(key, []).append(first + k)
        speaker = {key: self._link(nodes, 1) for key, nodes in mentions.items()}
        for group in similar_forms(list(mentions)):
            self._link([speaker[key] for key in group], 2)
        return list(range(first, first + len(words)))

    def _link(self, nodes: list[int], kind: int) -> int:
        """Links nodes through a hub, two of them directly; returns the node that speaks for all."""
        if len(nodes) < 3:
            if len(nodes) == 2:
                self._edge(*nodes, kind)
            return nodes[0]
        hub = len(self.features)
        self.features.append((NO_FEATURE,) * 6)
        self.hubs.append((hub, nodes))
        for node in nodes:
            self._edge(node, hub, kind)
        return hub

    def _edge(self, a: int, b: int, kind: int) -> None:
        self.source.append(a)
        self.target.append(b)
        self.kind.append(kind)

    def arrays(self):
        features = np.array(self.features, np.int64).reshape(len(self.features), 6)
        return features, np.array(self.source, np.int64), np.array(self.target, np.int64), np.array(self.kind, np.int64)


class SkipChain:
    def __init__(self):
        self.node = np.zeros((BUCKETS + 1, LABELS))
        self.start = np.zeros(LABELS)
        self.pair = np.zeros((3, LABELS, LABELS))
        self.fitted = False

    def beliefs(self, graph: Graph):
        """Marginals of the nodes, and of the edges, by damped sum-product."""
        features, a, b, kind = graph.arrays()
        unary = self.start + self.node[features].sum(1) if len(features) else np.zeros((0, LABELS))
        unary[features[:, 0] == NO_FEATURE] = 0
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        half = len(a)
        potential = np.concatenate([self.pair[kind], self.pair[kind].transpose(0, 2, 1)])
        message = np.zeros((2 * half, LABELS))
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])

        def gather():
            total = unary.copy()
            for label in range(LABELS):
                total[:, label] += np.bincount(target, message[:, label], len(unary))
            return total

        for _ in range(MOST_ROUNDS if half else 0):
            outgoing = gather()[source] - message[back]
            new = _logsum(outgoing[:, :, None] + potential, 1)
            new -= new.max(1, keepdims=True)
            change = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if change < SETTLED:
                break
        total = gather() if half else unary
        marginal = np.exp(total - _logsum(total, 1)[:, None])
        cavity = total[source] - message[back]
        joint = cavity[:half, :, None] + self.pair[kind] + cavity[half:, None, :]
        joint = np.exp(joint - _logsum(joint.reshape(half, -1), 1)[:, None, None]) if half else np.zeros((0, LABELS, LABELS))
        return features, a, b, kind, marginal, joint

    def fit(self, graph: Graph, nodes: np.ndarray, labels: np.ndarray) -> None:
        """Log-likelihood ascent with message-passing marginals for the expectations.

        ``labels`` are those of ``nodes``; a hub has the label of most of its members.
        """
        every = np.zeros(len(graph.features), np.int64)
        every[nodes] = labels
        for hub, members in graph.hubs:
            every[hub] = np.bincount(every[members], minlength=LABELS).argmax()
        held = np.eye(LABELS)[every]
        words = np.zeros((len(every), 1))
        words[nodes] = 1
        sums = [np.full(x.shape, 1e-2) for x in (self.node, self.start, self.pair)]
        for _ in range(EPOCHS):
            features, a, b, kind, marginal, joint = self.beliefs(graph)
            error = held - marginal
            error = error * words
            node = np.zeros_like(self.node)
            for column in features.T:
                np.add.at(node, column, error)
            pair = np.zeros_like(self.pair)
            np.add.at(pair, kind, held[a][:, :, None] * held[b][:, None, :] - joint)
            pair[1:] = (pair[1:] + pair[1:].transpose(0, 2, 1)) / 2
            for weights, step, total in zip((self.node, self.start, self.pair), (node, error.sum(0), pair), sums):
                step = step - 0.05 * weights
                total += step**2
                weights += RATE * step / np.sqrt(total)
        self.fitted = True


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True, initial=-1e30)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def find_spans(texts: list[str], field: SkipChain | None) -> list[list[tuple[int, int, int, bool]]]:
    """Per text (start, kind, end, base), sorted."""
    base = [base_spans(t) for t in texts]
    out = [[(*s, True) for s in spans] for spans in base]
    if field is None or not field.fitted:
        return out
    graph, held, nodes = Graph(), [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        if words:
            nodes += graph.add([w[0] for w in words], [text[a:b] for _, a, b in words])
            held += [(i, *w) for w in words]
    if not held:
        return out
    marginal = field.beliefs(graph)[4][nodes]
    best, sure = marginal.argmax(1), marginal.max(1) >= SURE
    runs: list[list[int]] = []  # text, kind, start, end, last place
    for (i, place, start, end), kind, ok in zip(held, best.tolist(), sure.tolist()):
        if not ok or not kind:
            continue
        last = runs[-1] if runs else None
        if last and last[0] == i and last[1] == kind - 1 and last[4] == place - 1 and kind - 1 >= 2:
            last[3], last[4] = end, place
        else:
            runs.append([i, kind - 1, start, end, place])
    for i, kind, start, end, _ in runs:
        word = texts[i][start:end]
        start += len(word) - len(word.lstrip(_EDGE))
        end -= len(word) - len(word.rstrip(_EDGE))
        inside = any(a < end and start < b for a, _, b in base[i])
        if end > start and not inside:
            out[i].append((start, kind, end, False))
    return [sorted(spans) for spans in out]


# ---- on Spark ---------------------------------------------------------------


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


_SAMPLED = T.ArrayType(
    T.StructType([T.StructField("place", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("label", T.IntegerType())])
)


def fit_pii(documents: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> SkipChain:
    """Fits on ``rows`` distinct texts that hold a digit or ``@``, those of least hash; on all if they are fewer.

    Only their words in question, at most ``WORDS_PER_ROW`` each, go to the driver.
    """

    @F.arrow_udf(_SAMPLED)
    def label(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            base, row = base_spans(t), []
            for place, a, b in sampled_words(t):
                kind = next((k + 1 for s, k, e in base if s < b and a < e), 0)
                row.append({"place": place, "word": t[a:b][:200], "label": kind})
            out.append(row)
        kind = pa.list_(pa.struct([("place", pa.int32()), ("word", pa.string()), ("label", pa.int32())]))
        return pa.array(out, kind)

    holding = documents.select(_text(text).alias("t")).where(F.col("t").rlike("[0-9@]")).withColumn("h", F.xxhash64("t"))
    # copies count once, before the sample is sized and taken
    distinct = holding.select("h").distinct()
    # about twice the wanted rows and 100 more pass the share, so it never leaves too few
    picked = hash_sample(distinct, F.col("h"), rows, distinct.count() * rows // (2 * rows + 100))
    # at most ``rows`` numbers: a proven bound
    sampled = holding.join(F.broadcast(picked), "h").dropDuplicates(["h"])
    sample = sorted(sampled.select("h", label("t").alias("w")).collect(), key=lambda r: r["h"])
    graph, nodes, labels = Graph(), [], []
    for row in sample:
        nodes += graph.add([w["place"] for w in row["w"]], [w["word"] for w in row["w"]])
        labels += [w["label"] for w in row["w"]]
    field = SkipChain()
    if any(labels):
        field.fit(graph, np.array(nodes), np.array(labels))
    return field


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])


def pii_spans(documents: DataFrame, field: SkipChain, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds the spans (start, kind, end, base) of every text; kinds by their place in ``KINDS``."""
    shared = documents.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf(T.ArrayType(_SPAN))
    def find(texts: pa.Array) -> pa.Array:
        found = []
        for start in range(0, len(texts), 1_000):
            found += find_spans(texts.slice(start, 1_000).to_pylist(), shared.value)
        kind = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        rows = [[dict(zip(("start", "kind", "end", "base"), s)) for s in spans] for spans in found]
        return pa.array(rows, pa.list_(kind))

    return replace_columns(documents, {out: find(_text(text))})


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with ``[KIND]`` in place of its (start, kind, end) spans; overlaps fall together."""
    out, at = [], 0
    for start, kind, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact_documents(documents: DataFrame, field: SkipChain, text: str = "text") -> DataFrame:
    """Replaces personal data in the texts; a null text stays null."""
    bound_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf(T.StringType())
    def clean(texts: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), 1_000):
            some = texts.slice(start, 1_000).to_pylist()
            spans = find_spans([t or "" for t in some], shared.value)
            out += [t if t is None else redact(t, [s[:3] for s in found]) for t, found in zip(some, spans)]
        return pa.array(out, pa.string())

    return documents.withColumn(text, clean(F.col(text)))


def pii_result(documents: DataFrame) -> DataFrame:
    narrow = documents.select("doc_id", "text")
    found = pii_spans(narrow, fit_pii(narrow)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    names = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
