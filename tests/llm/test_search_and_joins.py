import pytest
"""Operators 2, 3 and 4 against brute force."""

import base64
import collections
import hashlib
import io
import itertools
import random

import numpy as np

from metricspark.llm import chunks, jaccard, topk
from metricspark.llm.queries import QUERIES
from metricspark.llm.topk import Best, search_block, top_k


def brute_top(rows, k, every):
    whole = [
        (i, np.floor(np.array(v, float) * 64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    out = []
    for q, x in {(i, tuple(v)) for i, v in whole if i % every == 0}:
        scored = []
        for i, v in whole:
            if i != q:
                n = max(len(x), len(v))
                scored.append((-int(np.pad(x, (0, n - len(x))) @ np.pad(v, (0, n - len(v)))), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_odd_vectors(spark):
    chance = random.Random(2)
    rows = [(i, [chance.gauss(0, 0.2) for _ in range(8)]) for i in range(90)]
    rows += [(90, None), (91, [1.0, None]), (92, [float("nan")] * 8), (93, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(94, [0.1] * 5), (95, []), (7, rows[7][1]), (96, rows[3][1]), (97, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in top_k(df, k=5, query_every=10).collect())
    assert got == brute_top(exact, 5, 10)
    assert top_k(df.limit(0)).count() == 0


def opened(ids, values):
    return np.load(io.BytesIO(topk.pack_index(ids, values)))


def best_of(best, q):
    mine = best.query == q
    return sorted(zip((-best.score[mine]).tolist(), best.vec[mine].tolist()))


@pytest.mark.parametrize("few", [0.02, 0.0])
def test_search_stops_on_proof_only(monkeypatch, few):
    """With a proof, later postings stay unread; without one, all are read; results are the same."""
    monkeypatch.setattr(topk, "FEW", few)
    chance = np.random.default_rng(3)
    values = np.floor(chance.normal(0, 8, (6_000, 64))).astype(np.int64)
    values[:, 8:] = np.trunc(values[:, 8:] / 8)  # most of the length in a few components
    queries, ids = values[:40], np.arange(6_000)
    best, read, rescored = Best(40, 20), 0, 0
    for start in range(0, 6_000, 2_000):
        some = slice(start, start + 2_000)
        seen, exact = search_block(best, np.arange(40), queries, opened(ids[some], values[some]))
        read, rescored = read + seen, rescored + exact
    postings = int((values != 0).sum())
    assert read < 0.9 * postings if few else read == postings
    assert rescored < 0.05 * 40 * 6_000
    score = queries @ values.T
    for q in range(40):
        assert best_of(best, q) == sorted((-int(s), i) for i, s in enumerate(score[q]) if i != q)[:20]


def test_segments_stand_by_impact_and_hold_every_posting_once():
    chance = np.random.default_rng(4)
    values = np.floor(chance.normal(0, 3, (300, 7))).astype(np.int64)
    block, again, last = opened(np.arange(300), values), np.zeros_like(values), None
    for level in range(int(block["levels"])):
        postings = block[f"postings{level}"]
        for dimension, value, a, b in block[f"segments{level}"].tolist():
            assert value and (last is None or abs(value) <= last)
            last = abs(value)
            assert not again[postings[a:b], dimension].any()
            again[postings[a:b], dimension] = value
        rest = np.sqrt(((values - again).astype(float) ** 2).sum(1))
        assert (block[f"rest{level}"] >= rest).all() and block[f"rest{level}"] == pytest.approx(rest)
    assert (again == values).all()


@pytest.mark.parametrize("top", [1, 10**6, 10**9])
def test_search_with_large_numbers_and_other_widths(top):
    chance = np.random.default_rng(top)
    values = chance.integers(-top, top, (150, 5), endpoint=True)
    for width in (3, 5, 8):
        queries = chance.integers(-top, top, (4, width), endpoint=True)
        best = Best(4, 6)
        search_block(best, np.array([0, 1, 2, 999]), queries, opened(np.arange(150), values))
        shared = min(width, 5)
        score = queries[:, :shared] @ values[:, :shared].T
        for q, own in enumerate((0, 1, 2, 999)):
            assert best_of(best, q) == sorted((-int(s), i) for i, s in enumerate(score[q]) if i != own)[:6]
    none = Best(1, 6)
    search_block(none, np.array([7]), np.zeros((1, 0), np.int64), opened(np.arange(3), np.zeros((3, 0), np.int64)))
    assert best_of(none, 0) == [(0, 0), (0, 1), (0, 2)]


def test_chunks_cover_and_resist_shifts():
    chance = random.Random(1)
    data = bytes(chance.randrange(97, 123) for _ in range(40_000))
    ends = chunks.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= chunks.MOST and sizes[:-1].min() >= chunks.LEAST
    text = data.decode()
    a, b = chunks.chunk_set(text), chunks.chunk_set("shifted " + text)
    assert chunks.likeness(a, b) > 0.98
    assert chunks.likeness(a, chunks.chunk_set(text[::-1])) < 0.05
    assert (chunks.from_string(chunks.as_string(a)) == a).all()


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog, twice over", np.uint8)
    h, want = 0, []
    for byte in data:
        h = ((h << 1) + int(chunks.GEAR[byte])) & 0xFFFFFFFF
        want.append(h)
    assert chunks.gear_hashes(data).tolist() == want


def check_fingerprints(rows, got):
    want = collections.Counter()
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        own, other, after = (chunks.chunk_set(t) for t in (text, changed, following))
        want[
            doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), chunks.as_string(own), chunks.as_string(other),
            chunks.likeness(own, other), chunks.likeness(own, after),
        ] += 1
    assert collections.Counter(tuple(r) for r in got) == want


def test_op3_over_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((r["doc_id"], r["text"] or "") for r in rows), reverse=True)
    check_fingerprints(rows, QUERIES["op3_chunks"](spark, sf_dir).collect())


def test_op3_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_documents.collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    check_fingerprints(rows, chunks.fingerprint_result(odd_documents).collect())
    assert chunks.fingerprint_result(no_documents).count() == 0
    one = odd_documents.where("doc_id = 1")
    assert chunks.fingerprint_result(one).first()["near_next"] == 1.0
    kept = chunks.fingerprint(odd_documents).collect()
    assert len(kept) == len(rows) and all(r["Score"] == "kept" for r in kept)
    assert {r["fingerprint"] for r in kept if not r["text"]} == {base64.b64encode(b"").decode()}


def brute_components(rows):
    sets, parent = {}, {}
    for doc_id, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets.setdefault(doc_id, []).append(grams)
        parent[doc_id] = doc_id

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations([d for d in sets if d is not None], 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return collections.Counter(
        (d, len(g), None if d is None else find(d)) for d, grams in sets.items() for g in grams
    )


def test_op4_over_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_jaccard"](spark, sf_dir).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(rows)


def test_op4_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = jaccard.jaccard_components(odd_documents).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(rows)
    assert jaccard.jaccard_components(no_documents).count() == 0


def test_op4_hot_families(spark, monkeypatch):
    """A common passage, a family of near copies and small tiles: same components as all pairs."""
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 6)
    chance = random.Random(8)
    word = lambda: f"w{chance.randrange(5000)}"
    passage = [word() for _ in range(40)]
    seed = [word() for _ in range(60)]
    rows = []
    for i in range(120):
        if i % 3 == 0:
            text = passage + [word() for _ in range(chance.randrange(1, 60))]
        elif i % 3 == 1:
            text = list(seed)
            for _ in range(chance.randrange(0, 3)):
                text[chance.randrange(60)] = word()
        else:
            text = [word() for _ in range(chance.randrange(0, 30))]
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.jaccard_components(df).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(rows)


@pytest.mark.parametrize("edits", [3])
def test_op4_pairs_of_a_family_grow_with_its_size(spark, monkeypatch, edits):
    """Near copies of one text, each with its own random edits: pairs and links in proportion, one component."""
    kept = {}
    stored = jaccard._stored

    def counted(df, name):
        out = stored(df, name)
        if name in ("pairs", "links", "edges"):
            kept.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_stored", counted)
    totals = []
    for n in (300, 1200):
        chance = random.Random(edits)
        seed = [f"s{i}" for i in range(300)]
        rows = []
        for i in range(n):
            words = list(seed)
            for _ in range(edits):
                words[chance.randrange(300)] = f"w{chance.randrange(10**6)}"
            rows.append((i, " ".join(words)))
        kept.clear()
        got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r["component_id"] for r in got} == {0}
        totals.append({name: sum(counts) for name, counts in kept.items()})
    for name, few in totals[0].items():
        assert totals[1][name] <= 6 * few, (name, totals)
    assert totals[1]["pairs"] <= 8 * 1200


def test_op4_rows_of_one_document_have_one_component(spark):
    """Also where an unrelated text of it, or an empty one, links with nothing."""
    texts = [" ".join(f"{c}{i}" for i in range(20)) for c in "abcd"]
    rows = [(1, texts[0]), (2, texts[1]), (2, texts[0]), (2, ""), (3, texts[2]), (4, texts[2] + " more"), (4, texts[3]), (5, texts[3]), (None, texts[0])]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    got = {r["rep"]: r["label"] for r in jaccard.components(links).collect()}
    assert set(got.values()) == {0, 1000} and len(got) == 303


def test_prefixes_meet():
    """Sets that link share a shown gram, in any order of frequency."""
    chance = random.Random(3)
    for _ in range(300):
        n = chance.randrange(1, 40)
        a = set(chance.sample(range(200), n))
        b = set(a)
        for _ in range(chance.randrange(0, 5)):
            b.discard(chance.choice(sorted(b))) if len(b) > 1 else None
            b.add(chance.randrange(200))
        frequent = np.array(sorted(chance.sample(range(200), 30)), np.uint64)
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        if jaccard.linked(x, y):
            shown = [set(jaccard.prefix(z, frequent).tolist()) for z in (x, y)]
            assert shown[0] & shown[1]
