"""Operators 6, 7 and 9: held-out accuracy, brute force for what is exact, odd rows."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from metricspark.llm import pii, quality, toxicity
from metricspark.llm.queries import QUERIES

MODEL_DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{MODEL_DATA}/labels.parquet").collect()}


@pytest.mark.parametrize("query, label, least", [("op9_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, labels, query, label, least):
    got = QUERIES[query](spark, MODEL_DATA).collect()
    assert len(got) == spark.read.parquet(f"{MODEL_DATA}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    right = [r["predicted"] == labels[r["doc_id"]][label] for r in held]
    assert len(held) > 50 and np.mean(right) >= least
    assert all(0 <= r["score"] <= 1 for r in got)


def test_machine_equals_all_pairs():
    machine = quality.FactorisationMachine(size=50, rank=4)
    machine.table[:, 0] = np.linspace(-1, 1, 50)
    index, value = np.array([3, 9, 20, 41]), np.array([0.5, 1.0, 2.0, 0.25], np.float32)
    pairs = sum(
        float(machine.table[a, 1:] @ machine.table[b, 1:]) * x * y
        for (a, x), (b, y) in itertools.combinations(zip(index, value), 2)
    )
    want = float(machine.table[index, 0] @ value) + pairs
    assert machine.raw(index, value, np.array([0]))[0] == pytest.approx(want, rel=1e-4)


def test_models_on_odd_rows(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (8, None, None), (None, 1, 1)], none.schema)
    for known in (none, some):
        rows = quality.score_quality(odd_documents, quality.fit_quality(odd_documents, known)).collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
        if known is none:
            assert {r["score"] for r in rows} == {0.5}
        rows = toxicity.score_toxicity(odd_documents, toxicity.fit_toxicity(odd_documents, known)).collect()
        assert len(rows) == 12 and all(0 <= r["toxicity"]["score"] <= 1 for r in rows)
    assert quality.quality_result(no_documents, some).count() == 0
    assert toxicity.toxicity_result(no_documents, some).count() == 0


def test_chain_marginals_equal_enumeration():
    chance = np.random.default_rng(1)
    field = toxicity.LinearChain()
    field.move = chance.normal(0, 1, (2, 2))
    emission, starts = chance.normal(0, 2, 9), np.array([0, 4, 5])
    forward, backward = field.messages(emission, starts)
    odds = forward * backward
    for a, b in zip(starts, [4, 5, 9]):
        weight = np.zeros((b - a, 2))
        for path in itertools.product((0, 1), repeat=b - a):
            score = sum(emission[a + i] for i, s in enumerate(path) if s)
            score += sum(field.move[x, y] for x, y in itertools.pairwise(path))
            for i, s in enumerate(path):
                weight[i, s] += np.exp(score)
        assert odds[a:b] == pytest.approx(weight[:, 1] / weight[:, 0])


def test_toxic_spans_point_into_the_text(spark):
    words = ["plain", "river", "stone", "cloud", "green", "table", "light", "paper"]
    rows, known = [], []
    chance = np.random.default_rng(7)
    for i in range(160):
        line = " ".join(chance.choice(words, 12)) + f" n{i}."
        bad = i % 2
        rows.append((i, line.replace("stone", "stone vilewretch", 1) + ("\nYou vilewretch!" if bad else "")) if bad else (i, line))
        known.append((i, bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = toxicity.fit_toxicity(docs, spark.createDataFrame(known, "doc_id long, toxic int"))
    for row in toxicity.score_toxicity(docs, field).collect():
        found = [row["text"][s["start"] : s["end"]] for s in row["toxicity"]["spans"]]
        assert (row["toxicity"]["score"] >= 0.5) == bool(row["doc_id"] % 2)
        assert any("vilewretch" in f for f in found) == bool(row["doc_id"] % 2)


# ---- personal data ----------------------------------------------------------

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    import random

    chance = random.Random(5)
    parts = ["@", ".", "a", "b-", "1", "25", "256", "0007", "+", "+1 ", "(", ") ", "-", " ", "4111 1111 1111 1111", "x@y.z", "1.2.3.4", "é", "\n", "٣"]
    for _ in range(3_000):
        text = "".join(chance.choice(parts) for _ in range(chance.randrange(0, 25)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_base_spans_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "@a.b" * 40_000, "1." * 80_000, "+1 " * 60_000, "a@" * 80_000):
        pii.base_spans(text)


def test_messages_are_exact_on_a_tree():
    field = pii.SkipChain()
    chance = np.random.default_rng(2)
    field.start, field.pair = chance.normal(0, 1, pii.LABELS), chance.normal(0, 1, field.pair.shape)
    field.pair[1] = (field.pair[1] + field.pair[1].T) / 2
    graph = pii.Graph()
    graph.add([0, 1, 5], ["12-34", "999", "1234"])  # a neighbour and one alike
    field.node[np.array(graph.features).ravel()] = chance.normal(0, 1, (18, pii.LABELS))
    _, a, b, kind, marginal, _ = field.beliefs(graph)
    assert sorted(zip(a, b, kind)) == [(0, 1, 0), (0, 2, 1)]
    unary = field.start + field.node[np.array(graph.features)].sum(1)
    weight = np.zeros((3, pii.LABELS))
    for path in itertools.product(range(pii.LABELS), repeat=3):
        score = sum(unary[i, s] for i, s in enumerate(path)) + field.pair[0][path[0], path[1]] + field.pair[1][path[0], path[2]]
        for i, s in enumerate(path):
            weight[i, s] += np.exp(score)
    assert marginal == pytest.approx(weight / weight.sum(1, keepdims=True), abs=2e-3)


def test_field_adds_what_repeats(spark):
    """A card number that fails its check digit but stands where cards stand is added."""
    chance = np.random.default_rng(11)
    rows = []
    for i in range(150):
        digits = [4, *chance.integers(0, 10, 14).tolist()]
        doubled = [d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        number = "".join(map(str, [*digits, -sum(doubled) % 10]))
        rows.append((i, f"paid with {number} today, version 2.{i % 9} of {1990 + i % 30}"))
    field = pii.fit_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    text = "paid with 4111111111111112 today, again 4111111111111112 today, version 2.3 of 1999"
    (spans,) = pii.find_spans([text], field)
    assert [(text[a:b], k, base) for a, k, b, base in spans] == [("4111111111111112", 2, False)] * 2
    assert all([s[1:2] + s[3:] for s in spans] == [(2, True)] for spans in pii.find_spans([t for _, t in rows], field))


def test_field_learns_from_as_many_distinct_texts_as_wanted(spark, monkeypatch):
    """However rare the texts that hold a digit are, and however often each is copied."""
    learnt = []
    monkeypatch.setattr(pii.SkipChain, "fit", lambda self, graph, nodes, labels: learnt.append(len(labels)))
    for copies, others in ((1, 40_000), (30, 0)):
        holding = spark.range(60 * copies).selectExpr("concat('write to ', 'user', id % 60, '@example.org') AS text")
        pii.fit_pii(holding.union(spark.range(others).selectExpr("'nothing here'")), rows=20)
        pii.fit_pii(holding, rows=100)
    assert learnt == [20, 60, 20, 60]


def test_forms_are_similar_by_one_character_or_a_tail_of_digits():
    groups = pii.similar_forms(["4111111111111111", "4111111111111112", "411111111111111", "user17", "user18x", "00493012345678", "3012345678", "ab1", "ab2", "z" * 90, "z" * 89])
    assert sorted(map(sorted, groups)) == [["00493012345678", "3012345678"], ["411111111111111", "4111111111111111", "4111111111111112"]]


def test_evidence_reaches_every_mention_through_a_hub():
    """One sure mention among thirty, and one of a similar form: edges stay linear, and all follow."""
    field = pii.SkipChain()
    field.fitted = True
    field.pair[1:] = 6 * np.eye(pii.LABELS)
    field.start = np.array([2.0, 0, 0, 0, 0])
    graph = pii.Graph()
    nodes = graph.add([3 * i for i in range(31)], [f"a-{'b' * (i % 2)}123456" if i % 2 == 0 else "a123456" for i in range(30)] + ["a123457"])
    field.node[graph.features[nodes[0]][0]] = [0, 0, 60, 0, 0]
    assert len(graph.source) == 31 and len(graph.hubs) == 1
    marginal = field.beliefs(graph)[4][nodes]
    assert (marginal.argmax(1) == 2).all()


def test_sampled_words_are_runs_from_the_whole_text():
    text = " ".join(f"n{i}" for i in range(5_000))
    words = pii.sampled_words(text)
    assert len(words) == 200 and words == sorted(words) and words[-1][0] > 2_500
    assert pii.sampled_words("1 2 3") == pii.words_of("1 2 3")


def test_planted_mentions_of_a_broken_format_are_found(spark):
    """Numbers that occur once as the patterns ask and again with a wrong digit or other signs: precision and recall."""
    chance = np.random.default_rng(23)

    def card():
        digits = [4, *chance.integers(0, 10, 14).tolist()]
        doubled = [d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return "".join(map(str, [*digits, -sum(doubled) % 10]))

    def document(i, broken):
        number = card()
        again = number[:-1] + str((int(number[-1]) + 3) % 10)
        order = f"{chance.integers(10**6, 10**7)}"
        filler = " ".join(f"word{j}" for j in range(40))
        return f"paid with {number} today. {filler} order {order} of {1990 + i % 30}, {filler} paid with {again if broken else number} again", again

    plain = [(i, document(i, False)[0]) for i in range(150)]
    field = pii.fit_pii(spark.createDataFrame(plain, "doc_id long, text string"))
    hit = wrong = 0
    for i in range(100):
        text, again = document(i, True)
        (spans,) = pii.find_spans([text], field)
        added = [(text[a:b], pii.KINDS[k]) for a, k, b, base in spans if not base]
        hit += (again, "card") in added
        wrong += sum(x != (again, "card") for x in added)
    assert hit >= 90 and wrong <= 5


def test_op7_over_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    import hashlib

    for row in QUERIES["op7_pii"](spark, sf_dir).collect():
        want = brute_spans(texts.pop(row["doc_id"]))
        written = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert row["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in want) for i in range(4)]
        assert set(written) <= set(row["spans"].split(","))
    assert not texts


def test_op7_odd_rows(odd_documents, no_documents):
    field = pii.fit_pii(odd_documents)
    found = {r["doc_id"]: r["spans"] for r in pii.pii_spans(odd_documents, field).collect()}
    assert [(s["kind"], s["base"]) for s in found[7]] == [(0, True), (1, True)]
    masked = pii.redact_documents(odd_documents, field)
    assert masked.columns == odd_documents.columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[7].startswith("Zoë wrote to [EMAIL], then [IP] <|") and texts[4] is None
    assert pii.pii_result(no_documents).count() == 0


@pytest.mark.parametrize("segment", [1, 2, 7, 64])
def test_long_chains_are_exact_whatever_their_segments(monkeypatch, segment):
    """Marginals of chains cut in segments are those of the whole chains."""
    chance = np.random.default_rng(segment)
    field = toxicity.LinearChain()
    field.move = chance.normal(0, 1.5, (2, 2))
    sizes = [1, 2, 7, 8, 64, 65, 200, 1, 513]
    starts, emission = np.cumsum(sizes) - sizes, chance.normal(0, 4, sum(sizes))
    monkeypatch.setattr(toxicity, "SEGMENT", 10**6)
    forward, backward = field.messages(emission, starts)
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    again = field.messages(emission, starts)
    assert again[0] == pytest.approx(forward, rel=1e-8) and again[1] == pytest.approx(backward, rel=1e-8)


def test_new_words_are_learnt_at_once_and_short_chains_carry_nothing(monkeypatch):
    """Parts are those of every word's features; a word is cut once, also where the memory is emptied between."""
    chance = np.random.default_rng(4)
    field = toxicity.LinearChain()
    field.own, field.left, field.right = chance.normal(0, 1, (3, toxicity.BUCKETS))
    field.move = chance.normal(0, 1, (2, 2))

    def bucket(kind, value):
        return zlib.crc32(f"{kind}{value}".encode()) & (toxicity.BUCKETS - 1)

    def brute(word):
        if word == toxicity.BREAK:
            return [-toxicity.LIMIT, 0, 0, 1]
        low = re.sub(r"^\W+|\W+$", "", word.lower())
        own = [bucket("w", low)] + [bucket(f"p{k}", low[:k]) for k in (3, 4, 5, 6) if len(low) >= k]
        own += [bucket(f"s{k}", low[-k:]) for k in (3, 4) if len(low) > k]
        return [field.own[own].sum(), field.left[own[0]], field.right[own[0]], float(word[-1] in ".!?")]

    words = ["Fine", "(so-so)", "ärgerlich!", "---", "«Olé»", "x_", "don't", "ΣΑΣ", "日本語", "a.b", "?!", "'s.", "…wait", "été,"]
    texts = [" ".join(words) + "\nagain fine.", " ".join(f"w{i}" for i in range(200)) + ". short one."]
    calls, carried = [], []
    cut, carry = toxicity.core, toxicity.LinearChain._carry
    monkeypatch.setattr(toxicity, "core", lambda w: calls.append(w) or cut(w))
    monkeypatch.setattr(toxicity.LinearChain, "_carry", staticmethod(lambda *x: carried.append(len(x[3])) or carry(*x)))
    split = [toxicity.tokens(t) for t in texts]
    tagger = toxicity.Tagger(field)
    odds, _ = tagger.marginals(split)
    for word, at in tagger.number.items():
        assert tagger.parts[:, at] == pytest.approx(brute(word)), word
    assert sorted(calls) == sorted({w for ws in split for w in ws})
    assert carried == [4]  # 200 words are four segments
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 30)
    tagger = toxicity.Tagger(field)
    for _ in range(3):
        again = np.concatenate([tagger.marginals([ws])[0] for ws in split])
        assert again == pytest.approx(odds, rel=1e-9)


def test_a_sentence_of_three_thousand_words_is_one_chain(spark):
    """Words stay linked across the 64th, and a repeated id sends a bounded number of rows to the driver."""
    chance = random.Random(9)
    plain = [f"w{i}" for i in range(300)]
    rows, known = [], []
    for i in range(120):
        words = [chance.choice(plain) for _ in range(3_000 if i == 0 else 40)]
        if i % 2 == 0:
            words[62:66] = ["vile", "nasty", "vile", "nasty"] if i == 0 else words[62:66]
            words[10:14] = ["vile", "nasty", "vile", "nasty"]
        rows.append((i, " ".join(words)))
        known.append((i, 1 - i % 2))
    rows += [(2, rows[2][1])] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    field = toxicity.fit_toxicity(docs, labels)
    spans = {r["doc_id"]: r["toxicity"]["spans"] for r in toxicity.score_toxicity(docs, field).collect()}
    text = rows[0][1]
    found = [text[s["start"] : s["end"]] for s in spans[0]]
    assert found == ["vile nasty vile nasty"] * 2
    texts = toxicity.sampled_texts(docs, labels, "toxic", 50)
    assert toxicity.bounded_rows(toxicity.sampled_sentences(texts), ["doc_id", "_label", "_hash"], 100).count() <= 100
