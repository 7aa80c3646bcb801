"""Operators 8 and 10, and the pipeline."""

import collections
import gzip
import hashlib
import io
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from metricspark.llm import mixing, warc
from metricspark.llm.queries import ORACLE_SQL, QUERIES
from metricspark.session import work_path

TABLES = ("documents", "pages", "embeddings")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    want = collections.Counter(con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall())
    assert collections.Counter(tuple(r) for r in df.collect()) == want


# ---- archives ---------------------------------------------------------------


@pytest.fixture()
def archive(spark, tmp_path):
    large = "payload " * 200
    rows = [(1, "http://a/ b\r\nX: y", large), (2, None, large), (3, "u", large + "é"), (4, "u", "small"), (5, "u", "small")]
    rows += [(6, "u", None), (None, "u", large), (7, "v", ""), (2, None, large)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = work_path(spark, "test-warc")
    warc.write_warc(warc.page_records(pages), folder)
    return pages, folder, large


def test_archive_round_trip(spark, archive):
    pages, folder, large = archive
    got = collections.Counter(tuple(r) for r in warc.warc_result(pages).collect())
    digest = lambda t: hashlib.sha1(t.encode()).hexdigest()
    size = len(large.encode())
    want = collections.Counter(
        [
            (1, size, digest(large), "revisit", 2), (None, size, digest(large), "revisit", 2),
            (3, size + 2, digest(large + "é"), "response", None), (4, 5, digest("small"), "response", None),
            (5, 5, digest("small"), "response", None), (6, 0, digest(""), "response", None), (7, 0, digest(""), "response", None),
        ]
    )
    want[2, size, digest(large), "response", None] = 2
    assert got == want
    records = warc.read_warc(spark, folder).collect()
    assert {r["target_uri"] for r in records} == {"http://a/%20b%0D%0AX:%20y", "", "u", "v"}
    assert warc.warc_result(pages.limit(0)).count() == 0


def test_predicates_are_pushed(spark, archive):
    _, folder, _ = archive
    df = warc.read_warc(spark, folder, payload=False).where(
        (F.col("record_type") == "response") & F.col("target_uri").startswith("u")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in plan
    rows = df.collect()
    assert {r["record_id"] for r in rows} == {f"<urn:page:{i}>" for i in (3, 4, 5, 6)}
    assert all(r["payload"] is None for r in rows)
    assert warc.read_warc(spark, folder).where("payload_length > 1600").count() > 0


def test_unwanted_payloads_are_not_inflated():
    body = os.urandom(300_000)
    row = dict(record_id="<a>", record_type="response", target_uri="u", payload=body, payload_digest=hashlib.sha1(body).hexdigest(), payload_length=len(body), refers_to=None)
    data = b"".join(warc.gzip_member(warc.build_record(row | {"record_id": f"<{i}>"}, "d")) for i in range(4))
    assert gzip.decompress(data).count(b"WARC/1.0\r\n") == 4

    class Counted(io.BytesIO):
        taken = 0

        def readinto(self, b):
            n = super().readinto(b)
            self.taken += n
            return n

    for wanted, payload in ((lambda r: False, True), (lambda r: True, False)):
        raw = Counted(data)
        rows = list(warc.read_records(io.BufferedReader(raw, 4096), wanted, payload))
        assert len(rows) == (0 if payload else 4) and raw.taken < 100_000
    whole = list(warc.read_records(io.BufferedReader(io.BytesIO(data)), lambda r: True, True))
    assert [r["payload"] for r in whole] == [body] * 4


def test_other_archives_are_read():
    rows = [dict(record_id=f"<{i}>", record_type="response", target_uri="u", payload=b"x\r\n\r\ny" * i, payload_digest="00" * 20, payload_length=6 * i, refers_to=None) for i in (0, 1, 5000)]
    records = [warc.build_record(r, "d") for r in rows]
    for data in (b"".join(records), b"".join(map(gzip.compress, records))):  # plain; members without lengths
        for payload in (True, False):
            got = list(warc.read_records(io.BufferedReader(io.BytesIO(data)), lambda r: True, payload))
            assert [r["payload_length"] for r in got] == [0, 6, 30_000]
            assert [r["payload"] for r in got] == [r["payload"] if payload else None for r in rows]


# ---- mixing -----------------------------------------------------------------


def brute_targets(sizes):
    """Shares by weight, the excess of the full ones dealt out again until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        full = {n for n in open_ if share[n] > 2 * sizes[n]}
        if not full:
            return target | share
        for n in full:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
        open_ -= full
    return target


def check_mix(rows):
    sizes = collections.defaultdict(int)
    taken = collections.defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 2
    want = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for source, words in taken.items():
        largest = max(r["size"] for r in rows if r["source"] == source)
        assert abs(words - want[source]) <= largest / 2 + 1e-6


def test_mix_reaches_targets(spark, sf_dir, odd_documents, no_documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    check_mix(rows)
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(7)).collect())
    check_mix(mixing.mix(odd_documents).collect())
    assert mixing.mix_result(no_documents).count() == 0


def test_appends_add_to_an_archive(spark):
    folder = work_path(spark, "append-warc")
    schema = "page_id long, url string, html string, PAYLOAD string, record_type int"
    for start in (0, 2):
        pages = spark.createDataFrame([(i, f"http://x/{i}", "p" * (900 + 200 * i), "kept", 5) for i in (start, start + 1)], schema)
        warc.write_warc(warc.page_records(pages), folder)
    assert sorted(r["record_id"] for r in warc.read_warc(spark, folder).collect()) == [f"<urn:page:{i}>" for i in range(4)]
    records = warc.page_records(pages.limit(1)).select(*warc.WRITE_COLUMNS)
    records.write.format("warc").option("path", folder).mode("overwrite").save()
    assert warc.read_warc(spark, folder, headers=False).select("headers").collect() == [(None,)]


@pytest.mark.parametrize(
    "said, want",
    [
        ("sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ", "da39a3ee5e6b4b0d3255bfef95601890afd80709"),
        ("SHA1:da39a3ee5e6b4b0d3255bfef95601890afd80709", "da39a3ee5e6b4b0d3255bfef95601890afd80709"),
        ("3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ", "da39a3ee5e6b4b0d3255bfef95601890afd80709"),
        ("sha256:" + "0A" * 32, "sha256:" + "0a" * 32),
        ("md5:2QOYZWMPACZAJ2MABGMOZ6CCPY", "md5:d41d8cd98f00b204e9800998ecf8427e"),
        ("sha1:not a digest!", "not a digest!"),
        ("blake3:xyz", "blake3:xyz"),
        ("", None),
        (None, None),
    ],
)
def test_digests_of_other_archives(said, want):
    assert warc.read_digest(said) == want


@pytest.mark.parametrize("packed", [True, False])
def test_cut_off_archives_are_an_error_or_kept(packed):
    row = {"record_type": "response", "target_uri": "u", "payload": b"x" * 300, "payload_digest": "00" * 20, "payload_length": 300, "refers_to": None}
    one = warc.build_record(row | {"record_id": "<0>"}, "d")
    member = warc.gzip_member(one) if packed else one
    for payload in (True, False):
        for cut in (len(member) - 20 if packed else len(one) - 100, 30):
            data = member + member[:cut]
            with pytest.raises(warc.CutOffError):
                list(warc.read_records(io.BufferedReader(io.BytesIO(data)), lambda r: True, payload))
            kept = list(warc.read_records(io.BufferedReader(io.BytesIO(data)), lambda r: True, payload, keep_cut=True))
            assert 1 <= len(kept) <= 2 and kept[0]["payload"] == (b"x" * 300 if payload else None)
        whole = list(warc.read_records(io.BufferedReader(io.BytesIO(member * 3)), lambda r: False, payload))
        assert whole == []


def test_folders_without_a_manifest_are_read_by_name(spark, tmp_path):
    row = {"record_type": "response", "target_uri": "u", "payload": b"abc", "payload_digest": "00" * 20, "payload_length": 3, "refers_to": None}
    (tmp_path / "a.warc").write_bytes(warc.build_record(row | {"record_id": "<1>"}, "d"))
    (tmp_path / "b.warc.gz").write_bytes(warc.gzip_member(warc.build_record(row | {"record_id": "<2>"}, "d")))
    (tmp_path / "notes.txt").write_text("no archive")
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r["record_id"], bytes(r["payload"])) for r in got) == [("<1>", b"abc"), ("<2>", b"abc")]


def test_mix_uses_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df in (mixing.mix_result(docs), mixing.mixed_documents(docs), mixing._keyed(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mixed_documents_repeat_whole_rows(odd_documents, no_documents):
    want = collections.Counter()
    for r in mixing.mix(odd_documents).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    mixed = mixing.mixed_documents(odd_documents)
    assert mixed.columns == odd_documents.columns
    sized = mixed.select("doc_id", "source", mixing.word_count().alias("size")).collect()
    assert collections.Counter(tuple(r) for r in sized) == +want
    assert mixing.mixed_documents(no_documents).count() == 0


def test_mix_of_null_and_repeated_ids(spark):
    """Nine rows in ten without an id; equal rows are split where the budget ends among them."""
    rows = [(None if i % 10 else i, " ".join(["w"] * (1 + i % 7)) + f" {i % 40}", "ab"[i % 2]) for i in range(400)]
    rows += [(7, "one two three four", "b")] * 3000 + [(8, "x", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    keys = mixing._keyed(docs)
    assert keys.count() < 403 and keys.agg({"rows": "sum"}).first()[0] == 3401
    assert keys.where("doc_id is null").select("mix_key").distinct().count() > 100
    counted = mixing.mix(docs).collect()
    assert len(counted) == 3401
    want, taken, target = collections.Counter(), collections.Counter(), {}
    for r in counted:
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 4 for s in target)
    # source b is mostly equal rows: they are taken once, and some of them once more
    assert {r["copies"] for r in counted if r["doc_id"] == 7} == {1, 2}
    mixed = mixing.mixed_documents(docs).select("doc_id", "source", mixing.word_count().alias("size")).collect()
    assert collections.Counter(tuple(r) for r in mixed) == +want


# ---- the pipeline -----------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline
    from metricspark.llm import jaccard, pii, quality

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "encode"]
    for name, stage in corpus_pipeline.STAGES:
        path = work_path(spark, f"test-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        before, after = docs.collect(), out.collect()
        if name != "encode":
            assert out.columns == columns
        if name == "quality":
            model = quality.fit_quality(docs, quality.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
            scores = quality.score_quality(docs, model).collect()
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in scores if r["score"] >= 0.7}
        elif name == "near_duplicates":
            groups = {r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
            assert {r["doc_id"] for r in after} == groups and len(after) == len(groups)
        elif name == "personal_data":
            assert len(after) == len(before) and not any(pii.base_spans(r["text"] or "") for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] is not None)
        elif name == "mix":
            kept = {tuple(r) for r in before}
            assert all(tuple(r) in kept for r in after)
        else:
            assert len(after) == len(before)
        docs = out


def test_pipeline_keeps_unrelated_texts_of_one_id(spark):
    import corpus_pipeline

    texts = [" ".join(f"{c}{i}" for i in range(20)) for c in "abcz"]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (7, texts[1] + " more"), (8, texts[0]), (6, texts[3]), (7, texts[3]), (7, ""), (None, texts[0])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string")
    got = [(r["doc_id"], (r["text"] or "").split(" ")[0]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(7, "a0"), (7, "b0"), (6, "z0"), (7, ""), (None, "a0")], key=str)


def test_pipeline_on_odd_rows(spark, odd_documents, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES:
        if name == "quality":  # its threshold would leave few of these rows
            stage(spark, docs, str(tmp_path)).collect()
            continue
        path = work_path(spark, f"odd-{name}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() > 0
