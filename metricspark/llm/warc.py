"""Operator 8: WARC archives as a Python data source.

Writing: a task writes its records to ``.warc.gz`` files of bounded size, one gzip
member per record, whose extra field ``sl`` holds the member's lengths. The files of
finished tasks are listed in a manifest of their own when the job commits, so what lost or
repeated attempts leave is never read, and an append adds to what is there. A folder
without a manifest, as others write it, is read by its file names.

Reading: the driver plans partitions of whole files by their sizes. Predicates on
the record type and on header columns are pushed down. A record's headers are read
first; when the predicates fail, or no payload is asked for, the rest of the member
is skipped by its length and never inflated. Archives without the extra field, and
plain ``.warc`` files, are read as well. Digests of any algorithm are read: SHA-1 as bare lower-case
hexadecimal, others with their name before it. An archive that ends within a record is an error;
with the option ``cutoff=keep`` what is whole before that is read, and a payload as far as it goes.

Pages: of records with equal payloads of at least ``LEAST_BYTES`` bytes, the one with
the largest page id is a response and the others revisit it.

Defined cases: a null html is an empty payload and a response; a null page id is
written as ``null`` and read as null, and ranks below all others; rows that share
page id and payload are all responses, or all revisits; control characters and blanks
in a URL are written as percent codes; an empty table gives an archive of no records.
"""

from __future__ import annotations

import base64
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from metricspark.llm.common import bound_batches
from metricspark.llm.wavelet import open_folder
from metricspark.session import work_path

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, content_type string, "
    "payload_digest string, payload_length long, refers_to string, headers map<string,string>, payload binary"
)
ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_id", "record_type", "target_uri", "warc_date", "content_type", "payload_digest")]
    + [("payload_length", pa.int64()), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)
# What a writer takes; the digest is lower-case hexadecimal SHA-1.
WRITE_COLUMNS = ("record_id", "record_type", "target_uri", "payload", "payload_digest", "payload_length", "refers_to")
# Fixed values of the format.
VERSION = b"WARC/1.0\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
FILE_BYTES = 64 << 20
SPLIT_BYTES = 32 << 20
LEAST_BYTES = 1000
HEAD_BYTES = 2048
MANIFEST = "_files"
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
# Bytes of each algorithm's digest.
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha256": 32, "sha384": 48, "sha512": 64}


# ---- records ----------------------------------------------------------------


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(row: dict, date: str) -> bytes:
    """A response with HTTP head and payload, or a revisit with the HTTP head alone."""
    length = row["payload_length"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {length}\r\n\r\n"
    ).encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + (row["payload"] or b"")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": row["record_id"],
        "WARC-Date": date,
        "WARC-Target-URI": _clean(row["target_uri"] or ""),
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if revisit:
        lines |= {"WARC-Refers-To": row["refers_to"], "WARC-Profile": REVISIT_PROFILE}
    lines |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes) -> bytes:
    """One gzip member with its own and the record's length in the extra field ``sl``."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    size = 24 + len(body) + 8
    fits = size < 1 << 32 and len(record) < 1 << 32
    extra = b"sl" + struct.pack("<HII", 8, size if fits else 0, len(record) if fits else 0)
    start = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return start + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class _Member:
    """A record's bytes, inflated only as far as they are asked for."""

    def __init__(self, file: io.BufferedReader):
        self.file, self.start = file, file.tell()
        first = file.read(24)
        file.seek(self.start)
        self.packed = first[:2] == b"\x1f\x8b"
        self.end = None
        if self.packed:
            self.inflate = zlib.decompressobj(31)
            if len(first) == 24 and first[3] & 4 and first[12:14] == b"sl":
                size = struct.unpack("<I", first[16:20])[0]
                self.end = self.start + size if size else None
        self.text, self.over = b"", False

    def _more(self) -> None:
        if not self.packed:
            got = self.file.read(HEAD_BYTES)
            self.over = not got
            self.text += got
            return
        at = self.file.tell()
        size = HEAD_BYTES if self.end is None else min(HEAD_BYTES, self.end - at)
        got = self.file.read(size) if size > 0 else b""
        self.text += self.inflate.decompress(got)
        if self.inflate.eof or not got:
            self.over = True
            self.file.seek(self.file.tell() - len(self.inflate.unused_data))

    def until(self, mark: bytes, since: int = 0) -> int:
        """Place behind the first ``mark``; -1 if there is none."""
        while (at := self.text.find(mark, since)) < 0:
            if self.over:
                return -1
            self._more()
        return at + len(mark)

    def bytes(self, since: int, size: int) -> bytes:
        parts, have = [self.text], len(self.text)
        while have < since + size and not self.over:
            if self.packed and self.end is not None:
                got = self.file.read(self.end - self.file.tell())
                parts.append(self.inflate.decompress(got))
                self.over = True
            elif self.packed:
                self.text = b""
                self._more()
                parts.append(self.text)
            else:
                got = self.file.read(since + size - have)
                parts.append(got)
                self.over = not got
            have += len(parts[-1])
        self.text = b"".join(parts)
        return self.text[since : since + size]

    def close(self, since: int, size: int) -> None:
        """To the next record; ``since`` and ``size`` place the block in a plain file."""
        if not self.packed:
            self.file.seek(self.start + since + size + 4)
        elif self.end is not None:
            self.file.seek(self.end)
        else:
            while not self.over:
                self.text = b""
                self._more()


class CutOffError(ValueError):
    """An archive ends within a record."""


def read_digest(said: str | None) -> str | None:
    """Hexadecimal of a digest header, base 32 or 16; other algorithms than SHA-1 stay named."""
    if not said:
        return None
    algorithm, found, value = said.strip().partition(":")
    algorithm, value = (algorithm.lower(), value) if found else ("sha1", algorithm)
    size = DIGEST_BYTES.get(algorithm)
    if size and re.fullmatch(rf"[0-9a-fA-F]{{{2 * size}}}", value):
        value = value.lower()
    elif size:
        try:
            raw = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
            value = raw.hex() if len(raw) == size else value
        except ValueError:  # some other form, kept as it is
            pass
    return value if algorithm == "sha1" else f"{algorithm}:{value}"


def read_records(
    file: io.BufferedReader, wanted: Callable[[dict], bool], payload: bool, keep_cut: bool = False, all_headers: bool = True
) -> Iterator[dict]:
    """Records whose columns are ``wanted``; nothing is inflated beyond what is asked for."""
    size_of_file = file.seek(0, io.SEEK_END)
    file.seek(0)

    def cut(record: _Member) -> None:
        if not keep_cut:
            raise CutOffError(f"the archive ends within the record at byte {record.start}")

    while file.peek(1):
        record = _Member(file)
        try:
            end = record.until(b"\r\n\r\n")
        except zlib.error:
            end = -1
        if end < 0:
            if record.packed or record.text.strip():  # blank lines may end a plain file
                cut(record)
            return
        lines = record.text[:end].decode(errors="replace").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        size = int(headers.get("Content-Length", 0))
        row = {
            "record_id": headers.get("WARC-Record-ID"),
            "record_type": headers.get("WARC-Type"),
            "target_uri": headers.get("WARC-Target-URI"),
            "warc_date": headers.get("WARC-Date"),
            "content_type": headers.get("Content-Type"),
            "payload_digest": read_digest(headers.get("WARC-Payload-Digest")),
            "payload_length": None,
            "refers_to": headers.get("WARC-Refers-To"),
            "headers": headers if all_headers else None,
            "payload": None,
        }
        if wanted(row):
            http = 0
            if (row["content_type"] or "").startswith("application/http"):
                http = max(record.until(b"\r\n\r\n", end) - end, 0)
                said = re.search(rb"(?i)\r\ncontent-length: *(\d+)", record.text[end : end + http])
                row["payload_length"] = int(said[1]) if said else None
            if payload and row["record_type"] != "revisit":
                block = record.bytes(end, size)
                if len(block) < size:
                    cut(record)
                row["payload"] = block[http:]
            if row["payload_length"] is None:
                row["payload_length"] = size - http
            yield row
        if not record.packed and record.start + end + size > size_of_file or record.packed and (record.end or 0) > size_of_file:
            cut(record)
            return
        record.close(end, size)


# ---- the data source --------------------------------------------------------


@dataclass
class _Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class _Written(WriterCommitMessage):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.headers = str(options.get("headers", "true")).lower() == "true"
        self.keep_cut = str(options.get("cutoff", "error")).lower() == "keep"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        headers = {"record_id", "record_type", "target_uri", "warc_date", "content_type", "payload_digest", "refers_to"}
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kind = {EqualTo: "eq", In: "in", StringStartsWith: "starts", IsNotNull: "known"}.get(type(f))
            if column in headers and kind:
                self.tests.append((column, kind, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        """Whole files, small ones together; the driver sees names and sizes only."""
        files, root = open_folder(self.folder)
        found = files.get_file_info(pafs.FileSelector(root, recursive=False))
        names = []
        for info in sorted((i for i in found if i.base_name.startswith(MANIFEST)), key=lambda i: i.base_name):
            with files.open_input_stream(info.path) as listed:
                names += json.loads(listed.read())
        if not any(i.base_name.startswith(MANIFEST) for i in found):
            names = sorted((i.base_name, i.size) for i in found if re.search(r"\.warc(\.gz)?$", i.base_name))
        groups, size = [[]], 0
        for name, length in names:
            if size and size + length > self.split:
                groups.append([])
                size = 0
            groups[-1].append(f"{root}/{name}")
            size += length
        return [_Files(tuple(g)) for g in groups]

    def _wanted(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            have = row[column]
            if have is None:
                return False
            if (kind == "eq" and have != value) or (kind == "in" and have not in value):
                return False
            if kind == "starts" and not have.startswith(value):
                return False
        return True

    def read(self, partition):
        files, _ = open_folder(self.folder)
        for path in partition.paths:
            with files.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 18) as file:
                held, size = [], 0
                for row in read_records(file, self._wanted, self.payload, self.keep_cut, self.headers):
                    held.append(row)
                    size += len(row["payload"] or b"")
                    if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=ARROW)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool = False):
        self.folder, self.overwrite = options["path"], overwrite
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.most = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, root = open_folder(self.folder)
        files.create_dir(root, recursive=True)
        attempt, done, out, size = uuid.uuid4().hex, [], None, 0

        def close():
            out.close()
            done.append((name, size))

        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{attempt}-{len(done):05d}.warc.gz"
                    out, size = files.open_output_stream(f"{root}/{name}", compression=None), 0
                member = gzip_member(build_record(row, self.date))
                out.write(member)
                size += len(member)
                if size >= self.most:
                    close()
                    out = None
        if out is not None:
            close()
        return _Written(tuple(done))

    def commit(self, messages):
        files, root = open_folder(self.folder)
        files.create_dir(root, recursive=True)
        names = [file for m in messages if m for file in m.paths]
        before = files.get_file_info(pafs.FileSelector(root, recursive=False))
        with files.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())
        if self.overwrite:
            for info in before:
                if info.base_name.startswith(MANIFEST):
                    files.delete_file(info.path)

    def abort(self, messages):
        """Files without a manifest entry are never read; nothing to undo."""


class WarcDataSource(DataSource):
    """``format("warc")``: options path, payload, headers, cutoff, splitBytes; date and fileBytes to write."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ---- pages ------------------------------------------------------------------

# A digest with at least this share of the rows counts as hot: there are at most 1,000.
HOT_SHARE = 0.001


def page_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """A record per page, in the writer's columns, equal payloads resolved.

    Digests that many pages share are few by their definition and are broadcast; a
    page that got its answer there takes a place of its own in the join of the rest.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.select("*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_length"))
    large = own.where(F.col("payload_length") >= least_bytes)
    groups = large.groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    groups = groups.where(F.col("rows") > 1)
    rows = pages.count()
    is_hot = F.col("rows") >= F.lit(max(2.0, rows * HOT_SHARE))
    hot = groups.where(is_hot).select(F.col("payload_digest").alias("_hot"), F.col("first").alias("_hot_first"))
    cold = groups.where(~is_hot).select(F.col("payload_digest").alias("_cold"), F.col("first").alias("_cold_first"))
    met = own.join(F.broadcast(hot), F.col("payload_digest") == F.col("_hot"), "left")
    met = met.withColumn(
        "_key", F.when(F.col("_hot").isNull(), F.col("payload_digest")).otherwise(F.concat(F.lit("-"), F.col("page_id")))
    )
    met = met.join(cold, F.col("_key") == F.col("_cold"), "left")
    first = F.coalesce("_hot_first", "_cold_first")
    revisit = F.coalesce(~first.eqNullSafe(F.col("page_id")), F.lit(False)) & first.isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return met.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_digest",
        "payload_length",
        F.when(revisit, urn(first)).alias("refers_to"),
    )


def write_warc(records: DataFrame, folder: str) -> None:
    bound_batches(records.sparkSession)
    register(records.sparkSession)
    records.select(*WRITE_COLUMNS).write.format("warc").option("path", folder).mode("append").save()


def read_warc(spark: SparkSession, folder: str, payload: bool = True, headers: bool = True, keep_cut: bool = False) -> DataFrame:
    """The records of a folder; ``headers`` is the map of all of them, null where it is not asked for."""
    register(spark)
    reader = spark.read.format("warc").option("path", folder).option("cutoff", "keep" if keep_cut else "error")
    return reader.option("payload", str(payload).lower()).option("headers", str(headers).lower()).load()


def warc_result(pages: DataFrame) -> DataFrame:
    """Writes the pages, then reads responses with their payloads and revisits by headers."""
    spark = pages.sparkSession
    folder = work_path(spark, "warc")
    write_warc(page_records(pages), folder)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) as bigint)")
    responses = read_warc(spark, folder, headers=False).where(F.col("record_type") == "response")
    revisits = read_warc(spark, folder, payload=False, headers=False).where(F.col("record_type") == "revisit")
    return responses.select(
        page("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(
            page("record_id").alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            "payload_digest",
            "record_type",
            page("refers_to").alias("refers_to"),
        )
    )
