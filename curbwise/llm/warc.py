"""WARC archives: writing with payload de-duplication, and a Python data source that reads them.

Files are gzip members, one record each. A member's gzip header carries an
extra field ("sl", skip length) with the member's size, so a reader that does
not want a record goes to the next one without inflating it; a member without
the field is inflated to find its end.

``WarcSource`` (format "warc") plans one partition per group of files, or per
byte range of a file whose ``.idx`` list of member offsets is beside it. For each
record the headers are inflated first (a bounded read); record-type and header
predicates are tested on them, and the payload is inflated only when it is
asked for and the record passed. Predicates arrive either as options
(``types``, ``header.<name>``) or as Spark filters on ``record_type``,
``record_id`` and ``target_uri`` where the session allows pushdown for Python
sources.

Duplicates: of records with equal payloads of at least ``min_payload`` bytes
the one with the largest page_id is the response and the others become revisit
records that name it; a group is counted by digest in the map tasks first, and
a hot payload meets its group row in a join whose large side Spark can split.

Cases: null html is an empty payload; null url has no target header; control
characters of a url are percent-encoded; rows that repeat the largest page_id
with the same payload are all responses; a null page_id is the response only
where its whole group has none; an empty table gives an archive without page
records and an empty result; further columns are ignored; very long urls and
payloads come back whole, one record of a file in memory at a time beyond a batch
of ``BATCH_BYTES``. A path without a scheme is one on Spark's default file system.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    StringStartsWith, WriterCommitMessage)

from curbwise.llm.common import ship

EOL = b"\r\n"
HEAD_BYTES = 16 << 10
READ_BYTES = 1 << 20
PART_BYTES = 64 << 20
ROWS = 500
BATCH_BYTES = 16 << 20
RECORD = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, headers map<string,string>, payload binary, file string, offset long")
_URN = "urn:page:"
#: Fixed value: the date of every record, so that reruns give the same bytes.
_DATE = datetime.datetime(2024, 1, 1).strftime("%Y-%m-%dT%H:%M:%SZ")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(path: str):
    """(filesystem, path) for a plain path or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


def on_default(path: str, default: str) -> str:
    """A path without a scheme on Spark's default file system, which executors must not take for their own disk."""
    if re.match(r"\w[\w+.-]*:/", path) or default.startswith("file:"):
        return path
    if not path.startswith("/"):
        raise ValueError(f"{path!r}: a path on {default} must be absolute")
    return default.rstrip("/") + path


def resolved(spark: SparkSession, path: str) -> str:
    """``path`` as Spark's own readers and writers understand it."""
    return on_default(path, spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///"))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ------------------------------------------------------------------------------------

def member(record: bytes, level: int = 4) -> bytes:
    """One gzip member with its own size in the "sl" extra field."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = pack.compress(record) + pack.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<HccHQ", 12, b"s", b"l", 8, size)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _header_block(fields: list[tuple[str, str | None]]) -> bytes:
    return EOL.join([b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields if v is not None)]) + EOL * 2


def _safe(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, n: int, digest: str, response: bool, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK" + EOL + b"Content-Type: text/html; charset=utf-8" + EOL + f"Content-Length: {n}".encode() + EOL * 2
    block = http + (payload if response else b"")
    name = lambda i: f"<{_URN}{'' if i is None else i}>"
    return _header_block([
        ("WARC-Type", "response" if response else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", _DATE),
        ("WARC-Target-URI", _safe(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", None if response else name(refers_to)), ("WARC-Profile", None if response else _PROFILE),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]) + block + EOL * 2


def info_bytes() -> bytes:
    body = b"software: corpus archive writer" + EOL
    return _header_block([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:info:0>"), ("WARC-Date", _DATE),
                          ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(body)))]) + body + EOL * 2


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(EOL)[1:]:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        if k:
            out[k.strip().lower()] = v.strip()
    return out


def _heads_whole(text: bytes) -> bool:
    """Whether the start of a record holds its headers and, for a response, those of HTTP."""
    cut = text.find(EOL * 2)
    return cut >= 0 and (b"msgtype=response" not in text[:cut] or text.find(EOL * 2, cut + 4) >= 0)


# --- data source --------------------------------------------------------------------------------

@dataclass
class Span(InputPartition):
    """Byte ranges (file, first, end) read by one task."""

    ranges: list[tuple[str, int, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.part_bytes = int(options.get("partbytes", PART_BYTES))
        self.types = set(filter(None, options.get("types", "").split(","))) or None
        self.want_payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.equal = {k[7:].lower(): {v} for k, v in options.items() if k.lower().startswith("header.")}
        self.prefix: dict[str, str] = {}

    #: Columns whose predicates can be told from the headers.
    HEADERS = {"record_id": "warc-record-id", "target_uri": "warc-target-uri"}

    def pushFilters(self, filters: list) -> Iterator:
        """Takes equality, membership and prefix tests on the header columns; the rest stays with Spark."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if name == "record_type" and values is not None:
                self.types = values if self.types is None else self.types & values
            elif name in self.HEADERS and values is not None:
                key = self.HEADERS[name]
                self.equal[key] = values & self.equal.get(key, values)
            elif name in self.HEADERS and isinstance(f, StringStartsWith) and self.HEADERS[name] not in self.prefix:
                self.prefix[self.HEADERS[name]] = f.value
            else:
                yield f

    def partitions(self) -> list[Span]:
        from pyarrow import fs

        store, top = filesystem(self.path)
        files = sorted((x for x in store.get_file_info(fs.FileSelector(top, allow_not_found=True)) if x.path.endswith(".warc.gz")),
                       key=lambda x: x.path)
        spans, room = [Span([])], self.part_bytes
        for f in files:
            cuts = [0, f.size]
            if f.size > self.part_bytes:  # member offsets, if the writer left them
                index = store.get_file_info(f.path + ".idx")
                if index.type == fs.FileType.File:
                    offsets = list(map(int, store.open_input_stream(index.path).read().split()))
                    cuts, last = [0], 0
                    for o in offsets:
                        if o - last >= self.part_bytes:
                            cuts.append(last := o)
                    cuts.append(f.size)
            for a, b in zip(cuts, cuts[1:]):
                if spans[-1].ranges and b - a > room:
                    spans.append(Span([]))
                    room = self.part_bytes
                spans[-1].ranges.append((f.path, a, b))
                room -= b - a
        return [s for s in spans if s.ranges] or [Span([])]

    def wanted(self, head: dict[str, str]) -> bool:
        if self.types is not None and head.get("warc-type") not in self.types:
            return False
        return (all(head.get(k) in v for k, v in self.equal.items())
                and all((head.get(k) or "").startswith(v) for k, v in self.prefix.items()))

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        schema = _arrow_schema()
        rows: list[tuple] = []
        held = 0
        for path, first, end in partition.ranges:
            with store.open_input_file(path) as f:
                for row in self._records(f, path, first, end):
                    rows.append(row)
                    held += len(row[7] or b"")
                    if len(rows) == ROWS or held >= BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    def _records(self, f, path: str, at: int, end: int) -> Iterator[tuple]:
        window = Window(f)
        while at < end:
            data = window.get(at, HEAD_BYTES)
            size = struct.unpack_from("<Q", data, 16)[0] if data[3] == 4 and data[12:14] == b"sl" else None
            if size is None:
                text, size = window.inflated(at)
            else:
                text = zlib.decompressobj(31).decompress(data[:size], HEAD_BYTES)
                if not _heads_whole(text):  # longer headers than the bounded read holds
                    text, _ = window.inflated(at)
            cut = text.index(EOL * 2)
            head = _fields(text[:cut])
            if self.wanted(head):
                block = None
                if (self.want_payload or self.verify) and head.get("warc-type") == "response":
                    block = zlib.decompress(window.get(at, size)[:size], 31)[cut + 4:][:int(head["content-length"])]
                yield self._row(head, block, text[cut + 4:], path, at)
            at += size

    def _row(self, head: dict[str, str], block: bytes | None, begun: bytes, path: str, at: int) -> tuple:
        digest = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
        payload, n = None, None
        if "msgtype=response" in head.get("content-type", ""):
            http = begun[:begun.index(EOL * 2) + 2]
            n = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
            if block is not None:
                payload = block[len(http) + 2:]
                if self.verify and (len(payload) != n or base32_sha1(payload) != digest):
                    raise ValueError(f"{path}, offset {at}: the payload is not the one its headers name")
        return (head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-refers-to"), digest,
                n, list(head.items()), payload if self.want_payload else None, path, at)


class Window:
    """A file read in long pieces; bytes already held are not read again."""

    def __init__(self, f):
        self._f, self._at, self._held = f, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at`` on, fewer at the end of the file."""
        lead = at - self._at
        if not 0 <= lead <= lead + n <= len(self._held):
            self._f.seek(at)
            self._at, self._held, lead = at, self._f.read(max(n, READ_BYTES)), 0
        return self._held[lead:lead + n]

    def inflated(self, at: int) -> tuple[bytes, int]:
        """The record of the member at ``at``, and the member's size."""
        n = HEAD_BYTES
        while True:
            data = self.get(at, n)
            inflate = zlib.decompressobj(31)
            text = inflate.decompress(data)
            if inflate.eof:
                return text, len(data) - len(inflate.unused_data)
            if len(data) < n:
                raise EOFError(f"the member at {at} is cut off")
            n *= 4


class WarcWriter(DataSourceArrowWriter):
    """One file per task under a name of its own; those of failed attempts are removed, the others renamed at the end."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, top = filesystem(self.path)
        store.create_dir(top, recursive=True)
        name = f"{top}/.{uuid.uuid4().hex}.tmp"
        offsets, at, any_rows = [], 0, False
        with store.open_output_stream(name) as out:
            def put(record: bytes) -> None:
                nonlocal at
                data = member(record)
                out.write(data)
                offsets.append(at)
                at += len(data)

            put(info_bytes())
            for batch in iterator:
                for row in batch.to_pylist():
                    any_rows = True
                    put(record_bytes(row["page_id"], row["url"], row["payload"], row["payload_bytes"],
                                     base64.b32encode(bytes.fromhex(row["payload_digest"])).decode(),
                                     row["is_response"], row["refers_to"]))
        if not any_rows:
            store.delete_file(name)
            return Written(None)
        with store.open_output_stream(f"{name}.idx") as out:
            out.write("\n".join(map(str, offsets)).encode())
        return Written(name)

    def commit(self, messages: list) -> None:
        store, top = filesystem(self.path)
        store.create_dir(top, recursive=True)
        for i, m in enumerate(sorted(m.name for m in messages if m is not None and m.name)):
            store.move(f"{m}.idx", f"{top}/part-{i:06d}.warc.gz.idx")
            store.move(m, f"{top}/part-{i:06d}.warc.gz")

    def abort(self, messages: list) -> None:
        store, _ = filesystem(self.path)
        for m in messages:
            if m is not None and m.name:
                for f in (m.name, f"{m.name}.idx"):
                    store.delete_file(f)


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def _arrow_schema() -> pa.Schema:
    text, big = pa.string(), pa.int64()
    return pa.schema([("record_type", text), ("record_id", text), ("target_uri", text), ("refers_to", text),
                      ("payload_digest", text), ("payload_bytes", big), ("headers", pa.map_(text, text)),
                      ("payload", pa.binary()), ("file", text), ("offset", big)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# --- jobs ---------------------------------------------------------------------------------------

def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets Spark push filters down to it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def with_roles(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url", min_payload: int = 0) -> DataFrame:
    """What the writer takes (digest in hex): each page as a response or a revisit of the largest page_id with its payload."""
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    groups = (rows.filter(F.col("payload_bytes") >= min_payload).groupBy("sha1").agg(F.max("page_id").alias("kept"))
              .select(F.col("sha1").alias("g"), "kept", F.lit(True).alias("grouped")))
    got = rows.join(groups, rows["sha1"] == groups["g"], "left")
    first = F.col("grouped").isNull() | F.col("page_id").eqNullSafe(F.col("kept"))
    got = got.withColumn("is_response", first)
    return got.select("page_id", "url", F.when(first, F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "payload_bytes",
                      F.col("sha1").alias("payload_digest"), F.when(~first, F.col("kept")).alias("refers_to"), "is_response")


def write_archive(pages: DataFrame, path: str, **options) -> str:
    """Writes a record per page under ``path`` and returns it."""
    register(pages.sparkSession)
    with_roles(pages, **options).write.format("warc").mode("append").save(resolved(pages.sparkSession, path))
    return path


def read_archive(spark: SparkSession, path: str, types: tuple[str, ...] = (), payload: bool = True, verify: bool = False,
                 **headers: str) -> DataFrame:
    """Records under ``path``; ``types`` and header values are tested before any payload is inflated.

    ``verify`` compares each response's payload with the digest and length of its headers and raises if they differ.
    """
    register(spark)
    reader = spark.read.format("warc").option("types", ",".join(types)).option("payload", str(payload).lower()).option(
        "verify", str(verify).lower())
    for name, value in headers.items():
        reader = reader.option(f"header.{name.replace('_', '-')}", value)
    return reader.load(resolved(spark, path))


def page_of(record_id: str) -> Column:
    """The page_id in a record id column."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
