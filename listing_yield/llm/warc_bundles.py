"""WARC archives in seekable Zstandard bundles: write, read back, and fetch single records.

A bundle is one file. Records are grouped into frames of about ``FRAME_BYTES``, each compressed on its own. Behind them
stand two skippable frames, which decoders pass over, so that a bundle decompresses to a plain WARC file:

* the index: record identifier, frame, offset in the decompressed frame, length;
* the seek table of the public seekable format: compressed and decompressed size of every frame, then a footer with the
  number of frames and the closing magic number.

A reader finds a record from the end of the file: footer, seek table, index, and then decompresses one frame.

Bundles are written by Spark's own text sink, so they are committed like any other output and land in any file system
that Spark writes to: one row is one bundle without its last four bytes, one row goes to each file, and the sink's line
separator is the seek table's closing magic number. A task holds one bundle (``BUNDLE_BYTES``, or one longer record).

Records with equal payloads of at least ``LEAST`` bytes are written once: that with the largest page_id is a response,
the others are revisits that name it. Equal payloads are found by SHA-1 and length in an aggregate that combines on the
map side, so a payload that a third of the rows share is no hot group; pages meet the repeated digests by a broadcast
up to ``BROADCAST_ROWS`` of them, else the ``HOT`` most frequent by a broadcast and the others by a shuffle.

Defined cases: a null html is an empty payload; a null url leaves the target out; control characters, spaces and
non-ASCII characters of a url are percent-encoded in the target; null page_ids take part but are never the largest
(without any other, all are responses); repeated rows are each written, and all with a group's largest page_id are
responses of one identifier; long texts are a frame, or a bundle, of their own; an empty table gives no bundle and
no records; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, read_table

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 16 << 20
LEAST = 1000
BROADCAST_ROWS = 200_000
HOT = 1000
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time

# fixed values of the public formats
SKIPPABLE_INDEX = 0x184D2A51
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("record_id string, record_type string, page_id long, target_uri string, payload_digest string, "
           "payload_bytes long, refers_to string, bundle string, frame int, offset long, length long")


# ---------------------------------------------------------------- what to write

def plan_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, payload_digest, payload_bytes, record_type, refers_to: one row for each page."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    base = base.withColumn("payload_digest", F.sha1("html")).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    key = ["payload_digest", "payload_bytes"]
    repeated = materialize(base.where(F.col("payload_bytes") >= least).groupBy(*key)
                           .agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("first"))
                           .where("copies > 1 and first is not null"), "repeated")
    if repeated.count() <= BROADCAST_ROWS:
        joined = base.join(F.broadcast(repeated), key, "left")
    else:
        hot = materialize(repeated.orderBy(F.desc("copies"), "payload_digest").limit(HOT), "repeated-hot")
        mine = base.join(F.broadcast(hot.select(*key, F.col("first").alias("hot"))), key, "left")
        # rows that have their answer are dealt evenly, so they can't meet in one task
        mine = mine.withColumn("at", F.when(F.col("hot").isNotNull(), F.hex(F.xxhash64("page_id", "url")))
                               .otherwise(F.col("payload_digest")))
        rest = repeated.select(F.col("payload_digest").alias("at"), "payload_bytes", F.col("first").alias("other"))
        joined = mine.join(rest, ["at", "payload_bytes"], "left").withColumn("first", F.coalesce("hot", "other"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", *key,
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("first")).alias("refers_to"))


# ---------------------------------------------------------------- records and bundles as bytes

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_of(identifier: str | None) -> int | None:
    """The page_id that an identifier names."""
    page = identifier.split(":")[2] if identifier else ""
    return int(page) if page else None


def record_bytes(page_id, url, payload: bytes, digest: str, size: int, kind: str, refers_to, date: str = DATE) -> bytes:
    block = b""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(0x21, 0x7F))))))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "response":
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
        fields.append(("Content-Type", "application/http; msgtype=response"))
    else:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Payload-Length", size)]
    fields.append(("Content-Length", len(block)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("ascii") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; an answer whose digest isn't its payload's is an error."""
    end = data.index(b"\r\n\r\n")
    first, *lines = data[:end].decode("ascii").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) for line in lines)
    block = data[end + 4: end + 4 + int(fields["Content-Length"])]
    if fields["WARC-Type"] != "response":
        return fields, b""
    payload = block[block.index(b"\r\n\r\n") + 4:]
    if "sha1:" + hashlib.sha1(payload).hexdigest() != fields["WARC-Payload-Digest"]:
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return fields, payload


class Bundle:
    """A bundle in the making: ``add`` records, ``finish`` for its bytes."""

    def __init__(self, frame_bytes: int, level: int):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.frame_bytes, self.frame, self.fill = frame_bytes, [], 0
        self.parts: list[bytes] = []
        self.table: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.size = 0

    def add(self, identifier: str, record: bytes) -> None:
        if self.fill and self.fill + len(record) > self.frame_bytes:
            self._close_frame()
        self.index.append((identifier, len(self.table), self.fill, len(record)))
        self.frame.append(record)
        self.fill += len(record)

    def _append(self, part: bytes, plain: int) -> None:
        self.parts.append(part)
        self.table.append((len(part), plain))
        self.size += len(part)

    def _close_frame(self) -> None:
        if self.fill:
            self._append(self.compress(b"".join(self.frame)), self.fill)
            self.frame, self.fill = [], 0

    def finish(self) -> bytes:
        self._close_frame()
        index = self.compress(json.dumps(self.index).encode())
        self._append(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index, 0)
        body = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.parts.append(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(body) + len(footer)) + body + footer)
        return b"".join(self.parts)


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """Start, compressed size and decompressed size of every frame, from a bundle's end."""
    frames, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the file")
    body, out, at = content[-9 - 8 * frames: -9], [], 0
    for i in range(frames):
        size, plain = struct.unpack_from("<II", body, 8 * i)
        out.append((at, size, plain))
        at += size
    return out


def read_index(content: bytes) -> list[tuple[str, int, int, int]]:
    """Identifier, frame, offset in the frame and length of each record, without decompressing any frame of records."""
    import zstandard

    at, size, _ = seek_table(content)[-1]
    if struct.unpack_from("<I", content, at)[0] != SKIPPABLE_INDEX:
        raise ValueError("no index before the seek table")
    return [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(content[at + 8: at + size]))]


def records_of(content: bytes, wanted: set[str] | None = None) -> Iterator[tuple]:
    """Index entry, header fields and payload of the wanted records (of all, if None); frames without any stay closed."""
    import zstandard

    table, opened, plain = seek_table(content), None, b""
    for entry in read_index(content):
        if wanted is not None and entry[0] not in wanted:
            continue
        if entry[1] != opened:
            at, size, _ = table[entry[1]]
            opened, plain = entry[1], zstandard.ZstdDecompressor().decompress(content[at: at + size])
        yield entry, *parse_record(plain[entry[2]: entry[2] + entry[3]])


# ---------------------------------------------------------------- archives

def write_archives(records: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                   level: int = LEVEL, date: str = DATE) -> None:
    """Write planned records as bundles below ``path``; each task fills bundles of its own rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = lambda b: pa.RecordBatch.from_pydict({"bundle": pa.array([b.finish()[:-4]], pa.binary())})
        bundle = Bundle(frame_bytes, level)
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, digest, size, kind, refers = (c[i].as_py() for c in batch.columns)
                bundle.add(record_id(page, digest),
                           record_bytes(page, url, html.encode(), digest, size, kind, refers, date))
                if bundle.size >= bundle_bytes:
                    yield done(bundle)
                    bundle = Bundle(frame_bytes, level)
        if bundle.index:
            yield done(bundle)

    columns = ["page_id", "url", "html", "payload_digest", "payload_bytes", "record_type", "refers_to"]
    bundles = records.select(*columns).mapInArrow(run, "bundle binary")
    closing = struct.pack("<I", SEEKABLE_MAGIC).decode("latin-1")
    (bundles.select(F.col("bundle").cast("string").alias("value")).write
     .options(encoding="ISO-8859-1", lineSep=closing, maxRecordsPerFile=1).text(path))


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all bundles below ``path`` (columns ``RECORDS``, with ``payload`` if asked)."""
    return _opened(_bundles(spark, path).withColumn("wanted", F.lit(None).cast("array<string>")), payloads)


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """record_id, bundle, frame, frame_start (in the file), offset (in the frame), length, from the bundles' ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column(1)[i].as_py()
                table, entries = seek_table(content), read_index(content)
                yield pa.RecordBatch.from_pydict({
                    "record_id": pa.array([x[0] for x in entries], pa.string()),
                    "bundle": pa.array([batch.column(0)[i].as_py()] * len(entries), pa.string()),
                    "frame": pa.array([x[1] for x in entries], pa.int32()),
                    "frame_start": pa.array([table[x[1]][0] for x in entries], pa.int64()),
                    "offset": pa.array([x[2] for x in entries], pa.int64()),
                    "length": pa.array([x[3] for x in entries], pa.int64())})

    return _bundles(spark, path).mapInArrow(
        run, "record_id string, bundle string, frame int, frame_start long, offset long, length long")


def fetch(spark: SparkSession, path: str, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records (with payload) named in ``wanted.record_id``: only bundles that hold one are opened, and of these only
    the frames that do."""
    asked = (index.join(wanted.select("record_id").distinct(), "record_id")
             .groupBy(F.col("bundle").alias("path")).agg(F.collect_set("record_id").alias("wanted")))  # of one bundle
    return _opened(_bundles(spark, path).join(asked, "path"), True)


def _opened(bundles: DataFrame, payloads: bool) -> DataFrame:
    schema = RECORDS + (", payload binary" if payloads else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, content, wanted = (c[i].as_py() for c in batch.columns)
                rows: list[tuple] = []
                held = 0
                for (identifier, frame, offset, length), fields, payload in records_of(
                        content, None if wanted is None else set(wanted)):
                    refers = fields.get("WARC-Refers-To")
                    size = int(fields.get("X-Payload-Length", len(payload)))
                    rows.append((identifier, fields["WARC-Type"], page_of(identifier), fields.get("WARC-Target-URI"),
                                 fields["WARC-Payload-Digest"].removeprefix("sha1:"), size, refers, name, frame, offset,
                                 length, *([payload] if payloads else [])))
                    held += len(payload) if payloads else 0
                    if held > FRAME_BYTES:
                        yield _batch(rows, payloads)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, payloads)

    return bundles.select("path", "content", "wanted").mapInArrow(run, schema)


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * payloads
    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"] * payloads
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def op11_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(plan_records(read_table(spark, sf_dir, "pages")), path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.regexp_extract("refers_to", r"^<urn:page:(-?\d+):", 1).try_cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM m
"""
