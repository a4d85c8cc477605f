"""WARC archives: records of pages written as gzip members, and a splittable reader.

Writing. Tasks turn rows into members and hand blocks of them to Spark's text writer, whose committer makes retried tasks
safe in any store that Spark writes to; the writer ends each block with a separator, which is an empty gzip member here, so a file is
plain gzip from end to end. Records of equal payloads of at least 100 bytes are one response and revisits of it: digests
are counted first, a filter of bounded size keeps pages without a copy out of any exchange, and a digest that holds many rows is broadcast.

Reading. Files are cut into byte ranges of equal size, one row each, dealt over all tasks. A task scans its range for the magic
of gzip and takes a candidate whose decoded start is a WARC header (an empty member counts as a link of the chain); it owns the
members that start inside the range and reads past the range's end to finish the last. Bytes that only look like a record, for instance an archive
stored inside a payload, can't be told apart within one range. So each range also gives where its first member starts and its
last one ends, and a range that begins before the end of an earlier range's last member is read again from there, until none does:
the records are those of a reader that goes through the file from its start. The files are opened with ``pyarrow.fs`` by their URI.

Edge cases: a null payload is empty; a null url gives no WARC-Target-URI, white space and control characters in one are percent-encoded;
null ids sort last; rows of one id, url and payload are records each, of which one is the response; a member that is cut off or
whose checksum or length is wrong comes out as ``damaged``, without payload, and reading goes on at the next candidate; other members are skipped;
an empty table gives an archive without records, and that an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bloom
from .skew import join_back
from .storage import claim, discard, materialise, remove
from .workers import trimmed

MAGIC = b"\x1f\x8b\x08"
LEAST_REVISIT = 100
RANGE_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
WINDOW = 1 << 20
#: A header longer than that is none.
MOST_HEADER = 1 << 20
_ODD = re.compile(rb"[\x00-\x20\x7f]")


def gzipped(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


EMPTY_MEMBER = gzipped(b"")


def record(kind: str, record_id: str, url: str | None, date: str, digest: str, size: int, payload: bytes | None, refers_to: str | None) -> bytes:
    """One record's bytes: a revisit has the page's HTTP header alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    lines = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <" + record_id.encode() + b">", b"WARC-Date: " + date.encode(), b"WARC-Payload-Digest: sha256:" + digest.encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _ODD.sub(lambda m: b"%%%02X" % m[0][0], url.encode()))
    if refers_to is not None:
        lines += [b"WARC-Refers-To: <" + refers_to.encode() + b">", b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(date: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("record_type", "record_id", "url", "digest", "size", "payload", "refers_id")]
            for i in range(batch.num_rows):
                kind, name, url, digest, n, payload, refers = (c[i].as_py() for c in columns)
                held.append(gzipped(record(kind, name, url, date, digest, n, payload, refers), level))
                size += len(held[-1])
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    return run


def write_warc(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> None:
    """Writes (record_type, record_id, url, digest, size, payload, refers_id) as archives in the folder ``path``, one a partition."""
    blocks = records.mapInArrow(trimmed(_members(date, level)), "value binary")
    blocks.select(F.col("value").cast("string").alias("value")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def page_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """A record for each row of ``pages`` (page_id, url, html): a response, or a revisit of the response with the smallest page_id."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    rows = rows.withColumn("mark", F.when(F.col("size") >= least, F.xxhash64("digest")))
    order = F.struct(F.col("page_id").isNull().alias("a"), F.col("page_id").alias("page_id"), F.col("url").isNull().alias("b"), F.col("url").alias("url"))
    copies = rows.where(F.col("size") >= least).groupBy("digest").agg(F.count("*").alias("copies"), F.min(order).alias("first")).where("copies > 1")
    copies = materialise(copies.select("digest", "copies", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")))
    maybe = bloom.marked(rows, "mark", bloom.build(copies.select(F.xxhash64("digest"))), "maybe")
    # unlike for rows that differ in id, url or payload, and numbered for others
    name = lambda page, url, n: F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.substring("digest", 1, 16), F.lit(":"), F.lower(F.hex(F.xxhash64(url))), F.lit(":"), n)
    none = F.lit(None).cast("string")
    alone = maybe.where(~F.col("maybe")).select(
        F.lit("response").alias("record_type"), name(F.col("page_id"), F.col("url"), F.concat(F.lit("r"), F.monotonically_increasing_id().cast("string"))).alias("record_id"), "url", "digest", "size", "payload", none.alias("refers_id")
    )
    total = copies.agg(F.sum("copies")).first()[0] or 0
    met = join_back(maybe.where("maybe").drop("mark", "maybe"), copies.withColumn("known", F.lit(True)), ["digest"], total, "copies")
    own = F.col("known").isNull() | (F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url")))
    slim = met.withColumns({"own": own, "payload": F.when(own, F.col("payload"))})
    # rows that are alike in all count as one with a number, before the exchange
    alike = slim.groupBy("digest", "page_id", "url", "size", "own", "known", "first_id", "first_url").agg(F.count("*").alias("n"), F.first("payload").alias("payload"))
    each = alike.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    response = F.col("own") & (F.col("known").isNull() | (F.col("k") == 1))
    told = each.select(
        F.when(response, "response").otherwise("revisit").alias("record_type"), name(F.col("page_id"), F.col("url"), F.col("k").cast("string")).alias("record_id"), "url", "digest", "size",
        F.when(response, F.col("payload")).alias("payload"), F.when(~response, name(F.col("first_id"), F.col("first_url"), F.lit("1"))).alias("refers_id"),
    )
    return alone.unionByName(told)


class _File:
    """Bytes of a file by position, through one window."""

    def __init__(self, uri: str) -> None:
        if uri.startswith("file:"):
            fs, path = pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
        else:
            fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        self.source = fs.open_input_file(path)
        self.start, self.held = 0, b""

    def at(self, position: int) -> memoryview:
        """What is held from ``position`` on; empty at the file's end."""
        if not self.start <= position < self.start + len(self.held):
            self.start, self.held = position, self.source.read_at(WINDOW, position)
        return memoryview(self.held)[position - self.start :]

    def find(self, position: int, stop: int) -> int:
        """The first magic that starts in [position, stop), or -1."""
        while position < stop:
            here = bytes(self.at(position))
            if len(here) < len(MAGIC):
                self.start, self.held = position, self.source.read_at(WINDOW, position)
                here = self.held
            found = here.find(MAGIC)
            if found >= 0:
                return position + found if position + found < stop else -1
            if len(here) < len(MAGIC):
                return -1
            position += len(here) - len(MAGIC) + 1
        return -1


def _decode(file: _File, position: int) -> tuple[str, int, bytes]:
    """What starts here: "record" (end, bytes), "empty" (end), "damaged" (a header, but no good end), or "none"."""
    z = zlib.decompressobj(31)
    out: list[bytes] = []
    size, at, header = 0, position, False
    try:
        while not z.eof:
            here = file.at(at)
            if not len(here):
                return ("damaged" if header else "none"), position, b""
            got = z.decompress(here)
            at += len(here) - len(z.unused_data)
            if got:
                out.append(got)
                size += len(got)
            if not header and size >= 5:
                start = b"".join(out)
                out = [start]
                if not start.startswith(b"WARC/"):
                    return "none", position, b""
                if b"\r\n\r\n" in start:
                    header = True
                elif size > MOST_HEADER:
                    return "none", position, b""
    except zlib.error:
        return ("damaged" if header else "none"), position, b""
    if not size:
        return "empty", at, b""
    return ("record", at, b"".join(out)) if header else ("none", position, b"")


def parse_record(data: bytes) -> dict | None:
    """Headers and payload of a record's bytes; None if its length is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        headers[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        return None
    block = rest[: int(length)]
    payload, told = block, None
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        told = int(sizes[0]) if sizes and sizes[0].isdigit() else None
    kind = headers.get("warc-type")
    digest = hashlib.sha256(payload).hexdigest()
    said = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
    revisit = kind == "revisit"
    return {
        "record_type": kind, "record_id": headers.get("warc-record-id", "").strip("<>") or None, "url": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
        "refers_id": headers.get("warc-refers-to", "").strip("<>") or None, "payload_bytes": told if revisit else len(payload), "payload_digest": said if revisit else digest,
        "digest_agrees": None if revisit or said is None else said == digest, "payload": None if revisit else payload,
    }


_FIELDS = [("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("refers_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_agrees", pa.bool_()), ("payload", pa.binary())]
_FOUND = pa.schema([("file", pa.string()), ("part", pa.int64()), ("first", pa.int64()), ("carry", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("damaged", pa.bool_()), *_FIELDS])
FOUND = "file string, part bigint, first bigint, carry bigint, offset bigint, length bigint, damaged boolean, record_type string, record_id string, url string, date string, refers_id string, payload_bytes bigint, payload_digest string, digest_agrees boolean, payload binary"


def scan_range(uri: str, start: int, stop: int) -> Iterator[tuple[str, int, int, bytes]]:
    """Members that start in [start, stop): what it is, where it starts and ends, its decoded bytes."""
    file = _File(uri)
    position = file.find(start, stop)
    while position >= 0:
        kind, end, data = _decode(file, position)
        if kind != "none":
            yield kind, position, end, data
        position = file.find(end if kind in ("record", "empty") else position + 1, stop)


def _scan(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, size, first, carry = [], 0, None, None
                base = {"file": r["file"], "part": r["part"]}
                for kind, at, end, data in scan_range(r["file"], r["start"], r["stop"]):
                    if kind in ("record", "empty"):
                        first = at if first is None else first
                        carry = end
                    if kind == "empty":
                        continue
                    parsed = parse_record(data) if kind == "record" else None
                    row = base | {"offset": at, "length": end - at if parsed else None, "damaged": parsed is None} | (parsed or {})
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 500
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _FOUND)
                        rows, size = [], 0
                rows.append(base | {"first": first, "carry": carry})
                yield pa.RecordBatch.from_pylist(rows, _FOUND)

    return run


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, payload: bool = False) -> DataFrame:
    """All records of the archives in ``path``: file, offset, length, damaged, headers' fields, and the payload if asked for."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("length > 0").select("file", "length", start.alias("start"))
    ranges = ranges.select("file", F.expr(f"start div {range_bytes}").alias("part"), "start", F.least(F.col("start") + range_bytes, "length").alias("stop"))
    n = ranges.count()
    dealt = ranges.repartition(max(1, min(n, 4 * spark.sparkContext.defaultParallelism), n // 8), "file", "part")
    found = materialise(dealt.mapInArrow(trimmed(_scan(payload)), FOUND))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        # a few numbers a range: one row each
        facts = found.where("offset is null").select("file", "part", "first", F.max("carry").over(before).alias("due"))
        late = materialise(facts.where("first < due").select("file", "part", "due"))
        if late.isEmpty():
            discard(late)
            break
        again = ranges.join(late, ["file", "part"]).select("file", "part", F.col("due").alias("start"), "stop")
        kept = found.join(late, ["file", "part"], "left_anti").select(*found.columns)
        fixed = materialise(kept.unionByName(again.repartition("file", "part").mapInArrow(trimmed(_scan(payload)), FOUND)))
        discard(late)
        discard(found)
        found = fixed
    out = found.where("offset is not null").drop("part", "first", "carry")
    return out if payload else out.drop("payload")


def archived_pages(pages: DataFrame, path: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pages written as archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    ``path``: a folder for the archives, which stay then; by default one in the shared folder, removed once read.
    """
    spark = pages.sparkSession
    where = path or claim(spark, ".warc")
    write_warc(page_records(pages), where)
    out = read_warc(spark, where, range_bytes)
    if path is None:
        remove(spark, where)
    page = lambda c: F.nullif(F.regexp_extract(c, r"^urn:page:(-?[0-9]*):", 1), F.lit("")).cast("long")
    return out.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_id").alias("refers_to"), "damaged", "digest_agrees")
