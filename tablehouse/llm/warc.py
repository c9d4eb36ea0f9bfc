"""Operator 3: WARC archives with revisit records, and a reader that splits their files.

Writing: one gzip member per record.  Of pages with equal payloads the one with the largest
page_id is a `response` and holds the payload; the others are `revisit` records that name it.
A task writes a file under a name of its own and reports it; only files in the report, which
Spark commits, are read, so a lost or repeated task leaves nothing but an unread file.

Reading: the files are cut into byte ranges of `SPLIT` bytes, whatever their records.  A task
looks for the gzip magic in its range, decodes what follows, and takes it for a record only if
that begins with a WARC version line, has complete headers and ends where another member or
the end of the file follows.  It owns the records that start in its range and reads over the
end of the range for the last of them.

Files are reached through pyarrow's file systems, by the URI of the shared folder; on HDFS
that needs libhdfs on the executors.

Defined cases: null html is an empty payload; pages that repeat a page_id and its payload are
all responses; null page_ids are less than any other, refer to nothing and stay null; null
urls have no target header; control characters in a url are percent-encoded in the header;
a record whose payload doesn't fit its digest header is read as `damaged`, with the digest of
what is there, and ends nothing (`records_in` raises unless told otherwise); an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehouse.llm.common import fit, prepare, scratch, stored

SPLIT, DATE = 8 << 20, "1970-01-01T00:00:00Z"
MAGIC, PROFILE = b"\x1f\x8b\x08", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, at long"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; Hadoop also writes file:/path."""
    return pafs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _escaped(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One record as a gzip member; `refers_to` makes it a revisit."""
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page {i} {digest}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": DATE,
            "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    if url is not None:
        head["WARC-Target-URI"] = _escaped(url)
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": name(refers_to), "X-Refers-To-Page-ID": str(refers_to)}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Archives below `folder`; the report (file, bytes, records)."""
    prepare(pages.sparkSession)
    rows = fit(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    holders = rows.filter(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
    holders = holders.filter("n > 1").select("digest", "holder")
    known = rows.join(holders, "digest", "left").withColumn(
        "refers_to", F.when((F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at, size, n, out = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store, path = _store(at)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path, compression=None)
                made = record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"], base64.b32encode(row["digest"]).decode())
                out.write(made)
                size, n = size + len(made), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": at, "bytes": size, "records": n}])

    report = known.select("page_id", "url", "html", "refers_to", "digest").mapInArrow(run, "file string, bytes long, records long")
    return stored(report, "warc-report")


class _Window:
    """Bytes of a file from `start` on, read as far as they are asked for."""

    def __init__(self, file: pa.NativeFile, start: int, size: int):
        self.file, self.start, self.size, self.data = file, start, size, bytearray()
        file.seek(start)

    def upto(self, end: int) -> None:
        have = self.start + len(self.data)
        if end > have:
            self.data += self.file.read(max(end - have, 1 << 16))


def _member(w: _Window, at: int) -> tuple[bytes, int] | None:
    """The decoded member at `at` and where it ends, if it is a WARC record."""
    unpack, parts, pos, seen = zlib.decompressobj(31), [], at, 0
    try:
        while not unpack.eof:
            w.upto(min(pos + (1 << 16), w.size))
            piece = bytes(w.data[pos - w.start : pos - w.start + (1 << 16)])
            if not piece:
                return None
            parts.append(unpack.decompress(piece))
            pos += len(piece)
            seen += len(parts[-1])
            if seen >= 7 and not b"".join(parts[:2] if len(parts[0]) < 7 else parts[:1]).startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    end = pos - len(unpack.unused_data)
    w.upto(min(end + 3, w.size))
    if end < w.size and bytes(w.data[end - w.start : end - w.start + 3]) != MAGIC:
        return None
    return b"".join(parts), end


def _parse(raw: bytes, strict: bool = True) -> dict | None:
    """Headers and payload facts of a decoded record; None if it is not one."""
    head, cut, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    if not cut or not lines[0].startswith("WARC/1.") or not {"WARC-Type", "WARC-Record-ID", "Content-Length"} <= fields.keys():
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if fields["WARC-Type"] == "revisit":
        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    else:
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest and found != digest:
            if strict:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} has digest {found}, not {digest}")
            fields["WARC-Type"] = "damaged"
        digest = found
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID")}


def records_in(file: pa.NativeFile, size: int, start: int, end: int, strict: bool = True) -> Iterator[tuple[int, dict]]:
    """(offset, record) of every record that starts in [start, end); `strict`: a wrong digest raises."""
    w, at = _Window(file, start, size), start
    while at < end:
        w.upto(min(max(end, at) + 2, size))
        at = w.data.find(MAGIC, at - w.start, min(end + 2, size) - w.start)
        if at < 0:
            return
        at += w.start
        got = _member(w, at)
        parsed = _parse(got[0], strict) if got else None
        if parsed:
            yield at, parsed
            at = got[1]
        else:
            at += 1


def read(spark: SparkSession, report: DataFrame, split: int = SPLIT) -> DataFrame:
    """All records of the files (file, bytes) of a report, range by range."""
    prepare(spark)
    ranges = report.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"))
    total = report.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    # few rows that stand for much work each: one task per range, as far as that is sensible
    ranges = ranges.repartition(min(int(total), 100_000), "file", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("at", pa.int64())])
        for batch in batches:
            for r in batch.to_pylist():
                store, path = _store(r["file"])
                with store.open_input_file(path) as file:
                    rows = []
                    for at, row in records_in(file, r["bytes"], r["start"], min(r["start"] + split, r["bytes"]), strict=False):
                        rows.append(row | {"file": r["file"], "at": at})
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, kind)

    return ranges.mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 0, split: int = SPLIT) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    return read(spark, write(pages, scratch(spark, "warc"), min_bytes), split)


SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, html, sha1(html) as hex, max(page_id) over (partition by html) as holder from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast((cast(concat('0x', substr(hex, cast(floor(i / 4) * 5 + 1 as bigint), 5)) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31 as bigint) + 1, 1)), '') as payload_digest,
  case when page_id is not distinct from holder then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from holder then null else holder end as refers_to
from h
"""
