"""WARC archives: monolithic gzip normaliser.

``write`` puts one record for each page into gzip files whose whole content
is a single deflate stream, as crawlers that compress afterwards leave
them: no record can be reached without inflating all before it.
``normalise`` inflates each such stream once, in pieces, and rewrites every
record as a gzip member of its own, with a sidecar of offsets next to each
archive. ``read`` fetches records by offset alone.

Equal payloads: the record with the smallest page id (null last; then the
smallest url, null last; then one of rows equal in both) is the response,
the others are revisits without the payload. The decision joins digests
and ids only; pages move once, by a key of id, url and digest, so a payload
that a third of all pages share is spread.

A normalising task holds one piece of a stream and the header of a record;
bodies pass through. Archives are written under a name of the attempt and
renamed when complete, so a retried task leaves no half archive. Archives
are opened by the tasks through pyarrow file systems (file, hdfs, s3, gs).

Defined cases: a null payload is empty; payloads shorter than
``min_revisit_bytes`` are all responses; null and repeated ids and urls are
kept as they are; an empty table gives no archive and an empty result;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from copse.llm.scratch import Steps, shuffle_parts

PIECE = 1 << 20
END = "\r\n\r\n"
#: Captures carry no time of their own in the input.
DATE = "1970-01-01T00:00:00Z"
INDEX = "path string, offset long, length long, record_id string, record_type string"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a binary column's SHA-1: four groups of forty
    bits, each eight digits of five bits."""
    groups = [F.lpad(F.conv(F.substring(F.sha1(data), at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, key, copy (numbers rows that are equal
    in all), response (whether the row is one), refers_to."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8"))) \
        .withColumn("key", F.md5(F.to_json(F.struct("page_id", "url", "digest"))))
    order = F.struct(F.col("page_id").isNull().alias("a"), F.col("page_id").alias("page_id"),
                     F.col("url").isNull().alias("b"), F.col("url").alias("url"))
    thin = rows.where(F.octet_length("payload") >= min_revisit_bytes) \
        .select("key", "digest", order.alias("o")).distinct()
    least = thin.groupBy(F.col("digest").alias("d")).agg(F.min("o").alias("least"))
    marks = thin.join(least, F.col("digest") == F.col("d")).select(
        F.col("key").alias("k"), (F.col("o") == F.col("least")).alias("is_least"), F.col("least.page_id").alias("least_id"))
    copies = W.partitionBy("key").orderBy("key")
    out = rows.join(marks, F.col("key") == F.col("k"), "left").withColumn("copy", F.row_number().over(copies))
    response = F.col("is_least").isNull() | (F.col("is_least") & (F.col("copy") == 1))
    return out.select("page_id", "url", "payload", "digest", "key", "copy", response.alias("response"),
                      F.when(~response, F.col("least_id")).alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line breaks cannot occur in one."""
    clean = F.regexp_replace(value.cast("string"), "[\r\n]", "%0A")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise("")


def lines(rows: DataFrame) -> DataFrame:
    """The WARC/1.1 records of ``records`` as strings, without the end mark."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(END))
    block = F.concat(http, F.when(F.col("response"), F.col("payload")).otherwise(""))
    uid = F.md5(F.concat_ws("|", "key", F.col("copy").cast("string")))
    part = lambda a, n: F.substring(uid, a, n)
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("response"), "response").otherwise("revisit"), F.lit("\r\n"),
        F.lit("WARC-Record-ID: <urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nContent-Type: application/http;msgtype=response\r\n"),
        _header("WARC-Target-URI", F.col("url")), _header("X-Page-ID", F.col("page_id")),
        _header("X-Refers-To-Page-ID", F.col("refers_to")),
        F.when(F.col("response"), "").otherwise(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(header, block).alias("value"))


def write(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> None:
    """Monolithic archives of all pages in ``folder``."""
    lines(records(pages, min_revisit_bytes)).write.option("compression", "gzip").option("lineSep", END).text(folder)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


class Stream:
    """A gzip file's content in pieces, whatever its members."""

    def __init__(self, source):
        self.source, self.inflate, self.held = source, None, b""

    def more(self) -> bool:
        """Fetches some content; False at the end of the file."""
        while True:
            raw = self.inflate and (self.inflate.unconsumed_tail or self.inflate.unused_data) or self.source.read(PIECE)
            if not raw:
                if self.inflate and not self.inflate.eof:
                    raise ValueError("truncated gzip stream")
                return False
            if self.inflate is None or self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            out = self.inflate.decompress(raw, PIECE)
            if out:
                self.held += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Content up to and with ``mark``; None at a clean end."""
        at = 0
        while (i := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise ValueError("truncated record header")
                return None
        out, self.held = self.held[:i + len(mark)], self.held[i + len(mark):]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if not self.held and not self.more():
                raise ValueError("truncated record body")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out


def fields(header: bytes) -> dict[str, str]:
    rows = header.decode("utf-8", "surrogateescape").split("\r\n")
    if not rows[0].startswith("WARC/"):
        raise ValueError(f"not a record: {rows[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (r.partition(":") for r in rows[1:] if r)}


def rewrite(source, sink) -> Iterator[dict]:
    """Every record of a stream as a gzip member; yields the index rows."""
    stream, offset = Stream(source), 0
    while (header := stream.until(END.encode())) is not None:
        f = fields(header)
        pack, start = zlib.compressobj(6, zlib.DEFLATED, 31), offset
        offset += sink.write(pack.compress(header))
        for piece in stream.take(int(f["content-length"])):
            offset += sink.write(pack.compress(piece))
        if (mark := b"".join(stream.take(len(END)))) != END.encode():
            raise ValueError(f"no end of record after the body: {mark!r}")
        offset += sink.write(pack.compress(mark) + pack.flush())
        yield {"offset": start, "length": offset - start, "record_id": f.get("warc-record-id", "").strip("<>"),
               "record_type": f.get("warc-type", "")}


class _Counted:
    """A sink whose ``write`` tells how many bytes it took."""

    def __init__(self, sink):
        self.sink = sink

    def write(self, data: bytes) -> int:
        self.sink.write(data)
        return len(data)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites the archives of ``source`` into ``target``; gives the index
    of all records, read from the sidecars."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, out_dir = _open(target)
        out_fs.create_dir(out_dir, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, name = _open(path)
                base = f"{out_dir}/{os.path.basename(name).split('.')[0]}.warc.gz"
                half, side = f"{base}.{attempt}", f"{base}.idx.{attempt}"
                with fs.open_input_stream(name, compression=None) as src, out_fs.open_output_stream(half, compression=None) as sink, \
                        out_fs.open_output_stream(side, compression=None) as index:
                    for row in rewrite(src, _Counted(sink)):
                        index.write((json.dumps({"path": f"{target}/{os.path.basename(base)}"} | row) + "\n").encode())
                out_fs.move(half, base)
                out_fs.move(side, f"{base}.idx")
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    # A number of partitions, as AQE would merge such small rows into one task.
    paths = files.repartition(shuffle_parts(spark), "path")
    paths.mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()
    if files.limit(1).count() == 0:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(target)


def read(index: DataFrame) -> DataFrame:
    """The records that an index lists, each inflated alone: page_id,
    payload_bytes, payload_digest, record_type, refers_to, record_id,
    payload (null for revisits). A response whose payload does not have the
    digest it claims is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for b in batches:
            out, held = [], 0
            for path, offset, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                if path != opened:
                    fs, name = _open(path)
                    opened, source = path, fs.open_input_file(name)
                source.seek(offset)
                out.append(parse(zlib.decompress(source.read(length), 31)))
                held += len(out[-1][-1] or b"")
                if held > 8 * PIECE:
                    yield _batch(out)
                    out, held = [], 0
            yield _batch(out)

    return index.select("path", "offset", "length").mapInArrow(run, RECORD)


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, " \
    "record_id string, payload binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = [c.strip().split(" ")[0] for c in RECORD.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def parse(record: bytes) -> tuple:
    header, _, rest = record.partition(END.encode())
    f = fields(header + b"\r\n")
    block = rest[:int(f["content-length"])]
    http, _, payload = block.partition(END.encode())
    digest = f["warc-payload-digest"].removeprefix("sha1:")
    number = lambda name: int(f[name]) if name in f else None
    common = f["warc-type"], number("x-refers-to-page-id"), f["warc-record-id"].strip("<>")
    if f["warc-type"] == "revisit":
        size = next(int(h.split(b":")[1]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
        return number("x-page-id"), size, digest, *common, None
    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {common[2]} does not have its digest")
    return number("x-page-id"), len(payload), digest, *common, payload


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes, normalises and reads back all pages."""
    steps = Steps(pages.sparkSession, "warc")
    raw, out = steps.path("monolithic"), steps.path("members")
    write(pages, raw, min_revisit_bytes)
    return read(normalise(pages.sparkSession, raw, out))
