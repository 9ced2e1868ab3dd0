"""WARC archives with revisit records, and a two-level capture index to read them.

Writing: every page is a gzip member of its own in a .warc.gz file, a response
with its HTTP message or a revisit that refers to the response with the same
payload digest.  Tasks write under names of their own attempt, and only the names
that successful tasks return belong to the archive.

Index: a scan of the archive gives (key, page_id, file, offset, length); keys are
URLs with the host reversed.  Sorted by key, they form zlib blocks of BLOCK_LINES
lines; the sparse directory holds each block's first key.

Reading: a key is searched in the directory, then in its block, and the capture's
byte range is read from its file; no archive is read whole.

Files go through pyarrow's file systems, so the folder may be any that these
open on every executor (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, fresh_path, spread_join, stored

#: A file is closed once it holds this many compressed bytes.
FILE_BYTES = 8 << 20
BLOCK_LINES = 3000
LEVEL = 4
#: Smaller payloads are always responses.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32, of a binary column."""
    hexa, out = F.sha1(payload), []
    for g in range(8):
        n = F.conv(F.substring(hexa, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.lit(_BASE32).substr(F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for a response).

    Of pages with equal payloads of `least_bytes` or more, that with the largest
    page_id is the response (each of them, if rows repeat it) and the others
    revisit it.  A page without an id is a response.  A null html is empty.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    narrow = rows.where((F.octet_length("payload") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", payload_digest(F.col("payload")).alias("digest"))
    narrow = stored(narrow, "digests")
    last = narrow.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("_first")).where("last <> _first").drop("_first")
    again = spread_join(narrow, last, "digest", F.col("page_id")).where("page_id <> last").select("page_id", F.col("digest").alias("_d"), F.col("last").alias("refers_to")).distinct()
    rows = rows.withColumn("digest", payload_digest(F.col("payload")))
    return rows.join(again, (rows.page_id == again.page_id) & (rows.digest == again._d), "left").select(rows.page_id, "url", "payload", "digest", "refers_to")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record; control characters of a URL are percent-encoded, a null URL is left out."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    http = _HTTP.format(len(payload)).encode()
    body = http + payload if refers_to is None else http
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one uncompressed record; a response's payload must have the digest that it states."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
    ident = lambda v: int(m[1]) if v and (m := re.search(r"(-?\d+)>$", v)) else None
    return {"page_id": ident(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": ident(fields.get("WARC-Refers-To")), "payload": payload if kind == "response" else None}


def surt(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, then path and query; no scheme, user or fragment."""
    if not url:
        return ")"
    try:
        parts = urlsplit(url)
        host = parts.netloc.rpartition("@")[2].lower()
    except ValueError:
        return ")" + url
    name, _, port = host.partition(":")
    if name.startswith("www."):
        name = name[4:]
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def write_archive(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of `with_revisits` as .warc.gz files; returns the table (file, records, bytes) of the archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        stem = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}"
        out, n, size, number = None, 0, 0, 0
        done = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{stem}-{number:05d}.warc.gz"
                    out, n, size = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = squeeze.compress(record(*row)) + squeeze.flush()
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((name, n, size))
                    out, number = None, number + 1
        if out is not None:
            out.close()
            done.append((name, n, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], ["file", "records", "bytes"])

    return stored(rows.mapInArrow(run, "file string, records long, bytes long"), "archive-files")


def captures(files: DataFrame, folder: str) -> DataFrame:
    """(key, page_id, file, offset, length) of every record, by a scan of the archive's files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                found = []
                with fs.open_input_stream(f"{root}/{file}", compression=None) as f:
                    held, start, inflate, raw = b"", 0, zlib.decompressobj(31), []
                    at = 0
                    while held or (held := f.read(1 << 20)):
                        raw.append(inflate.decompress(held))
                        at += len(held) - len(inflate.unused_data)
                        held = inflate.unused_data
                        if inflate.eof:
                            got = parse(b"".join(raw))
                            found.append((surt(got["url"]), got["page_id"], file, start, at - start))
                            start, inflate, raw = at, zlib.decompressobj(31), []
                cols = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "page_id", "file", "offset", "length"])

    many = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file").repartition(many, "file").mapInArrow(run, "key string, page_id long, file string, offset long, length long")


def build_index(entries: DataFrame, lines: int = BLOCK_LINES) -> DataFrame:
    """The index as a table of compressed blocks: block, first, last, data; blocks are in key order within a range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), itertools.count()
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        while some := list(itertools.islice(rows, lines)):
            text = "\n".join(f"{k}\t{'' if p is None else p}\t{f}\t{o}\t{n}" for k, p, f, o, n in some)
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | next(number)], pa.int64()), pa.array([some[0][0]]), pa.array([some[-1][0]]), pa.array([zlib.compress(text.encode())], pa.binary())], ["block", "first", "last", "data"])

    many = max(1, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = entries.repartitionByRange(many, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    return stored(ranged.mapInArrow(run, "block long, first string, last string, data binary"), "capture-index")


def find_captures(keys: DataFrame, index: DataFrame, part_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, page_id, file, offset, length) of every capture of the distinct keys in `keys`.

    The directory is sent to the executors in parts of at most `part_bytes`; a
    larger one takes further passes over the keys.
    """
    spark = keys.sparkSession
    directory = index.select("first", "last", "block")
    total = directory.agg(F.sum(F.length("first") + F.length("last") + 32)).first()[0] or 0
    parts = -(-total // part_bytes) or 1
    wanted, found = stored(keys.select("key").distinct(), "keys"), None
    for k in range(parts):
        sent = spark.sparkContext.broadcast(sorted(map(tuple, directory.where(F.pmod(F.xxhash64("block"), F.lit(parts)) == k).collect())))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            firsts = [d[0] for d in sent.value]
            for batch in batches:
                out = []
                for key in batch.column(0).to_pylist():
                    i = bisect.bisect_right(firsts, key) - 1
                    while i >= 0 and sent.value[i][1] >= key:  # a key's captures may fill several blocks
                        out.append((sent.value[i][2], key))
                        i -= 1
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], ["block", "key"])

        some = wanted.mapInArrow(run, "block long, key string")
        found = some if found is None else found.unionByName(some)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys_of, lines = None, [], []
        for batch in batches:
            out = []
            for block, key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if data is not None:  # sorts before the block's keys
                    now = block
                    lines = [x.split("\t") for x in zlib.decompress(data).decode().split("\n")]
                    keys_of = [x[0] for x in lines]
                elif block == now:
                    for i in range(bisect.bisect_left(keys_of, key), bisect.bisect_right(keys_of, key)):
                        _, p, f, o, n = lines[i]
                        out.append((key, int(p) if p else None, f, int(o), int(n)))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "page_id", "file", "offset", "length"])

    both = found.select("block", "key", F.lit(None).cast("binary").alias("data")).unionByName(index.select("block", F.lit(None).cast("string").alias("key"), "data"))
    many = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(many, "block").sortWithinPartitions("block", F.col("key").asc_nulls_first()).mapInArrow(read, "key string, page_id long, file string, offset long, length long")


def read_captures(found: DataFrame, folder: str) -> DataFrame:
    """The records of captures, by range reads: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload."""
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        name, f = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                out = []
                for file, offset, length in zip(*(batch.column(c).slice(i, 200).to_pylist() for c in ("file", "offset", "length")), strict=True):
                    if file != name:
                        if f is not None:
                            f.close()
                        name, f = file, fs.open_input_file(f"{root}/{file}")
                    out.append(parse(zlib.decompress(f.read_at(length, offset), 31)))
                yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], t) for n, t in zip(names, kinds, strict=True)], names)
        if f is not None:
            f.close()

    many = max(1, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # a file holds a bounded number of bytes, so its captures make a bounded group
    dealt = found.select("file", "offset", "length").repartition(many, "file").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def keys_of(pages: DataFrame) -> DataFrame:
    """(key) of each page's URL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [None if u is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", u) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in clean], pa.string())], ["key"])

    return pages.select(F.col("url").cast("string")).mapInArrow(run, "key string")


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write `pages` as an archive, index it, look every page's URL up and read its captures.

    page_id, payload_bytes, payload_digest, record_type and refers_to of every row
    of `pages`.  Null and repeated URLs are looked up like others; an empty table
    gives no rows; other columns are ignored.
    """
    folder = folder or fresh_path(spark, "warc")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    files = write_archive(with_revisits(pages, least_bytes), folder)
    index = build_index(captures(files, folder))
    done = read_captures(find_captures(keys_of(pages), index), folder)
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
