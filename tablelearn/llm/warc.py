"""WARC archives of pages, with a two-level capture index.

``write_archives``: every page becomes one gzip member.  Of the pages with equal payloads (of
``min_bytes`` or more) the one with the smallest id is a response, all others are
revisits that name it; a group of copies is found by partial aggregation on the digest and joined
back with skew splitting.  Each task writes its own files; the rows it returns (file,
offset, length) are committed by Spark's Parquet writer, so files of failed attempts
are never referenced.

``write_index``: captures are dealt by range of (reversed-host url key, id) and sorted; each
task writes its range as compressed blocks of ``BLOCK_LINES`` lines, and a
sparse directory with the first key of every block.  The driver only sees one line per range.

``lookup``: a key is looked up by binary search over the ranges, then over the range's
directory, then in the one or few blocks fetched by range read.  ``read_records`` sorts the
found places and reads neighbouring records together.

Paths go through pyarrow's file systems (file, hdfs, s3, gs); they must be shared by
all executors, as spark.checkpoint.dir is.

Defined results: a null html is an empty payload; a null url has the empty key and no
target line; rows that tie on the smallest id of a payload (repeated rows) are all
responses; a null id is a response only where all ids of the payload are null, else a
revisit; an empty table gives no files and an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import Scratch, partitions_for, ship_package

BLOCK_LINES = 3000
MAX_FILE = 1 << 30
MAX_READ = 8 << 20  # neighbouring records are fetched together up to this size
DATE = "2024-01-01T00:00:00Z"  # pages have no capture time
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if re.match(r"[a-z0-9+.-]+:", path):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query``: host labels reversed and in lower case, no fragment, controls escaped."""
    if not url:
        return ""
    rest = url.partition("://")[2] if "://" in url else url
    host, tail = re.match(r"(?s)([^/?#]*)([^#]*)", rest).groups()
    host = host.rpartition("@")[2].lower()
    return _escaped(",".join(reversed(host.split("."))) + ")" + (tail or "/"))


def _escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", text)


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(key, url: str | None, payload: bytes | None, size: int, digest: str, refers_to=None) -> bytes:
    """One WARC record, not yet compressed; ``payload`` is None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMES, f'page:{key}')}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"Page-ID: {json.dumps(key)}"]
    if payload is None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(_NAMES, f'page:{refers_to}')}>",
                 f"Refers-To-Page-ID: {json.dumps(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The fields of one record (without compression), its payload and its HTTP length."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    return {"fields": fields, "type": kind, "size": size, "payload": payload if kind == "response" else None}


def _opened(base: str, name: str):
    fs, root = file_system(base)
    fs.create_dir(root, recursive=True)
    return fs.open_output_stream(f"{root}/{name}", compression=None)  # members are compressed already


def write_archives(pages: DataFrame, path: str, own: Scratch, key: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """Captures (id, key, file, offset, length); the archives are below ``path``."""
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("p"))
    rows = rows.withColumn("sha1", F.sha1("p")).withColumn("bytes", F.octet_length("p"))
    copies = (rows.where(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes").agg(F.min("id").alias("first"), F.count("*").alias("c"))
              .where("c > 1").select(F.col("sha1").alias("_s"), F.col("bytes").alias("_b"), "first"))
    rows = rows.join(copies, (F.col("sha1") == F.col("_s")) & (F.col("bytes") == F.col("_b")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.select("id", "url", "sha1", "bytes", F.when(~revisit, F.col("p")).alias("p"), F.when(revisit, F.col("first")).alias("refers_to"))

    def run(batches):
        name, out, at, number = None, None, 0, 0
        try:
            for b in batches:
                found = []
                for i, u, sha1, size, payload, refers in zip(*(b.column(j).to_pylist() for j in range(6))):
                    if out is None or at >= MAX_FILE:
                        if out is not None:
                            out.close()
                        name = f"pages-{TaskContext.get().partitionId():06d}-{number:03d}-{uuid.uuid4().hex[:8]}.warc.gz"
                        out, at, number = _opened(path, name), 0, number + 1
                    member = gzip.compress(record(i, u, payload, size, base32(sha1), refers), 6, mtime=0)
                    out.write(member)
                    found.append((i, url_key(u), name, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], b.column(0).type), *(
                        pa.array([f[j] for f in found], t) for j, t in ((1, pa.string()), (2, pa.string()), (3, pa.int64()), (4, pa.int64())))],
                    ["id", "key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return own.save(rows.mapInArrow(run, f"id {kind}, key string, file string, offset long, length long"))


def write_index(captures: DataFrame, path: str, own: Scratch, block_lines: int = BLOCK_LINES) -> list[tuple]:
    """Writes blocks and directories; one (first key, last key, file) per range, in order."""
    ranges = max(1, min(partitions_for(captures.sparkSession), -(-captures.count() // block_lines)))
    ordered = captures.repartitionByRange(ranges, "key", "id").sortWithinPartitions("key", "id")

    def run(batches):
        name = f"index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}"
        out, at, directory, lines, last = None, 0, [], [], None

        def flush():
            nonlocal at
            packed = zlib.compress("\n".join(f"{k} {rest}" for k, rest in lines).encode(), 6)
            out.write(packed)
            directory.append((lines[0][0], at, len(packed)))
            at += len(packed)
            lines.clear()

        for b in batches:
            for i, k, file, offset, length in zip(*(b.column(j).to_pylist() for j in range(5))):
                out = out or _opened(path, f"{name}.blocks")
                lines.append((k, json.dumps([i, file, offset, length])))
                last = k
                if len(lines) >= block_lines:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        out.close()
        with _opened(path, f"{name}.directory") as d:
            d.write(zlib.compress(json.dumps(directory).encode()))
        yield pa.RecordBatch.from_pydict({"first": [directory[0][0]], "last": [last], "file": [name]})

    found = own.save(ordered.select("id", "key", "file", "offset", "length").mapInArrow(run, "first string, last string, file string"))
    return sorted((r["first"], r["last"], r["file"]) for r in found.collect())


@lru_cache(maxsize=8)
def _directory(path: str, name: str) -> tuple[list[str], list[tuple[int, int]]]:
    fs, root = file_system(path)
    with fs.open_input_file(f"{root}/{name}.directory") as f:
        rows = json.loads(zlib.decompress(f.read()))
    return [r[0] for r in rows], [(r[1], r[2]) for r in rows]


@lru_cache(maxsize=32)
def _block(path: str, name: str, offset: int, length: int) -> tuple[list[str], list[str]]:
    fs, root = file_system(path)
    with fs.open_input_file(f"{root}/{name}.blocks") as f:
        f.seek(offset)
        lines = zlib.decompress(f.read(length)).decode().split("\n")
    parts = [x.partition(" ") for x in lines]
    return [p[0] for p in parts], [p[2] for p in parts]


def entries(path: str, ranges: list[tuple], key: str):
    """All index entries [id, file, offset, length] of a url key."""
    lasts = [r[1] for r in ranges]
    for r in range(bisect.bisect_left(lasts, key), len(ranges)):
        first, _, name = ranges[r]
        if first > key:
            return
        firsts, places = _directory(path, name)
        # the block before the first one that starts at the key or later may end with it
        for b in range(max(0, bisect.bisect_left(firsts, key) - 1), len(firsts)):
            if firsts[b] > key:
                break
            keys, rest = _block(path, name, *places[b])
            for j in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                yield json.loads(rest[j])


def lookup(wanted: DataFrame, ranges: list[tuple], path: str) -> DataFrame:
    """(id, file, offset, length) of the captures of each distinct (id, key) in ``wanted``."""
    kind = wanted.schema["id"].dataType.simpleString()
    ship_package(wanted.sparkSession)

    def run(batches):
        held: tuple = (None, {})
        for b in batches:
            out = []
            for i, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held[0] != k:  # keys come sorted: one search serves all ids of a hot url
                    by_id: dict = {}
                    for e in entries(path, ranges, k):
                        by_id.setdefault(e[0], []).append(e[1:])
                    held = (k, by_id)
                out += [(i, *place) for place in held[1].get(i, ())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], b.column(0).type), pa.array([o[1] for o in out], pa.string()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.int64())], ["id", "file", "offset", "length"])

    near = wanted.select("id", "key").distinct().repartitionByRange(partitions_for(wanted.sparkSession), "key", "id")
    return near.sortWithinPartitions("key", "id").mapInArrow(run, f"id {kind}, file string, offset long, length long")


def read_records(places: DataFrame, path: str, with_payload: bool = True) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to and, if asked, payload) of the records at ``places``.

    The digest of a response is computed from the payload that was read, and must be the recorded one.
    """
    spark, kind = places.sparkSession, places.schema["id"].dataType.simpleString()
    near = places.repartition(partitions_for(spark), "file", F.floor(F.col("offset") / (64 << 20))).sortWithinPartitions("file", "offset")

    def run(batches):
        fs, root = file_system(path)
        name, source = None, None
        for b in batches:
            rows = list(zip(*(b.column(j).to_pylist() for j in range(4))))
            start = 0
            while start < len(rows):
                _, file, first, length = rows[start]
                end, stop = first + length, start + 1
                while stop < len(rows) and rows[stop][1] == file and rows[stop][2] <= end and rows[stop][2] + rows[stop][3] - first <= MAX_READ:
                    end, stop = max(end, rows[stop][2] + rows[stop][3]), stop + 1
                if name != file:
                    if source is not None:
                        source.close()
                    name, source = file, fs.open_input_file(f"{root}/{file}")
                source.seek(first)
                raw = source.read(end - first)
                out = []
                for i, _, offset, size in rows[start:stop]:
                    r = parsed(gzip.decompress(raw[offset - first:offset - first + size]))
                    digest = r["fields"]["WARC-Payload-Digest"].removeprefix("sha1:")
                    if r["payload"] is not None and base32(hashlib.sha1(r["payload"]).hexdigest()) != digest:
                        raise ValueError(f"digest of page {i} in {file} at {offset}")
                    refers = r["fields"].get("Refers-To-Page-ID")
                    out.append((i, r["size"], digest, r["type"], None if refers is None else json.loads(refers), r["payload"]))
                cols = [pa.array([o[0] for o in out], b.column(0).type), pa.array([o[1] for o in out], pa.int64()),
                        pa.array([o[2] for o in out], pa.string()), pa.array([o[3] for o in out], pa.string()),
                        pa.array([o[4] for o in out], b.column(0).type)]
                if with_payload:
                    cols.append(pa.array([o[5] for o in out], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names)
                start = stop
        if source is not None:
            source.close()

    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    return near.select("id", "file", "offset", "length").mapInArrow(
        run, f"id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes archives and index to scratch space, looks every page up in the index and reads its record back."""
    spark = ship_package(pages.sparkSession)
    path = scratch_path(spark, "warc")
    with Scratch(spark, "warc-tables") as own:
        own.paths.append(path)
        captures = write_archives(pages, path, own, key, url, html, min_bytes)
        ranges = write_index(captures, path, own)
        places = own.save(lookup(captures.select("id", "key"), ranges, path))
        return own.save(read_records(places, path, with_payload=False), keep=True).withColumnRenamed("id", key)
