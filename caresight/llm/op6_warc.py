"""WARC archives with a two-level capture index.

Pages become gzip-per-record WARC/1.1 files in a shared folder: the smallest page_id of those with
equal payloads is a response, the others are revisits of it. Every task writes files of its own name
and reports where each record lies; only files that a successful task reports are used.

Index: captures sorted by reversed-host URL key, in compressed blocks of BLOCK lines; each index
file has a sparse directory of its blocks (first key, last key, offset, length). A look-up finds the
index file by binary search in the list of files (one entry per range partition), the block by
binary search in the file's directory, the lines by binary search in the block, and reads the
record by its range.

Defined cases: null html: empty payload. Null url: the empty key, and a record without target URI.
Null page_id: always a response, read back as null. Repeated rows: a record each, of one type. Empty
table: no files, no rows. Extra columns are not written.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, checkpointed, column, ensure_checkpoint_dir, join_by_key, map_in_arrow, table

#: Lines per block of the index, bytes after which a task begins another file, open files kept.
BLOCK, FILE_BYTES, OPEN = 500, 1 << 30, 32
#: Records that a task of a look-up reads, about.
READ = 8_000
#: The pages have no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Captures (key, page_id, file, at, length) and, by index file, the range of its keys."""

    captures: DataFrame
    parts: tuple[tuple[str, str, str], ...]


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: http://a.example.com/x?y -> com,example,a)/x?y."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname or ""
    except ValueError:
        host = ""
    if not host:
        return url or ""
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + rest


def _head(fields: list[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit (without the payload) of the page it refers to."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\n" + _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    if refers_to is None:
        block += payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return gzip.compress(b"WARC/1.1\r\n" + _head(fields) + block + b"\r\n\r\n", 6, mtime=0)


def _fields(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])


def parsed(member: bytes) -> dict:
    """page_id, url, record_type, payload (None of a revisit), payload_bytes, payload_digest, refers_to."""
    head, rest = gzip.decompress(member).split(b"\r\n\r\n", 1)
    warc = _fields(head)
    block = rest[:int(warc["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size, digest = int(_fields(http)["Content-Length"]), warc["WARC-Payload-Digest"].removeprefix("sha1:")
    response = warc["WARC-Type"] == "response"
    if response and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"record {warc['WARC-Record-ID']} is damaged")
    number = lambda x: int(x) if (x := (x or "").removeprefix("<urn:page:").removesuffix(">")) else None
    return {"page_id": number(warc["WARC-Record-ID"]), "url": warc.get("WARC-Target-URI"), "record_type": warc["WARC-Type"],
            "payload": payload if response else None, "payload_bytes": size, "payload_digest": digest, "refers_to": number(warc.get("WARC-Refers-To"))}


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, digest, first: rows whose payload (``least`` bytes or more) a page of smaller id has."""
    facts = pages.select("page_id", F.sha1("html").alias("digest")).where(F.octet_length("html") >= least) if least else pages.select("page_id", F.sha1("html").alias("digest"))
    shared = checkpointed(facts.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    total = shared.agg(F.sum("n")).first()[0] or 0
    return join_by_key(facts, shared, ["digest"], total).where("page_id != first").distinct()


def write(pages: DataFrame, to: str, least: int = 0) -> DataFrame:
    """Writes the records of all rows below ``to``; key, page_id, file, at, length of each."""
    read = pages.select(column("page_id").cast("long").alias("page_id"), column("url").cast("string").alias("url"), F.coalesce(column("html").cast("string"), F.lit("")).alias("html"))
    again = revisits(read, least)
    records = read.withColumn("digest", F.sha1("html")).join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(to)
        store.create_dir(folder)
        out, at = None, 0
        for batch in by_bytes(batches, 2, 1 << 22):
            rows = []
            if out is None or at > FILE_BYTES:
                if out is not None:
                    out.close()
                name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                out = store.open_output_stream(name, compression=None)
            for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns)):
                member = record(page_id, url, html.encode(), first)
                out.write(member)
                rows.append((url_key(url), page_id, name, at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                             ["key", "page_id", "file", "at", "length"])
        if out is not None:
            out.close()

    return checkpointed(map_in_arrow(records, run, "key string, page_id long, file string, at long, length long"))


def index(captures: DataFrame, to: str) -> Archive:
    """Writes the blocks and directories of the index below ``to``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(to)
        store.create_dir(folder)
        out, at, lines, directory = None, 0, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.cdx"
                    out = store.open_output_stream(name, compression=None)
                lines.append(row)
                if len(lines) == BLOCK:
                    directory.append((*_block(out, lines), at))
                    at += directory[-1][2]
                    lines = []
        if out is None:
            return
        if lines:
            directory.append((*_block(out, lines), at))
        out.close()
        with store.open_output_stream(name + ".dir", compression=None) as f:
            f.write(zlib.compress(json.dumps(directory).encode()))
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (directory[0][0], directory[-1][1], name)], ["first", "last", "file"])

    ordered = captures.repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")
    parts = map_in_arrow(ordered, run, "first string, last string, file string").collect()  # one row per range partition
    return Archive(captures, tuple(sorted(map(tuple, parts))))


def _block(out: pa.NativeFile, lines: list[tuple]) -> tuple[str, str, int]:
    data = zlib.compress(json.dumps(lines).encode())
    out.write(data)
    return lines[0][0], lines[-1][0], len(data)


def look_up(archive: Archive, keys: DataFrame, payload: bool = True) -> DataFrame:
    """The records of all captures whose URL key is among ``keys`` (column key), read by range."""
    # keys are compared as UTF-8 bytes, as Spark sorts them
    parts = sorted((a.encode(), z.encode(), f) for a, z, f in archive.parts)
    firsts = [p[0] for p in parts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                k = key.encode()
                part = bisect_right(firsts, k) - 1
                while part >= 0 and parts[part][1] >= k:  # a key may fill several files
                    rows.append((key, part))
                    part -= 1
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], ["key", "part"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, pa.NativeFile] = {}
        part = block = directory = lines = None

        def ranged(name: str, at: int, n: int) -> bytes:
            if name not in files:
                if len(files) >= OPEN:
                    files.pop(next(iter(files))).close()
                store, path = opened(name)
                files[name] = store.open_input_file(path)
            files[name].seek(at)
            return files[name].read(n)

        for batch in batches:
            rows, size = [], 0
            for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != part:
                    part, block = number, None
                    store, path = opened(parts[part][2] + ".dir")
                    with store.open_input_stream(path, compression=None) as f:
                        directory = json.loads(zlib.decompress(f.read()))
                    lasts = [d[1].encode() for d in directory]
                k = key.encode()
                at = bisect_left(lasts, k)
                while at < len(directory) and directory[at][0].encode() <= k:
                    if at != block:
                        block, (_, _, n, start) = at, directory[at]
                        lines = json.loads(zlib.decompress(ranged(parts[part][2], start, n)))
                        line_keys = [x[0].encode() for x in lines]
                    for _, _, name, start, n in lines[bisect_left(line_keys, k):bisect_right(line_keys, k)]:
                        r = parsed(ranged(name, start, n))
                        if not payload:
                            r["payload"] = None
                        rows.append({"key": key, **r})
                        size += len(r["payload"] or b"") + 200
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, size = [], 0
                    at += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow)

    arrow = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
    routed = map_in_arrow(keys.select("key").distinct(), route, "key string, part int")
    # by the records to be read, not by the bytes of their keys; a key with many captures lies in several files
    tasks = max(1, -(-archive.captures.count() // READ))
    return map_in_arrow(routed.repartitionByRange(tasks, "part", "key").sortWithinPartitions("part", "key"), fetch,
                        "key string, page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def archive_pages(pages: DataFrame, to: str, least: int = 0) -> Archive:
    """Writes and indexes the pages below ``to`` (a folder that all executors reach)."""
    return index(write(pages, f"{to}/warc", least), f"{to}/index")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    archive = archive_pages(table(spark, sf_dir, "pages"), to)
    back = look_up(archive, archive.captures.select("key"), payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BITS = "array_to_string(list_transform(string_split(sha1(coalesce(html, '')), ''), lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', c)]), '')"
_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * bits[5*i+1]::int + 8 * bits[5*i+2]::int + 4 * bits[5*i+3]::int + 2 * bits[5*i+4]::int + bits[5*i+5]::int, 1)"
SQL = f"""with p as (select page_id, strlen(coalesce(html, '')) as n, {_BITS} as bits from pages),
    d as (select page_id, n, array_to_string(list_transform(range(32), lambda i: {_LETTER}), '') as digest from p),
    f as (select *, min(page_id) over (partition by digest) as first from d)
    select page_id, n as payload_bytes, digest as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
      case when page_id = first then null else first end as refers_to from f"""
