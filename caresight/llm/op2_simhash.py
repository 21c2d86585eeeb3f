"""SimHash near-duplicates, compared bit-sliced.

A text's fingerprint is the majority of its shingles' hash bits. Fingerprints that differ in at
most ``radius`` bits are linked; groups are the connected components.

Candidates: the 64 bits are cut into ``blocks`` blocks. Two fingerprints within the radius agree in
``blocks - radius`` of them at least, so they meet in one of the tables that take that many blocks
as key: no link is lost. Only different fingerprints take part. Within a bucket, 64 fingerprints at
a time stand as bit planes; the distances of one to all 64 are counted with carry-save adders, and
a block of 64 is given up as soon as all exceed the radius. A bucket yields a spanning forest of its
links, never its pairs.

More blocks make smaller buckets and more tables: with 6 blocks and radius 4, 15 tables of about
21 bits; 8 blocks (70 tables of 32 bits) suit some 10^10 fingerprints. Buckets with over
max(CHUNK, 1/10,000 of the fingerprints) are split into up to PARTS chunks, whose pairs are cells
of their own; the list of such buckets is bounded by 10,000 a table and is broadcast.

Defined cases: null or empty text, or no words: fingerprint zero, linked like any other. Null id:
the row takes part, and its component is the smallest id reached, null if there is none. Repeated
rows: one result row for each. Empty table: no rows. Extra columns are not read.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from xxhash import xxh64_digest

from caresight.llm.common import by_bytes, checkpointed, column, join_by_key, map_in_arrow, named_again, plainly_named, table
from caresight.llm.components import components

SHINGLE, RADIUS, BLOCKS = 4, 4, 6
#: Fingerprints in a chunk of a split bucket; chunks at most; shingles, rows and (fingerprint, word) pairs at a time.
CHUNK, PARTS, RUN, ROWS, SLAB = 4096, 64, 1 << 16, 1 << 15, 1 << 14


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles (ASCII lower case, XXH64 with seed 42)."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, white space \x20 \x09-\x0d only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ends = list(itertools.accumulate(map(len, words), lambda at, k: at + k + 1))
    starts = [0, *[e + 1 for e in ends]]
    joined = b" ".join(words)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, RUN):
        to = min(n, at + RUN)
        stops = ends[at + size - 1:to + size - 1] if len(words) >= size else [len(joined)]
        hashes = b"".join([xxh64_digest(joined[s:e], 42) for s, e in zip(starts[at:to], stops)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, 1 << 22):
            fps = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    return map_in_arrow(read, run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, fp long")


def tables(blocks: int, radius: int) -> list[list[tuple[int, int]]]:
    """For each table the (shift, width) of the blocks in its key."""
    if not radius < blocks <= 64:
        raise ValueError("blocks must be over the radius, and 64 at most")
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [[(a, b - a) for a, b in pick] for pick in itertools.combinations(list(itertools.pairwise(cuts)), blocks - radius)]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words; bit i of word w in row p is bit p of fingerprint 64 w + i."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _carry_save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bits in each lane."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count exceeds the radius."""
    more, same = over.copy(), np.full_like(over, ~np.uint64(0))
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def within(planes: np.ndarray, fps: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, lane) of all wanted lanes within the radius; ``lanes`` masks those wanted of each word."""
    zero = np.zeros(len(query), np.uint64)
    counters, over = [zero.copy() for _ in range(max(3, radius.bit_length()))], zero.copy()
    one, full = np.uint64(1), ~np.uint64(0)
    for plane in range(0, 64, 4):
        d = [planes[p][word] ^ (((fps[query] >> np.uint64(p)) & one) * full) for p in range(plane, plane + 4)]
        counters[0], a = _carry_save(counters[0], d[0], d[1])
        counters[0], b = _carry_save(counters[0], d[2], d[3])
        counters[1], up = _carry_save(counters[1], a, b)
        for k in range(2, len(counters)):
            counters[k], up = counters[k] ^ up, counters[k] & up
        over |= up
        if plane >= 12 and plane % 8 == 4:
            left = lanes & ~_beyond(counters, over, radius)
            alive = left != 0
            if not alive.any():
                return
            if alive.sum() < 0.8 * len(alive):  # blocks all of whose lanes exceed the radius are given up
                query, word, lanes, over = query[alive], word[alive], lanes[alive], over[alive]
                counters = [c[alive] for c in counters]
    left = lanes & ~_beyond(counters, over, radius)
    hit = np.flatnonzero(left)
    if len(hit):
        bits = np.unpackbits(left[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, lane = np.nonzero(bits)
        yield query[hit][at], word[hit][at] * 64 + lane


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[i] and b[i]; the smaller index becomes the root."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b = a[apart], b[apart]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def forest(fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (index, root index) of a spanning forest of all links between i and lo[i] to hi[i] - 1."""
    planes, parent = bit_planes(fps), np.arange(len(fps))
    first, words = lo >> 6, np.maximum(0, ((hi - 1) >> 6) - (lo >> 6) + 1)
    words[hi <= lo] = 0
    ends = np.cumsum(words)
    for at in range(0, int(ends[-1]) if len(ends) else 0, SLAB):
        flat = np.arange(at, min(at + SLAB, int(ends[-1])))
        query = np.searchsorted(ends, flat, side="right")
        word = first[query] + flat - (ends[query] - words[query])
        low, high = np.maximum(lo[query] - 64 * word, 0), np.minimum(hi[query] - 64 * word, 64)
        full = ~np.uint64(0)
        lanes = (full >> (64 - high).astype(np.uint64)) & (full << low.astype(np.uint64))
        for q, lane in within(planes, fps, query, word, lanes, radius):
            _join(parent, q, lane)
    joined = np.flatnonzero(parent != np.arange(len(fps)))
    return joined, parent[joined]


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the different ``fp`` given."""
    total = fps.count()
    keys = []
    for t, pick in enumerate(tables(blocks, radius)):
        key = F.lit(0).cast("long")
        for shift, width in pick:
            part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(F.struct(F.lit(t).alias("t"), key.alias("key")))
    members = fps.select("fp", F.explode(F.array(*keys)).alias("b")).select("fp", "b.t", "b.key")
    hot = (members.groupBy("t", "key").agg(F.count("*").alias("n"))
           .where((F.col("n") > CHUNK) & (F.col("n") * 10_000 > total))
           .select("t", "key", F.least(F.lit(PARTS), F.ceil(F.col("n") / CHUNK)).cast("int").alias("parts")))
    chunk = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = (members.join(F.broadcast(hot), ["t", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("c", chunk).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("fp", "t", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), (F.col("c") > F.col("o")).cast("int").alias("side")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                got = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
                held = got if held is None else np.concatenate([held, got])
                if len(held) < ROWS:
                    continue
            if held is None or not len(held):
                continue
            new = np.flatnonzero((held[1:, 1:5] != held[:-1, 1:5]).any(axis=1)) + 1
            if batch is not None:  # the last cell may go on
                if not len(new):
                    continue
                held, now = held[new[-1]:], held[:new[-1]]
                new = new[:-1]
            else:
                now, held = held, None
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(now)]])
            sizes = ends - starts
            end = np.repeat(ends, sizes)
            other = np.repeat(ends - np.add.reduceat(now[:, 5], starts), sizes)  # first row of side 1
            apart = now[:, 3] != now[:, 4]
            row = np.arange(len(now))
            lo = np.where(apart, other, row + 1)
            hi = np.where(apart & (now[:, 5] == 1), lo, end)
            several = np.repeat(sizes > 1, sizes)
            hi = np.where(several, hi, lo)
            a, b = forest(np.ascontiguousarray(now[:, 0]).view(np.uint64), lo, hi, radius)
            yield pa.RecordBatch.from_arrays([pa.array(now[a, 0]), pa.array(now[b, 0])], ["a", "b"])

    placed = cells.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "side", "fp")
    return map_in_arrow(placed, run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id of the row's group) of each row."""
    marked = checkpointed(fingerprints(docs, size, doc_id, text))
    by_fp = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = components(links(by_fp.select("fp"), radius, blocks))
    named = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = checkpointed(named.withColumnRenamed("n", "rows"))
    smallest = checkpointed(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n")))
    keyed = checkpointed(join_by_key(named, smallest, ["root"], named.count()).select("fp", F.col("rows").alias("n"), "component_id"))
    return join_by_key(marked, keyed, ["fp"], marked.count()).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the first document (smallest id) of each group, all columns kept.

    Rows that repeat an id (of any type that sorts) count as one document, of which one row stays.
    Rows without an id are told apart by their text and come after those that have one.
    """
    plain = plainly_named(docs)
    own, body = F.col(f"c{docs.columns.index(doc_id)}"), F.col(f"c{docs.columns.index(text)}").cast("string")
    named = F.struct(own.isNull().alias("missing"), own.alias("id"),
                     F.when(own.isNull(), F.sha2(F.coalesce(body, F.lit("")), 256)).otherwise("").alias("text"))
    keyed = plain.withColumn("key", named)
    groups = near_duplicates(keyed, size, radius, blocks, "key", f"c{docs.columns.index(text)}")
    first = groups.where("doc_id <=> component_id").select(F.col("doc_id").alias("first_key")).distinct()
    return named_again(keyed.join(first, F.expr("key <=> first_key"), "left_semi").dropDuplicates(["key"]), docs)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
