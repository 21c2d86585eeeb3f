r"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of consecutive words whose words ``period`` apart are equal, which no neighbouring
word extends, with the smallest such period and at least ``exponent`` (3 or more) whole periods.
Words are ``[^\x20\x09-\x0D]+``, compared exactly.

At the scale B = 1, 2, 4, .. the words of some MB of text are cut into blocks of B words. A run of a
period from B to 2B - 1 holds, in a row, aligned blocks that occur again a period later. For all
blocks at once the sum of squared differences between a block and every place of the following window
is taken by number-theoretic transforms modulo so many primes that their product exceeds any such sum:
it is zero there exactly where the block occurs. Distances that enough blocks in a row share are
seeds; each is extended word by word to both sides, and kept if it is long enough.

Two exact tests spare most transforms: all words of a block that occurs in its window occur again
within 2B words; and where the whole window lies in a run of a smaller period, another run through
the block would, by the periodicity lemma, have that run's period.

Rows are worked on in place: no shuffle, no hot keys. A text is held whole by its task.

Defined cases: null or empty text, or white space only: no words, no runs, empty collapsed text. Null
or repeated ids: a row each. Ties for the strongest run: smallest start, then period. Empty table: no
rows. Extra columns are not read; the output has the operator's columns only.
"""
from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, column, map_in_arrow, table

#: Words of a run at least, and whole periods of it.
LENGTH, EXPONENT = 6, 4
#: Bytes of text per group of rows, numbers of a transform at a time.
GROUP_BYTES, CHUNK = 1 << 22, 1 << 19
# Primes of the form k * 2^26 + 1 below 2^31, with a primitive root of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
GAP = r"[\x20\x09-\x0D]+"


def transformed(a: np.ndarray, p: int, root: int) -> np.ndarray:
    """Number-theoretic transform of each row (length a power of two) modulo p, by halving the
    frequencies; values come in bit-reversed order."""
    n = a.shape[1]
    while n > 1:
        half = n >> 1
        w = pow(root, (p - 1) // n, p)
        powers = np.ones(half, np.uint64)
        k = 1
        while k < half:
            powers[k:2 * k] = powers[:k] * np.uint64(pow(w, k, p)) % np.uint64(p)
            k *= 2
        a = a.reshape(len(a), -1, n)
        low, high = a[:, :, :half], a[:, :, half:]
        a = np.concatenate([(low + high) % np.uint64(p), (low + np.uint64(p) - high) * powers % np.uint64(p)], axis=2)
        n = half
    return a.reshape(a.shape[0], -1)


def restored(a: np.ndarray, p: int, root: int) -> np.ndarray:
    """The inverse of ``transformed``."""
    size, n = a.shape[1], 2
    back = pow(root, p - 2, p)
    while n <= size:
        half = n >> 1
        w = pow(back, (p - 1) // n, p)
        powers = np.ones(half, np.uint64)
        k = 1
        while k < half:
            powers[k:2 * k] = powers[:k] * np.uint64(pow(w, k, p)) % np.uint64(p)
            k *= 2
        a = a.reshape(len(a), -1, n)
        low, high = a[:, :, :half], a[:, :, half:] * powers % np.uint64(p)
        a = np.concatenate([(low + high) % np.uint64(p), (low + np.uint64(p) - high) % np.uint64(p)], axis=2)
        n *= 2
    return a.reshape(a.shape[0], -1) * np.uint64(pow(size, p - 2, p)) % np.uint64(p)


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Where each block (a row of B numbers) occurs in its window (2B - 1 numbers): B truth values.

    The sum of squared differences, by sums of squares and a cyclic correlation of length 2B, is
    compared with zero modulo each of the primes needed to exceed the largest possible sum.
    """
    width = blocks.shape[1]
    values, small = np.unique(np.concatenate([blocks.ravel(), windows.ravel()]), return_inverse=True)
    most = width * (len(values) - 1) ** 2
    blocks, windows = small[:blocks.size].reshape(blocks.shape), small[blocks.size:].reshape(windows.shape)
    here, product = np.ones((len(blocks), width), bool), 1
    for p, root in PRIMES:
        mod = np.uint64(p)
        b, w = blocks.astype(np.uint64) % mod, windows.astype(np.uint64) % mod
        turned, room = np.zeros((len(b), 2 * width), np.uint64), np.zeros((len(b), 2 * width), np.uint64)
        turned[:, (-np.arange(width)) % (2 * width)] = b
        room[:, :2 * width - 1] = w
        cross = restored(transformed(turned, p, root) * transformed(room, p, root) % mod, p, root)[:, :width]
        run = np.concatenate([np.zeros((len(w), 1), np.uint64), np.cumsum(w * w % mod, axis=1)], axis=1)
        squares = (b * b % mod).sum(axis=1, keepdims=True) + run[:, width:] - run[:, :width]
        here &= squares % mod == 2 * cross % mod
        product *= p
        if product > most:
            return here
    raise ValueError("text too long for the primes at hand")


class _Covered:
    """The found runs, for asking whether a stretch lies in one of them."""

    def __init__(self, n: int):
        self.reach = np.zeros(n + 1, np.int64)  # end of the farthest run that begins at a position

    def add(self, start: int, end: int) -> None:
        self.reach[start] = max(self.reach[start], end)

    def holds(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(self.reach)[starts] >= ends


def _extended(w: np.ndarray, at: int, to: int, q: int) -> tuple[int, int]:
    """The largest range around [at, to) in which words q apart are equal (starts of such pairs)."""
    step = 64
    while at > 0:
        a = max(0, at - step)
        differ = np.flatnonzero(w[a:at] != w[a + q:at + q])
        if len(differ):
            at = a + int(differ[-1]) + 1
            break
        at, step = a, step * 2
    step, last = 64, len(w) - q
    while to < last:
        z = min(last, to + step)
        differ = np.flatnonzero(w[to:z] != w[to + q:z + q])
        if len(differ):
            to += int(differ[0])
            break
        to, step = z, step * 2
    return at, to


def runs(w: np.ndarray, longest: int, length: int = LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in the numbers ``w``, of texts of ``longest`` words at most.

    Texts stand one after the other with a number between them that occurs nowhere else.
    """
    n = len(w)
    if not n:
        return []
    order = np.argsort(w, kind="stable")
    again = np.full(n, n + 1)
    again[order[:-1]] = np.where(w[order[1:]] == w[order[:-1]], order[1:] - order[:-1], n + 1)
    found: dict[tuple[int, int], int] = {}
    covered = _Covered(n)
    blocks_again, width = again, 1
    while exponent * width <= longest:
        held = len(blocks_again)
        alive = np.flatnonzero(blocks_again < 2 * width)
        if len(alive):
            starts = alive * width
            alive = alive[~covered.holds(starts, np.minimum(starts + 3 * width, n))]
        seeds_block, seeds_period = [], []
        padded = np.concatenate([w, np.full(3 * width, -1)]) if len(alive) else w
        per = max(1, CHUNK // (2 * width))
        for a in range(0, len(alive), per):
            part = alive[a:a + per]
            at = part[:, None] * width
            block, place = np.nonzero(occurrences(padded[at + np.arange(width)], padded[at + np.arange(width, 3 * width - 1)]))
            seeds_block.append(part[block])
            seeds_period.append(place + width)
        if seeds_block:
            block, period = np.concatenate(seeds_block), np.concatenate(seeds_period)
            by = np.lexsort((block, period))
            block, period = block[by], period[by]
            follows = (period[1:] == period[:-1]) & (block[1:] == block[:-1] + 1)
            heads = np.flatnonzero(np.concatenate([[True], ~follows])[:len(block)])
            count = np.diff(heads, append=len(block))
            # blocks in a row that the shortest run of this period holds
            need = (np.maximum(length, exponent * period[heads]) - period[heads] - width + 1) // width
            for k in np.flatnonzero(count >= need).tolist():
                q, x = int(period[heads[k]]), int(block[heads[k]]) * width
                s, e = _extended(w, x, x + int(count[k]) * width, q)
                if e + q - s >= max(length, exponent * q):
                    found.setdefault((s, e + q), q)  # a smaller period of the same stretch came first
        for (s, e), q in found.items():
            if width <= q:
                covered.add(s, e)
        width *= 2
        if held % 2:
            blocks_again = np.append(blocks_again, n + 1)
        blocks_again = blocks_again.reshape(-1, 2).max(axis=1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _group(texts: list[str | None], length: int, exponent: int) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """(words, runs, collapsed text) of each text."""
    # bytes.split() splits at \x20 and \x09-\x0D
    split = [(t or "").encode().split() for t in texts]
    numbers = pa.array([x for ws in split for x in ws], pa.binary()).dictionary_encode()
    ids = numbers.indices.to_numpy()
    sizes = np.array([len(ws) for ws in split], np.int64)
    firsts = np.cumsum(sizes + 1) - sizes - 1
    w = np.arange(len(numbers.dictionary), len(numbers.dictionary) + len(ids) + len(split), dtype=np.int64)
    inside = np.ones(len(w), bool)
    inside[firsts + sizes] = False
    w[inside] = ids
    own: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for s, n, q in runs(w, int(sizes.max(initial=0)), length, exponent):
        k = int(np.searchsorted(firsts, s, side="right")) - 1
        own[k].append((s - int(firsts[k]), n, q))
    for words, found in zip(split, own):
        if found:
            keep = np.ones(len(words), bool)
            for s, n, q in found:
                keep[s + q:s + n] = False
            words_left = [words[i] for i in np.flatnonzero(keep).tolist()]
        else:
            words_left = words
        yield len(words), found, b" ".join(words_left).decode()


def periodic_runs(docs: DataFrame, length: int = LENGTH, exponent: int = EXPONENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), strongest (the run with the
    most periods) and collapsed (the text without what repeats a run's first period) of each row."""
    if exponent < 3 or length < exponent:
        raise ValueError("a run has three periods at least, and as many words")
    run = "struct<start: bigint, length: bigint, period: bigint>"
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    names = ["start", "length", "period"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, GROUP_BYTES):
            rows = list(_group(batch.column(1).to_pylist(), length, exponent))
            best = [min(rs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if rs else None for _, rs, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in rows], pa.int64()),
                 pa.array([[dict(zip(names, r)) for r in rs] for _, rs, _ in rows], pa.list_(one)),
                 pa.array([r and dict(zip(names, r)) for r in best], one), pa.array([t for _, _, t in rows], pa.string())],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"])

    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return map_in_arrow(read, found, f"doc_id {kind}, n_words long, runs array<{run}>, strongest {run}, collapsed string")


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text; where the CRC-32 of the decimal id ends in 0, the words from one on are replaced
    so that they repeat with a period, both given by the rest of the CRC-32 (g)."""
    h = F.crc32(F.coalesce(column(doc_id).cast("string"), F.lit("")))
    words = F.array_remove(F.split(F.coalesce(column(text).cast("string"), F.lit("")), GAP), "")
    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    read = read.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    turned = F.transform("w", lambda x, i: F.when(i < a, x).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return read.select("doc_id", F.when(n > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def _lines(runs: Column) -> Column:
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(_lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
