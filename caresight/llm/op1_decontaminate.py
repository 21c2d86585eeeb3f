"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, verification.

Words are lower-cased runs without white space or ASCII punctuation; shingles have five words (an
item with fewer is one shingle). A shingle weighs as many bytes as its words have. For each length
of an item, windows of that many words slide over every whole text. A window's fingerprint is the
weighted majority of its shingles' hash bits. Items of that length lie in an index of BLOCKS blocks
of the fingerprint's bits: two fingerprints within RADIUS differ in RADIUS // BLOCKS bits at most in
some block, and all such block values lead to the item, so every item within the radius is found. The
candidates' weighted Jaccard similarity (of shingle multisets) decides.

Similarity of 0.8 means a cosine of about 0.89, which is 9.7 of 64 bits on average (deviation 2.9):
RADIUS 16 takes in all but about one in a hundred of the cases just at the threshold.

Fingerprints are only taken where a window can match: shingles that no item has may carry at most
1 - threshold of its weight. This loses nothing, as they count in full in the union.

The items go to the tasks in slices of about SLICE_WORDS words or SLICE_ITEMS items at most (the
benchmark's size is measured first; rows that repeat an item are one); each slice is a pass over the documents. Documents are never shuffled.

Defined cases: null or empty text: never contaminated. Items without words: match nothing. Texts
shorter than an item are one window. Null ids are returned as they are. Repeated rows: a result for
each. Empty tables: no rows; extra columns are not read (``drop_contaminated`` keeps them).
"""
from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, column, map_in_arrow, table, word_hashes

SHINGLE, THRESHOLD, RADIUS, BLOCKS = 5, 0.8, 16, 6
#: Words and items per slice (an item's index entries take some 3 KB); bits of the filter of shingles.
SLICE_WORDS, SLICE_ITEMS, FILTER_BITS = 2_000_000, 20_000, 22
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def shingles(words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight (bytes) of each run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    out, weight = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for k in range(size):
        out = (out ^ h[k:k + n]) * _ODD
        out ^= out >> np.uint64(29)
        weight += length[k:k + n]
    return out, weight


def _signs(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (2 * bits.astype(np.int64) - 1) * weights[:, None]


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets of shingles (hash, weight)."""
    both, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    weight = np.zeros(len(both), np.int64)
    weight[where] = np.concatenate([a[1], b[1]])
    in_a = np.bincount(where[:len(a[0])], minlength=len(both))
    in_b = np.bincount(where[len(a[0]):], minlength=len(both))
    union = (np.maximum(in_a, in_b) * weight).sum()
    return float((np.minimum(in_a, in_b) * weight).sum() / union) if union else 0.0


class HammingBlocks:
    """Items by the block values that lie near those of their fingerprints."""

    def __init__(self, fps: np.ndarray, radius: int, blocks: int):
        self.fps, self.radius = fps, radius
        cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
        self.parts = []
        for a, b in itertools.pairwise(cuts):
            masks = np.array([sum(1 << i for i in pick) for k in range(radius // blocks + 1) for pick in itertools.combinations(range(b - a), k)], np.int64)
            values = (self._block(fps, a, b)[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << (b - a)) + 1))
            self.parts.append((a, b, starts, order // len(masks)))

    @staticmethod
    def _block(fps: np.ndarray, a: int, b: int) -> np.ndarray:
        return ((fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)

    def near(self, fps: np.ndarray) -> list[tuple[int, int]]:
        """(query, item) of all pairs within the radius."""
        found: set[tuple[int, int]] = set()
        for a, b, starts, items in self.parts:
            value = self._block(fps, a, b)
            lo = starts[value]
            n = starts[value + 1] - lo
            query = np.repeat(np.arange(len(fps)), n)
            item = items[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(query))]
            close = np.bitwise_count(fps[query] ^ self.fps[item]) <= self.radius
            found.update(zip(query[close].tolist(), item[close].tolist()))
        return sorted(found)


class Items:
    """A slice of the benchmark, ready to be looked for in texts."""

    def __init__(self, items: list[tuple], threshold: float, radius: int, blocks: int):
        self.threshold = threshold
        groups: dict[int, list] = {}
        for item_id, text in items:
            words = words_of(text)
            if words:
                groups.setdefault(len(words), []).append((item_id, shingles(words, min(SHINGLE, len(words)))))
        #: By length in words: size of shingles, items, index.
        self.groups = {}
        for length, own in sorted(groups.items()):
            fps = _packed(np.array([_signs(*s).sum(axis=0) for _, s in own]))
            self.groups[length] = (min(SHINGLE, length), own, HammingBlocks(fps, radius, blocks))
        self.known = {}
        for size in {g[0] for g in self.groups.values()}:
            known = np.unique(np.concatenate([s[0] for g in self.groups.values() if g[0] == size for _, s in g[1]]))
            marks = np.zeros(1 << FILTER_BITS, bool)
            marks[known >> np.uint64(64 - FILTER_BITS)] = True
            self.known[size] = (known, marks)

    def found(self, text: str | None) -> list[tuple]:
        """(item_id, similarity, first word, words) of the best window for each item in the text."""
        words = words_of(text)
        best: dict[int, tuple] = {}
        taken = {}
        for size, (known, marks) in self.known.items():
            h, w = shingles(words, size)
            held = marks[h >> np.uint64(64 - FILTER_BITS)]
            if held.any():
                held[held] = known[np.minimum(np.searchsorted(known, h[held]), len(known) - 1)] == h[held]
                if held.any():
                    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (w, w * held)]
                    taken[size] = (h, w, *sums)
        for length, (size, own, index) in self.groups.items():
            if size not in taken:
                continue
            h, w, weight, shared = taken[size]
            span = min(length - size + 1, len(h))
            can = shared[span:] - shared[:-span] >= self.threshold * (weight[span:] - weight[:-span])
            starts = np.flatnonzero(can)
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1) if len(starts) else []:
                for at in range(0, len(part), 4096):  # windows that lie close together share running sums
                    some = part[at:at + 4096]
                    a, z = some[0], some[-1] + span
                    run = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(_signs(h[a:z], w[a:z]), axis=0)])
                    fps = _packed(run[some - a + span] - run[some - a])
                    for q, i in index.near(fps):
                        s = some[q]
                        sim = similarity((h[s:s + span], w[s:s + span]), own[i][1])
                        if sim >= self.threshold and sim > best.get((length, i), (0.0,))[0]:
                            best[length, i] = (sim, int(s), span + size - 1)
        return [(self.groups[length][1][i][0], *x) for (length, i), x in best.items()]


def slices(benchmark: DataFrame, threshold: float, radius: int, blocks: int, item_id: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The benchmark in parts of bounded size."""
    items = benchmark.select(column(item_id).alias("i"), F.coalesce(column(text).cast("string"), F.lit("")).alias("t")).distinct()
    words, n = items.agg(F.sum(F.size(F.split("t", r"\s+"))), F.count("*")).first()
    parts = max(1, math.ceil((words or 0) / SLICE_WORDS), math.ceil(n / SLICE_ITEMS))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).collect()  # about SLICE_WORDS words
        yield Items([(r.i, r.t) for r in rows], threshold, radius, blocks)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS, blocks: int = BLOCKS,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: each item found in a document, at its best window."""
    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kinds = [f.schema[0].dataType.simpleString() for f in (read.select("doc_id"), benchmark.select("item_id"))]
    item_type = pa.int64() if kinds[1] in ("bigint", "int") else pa.string()

    def search(items: Items, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, 1 << 22):
            rows = [(k, *x) for k, t in enumerate(batch.column(1).to_pylist()) for x in items.found(t)]
            if rows:
                k, item, sim, first, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(k)), pa.array(item, item_type), pa.array(sim, pa.float64()),
                                                  pa.array(first, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "item_id", "similarity", "first_word", "n_words"])

    schema = f"doc_id {kinds[0]}, item_id {'bigint' if item_type == pa.int64() else 'string'}, similarity double, first_word long, n_words long"
    found = [map_in_arrow(read, functools.partial(search, s), schema) for s in slices(benchmark, threshold, radius, blocks)]
    return functools.reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS, blocks: int = BLOCKS, text: str = "text") -> DataFrame:
    """The rows in which no item is found, with all their columns."""
    at = docs.columns.index(text)

    def clean(items: Items, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at, 1 << 22):
            yield batch.filter(pa.array([not items.found(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    for items in slices(benchmark, threshold, radius, blocks):
        docs = map_in_arrow(docs, functools.partial(clean, items), docs.schema)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
