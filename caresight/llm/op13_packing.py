"""Packing documents into sequences of bounded length by multiway differencing.

A document is the ids of its whole text and an end id. Documents are cut into pieces: whole sequences
as long as they last, then pieces of at most ``PIECE`` ids. Each task packs its pieces in groups of
``WINDOWS`` sequences (ids of one group are held at a time). In a group every piece begins as a partial
partition of its own: one window holds it, the others are empty. The two partial partitions with the
largest imbalance are merged, fullest window to emptiest and so on, until one is left: its windows
are nearly equal. If the fullest is over capacity, the same is done with one window more.

What a task has left at its end fills its windows exactly or goes, cut again, into sequences whose
lengths are powers of two (these are not padded), so small partitions cost no padding either.

Ids are those of the ``tokenizers`` library. The different units of some MB of text (``unitids``) are
encoded once, in joined strings whose ids are told apart by their leading space or line end, by the
faster engine of ``tiktoken`` over the same merges. Units with other characters or strings of added tokens, and
texts that can't be cut so everywhere, go to the library itself. Tests hold both against the library.

No row is shuffled, so no key can be hot. A sequence's number holds that of the partition that made it.

Defined cases: null or empty text: the end id alone. Null or repeated ids: a document per row. Empty
table: no rows. Extra columns are not read; the output has the operator's columns only.
"""
from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, column, map_in_arrow, table
from caresight.llm.unitids import UnitCoder, joined

#: Ids of a sequence, of a piece at most; windows of a group; ids left free in each for balance.
LENGTH, PIECE, WINDOWS, FREE = 2048, 512, 256, 8
#: Bytes of text per group of rows, bytes of units per call.
GROUP_BYTES, CALL_CHARS = 1 << 23, 1 << 16

_encoders: dict[str, Encoder] = {}


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable characters of Latin-1
    stand for themselves, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder(UnitCoder):
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters = _byte_letters()
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        words = {w: i for w, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if w not in added}
        ranks = {bytes(map(letters.__getitem__, w)): i for w, i in words.items()}
        #: The same merges, run by an engine that is some three times as fast.
        self.merges = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = list(added)
        #: Ids that begin a unit: their first byte is a space or a line end.
        self.leads = np.zeros(max([*ranks.values(), *added.values()]) + 1, bool)
        self.leads[[i for w, i in ranks.items() if w[:1] in (b" ", b"\n")]] = True

    def _library(self, string: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([string], add_special_tokens=False)[0].ids, np.uint32)

    code_text = _library

    def code_units(self, units: pa.Array, plain: np.ndarray, sound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for special in self.added:
            plain = plain & ~pc.match_substring(units, special).to_numpy(zero_copy_only=False)
        pool, starts, sizes, n = [np.zeros(0, np.uint32)], np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), 0
        where = np.flatnonzero(plain)
        for a, z, string in joined(units.take(pa.array(where)), CALL_CHARS):
            ids = np.array(self.merges.encode_ordinary(string), np.uint32)
            cuts = np.flatnonzero(self.leads[ids])
            starts[where[a:z]] = n + cuts
            sizes[where[a:z]] = np.diff(cuts, append=len(ids))
            pool.append(ids)
            n += len(ids)
        for i in np.flatnonzero(sound & ~plain).tolist():
            ids = self._library(units[i].as_py())
            starts[i], sizes[i] = n, len(ids)
            pool.append(ids)
            n += len(ids)
        return np.concatenate(pool), starts, sizes


def encoder(path: str) -> Encoder:
    """This worker's encoder for a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def differenced(sizes: list[int], windows: int) -> tuple[np.ndarray, list[list[int]]]:
    """Sums of the windows, fullest first, and the items in each: multiway differencing.

    A partial partition is kept as its windows' sums, fullest first, with the first and last item of
    each window; items of a window are chained.
    """
    chain = np.full(len(sizes), -1)
    heap = []
    for i, size in enumerate(sizes):
        sums, first = np.zeros(windows, np.int64), np.full(windows, -1)
        sums[0], first[0] = size, i
        heap.append((-size, i, sums, first, first.copy()))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, sums, first, last = heapq.heappop(heap)
        _, _, more, head, tail = heapq.heappop(heap)
        sums, head, tail = sums + more[::-1], head[::-1], tail[::-1]
        joined = (first >= 0) & (head >= 0)
        chain[last[joined]] = head[joined]
        first, last = np.where(first >= 0, first, head), np.where(head >= 0, tail, last)
        order = np.argsort(-sums, kind="stable")
        sums, first, last = sums[order], first[order], last[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, first, last))
        made += 1
    _, _, sums, first, _ = heap[0]
    follow, held = chain.tolist(), []
    for i in first.tolist():
        own = []
        while i >= 0:
            own.append(i)
            i = follow[i]
        held.append(own)
    return sums, held


def balanced(sizes: list[int], length: int, windows: int) -> list[list[int]]:
    """Items of each window, with as many windows more as it takes to hold all."""
    while True:
        sums, held = differenced(sizes, windows)
        if sums[0] <= length:
            return held
        windows += 1


#: A piece: (id of the document, ids before it, its ids, ids of the document).
Piece = tuple[object, int, np.ndarray, int]


class Packer:
    """Packs one task's documents; ``done`` holds (piece, sequence, offset)."""

    def __init__(self, length: int, first: int):
        self.length, self.next, self.open, self.held, self.done = length, first, [], 0, []
        self.full = WINDOWS * (length - min(FREE, length // 8))

    def _sequence(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.done.append((p, self.next, at))
            at += len(p[2])
        self.next += 1

    def add(self, doc: object, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.length:
            self._sequence([(doc, at, ids[at:at + self.length], n)])
            at += self.length
        most = min(PIECE, max(1, self.length // 4))
        while at < n:
            to = min(n, at + most, at + self.full - self.held)
            self.open.append((doc, at, ids[at:to], n))
            self.held += to - at
            at = to
            if self.held == self.full:
                self._close(self.open, WINDOWS)
                self.open, self.held = [], 0

    def _close(self, pieces: list[Piece], windows: int) -> None:
        for own in balanced([len(p[2]) for p in pieces], self.length, windows):
            if own:
                self._sequence([pieces[i] for i in own])

    def end(self) -> None:
        """The rest: whole windows, and what is over in sequences of powers of two."""
        windows, over = divmod(self.held, self.length)
        while over:
            room = 1 << (over.bit_length() - 1)
            over -= room
            own = []
            while room:
                doc, at, ids, n = self.open.pop()
                take = min(room, len(ids))
                left = len(ids) - take
                own.append((doc, at + left, ids[left:], n))
                if left:
                    self.open.append((doc, at, ids[:left], n))
                room -= take
            self._sequence(own)
        if windows:
            self._close(self.open, windows)
        self.open, self.held = [], 0


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), ids (little-endian 32-bit,
    binary), length, doc_tokens (with the end id), sequence_id, offset (in the sequence).

    Sequences hold at most ``length`` ids and are to be padded to that, but for those whose length
    is a power of two.
    """
    end = np.array([end_id], np.uint32)
    names = ["doc_id", "start", "ids", "length", "doc_tokens", "sequence_id", "offset"]
    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()

    def rows(packer: Packer, typed: pa.DataType) -> pa.RecordBatch:
        docs, starts, ids, totals = zip(*[p for p, _, _ in packer.done])
        out = [pa.array(docs, typed), pa.array(starts, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()),
               pa.array(totals, pa.int64()), pa.array([s for _, s, _ in packer.done], pa.int64()), pa.array([o for _, _, o in packer.done], pa.int64())]
        packer.done = []
        return pa.RecordBatch.from_arrays(out, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer, typed = encoder(tokenizer), Packer(length, TaskContext.get().partitionId() << 40), None
        for batch in by_bytes(batches, 1, GROUP_BYTES):
            typed = batch.column(0).type
            texts = own.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc, ids in zip(batch.column(0).to_pylist(), texts):
                packer.add(doc, np.concatenate([ids, end]))
            if packer.done:
                yield rows(packer, typed)
        packer.end()
        if packer.done:
            yield rows(packer, typed)

    return map_in_arrow(read, run, f"doc_id {kind}, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids (binary, in order) and parts (doc_id, start, length) of each sequence.

    A group is one sequence, so its size is bounded.
    """
    one = F.struct("offset", "ids", "doc_id", "start", "length")
    own = F.array_sort(F.collect_list(one))
    return pieces.groupBy("sequence_id").agg(own.alias("own")).select(
        "sequence_id", F.aggregate("own", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("own", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length"))).alias("parts"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
