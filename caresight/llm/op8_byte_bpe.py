"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each match of the pre-token pattern is encoded by itself. Its bytes form a linked list; every
adjacent pair that is a token lies in the bucket of its merge rank. A bitmap of three levels marks
the buckets that hold anything; find-first-set on it gives the lowest rank, whose positions are merged
from the left. Entries made stale by a neighbour's merge are skipped when met. A step costs the same
in a pre-token of a million bytes as in a short one (but for sorting a bucket).

The different units of some MB of text are encoded once (``unitids``), and their ids remembered for
the next two groups of texts, those that recur first, so what no longer occurs is forgotten. Tokens of a batch are decoded by one Arrow ``take``.

Defined cases: null or empty text: no ids, empty bytes. Null or repeated ids of rows: a row each.
Empty table: no rows. Extra columns are not read; the output has the operator's columns only.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, column, map_in_arrow, table
from caresight.llm.unitids import UnitCoder, joined

#: Bytes of text per group of rows; bytes of new pre-tokens per run of the queue (a longer one has a run
#: of its own) and of units split at a time; units remembered of a group, and their length.
GROUP_BYTES, RUN_BYTES, SPLIT_BYTES, REMEMBERED, UNIT_CHARS = 1 << 22, 1 << 19, 1 << 20, 100_000, 32
#: Positions in a bucket from which on they are merged at once.
MANY = 24

_coders: dict[tuple[str, str], Coder] = {}


def _among(pairs: dict[int, int], tokens: np.ndarray) -> np.ndarray:
    """The rank that ``pairs`` has for each token, -1 for none."""
    if not pairs:
        return np.full(len(tokens), -1)
    keys, ranks = np.array(list(pairs)), np.array(list(pairs.values()))
    by = np.argsort(keys)
    keys, ranks = keys[by], ranks[by]
    at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
    return np.where(keys[at] == tokens, ranks[at], -1)


class _Chain:
    """The linked list of nodes (by their first byte) with one place more that begins a pre-token.

    ``now`` is the rank of the pair that begins at a node, -1 if there is none or no node any longer.
    """

    def __init__(self, token: np.ndarray, heads: np.ndarray):
        n = len(token)
        self.token, self.now = np.append(token, -1), np.full(n + 1, -1)
        self.after, self.before = np.arange(1, n + 2), np.arange(-1, n)
        self.first, self.node = np.zeros(n + 1, bool), np.ones(n + 1, bool)
        self.first[heads] = True

    @staticmethod
    def push(buckets: dict[int, list[int]], made: list[int], ranks: np.ndarray, places: np.ndarray) -> None:
        """Positions by rank (sorted) into their buckets; ranks that had no bucket go to ``made``."""
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
        found, places = ranks[cuts].tolist(), places.tolist()
        for r, a, z in zip(found, cuts, [*cuts[1:], len(places)]):
            if r in buckets:
                buckets[r] += places[a:z]
            else:
                buckets[r] = places[a:z]
                made.append(r)

    def merge_all(self, r: int, bucket: list[int], with_right: dict[int, int], with_left: dict[int, int],
                  buckets: dict[int, list[int]], made: list[int]) -> bool:
        """Merges the whole bucket at once; not done if a lower rank would come up."""
        token, now, after, before, first = self.token, self.now, self.after, self.before, self.first
        at = np.unique(np.array(bucket))
        at = at[now[at] == r]
        if not len(at):
            return True
        # of pairs that overlap (equal tokens in a row) every second one is taken, from the left
        follows = np.concatenate([[False], after[at[:-1]] == at[1:]])
        if follows.any():
            places = np.arange(len(at))
            at = at[(places - np.maximum.accumulate(np.where(follows, 0, places))) % 2 == 0]
        gone = after[at]
        to = after[gone]
        inner, outer = ~first[to], ~first[at]
        for ranks in (_among(with_right, token[to[inner]]), _among(with_left, token[before[at[outer]]]), _among(with_right, np.array([r]))):
            if ((ranks >= 0) & (ranks < r)).any():
                return False
        token[at], now[at], now[gone], self.node[gone], after[at], before[to] = r, -1, -1, False, to, at
        at_left = before[at[outer]]
        right, left = _among(with_right, token[to[inner]]), _among(with_left, token[at_left])
        now[at[inner]], now[at_left] = right, left
        ranks, places = np.concatenate([right, left]), np.concatenate([at[inner], at_left])
        by = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0):]
        self.push(buckets, made, ranks[by], places[by])
        return True

    def merge_each(self, r: int, bucket: list[int], with_right: dict[int, int], with_left: dict[int, int],
                   buckets: dict[int, list[int]], made: list[int]) -> list[int]:
        """Merges one by one until the bucket is done or a lower rank comes up; returns what is left."""
        token, now, after, before, first, node = map(memoryview, (self.token, self.now, self.after, self.before, self.first, self.node))
        for done, i in enumerate(bucket, 1):
            if now[i] != r:
                continue  # stale
            gone = after[i]
            to = after[gone]
            token[i], now[i], now[gone], node[gone], after[i], before[to] = r, -1, -1, False, to, i
            changed = [] if first[to] else [(i, with_right.get(token[to], -1))]
            if not first[i]:
                j = before[i]
                changed.append((j, with_left.get(token[j], -1)))
            lower = False
            for j, new in changed:
                now[j] = new
                if new >= 0:
                    lower = lower or new < r
                    if new in buckets:
                        buckets[new].append(j)
                    else:
                        buckets[new] = [j]
                        made.append(new)
            if lower:
                return bucket[done:]
        return []


class Coder(UnitCoder):
    """Encodes and decodes by a file of ranks (base64 token, rank)."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            tokens[r] = t
        self.n_ids, self.tokens = len(tokens), pa.array(tokens, pa.large_binary())
        self.of_byte = np.array([self.ranks[bytes([x])] for x in range(256)], np.int64)
        #: Rank of two adjacent tokens, by the left one's id and by the right one's; of two bytes, by table.
        self.by_left: dict[int, dict[int, int]] = {}
        self.by_right: dict[int, dict[int, int]] = {}
        for t, r in self.ranks.items():
            for k in range(1, len(t)):
                left, right = self.ranks.get(t[:k]), self.ranks.get(t[k:])
                if left is not None and right is not None:
                    self.by_left.setdefault(left, {})[right] = r
                    self.by_right.setdefault(right, {})[left] = r
        self.of_bytes = np.array([self.ranks.get(bytes([x, y]), -1) for x in range(256) for y in range(256)], np.int64)
        self.matches = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens on end, and where those of each begin (and the last end): all bytes
        lie in one linked list, no pair spans two pre-tokens.

        The positions of a rank are merged from the left, one by one or, if they are many, at once.
        """
        data, n_ids = np.frombuffer(b"".join(pieces), np.uint8), self.n_ids
        n = len(data)
        heads = np.cumsum([0, *map(len, pieces)])
        chain = _Chain(self.of_byte[data], heads)
        ranks = np.where(chain.first[1:n], -1, self.of_bytes[data[:-1].astype(np.int64) * 256 + data[1:]])
        chain.now[:n - 1] = ranks
        by_rank = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0):]
        buckets: dict[int, list[int]] = {}
        chain.push(buckets, [], ranks[by_rank], by_rank)
        low, mid, top, none = [0] * ((n_ids >> 6) + 1), [0] * ((n_ids >> 12) + 1), 0, {}
        made = list(buckets)
        while True:
            for r in made:
                low[r >> 6] |= 1 << (r & 63)
                mid[r >> 12] |= 1 << (r >> 6 & 63)
                top |= 1 << (r >> 12)
            if not top:
                break
            # find-first-set, level by level
            block = (top & -top).bit_length() - 1
            bits = mid[block]
            word = (block << 6) + (bits & -bits).bit_length() - 1
            bits = low[word]
            r = (word << 6) + (bits & -bits).bit_length() - 1
            low[word] &= ~(1 << (r & 63))
            if not low[word]:
                mid[block] &= ~(1 << (word & 63))
                if not mid[block]:
                    top &= ~(1 << block)
            bucket, made = buckets.pop(r), []
            with_right, with_left = self.by_left.get(r, none), self.by_right.get(r, none)
            if len(bucket) < MANY or not chain.merge_all(r, bucket, with_right, with_left, buckets, made):
                left = chain.merge_each(r, sorted(bucket), with_right, with_left, buckets, made)
                if left:
                    buckets[r] = left
                    made.append(r)
        counted = np.concatenate([[0], np.cumsum(chain.node[:n])])
        return chain.token[:n][chain.node[:n]].astype(np.int32), counted[heads]

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where those of each pre-token begin in it and how many they are."""
        ranks = self.ranks
        pool = [np.arange(self.n_ids, dtype=np.int32)]  # a pre-token that is a token stands for itself
        starts, sizes, n = np.array([ranks.get(p, -1) for p in pieces], np.int64), np.ones(len(pieces), np.int64), self.n_ids
        left = np.flatnonzero(starts < 0).tolist()
        at = 0
        while at < len(left):
            to, size = at, 0
            while to < len(left) and (size == 0 or size + len(pieces[left[to]]) <= RUN_BYTES):
                size += len(pieces[left[to]])
                to += 1
            ids, bounds = self.merged([pieces[k] for k in left[at:to]])
            starts[left[at:to]] = n + bounds[:-1]
            sizes[left[at:to]] = np.diff(bounds)
            pool.append(ids)
            n += len(ids)
            at = to
        return np.concatenate(pool), starts, sizes

    def _coded(self, string: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of a string, where those of each pre-token begin (and the last end), and the pre-tokens."""
        split = self.matches(string)
        numbered = pa.array(split, pa.large_string()).dictionary_encode()
        pool, starts, sizes = self._pieces([x.encode() for x in numbered.dictionary.to_pylist()])
        which = numbered.indices.to_numpy()
        bounds = np.concatenate([[0], np.cumsum(sizes[which])])
        return pool[np.repeat(starts[which] - bounds[:-1], sizes[which]) + np.arange(bounds[-1])], bounds, split

    def code_text(self, text: str) -> np.ndarray:
        return self._coded(text)[0]

    def code_units(self, units: pa.Array, plain: np.ndarray, sound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        young, old = self.young, self.old
        strings = units.to_pylist()
        known = [young.get(u) or old.get(u) for u in strings]
        new = np.array([x is None for x in known], bool)
        starts, sizes = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        have = np.flatnonzero(~new)
        sizes[have] = np.array([len(known[i]) for i in have.tolist()], np.int64) >> 2
        starts[have] = np.cumsum(sizes[have]) - sizes[have]
        pool = [np.frombuffer(b"".join([known[i] for i in have.tolist()]), np.int32)]
        n = len(pool[0])
        again = [(strings[i], known[i]) for i in have.tolist()]
        where = np.flatnonzero(new & plain)
        for a, z, string in joined(units.take(pa.array(where)), SPLIT_BYTES):
            ids, bounds, split = self._coded(string)
            # a unit begins where a pre-token does that begins with its space or line end
            begin = bounds[:-1][pc.match_substring_regex(pa.array(split, pa.large_string()), "^[ \\n]").to_numpy(zero_copy_only=False)]
            starts[where[a:z]] = n + begin
            sizes[where[a:z]] = np.diff(begin, append=len(ids))
            pool.append(ids)
            n += len(ids)
        for i in np.flatnonzero(new & sound & ~plain).tolist():
            ids = self.code_text(strings[i])
            starts[i], sizes[i] = n, len(ids)
            pool.append(ids)
            n += len(ids)
        out = np.concatenate(pool)
        fresh = [i for i in np.flatnonzero(new & sound).tolist()[:REMEMBERED] if len(strings[i]) <= UNIT_CHARS]
        again += [(strings[i], out[a:z].tobytes()) for i, a, z in zip(fresh, starts[fresh].tolist(), (starts + sizes)[fresh].tolist())]
        self.old, self.young = young, dict(again[:REMEMBERED])
        return out, starts, sizes

    def decode(self, ids: np.ndarray) -> pa.Array:
        """The bytes of each id, on end in one array."""
        return self.tokens.take(pa.array(ids))


def coder(path: str, pattern: str) -> Coder:
    """This worker's coder for a file."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32()))


def _texts(own: Coder, ids: pa.Array, ends: np.ndarray) -> pa.Array:
    """The bytes that each row's ids decode to; ``ends`` of the rows, the first being 0."""
    _, at, body = own.decode(ids).buffers()
    at = np.frombuffer(at, np.int64)[:len(ids) + 1][ends]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(at), body or pa.py_buffer(b"")]).cast(pa.binary())


def encode(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, token_ids (array of int) of each row's whole text; with ``decoded`` also the bytes
    that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks, pattern)
        for batch in by_bytes(batches, 1, GROUP_BYTES):
            ids = _lists(own.encode([t or "" for t in batch.column(1).to_pylist()]))
            out, names = [batch.column(0), ids], ["doc_id", "token_ids"]
            if decoded:
                out.append(_texts(own, ids.values, ids.offsets.to_numpy()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(out, names)

    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return map_in_arrow(read, run, f"doc_id {kind}, token_ids array<int>" + (", decoded binary" if decoded else ""))


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, decoded (bytes) of each row's ``token_ids``; null ids decode to empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(part.column(1)), 0).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), _texts(own, pc.list_flatten(part.column(1)), ends)], ["doc_id", "decoded"])

    read = encoded.select("doc_id", "token_ids")
    return map_in_arrow(read, run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, decoded binary")


def digests(coded: DataFrame, *more: Column) -> DataFrame:
    """n_tokens and the SHA-256 of the ids (decimal, comma-joined) and of the decoded bytes."""
    return coded.select(
        "doc_id", *more, F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def multilingual() -> tuple[str, str]:
    """File of ranks and pattern that the query and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents"), *multilingual(), decoded=True))
