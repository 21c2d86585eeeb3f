r"""Chat formatting over a prefix tree.

A turn is written as ``<s>\n`` role ``\n[INST]\n`` text ``\n</s>\n``; an assistant's has ``[/INST]``.
Control strings inside roles and texts get a backslash before them (and before the backslashes that
already stand there), so no text can end its turn and the original comes back exactly.

Conversations that share their first turns share a path of a tree. A turn's chain is a hash of all
turns up to it; the chains that several conversations have, in their order, are a conversation's path
as far as it is shared, and no turn beyond can be merged. Conversations are numbered by that path,
spread by range, and emitted depth-first in packs: a turn shared by neighbours is emitted once, however
deep. Each node has the position ids of its characters (pos_start onwards: the length of its
ancestors), the loss mask (an assistant's text), and the intervals of the pack that it may attend to
besides itself: its ancestors', merged. A pack ends with the conversation in which it passes PACK
characters, or with its partition; a shared path over two packs is emitted in both.

Hashes alone are moved to find the paths; the texts then move twice, to their conversation's number and
to its range. No conversation is gathered: rows stream in order, and what is kept is bounded by the
turns that a conversation shares (chains) and by those of one path (hash states and intervals, no
texts). A system prompt that a third of all conversations share spreads over as many tasks as its
conversations fill, and is counted before it is moved.

Units are code points. Defined cases: null text or role: empty. Null turn: before the others. Rows
that repeat a turn: each is a turn, ordered by role and text (of several texts the path has another order,
and such turns may be emitted again). Null conv_id: one conversation of its
own. Empty table: no rows. Extra columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import checkpointed, column, join_by_key, map_in_arrow, table
from caresight.operators.scans import global_sequence

PACK, ROWS = 1 << 20, 2000
CONTROL = r"(</?s>|\[/?INST\])"
_TO_ESCAPE, _ESCAPED = re.compile(r"(\\*)" + CONTROL), re.compile(r"\\(\\*)" + CONTROL)
_MIDDLE = re.compile(r"\n\[/?INST\]\n")
ASSISTANT = "assistant"


def escaped(text: str) -> str:
    return _TO_ESCAPE.sub(r"\\\1\2", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and the range of its loss mask."""
    own, body = role == ASSISTANT, escaped(text)
    head = f"<s>\n{escaped(role)}\n{'[/INST]' if own else '[INST]'}\n"
    return f"{head}{body}\n</s>\n", len(head), len(head) + (len(body) if own else 0)


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    middle = _MIDDLE.search(segment)
    if middle is None or not segment.startswith("<s>\n") or not segment.endswith("\n</s>\n"):
        raise ValueError("not a formatted turn")
    return unescaped(segment[4:middle.start()]), unescaped(segment[middle.end():-6])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) >= ROWS or size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns))


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id and place: a number per conversation, in the order of their shared paths."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, depth, chain = None, False, 0, b""
        for batch in batches:
            depths, chains = [], []
            for conv_id, h in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if not begun or conv_id != conv:
                    conv, begun, depth, chain = conv_id, True, 0, b""
                chain = blake2b(chain + h.to_bytes(8, "big", signed=True), digest_size=16).digest()
                depths.append(depth)
                chains.append(chain)
                depth += 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(depths, pa.int64()), pa.array(chains, pa.binary())], ["conv_id", "depth", "chain"])

    hashed = turns.select("conv_id", "turn", "role", "hash").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "hash")
    steps = checkpointed(map_in_arrow(hashed, run, f"conv_id {kind}, depth long, chain binary"))
    counted = checkpointed(steps.groupBy("chain").agg(F.count("*").alias("n")).where("n > 1"))
    shared = join_by_key(steps, counted, ["chain"], steps.count())
    one = F.sort_array(F.collect_list(F.struct("depth", "chain")))
    paths = shared.groupBy("conv_id").agg(F.concat_ws("", F.transform(one, lambda x: F.hex(x["chain"]))).alias("path"))
    firsts = steps.where("depth = 0").select("conv_id", F.lit("").alias("path"))
    every = paths.unionByName(firsts).groupBy("conv_id").agg(F.max("path").alias("path"))
    return global_sequence(every, [F.col("path").asc(), F.col("conv_id").asc_nulls_first()], "place").select("conv_id", "place")


def format_chats(conversations: DataFrame) -> DataFrame:
    """The packs' rows by (pack_id, seq): nodes of the tree, and after the node where it ends each conversation.

    node: number in its pack; parent: -1 for roots; emit_start, emit_end: where its text lies in the
    pack; pos_start: position id of its first character; mask_start, mask_end: loss mask, as offsets
    in its text; attends: intervals of the pack. A row with ended = true names a conversation (conv_id)
    and its last node.
    """
    text = lambda c: F.coalesce(column(c).cast("string"), F.lit(""))
    turns = conversations.select("conv_id", column("turn").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    turns = turns.withColumn("hash", F.xxhash64("role", "text"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    interval = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    names = ["pack_id", "seq", "ended", "conv_id", "node", "parent", "emit_start", "emit_end", "pos_start", "mask_start", "mask_end", "attends", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def rows(first: pa.RecordBatch) -> Iterator[tuple]:
            path: list[tuple] = []  # chain, node, start, end, end position, intervals of its ancestors
            pack, seq, node, at, shared, place, conv, depth, chain = -1, 0, 0, 0, False, None, None, 0, b""

            def everything() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            def ended() -> tuple:
                return f"{task}-{pack}", seq, True, conv, path[depth - 1][1], None, None, None, None, None, None, None, None

            for now, conv_id, role, text in _rows(everything()):
                if now != place:
                    if place is not None:
                        yield ended()
                        seq += 1
                    place, conv, depth, chain, shared = now, conv_id, 0, b"", True
                    if pack < 0 or at >= PACK:
                        pack, seq, node, at, path = pack + 1, 0, 0, 0, []
                segment, start, end = formatted(role, text)
                chain = blake2b(chain + segment.encode(), digest_size=16).digest()
                if not (shared and depth < len(path) and path[depth][0] == chain):
                    shared = False
                    del path[depth:]
                    attends, pos = (), 0
                    if path:
                        *_, a, z, pos, attends = path[-1]
                        attends = (*attends[:-1], (attends[-1][0], z)) if attends and attends[-1][1] == a else (*attends, (a, z))
                    yield (f"{task}-{pack}", seq, False, None, node, path[-1][1] if path else -1, at, at + len(segment), pos, start, end,
                           [{"start": a, "stop": z} for a, z in attends], segment)
                    path.append((chain, node, at, at + len(segment), pos + len(segment), attends))
                    seq, node, at = seq + 1, node + 1, at + len(segment)
                depth += 1
            if place is not None:
                yield ended()

        for first in batches:
            types = [pa.string(), pa.int64(), pa.bool_(), first.schema.field(1).type, pa.int64(), pa.int64(), *[pa.int64()] * 3, pa.int32(), pa.int32(), pa.list_(interval), pa.string()]
            yield from _batches(rows(first), pa.schema(list(zip(names, types))))

    placed = turns.join(numbered(turns).withColumnRenamed("conv_id", "own"), F.expr("conv_id <=> own"))
    ordered = placed.repartitionByRange("place").sortWithinPartitions("place", "turn", "role", "text")
    return map_in_arrow(ordered.select("place", "conv_id", "role", "text"), run, f"pack_id string, seq long, ended boolean, conv_id {kind}, node long, parent long, emit_start long, emit_end long, "
                        "pos_start long, mask_start int, mask_end int, attends array<struct<start: long, stop: long>>, text string")


def read_back(packs: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation,
    read from the packs alone: every node from its parent, checked against positions and intervals."""
    kind = packs.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(first: pa.RecordBatch) -> Iterator[tuple]:
            pack, path = None, []  # node, emitted range, end position, turns, hash, loss chars, loss hash

            def everything() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            for name, _, ended, conv_id, node, parent, a, z, pos, start, end, attends, segment in _rows(everything()):
                if name != pack:
                    pack, path = name, []
                if ended:
                    _, _, _, chars, n, turns, loss_chars, loss = next(x for x in reversed(path) if x[0] == node)
                    yield conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
                    continue
                while path and path[-1][0] != parent:
                    path.pop()
                _, _, _, chars, n, turns, loss_chars, loss = path[-1] if path else (-1, 0, 0, 0, 0, sha256(), 0, sha256())
                if chars != pos or sum(x["stop"] - x["start"] for x in attends) != pos or z - a != len(segment):
                    raise ValueError(f"node {node} of pack {name} does not follow its parent")
                role, text = read_turn(segment)
                turns, loss = turns.copy(), loss.copy()
                turns.update(f"{role}\n{text}\n".encode())
                under = unescaped(segment[start:end])
                loss.update(under.encode())
                path.append((node, a, z, chars + len(segment), n + 1, turns, loss_chars + len(under), loss))

        for first in batches:
            types = [first.schema.field(3).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield from _batches(rows(first), pa.schema(list(zip(names, types))))

    ordered = packs.repartition("pack_id").sortWithinPartitions("pack_id", "seq")
    return map_in_arrow(ordered, run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(control).alias("text"))
    return read_back(format_chats(own.unionByName(more)))
