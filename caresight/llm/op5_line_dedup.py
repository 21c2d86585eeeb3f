r"""Line dedup by a log-template tree.

A line (\n-split) is taken as its tokens (runs without ASCII white space); tokens that hold a digit
count as the variable <*>. It goes down a tree of fixed depth: by its number of tokens, then by its
first HEAD tokens. In a leaf, a line joins the template
that agrees with it at the most positions (of several the oldest), if these are SIMILAR of its fixed
tokens at least, and positions that differ become <*>; else it opens a template. Lines come in a fixed
order (that of their other tokens' 16-bit hashes; positions are compared by these), so the templates
depend neither on how the work is split nor on how many lines a leaf holds.

Where SIMILAR leaves no token to differ (fewer than EXACT fixed tokens: most menu, footer and heading
lines), the line is a template of its own, in a leaf of its own. A line without a fixed token is
compared as it stands, so that rows of numbers recur only if the numbers do.

In a leaf with many templates, a line is not compared with all: of its fixed tokens behind the leading
ones, cut into one segment more than may differ, one segment agrees with any template that it can join.
The templates that agree in a segment are found by an index, and only these are compared.

A template that occurs in two different documents or more is recurring: its lines stay in the
document with the smallest id and are dropped from all others. Whole copies of a text so lose all
their lines but once.

Texts are read once for their lines, which are kept in the shared folder with the documents that have
them. Equal lines of some MB of text are merged before the one shuffle by leaf, and the lines' fate goes
back by ``join_by_key``: a line that a third of all documents share fills no task. A leaf is settled by
one task that holds two bytes for each token behind the leading ones of its different lines.

Defined cases: null or empty text: no lines; kept as it is. Null ids: told apart by their text, and
counted after all others. Ids that are no integers count by a 62-bit hash. Rows that repeat an id are
one document. Documents that lose all their lines with a token are removed by ``drop_recurring``
(n_lines = 0 in ``line_dedup``, where they stay). Empty table: no rows. Extra columns, of any name, are
kept by ``drop_recurring``; n_chars is renewed.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StructType

from caresight.llm.common import by_bytes, checkpointed, column, join_by_key, map_in_arrow, named_again, plainly_named, table, written

#: Leading tokens, similarity, fixed tokens of which one may differ.
HEAD, SIMILAR, EXACT = 4, 0.8, 5
#: Bytes of text whose lines are worked on at a time; rows of a leaf that stream at a time; templates of
#: a leaf from which on the index is used.
GROUP_BYTES, ROWS, INDEXED = 1 << 23, 20_000, 32
GAPS = " \t\r\x0b\x0c"
VARIABLE = "<*>"


class Lines:
    """The lines of some texts, by Arrow: what each is in the tree.

    ``text`` and ``line`` give the text's number and the line's 64-bit signature for each line in its order,
    ``some`` whether it has a token. Tokens are hashed once each (64 bits), a line's signature is a
    polynomial of its tokens' hashes.
    """

    STEP = 0x9E3779B97F4A7C15 | 1  # fixed value: odd, 2^64 over the golden ratio

    def __init__(self, texts: pa.Array):
        # taken anew: string kernels of a slice with an offset
        lists = pc.split_pattern(pc.fill_null(texts, "").take(pa.array(np.arange(len(texts)))), "\n")
        numbered = pc.list_flatten(lists).dictionary_encode()
        which = numbered.indices.to_numpy()
        self.text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
        split = pc.ascii_split_whitespace(numbered.dictionary)
        tokens = pc.list_flatten(split)
        full = pc.not_equal(tokens, "").to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())[full]
        tokens = tokens.filter(pa.array(full)).dictionary_encode()
        width = np.bincount(owner, minlength=len(split))
        starts = np.cumsum(width) - width
        place = np.arange(len(owner)) - starts[owner]
        # hashes of the different tokens; those with a digit count as the variable
        own, digit = self._hashed(tokens.dictionary)
        at = tokens.indices.to_numpy()
        variable = digit[at]
        fixed = width - np.bincount(owner, variable, len(split)).astype(np.int64)
        raw = fixed[owner] == 0  # a line without a fixed token is taken as it stands
        hashes = np.where(variable & ~raw, self._hashed(pa.array([VARIABLE], pa.string()))[0], own[at])
        sums = self._sums(hashes, place, self.STEP)
        self.starts, self.width, self.fixed, self.variable, self.place, self.owner = starts, width, fixed, variable, place, owner
        self.small = (own % np.uint64(65535) + np.uint64(1)).astype(np.uint16)[at]
        self.lines = self._mixed(sums[starts + width] - sums[starts], width)
        self.heads = self._mixed(sums[starts + np.minimum(width, HEAD)] - sums[starts], width + (1 << 32))
        self.which, self.line, self.some = which, self.lines[which], width[which] > 0

    @staticmethod
    def _sums(values: np.ndarray, place: np.ndarray, step: int) -> np.ndarray:
        """Running sums, from 0, of the values times powers of an odd step by their places, modulo 2^64."""
        powers = np.cumprod(np.append(np.ones(1, np.uint64), np.full(int(place.max(initial=0)), step, np.uint64)))
        return np.append(np.zeros(1, np.uint64), np.cumsum(values * powers[place], dtype=np.uint64))

    @staticmethod
    def _hashed(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hash of each string (the same in every task), and whether it holds a digit."""
        _, ends, body = tokens.buffers()
        ends = np.frombuffer(ends, np.int32)[tokens.offset:tokens.offset + len(tokens) + 1].astype(np.int64)
        sizes = np.diff(ends)
        bytes_ = np.frombuffer(body or b"", np.uint8)[ends[0]:ends[-1]] if len(tokens) else np.zeros(0, np.uint8)
        place = np.arange(len(bytes_)) - np.repeat(ends[:-1] - ends[0], sizes)
        # each byte is spread over 64 bits before it is weighted by its place
        spread = (bytes_.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)  # fixed value: odd
        sums = Lines._sums(spread ^ (spread >> np.uint64(32)), place, 0xCA5A826395121157)  # fixed value: odd
        digits = np.append(0, np.cumsum((bytes_ >= 48) & (bytes_ <= 57)))
        at = ends - ends[0]
        return Lines._mixed(sums[at[1:]] - sums[at[:-1]], sizes).view(np.uint64), digits[at[1:]] > digits[at[:-1]]

    @staticmethod
    def _mixed(h: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Bits spread over the whole number (the finaliser of a 64-bit mixer), as signed numbers."""
        h = h + width.astype(np.uint64) * np.uint64(Lines.STEP)
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(times)
        return (h ^ (h >> np.uint64(31))).view(np.int64)

    def once(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of the line) of each line with a token, once for each text."""
        some = np.flatnonzero(self.some)
        pair = np.unique(np.stack([self.text[some], self.which[some]]), axis=1) if len(some) else np.zeros((2, 0), np.int64)
        return pair[0], pair[1]

    def leaves(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Leaf, fixed leading tokens and the other tokens' 16-bit hashes (0: variable) of the given lines
        (their numbers); a line that must be met whole has none."""
        grown = self.fixed >= EXACT
        leaf = np.where(grown, self.heads, self.lines)[lines]
        lead = np.bincount(self.owner[(self.place < HEAD) & ~self.variable], minlength=len(self.width))
        tail = (self.place >= HEAD) & grown[self.owner]
        small = np.where(self.variable, 0, self.small).astype(">u2")
        sizes = np.where(grown, np.maximum(self.width - HEAD, 0), 0)
        ends = np.concatenate([[0], np.cumsum(2 * sizes)]).astype(np.int64)
        body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(small[tail].tobytes())])
        return leaf, np.where(grown, lead, 0)[lines], body.take(pa.array(lines)).cast(pa.binary())


def row_key(doc_id: Column, text: Column, integral: bool) -> Column:
    """The document a row belongs to; rows without an id come last, told apart by their text."""
    low = F.lit((1 << 62) - 1)
    known = doc_id.cast("long") if integral else F.when(doc_id.isNotNull(), F.xxhash64(doc_id.cast("string")).bitwiseAND(low))
    return F.coalesce(known, F.lit(1 << 62) + F.xxhash64(text).bitwiseAND(low))


def _lines(read: DataFrame) -> DataFrame:
    """doc and line for each line with a token, once for each document of a group of texts; the group's
    first row of a line also has leaf, fixed (leading tokens that are), tokens (16-bit hashes of the
    others), first, last (documents) and n, all for the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, GROUP_BYTES):
            lines = Lines(batch.column(1))
            text, number = lines.once()
            docs = batch.column(0).to_numpy(zero_copy_only=False)[text]
            by = np.lexsort((docs, lines.lines[number]))
            docs, number = docs[by], number[by]
            sign = lines.lines[number]
            # rows that repeat an id are one document
            kept = np.append(True, (sign[1:] != sign[:-1]) | (docs[1:] != docs[:-1]))[:len(sign)]
            docs, number, sign = docs[kept], number[kept], sign[kept]
            new = np.append(True, sign[1:] != sign[:-1])[:len(sign)]
            heads = np.flatnonzero(new)
            n = np.diff(heads, append=len(sign))
            leaf, fixed, tokens = lines.leaves(number[heads])
            place = np.cumsum(new) - 1
            wide = [x.take(pa.array(place, mask=~new)) for x in (pa.array(leaf), pa.array(fixed), tokens, pa.array(docs[heads]), pa.array(docs[heads + n - 1]), pa.array(n))]
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(sign), *wide], ["doc", "line", "leaf", "fixed", "tokens", "first", "last", "n"])

    return written(map_in_arrow(read, run, "doc long, line long, leaf long, fixed long, tokens binary, first long, last long, n long"))


class _Index:
    """Templates of a leaf by what they hold in the segments of lines with certain fixed positions."""

    def __init__(self):
        self.kinds: dict[bytes, tuple[list[np.ndarray], list[dict[bytes, list[int]]]]] = {}

    def add(self, template: np.ndarray, number: int) -> None:
        for segments, found in self.kinds.values():
            for where, by_content in zip(segments, found):
                by_content.setdefault(template[where].tobytes(), []).append(number)

    def near(self, line: np.ndarray, fixed: np.ndarray, may_differ: int, made: np.ndarray) -> list[int]:
        """Templates that hold the line's tokens in a segment, oldest first."""
        kind = fixed.tobytes()
        if kind not in self.kinds:
            segments = np.array_split(np.flatnonzero(fixed), may_differ + 1)
            found: list[dict[bytes, list[int]]] = [{} for _ in segments]
            for where, by_content in zip(segments, found):
                for number, content in enumerate(made[:, where]):
                    by_content.setdefault(content.tobytes(), []).append(number)
            self.kinds[kind] = segments, found
        segments, found = self.kinds[kind]
        return sorted({n for where, by_content in zip(segments, found) for n in by_content.get(line[where].tobytes(), ())})


def templates(lines: np.ndarray, ahead: int, similar: float = SIMILAR, indexed: int = INDEXED) -> list[int]:
    """For each line of a leaf (a row of token hashes, 0 for a variable) the number of its template;
    ``ahead`` fixed tokens before these are the same in all."""
    made, n, out, index = np.zeros((16, lines.shape[1]), lines.dtype), 0, [], None
    for line in lines:
        fixed = line != 0
        count = int(np.count_nonzero(fixed))
        may_differ = int((1 - similar) * (ahead + count) + 1e-9)
        if n <= indexed or may_differ >= count:
            near = np.arange(n)
        else:
            if index is None:
                index = _Index()
            near = np.array(index.near(line, fixed, may_differ, made[:n]), int)
        if len(near):
            same = ((made[near] == line) & fixed).sum(axis=1)
            best = int(same.argmax())
            if count - same[best] <= may_differ:
                own = made[near[best]]
                own[own != line] = 0
                out.append(int(near[best]))
                continue
        if n == len(made):
            made = np.concatenate([made, np.zeros_like(made)])
        made[n] = line
        if index is not None:
            index.add(line, n)
        out.append(n)
        n += 1
    return out


def recurring(lines: DataFrame) -> DataFrame:
    """line, template, keep (document that keeps it), n (documents with the line) of recurring templates."""
    merged = (lines.where("leaf is not null").drop("doc").repartition("leaf").groupBy("leaf", "line")
              .agg(F.first("fixed").alias("fixed"), F.first("tokens").alias("tokens"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")))

    def settled(t: pa.Table) -> pa.RecordBatch:
        """Templates of whole leaves."""
        leaves, line, ahead, first, last, n = (t.column(c).to_numpy() for c in (0, 1, 2, 4, 5, 6))
        number = np.arange(len(leaves))  # of the template: its first row
        starts = np.flatnonzero(np.concatenate([[True], leaves[1:] != leaves[:-1]]))
        ends = np.append(starts[1:], len(leaves))
        tokens = t.column(3).combine_chunks()
        for a, z in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            lines = np.frombuffer(b"".join(tokens.slice(a, z - a).to_pylist()), ">u2").astype(np.uint16).reshape(z - a, -1)
            own = np.array(templates(lines, int(ahead[a])))
            heads = np.full(own.max() + 1, z - a)
            np.minimum.at(heads, own, np.arange(z - a))
            number[a:z] = a + heads[own]
        low, high = first.copy(), last.copy()
        np.minimum.at(low, number, first)
        np.maximum.at(high, number, last)
        again = np.flatnonzero(low[number] != high[number])
        return pa.RecordBatch.from_arrays([pa.array(line[again]), pa.array(line[number[again]]), pa.array(low[number[again]]), pa.array(n[again])],
                                          ["line", "template", "keep", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < ROWS:
                continue
            t = pa.Table.from_batches(held)
            leaves = t.column(0).to_numpy()
            cut = int(np.searchsorted(leaves, leaves[-1]))  # the last leaf may go on
            if cut:
                yield settled(t.slice(0, cut))
            held = t.slice(cut).to_batches()
            rows = t.num_rows - cut
        if rows:
            yield settled(pa.Table.from_batches(held))

    return map_in_arrow(merged.sortWithinPartitions("leaf", "tokens", "line"), run, "line long, template long, keep long, n long")


def _dropped(read: DataFrame) -> DataFrame:
    """doc, lines: the lines that each document loses."""
    lines = _lines(read)
    again = checkpointed(recurring(lines))
    facts = lines.select("doc", "line")
    total = again.agg(F.sum("n")).first()[0] or 0
    lost = join_by_key(facts, again.select("line", "keep", "n"), ["line"], total).where("doc != keep")
    return lost.groupBy("doc").agg(F.collect_set("line").alias("lines"))


def _freed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs``, plainly named, with the text freed of recurring lines, and had and lost: lines with a
    token that it had, and that it lost."""
    at = docs.columns.index(text)
    integral = isinstance(docs.schema[doc_id].dataType, IntegralType)
    plain = plainly_named(docs).withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    body = F.coalesce(F.col(f"c{at}"), F.lit(""))
    keyed = plain.withColumn("doc", row_key(F.col(f"c{docs.columns.index(doc_id)}"), body, integral))
    some = F.length(body) > 0
    read = keyed.where(some).select("doc", F.col(f"c{at}").alias("t"))
    # rows without text meet nothing and take no part in the join
    joined = keyed.where(some).join(_dropped(read).withColumnRenamed("lines", "gone"), "doc", "left").select(*plain.columns, "gone")
    joined = joined.unionByName(plain.where(~some), allowMissingColumns=True)
    schema = StructType(list(plain.schema.fields)).add("had", "long").add("lost", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at, GROUP_BYTES):
            texts = batch.column(at).to_pylist()
            had, lost = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            gone = batch.column(batch.num_columns - 1)
            losing = np.flatnonzero(pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False)).tolist()
            lines = Lines(batch.column(at).take(pa.array(losing, pa.int64())))
            ends = np.searchsorted(lines.text, np.arange(len(losing) + 1)).tolist()
            for k, row in enumerate(losing):
                a, z = ends[k], ends[k + 1]
                go = lines.some[a:z] & np.isin(lines.line[a:z], gone[row].values.to_numpy())
                lost[row] = np.count_nonzero(go)
                texts[row] = "\n".join([x for x, g in zip(texts[row].split("\n"), go.tolist()) if not g])
                had[row] = np.count_nonzero(lines.some[a:z])
            for row in set(range(len(texts))).difference(losing):
                had[row] = sum([bool(x.strip(GAPS)) for x in (texts[row] or "").split("\n")])
            cols = list(batch.columns[:-1])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(had), pa.array(lost)], schema.names)

    return map_in_arrow(joined, run, schema)


def drop_recurring(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """Rows with their texts freed of recurring lines; those that lose every line are gone."""
    left = _freed(docs, doc_id, text).where("lost = 0 or lost < had")
    if chars in docs.columns:
        at, own = docs.columns.index(chars), f"c{docs.columns.index(text)}"
        renewed = F.when(F.col("lost") > 0, F.length(own).cast(docs.schema[chars].dataType)).otherwise(F.col(f"c{at}"))
        left = left.withColumn(f"c{at}", renewed)
    return named_again(left, docs)


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines (left), n_dropped and the text that is left, of each row."""
    left = _freed(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), "doc_id", "text")
    return left.select(F.col("c0").alias("doc_id"), (F.col("had") - F.col("lost")).alias("n_lines"), F.col("lost").alias("n_dropped"), F.col("c1").alias("text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))
