"""Token counts: batch encoding in an Arrow function that returns lengths only.

Texts are cut into units at safe boundaries (``textunits``), so long texts never go to the
tokenizer whole; units not met before are encoded in batches of about equal bytes, and the counts
of recurring units are remembered within a bound. The sum over a text's units is the library's
count for the whole text: special strings hold no space, so no cut falls into one.

Defined cases: null or empty text: 0 bytes, 0 tokens. Null or repeated ids: a row each, as given.
Empty table: no rows. Extra columns are not read; the output has the operator's columns only.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import by_bytes, column, map_in_arrow, table
from caresight.llm.textunits import spans, units

#: Bytes of text per group of rows, bytes per encoded batch, remembered units and their length.
GROUP_BYTES, BATCH_BYTES, REMEMBERED, UNIT_CHARS = 1 << 21, 1 << 17, 500_000, 64

_counters: dict[str, Counter] = {}


class Counter:
    """Counts of a ``tokenizers`` JSON file, with a bounded memory of units."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.seen: dict[str, int] = {}

    def encoded(self, fresh: list[str], into: dict[str, int], lead: str) -> None:
        batch, size = [], 0
        for i, u in enumerate(fresh):
            batch.append(u)
            size += len(u) + 1
            if size >= BATCH_BYTES or i + 1 == len(fresh):
                out = self.tokenizer.encode_batch_fast([lead + x for x in batch], add_special_tokens=False)
                into.update(zip(batch, map(len, out)))
                batch, size = [], 0

    def counts(self, texts: list[str | None]) -> list[int]:
        heads: dict[str, int] = {}
        seen, passing, cut = self.seen, {}, []
        fresh: dict[str, None] = {}
        totals = [0] * len(texts)
        parts = ((row, n, part) for row, text in enumerate(texts) if text for n, part in enumerate(spans(text)))

        def settle() -> None:
            self.encoded(list(fresh), passing, " ")
            self.encoded([us[0] for _, n, us in cut if not n and us[0] not in heads], heads, "")
            for row, n, us in cut:
                first = 0 if n else 1
                totals[row] += sum([seen[u] if u in seen else passing[u] for u in us[first:]])
                if first:
                    totals[row] += heads[us[0]]
            if len(seen) < REMEMBERED:
                seen.update((u, k) for u, k in passing.items() if len(u) <= UNIT_CHARS)
            for x in (fresh, passing, heads, cut):
                x.clear()

        held = 0
        for row, n, part in parts:
            us = units(part)
            cut.append((row, n, us))
            fresh.update(dict.fromkeys(u for u in us[0 if n else 1:] if u not in seen))
            held += len(part)
            if held > GROUP_BYTES:
                settle()
                held = 0
        settle()
        return totals


def counter(path: str) -> Counter:
    """This worker's counter for a file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in by_bytes(batches, 1, GROUP_BYTES):
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(own.counts(texts.to_pylist()), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    read = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    counted = map_in_arrow(read, count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
