"""From raw documents to token ids in five stages, each by one operator of ``caresight.llm``.

Every stage reads what its predecessor kept (Parquet), and returns the columns of ``documents`` but
for the last, which returns token ids with their digests.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caresight.llm.common import table, written
from caresight.llm.op1_decontaminate import drop_contaminated
from caresight.llm.op2_simhash import RADIUS, SHINGLE, drop_near_duplicates
from caresight.llm.op5_line_dedup import drop_recurring
from caresight.llm.op7_quality_rules import keep_good
from caresight.llm.op8_byte_bpe import digests, encode, multilingual


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in one document; documents without any other line go."""
    return drop_recurring(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    return drop_near_duplicates(docs, SHINGLE, RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens and the digests of the ids and of the bytes they decode to."""
    coded = encode(docs, *multilingual(), decoded=True)
    return digests(coded, F.col("token_ids"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("decontamination", decontamination), ("byte-level BPE", tokens)]
#: SQL can express neither the learned weights of the rules nor the SimHash components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
