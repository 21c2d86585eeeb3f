"""Snapshot selection: the newest tag, the newest two, and top-n distinct values."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, tag: str | Column) -> DataFrame:
    """Rows whose snapshot tag equals the maximum tag (uncorrelated scalar subquery)."""
    c = F.col(tag) if isinstance(tag, str) else tag
    return df.where(c == df.select(F.max(c)).scalar())


def top_n_distinct(df: DataFrame, col: str | Column, n: int, out: str = "value") -> DataFrame:
    """TOP(n) of the distinct values, descending (TakeOrdered over the distinct set)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(out)).distinct().orderBy(F.col(out).desc()).limit(n)


def straddle_snapshots(df: DataFrame, year: str, period: str) -> DataFrame:
    """Rows of the newest ``year||period`` tag, plus the second-newest tag when the newest
    one ends in ``'00'`` (a period that straddles the year end). Branch-free: the choice is
    a predicate over two scalar subqueries."""
    tag = F.concat(F.col(year).cast("string"), F.col(period).cast("string"))
    tags = df.select(tag.alias("_t")).distinct()
    newest = tags.select(F.max("_t")).scalar()
    second = tags.where(F.col("_t") < newest).select(F.max("_t")).scalar()
    keep = (tag == newest) | ((F.substring(newest, -2, 2) == "00") & (tag == second))
    return df.where(keep)
