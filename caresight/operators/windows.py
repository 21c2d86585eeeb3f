"""Per-key ranking operators.

Top-1 per key is written as an aggregate over a struct (min/max of (order..., payload))
wherever the ordering allows: it is combined map-side, so a key holding a large share of
the rows is reduced before the shuffle instead of being sorted in one task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  descending: bool = False) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1, as an aggregate.

    ``order`` must make the choice total (append a unique column as the last tie-break);
    all ``order`` columns sort in the same direction.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in rest]).alias("_r"))
    pick = F.max if descending else F.min
    best = df.groupBy(*keys).agg(pick(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._r.{c}").alias(c) for c in rest]).select(*df.columns)


def row_number_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn") -> DataFrame:
    """Plain ROW_NUMBER() per key (used where every rank is needed, e.g. positional pivots)."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def latest_with_ties(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """RANK() OVER (PARTITION BY keys ORDER BY ts DESC) = 1: every row at the latest ts.

    The max per key is an aggregate; rows are matched back on (keys, ts), so the join is
    spread over the timestamp values as well as the keys.
    """
    latest = df.groupBy(*keys).agg(F.max(ts).alias("_latest"))
    cond = [df[k].eqNullSafe(latest[k]) for k in keys] + [df[ts] == latest["_latest"]]
    return df.join(latest, cond, "left_semi")


def with_grand_total(df: DataFrame, col: str, out: str) -> DataFrame:
    """SUM(col) OVER () as an uncorrelated scalar subquery (no single-partition window)."""
    total = df.select(F.sum(col)).scalar()
    return df.withColumn(out, total)


def best_flags(df: DataFrame, keys: Sequence[str], flags: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Best outcome per key: the row with the lexicographically largest flag tuple
    (ROW_NUMBER ORDER BY flag1 DESC, flag2 DESC, ...), as a max over a struct."""
    packed = F.struct(*[F.col(f) for f in flags], *[F.col(c) for c in carry])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in [*flags, *carry]])


def priority_label(df: DataFrame, group: str, label: str, ranks: dict[str, int], other_rank: int,
                   last_labels: Sequence[str] = ("Unknown",), out: str | None = None) -> DataFrame:
    """One label per group: the smallest rank wins; equal ranks fall back to labels not in
    ``last_labels`` first, then alphabetical order."""
    rank = F.lit(other_rank)
    for lab, r in ranks.items():
        rank = F.when(F.col(label) == lab, F.lit(r)).otherwise(rank)
    packed = F.struct(rank.alias("r"), F.col(label).isin(*last_labels).alias("late"), F.col(label).alias("l"))
    return df.groupBy(group).agg(F.min(packed)["l"].alias(out or label))
