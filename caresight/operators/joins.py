"""Join shapes used by the reports, written so that no side fans out."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def anti(df: DataFrame, other: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` without a partner (LEFT JOIN ... WHERE other.key IS NULL)."""
    return df.join(other, on, "left_anti")


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` with at least one partner (IN / EXISTS), never duplicated."""
    return df.join(other, on, "left_semi")


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """SQL ``col NOT IN (SELECT other_col FROM other)`` with its NULL rules:

    * empty list: every row stays (NULL ``col`` included);
    * list with a NULL: no row stays;
    * otherwise rows whose ``col`` is not NULL and not in the list stay.

    Built as a hash anti join plus two uncorrelated EXISTS scalars instead of the
    null-aware anti join, which needs the list broadcast (or a nested loop) at scale.
    """
    keys = other.select(F.col(other_col).alias("_k"))
    has_rows = keys.select(F.lit(1)).exists()
    has_null = keys.where(F.col("_k").isNull()).select(F.lit(1)).exists()
    c = F.col(col)
    # NULL values never reach the join (they would all hash to one partition): they stay
    # only when the list is empty.
    kept = df.where(c.isNotNull()).join(keys.where(F.col("_k").isNotNull()).distinct(), c == F.col("_k"), "left_anti")
    return kept.where(~has_null).unionByName(df.where(c.isNull() & ~has_rows))


def semi_either(df: DataFrame, probes: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Keep rows matching ANY of several (column, key table, key column) probes.

    Each key table is reduced to distinct keys and left-joined as a flag (many-to-one),
    so a row matched by two probes still appears once. The keys grow with the data, so they are
    shuffled to the rows, not collected by the driver and broadcast.
    """
    out = df
    flags = []
    for i, (col, keys, key_col) in enumerate(probes):
        flag = f"_hit{i}"
        k = keys.select(F.col(key_col).alias(f"_k{i}")).where(F.col(f"_k{i}").isNotNull()).distinct()
        out = out.join(k.withColumn(flag, F.lit(True)).hint("merge"), F.col(col) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        flags.append(F.coalesce(F.col(flag), F.lit(False)))
    cond = flags[0]
    for f in flags[1:]:
        cond = cond | f
    return out.where(cond).drop(*[f"_hit{i}" for i in range(len(probes))])


def assemble(spine: DataFrame, key: str | Sequence[str], metrics: Sequence[DataFrame],
             defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join per-key metric tables (one row per key each) onto a spine and default
    the missing metrics (COALESCE(metric, 0))."""
    keys = [key] if isinstance(key, str) else list(key)
    out = spine
    metric_cols: list[str] = []
    for m in metrics:
        out = out.join(m, keys, "left")
        metric_cols += [c for c in m.columns if c not in keys]
    defaults = defaults if defaults is not None else {c: 0 for c in metric_cols}
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def exists_chain(rows: DataFrame, row_keys: Sequence[str], chain: Sequence[tuple[DataFrame, Sequence[str]]],
                 chain_keys: Sequence[str]) -> DataFrame:
    """Correlated EXISTS over a chain of tables: the chain is pre-joined once, reduced to
    its distinct correlation keys, and used as a left-semi join on those keys."""
    link, _ = chain[0]
    for t, on in chain[1:]:
        link = link.join(t, list(on), "inner")
    keys = link.select(*[F.col(c).alias(f"_chain{i}") for i, c in enumerate(chain_keys)]).distinct()
    cond = [rows[r] == F.col(f"_chain{i}") for i, r in enumerate(row_keys)]
    return rows.join(keys, cond, "left_semi")
