"""Aggregation helpers."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresight.functions.scalars import hundredths


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as a long."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def with_total_row(df: DataFrame, label_col: str, label: str, sum_cols: Sequence[str],
                   distinct: bool = True) -> DataFrame:
    """Append one total row (``label`` + sums) to a grouped result; UNION semantics by
    default (duplicates removed)."""
    total = df.agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sum_cols])
    total = total.select(F.lit(label).alias(label_col), *sum_cols)
    out = df.select(label_col, *sum_cols).unionByName(total)
    return out.distinct() if distinct else out


def percent_of_total(df: DataFrame, count_col: str, total: Column, out: str) -> DataFrame:
    """Two-decimal percentage text of ``count_col`` over ``total`` (``'12.34%'``), with the
    special cases of the completion report: share 100 of a non-zero total -> ``100.00%``,
    zero count at 100 -> ``0.00%``, NULL/zero total -> ``0.00%``."""
    h = hundredths(F.col(count_col), total)
    text = F.concat(F.format_string("%d.%02d", (h / 100).cast("long"), F.pmod(h, F.lit(100))), F.lit("%"))
    zero = F.lit("0.00%")
    return df.withColumn(out, F.when(total.isNull() | (total == 0), zero).otherwise(text))


def two_level_count(df: DataFrame, dedupe: Sequence[str], group: Sequence[str], out: str) -> DataFrame:
    """DISTINCT on ``dedupe`` columns, then COUNT(*) per ``group``."""
    return df.select(*dedupe).distinct().groupBy(*group).agg(F.count(F.lit(1)).alias(out))
