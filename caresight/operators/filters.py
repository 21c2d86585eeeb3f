"""Projections, classifiers and predicates."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresight.sources.tables import estimated_bytes

Codes = Mapping[str, Sequence[str]] | DataFrame


def _key(col: str, trim: bool) -> Column:
    return F.trim(F.col(col)) if trim else F.col(col)


def classify(df: DataFrame, col: str, codes: Codes, out: str, default: str | None = "Unknown",
             trim: bool = True, code_col: str = "code", label_col: str = "label") -> DataFrame:
    """Label each row by the code in ``col``; the first matching label wins.

    A mapping becomes a CASE over hashed IN-sets (no join at all); a dimension DataFrame
    (code -> label, unique codes, small by contract) is broadcast-joined.
    """
    key = _key(col, trim)
    if isinstance(codes, DataFrame):
        dim = codes.select(F.col(code_col).alias("_code"), F.col(label_col).alias("_label"))
        joined = df.join(F.broadcast(dim), key == F.col("_code"), "left")
        return joined.withColumn(out, F.coalesce(F.col("_label"), F.lit(default))).drop("_code", "_label")
    expr = None
    for label, group in codes.items():
        cond = key.isin(*group)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(out, expr.otherwise(F.lit(default)))


def code_table(codes: DataFrame, code_col: str = "code") -> DataFrame:
    """The different codes of a set kept as a table (column ``code``)."""
    return codes.select(F.trim(code_col).alias("code")).where("code is not null").distinct()


def has_code(col: str, key: str, code: str) -> Column:
    """Whether ``col`` equals the column ``code`` of a code table whose column ``key`` holds ``xxhash64(code)``: a join by
    one number, which the texts confirm. Tasks probe such a table without writing to what they share; the counters
    of a broadcast table of texts are written by all tasks of an executor at each probe."""
    # as an equation the texts would be a key of the join
    return (F.xxhash64(F.col(col)) == F.col(key)) & (F.col(code) >= F.col(col)) & (F.col(code) <= F.col(col))


def filter_code_set(df: DataFrame, col: str, codes: Sequence[str] | DataFrame, trim: bool = True,
                    code_col: str = "code") -> DataFrame:
    """Keep rows whose code is in the set: an IN-list, or a left-semi join for a set given as a
    table (Spark broadcasts it when its measured size allows).

    Trimmed codes cannot be compared in the scan; a condition on the stored spellings that every
    match meets is added: they begin with the first characters of some code, or with a blank.
    Parquet skips the row groups whose spellings all begin otherwise."""
    key = _key(col, trim)
    if isinstance(codes, DataFrame):
        return df.join(code_table(codes, code_col).withColumnRenamed("code", "_code"), key == F.col("_code"), "left_semi")
    if not trim:
        return df.where(F.col(col).isin(*codes))
    begins = F.col(col).startswith(" ")
    for prefix in sorted({c[:PREFIX] for c in codes}):
        begins = begins | F.col(col).startswith(prefix)
    return df.where(begins).where(key.isin(*codes))


#: Characters of a code that its stored spelling is known by in a scan; estimated size up to which a
#: code table is broadcast.
PREFIX, BROADCAST_BYTES = 3, 1 << 20


def _first_hit(df: DataFrame, cols: Sequence[str], codes: DataFrame, code_col: str) -> DataFrame:
    """``df`` with ``_hit``: the position of the first of ``cols`` whose code the table has, or NULL.

    A table of at most ``BROADCAST_BYTES`` by estimate is broadcast, and probed for each column in one
    stage. Any other is met once, whatever the number of columns, by the different
    combinations of codes that the rows hold: their codes as rows go through one semi join, the
    first position comes back per combination, and the rows take it by one join.
    """
    table = code_table(codes, code_col)
    if estimated_bytes(table) <= BROADCAST_BYTES:
        for i, c in enumerate(cols):
            small = F.broadcast(table.select(F.xxhash64("code").alias(f"_key{i}"), F.col("code").alias(f"_hit{i}")))
            df = df.join(small, has_code(c, f"_key{i}", f"_hit{i}"), "left").drop(f"_key{i}")
        found = F.coalesce(*[F.when(F.col(f"_hit{i}").isNotNull(), F.lit(i)) for i in range(len(cols))])
        return df.withColumn("_hit", found).drop(*[f"_hit{i}" for i in range(len(cols))])
    # codes hold no control characters, so the joined text stands for the combination
    keyed = df.withColumn("_codes", F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("")) for c in cols]))
    each = keyed.select("_codes").distinct().select("_codes", F.posexplode(F.split("_codes", "\x1f", -1)).alias("_hit", "_code"))
    first = (each.where("_code <> ''").join(table, F.col("_code") == F.col("code"), "left_semi")
             .groupBy("_codes").agg(F.min("_hit").alias("_hit")))
    return keyed.join(first, "_codes", "left").drop("_codes")


def any_in_set(df: DataFrame, cols: Sequence[str], codes: DataFrame, out: str, code_col: str = "code") -> DataFrame:
    """``df`` with ``out``: whether any of several columns holds a code of the table."""
    return _first_hit(df, cols, codes, code_col).withColumn(out, F.col("_hit").isNotNull()).drop("_hit")


def first_matching(df: DataFrame, pairs: Sequence[tuple[str, str]], codes: DataFrame,
                   out_code: str, out_desc: str, keep_unmatched: bool = False, code_col: str = "code") -> DataFrame:
    """The first (code, description) column pair whose code is in the table ``codes``; rows where
    no column matches are dropped unless ``keep_unmatched``."""
    found = _first_hit(df, [c for c, _ in pairs], codes, code_col)
    if not keep_unmatched:
        found = found.where(F.col("_hit").isNotNull())
    pick = lambda cols: F.coalesce(*[F.when(F.col("_hit") == i, F.col(c)) for i, c in enumerate(cols)])
    return found.withColumns({out_code: pick([c for c, _ in pairs]), out_desc: pick([d for _, d in pairs])}).drop("_hit")


def optional_in(df: DataFrame, col: str | Column, values: Sequence | DataFrame | None,
                value_col: str = "value") -> DataFrame:
    """Multi-value filter where an empty parameter means 'no restriction'."""
    c = F.col(col) if isinstance(col, str) else col
    if values is None:
        return df
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(value_col).alias("_v")).distinct(), c == F.col("_v"), "left_semi")
    values = list(values)
    if not values:
        return df
    return df.where(c.isin(*values))


def in_window(col: str, lo, hi, mode: str) -> Column:
    """The date-window flavours the reports use.

    ``date_le``      to_date(col) <= hi
    ``date_between`` to_date(col) BETWEEN lo AND hi
    ``ts_next_day``  col BETWEEN lo AND hi + 1 day (midnight of the next day included)
    ``ts_at_most_next_day`` col <= hi + 1 day
    """
    c = F.col(col)
    lo_c = F.lit(lo) if lo is not None and not isinstance(lo, Column) else lo
    hi_c = F.lit(hi) if not isinstance(hi, Column) else hi
    if mode == "date_le":
        return F.to_date(c) <= F.to_date(hi_c)
    if mode == "date_between":
        return F.to_date(c).between(F.to_date(lo_c), F.to_date(hi_c))
    if mode == "ts_next_day":
        return c.between(lo_c.cast("timestamp_ntz"), F.to_date(hi_c).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    if mode == "ts_at_most_next_day":
        return c <= hi_c.cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    raise ValueError(mode)
