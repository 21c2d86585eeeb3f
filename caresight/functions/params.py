"""Multi-value parameters: delimited strings as rows.

Both splitters work on a whole column of strings (one row per input string in, one row
per piece out) with ``explode(split(...))``; the delimiter is quoted because ``split``
takes a regular expression.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pattern(delim: str) -> str:
    if len(delim) != 1:
        raise ValueError("delimiter must be one character")
    return re.escape(delim)


def string_split(df: DataFrame, col: str, delim: str = ";", out: str = "value",
                 with_ordinal: bool = False) -> DataFrame:
    """STRING_SPLIT: every piece, blanks included; ``''`` gives one blank; NULL gives none."""
    arr = F.split(F.col(col), _pattern(delim), -1)
    if with_ordinal:
        return df.select("*", F.posexplode(arr).alias("ordinal", out)).withColumn(
            "ordinal", F.col("ordinal") + 1)
    return df.select("*", F.explode(arr).alias(out))


def split_param(df: DataFrame, col: str, delim: str = ",", out: str = "Param",
                max_len: int | None = 30) -> DataFrame:
    """The report-parameter splitter.

    Pieces come left to right; a leading or inner empty piece is emitted as ``''``; a
    trailing delimiter adds no final piece; ``''`` gives one ``''``; NULL gives one NULL
    row; blanks around pieces are kept (callers trim); pieces are cut to ``max_len``.
    Input is right-trimmed first (the original loses characters on trailing blanks).
    """
    s = F.rtrim(F.col(col))
    arr = F.split(s, _pattern(delim), -1)
    arr = F.when(s.endswith(delim), F.slice(arr, 1, F.size(arr) - 1)).otherwise(arr)
    piece = F.col("_piece")
    out_col: Column = F.left(piece, F.lit(max_len)) if max_len else piece
    return (df.select("*", F.posexplode_outer(arr).alias("ordinal", "_piece"))
              .withColumn("ordinal", F.col("ordinal") + 1)
              .withColumn(out, out_col).drop("_piece"))


def values_list(values: str | list[str] | tuple[str, ...] | None, delim: str = ";") -> list[str]:
    """Python-side parameter normalisation: ``None``/``''``/``[]`` mean 'no filter'."""
    if values is None:
        return []
    if isinstance(values, str):
        return [] if values == "" else values.split(delim)
    return list(values)
