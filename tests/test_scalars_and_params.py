"""Fixture tests for scalar semantics and parameter splitting (NULLs, blanks, quirks)."""
import datetime as dt

from pyspark.sql import functions as F

from caresight.functions.params import split_param, string_split
from caresight.functions.scalars import (boundary_diff, fallback, float_label, tsql_concat, plus_concat,
                                         tsql_len, utc_to_eastern, valid_npi)
from caresight.operators.aggregates import percent_of_total


def test_split_param_smoke_and_rules(spark):
    rows = [(1, "515515,  551515,   5545454"), (2, "a,,b"), (3, ",a"), (4, "a,"), (5, ""), (6, None),
            (7, "x" * 40 + ",y"), (8, "a,bc  "), (9, "a,,")]
    df = spark.createDataFrame(rows, "id int, s string")
    out = split_param(df, "s", ",").select("id", "ordinal", F.trim("Param").alias("p")).collect()
    got = {}
    for r in out:
        got.setdefault(r.id, []).append((r.ordinal, r.p))
    pieces = {k: [p for _, p in sorted(v)] for k, v in got.items()}
    assert pieces[1] == ["515515", "551515", "5545454"]
    assert pieces[2] == ["a", "", "b"]
    assert pieces[3] == ["", "a"]
    assert pieces[4] == ["a"]
    assert pieces[5] == [""]
    assert pieces[6] == [None]
    assert pieces[7] == ["x" * 30, "y"]
    assert pieces[8] == ["a", "bc"]
    assert pieces[9] == ["a", ""]


def test_string_split_keeps_blanks(spark):
    df = spark.createDataFrame([(1, "a;;b;"), (2, ""), (3, None)], "id int, s string")
    out = sorted((r.id, r.value) for r in string_split(df, "s", ";").collect())
    assert out == [(1, ""), (1, ""), (1, "a"), (1, "b"), (2, "")]


def test_boundary_diff_counts_crossings(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0)),
                                (dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(boundary_diff("MINUTE", "a", "b").alias("m"), boundary_diff("HOUR", "a", "b").alias("h"),
                  boundary_diff("DAY", "a", "b").alias("d")).collect()
    assert (r[0].m, r[0].h, r[0].d) == (1, 0, 0)
    assert (r[1].m, r[1].h, r[1].d) == (1, 1, 1)


def test_utc_to_eastern_is_dst_aware(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12),), (dt.datetime(2024, 1, 1, 12),)], "t timestamp_ntz")
    r = [x.e for x in df.select(utc_to_eastern("t").alias("e")).collect()]
    assert r == [dt.datetime(2024, 7, 1, 8), dt.datetime(2024, 1, 1, 7)]


def test_sentinel_fallback(spark):
    rows = [(None, "A"), ("", "B"), ("   ", "C"), ("~         ", "D"), ("~", "E"), ("123", "F")]
    df = spark.createDataFrame(rows, "o string, a string")
    assert [r.x for r in df.select(fallback("o", "a").alias("x")).collect()] == ["A", "B", "C", "D", "E", "123"]


def test_valid_npi(spark):
    rows = [("123456789",), ("12345678901",), ("9123456789",), ("12345A7890",), (None,), ("1234567890",)]
    df = spark.createDataFrame(rows, "n string")
    assert [r.v for r in df.select(valid_npi("n").alias("v")).collect()] == [False, False, False, False, False, True]


def test_float_label(spark):
    df = spark.createDataFrame([(None,), (12.5,), (12.3456789,), (0.1,), (100.0,), (1234567.0,), (123456.0,)], "x double")
    assert [r.s for r in df.select(float_label("x").alias("s")).collect()] == [
        "N/A", "12.5", "12.3457", "0.1", "100", "1.23457e+006", "123456"]


def test_concat_flavours_and_len(spark):
    df = spark.createDataFrame([("a", None), ("ab  ", "c")], "x string, y string")
    r = df.select(plus_concat("x", "y").alias("p"), tsql_concat("x", "y").alias("c"), tsql_len("x").alias("n")).collect()
    assert (r[0].p, r[0].c, r[0].n) == (None, "a", 1)
    assert (r[1].p, r[1].c, r[1].n) == ("ab  c", "ab  c", 2)


def test_percent_text_cases(spark):
    df = spark.createDataFrame([("a", 1, 3), ("b", 2, 3), ("c", 1, 800), ("d", 0, None), ("e", 4, 4)],
                               "k string, n long, t long")
    out = {r.k: r.pct for r in percent_of_total(df, "n", F.col("t"), "pct").collect()}
    assert out == {"a": "33.33%", "b": "66.67%", "c": "0.13%", "d": "0.00%", "e": "100.00%"}
