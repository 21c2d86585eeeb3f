"""Rules of the claims report on repeated rows, repeated codes and NULLs."""
import datetime as dt

from pyspark.sql import functions as F

from caresight.operators.scans import anchor_groups, asof_join, nearest_within
from caresight.plans import oncology as onc
from caresight.sources.tables import jdbc_options, write_report

D = dt.date


def test_null_keys_and_dates_match_nothing(spark):
    rows = [(1, D(2020, 1, 1), 1, "s"), (1, D(2020, 1, 5), 2, "f"), (1, None, 3, "f"), (1, None, 4, "b"), (None, D(2020, 1, 1), 5, "s"),
            (None, D(2020, 1, 1), 6, "b"), (2, None, 7, "s"), (2, D(2020, 1, 1), 8, "b"), (1, D(2019, 1, 1), 9, "f"), (1, D(2020, 1, 1), 10, "b")]
    df = spark.createDataFrame(rows, "k int, d date, id int, kind string")
    look = F.when(F.col("kind") == "f", "forward").when(F.col("kind") == "b", "backward")
    got = {r.id: r.g for r in anchor_groups(df, ["k"], "d", ["id"], F.col("kind") == "s", look, "g", 3).collect()}
    assert got == {5: 1, 1: 2, 7: 3, 2: None, 3: None, 4: None, 6: None, 8: None, 9: 2, 10: 2}
    anchors = df.where("kind = 's'").select("k", F.col("d").alias("ad"), F.col("id").alias("aid"))
    for direction, want in (("forward", {9: 1, 10: 1}), ("backward", {2: 1, 10: 1})):
        out = asof_join(df.where("kind <> 's'").select("k", "d", "id"), anchors, ["k"], "d", "ad", ["aid"], direction, ["aid"], num_partitions=3)
        assert {r.id: r.aid for r in out.collect()} == {i: want.get(i) for i in (2, 3, 4, 6, 8, 9, 10)}


def test_nearest_within_gives_the_smallest_difference(spark):
    left = spark.createDataFrame([(1, D(2020, 1, 1)), (1, D(2020, 3, 30)), (1, None), (None, D(2020, 1, 1)), (2, D(2020, 1, 1))], "k int, d date")
    right = spark.createDataFrame([(1, D(2020, 1, 20)), (1, D(2020, 2, 1)), (1, D(2019, 12, 31)), (1, None), (None, D(2020, 1, 2)), (2, D(2020, 3, 2))], "k int, e date")
    got = sorted((r.k, r.d, r.n) for r in nearest_within(left, right, ["k"], "d", "e", 0, 60, out="n").collect())
    assert got == [(1, D(2020, 1, 1), 19)]
    assert nearest_within(left, right, ["k"], "d", "e", 0, 61).count() == 2


def test_one_row_per_claim_line(spark):
    lines = spark.createDataFrame([(1, 1, "b", 2), (1, 1, "a", 9), (1, 1, "a", 9), (1, 2, None, 1), (1, 2, "a", 1)], "cur_clm_uniq_id long, clm_line_num int, x string, y int")
    assert sorted(map(str, onc.one_per_key(lines, onc.LINE_KEY).collect())) == sorted(
        map(str, [r for r in spark.createDataFrame([(1, 1, "a", 9), (1, 2, None, 1)], lines.schema).collect()]))


def test_repeated_descriptions_multiply_no_line(spark):
    from caresight.sources.adapters import Inputs
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    assert inputs["lu_icd10"].groupBy("ICD10").count().where("count > 1").count() > 0
    assert inputs["part_a"].groupBy(*onc.LINE_KEY).count().where("count > 1").count() > 0
    job = onc.OncologyJob(inputs, None)
    assert job.a_lines.groupBy(*onc.LINE_KEY).count().where("count > 1").count() == 0


def test_report_with_captions_as_csv(spark, tmp_path):
    df = spark.createDataFrame([("Lung", 3)], "body_area string, total_cost int")
    write_report(df, f"file:{tmp_path}/r", "csv", {"body_area": "Body Area", "total_cost": "Total Cost"}, single_file=True)
    back = spark.read.option("header", "true").csv(f"file:{tmp_path}/r")
    assert back.columns == ["Body Area", "Total Cost"] and back.collect()[0][0] == "Lung"


def test_remote_scan_options():
    plain = jdbc_options("claims", {"url": "jdbc:x"})
    assert plain["dbtable"] == "claims" and plain["pushDownPredicate"] == "true"
    try:
        jdbc_options("claims", {"url": "jdbc:x", "numPartitions": "4"})
    except ValueError:
        return
    raise AssertionError("an incomplete parallel read must be refused")


def test_padded_provider_numbers(spark):
    from caresight.functions.scalars import valid_npi
    df = spark.createDataFrame([("1234567890  ",), ("9234567890",), ("12345",), (None,), (" 1234567890",)], "n string")
    assert [r.v for r in df.select(valid_npi("n").alias("v")).collect()] == [True, False, False, False, False]
