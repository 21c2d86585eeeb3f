"""Plan-shape tests: no single-partition funnel over fact rows, no pair-forming joins,
no Python evaluation in the hot path, filters pushed to the scan."""
import re

import pytest
from pyspark.sql import functions as F

from caresight.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["global_sequence", "asof_forward", "asof_backward", "nearest_within_window",
                                  "cost_by_area_modality", "alert_report", "action_completion", "split_param"])
def test_no_pairs_no_python(spark, name):
    p = _plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


@pytest.fixture(scope="module")
def part_a(spark, tmp_path_factory):
    """Claim lines as a stored table."""
    from caresight.sources.adapters import Inputs
    path = f"file:{tmp_path_factory.mktemp('claims')}/part_a"
    Inputs(spark, SF)["part_a"].write.parquet(path)
    return spark.read.parquet(path)


def test_extract_pushes_filter_and_prunes(part_a):
    from caresight.sources.tables import extract_claims
    p = _plan(extract_claims(part_a, "1997-01-01", ["beneficiary_id", "clm_from_dt", "clm_line_hcpcs_cd"]))
    assert "PushedFilters: [IsNotNull(clm_from_dt), GreaterThan(clm_from_dt," in p
    assert "ReadSchema: struct<beneficiary_id" in p and "clm_type_cd" not in p.split("ReadSchema:")[1].split("\n")[0]


def _scanned_rows(df) -> int:
    """Rows that the scan of an executed plan gave out."""
    df._jdf.queryExecution().executedPlan().execute().count()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_code_filter_is_pushed_and_loses_nothing(spark, part_a, tmp_path):
    from caresight.functions.codes import LINE_CODES
    from caresight.operators.filters import filter_code_set
    found = filter_code_set(part_a, "clm_line_hcpcs_cd", LINE_CODES)
    assert "StringSta" in _plan(found).split("PushedFilters:")[1].split("\n")[0]
    rows = [r.clm_line_hcpcs_cd for r in part_a.collect()]
    assert found.count() == sum(c is not None and c.strip(" ") in set(LINE_CODES) for c in rows)
    odd = spark.createDataFrame([(c,) for c in ["  77263", "77263   ", "77263x", "", None, " ", "G6015 ", "zz"]], "c string")
    assert sorted(r.c for r in filter_code_set(odd, "c", LINE_CODES).collect()) == ["  77263", "77263   ", "G6015 "]
    # row groups without a spelling of the set are skipped
    codes = spark.range(20_000).select(F.concat(F.lpad((F.col("id") * 5 % 99999).cast("string"), 5, "0"), F.lit(" ")).alias("c")).orderBy("c")
    codes.coalesce(1).write.option("parquet.block.size", 4096).option("parquet.page.size", 1024).option("parquet.block.size.row.check.min", 10).parquet(f"{tmp_path}/codes")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = spark.read.parquet(f"{tmp_path}/codes")
        kept = filter_code_set(stored, "c", LINE_CODES)
        assert 0 < kept.count() <= _scanned_rows(kept) < 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_large_code_table_is_met_once(spark, monkeypatch):
    from caresight.operators import filters as flt
    rows = [(i, *[None if (i + k) % 4 == 0 else f"c{(i * 7 + k * 3) % 50}" for k in range(6)]) for i in range(400)] + [(400, *[None] * 6), (7, *["c1"] * 6)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"c{k} string" for k in range(6))).selectExpr("*", *[f"concat('text of ', c{k}, ' {k}') as d{k}" for k in range(6)])
    codes = spark.createDataFrame([(f"c{k}",) for k in range(0, 50, 9)] + [(None,), ("c9",)], "code string")
    pairs = [(f"c{k}", f"d{k}") for k in range(6)]
    small = flt.first_matching(df, pairs, codes, "code", "text", keep_unmatched=True)
    monkeypatch.setattr(flt, "BROADCAST_BYTES", 0)
    large = flt.first_matching(df, pairs, codes, "code", "text", keep_unmatched=True)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, small.collect()), key=key) == sorted(map(tuple, large.collect()), key=key)
    wanted = {r.code for r in codes.collect() if r.code}
    for r in large.collect():
        first = next((k for k in range(6) if r[f"c{k}"] in wanted), None)
        assert (r.code, r.text) == ((None, None) if first is None else (r[f"c{first}"], r[f"d{first}"]))
    assert large._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    some = flt.any_in_set(df, [c for c, _ in pairs], codes, "some")
    assert some.where("some").count() == large.where("code is not null").count()


def test_course_pass_moves_whole_rows_once(spark):
    """After the pinned ranges, one exchange has all columns; the carry is broadcast."""
    from caresight.operators.scans import anchor_groups, asof_join
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), (F.col("id") % 31).alias("ts"), F.col("id").alias("tie"), F.lit("x").alias("wide"))
    anchors = df.select("k", F.col("ts").alias("at"), F.col("tie").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (anchor_groups(df, ["k"], "ts", ["tie"], F.col("tie") % 5 == 0, F.lit("backward"), num_partitions=6),
                    asof_join(df, anchors, ["k"], "ts", "at", ["n"], tie_break=["n"], num_partitions=6)):
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            parts = out._jdf.queryExecution().explainString(mode).split("\n\n")
            wide = [p for p in parts if re.match(r"\(\d+\) Exchange", p.strip()) and re.search(r"Input.*(wide|_row)", p)]
            assert len(wide) == 1, wide
            assert "SortMergeJoin" not in "".join(parts) and "BroadcastHashJoin" in "".join(parts)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_code_sets_are_not_joins(part_a):
    from caresight.plans.oncology import classify_stage
    assert "Join" not in _plan(classify_stage(part_a))


def test_claim_tables_are_read_twice(spark):
    """Once for the cohort and once for the lines; everything later reads the staged lines."""
    from caresight.plans.oncology import OncologyJob
    from caresight.sources.adapters import Inputs
    from caresight.sources.tables import Owned
    reads = {"part_a": 0, "part_b": 0, "cclf4": 0}
    with Owned() as own:
        made = Inputs(spark, SF)

        class Counting:
            def __getitem__(self, name):
                reads[name] = reads.get(name, 0) + 1
                return made[name]
        job = OncologyJob(Counting(), None)
        assert job.filtered.count() > 0
    own.release()
    assert reads["part_a"] == 1 and reads["part_b"] == 1 and reads["cclf4"] == 2  # handles; a and b are used twice each


def test_building_a_frame_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    for name in ("filtered_claims", "alert_report", "action_completion", "provider_roster"):
        QUERIES[name](spark, SF)
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup("building") for i in tracker.getJobInfo(j).stageIds]
    assert {s.name.split(" ")[0] for s in stages if s} <= {"parquet"}  # footers are read for the schemas
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
