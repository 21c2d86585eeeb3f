"""The disk of the cost reports: steps in files that go, shuffles that go, lines numbered in slices."""
import datetime as dt
import decimal
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from caresight.plans import oncology as onc
from caresight.sources import adapters, tables
from caresight.sources.adapters import Inputs
from caresight.sources.tables import Owned, settle

SINCE = "1995-03-01"


@pytest.fixture(scope="module")
def claims(spark, tmp_path_factory):
    """Orders that repeat, keys and dates that are NULL, lines that come twice, a few patients and providers."""
    at, some = f"file:{tmp_path_factory.mktemp('claims')}", random.Random(4)
    day = lambda lo, hi: dt.datetime(1995, 1, 1) + dt.timedelta(days=some.randint(lo, hi))
    money = lambda n: decimal.Decimal(some.randint(1, n)) / 100
    orders = [(None if i == 7 else i, None if i % 31 == 0 else i % 6, None if i % 37 == 0 else day(30, 400), money(90000)) for i in range(400)]
    orders += orders[:40]
    lines = [(None if some.random() < 0.01 else some.randint(0, 399), some.randint(1, 60), some.randint(1, 3), some.randint(1, 7), money(5000), money(90000), money(10), money(8),
              some.choice("RAN"), some.choice("OFO"), None if some.random() < 0.02 else day(30, 460)) for _ in range(4000)]
    parts = [(i, 1 + i * 7 % 47, f"Brand#{11 + i % 40}") for i in range(1, 61)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice decimal(15,2)").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(lines + lines[::50], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity decimal(15,2), l_extendedprice decimal(15,2), "
                          "l_discount decimal(15,2), l_tax decimal(15,2), l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_brand string").write.parquet(f"{at}/part.parquet")
    return at


def rows(df):
    return sorted(map(str, df.collect()))


def scratch(spark, *kinds):
    """Files below the checkpoint folder of these kinds."""
    top = re.sub("^file:/*", "/", spark.sparkContext.getCheckpointDir())
    return {f"{d}/{f}" for d, _, names in os.walk(top) for f in names if any(f"/{k}-" in d for k in kinds)}


def test_slices_of_the_lines_are_all_lines(spark, claims, monkeypatch):
    """Lines numbered in slices of the order keys, in files dealt by them, are those numbered at once."""
    monkeypatch.setattr(adapters, "shuffle_width", lambda df: 12)
    whole = rows(Inputs(spark, claims, claims_since=SINCE)["claim_base"])
    monkeypatch.setattr(adapters, "SLICE_BYTES", tables.estimated_bytes(tables.read_table(spark, claims, "lineitem")) // 5 + 1)
    written = []
    monkeypatch.setattr(adapters, "settle", lambda frames, *a: written.extend(f.count() for f in frames) or settle(frames, *a))
    with Owned(brief=True):
        base = Inputs(spark, claims, claims_since=SINCE).in_files()["claim_base"]
        assert rows(base) == whole and len(written) == 5 and all(0 < n < len(whole) for n in written) and sum(written) == len(whole)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = base.groupBy("cur_clm_uniq_id").agg(F.max("bn"))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        assert "Bucketed: true" in plan and "Exchange" not in plan


def test_cost_reports_of_few_columns_are_those_of_all(spark, claims):
    """Also with NULL and repeated rows; the steps' files are gone by then, the courses stay."""
    whole = onc.OncologyJob(Inputs(spark, claims, claims_since=SINCE), SINCE, 9)
    before, views = scratch(spark, "settled", "scan"), spark.catalog.listTables()
    few = onc.OncologyJob(Inputs(spark, claims, claims_since=SINCE), SINCE, 9, onc.REPORT_COLS, onc.COST_COLS)
    final = few.final
    assert set(final.columns) < set(whole.final.columns) and final.count() > 100
    assert rows(final) == rows(whole.final.select(*final.columns))
    assert final.select("treatment_group").distinct().count() > 10
    for provider in "123":
        for report in (onc.cost_by_body_area, onc.cost_by_area_modality):
            assert [tuple(r) for r in report(final, provider).collect()] == [tuple(r) for r in report(whole.final, provider).collect()] != []
    made = scratch(spark, "settled") - before
    assert made and {os.path.basename(os.path.dirname(f)) for f in made} == {re.sub("/part-.*", "", final.inputFiles()[0]).rsplit("/", 1)[1]}
    assert [t.name for t in spark.catalog.listTables() if not t.isTemporary] == [t.name for t in views if not t.isTemporary]


def test_a_failing_step_leaves_no_files(spark, claims, monkeypatch):
    before = scratch(spark, "settled", "scan")
    monkeypatch.setattr(onc, "treatment_groups", lambda lines, *a: lines.select(F.raise_error(F.lit("no"))).collect())
    with pytest.raises(Exception, match="no"):
        onc.OncologyJob(Inputs(spark, claims, claims_since=SINCE), SINCE, 9, onc.REPORT_COLS, onc.COST_COLS).grouped
    assert scratch(spark, "settled", "scan") == before


def test_shuffle_files_go_when_a_step_is_written(spark):
    """And the session's settings are as before."""
    keys = (tables.SHUFFLES_GO, tables.WRITERS)
    before = [spark.conf.get(k, None) for k in keys]
    seen = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: sum(seen.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(seen.getAllFiles().size()))
    spark.range(500).repartition(3, "id").collect()  # its files stay until the garbage is collected
    there = shuffles()
    with Owned(brief=True):
        df = spark.range(5000).selectExpr("id % 90 as k", "id as v", "if(id % 3 = 0, null, 'x') as s")
        kept = settle(df.repartition(7, "k"), 7, "k")
        assert rows(kept) == rows(df)
        until = 100
        while shuffles() > there and (until := until - 1):
            __import__("time").sleep(0.1)
        assert shuffles() <= there and until
    assert [spark.conf.get(k, None) for k in keys] == before


@pytest.mark.parametrize("name", ["report_sink", "published_report", "cost_by_area_modality_sql"])
def test_the_reports_keep_no_blocks(spark, claims, name):
    """Their steps lie in encoded files: nothing of them is persisted, and the course pass carries few columns."""
    from caresight import catalog
    blocks = spark.sparkContext._jsc.sc().getPersistentRDDs
    before = blocks().size()
    df = catalog.QUERIES[name](spark, claims)
    assert df.columns and blocks().size() <= before
    stored = scratch(spark, "scan")
    df.collect()
    assert scratch(spark, "scan") <= stored
