"""Splitters in SQL text against their DataFrame forms; published results; catalog tables."""
import pytest
from pyspark.sql import functions as F

from caresight.functions.params import split_param, string_split
from caresight.functions.sql import create_reports, create_splitters
from caresight.sources import tables as src

TEXTS = ["a,b,c", ",a,,b,", "a", "", None, "   ", " a , b  ", "a,,", ",", "x" * 40 + ",y", "515515,  551515,   5545454"]


@pytest.mark.parametrize("delim", [",", ";", "|", ".", "*", "^", "\\", "]", "-", "$", " "])
def test_sql_splitters_equal_the_dataframe_forms(spark, delim):
    create_splitters(spark)
    df = spark.createDataFrame([(i, t and t.replace(",", delim)) for i, t in enumerate(TEXTS)], "i int, s string")
    df.createOrReplaceTempView("texts")
    quoted = delim.replace("\\", "\\\\")
    for name, want in ((f"split_param(t.s, '{quoted}', 30)", split_param(df, "s", delim).select("i", "ordinal", "Param")),
                       (f"string_split(t.s, '{quoted}')", string_split(df, "s", delim, with_ordinal=True).select("i", "ordinal", "value"))):
        got = spark.sql(f"SELECT t.i, p.* FROM texts t, LATERAL {name} p")
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key), (delim, name)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Join" not in plan and "Generate" in plan


def test_sql_splitter_with_constants_filters_a_table(spark):
    create_splitters(spark)
    spark.range(5).select(F.concat(F.lit("n"), "id").alias("name")).createOrReplaceTempView("named")
    got = spark.sql("SELECT name FROM named WHERE name IN (SELECT trim(piece) FROM string_split('n1; n3 ;n9', ';'))")
    assert sorted(r.name for r in got.collect()) == ["n1", "n3"]


def test_reports_are_called_with_parameters(spark):
    class Job:
        final = spark.createDataFrame(
            [("3", "breast", "IMRT", "4-Radiation", 1, 7, 10), ("3", "breast", "IMRT", "2-Simulation", 1, 7, 5), ("3", "lung", "SBRT", "4-Radiation", None, 8, 1), ("4", "lung", "SBRT", "4-Radiation", 2, 8, 2)],
            "oprtg_prvdr_npi_num string, body_area string, treatment_type string, treatment_process string, treatment_group long, beneficiary_id long, clm_line_pmt_amnt int")
    create_reports(spark, Job())
    rows = lambda text: sorted(map(tuple, spark.sql(text).collect()))
    assert rows("SELECT body_area, CAST(total_cost AS INT), distinct_patients, treatment_deliveries FROM cost_by_body_area('3')") == [("breast", 15, 1, 1), ("lung", 1, 1, 1)]
    assert rows("SELECT body_area, treatment_type, CAST(total_cost AS INT) FROM cost_by_area_modality('3')") == [("breast", "IMRT", 15)]
    spark.createDataFrame([("3",), ("4",), ("5",)], "p string").createOrReplaceTempView("providers")
    assert rows("SELECT v.p, r.body_area FROM providers v, LATERAL cost_by_body_area(v.p) r") == [("3", "breast"), ("3", "lung"), ("4", "lung")]
    assert rows("SELECT treatment_group, delivery_sessions FROM course_sessions(8)") == [(2, 1)]


def test_a_failed_write_leaves_the_former_result(spark, tmp_path):
    path = f"{tmp_path}/report"
    src.publish_report(spark.range(3).withColumnRenamed("id", "n"), path, {"n": "# Count"})
    assert spark.read.parquet(path).columns == ["# Count"] and spark.read.parquet(path).count() == 3
    broken = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="no"):
        src.publish_report(broken, path, {"n": "# Count"})
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["report"]
    src.publish_report(spark.range(5).withColumnRenamed("id", "n"), path)
    assert spark.read.parquet(path).columns == ["n"] and spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["report"]


def test_captions_name_every_column_of_their_report():
    from caresight.plans import actions, oncology
    assert list(oncology.BODY_AREA_CAPTIONS) == ["body_area", "total_cost", "distinct_patients", "treatment_deliveries"]
    assert set(oncology.DETAIL_CAPTIONS) <= set(oncology.FINAL_COLS)
    assert list(actions.CAPTIONS) == ["category", "total_action", "total_act_percentage", "aggregated_total"]


def test_catalog_tables_of_two_databases(spark):
    names = {**src.add_to_catalog(spark, "/root/testdata/sf0.001", "caresight_test_a", ["orders"]),
             **src.add_to_catalog(spark, "/root/testdata/sf0.001", "caresight_test_b", ["nation", "orders"])}
    assert names == {"nation": "caresight_test_b.nation", "orders": "caresight_test_b.orders"}
    tables = src.CatalogTables(spark, names)
    assert tables["orders"].count() == src.read_table(spark, "/root/testdata/sf0.001", "orders").count()
    assert src.add_to_catalog(spark, "/root/testdata/sf0.001", "caresight_test_b", ["nation"]) == {"nation": "caresight_test_b.nation"}
    plan = tables["orders"].where("o_orderkey > 7").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,7)]" in plan
    with pytest.raises(KeyError):
        tables["supplier"]
