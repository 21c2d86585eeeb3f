"""The registered queries against their SQL, and the pipeline against its stages."""
import os
import random
import sys

import duckdb
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from caresight.llm import op1_decontaminate as o1, op2_simhash as o2, op7_quality_rules as o7  # noqa: E402
from caresight.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, SF)
        want = con.sql(sql)
        assert sorted(got.columns) == sorted(want.columns), name
        cols = sorted(got.columns)
        key = lambda r: tuple(str(x) for x in r)
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key) == sorted(want.select(*cols).fetchall(), key=key), name


def test_every_stage_does_its_part(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        if name == "near dedup":  # lines of copies are gone in this small table: a copy is planted that must go
            before = corpus_pipeline.written(before.union(before.orderBy("doc_id").limit(1).withColumn("doc_id", F.lit(10**9).cast("long")).select(docs.columns)))
        kept = corpus_pipeline.written(stage(spark, before, SF))
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes, name
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        was = {r.doc_id for r in before.select("doc_id").collect()}
        assert ids < was, name
        if name == "quality rules":
            assert ids == {r.doc_id for r in o7.quality(before).where("kept").collect()}
        if name == "near dedup":
            assert ids == {r.component_id for r in o2.near_duplicates(before).collect()}
        if name == "decontamination":
            assert was - ids == {r.doc_id for r in o1.contaminated(before, corpus_pipeline.table(spark, SF, "benchmark")).collect()}
    final = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in final.select("doc_id").collect()} == ids
    assert final.columns == ["doc_id", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_on_null_empty_repeated_and_long_rows(spark, tmp_path):
    """Null ids and texts, empty and very long texts, repeated rows and an empty table go through all stages."""
    rng = random.Random(2)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)]
    good = lambda k: " ".join(f"the {rng.choice(words)} of {rng.choice(words)} and {rng.choice(words)} is in." for _ in range(k))
    texts = [good(30) for _ in range(6)]
    rows = [(1, texts[0]), (2, texts[1]), (2, texts[1]), (3, None), (4, ""), (5, " \n\t "), (None, texts[2]), (None, None), (6, texts[3] + "\n" + texts[0]), (7, good(6000)), (8, texts[0])]
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    bench = spark.createDataFrame([(1, None), (2, "nothing of this kind here at all")], "item_id long, text string")
    for name, data in (("rows", full), ("none", [])):
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{tmp_path}/{name}/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/rows").collect()
    ids = [r.doc_id for r in got]
    # the copy of document 1 and the repeated row go; what has no words fails the base rules
    assert sorted(ids, key=str) == sorted([1, 2, 6, 7, None], key=str) and all(r.n_tokens == len(r.token_ids) > 0 for r in got)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
