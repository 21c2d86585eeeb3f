"""The claim lines at size: early date floor, widths by size, methods that the JVM compiles, stages read once."""
import datetime as dt
import decimal
import re

from pyspark.sql import functions as F

from caresight.plans.oncology import OncologyJob
from caresight.sources.adapters import LOOKUPS, Inputs
from caresight.sources.tables import NO_ESTIMATE, Owned, shuffle_width

SF = "/root/testdata/sf0.001"


def test_diagnosis_look_ups_are_the_cases(spark):
    n = spark.range(-60, 60).select(F.col("id").cast("int").alias("bn")).union(spark.createDataFrame([(None,)], "bn int"))
    for case, lookup in LOOKUPS.items():
        assert n.selectExpr(f"({case}) = ({lookup}) as same").where("same is not true").count() == 0


def test_early_date_floor_changes_no_later_claim(spark, tmp_path):
    """Order keys that repeat, with dates on both sides of the floor, or NULL."""
    t = dt.datetime
    orders = [(1, 10, t(1995, 1, 1)), (2, 20, t(1996, 1, 1)), (3, 30, t(1995, 1, 1)), (3, 31, t(1996, 5, 5)), (4, 40, None), (5, 50, t(1995, 3, 1)),
              (None, 60, t(1997, 1, 1)), (6, 61, t(1997, 1, 1)), (6, 61, t(1997, 1, 1)), (6, 62, None)]
    money = decimal.Decimal("1.50")
    spark.createDataFrame([(*o, money) for o in orders], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice decimal(15,2)"
                          ).write.parquet(f"file:{tmp_path}/orders.parquet")
    lines = [(k, p, 5, n, money, money, money, money, "R", s, t(1996, 1, n)) for k in (1, 2, 3, 4, 5, 6, None) for n, p, s in ((1, 1, "O"), (2, 2, "F"), (3, 1, "F"))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity decimal(15,2), l_extendedprice decimal(15,2), "
                          "l_discount decimal(15,2), l_tax decimal(15,2), l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"file:{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 10, "Brand#13"), (2, 30, "Brand#25")], "p_partkey long, p_size int, p_brand string").write.parquet(f"file:{tmp_path}/part.parquet")
    since = "1995-03-01"
    for name in ("part_a", "part_b"):
        later = F.col("clm_from_dt") > F.lit(since).cast("date")
        whole = sorted(map(str, Inputs(spark, f"file:{tmp_path}")[name].where(later).collect()))
        early = sorted(map(str, Inputs(spark, f"file:{tmp_path}", claims_since=since)[name].where(later).collect()))
        assert early == whole and early
    assert Inputs(spark, f"file:{tmp_path}", claims_since=since)["claim_base"].where("cur_clm_uniq_id in (1, 4, 5)").count() == 0


def test_widths_grow_with_the_table(spark, monkeypatch):
    from caresight.sources import tables
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_width(df) == least
    size = tables.estimated_bytes(df)
    monkeypatch.setattr(tables, "TASK_BYTES", size // 50)
    assert 50 <= shuffle_width(df) <= 52
    monkeypatch.setattr(tables, "estimated_bytes", lambda df: NO_ESTIMATE)
    assert shuffle_width(df) == least
    with Owned() as own:
        job = OncologyJob(Inputs(spark, SF), None, 13)
        assert job.cohort.rdd.getNumPartitions() == 13
    own.release()


def test_generated_methods_of_the_lines_are_compiled(spark):
    """The JVM compiles no method of 8,000 bytes of code or more."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with Owned() as own:
            job = OncologyJob(Inputs(spark, SF), "1995-03-01")
            for lines in (job.a_lines, job.b_lines):
                text = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package").codegenString(lines._jdf.queryExecution().executedPlan())
                sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
                assert sizes and max(sizes) < 8000
        own.release()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_final_lines_read_staged_courses(spark):
    """The course pass is computed once for the modality of each course and the lines."""
    with Owned() as own:
        final = OncologyJob(Inputs(spark, SF), None).final
        plan = final._jdf.queryExecution().withCachedData()
        leaves = plan.collectLeaves()
        assert {leaves.apply(i).nodeName() for i in range(leaves.size())} == {"InMemoryRelation"}
    own.release()


def test_event_pairs_by_one_join_are_those_of_two(spark, tmp_path):
    """Around bucket borders and the turn of the year, with NULL users and times and repeated rows."""
    from caresight.sources.adapters import ADAPTERS
    rows = [(i, None if i % 17 == 0 else i % 3, None if i % 19 == 0 else dt.datetime(2023, 11, 1) + dt.timedelta(hours=17 * i),
             ("error", "click", "view", "purchase")[i * 7 % 4 if i % 5 else 0]) for i in range(240)]
    events = spark.createDataFrame(rows + rows[:40], "event_id long, user_id long, ts timestamp_ntz, event_type string")
    events.write.parquet(f"file:{tmp_path}/events.parquet")
    events.createOrReplaceTempView("pair_events")
    inputs = Inputs(spark, f"file:{tmp_path}")
    for name in ("action_logs", "user_alerts"):
        two = sorted(map(str, spark.sql(ADAPTERS[name].replace("{events}", "pair_events")).collect()))
        assert sorted(map(str, inputs[name].collect())) == two and two
        assert inputs[name]._jdf.queryExecution().analyzed().toString().count("Join Inner") == 1


def test_staged_columns_are_kept_as_they_are(spark):
    """Stored sizes: the text is not put into a dictionary; the session's setting is as before."""
    from caresight.sources.tables import COMPRESSED, stage
    before = spark.conf.get(COMPRESSED)
    df = spark.range(20_000, numPartitions=1).select(F.repeat(F.lit("x"), 50).alias("s"))
    with Owned() as own:
        kept = stage(df)
        assert kept.count() == 20_000
        assert kept.where(F.col("s") == "x" * 50).count() == 20_000
        size = int(str(kept._jdf.queryExecution().withCachedData().stats().sizeInBytes()))
    own.release()
    assert size > 20_000 * 50 and spark.conf.get(COMPRESSED) == before


def test_lines_meet_the_cohort_where_their_claim_is(spark):
    """No line is shuffled by patient: two narrow shuffles of claims and patients instead, with repeated and NULL keys."""
    from caresight.plans.oncology import BENE, of_patients
    rows = [(i % 7 if i % 5 else None, None if i % 11 == 0 else i % 13, f"line {i}") for i in range(300)]
    lines = spark.createDataFrame(rows, f"cur_clm_uniq_id long, {BENE} long, text string").repartition(4, "cur_clm_uniq_id")
    patients = spark.createDataFrame([(1,), (2,), (12,), (None,)], f"{BENE} long")
    found = of_patients(lines, patients)
    # as a join by patient, but for lines without a claim, which are in no claim's list
    expected = sorted(str(r) for r in lines.join(patients, BENE, "left_semi").select(*lines.columns).where("cur_clm_uniq_id is not null").collect())
    assert sorted(map(str, found.collect())) == expected and expected
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = of_patients(lines, patients.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("cur_clm_uniq_id" in x and "REPARTITION" in x for x in shuffles) >= 1
    assert not any("text" in x for x in plan.splitlines() if f"hashpartitioning({BENE}" in x)


def test_one_row_per_key_needs_no_sort_aggregate(spark):
    from caresight.plans.oncology import one_per_key
    rows = [(i % 9 or None, i % 2, f"{i * 7 % 5}" if i % 3 else None, i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, s string, n long")
    least = df.groupBy("a", "b").agg(F.min(F.struct("n", "s")).alias("m")).select("a", "b", "m.s", "m.n")
    once = one_per_key(df, ["a", "b"], ["n"])
    assert sorted(map(str, once.collect())) == sorted(map(str, least.collect()))
    assert "SortAggregate" not in once._jdf.queryExecution().executedPlan().toString()


def test_days_as_bits_and_as_sets(spark, monkeypatch):
    from caresight.operators import scans
    day = lambda n: dt.date(1969, 11, 1) + dt.timedelta(days=n)
    left = spark.createDataFrame([(k if k else None, day(n) if n % 29 else None, n) for k in (0, 1, 2) for n in range(0, 400, 3)], "k long, d date, n long")
    right = spark.createDataFrame([(k if k else None, day(n * n % 397) if n % 7 else None) for k in (0, 1) for n in range(25)], "k long, d date")
    lefts, rights = left.collect(), right.collect()
    for lo, hi in ((0, 60), (-5, 4)):
        pairs = {}
        for a in lefts:
            gaps = [(b.d - a.d).days for b in rights if a.k is not None and a.k == b.k and a.d and b.d and lo <= (b.d - a.d).days <= hi]
            if gaps:
                pairs[(a.k, a.n)] = min(gaps)
        for mask in (62, 0):
            monkeypatch.setattr(scans, "MASK_DAYS", mask)
            near = scans.nearest_within(left, right, ["k"], "d", "d", lo, hi, out="gap")
            assert near.columns == ["k", "d", "n", "gap"]
            assert {(r.k, r.n): r.gap for r in near.collect()} == pairs and pairs
    monkeypatch.setattr(scans, "MASK_DAYS", 62)
    assert "collect_set" not in scans.nearest_within(left, right, ["k"], "d", "d", 0, 60)._jdf.queryExecution().executedPlan().toString()


def test_fewer_staged_columns_change_no_row(spark):
    """The course and report queries over all columns and over those they read."""
    from caresight.plans.oncology import COURSE_COLS, REPORT_COLS, OncologyJob as Job
    with Owned() as own:
        inputs = Inputs(spark, SF)
        whole, course, report = (Job(inputs, "1995-03-01", None, c) for c in (None, COURSE_COLS, REPORT_COLS))
        rows = lambda df: sorted(map(str, df.collect()))
        assert course.combined.columns == COURSE_COLS and report.combined.columns == REPORT_COLS
        assert rows(course.grouped) == rows(whole.grouped.select(*COURSE_COLS, "treatment_group"))
        assert rows(report.final) == rows(whole.final)
    own.release()


def test_part_b_lines_without_a_claim_stay(spark):
    """They are in no claim's list of patients, and meet the cohort by patient."""
    from caresight.plans.oncology import BENE, CODE, PART_B_DX, part_b_lines
    columns = f"{BENE} long, cur_clm_uniq_id long, {CODE} string, " + ", ".join(f"{c} string, {d} string" for c, d in PART_B_DX)
    rows = [(b, claim, "77263", *(("I10", "x") * 2 + ("C61", "y")  + ("C439", "z") * 1 + ("I10", "x") * 2)) for b, claim in ((1, 5), (1, None), (2, 5), (3, None), (None, None), (1, 5))]
    part_b = spark.createDataFrame(rows, columns)
    cancer = spark.createDataFrame([("C61",), ("C439",)], "icd_code string")
    found = part_b_lines(part_b, spark.createDataFrame([(1,), (None,)], f"{BENE} long"), cancer)
    assert sorted(((r[BENE], r.cur_clm_uniq_id, r.clm_dgns_cd, r.description) for r in found.collect()), key=str) == sorted(
        [(1, 5, "C61", "y"), (1, None, "C61", "y"), (1, 5, "C61", "y")], key=str)


def test_claim_lines_are_staged_as_numbers(spark):
    """No text is kept of the numbered lines, and they are sorted once, for their numbers."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with Owned() as own:
            base = Inputs(spark, SF)["claim_base"]
            leaves = base._jdf.queryExecution().withCachedData().collectLeaves()
            assert [leaves.apply(i).nodeName() for i in range(leaves.size())] == ["InMemoryRelation"]
            assert "string" not in leaves.apply(0).schema().simpleString()
            plan = base._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Sort \[l_orderkey", plan)) == 1 and "ShuffledHashJoin" in plan
        own.release()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_least_rows_by_leading_columns(spark):
    """Fewer columns are ranked where the wanted ones come first; the rows stay those of all columns."""
    from caresight.plans.oncology import leading, one_per_key
    rows = [(i % 9 or None, i % 2, f"{i * 7 % 5}" if i % 3 else None, i % 4, f"{i % 6}") for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, s string, n long, t string")
    few = leading(df, ["n", "a", "not there"])
    assert few.columns == ["a", "b", "s", "n"]
    assert sorted(map(str, one_per_key(few, ["a", "b"]).collect())) == sorted(map(str, one_per_key(df, ["a", "b"]).drop("t").collect()))
    with Owned() as own:
        from caresight.plans.oncology import COURSE_COLS
        lines = OncologyJob(Inputs(spark, SF), "1995-03-01", None, COURSE_COLS).a_lines
        assert "fac_prvdr_npi_num" not in lines.columns and "clm_line_pmt_amnt" not in lines.columns
    own.release()


def test_course_pass_has_a_task_per_range(spark):
    """Ranges are dealt by their numbers, not by hashes of them, and one sort serves the numbers and the look-up back."""
    from caresight.operators.scans import anchor_groups
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), (F.col("id") % 31).alias("ts"), F.col("id").alias("tie"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = anchor_groups(df, ["k"], "ts", ["tie"], F.col("tie") % 5 == 0, F.lit("backward"), num_partitions=11)
        rows = [r[0] for r in out.select(F.spark_partition_id()).distinct().collect()]
        assert len(rows) == 11
        plan = out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange HashedRelation")[0]
        assert len(re.findall(r"Sort \[_scan_pid\S* ASC", plan)) == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    anchors = sorted((r.k, r.ts, r.tie) for r in df.where("tie % 5 = 0").collect())
    number = {a: i + 1 for i, a in enumerate(anchors)}
    for r in out.collect():
        before = [a for a in anchors if a[0] == r.k and a[1] <= r.ts]
        day = max((a[1] for a in before), default=None)
        least = min((number[a] for a in before if a[1] == day), default=None)
        assert r.group == (number[(r.k, r.ts, r.tie)] if r.tie % 5 == 0 else least)


def test_no_text_of_the_lines_is_shuffled(spark):
    """Texts that are staged as numbers become numbers where their table is read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with Owned() as own:
            leaf = Inputs(spark, SF)["claim_base"]._jdf.queryExecution().withCachedData().collectLeaves().apply(0)
            joined = leaf.cachedPlan().toString().split("Exchange hashpartitioning(l_orderkey")[0]
            assert "l_shipdate" in joined and not re.search("p_brand|l_returnflag|l_linestatus", joined)
        own.release()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_codes_are_probed_by_numbers(spark):
    """Texts only confirm what one number finds: no table of texts is broadcast, whose counters all tasks write."""
    from caresight.operators.filters import any_in_set, first_matching
    rows = [(i, (None, "A", "B", "x", "", "A ")[i % 6], ("B", None, "y")[i % 3]) for i in range(18)]
    df = spark.createDataFrame(rows, "id long, c string, d string")
    codes = spark.sql("select * from values ('A'), (' B'), ('A'), (null) as t(code)")
    wanted = {i: next((v for v in (c, d) if v in ("A", "B")), None) for i, c, d in rows}
    every = first_matching(df, [("c", "c"), ("d", "d")], codes, "found", "text", keep_unmatched=True)
    assert {r.id: r.found for r in every.collect()} == wanted and every.count() == 18
    assert {r.id: r.hit for r in any_in_set(df, ["c", "d"], codes, "hit").collect()} == {i: v is not None for i, v in wanted.items()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = first_matching(df, [("c", "c"), ("d", "d")], codes, "found", "text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    keys = re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan)
    assert len(keys) == 2 and all("xxhash64" in k for k in keys)


def test_one_diagnosis_goes_on_to_the_joins(spark):
    """Part B lines meet the cohort with the diagnosis picked, not with six and their texts; the big methods still compile."""
    with Owned() as own:
        job = OncologyJob(Inputs(spark, SF), "1995-03-01")
        lines = [x for x in job.b_lines._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
        semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x and "_claim" in x)
        assert any("LeftOuter" in x and "_hit0" in x for x in lines[semi + 1:])
        assert not any("_hit" in x for x in lines[:semi])
    own.release()
