"""Operator tests: brute force on small fixtures, NULL rules, hot keys across partitions."""
import datetime as dt
import random

from pyspark.sql import functions as F

from caresight.operators.joins import not_in, semi_either
from caresight.operators.scans import asof_join, global_sequence, nearest_within
from caresight.operators.windows import best_flags, first_per_key, latest_with_ties, priority_label
from caresight.plans.actions import role_scope, role_tiers


def _rows(n=400, keys=6, hot=0, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = hot if (hot is not None and rnd.random() < 0.5) else rnd.randrange(keys)
        out.append((i, k, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(200))))
    return out


def test_asof_backward_and_forward_match_brute_force(spark):
    left = _rows(400, hot=0, seed=1)
    anchors = [(i, k, d) for i, k, d in _rows(120, hot=0, seed=2)]
    ldf = spark.createDataFrame(left, "id int, k int, d date")
    adf = spark.createDataFrame(anchors, "grp int, k int, ad date")
    for direction in ("backward", "forward"):
        got = {r.id: r.grp for r in asof_join(ldf, adf, ["k"], "d", "ad", ["grp"], direction,
                                              tie_break=["grp"], num_partitions=5).collect()}
        for i, k, d in left:
            cands = [(ad, g) for g, kk, ad in anchors if kk == k and (ad <= d if direction == "backward" else ad >= d)]
            if not cands:
                exp = None
            elif direction == "backward":
                best = max(a for a, _ in cands)
                exp = min(g for a, g in cands if a == best)
            else:
                best = min(a for a, _ in cands)
                exp = min(g for a, g in cands if a == best)
            assert got[i] == exp, (direction, i)


def test_nearest_within_matches_brute_force(spark):
    left = _rows(300, hot=1, seed=3)
    right = _rows(300, hot=1, seed=4)
    ldf = spark.createDataFrame(left, "id int, k int, d date")
    rdf = spark.createDataFrame(right, "rid int, k int, d2 date")
    got = {r.id for r in nearest_within(ldf, rdf, ["k"], "d", "d2", 0, 60).collect()}
    exp = {i for i, k, d in left if any(kk == k and 0 <= (d2 - d).days <= 60 for _, kk, d2 in right)}
    assert got == exp


def test_global_sequence_dense_and_ordered(spark):
    rows = _rows(500, hot=2, seed=5)
    df = spark.createDataFrame(rows, "id int, k int, d date")
    out = global_sequence(df, ["k", "d", "id"], out="seq", num_partitions=6).collect()
    exp = {r[0]: n + 1 for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2], r[0])))}
    assert {r.id: r.seq for r in out} == exp


def test_not_in_null_rules(spark):
    a = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, ben int")
    empty = spark.createDataFrame([], "ben int")
    listed = spark.createDataFrame([(10,)], "ben int")
    with_null = spark.createDataFrame([(10,), (None,)], "ben int")
    assert sorted(r.id for r in not_in(a, "ben", empty, "ben").collect()) == [1, 2, 3]
    assert sorted(r.id for r in not_in(a, "ben", listed, "ben").collect()) == [3]
    assert not_in(a, "ben", with_null, "ben").count() == 0


def test_semi_either_no_duplicates(spark):
    df = spark.createDataFrame([("n1", "t1"), ("n2", "t2"), ("n3", "t3")], "npi string, tin string")
    k1 = spark.createDataFrame([("n1",), ("n1",)], "npi string")
    k2 = spark.createDataFrame([("t1",), ("t2",)], "tin string")
    out = semi_either(df, [("npi", k1, "npi"), ("tin", k2, "tin")]).collect()
    assert sorted(r.npi for r in out) == ["n1", "n2"]


def test_latest_with_ties_keeps_ties(spark):
    rows = [(1, 1, dt.datetime(2024, 1, 2), "a"), (1, 1, dt.datetime(2024, 1, 2), "b"), (1, 1, dt.datetime(2024, 1, 1), "c"),
            (2, 1, dt.datetime(2024, 1, 1), "d")]
    df = spark.createDataFrame(rows, "p int, c int, ts timestamp_ntz, s string")
    assert sorted(r.s for r in latest_with_ties(df, ["p", "c"], "ts").collect()) == ["a", "b", "d"]


def test_first_per_key_and_best_flags(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "z"), (1, 1, "y"), (2, 5, "q")], "k int, seq int, code string")
    out = {r.k: (r.seq, r.code) for r in first_per_key(df, ["k"], ["seq", "code"]).collect()}
    assert out == {1: (1, "y"), 2: (5, "q")}
    f = spark.createDataFrame([(1, 0, 1, 0), (1, 1, 0, 0), (2, 0, 0, 1)], "a int, l int, o int, m int")
    got = {r.a: (r.l, r.o, r.m) for r in best_flags(f, ["a"], ["l", "o", "m"]).collect()}
    assert got == {1: (1, 0, 0), 2: (0, 0, 1)}


def test_priority_label_ties(spark):
    df = spark.createDataFrame([(1, "Unknown"), (1, "Brachytherapy"), (2, "3D"), (2, "SBRT"), (3, "IMRT")],
                               "g int, t string")
    out = {r.g: r.t for r in priority_label(df, "g", "t", {"IMRT": 1, "SBRT": 2, "3D": 3}, 5).collect()}
    assert out == {1: "Brachytherapy", 2: "SBRT", 3: "IMRT"}


def test_role_tiers_and_scope(spark):
    roles = spark.createDataFrame([(0, "SUPERVISOR"), (1, "PROVIDER"), (2, "REVIEWER USER"), (3, "USER"),
                                   (5, "REPORT"), (6, "DATA")], "RoleId int, RoleName string")
    ur = spark.createDataFrame([(10, 0), (10, 5), (11, 2), (11, 3), (12, 6), (12, 3)], "UserId int, RoleId int")
    got = {r.UserId: r.RoleName for r in role_tiers(ur, roles).collect()}
    assert got == {10: "REPORT", 11: "REVIEWER USER", 12: "DATA"}
    rows = spark.createDataFrame([(7,), (8,)], "CreatedBy int")
    for role, exp in (("SUPERVISOR", [7, 8]), ("USER", [7, 8]), ("REVIEWER USER", [7]), (None, [])):
        r = F.lit(role).cast("string")
        assert sorted(x.CreatedBy for x in rows.where(role_scope(F.col("CreatedBy"), r, 7, [])).collect()) == exp
    r = F.lit(None).cast("string")
    assert [x.CreatedBy for x in rows.where(role_scope(F.col("CreatedBy"), r, 7, [8])).collect()] == [8]


def test_anchor_groups_matches_brute_force(spark):
    from caresight.operators.scans import anchor_groups
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(5)
        kind = rnd.choice(["anchor", "forward", "backward", "none"])
        rows.append((i, k, dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randrange(90)), kind))
    df = spark.createDataFrame(rows, "id int, k int, d date, kind string")
    look = F.when(F.col("kind").isin("forward", "backward"), F.col("kind"))
    got = {r.id: r.g for r in anchor_groups(df, ["k"], "d", ["id"], F.col("kind") == "anchor", look,
                                            out="g", num_partitions=6).collect()}
    anchors = sorted((k, d, i) for i, k, d, kind in rows if kind == "anchor")
    number = {i: n + 1 for n, (_, _, i) in enumerate(anchors)}
    for i, k, d, kind in rows:
        if kind == "anchor":
            exp = number[i]
        elif kind == "none":
            exp = None
        else:
            c = [(ad, number[ai]) for ak, ad, ai in anchors if ak == k and (ad >= d if kind == "forward" else ad <= d)]
            if not c:
                exp = None
            else:
                best = min(a for a, _ in c) if kind == "forward" else max(a for a, _ in c)
                exp = min(g for a, g in c if a == best)
        assert got[i] == exp, (i, kind)
