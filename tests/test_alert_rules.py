"""Response-bucket rules against a brute-force reading of the weekday table."""
import datetime as dt

from pyspark.sql import functions as F

from caresight.plans.alerts import AlertReport, response_flags, timely_no_action

NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
ALLOWED = {"Monday": {"Tuesday", "Wednesday", "Thursday"},
           "Tuesday": {"Wednesday", "Thursday", "Friday"},
           "Wednesday": {"Thursday", "Friday", "Saturday", "Sunday", "Monday"},
           "Thursday": {"Friday", "Saturday", "Sunday", "Monday", "Tuesday"},
           "Friday": {"Saturday", "Sunday", "Monday", "Tuesday", "Wednesday"},
           "Saturday": {"Sunday", "Monday", "Tuesday", "Wednesday"},
           "Sunday": {"Monday", "Tuesday", "Wednesday"}}


def _minutes(a, b):
    return int((b.replace(second=0, microsecond=0) - a.replace(second=0, microsecond=0)).total_seconds() // 60)


def _expected(a, b):
    m = _minutes(a, b)
    da, db = NAMES[a.weekday()], NAMES[b.weekday()]
    if da in ("Monday", "Tuesday", "Wednesday", "Thursday"):
        less = 1 if m <= 1440 else 0
    else:
        less = 1 if db in ("Friday", "Saturday", "Sunday", "Monday") and m <= 4320 else 0
    one = 0 if less else (1 if m <= 7200 and db in ALLOWED[da] else 0)
    return less, one, 1 if less == 0 and one == 0 else 0


def test_response_buckets_all_weekday_pairs(spark):
    base = dt.datetime(2024, 3, 4, 10, 30, 15)  # a Monday; the DST switch 2024-03-10 is inside the range
    rows = []
    for d in range(7):
        a = base + dt.timedelta(days=d)
        for off in (0, 1440, 1441, 4320, 4321, 7200, 7201, -30, 2 * 1440 + 7, 6 * 1440):
            rows.append((a, a + dt.timedelta(minutes=off)))
        for e in range(7):
            rows.append((a, a + dt.timedelta(days=e, minutes=5)))
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    out = df.select("a", "b", *response_flags("a", "b"),
                    timely_no_action(F.col("a"), F.col("b")).alias("t")).collect()
    for r in out:
        assert (r.Less24, r.OneToThreeBD, r.MoreThreeBD) == _expected(r.a, r.b), (r.a, r.b)
        assert r.Less24 + r.OneToThreeBD + r.MoreThreeBD == 1
        m = _minutes(r.a, r.b)
        exp_t = m <= 1440 or (m <= 7200 and NAMES[r.b.weekday()] in ALLOWED[NAMES[r.a.weekday()]])
        assert r.t == exp_t


def test_no_action_exclusion_pairs(spark):
    """All-timely 'No Action Taken' pairs are removed; an unanswered alert or a late
    no-action keeps the pair (an alert with no action still counts once)."""
    t0 = dt.datetime(2024, 1, 8, 14)  # Monday, UTC
    tables = {
        "users": spark.createDataFrame([(u, f"F{u}", f"L{u}", f"u{u}", 1) for u in (1, 2, 3)],
                                       "UserId long, FirstName string, LastName string, UserName string, Active int"),
        "staff": spark.createDataFrame([], "userId long"),
        "exclusions": spark.createDataFrame([], "BenId long"),
        "alert_actions": spark.createDataFrame([(1, "Called patient"), (2, "No Action Taken")],
                                               "AlertActionId int, Text string"),
        "alerts": spark.createDataFrame([
            (100, 9, 1, t0, 1), (101, 9, 1, t0, 1),   # pair (1, 9): both closed by timely no-action
            (200, 9, 2, t0, 1), (201, 9, 2, t0, 1),   # pair (2, 9): one alert unanswered
            (300, 9, 3, t0, 1)],                      # pair (3, 9): no-action after 6 days
            "AlertId long, NpiId long, BenId long, CreatedDate timestamp_ntz, Active int"),
        "action_logs": spark.createDataFrame([
            (1, 2, 100, 1, t0 + dt.timedelta(hours=2), 1), (2, 2, 101, 1, t0 + dt.timedelta(hours=3), 1),
            (3, 2, 200, 1, t0 + dt.timedelta(hours=2), 1),
            (4, 2, 300, 1, t0 + dt.timedelta(days=6), 1)],
            "AlertActionLogId long, AlertActionId int, AlertId long, UserId long, CreatedDate timestamp_ntz, Active int"),
    }
    r = AlertReport(tables, lower="2024-01-01", upper="2024-01-31", consultants=["Alice", "Bob"])
    pairs = {(x.BenId, x.NpiId) for x in r.no_action_pairs.collect()}
    assert pairs == {(1, 9)}
    assert sorted(x.AlertId for x in r.kept.collect()) == [200, 201, 300]


def test_every_provider_of_a_practice_repeats_the_report_row(spark, tmp_path, monkeypatch):
    """Eight practices hold all providers, and a report row comes once for each entry of its practice."""
    import datetime as dt
    from caresight.sources.adapters import Inputs
    ids = list(range(0, 600, 3))
    events = [(i, u, dt.datetime(2024, 1, 3, 10), "error", 1.0) for i, u in enumerate(ids)]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double").write.parquet(f"file:{tmp_path}/events.parquet")
    monkeypatch.setattr(AlertReport, "COPIES", 4)  # several runs for each row
    report = AlertReport(Inputs(spark, f"file:{tmp_path}"), "2023-12-31", "2024-01-31", ["Alice", "Bob"])
    npis = {r.NpiId: r.NpiNum for r in report.npis.collect()}
    listed = {}
    for i in ids:
        listed[f"T{i % 8}"] = listed.get(f"T{i % 8}", 0) + (i % 4 != 0)
    got = {}
    for r in report.report_base.where("TIN is not null").select("NpiId", "TIN").collect():
        assert r.TIN == f"T{r.NpiId % 8}"
        got[r.NpiId] = got.get(r.NpiId, 0) + 1
    assert set(got) <= set(npis) and max(got.values()) > 4
    assert all(n == max(1, listed[f"T{i % 8}"]) for i, n in got.items())
    rows = [r.PatientsReceived for r in report.report.collect()]
    assert rows == sorted(rows, reverse=True) and len(rows) > max(got.values())
