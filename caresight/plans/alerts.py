"""Provider responsiveness to clinical alerts (dashboard report).

Inputs (adapter names): users, staff, npis, subs, alerts, exclusions, action_logs,
user_alerts, alert_actions, tin_consultant, assignment, master_view, practice_mapping.

Every per-provider metric is an aggregate keyed by NpiId; alert-level intermediates are
keyed by AlertId. "First read/action per alert and user" and "best response bucket per
alert / per patient" are aggregates over structs (combined map-side), not sorted windows.
The kept-alert set is staged once because a dozen metrics read it.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresight.functions.scalars import (boundary_diff, is_digits, plus_concat, utc_to_eastern,
                                         weekday_mon0, float_label, hundredths, valid_npi)
from caresight.operators.aggregates import count_if
from caresight.operators.filters import in_window
from caresight.operators.joins import anti, assemble, not_in, semi_either
from caresight.operators.snapshots import latest_snapshot, straddle_snapshots
from caresight.operators.windows import best_flags, row_number_per_key
from caresight.sources.tables import stage

NO_ACTION_TEXT = "No Action Taken"
METRICS = ("30-Day Readmission Rate", "% PDV")

# Business-day reach per weekday of receipt (Mon=0 .. Sun=6): a response counts as
# "within three business days" when its weekday lies 1..N days after the receipt weekday.
BUSINESS_DAY_REACH = (3, 3, 5, 5, 5, 4, 3)
WEEKEND_RECEIPT = (4, 5, 6)          # Fri, Sat, Sun
WEEKEND_REPLY_DAYS = (4, 5, 6, 0)    # Fri, Sat, Sun, Mon
DAY, THREE_DAYS, FIVE_DAYS = 60 * 24, 60 * 24 * 3, 60 * 24 * 5


def within_business_days(received: Column, done: Column) -> Column:
    """Weekday of ``done`` is 1..N days after the weekday of ``received`` (N by weekday)."""
    gap = F.pmod(weekday_mon0(done) - weekday_mon0(received), F.lit(7))
    reach = F.element_at(F.array(*[F.lit(n) for n in BUSINESS_DAY_REACH]), weekday_mon0(received) + 1)
    return (gap >= 1) & (gap <= reach)


def response_flags(received: str, done: str) -> list[Column]:
    """HoursLapsed, Less24, OneToThreeBD, MoreThreeBD for one (received, done) pair."""
    a, b = F.col(received), F.col(done)
    minutes = boundary_diff("MINUTE", a, b)
    less24 = F.when(weekday_mon0(a).isin(*WEEKEND_RECEIPT),
                    weekday_mon0(b).isin(*WEEKEND_REPLY_DAYS) & (minutes <= THREE_DAYS)
                    ).otherwise(minutes <= DAY)
    less24 = F.when(less24, 1).otherwise(0)
    one_three = F.when(less24 == 1, 0).when((minutes <= FIVE_DAYS) & within_business_days(a, b), 1).otherwise(0)
    more = F.when((less24 == 0) & (one_three == 0), 1).otherwise(0)
    return [boundary_diff("HOUR", a, b).alias("HoursLapsed"), less24.alias("Less24"),
            one_three.alias("OneToThreeBD"), more.alias("MoreThreeBD")]


def timely_no_action(received: Column, done: Column) -> Column:
    """The window in which a 'No Action Taken' closes an alert."""
    minutes = boundary_diff("MINUTE", received, done)
    return (minutes <= DAY) | ((minutes <= FIVE_DAYS) & within_business_days(received, done))


def _width(df: DataFrame) -> int:
    """Tasks of the session's shuffles; given as a number it stands, however small the rows are."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class AlertReport:
    def __init__(self, inputs, lower: str, upper: str, consultants: Sequence[str], convert_views: bool = False):
        """``convert_views``: read timestamps are stored in UTC like everything else, but
        the report compares them unconverted with Eastern receipt times; True converts."""
        self.inp, self.lower, self.upper = inputs, lower, upper
        self.consultants = list(consultants)
        self.convert_views = convert_views

    # ------------------------------------------------------------ mappings
    def _consultant_map(self, multi: int) -> DataFrame:
        tc = self.inp["tin_consultant"]
        newest = tc.select(F.max("dataset")).scalar()  # newest tag of the whole table
        tc = tc.where(F.col("Provider_Consultant").isin(*self.consultants)
                      & (F.col("multi_consultant_tin") == multi) & (F.col("dataset") == newest))
        return tc.select("TIN", F.col("Provider_Consultant").alias("Consultant"), "Company", "NPI").distinct()

    @cached_property
    def tin_map(self) -> DataFrame:
        return self._consultant_map(0)

    @cached_property
    def npi_map(self) -> DataFrame:
        return self._consultant_map(1)

    @cached_property
    def straddle(self) -> DataFrame:
        return (straddle_snapshots(self.inp["assignment"], "Year", "Period")
                .select("Beneficiary_ID", "TIN", "Npi", "Year", "Period").distinct())

    # ------------------------------------------------------------ roster (C11)
    @cached_property
    def staff(self) -> DataFrame:
        return self.inp["staff"].select("userId").distinct()

    @cached_property
    def users(self) -> DataFrame:
        u = self.inp["users"]
        return anti(u, self.staff, u["UserId"] == self.staff["userId"]).select(
            "UserId", F.col("FirstName").alias("FN"), F.col("LastName").alias("LN"), "UserName")

    @cached_property
    def npis(self) -> DataFrame:
        n = self.inp["npis"]
        active_users = self.inp["users"].where(F.col("Active") == 1).select(F.col("UserId").alias("_au"))
        n = anti(n, self.staff, n["PhysicianUserId"] == self.staff["userId"])
        n = n.where((F.col("Active") == 1) | (F.col("isMAProvider") == 1))
        n = n.join(active_users, F.col("PhysicianUserId") == F.col("_au"), "left_semi")
        n = n.where(valid_npi("NpiNum"))
        return n.select("NpiId", F.col("PhysicianUserId").alias("UserId"), "NpiNum")

    @cached_property
    def subs(self) -> DataFrame:
        s = self.inp["subs"]
        return anti(s, self.staff, s["UserId"] == self.staff["userId"]).select("NpiId", "UserId").distinct()

    @cached_property
    def doc_sub_info(self) -> DataFrame:
        n, s = self.npis.alias("n"), self.subs.alias("s")
        return stage(n.join(s, F.col("n.NpiId") == F.col("s.NpiId"), "inner")
                     .join(self.users.alias("u"), F.col("s.UserId") == F.col("u.UserId"), "inner")
                     .select(F.col("n.NpiId"), F.col("s.UserId"),
                             F.when(F.col("n.UserId") == F.col("s.UserId"), 1).otherwise(0).alias("IsDoctor"),
                             F.col("u.FN"), F.col("u.LN"), F.col("u.UserName")))

    # ------------------------------------------------------------ alerts and actions
    @cached_property
    def alerts(self) -> DataFrame:
        a = self.inp["alerts"].where(F.col("Active") == 1)
        a = a.withColumn("DateReceived", utc_to_eastern("CreatedDate"))
        a = a.where(in_window("DateReceived", self.lower, self.upper, "ts_next_day"))
        excl = self.inp["exclusions"].where(F.col("BenId").isNotNull())
        return stage(not_in(a, "BenId", excl, "BenId").select("AlertId", "NpiId", "BenId", "DateReceived"))

    @cached_property
    def beneficiaries(self) -> DataFrame:
        """Patients with an alert in the window, with payer and member number (one row per patient)."""
        ids = self.alerts.where(F.col("BenId").isNotNull()).select("BenId")
        return self.inp["beneficiaries"].join(ids, "BenId", "left_semi").select("BenId", "Payor", "BeneficiaryId")

    @cached_property
    def no_action_ids(self) -> DataFrame:
        return self.inp["alert_actions"].where(F.col("Text").like(NO_ACTION_TEXT)).select("AlertActionId")

    @cached_property
    def all_actions(self) -> DataFrame:
        logs = self.inp["action_logs"].where(F.col("Active") == 1)
        logs = logs.join(self.alerts.select("AlertId"), "AlertId", "left_semi")
        logs = anti(logs, self.staff, logs["UserId"] == self.staff["userId"])
        logs = logs.join(self.users.select(F.col("UserId").alias("_u")), F.col("UserId") == F.col("_u"), "left_semi")
        return stage(logs.select("AlertActionLogId", "AlertActionId", "AlertId", "UserId",
                                 utc_to_eastern("CreatedDate").alias("CreatedDate")))

    @cached_property
    def actions(self) -> DataFrame:
        """Actions excluding 'No Action Taken'."""
        return not_in(self.all_actions, "AlertActionId", self.no_action_ids, "AlertActionId")

    # ------------------------------------------------------------ exclusion
    @cached_property
    def no_action_pairs(self) -> DataFrame:
        """(NpiId, BenId) pairs whose every alert row is a timely 'No Action Taken'.

        Per alert: rows = max(1, #actions) (an alert without actions still counts once),
        timely = #timely no-action actions; a pair is removed when the sums are equal.
        """
        acts = self.all_actions.join(self.alerts.select("AlertId", "DateReceived"), "AlertId")
        no_ids = self.no_action_ids.select(F.col("AlertActionId").alias("_na"), F.lit(True).alias("_is_no"))
        acts = acts.join(no_ids, F.col("AlertActionId") == F.col("_na"), "left")
        timely = F.coalesce(F.col("_is_no"), F.lit(False)) & timely_no_action(F.col("DateReceived"), F.col("CreatedDate"))
        per_alert = acts.groupBy("AlertId").agg(F.count(F.lit(1)).alias("_n"), count_if(timely).alias("_t"))
        a = self.alerts.join(per_alert, "AlertId", "left")
        per_pair = self._pair_totals(a)
        return (per_pair.where(F.col("BenId").isNotNull()
                               & (F.col("TotalActionsPerPatient") == F.col("TotalNoActionTakenActions")))
                .select("NpiId", "BenId"))

    @staticmethod
    def _pair_totals(a: DataFrame) -> DataFrame:
        return a.groupBy("BenId", "NpiId").agg(
            F.sum(F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1))).alias("TotalActionsPerPatient"),
            F.sum(F.coalesce("_t", F.lit(0))).alias("TotalNoActionTakenActions"))

    @cached_property
    def action_totals(self) -> DataFrame:
        """COUNT(*) of alerts LEFT JOIN actions per (BenId, NpiId): an alert without
        actions counts once. Computed per alert first, so no alert x action rows."""
        per_alert = self.all_actions.groupBy("AlertId").agg(F.count(F.lit(1)).alias("_n"), F.lit(0).alias("_t"))
        return self._pair_totals(self.alerts.join(per_alert, "AlertId", "left"))

    @cached_property
    def kept(self) -> DataFrame:
        """Alerts minus the no-action pairs; staged (a dozen metrics read it)."""
        # Alerts without a patient can never match a pair: keep them without sending them
        # through the anti join (where all NULL keys would hash to one partition).
        a = self.alerts
        matched = anti(a.where(F.col("BenId").isNotNull()), self.no_action_pairs, ["BenId", "NpiId"])
        return stage(matched.unionByName(a.where(F.col("BenId").isNull())))

    # ------------------------------------------------------------ reads
    @cached_property
    def reads(self) -> DataFrame:
        ua = self.inp["user_alerts"].where(F.col("ViewedDate").isNotNull())
        ua = ua.join(self.kept.select("AlertId"), "AlertId", "left_semi")
        viewed = utc_to_eastern("ViewedDate") if self.convert_views else F.col("ViewedDate")
        return anti(ua, self.staff, ua["UserId"] == self.staff["userId"]).select(
            "AlertId", "UserId", viewed.alias("ViewedDate"))

    def _first_per_user(self, events: DataFrame, ts: str, out: str) -> DataFrame:
        first = events.groupBy("AlertId", "UserId").agg(F.min(ts).alias(out))
        return self.kept.join(first, "AlertId").select("AlertId", "NpiId", "BenId", "UserId", "DateReceived", out)

    @cached_property
    def first_reads(self) -> DataFrame:
        return self._first_per_user(self.reads, "ViewedDate", "DateRead")

    @cached_property
    def first_actions(self) -> DataFrame:
        return self._first_per_user(self.actions, "CreatedDate", "DateAction")

    # ------------------------------------------------------------ engagement counts
    def _per_npi(self, df: DataFrame, alerts: str, patients: str | None) -> DataFrame:
        aggs = [F.countDistinct("AlertId").alias(alerts)]
        if patients:
            aggs.append(F.countDistinct("BenId").alias(patients))
        return df.groupBy("NpiId").agg(*aggs)

    @cached_property
    def not_read_as_written(self) -> DataFrame:
        """As written the "unread" set joins kept alerts to themselves on their key, so it
        keeps exactly the alerts whose BenId is NULL."""
        k, r = self.kept.alias("k"), self.kept.alias("r")
        joined = k.join(r, F.col("k.AlertId") == F.col("r.AlertId"), "left").where(F.col("r.BenId").isNull())
        return joined.groupBy(F.col("k.NpiId").alias("NpiId")).agg(
            F.countDistinct(F.col("k.AlertId")).alias("AlertsNotRead"),
            F.countDistinct(F.col("k.BenId")).alias("PatientsNotRead"))

    @cached_property
    def alerts_not_read(self) -> DataFrame:
        """What the report means by unread: kept alerts with no read at all."""
        return self._per_npi(anti(self.kept, self.reads.select("AlertId"), "AlertId"),
                             "AlertsNotRead", "PatientsNotRead")

    # ------------------------------------------------------------ response buckets
    def _timings(self, first: DataFrame, done: str) -> DataFrame:
        d = self.doc_sub_info.select("NpiId", "UserId", "IsDoctor")
        j = d.join(first, ["UserId", "NpiId"])
        return j.select("AlertId", "NpiId", "BenId", "UserId", "IsDoctor", "DateReceived",
                        F.col(done).alias("DateAction"), *response_flags("DateReceived", done))

    @cached_property
    def read_timings(self) -> DataFrame:
        return stage(self._timings(self.first_reads, "DateRead"))

    @cached_property
    def action_timings(self) -> DataFrame:
        return stage(self._timings(self.first_actions, "DateAction"))

    FLAGS = ["Less24", "OneToThreeBD", "MoreThreeBD"]

    def _bucket_totals(self, timings: DataFrame, per: Sequence[str], prefix: str) -> DataFrame:
        best = best_flags(timings, per, self.FLAGS)
        return best.groupBy("NpiId").agg(*[
            count_if(F.col(f) == 1).alias(f"{prefix}{f}") for f in self.FLAGS])

    @cached_property
    def bucket_totals(self) -> list[DataFrame]:
        return [self._bucket_totals(self.read_timings, ["AlertId", "NpiId"], "AlertsRead"),
                self._bucket_totals(self.read_timings, ["BenId", "NpiId"], "PatientsRead"),
                self._bucket_totals(self.action_timings, ["AlertId", "NpiId"], "AlertsActions"),
                self._bucket_totals(self.action_timings, ["BenId", "NpiId"], "PatientsActions")]

    #: The flag tuple as one number that sorts as the tuple does.
    RANK = {"Less24": 4, "OneToThreeBD": 2, "MoreThreeBD": 1}

    @cached_property
    def per_alert(self) -> DataFrame:
        """One row per kept alert: read, acted (0 or 1), and the best response of a read and of an
        action (the flag tuple as a number, NULL without one), from one aggregation."""
        rank = sum((F.col(f) * n for f, n in self.RANK.items()), F.lit(0))
        parts = [(self.kept, {"NpiId": "NpiId", "BenId": "BenId", "kept": F.lit(1)}),
                 (self.reads, {"read": F.lit(1)}), (self.actions, {"acted": F.lit(1)}),
                 (self.read_timings, {"best_read": rank}), (self.action_timings, {"best_action": rank})]
        kinds = {"NpiId": "long", "BenId": "long", "kept": "int", "read": "int", "acted": "int", "best_read": "int", "best_action": "int"}
        rows = None
        for df, has in parts:
            part = df.select("AlertId", *[(F.col(has[c]) if isinstance(has.get(c), str) else has.get(c, F.lit(None))).cast(t).alias(c) for c, t in kinds.items()])
            rows = part if rows is None else rows.unionByName(part)
        return rows.groupBy("AlertId").agg(*[F.max(c).alias(c) for c in kinds]).where("kept = 1")

    @cached_property
    def engagement(self) -> DataFrame:
        """Received / read / unread / acted / not-acted counts and the four best-bucket totals per
        provider: alerts are reduced to patients, patients to providers, so a distinct count is a
        plain one and a large provider is reduced before each shuffle.

        "Not read" keeps the as-written meaning (alerts whose BenId is NULL, see
        ``not_read_as_written``); the alerts without a patient are one patient of the buckets and none
        of the counts."""
        count = lambda cond: F.sum(cond.cast("long"))
        by_patient = self.per_alert.groupBy("NpiId", "BenId").agg(
            F.count(F.lit(1)).alias("alerts"), F.count("read").alias("read"), F.count("acted").alias("acted"),
            *[count(F.coalesce(F.col(best) == n, F.lit(False))).alias(f"{best}{n}") for best in ("best_read", "best_action") for n in self.RANK.values()],
            F.max("best_read").alias("best_read"), F.max("best_action").alias("best_action"))
        known = F.col("BenId").isNotNull()
        some = lambda cond: count_if(known & cond)
        buckets = [(kind, best) for kind, best in (("Read", "best_read"), ("Actions", "best_action"))]
        return by_patient.groupBy("NpiId").agg(
            F.sum("alerts").alias("AlertsReceived"), count_if(known).alias("PatientsReceived"),
            F.sum("read").alias("AlertsRead"), some(F.col("read") > 0).alias("PatientsRead"),
            F.sum(F.when(~known, F.col("alerts")).otherwise(0)).alias("AlertsNotRead"), F.lit(0).cast("long").alias("PatientsNotRead"),
            F.sum("acted").alias("AlertsWActions"), some(F.col("acted") > 0).alias("PatientsWActions"),
            F.sum(F.col("alerts") - F.col("acted")).alias("AlertsWNoActions"), some(F.col("acted") < F.col("alerts")).alias("PatientsWNoActions"),
            *[F.sum(f"{best}{n}").alias(f"Alerts{kind}{f}") for kind, best in buckets for f, n in self.RANK.items()],
            *[count_if(F.col(best) == n).alias(f"Patients{kind}{f}") for kind, best in buckets for f, n in self.RANK.items()])

    # ------------------------------------------------------------ assembly (C20)
    @cached_property
    def statistics(self) -> DataFrame:
        spine = (self.users.join(self.npis, "UserId")
                 .select("UserId", "NpiId", "NpiNum", "UserName", plus_concat("LN", F.lit(", "), "FN").alias("Provider")))
        return assemble(spine, "NpiId", [self.engagement]).distinct()

    # ------------------------------------------------------------ enrichment
    @cached_property
    def entity_map(self) -> DataFrame:
        mv = latest_snapshot(self.inp["master_view"], "ACOR")
        mv = (mv.where((F.col("NPI_Approval") == 1) & (F.col("TIN_Approval") == 1))
              .select("NPI", "TIN", "Entity").distinct())
        return (self.npis.join(mv.hint("merge"), self.npis["NpiNum"] == mv["NPI"], "left")
                .select("NpiId", "TIN", F.col("Entity").alias("EntityName")))

    @cached_property
    def quality_metrics(self) -> DataFrame:
        pm = self.inp["practice_mapping"]
        newest = pm.select(F.max("DATASET")).scalar()  # newest tag of the whole table
        pm = semi_either(pm, [("NPI", self.npi_map, "NPI"), ("TIN", self.tin_map, "TIN")]).distinct()
        pm = pm.where(F.col("DATASET") == newest)
        st = self.straddle
        b = st.select(F.col("Npi").alias("_npi"), F.col("TIN").alias("_tin"), "Period").distinct()
        j = pm.join(b.hint("merge"), (pm["TIN"] == b["_tin"]) & (pm["NPI"] == b["_npi"]))
        j = j.where((F.col("year") == st.select(F.max("Year")).scalar())
                    & (((F.col("Eligibility") == "Formulated") & (F.col("Period") == "00"))
                       | ((F.col("Eligibility") == "CMS") & (F.col("Period") != "00")))
                    & (F.col("MemberSource") == "All") & is_digits("NPI") & F.col("Metric").isin(*METRICS))
        k = j.select("TIN", "NPI", "Metric", *[F.col(f"QTR{i}").cast("double").alias(f"Q{i}Ptg") for i in range(1, 5)],
                     "DATASET", "Eligibility").distinct()
        return row_number_per_key(k, ["TIN", "NPI"], [F.col("Metric").desc(), F.col("Eligibility"), F.col("DATASET")], "Rn")

    @cached_property
    def quality_table(self) -> DataFrame:
        """Positional pivot: rank 1 -> readmission columns, rank 2 -> PDV columns."""
        aggs = []
        for q in range(1, 5):
            aggs.append(F.avg(F.when(F.col("Rn") == 1, F.col(f"Q{q}Ptg"))).alias(f"Q{q}ReadmPtg"))
            aggs.append(F.avg(F.when(F.col("Rn") == 2, F.col(f"Q{q}Ptg"))).alias(f"Q{q}PDVPtg"))
        return self.quality_metrics.groupBy("TIN", "NPI").agg(*aggs)

    # ------------------------------------------------------------ final report
    #: Most copies of a report row that one run stands for.
    COPIES = 1024

    @cached_property
    def _report_runs(self) -> DataFrame:
        s = self.statistics.alias("a")
        em = self.entity_map.alias("b")
        # as written, a practice's row comes once for each of its providers: joined once, with their number,
        # and repeated at the end in runs of at most COPIES rows that are dealt to all tasks
        tin = self.tin_map.groupBy(F.col("TIN").alias("_ttin"), F.col("Consultant").alias("_tcons")).agg(F.count(F.lit(1)).alias("_times"))
        npi = self.npi_map.select(F.col("NPI").alias("_nnpi"), F.col("Consultant").alias("_ncons"))
        multi = self.npi_map.select(F.col("TIN").alias("_mtin")).distinct().withColumn("_multi", F.lit(True))
        e = self.quality_table.select(F.col("TIN").alias("_etin"), F.col("NPI").alias("_enpi"),
                                  *[F.col(c) for c in self.quality_table.columns if c not in ("TIN", "NPI")])
        # tables that grow with the providers meet by shuffles: the driver would collect each to broadcast it
        j = (s.join(em.hint("merge"), F.col("a.NpiId") == F.col("b.NpiId"), "left")
             .join(tin.hint("merge"), F.col("b.TIN") == F.col("_ttin"), "left")
             .join(npi.hint("merge"), F.col("a.NpiNum") == F.col("_nnpi"), "left")
             .join(multi.hint("merge"), F.col("b.TIN") == F.col("_mtin"), "left")
             .join(e.hint("merge"), (F.col("a.NpiNum") == F.col("_enpi")) & (F.col("b.TIN") == F.col("_etin")), "left"))
        j = (j.withColumn("_times", F.coalesce("_times", F.lit(1)))
             .withColumn("_from", F.explode(F.expr(f"sequence(0L, _times - 1, {self.COPIES}L)"))))
        consultant = F.coalesce(F.when(F.coalesce(F.col("_multi"), F.lit(False)), F.col("_ncons"))
                                .otherwise(F.col("_tcons")), F.lit("no consultant"))
        c = F.col
        return j.select(
            c("a.UserId").alias("UserId"), c("a.NpiId").alias("NpiId"), c("a.NpiNum").alias("NpiNum"),
            c("a.UserName").alias("Username"), c("a.Provider").alias("Provider"), c("b.TIN").alias("TIN"),
            c("b.EntityName").alias("TINName"), consultant.alias("ProviderConsultant"),
            "AlertsReceived", "AlertsWActions", "AlertsWNoActions",
            (c("AlertsActionsLess24") + c("AlertsActionsOneToThreeBD")).alias("AlertsWActionsUnder3BD"),
            "AlertsActionsLess24", "AlertsActionsOneToThreeBD", "AlertsActionsMoreThreeBD",
            "AlertsRead", "AlertsNotRead",
            (c("AlertsReadLess24") + c("AlertsReadOneToThreeBD")).alias("AlertsReadUnder3BD"),
            "AlertsReadLess24", "AlertsReadOneToThreeBD", "AlertsReadMoreThreeBD",
            "PatientsReceived", "PatientsWActions", "PatientsWNoActions",
            (c("PatientsActionsLess24") + c("PatientsActionsOneToThreeBD")).alias("PatientsWActionsUnder3BD"),
            "PatientsActionsLess24", "PatientsActionsOneToThreeBD", "PatientsActionsMoreThreeBD",
            "PatientsRead", "PatientsNotRead",
            (c("PatientsReadLess24") + c("PatientsReadOneToThreeBD")).alias("PatientsReadUnder3BD"),
            "PatientsReadLess24", "PatientsReadOneToThreeBD", "PatientsReadMoreThreeBD",
            *[float_label(c(f"Q{q}{m}Ptg")).alias(f"Q{q}{m}Ptg") for q in range(1, 5) for m in ("Readm", "PDV")],
            "_from", F.least(c("_times") - c("_from"), F.lit(self.COPIES)).alias("_copies"))

    @staticmethod
    def _repeated(runs: DataFrame) -> DataFrame:
        """Each run's row as often as it counts, next to each other."""
        return runs.withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)"))).drop("_from", "_copies", "_copy")

    @cached_property
    def report(self) -> DataFrame:
        """In order of the patients received: the runs are sorted, then repeated where they lie."""
        runs = self._report_runs.where(F.col("ProviderConsultant").isin(*self.consultants))
        order = [F.col("PatientsReceived").desc(), F.col("NpiId"), F.col("_from")]
        return self._repeated(runs.repartitionByRange(_width(runs), *order).sortWithinPartitions(*order))

    @cached_property
    def report_base(self) -> DataFrame:
        """The report rows before the consultant filter (every provider's consultant)."""
        return self._repeated(self._report_runs.repartition(_width(self._report_runs), "NpiId", "_from"))

    # ------------------------------------------------------------ README questions
    @cached_property
    def response_share(self) -> DataFrame:
        """Share of acted alerts handled within 24 h vs later, per provider (hundredths)."""
        s = self.statistics.where(F.col("AlertsWActions") > 0)
        return s.select("NpiId", "AlertsWActions", "AlertsActionsLess24",
                        hundredths(F.col("AlertsActionsLess24"), F.col("AlertsWActions")).alias("pct_within_24h_x100"),
                        hundredths(F.col("AlertsWActions") - F.col("AlertsActionsLess24"),
                                   F.col("AlertsWActions")).alias("pct_delayed_x100"))

    @cached_property
    def engagement_vs_quality(self) -> DataFrame:
        """Engagement counts next to the quality metrics of the same TIN x NPI."""
        s = self.statistics.join(self.entity_map.select("NpiId", "TIN"), "NpiId", "left")
        q = self.quality_table.select(F.col("TIN").alias("_t"), F.col("NPI").alias("_n"), "Q1ReadmPtg", "Q1PDVPtg")
        j = s.join(q, (F.col("NpiNum") == F.col("_n")) & (F.col("TIN") == F.col("_t")), "inner")
        return j.select("NpiId", "TIN", "AlertsReceived", "AlertsWActions", "AlertsActionsLess24",
                        "Q1ReadmPtg", "Q1PDVPtg")

    @cached_property
    def engagement_quality_corr(self) -> DataFrame:
        """Pearson correlation between timely action and the quality metrics, over the
        providers that have both (rounded to 6 decimals)."""
        e = self.engagement_vs_quality
        timely = F.col("AlertsActionsLess24").cast("double")
        return e.agg(F.count(F.lit(1)).alias("providers"),
                     F.round(F.corr(timely, F.col("Q1ReadmPtg")), 6).alias("corr_timely_readmission"),
                     F.round(F.corr(timely, F.col("Q1PDVPtg")), 6).alias("corr_timely_pdv"))
