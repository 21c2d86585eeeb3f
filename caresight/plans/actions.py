"""Care-tracking action completion statistics (parameterised report).

The procedure's scalars (default dates, resolved role, completed total, available total)
stay *inside the plan* as uncorrelated scalar subqueries: nothing is collected to the
driver, and the whole report is one lazy DataFrame. Python-side branching happens only
on the caller's parameters (empty multi-value parameter = no filter).
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresight.functions.params import values_list
from caresight.functions.scalars import flag_off
from caresight.operators.aggregates import percent_of_total, two_level_count, with_total_row
from caresight.operators.filters import optional_in
from caresight.operators.joins import exists_chain
from caresight.operators.windows import latest_with_ties, with_grand_total
from caresight.sources.tables import stage

TOTAL_AVAILABLE = "Total Actions Available"
TOTAL_COMPLETED = "Total Actions Completed"
OPEN = "OPEN"
# Role tiers in resolution order; the first tier holding any role of the user wins.
ROLE_TIERS = (("SUPERVISOR", "REPORT"), ("PROVIDER", "REVIEWER USER"), ("USER", "DATA"))
SEE_ALL_CHAIN = ("SUPERVISOR", "REPORT")


# Captions of the published report.
CAPTIONS = {"category": "Category", "total_action": "TotalAction", "total_act_percentage": "TotalActPecentage", "aggregated_total": "AggregatedTotal"}


@dataclass
class ActionParams:
    login: int
    selected: Sequence[int] | str | None = None
    category: Sequence[str] | str | None = None
    practice: Sequence[str] | str | None = None
    payer: Sequence[str] | str | None = None
    physician: Sequence[str] | str | None = None
    start: str | None = None          # None = earliest CreatedDate
    end: str | None = None            # None = latest CreatedDate
    npi_type: Sequence[str] | str | None = None
    strict: bool = False              # the documented scope instead of the one as written

    def values(self, name: str) -> list:
        return values_list(getattr(self, name))


def role_tiers(user_roles: DataFrame, roles: DataFrame) -> DataFrame:
    """Resolved role per user: the first non-empty tier, alphabetical within a tier."""
    tier = F.lit(None).cast("int")
    for i, names in reversed(list(enumerate(ROLE_TIERS))):
        tier = F.when(F.col("RoleName").isin(*names), F.lit(i)).otherwise(tier)
    ranked = (user_roles.join(roles, "RoleId").select("UserId", tier.alias("tier"), "RoleName")
              .where(F.col("tier").isNotNull()))
    return ranked.groupBy("UserId").agg(F.min(F.struct("tier", "RoleName"))["RoleName"].alias("RoleName"))


def resolve_role(user_roles: DataFrame, roles: DataFrame, user: int) -> Column:
    """The caller's role as a scalar subquery; NULL when the user holds no listed role."""
    per_user = role_tiers(user_roles.where(F.col("UserId") == user), roles)
    return per_user.select(F.max("RoleName")).scalar()


def role_scope(created_by: Column, role: Column, login: int, selected: list) -> Column:
    """Row visibility as the procedure states it: selected users win; otherwise every role
    but REVIEWER USER sees all rows, REVIEWER USER sees its own rows, no role sees none."""
    if selected:
        return created_by.isin(*selected)
    own = role.isNotNull() & (created_by == login)
    everyone = role.isin("SUPERVISOR", "REPORT", "PROVIDER") | (role != "REVIEWER USER")
    return F.coalesce(own | everyone, F.lit(False))


def role_scope_strict(created_by: Column, role: Column, login: int, selected: list) -> Column:
    """The documented intent: supervisors and report users see all rows, others their own."""
    if selected:
        return created_by.isin(*selected)
    return F.coalesce(role.isin(*SEE_ALL_CHAIN) | (created_by == login), F.lit(False))


class ActionCompletion:
    def __init__(self, inputs, params: ActionParams):
        self.inp, self.p = inputs, params

    # ---------------------------------------------------------------- scalars
    @cached_property
    def tracking(self) -> DataFrame:
        return self.inp["tracking"]

    @cached_property
    def _bounds(self) -> DataFrame:
        """First and last record in one row, from one scan."""
        return stage(self.tracking.agg(F.min("CreatedDate").alias("lo"), F.max("CreatedDate").alias("hi")))

    @cached_property
    def start(self) -> Column:
        if self.p.start:
            return F.lit(self.p.start).cast("timestamp_ntz")
        return self._bounds.select("lo").scalar()

    @cached_property
    def end(self) -> Column:
        if self.p.end:
            return F.lit(self.p.end).cast("timestamp_ntz")
        return self._bounds.select("hi").scalar()

    @cached_property
    def role(self) -> Column:
        return resolve_role(self.inp["ct_user_roles"], self.inp["ct_roles"], self.p.login)

    def _day_of(self, c: str) -> Column:
        return F.to_date(F.col(c)).cast("timestamp_ntz")

    def _next_day(self, ts: Column) -> Column:
        return ts + F.expr("INTERVAL 1 DAY")

    # ---------------------------------------------------------------- eligible patients
    @cached_property
    def chain(self) -> list:
        """subscription -> user -> npi -> npi location -> location -> entity location -> entity,
        with the parameter filters on each table."""
        i = self.inp
        subs = i["ct_subscriptions"].where(F.col("ShowCareTracker") == 1)
        user_ok = self.role.isin(*SEE_ALL_CHAIN) | (F.col("UserId") == self.p.login)
        users = i["ct_users"].where(user_ok)
        npis = optional_in(i["ct_npis"], "NpiType", self.p.values("npi_type"))
        entities = optional_in(i["entities"].where(F.col("Active") == 1), "EntityName", self.p.values("practice"))
        return [(subs, ()), (users, ["UserId"]), (npis, ["NpiId"]),
                (i["npi_locations"].withColumnRenamed("NPIId", "NpiId"), ["NpiId"]),
                (i["locations"], ["LocationId"]), (i["entity_locations"], ["LocationId"]),
                (entities, ["EntityId"])]

    @cached_property
    def patients(self) -> DataFrame:
        """Patients passing the payer/physician filters and the relationship EXISTS."""
        pts = self.inp["patients"]
        pts = optional_in(pts, "Insurance", self.p.values("payer"))
        pts = optional_in(pts, "PhysicianName", self.p.values("physician"))
        return exists_chain(pts, ["NPIId", "EntityId"], self.chain, ["NpiId", "EntityId"])

    @cached_property
    def eligible(self) -> DataFrame:
        pts = self.patients
        t = self.tracking.where((F.col("IsReqforHistory") == 1) & (self._day_of("CreatedDate") <= self.end))
        # read by the completed, available and aggregated branches
        return stage(t.join(pts, t["CTBeneficiaryID"] == pts["ID"], "left_semi")
                     .select("CTBeneficiaryID").distinct())

    # ---------------------------------------------------------------- completed
    def _scoped(self, df: DataFrame) -> DataFrame:
        scope = role_scope_strict if self.p.strict else role_scope
        return df.where(scope(F.col("CreatedBy"), self.role, self.p.login, self.p.values("selected")))

    def _with_category(self, df: DataFrame) -> DataFrame:
        cat = self.inp["bene_category"].select(F.col("Id").alias("_bc"), F.col("CategoryId").alias("_cid"))
        c = self.inp["category"].select(F.col("Id").alias("_cid"), "CategoryCode")
        return (df.join(cat, df["CTBeneficiaryCategoryID"] == cat["_bc"])
                .join(c, "_cid").drop("_bc", "_cid"))

    @cached_property
    def counts_by_category_status(self) -> DataFrame:
        t = self.tracking.where((F.col("IsReqforHistory") == 1)
                                & self._day_of("CreatedDate").between(self.start, self.end)
                                & flag_off("IsCustomActionTaken"))
        t = t.join(self.eligible, "CTBeneficiaryID", "left_semi")
        t = self._with_category(self._scoped(t))
        return t.groupBy("CategoryCode", "StatusId").agg(F.count("Id").alias("total"))

    @cached_property
    def by_status(self) -> DataFrame:
        """SUM of counts per status; statuses without data keep a NULL count unless a
        category filter is set (the filter on the joined side makes the join inner)."""
        s = self.inp["ct_status"]
        t = self.counts_by_category_status
        cats = self.p.values("category")
        j = s.join(t, s["Id"] == t["StatusId"], "inner" if cats else "left")
        if cats:
            j = j.where(F.col("CategoryCode").isin(*cats))
        return stage(j.groupBy("Status", "Id").agg(F.sum("total").alias("ActionsCount")))

    @cached_property
    def completed(self) -> DataFrame:
        """Non-OPEN statuses with their count and the grand total over them."""
        d = self.by_status.where(F.col("Status") != OPEN)
        return with_grand_total(d, "ActionsCount", "TotalActions")

    @cached_property
    def total_completed(self) -> Column:
        return self.by_status.where(F.col("Status") != OPEN).select(F.sum("ActionsCount")).scalar()

    # ---------------------------------------------------------------- available
    @cached_property
    def _history(self) -> DataFrame:
        t = self.tracking.join(self.eligible, "CTBeneficiaryID", "left_semi")
        t = t.where((F.col("IsReqforHistory") == 1) & flag_off("IsCustomActionTaken"))
        t = self._with_category(t)
        t = optional_in(t, "CategoryCode", self.p.values("category"))
        st = self.inp["ct_status"].select(F.col("Id").alias("_sid"), "Status", "StatusCategory")
        act = self.inp["ct_actions"].select(F.col("Id").alias("_aid"))
        # read by the available and the aggregated branch, and by the tie look-up
        return stage(t.join(st, t["StatusId"] == st["_sid"])
                     .join(act, t["ActionId"] == act["_aid"], "left_semi").drop("_sid"))

    @cached_property
    def open_latest(self) -> DataFrame:
        """Latest rows (ties kept) per patient x category that are still OPEN."""
        h = self._history.where(F.col("CreatedDate") <= self._next_day(self.end))
        latest = latest_with_ties(h, ["CTBeneficiaryID", "CTBeneficiaryCategoryID"], "CreatedDate")
        return latest.where(F.col("StatusCategory") == OPEN)

    @cached_property
    def total_available(self) -> Column:
        return (self.open_latest.select(F.count(F.lit(1))).scalar()
                + F.coalesce(self.total_completed, F.lit(0)))

    # ---------------------------------------------------------------- aggregated
    @cached_property
    def status_row_count(self) -> DataFrame:
        h = self._history.where(F.col("CreatedDate").between(self.start, self._next_day(self.end)))
        h = self._scoped(h)
        return two_level_count(h, ["CTBeneficiaryID", "CTBeneficiaryCategoryID", "StatusCategory", "Status", "CreatedDate"],
                               ["CTBeneficiaryID", "StatusCategory", "Status", "CreatedDate"], "RowCount")

    @cached_property
    def aggregated_by_status(self) -> DataFrame:
        other = self.status_row_count.where(F.col("StatusCategory") != OPEN)
        return other.groupBy("Status").agg(
            F.sum(F.when(F.col("RowCount") >= 1, 1).otherwise(0)).cast("long").alias("AggregatedTotal"))

    @cached_property
    def aggregated_with_total(self) -> DataFrame:
        return with_total_row(self.aggregated_by_status, "Status", TOTAL_COMPLETED, ["AggregatedTotal"])

    # ---------------------------------------------------------------- final table
    @cached_property
    def result(self) -> DataFrame:
        s = self.inp["ct_status"].where(F.col("Status") != OPEN)
        comp = self.completed.select(F.col("Id").alias("_cid"), "ActionsCount")
        status_rows = (s.join(comp, s["Id"] == comp["_cid"], "left")
                       .select(F.col("Status").alias("category"),
                               F.coalesce("ActionsCount", F.lit(0)).cast("long").alias("total_action")))
        total_c = F.coalesce(self.total_completed, F.lit(0)).cast("long")
        one = self.tracking.sparkSession.range(1)
        completed_row = one.select(F.lit(TOTAL_COMPLETED).alias("category"), total_c.alias("total_action"))
        pct_rows = percent_of_total(status_rows, "total_action", self.total_completed, "total_act_percentage")
        completed_row = completed_row.withColumn(
            "total_act_percentage", F.when(F.col("total_action") != 0, F.lit("100.00%")).otherwise(F.lit("0.00%")))
        available_row = one.select(F.lit(TOTAL_AVAILABLE).alias("category"),
                                   self.total_available.cast("long").alias("total_action"),
                                   F.lit("").alias("total_act_percentage"))
        rows = available_row.unionByName(completed_row).unionByName(pct_rows)
        agg = self.aggregated_with_total.select(F.col("Status").alias("_st"), "AggregatedTotal")
        j = rows.join(agg, rows["category"] == agg["_st"], "left")
        return j.select("category", F.coalesce("total_action", F.lit(0)).alias("total_action"),
                        "total_act_percentage",
                        F.when(F.col("category") == TOTAL_AVAILABLE, F.lit(""))
                        .otherwise(F.coalesce(F.col("AggregatedTotal").cast("string"), F.lit("0")))
                        .alias("aggregated_total"))
