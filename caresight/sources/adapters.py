"""Reference-shaped inputs projected from the driver's test tables.

The reference reads claims, alerting and care-tracking tables that are not available; the
adapters below reshape the TPC-H-like test tables into those shapes (definitions in
FIXTURES.md). Each adapter is one SQL text in the common dialect of Spark SQL and DuckDB,
so the *same* input feeds the Spark jobs and the DuckDB oracle. Only the adapters are
shared; the operator logic is written separately on each side.

Placeholders ``{name}`` refer to base tables or to other adapters.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caresight.sources.tables import NO_ESTIMATE, TABLES, CatalogTables, estimated_bytes, read_table, settle, shuffle_width, stage, view


def _dx(n: str) -> str:
    """Diagnosis code picked from a brand number (FIXTURES.md §2)."""
    return (f"case when ({n}) % 25 between 0 and 3 then 'C50911' "
            f"when ({n}) % 25 between 4 and 6 then 'C3490' "
            f"when ({n}) % 25 between 7 and 8 then 'C61' "
            f"when ({n}) % 25 between 9 and 10 then 'C439' "
            f"when ({n}) % 25 = 11 then 'C189' else 'I10' end")


def _dx_lookup(n: str) -> str:
    """``_dx`` as a look-up in a constant array: twelve of them as CASE make one generated method that
    the JVM leaves uncompiled."""
    codes = [next((c for lo, hi, c in ((0, 3, "C50911"), (4, 6, "C3490"), (7, 8, "C61"), (9, 10, "C439"), (11, 11, "C189"))
                   if lo <= i <= hi), "I10") for i in range(25)]
    return f"coalesce(get(array({', '.join(map(repr, codes))}), ({n}) % 25), 'I10')"


#: Diagnosis picks of the texts and what Spark evaluates for them.
LOOKUPS = {_dx(n): _dx_lookup(n) for n in ("bn", *(f"bn + {k}" for k in range(1, 6)))}


#: Expressions of the claim lines' text that the staged lines hold as numbers: name, stored form, read back as.
STORED = {
    "cast(o.o_orderdate as date)": ("order_day", "unix_date({})", "date_from_unix_date({})"),
    "cast(l.l_shipdate as date)": ("ship_day", "unix_date({})", "date_from_unix_date({})"),
    "l.l_returnflag = 'R'": ("returned", "{}", "{}"),
    "cast(l.l_quantity as int)": ("quantity", "{}", "{}"),
    # no adapter reads lines of another status
    "l.l_linestatus": ("status", "case {} when 'O' then 1 when 'F' then 2 end", "case {} when 1 then 'O' when 2 then 'F' end"),
    "cast(substr(p.p_brand, 7) as int)": ("bn", "{}", "{}"),
}
#: Those that are taken of the numbered lines: what they come from is shuffled anyway, as lines are numbered by it.
NUMBERED = {"ship_day", "quantity"}
#: Stored bytes up to which the planner may broadcast the parts.
PART_BYTES = 10 << 20
#: Stored bytes of lines that are numbered at a time where the numbered lines go to files.
SLICE_BYTES = 1 << 30


def _tin(n: str) -> str:
    """Practice number of a provider: eight practices hold all providers."""
    return f"cast({n} % 8 as string)"


def _desc(code: str) -> str:
    return f"concat('Diagnosis ', {code})"


_HCPCS = """case when p.p_size <= 8 then '99213' when p.p_size <= 12 then '77263'
      when p.p_size <= 18 then '77300' when p.p_size <= 24 then '77412'
      when p.p_size <= 28 then 'G6015' when p.p_size <= 31 then '77373'
      when p.p_size <= 34 then 'G6012' when p.p_size <= 37 then '77770'
      when p.p_size <= 41 then '77427' when p.p_size <= 44 then '77767' else '12345' end"""

ADAPTERS: dict[str, str] = {
    # ---------------------------------------------------------------- oncology claims
    "claim_base": f"""
select case when l.l_orderkey % 101 = 7 then cast(null as bigint) else o.o_custkey end as beneficiary_id,
       l.l_orderkey as cur_clm_uniq_id,
       cast(row_number() over (partition by l.l_orderkey order by l.l_linenumber, l.l_partkey,
            l.l_suppkey, l.l_shipdate, l.l_extendedprice, l.l_quantity, l.l_discount, l.l_tax) as int)
         as clm_line_num,
       cast(o.o_orderdate as date) as clm_from_dt,
       case when l.l_orderkey % 89 = 3 then cast(null as date) else cast(l.l_shipdate as date) end
         as clm_line_from_dt,
       cast(l.l_shipdate as date) as clm_line_thru_dt,
       concat({_HCPCS}, case when l.l_linenumber % 2 = 0 then ' ' else '' end) as clm_line_hcpcs_cd,
       cast(l.l_suppkey as string) as atndg_prvdr_npi_num,
       case when l.l_partkey % 10 = 0 then cast(null as string)
            when l.l_partkey % 10 = 1 then ''
            when l.l_partkey % 10 = 2 then '~         '
            else cast(l.l_suppkey as string) end as oprtg_prvdr_npi_num,
       case when l.l_returnflag = 'R' then '1' else '0' end as clm_adjsmt_type_cd,
       case when l.l_linenumber = 7 then '50' else '71' end as clm_type_cd,
       cast(l.l_quantity as int) as clm_line_srvc_unit_qty,
       cast(o.o_totalprice as decimal(18,2)) as clm_header_pmt_amnt,
       cast(l.l_extendedprice as decimal(18,2)) as clm_line_pmt_amnt,
       l.l_linestatus as line_status,
       l.l_linenumber as src_line,
       cast(substr(p.p_brand, 7) as int) as bn,
       cast(l.l_partkey as string) as fac_prvdr_npi_num
from {{lineitem}} l
join {{orders}} o on l.l_orderkey = o.o_orderkey
join {{part}} p on l.l_partkey = p.p_partkey""",
    # some (claim, line) rows come twice, as the sources have them
    "claim_copies": """
select b.*, c.copy from {claim_base} b
join (select * from (values (1, 0), (1, 1), (2, 1)) as t(copy, twice)) c
  on c.twice = case when b.cur_clm_uniq_id % 23 = 5 or b.cur_clm_uniq_id % 19 = 4 then 1 else 0 end""",
    "part_a": f"""
select beneficiary_id, cur_clm_uniq_id, clm_from_dt, clm_line_num, clm_type_cd,
       clm_line_from_dt, clm_line_thru_dt, clm_line_hcpcs_cd, oprtg_prvdr_npi_num,
       {_dx('bn')} as prncpl_dgns_cd, {_desc(_dx('bn'))} as prncpl_dgns,
       fac_prvdr_npi_num, case when copy = 2 then '0' else atndg_prvdr_npi_num end as atndg_prvdr_npi_num,
       cast(null as string) as othr_prvdr_npi_num,
       clm_adjsmt_type_cd, clm_line_srvc_unit_qty, clm_header_pmt_amnt, clm_line_pmt_amnt
from {{claim_copies}} where line_status = 'O' and (copy = 1 or cur_clm_uniq_id % 23 = 5)""",
    "cclf4": f"""
select cur_clm_uniq_id, src_line as clm_val_sqnc_num, {_dx('bn')} as clm_dgns_cd
from {{claim_base}} where line_status = 'O'""",
    "part_b": f"""
select beneficiary_id, cur_clm_uniq_id, clm_line_num, clm_line_pmt_amnt as clm_line_cvrd_pd_amt,
       clm_line_hcpcs_cd,
       {_dx('bn')} as clm_line_dgns_cd, {_desc(_dx('bn'))} as clm_line_dgns,
       {_dx('bn + 1')} as clm_dgns_1_cd, {_desc(_dx('bn + 1'))} as clm_dgns_1,
       {_dx('bn + 2')} as clm_dgns_2_cd, {_desc(_dx('bn + 2'))} as clm_dgns_2_,
       {_dx('bn + 3')} as clm_dgns_3_cd, {_desc(_dx('bn + 3'))} as clm_dgns3,
       {_dx('bn + 4')} as clm_dgns_4_cd, {_desc(_dx('bn + 4'))} as clm_dgns_4,
       {_dx('bn + 5')} as clm_dgns_5_cd, {_desc(_dx('bn + 5'))} as clm_dgns_5,
       clm_type_cd, clm_from_dt,
       cast(case when copy = 2 then clm_line_from_dt + interval 2 days else clm_line_from_dt end as date) as clm_line_from_dt,
       clm_line_thru_dt, clm_line_srvc_unit_qty,
       clm_adjsmt_type_cd, oprtg_prvdr_npi_num as rndrg_prvdr_npi_num,
       atndg_prvdr_npi_num as clm_rfrg_prvdr_npi_num
from {{claim_copies}} where line_status = 'F' and (copy = 1 or (cur_clm_uniq_id % 19 = 4 and clm_line_hcpcs_cd like '99213%'))""",
    "lu_icd10": f"""
select code as ICD10, concat({_desc('code')}, more) as description
from (values ('C50911', ''), ('C3490', ''), ('C61', ''), ('C61', ', old text'), ('C439', ''), ('C189', ''), ('C189', ' (2)'),
      ('I10', '')) as t(code, more)""",
    "icd_codes": """
select code as icd_code from (values ('C50911'), ('C3490'), ('C61'), ('C439'), ('C189')) as t(code)""",
    # ---------------------------------------------------------------- alerting
    "users": """
select user_id as UserId, concat('F', cast(user_id as string)) as FirstName,
       concat('L', cast(user_id as string)) as LastName,
       concat('user', cast(user_id as string)) as UserName,
       case when user_id % 11 = 0 then 0 else 1 end as Active
from (select distinct user_id from {events}) u""",
    "staff": """select UserId as userId from {users} where UserId % 17 = 0""",
    "npis": """
select UserId as NpiId, UserId as PhysicianUserId,
       case when UserId % 15 = 0 then concat('9', cast(100000000 + UserId as string))
            when UserId % 21 = 0 then concat('1', cast(1000 + UserId as string))
            else concat('1', cast(100000000 + UserId as string)) end as NpiNum,
       case when UserId % 12 = 0 then 0 else 1 end as Active,
       case when UserId % 24 = 0 then 1 else 0 end as isMAProvider
from {users} where UserId % 3 = 0""",
    # each provider's subscribers: the users whose ids lie 0, 10, .. 40 above the provider's
    "subs": """
select n.NpiId, u.UserId
from (select NpiId, NpiId + k.more as wanted from {npis} join (values (0, 0), (0, 10), (0, 20), (0, 30), (0, 40),
        (1, 0), (1, 10), (1, 20), (1, 30), (1, 40)) as k(odd, more) on k.odd = NpiId % 2) n
join {users} u on u.UserId = n.wanted""",
    "alerts": """
select event_id as AlertId, user_id - user_id % 3 as NpiId,
       case when event_id % 50 = 0 then cast(null as bigint) else user_id * 8 + event_id % 8 end as BenId,
       ts as CreatedDate, case when event_id % 20 = 0 then 0 else 1 end as Active
from {events} where event_type = 'error'""",
    "exclusions": """
select distinct user_id * 8 as BenId from {events} where user_id % 37 = 5
union all select cast(null as bigint) as BenId""",
    # every patient, with or without alerts
    "beneficiaries": """
select user_id * 8 + k as BenId, concat('Payer ', cast(user_id % 4 as string)) as Payor, concat('M', cast(user_id * 8 + k as string)) as BeneficiaryId
from (select distinct user_id, event_id % 8 as k from {events}) e""",
    "action_logs": None,   # generated below (bucketed range join)
    "user_alerts": None,
    "alert_actions": """
select AlertActionId, Text from (values (1, 'Called patient'), (2, 'No Action Taken')) as t(AlertActionId, Text)""",
    "tin_consultant": """
select concat('T', cast(NpiId % 8 as string)) as TIN,
       case NpiId % 3 when 0 then 'Alice' when 1 then 'Bob' else 'Carol' end as Provider_Consultant,
       concat('Co', cast(NpiId % 2 as string)) as Company, NpiNum as NPI,
       case when NpiId % 4 = 0 then 1 else 0 end as multi_consultant_tin, '2024-01' as dataset
from {npis}
union all
select concat('T', cast(NpiId % 8 as string)),
       case (NpiId + 1) % 3 when 0 then 'Alice' when 1 then 'Bob' else 'Carol' end,
       concat('Co', cast(NpiId % 2 as string)), NpiNum,
       case when NpiId % 4 = 0 then 1 else 0 end, '2023-12'
from {npis}""",
    # each patient's provider, by period; every second patient was assigned a period earlier too
    "assignment": f"""
select distinct cast(a.BenId as string) as Beneficiary_ID, concat('T', {_tin('n.NpiId')}) as TIN, n.NpiNum as Npi, p.Year, p.Period
from {{alerts}} a join {{npis}} n on a.NpiId = n.NpiId
join (values (0, '2023', '04'), (0, '2024', '00'), (0, '2023', '03'), (1, '2023', '04'), (1, '2024', '00')) as p(odd, Year, Period)
  on p.odd = a.BenId % 2""",
    "assignment_flat": """
select Beneficiary_ID, TIN, Npi, Year, Period from {assignment} where Period <> '00'""",
    "master_view": f"""
select NpiNum as NPI, concat('T', {_tin('NpiId')}) as TIN, concat('Entity T', {_tin('NpiId')}) as Entity, 'ACO-2024' as ACOR,
       case when NpiId % 9 = 0 then 0 else 1 end as NPI_Approval,
       case when NpiId % 10 = 0 then 0 else 1 end as TIN_Approval
from {{npis}}
union all
select NpiNum, concat('T', {_tin('(NpiId + 1)')}), concat('Entity T', {_tin('(NpiId + 1)')}), 'ACO-2023', 1, 1
from {{npis}}""",
    "practice_mapping": None,  # generated below: one block per (metric, eligibility, dataset)
    # ---------------------------------------------------------------- care tracking
    "tracking": """
select o_orderkey as Id, o_custkey as CTBeneficiaryID,
       o_custkey * 10 + cast(substr(o_orderpriority, 1, 1) as int) as CTBeneficiaryCategoryID,
       case o_orderstatus when 'O' then 1 when 'F' then 2 else 3 end as StatusId,
       o_orderdate as CreatedDate, o_orderdate as UploadDate,
       o_orderkey % 10 as CreatedBy,
       case when o_orderkey % 7 = 0 then 1 when o_orderkey % 7 = 1 then cast(null as int) else 0 end
         as IsCustomActionTaken,
       case when o_orderkey % 5 = 0 then 0 else 1 end as IsReqforHistory,
       case when o_orderkey % 13 = 0 then cast(null as bigint) else o_orderkey % 4 end as ActionId
from {orders}""",
    "bene_category": """
select distinct o_custkey * 10 + cast(substr(o_orderpriority, 1, 1) as int) as Id,
       cast(substr(o_orderpriority, 1, 1) as int) as CategoryId from {orders}""",
    "category": """
select distinct cast(substr(o_orderpriority, 1, 1) as int) as Id, substr(o_orderpriority, 3) as CategoryCode
from {orders}""",
    "ct_status": """
select Id, Status, StatusCategory
from (values (1, 'OPEN', 'OPEN'), (2, 'COMPLETED', 'CLOSED'), (3, 'DECLINED', 'CLOSED')) as t(Id, Status, StatusCategory)""",
    "ct_actions": """
select cast(Id as bigint) as Id, ActionName
from (values (0, 'Call'), (1, 'Visit'), (2, 'Refer'), (3, 'Educate')) as t(Id, ActionName)""",
    "ct_roles": """
select RoleId, RoleName from (values (0, 'SUPERVISOR'), (1, 'PROVIDER'), (2, 'REVIEWER USER'),
       (3, 'USER'), (5, 'REPORT'), (6, 'DATA')) as t(RoleId, RoleName)""",
    "ct_user_roles": """
select distinct CreatedBy as UserId, CreatedBy % 5 as RoleId from {tracking} where CreatedBy % 5 <> 4
union all select distinct CreatedBy, 5 from {tracking} where CreatedBy = 5
union all select distinct CreatedBy, 6 from {tracking} where CreatedBy = 8""",
    "patients": """
select c.c_custkey as ID, c.c_mktsegment as Insurance,
       concat('Dr', cast(c.c_custkey % 9 as string)) as PhysicianName, s.s_suppkey as NPIId,
       case when c.c_custkey % 9 = 0 then c.c_nationkey else s.s_nationkey end as EntityId
from (select cc.*, cc.c_custkey % (select count(*) from {supplier}) as supplier_no from {customer} cc) c
join {supplier} s on s.s_suppkey = c.supplier_no""",
    "ct_subscriptions": """
select s_suppkey as NpiId, s_suppkey % 10 as UserId,
       case when s_suppkey % 4 = 0 then 0 else 1 end as ShowCareTracker from {supplier}""",
    "ct_users": """select distinct s_suppkey % 10 as UserId from {supplier}""",
    "ct_npis": """
select s.s_suppkey as NpiId, r.r_name as NpiType
from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey join {region} r on n.n_regionkey = r.r_regionkey""",
    "npi_locations": """select s_suppkey as NPIId, s_suppkey * 100 + s_nationkey as LocationId from {supplier}""",
    "locations": """select distinct s_suppkey * 100 + s_nationkey as LocationId from {supplier}""",
    "entity_locations": """
select distinct s_suppkey * 100 + s_nationkey as LocationId, s_nationkey as EntityId from {supplier}""",
    "entities": """
select n_nationkey as EntityId, n_name as EntityName,
       case when n_nationkey % 6 = 0 then 0 else 1 end as Active from {nation}""",
}


def _practice_mapping() -> str:
    """npis x 2 metrics x 2 eligibilities x 2 datasets, quarter values as text; every seventh provider
    has no readmission rate."""
    rows = [(some, metric, elig, mk + ek, dataset) for some in (0, 1)
            for metric, mk in (("30-Day Readmission Rate", 1), ("% PDV", 3)) if some or mk == 3
            for elig, ek in (("CMS", 0), ("Formulated", 2)) for dataset in ("QM-2023", "QM-2024")]
    kinds = ", ".join(f"({some}, '{metric}', '{elig}', {add}, '{dataset}')" for some, metric, elig, add, dataset in rows)
    q = [f"cast(cast((q.c{i} + k.plus) * 0.25 as decimal(10,2)) as string)" for i in range(1, 5)]
    return f"""
select concat('T', {_tin('n.NpiId')}) as TIN, n.NpiNum as NPI, k.Metric, k.Eligibility, {q[0]} as QTR1, {q[1]} as QTR2, {q[2]} as QTR3,
       case when n.NpiId % 5 = 0 then cast(null as string) else {q[3]} end as QTR4,
       k.DATASET, '2024' as year, case when n.NpiId % 6 = 0 then 'Assigned' else 'All' end as MemberSource
from {{npis}} n join {{practice_counts}} q on q.user_id = n.NpiId
join (values {kinds}) as k(rated, Metric, Eligibility, plus, DATASET) on k.rated = case when n.NpiId % 7 <> 0 then 1 else 0 end"""


ADAPTERS["practice_counts"] = """
select user_id,
       sum(case when event_id % 4 = 0 then 1 else 0 end) as c1,
       sum(case when event_id % 4 = 1 then 1 else 0 end) as c2,
       sum(case when event_id % 4 = 2 then 1 else 0 end) as c3,
       sum(case when event_id % 4 = 3 then 1 else 0 end) as c4
from {events} group by user_id"""
ADAPTERS["practice_mapping"] = _practice_mapping()

# Events joined to later events of the same user within 10 days. A range condition on
# one key would pair every event of a user with every other; instead both sides carry an
# 11-day bucket of a day number (gaps at year ends are at most one day), and each alert
# probes its own bucket and the next one by equality (two equi-joins, no duplicates).
_DAYNO = "(year({t}.ts) * 366 + dayofyear({t}.ts))"
_BUCKET = "cast(floor(" + _DAYNO + " / 11) as bigint)"


def _event_pairs(select: str, types: str) -> str:
    a_b, e_b = _BUCKET.format(t="a"), _BUCKET.format(t="e")
    blocks = []
    for k in (0, 1):
        blocks.append(f"""
select {select}
from (select a.*, {a_b} as bkt from {{events}} a where a.event_type = 'error') a
join (select e.*, {e_b} as bkt from {{events}} e where e.event_type in ({types})) e
  on a.user_id = e.user_id and e.bkt = a.bkt + {k}
where e.ts > a.ts and e.ts <= a.ts + interval 10 days and (a.event_id + e.event_id) % 3 = 0""")
    return "\nunion all".join(blocks)


def _event_pairs_once(text: str) -> str:
    """The text of ``_event_pairs`` with one join instead of two: each alert comes once for its own bucket
    and once for the next, so the other events are read and shuffled once."""
    own = text.split("\nunion all")[0]
    bucket = _BUCKET.format(t="a")
    return own.replace(f"{bucket} as bkt from {{events}} a", f"{bucket} + k.more as bkt from {{events}} a lateral view explode(array(0L, 1L)) k as more")


ADAPTERS["action_logs"] = _event_pairs("""e.event_id * 100000 + a.event_id as AlertActionLogId,
       case when e.event_type = 'click' then 1 else 2 end as AlertActionId,
       a.event_id as AlertId,
       (a.user_id - a.user_id % 3) + 10 * (e.event_id % 4) as UserId,
       e.ts as CreatedDate,
       case when e.event_id % 25 = 0 then 0 else 1 end as Active""", "'click', 'purchase'")
ADAPTERS["user_alerts"] = _event_pairs("""a.event_id as AlertId,
       (a.user_id - a.user_id % 3) + 10 * (e.event_id % 4) as UserId,
       case when e.event_id % 9 = 0 then null else e.ts end as ViewedDate""", "'view'")

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return sorted(set(_REF.findall(ADAPTERS[name])))


class Inputs:
    """Adapters of one job: ``Inputs(spark, sf_dir)['part_a']``.

    An adapter is a lazy frame over the given tables. Those that several branches of a job read
    are staged (persisted on first use), and so are joined once.
    """

    STAGED = {"npis", "alerts", "action_logs", "user_alerts", "practice_counts", "assignment", "tracking", "patients"}

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, tables: CatalogTables | None = None,
                 claims_since: str | None = None):
        """Base tables are the files of ``sf_dir``, or those of ``tables``. For a job that reads no claim
        up to the day ``claims_since``, the claim lines are built without those claims."""
        self.spark, self.sf_dir, self.tables, self.claims_since = spark, sf_dir, tables, claims_since
        self.to_files = False
        self._made: dict[str, DataFrame] = {}
        self._views: dict[str, str] = {}

    def in_files(self) -> Inputs:
        """The same tables, for a job that keeps its claim lines in files (``settle``) while it is built."""
        same = Inputs(self.spark, self.sf_dir, self.tables, self.claims_since)
        same.to_files = True
        return same

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.tables[name] if self.tables else read_table(self.spark, self.sf_dir, name)
        if name not in self._made:
            made = self._claim_base() if name == "claim_base" else self.spark.sql(
                _REF.sub(lambda m: self._view(m.group(1)), self._text(name)))
            self._made[name] = stage(made) if name in self.STAGED else made
        return self._made[name]

    @staticmethod
    def _text(name: str) -> str:
        text = ADAPTERS[name]
        if name in ("action_logs", "user_alerts"):
            return _event_pairs_once(text)
        for case, lookup in LOOKUPS.items():
            text = text.replace(case, lookup)
        return text

    def width(self, name: str) -> int:
        """Tasks of a shuffle of the base table ``name``."""
        return shuffle_width(self[name])

    def _claim_base(self) -> DataFrame:
        """The adapter's text over the same tables, parts joined before orders: the numbering of a
        claim's lines then finds them where the join by order has put them, in tasks whose number
        grows with the lines.

        What is staged are the numbered lines as numbers, half as many bytes as the columns of the text,
        which each reader derives from them for the lines that it keeps. But for ``NUMBERED`` each is taken where its
        table is read: an order's day and a part's number are derived once, and no text is shuffled. Orders are hashed, so that the
        lines are sorted once, for their numbers.

        Lines are numbered per order key, so of the claims up to ``claims_since`` only keys without any
        later order are left out.

        In files the lines are numbered in slices of the order keys, one after the other, so that the shuffles
        of one slice alone are on disk; the files are read back dealt by order key, as the blocks are."""
        width, size = self.width("lineitem"), estimated_bytes(self["lineitem"])
        if not self.to_files:
            kept, columns = self._numbered_lines(width)
            return self.spark.sql(f"{columns}\nfrom {view(stage(kept))} l")
        slices = 1 if size >= NO_ESTIMATE else max(1, -(-size // SLICE_BYTES))
        made = [self._numbered_lines(width, i, slices) for i in range(slices)]
        return self.spark.sql(f"{made[0][1]}\nfrom {view(settle([kept for kept, _ in made], width, 'l_orderkey'))} l")

    def _numbered_lines(self, width: int, turn: int = 0, slices: int = 1) -> tuple[DataFrame, str]:
        """The numbered lines of one slice of the order keys, and the text that selects the claim lines' columns of them."""
        def of_slice(df: DataFrame, key: str) -> DataFrame:
            # slices are whole tasks of the shuffle by order key
            return df if slices == 1 else df.where(F.pmod(F.hash(F.col(key).cast("bigint")), F.lit(width)) % slices == turn)

        orders = of_slice(self["orders"], "o_orderkey").repartition(width, "o_orderkey")
        if self.claims_since is not None:
            newest = F.max(F.col("o_orderdate").cast("date")).over(Window.partitionBy("o_orderkey"))
            orders = (orders.withColumn("_newest", newest)
                      .where(F.col("_newest") > F.lit(self.claims_since).cast("date")).drop("_newest"))
        tables = {"l": of_slice(self["lineitem"], "l_orderkey"), "o": orders, "p": self["part"].repartition(width, "p_partkey")}
        early = {}
        for part, (name, form, _) in STORED.items():
            alias = re.search(r"\b([lop])\.", part).group(1)
            if name not in NUMBERED:
                tables[alias] = tables[alias].withColumn(name, F.expr(form.format(part.replace(f"{alias}.", ""))))
                early[name] = f"{alias}.{name}"
        views = {"lineitem": view(tables["l"]), "orders": view(tables["o"]), "part": view(tables["p"])}
        text, by_order, by_part = ADAPTERS["claim_base"].rsplit("\njoin ", 2)
        columns, lines = text.rsplit("\nfrom ", 1)
        number = re.search(r"cast\(row_number\(\).*?as int\)", columns, re.S).group(0)
        columns = columns.replace(number, "l.line_no")
        stored = [f"{number} as line_no"]
        for part, (name, form, back) in STORED.items():
            stored.append(f"{early.get(name) or form.format(part)} as {name}")
            columns = columns.replace(part, back.format(f"l.{name}"))
        rest = sorted(set(re.findall(r"\b[lop]\.[lop]_\w+", columns)))
        hashed = "o, p" if estimated_bytes(self["part"]) > PART_BYTES else "o"
        numbered = f"select /*+ SHUFFLE_HASH({hashed}) */ {', '.join(rest + stored)}\nfrom {lines}\njoin {by_part}\njoin {by_order}"
        return self.spark.sql(_REF.sub(lambda m: views[m.group(1)], numbered)), re.sub(r"\b[op]\.([op]_)", r"l.\1", columns)

    def _view(self, name: str) -> str:
        if name not in self._views:
            self._views[name] = view(self[name])
        return self._views[name]


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the DuckDB oracle, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in TABLES or n in order:
            return
        for d in deps(n):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return ""
    parts = []
    for n in order:
        text = _REF.sub(lambda m: m.group(1), ADAPTERS[n])
        parts.append(f"{n} AS ({text}\n)")
    return "WITH " + ",\n".join(parts) + "\n"
