"""Oracle SQL for the alert-responsiveness report (DuckDB dialect)."""
from __future__ import annotations

from caresight.sources.adapters import with_clause

LOWER, UPPER = "2023-12-31", "2024-01-31"
CONSULTANTS = "('Alice', 'Bob')"

# FIXED VALUES: days after the received weekday (Monday first) that still count as three business days.
REACH = [3, 3, 5, 5, 5, 4, 3]


def _minutes(a: str, b: str) -> str:
    return f"datediff('minute', {a}, {b})"


def _reached(a: str, b: str) -> str:
    """Answered within five days, on a weekday that the received weekday reaches."""
    days = f"(isodow({b}) - isodow({a}) + 7) % 7"
    return f"({_minutes(a, b)} <= 7200 and {days} between 1 and {REACH}[isodow({a})])"


def _bucket(a: str, b: str) -> str:
    """0: within a day (over the weekend: three), 1: within three business days, 2: later."""
    quick = (f"(case when isodow({a}) <= 4 then {_minutes(a, b)} <= 1440 "
             f"else {_minutes(a, b)} <= 4320 and isodow({b}) in (5, 6, 7, 1) end)")
    return f"case when {quick} then 0 when {_reached(a, b)} then 1 else 2 end"


def _eastern(ts: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {ts}))"


def _per(what: str, kind: str) -> str:
    """Counts by best bucket: what was done (read, action), for alerts or patients."""
    title = {"alert": "Alerts", "patient": "Patients"}[kind] + {"read": "Read", "action": "Actions"}[what]
    return ", ".join(f"count(*) filter (kind = '{kind}' and what = '{what}' and bucket = {i}) as {title}{name}"
                     for i, name in enumerate(("Less24", "OneToThreeBD", "MoreThreeBD")))


FLAGS = "cast(bucket = 0 as int) as Less24, cast(bucket = 1 as int) as OneToThreeBD, cast(bucket = 2 as int) as MoreThreeBD"
SPEED = ", ".join(_per(w, k) for w in ("read", "action") for k in ("alert", "patient"))
_TITLES = [f"{k}{w}{n}" for k in ("Alerts", "Patients") for w in ("Read", "Actions") for n in ("Less24", "OneToThreeBD", "MoreThreeBD")]
_COUNTS = ["AlertsReceived", "PatientsReceived", "AlertsRead", "PatientsRead", "AlertsNotRead", "PatientsNotRead",
           "AlertsWActions", "PatientsWActions", "AlertsWNoActions", "PatientsWNoActions"]


def _both(condition: str, alerts: str, patients: str) -> str:
    return (f"count(distinct alert_id) filter ({condition}) as {alerts}, "
            f"count(distinct ben_id) filter ({condition}) as {patients}")


BODY = f"""
person as materialized (
  select UserId as user_id, FirstName as fn, LastName as ln, UserName as user_name, Active = 1 as active
  from users anti join staff on staff.userId = users.UserId),
provider as materialized (
  select NpiId as npi_id, PhysicianUserId as user_id, NpiNum as npi_num from npis
  where 1 in (Active, isMAProvider) and regexp_full_match(rtrim(NpiNum), '[0-8][0-9]{{9}}')
    and exists (select 1 from users u where u.UserId = PhysicianUserId and u.Active = 1)
    and not exists (select 1 from staff st where st.userId = PhysicianUserId)),
roster as materialized (
  select distinct pr.npi_id, pe.user_id, cast(pr.user_id = pe.user_id as int) as is_doctor, pe.fn, pe.ln, pe.user_name
  from provider pr join subs on subs.NpiId = pr.npi_id join person pe on pe.user_id = subs.UserId),
incoming as materialized (
  select AlertId as alert_id, NpiId as npi_id, BenId as ben_id, {_eastern('CreatedDate')} as recv
  from alerts where Active = 1 and BenId not in (select BenId from exclusions where BenId is not null)
    and {_eastern('CreatedDate')} between timestamp '{LOWER}' and date '{UPPER}' + interval 1 day),
deed as materialized (
  select AlertActionLogId as log_id, g.AlertActionId as kind_id, AlertId as alert_id, g.UserId as user_id, {_eastern('CreatedDate')} as done_at,
    g.AlertActionId in (select AlertActionId from alert_actions where Text like 'No Action Taken') as idle
  from action_logs g semi join person on person.user_id = g.UserId
  where Active = 1 and AlertId in (select alert_id from incoming)),
dismissed as materialized (  -- every row of the pair's alerts is a timely "no action"
  select npi_id, ben_id from incoming left join deed using (alert_id) where ben_id is not null group by all
  having bool_and(coalesce(idle and ({_minutes('recv', 'done_at')} <= 1440 or {_reached('recv', 'done_at')}), false))),
open_alert as materialized (select * from incoming anti join dismissed using (npi_id, ben_id)),
view_of as materialized (
  select AlertId as alert_id, UserId as user_id, ViewedDate as done_at from user_alerts
  where ViewedDate is not null and UserId not in (select userId from staff where userId is not null)),
first_event as materialized (
  select 'read' as what, * from open_alert join (select alert_id, user_id, min(done_at) as done_at from view_of group by all) using (alert_id)
  union all by name
  select 'action' as what, * from open_alert join (select alert_id, user_id, min(done_at) as done_at from deed where not idle group by all) using (alert_id)),
timed as materialized (
  select e.*, r.is_doctor, datediff('hour', recv, done_at) as hours, {_bucket('recv', 'done_at')} as bucket
  from first_event e join roster r using (npi_id, user_id)),
best as materialized (
  select 'alert' as kind, what, npi_id, alert_id, cast(null as bigint) as ben_id, min(bucket) as bucket from timed group by all
  union all by name
  select 'patient' as kind, what, npi_id, ben_id, min(bucket) as bucket from timed group by all),
speed as (select npi_id, {SPEED} from best group by npi_id),
engaged as (
  select npi_id, {_both('true', 'AlertsReceived', 'PatientsReceived')}, {_both('viewed', 'AlertsRead', 'PatientsRead')},
    {_both('ben_id is null', 'AlertsNotRead', 'PatientsNotRead')}, {_both('acted', 'AlertsWActions', 'PatientsWActions')},
    {_both('not acted', 'AlertsWNoActions', 'PatientsWNoActions')}
  from (select *, alert_id in (select alert_id from view_of) as viewed, alert_id in (select alert_id from deed where not idle) as acted
        from open_alert) group by npi_id),
stats as materialized (
  select distinct user_id as UserId, npi_id as NpiId, npi_num as NpiNum, user_name as UserName, concat(ln, ', ', fn) as Provider,
    {', '.join(f'coalesce({c}, 0) as {c}' for c in [*_COUNTS, *_TITLES])}
  from provider join person using (user_id) left join engaged using (npi_id) left join speed using (npi_id)),
consultant as materialized (
  select distinct TIN, Provider_Consultant as Consultant, Company, NPI, multi_consultant_tin as several from tin_consultant
  where Provider_Consultant in {CONSULTANTS} and dataset = (select max(dataset) from tin_consultant)),
by_tin as (select TIN, Consultant, Company, NPI from consultant where several = 0),
by_npi as (select TIN, Consultant, Company, NPI from consultant where several = 1),
straddle as materialized (
  select distinct Beneficiary_ID, TIN, Npi, Year, Period
  from (select *, dense_rank() over (order by concat(Year, Period) desc) as age, max(concat(Year, Period)) over () as newest from assignment)
  where age = 1 or (age = 2 and newest like '%00')),
entity_of as materialized (
  select npi_id as NpiId, TIN, Entity as EntityName from provider left join (
    select distinct NPI, TIN, Entity from master_view
    where NPI_Approval = 1 and TIN_Approval = 1 and ACOR = (select max(ACOR) from master_view)) on NPI = npi_num),
measure as materialized (
  select *, row_number() over (partition by TIN, NPI order by Metric desc, Eligibility, DATASET) as Rn from (
    select distinct TIN, NPI, Metric, {', '.join(f'cast(QTR{i} as double) as Q{i}Ptg' for i in range(1, 5))}, DATASET, Eligibility
    from practice_mapping m
    where MemberSource = 'All' and Metric in ('30-Day Readmission Rate', '% PDV') and regexp_full_match(NPI, '[0-9]+')
      and DATASET = (select max(DATASET) from practice_mapping) and year = (select max(Year) from straddle)
      and (NPI in (select NPI from by_npi) or TIN in (select TIN from by_tin))
      and exists (select 1 from straddle st where st.TIN = m.TIN and st.Npi = m.NPI
                  and case Eligibility when 'Formulated' then Period = '00' when 'CMS' then Period <> '00' end))),
quality as (
  select TIN, NPI, {', '.join(f"avg(Q{q}Ptg) filter (Rn = {n}) as Q{q}{name}Ptg" for q in range(1, 5) for n, name in ((1, 'Readm'), (2, 'PDV')))}
  from measure group by all)
"""


def _label(x: str) -> str:
    return f"coalesce(regexp_replace(printf('%.6g', {x}), 'e([+-])([0-9]{{2}})$', 'e\\10\\2'), 'N/A')"


REPORT = f"""
select UserId, NpiId, s.NpiNum, UserName as Username, Provider, o.TIN, EntityName as TINName, c.name as ProviderConsultant,
  AlertsReceived, AlertsWActions, AlertsWNoActions, AlertsActionsLess24 + AlertsActionsOneToThreeBD as AlertsWActionsUnder3BD,
  AlertsActionsLess24, AlertsActionsOneToThreeBD, AlertsActionsMoreThreeBD,
  AlertsRead, AlertsNotRead, AlertsReadLess24 + AlertsReadOneToThreeBD as AlertsReadUnder3BD,
  AlertsReadLess24, AlertsReadOneToThreeBD, AlertsReadMoreThreeBD,
  PatientsReceived, PatientsWActions, PatientsWNoActions, PatientsActionsLess24 + PatientsActionsOneToThreeBD as PatientsWActionsUnder3BD,
  PatientsActionsLess24, PatientsActionsOneToThreeBD, PatientsActionsMoreThreeBD,
  PatientsRead, PatientsNotRead, PatientsReadLess24 + PatientsReadOneToThreeBD as PatientsReadUnder3BD,
  PatientsReadLess24, PatientsReadOneToThreeBD, PatientsReadMoreThreeBD,
  {', '.join(f"{_label(f'q.Q{i}{n}Ptg')} as Q{i}{n}Ptg" for i in range(1, 5) for n in ('Readm', 'PDV'))}
from stats s join entity_of o using (NpiId) left join quality q on q.NPI = s.NpiNum and q.TIN = o.TIN
  join lateral (  -- a TIN that several consultants share is looked up by provider; one row per entry
    select Consultant as name from by_npi where by_npi.NPI = s.NpiNum and o.TIN in (select TIN from by_npi)
    union all by name
    select t.Consultant as name from by_tin t where t.TIN = o.TIN and o.TIN not in (select TIN from by_npi)) c on true
order by PatientsReceived desc"""

_W = with_clause("beneficiaries", "users", "staff", "npis", "subs", "alerts", "exclusions", "action_logs", "user_alerts",
                 "alert_actions", "tin_consultant", "assignment", "master_view", "practice_mapping")


def q(tail: str) -> str:
    return _W + "," + BODY + tail


_ALERT = "alert_id as AlertId, npi_id as NpiId, ben_id as BenId"
_TOTALS = ", ".join(f"cast(count(*) filter (bucket = {i}) as bigint) as AlertsActions{n}" for i, n in enumerate(("Less24", "OneToThreeBD", "MoreThreeBD")))
_WITH_QUALITY = "stats s join entity_of o using (NpiId) join quality q on q.NPI = s.NpiNum and q.TIN = o.TIN"

SQL = {
    "provider_roster": q("select npi_id as NpiId, user_id as UserId, is_doctor as IsDoctor, fn as FN, ln as LN, user_name as UserName from roster"),
    "alerts_in_window": q(f"select {_ALERT}, recv as DateReceived from incoming"),
    "alert_actions": q("""select log_id as AlertActionLogId, kind_id as AlertActionId, alert_id as AlertId, user_id as UserId,
        done_at as CreatedDate from deed where not idle"""),
    "no_action_exclusion": q("select npi_id as NpiId, ben_id as BenId from dismissed"),
    "alerts_kept": q(f"select {_ALERT}, recv as DateReceived from open_alert"),
    "alert_beneficiaries": q("select * from beneficiaries semi join (select ben_id as BenId from incoming) i using (BenId)"),
    "first_read_converted": q(f"""select {_ALERT}, user_id as UserId, recv as DateReceived, {_eastern('done_at')} as DateRead
        from first_event where what = 'read'"""),
    "first_read_per_user": q(f"select {_ALERT}, user_id as UserId, recv as DateReceived, done_at as DateRead from first_event where what = 'read'"),
    "response_buckets": q(f"""select {_ALERT}, user_id as UserId, is_doctor as IsDoctor, recv as DateReceived, done_at as DateAction,
        hours as HoursLapsed, {FLAGS} from timed where what = 'action'"""),
    "best_bucket_alert": q(f"select alert_id as AlertId, npi_id as NpiId, {FLAGS} from best where kind = 'alert' and what = 'read'"),
    "best_bucket_patient": q(f"select ben_id as BenId, npi_id as NpiId, {FLAGS} from best where kind = 'patient' and what = 'action'"),
    "bucket_totals": q(f"select npi_id as NpiId, {_TOTALS} from best where kind = 'alert' and what = 'action' group by npi_id"),
    "engagement_counts": q(f"select NpiId, {', '.join(_COUNTS)} from stats"),
    "alerts_not_read": q(f"select npi_id as NpiId, {_both('true', 'AlertsNotRead', 'PatientsNotRead')} from open_alert anti join view_of using (alert_id) group by npi_id"),
    "not_read_as_written": q("select npi_id as NpiId, AlertsNotRead, PatientsNotRead from engaged where AlertsNotRead > 0"),
    "alert_statistics": q("select * from stats"),
    "consultant_maps": q("select case several when 0 then 'tin' else 'npi' end as kind, TIN, Consultant, Company, NPI from consultant"),
    "provider_entity_lookup": q("select * from entity_of"),
    "straddle_snapshot": q("select * from straddle"),
    "quality_pivot": q("select * from quality"),
    "positional_pivot": q("select * from measure"),
    "alert_report": q(REPORT),
    "response_share": q("""select NpiId, AlertsWActions, AlertsActionsLess24,
        (20000 * AlertsActionsLess24 + AlertsWActions) // (2 * AlertsWActions) as pct_within_24h_x100,
        (20000 * (AlertsWActions - AlertsActionsLess24) + AlertsWActions) // (2 * AlertsWActions) as pct_delayed_x100
        from stats where AlertsWActions > 0"""),
    "engagement_vs_quality": q(f"select NpiId, o.TIN, AlertsReceived, AlertsWActions, AlertsActionsLess24, Q1ReadmPtg, Q1PDVPtg from {_WITH_QUALITY}"),
    "engagement_quality_corr": q(f"""select count(*) as providers, {', '.join(
        f"round(nullif(corr(cast(AlertsActionsLess24 as double), Q1{n}Ptg), 'nan'), 6) as corr_timely_{t}" for n, t in (("Readm", "readmission"), ("PDV", "pdv")))} from {_WITH_QUALITY}"""),
}
