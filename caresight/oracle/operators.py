"""Oracle SQL for the operator-level keys (DuckDB dialect)."""
from __future__ import annotations

from caresight.functions.codes import LINE_CODES, MODALITY_CODES, STAGE_CODES, BODY_AREA_CODES, TREATMENT_CODES
from caresight.oracle.alerts import BODY as ALERT_BODY, FLAGS as ALERT_FLAGS, _W as ALERT_W
from caresight.oracle.oncology import PIPELINE as ONC_PIPELINE, _W as ONC_W, _case, _in
from caresight.sources.adapters import with_clause
from caresight.sources.tables import TABLES

CANCER = "('C50911', 'C3490', 'C61', 'C439', 'C189')"
PB_CODES = ["clm_line_dgns_cd", "clm_dgns_1_cd", "clm_dgns_2_cd", "clm_dgns_3_cd", "clm_dgns_4_cd", "clm_dgns_5_cd"]
PB_DESCS = ["clm_line_dgns", "clm_dgns_1", "clm_dgns_2_", "clm_dgns3", "clm_dgns_4", "clm_dgns_5"]


def w(*names: str) -> str:
    return with_clause(*names)


def onc(tail: str) -> str:
    return ONC_W + "," + ONC_PIPELINE + tail


def alerts(tail: str) -> str:
    return ALERT_W + "," + ALERT_BODY + tail


_FIRST_CODE = "case " + " ".join(f"when {c} in {CANCER} then {c}" for c in PB_CODES) + " end"
_FIRST_DESC = "case " + " ".join(f"when {c} in {CANCER} then {d}" for c, d in zip(PB_CODES, PB_DESCS)) + " end"

_SPLIT_SRC = """concat(p_name, ',', p_brand, ',', case when p_size % 3 = 0 then '' else p_type end,
                case when p_size % 4 = 0 then ',' else '' end)"""
_SSPLIT_SRC = """concat(c_mktsegment, ';', case when c_custkey % 4 = 0 then '' else c_name end,
                 case when c_custkey % 6 = 0 then ';' else '' end)"""

SQL = {
    # ---------------------------------------------------------------- sources
    "scan_sources": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}"
        for t in TABLES),
    "claims_extract": w("part_a") + """select beneficiary_id, cur_clm_uniq_id, clm_line_num, clm_from_dt,
        trim(clm_line_hcpcs_cd) as clm_line_hcpcs_cd, clm_line_pmt_amnt from part_a where clm_from_dt > date '1997-01-01'""",
    "cohort_roundtrip": onc("select beneficiary_id from patient"),
    "report_sink": onc("""select body_area, cast(sum(clm_line_pmt_amnt) as decimal(38,2)) as total_cost,
        count(distinct beneficiary_id) as distinct_patients,
        cast(sum(case when treatment_process = '4-Radiation' then 1 else 0 end) as bigint) as treatment_deliveries
        from billed where oprtg_prvdr_npi_num = '7' group by body_area"""),
    "latest_snapshot": w("master_view") + """select NPI, TIN, Entity, ACOR from master_view
        where ACOR = (select max(ACOR) from master_view)""",
    "straddle_snapshot_flat": w("assignment_flat") + """select distinct Beneficiary_ID, TIN, Npi, Year, Period from (
        select *, dense_rank() over (order by concat(Year, Period) desc) as age, max(concat(Year, Period)) over () as newest
        from assignment_flat) where age = 1 or (age = 2 and newest like '%00')""",
    "top_n_distinct": w("assignment") + """select dataset as value from (select distinct concat(Year, Period) as dataset
        from assignment) d order by dataset desc limit 2""",
    # ---------------------------------------------------------------- projections and predicates
    "project_claims": w("part_a") + """select 'PartA' as source, beneficiary_id as patient_id, cur_clm_uniq_id,
        clm_line_num, trim(clm_line_hcpcs_cd) as procedure_code,
        clm_header_pmt_amnt - clm_line_pmt_amnt as amount_gap from part_a""",
    "classify_stage": w("part_a") + f"""select cur_clm_uniq_id, clm_line_num, trim(clm_line_hcpcs_cd) as clm_line_hcpcs_cd,
        {_case('trim(clm_line_hcpcs_cd)', STAGE_CODES)} as treatment_process from part_a""",
    "classify_body_area": w("part_b") + f"""select cur_clm_uniq_id, clm_line_num, clm_line_dgns_cd,
        {_case('clm_line_dgns_cd', BODY_AREA_CODES)} as body_area from part_b""",
    "classify_modality": w("part_b") + f"""select cur_clm_uniq_id, clm_line_num, trim(clm_line_hcpcs_cd) as clm_line_hcpcs_cd,
        {_case('trim(clm_line_hcpcs_cd)', MODALITY_CODES)} as treatment_type from part_b""",
    "filter_code_set": w("part_b") + f"""select cur_clm_uniq_id, clm_line_num from part_b
        where trim(clm_line_hcpcs_cd) in {_in(LINE_CODES)}""",
    "first_matching_diagnosis": w("part_b") + f"""select cur_clm_uniq_id, clm_line_num, {_FIRST_CODE} as clm_dgns_cd,
        {_FIRST_DESC} as description from part_b where {_FIRST_CODE} is not null""",
    "any_column_in_set": w("part_b") + "select cur_clm_uniq_id, clm_line_num, case when " + " or ".join(
        f"{c} in {CANCER}" for c in PB_CODES) + " then 1 else 0 end as any_cancer from part_b",
    "sentinel_fallback": w("part_a") + """select cur_clm_uniq_id, clm_line_num, oprtg_prvdr_npi_num as raw_npi,
        case when oprtg_prvdr_npi_num is null or rtrim(oprtg_prvdr_npi_num) in ('', '~') then atndg_prvdr_npi_num
             else oprtg_prvdr_npi_num end as resolved_npi from part_a""",
    "signed_payment": w("part_a") + """select cur_clm_uniq_id, clm_line_num, clm_adjsmt_type_cd,
        case when clm_adjsmt_type_cd = '1' then -clm_line_pmt_amnt else clm_line_pmt_amnt end as signed_amount from part_a""",
    "exclude_type": w("part_a") + "select cur_clm_uniq_id, clm_line_num from part_a where clm_type_cd <> '50'",
    "null_and_range_predicates": w("part_a") + """select cur_clm_uniq_id, clm_line_num from part_a
        where oprtg_prvdr_npi_num is not null and clm_line_srvc_unit_qty between 10 and 30
          and clm_line_pmt_amnt >= 30000 and clm_adjsmt_type_cd = '1'""",
    "valid_npi": w("npis") + """select NpiId, NpiNum,
        case when length(NpiNum) = 10 and regexp_matches(NpiNum, '^[0-9]+$') and NpiNum not like '9%' then 1 else 0 end
          as is_valid from npis""",
    "like_predicates": w("npis", "alert_actions") + """select 'npi' as kind, cast(NpiId as varchar) as id from npis
        where NpiNum not like '9%' union all select 'action', cast(AlertActionId as varchar) from alert_actions
        where Text like 'No Action Taken'""",
    # ---------------------------------------------------------------- joins
    "inner_join": alerts("select alert_id as AlertId, npi_id as NpiId, UserId, ViewedDate from incoming join user_alerts on AlertId = alert_id"),
    "left_join": alerts("select distinct npi_id as NpiId, UserId from provider left join (select * from subs where UserId not in (select userId from staff)) on NpiId = npi_id"),
    "left_join_filtered": alerts("select npi_id as NpiId, user_id as UserId from roster"),
    "anti_join": alerts("select user_id as UserId from person"),
    "not_in_null_aware": w("alerts", "exclusions") + """select AlertId, BenId from alerts
        where BenId not in (select BenId from exclusions where BenId is not null)""",
    "semi_join_in": w("patients", "tracking") + """select ID from patients
        where ID in (select CTBeneficiaryID from tracking where StatusId = 3)""",
    "semi_join_either": alerts("""select distinct TIN, NPI, Metric, Eligibility, DATASET from practice_mapping
        where exists (select 1 from by_npi b where b.NPI = practice_mapping.NPI) or exists (select 1 from by_tin b where b.TIN = practice_mapping.TIN)"""),
    "attach_group": onc("select pta, cur_clm_uniq_id, clm_line_num, treatment_group from course_line"),
    "wide_metric_assembly": alerts("select * from stats"),
    "precedence_lookup": alerts("""select NpiId, o.TIN, coalesce(c.name, 'no consultant') as ProviderConsultant
        from stats s join entity_of o using (NpiId) left join lateral (
          select Consultant as name from by_npi where by_npi.NPI = s.NpiNum and o.TIN in (select TIN from by_npi)
          union all by name
          select t.Consultant as name from by_tin t where t.TIN = o.TIN and o.TIN not in (select TIN from by_npi)) c on true"""),
    "composite_join": alerts("select alert_id as AlertId, user_id as UserId, npi_id as NpiId from first_event semi join roster using (user_id, npi_id) where what = 'read'"),
    # ---------------------------------------------------------------- aggregates
    "count_rows_left": alerts("select ben_id as BenId, npi_id as NpiId, count(*) as TotalActionsPerPatient from incoming left join deed using (alert_id) group by ben_id, npi_id"),
    "multi_count_distinct": w("part_a") + """select atndg_prvdr_npi_num, count(distinct beneficiary_id) as patients,
        count(distinct cur_clm_uniq_id) as claims, count(distinct trim(clm_line_hcpcs_cd)) as procedures
        from part_a group by atndg_prvdr_npi_num""",
    "sum_by_key": w("part_a") + """select beneficiary_id, cast(sum(clm_line_pmt_amnt) as decimal(38,2)) as total_paid
        from part_a group by beneficiary_id""",
    "conditional_sum": w("part_a") + """select atndg_prvdr_npi_num,
        cast(sum(case when clm_adjsmt_type_cd = '1' then 1 else 0 end) as bigint) as adjustment_lines,
        cast(sum(case when clm_type_cd = '50' then 1 else 0 end) as bigint) as type50_lines
        from part_a group by atndg_prvdr_npi_num""",
    "conditional_avg_pivot": alerts("""select TIN, NPI,
        avg(case when Metric = '30-Day Readmission Rate' then Q1Ptg end) as Q1ReadmPtg,
        avg(case when Metric = '% PDV' then Q1Ptg end) as Q1PDVPtg,
        avg(case when Metric = '30-Day Readmission Rate' then Q2Ptg end) as Q2ReadmPtg,
        avg(case when Metric = '% PDV' then Q2Ptg end) as Q2PDVPtg,
        avg(case when Metric = '30-Day Readmission Rate' then Q3Ptg end) as Q3ReadmPtg,
        avg(case when Metric = '% PDV' then Q3Ptg end) as Q3PDVPtg,
        avg(case when Metric = '30-Day Readmission Rate' then Q4Ptg end) as Q4ReadmPtg,
        avg(case when Metric = '% PDV' then Q4Ptg end) as Q4PDVPtg
        from measure group by TIN, NPI"""),
    "distinct_rows": w("part_a") + "select distinct beneficiary_id, atndg_prvdr_npi_num from part_a",
    "group_by_dedupe": w("tracking") + "select CTBeneficiaryID, StatusId from tracking group by CTBeneficiaryID, StatusId",
    # ---------------------------------------------------------------- windows, sorts, sets
    "first_per_key": w("cclf4") + f"""select cur_clm_uniq_id, clm_val_sqnc_num, clm_dgns_cd from (
        select *, row_number() over (partition by cur_clm_uniq_id order by clm_val_sqnc_num, clm_dgns_cd) as rn
        from cclf4 where clm_dgns_cd in {CANCER}) x where rn = 1""",
    "best_bucket": alerts(f"select ben_id as BenId, npi_id as NpiId, {ALERT_FLAGS} from best where kind = 'patient' and what = 'read'"),
    "sorted_report": onc("""select treatment_process, cast(sum(clm_line_pmt_amnt) as decimal(38,2)) as total_cost,
        count(*) as line_count from billed group by treatment_process order by total_cost desc, treatment_process"""),
    "union_distinct": w("part_a", "part_b") + f"""select beneficiary_id from part_a where trim(clm_line_hcpcs_cd) in {_in(TREATMENT_CODES)}
        union select beneficiary_id from part_b where trim(clm_line_hcpcs_cd) in {_in(TREATMENT_CODES)}""",
    # ---------------------------------------------------------------- scalars
    "string_scalars": w("part_a") + """select cur_clm_uniq_id, clm_line_num,
        trim(clm_line_hcpcs_cd) as code_trimmed, instr(oprtg_prvdr_npi_num, '~') as tilde_pos,
        left(atndg_prvdr_npi_num, 2) as npi_head, right(atndg_prvdr_npi_num, 2) as npi_tail,
        length(rtrim(oprtg_prvdr_npi_num)) as npi_len,
        oprtg_prvdr_npi_num || '-' || atndg_prvdr_npi_num as plus_joined,
        concat(oprtg_prvdr_npi_num, '-', atndg_prvdr_npi_num) as concat_joined from part_a""",
    "null_scalars": w("part_a") + """select cur_clm_uniq_id, clm_line_num,
        coalesce(oprtg_prvdr_npi_num, othr_prvdr_npi_num, atndg_prvdr_npi_num) as first_npi,
        case when clm_type_cd = '50' then 'inpatient'
             when clm_adjsmt_type_cd = '1' then case when clm_line_srvc_unit_qty > 25 then 'big adjustment' else 'adjustment' end
             else 'regular' end as line_kind from part_a""",
    "date_diff_units": w("alerts", "action_logs") + """select l.AlertActionLogId,
        datediff('day', a.CreatedDate, l.CreatedDate) as days, datediff('hour', a.CreatedDate, l.CreatedDate) as hours,
        datediff('minute', a.CreatedDate, l.CreatedDate) as minutes
        from action_logs l join alerts a on l.AlertId = a.AlertId""",
    "date_scalars": w("tracking") + """select Id, CreatedDate + interval 1 day as next_day, dayname(CreatedDate) as weekday_name,
        isodow(CreatedDate) - 1 as weekday_mon0 from tracking""",
    "utc_to_eastern": w("alerts") + """select AlertId, CreatedDate,
        (CreatedDate at time zone 'UTC') at time zone 'America/New_York' as eastern from alerts""",
    "cast_scalars": w("practice_mapping", "tracking") + """select 'pm' as src, concat(TIN, NPI, Metric, Eligibility, DATASET) as k,
        cast(QTR1 as double) as as_float, cast(cast(QTR1 as double) as decimal(10,2)) as as_decimal, cast(null as date) as as_date
        from practice_mapping
        union all select 'tr', cast(Id as varchar), cast(Id as double), cast(Id % 1000 as decimal(10,2)), cast(CreatedDate as date)
        from tracking""",
    "arith_scalars": w("part_a") + """select cur_clm_uniq_id, clm_line_num, clm_line_pmt_amnt * 2 as doubled,
        -clm_line_pmt_amnt as negated, clm_header_pmt_amnt - clm_line_pmt_amnt as gap,
        clm_line_srvc_unit_qty + 1 as qty_plus_one, clm_line_srvc_unit_qty * clm_line_srvc_unit_qty as qty_squared from part_a""",
    "float_label": w("practice_mapping") + """select concat(TIN, NPI, Metric, Eligibility, DATASET) as k,
        coalesce(regexp_replace(printf('%.6g', cast(QTR4 as double) / 3), 'e([+-])([0-9]{2})$', 'e\\10\\2'), 'N/A') as label
        from practice_mapping""",
    # ---------------------------------------------------------------- parameter splitting
    "split_param": w("part") + f"""select p_partkey, i as ordinal, left(l[i], 30) as Param from (
        select p_partkey, case when s like '%,' then list_slice(string_split(s, ','), 1, len(string_split(s, ',')) - 1)
                               else string_split(s, ',') end as l
        from (select p_partkey, rtrim({_SPLIT_SRC}) as s from part) x) y, generate_series(1, len(l)) as g(i)""",
    "string_split": w("customer") + f"""select c_custkey, unnest(string_split({_SSPLIT_SRC}, ';')) as value from customer""",
    "split_join": w("patients") + """select ID, Insurance from patients
        where Insurance in (select trim(unnest(string_split('AUTOMOBILE;  BUILDING ;MACHINERY', ';'))))""",
}

# The splitters called from SQL text give what their DataFrame forms give.
SQL |= {f"{name}_sql": SQL[name] for name in ("split_param", "string_split", "split_join")}
