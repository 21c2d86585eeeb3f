"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Each entry rebuilds its inputs from the test tables in ``sf_dir`` through the adapters and
runs one operator or report on the whole tables. ``ORACLE[name]`` holds the matching
DuckDB SQL (absent for operators checked only by row count).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresight.oracle.oncology import SINCE as ONC_SINCE, SQL as ONC_SQL
from caresight.plans import oncology as onc
from caresight.sources.adapters import Inputs
from caresight.sources.tables import owned_by

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: owned_by(fn, spark, sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ oncology report

def _onc(spark: SparkSession, sf_dir: str, columns: list[str] | None = onc.REPORT_COLS) -> onc.OncologyJob:
    inputs = Inputs(spark, sf_dir, claims_since=ONC_SINCE)
    return onc.OncologyJob(inputs, ONC_SINCE, inputs.width("lineitem"), columns)


def _cost(spark: SparkSession, sf_dir: str) -> onc.OncologyJob:
    """The job of the cost reports alone: few columns, steps before the course pass in files."""
    inputs = Inputs(spark, sf_dir, claims_since=ONC_SINCE)
    return onc.OncologyJob(inputs, ONC_SINCE, inputs.width("lineitem"), onc.REPORT_COLS, onc.COST_COLS)


def _onc_query(name: str, build: Callable[[onc.OncologyJob], DataFrame], columns: list[str] | None = onc.REPORT_COLS) -> None:
    register(name, ONC_SQL.get(name))(lambda spark, sf_dir: build(_onc(spark, sf_dir, columns)))


_LINE_KEY = ["cur_clm_uniq_id", "clm_line_num", "beneficiary_id"]

_onc_query("oncology_cohort", lambda j: j.cohort)
_onc_query("part_a_lines", lambda j: j.a_lines.select(
    *_LINE_KEY, "clm_line_hcpcs_cd", "clm_val_sqnc_num", "clm_dgns_cd", "description",
    "treatment_process", "body_area"))
_onc_query("part_b_lines", lambda j: j.b_lines.select(
    *_LINE_KEY, "clm_line_hcpcs_cd", "clm_dgns_cd", "description", "treatment_process", "body_area"))
_onc_query("filtered_claims", lambda j: j.filtered, None)
_onc_query("union_all_tagged", lambda j: j.combined, None)
_onc_query("treatment_groups", lambda j: j.grouped.select(
    "pta", *_LINE_KEY, "clm_line_from_dt", "treatment_process", "treatment_group"), onc.COURSE_COLS)
_onc_query("oncology_final", lambda j: j.final)
_onc_query("oncology_detail", lambda j: onc.detail(j.final))
_onc_query("cost_by_body_area", lambda j: onc.cost_by_body_area(j.final, "7"))
_onc_query("cost_by_area_modality", lambda j: onc.cost_by_area_modality(j.final, "3"))
@register("cost_by_area_modality_sql", ONC_SQL["cost_by_area_modality"])
def _cost_by_area_modality_sql(spark, sf_dir):
    from caresight.functions.sql import create_reports
    create_reports(spark, _cost(spark, sf_dir))
    return spark.sql("SELECT * FROM cost_by_area_modality('3')")


_onc_query("sessions_per_course", lambda j: onc.sessions_per_course(j.final))
_onc_query("cost_by_phase", lambda j: onc.cost_by_phase(j.final))


def _sims(j: onc.OncologyJob) -> DataFrame:
    from caresight.operators.scans import global_sequence
    sims = j.filtered.where(F.col("treatment_process") == onc.SIMULATION)
    return global_sequence(sims, ["beneficiary_id", "clm_line_from_dt", "cur_clm_uniq_id", "clm_line_num"],
                           out="treatment_group", num_partitions=j.width).select(*_LINE_KEY, "clm_line_from_dt", "treatment_group")


_onc_query("global_sequence", _sims, onc.COURSE_COLS)
_onc_query("nearest_within_window", lambda j: j.filtered.where(
    F.col("treatment_process") == onc.CONSULT).select(*_LINE_KEY, "clm_line_from_dt"), onc.COURSE_COLS)
def _asof(j: onc.OncologyJob, direction: str) -> DataFrame:
    """The generic as-of operator on its own: lines against numbered simulation anchors."""
    from caresight.operators.scans import asof_join
    anchors = _sims(j).select("beneficiary_id", F.col("clm_line_from_dt").alias("sim_date"), "treatment_group")
    proc = F.col("treatment_process")
    rows = j.filtered.where(proc == onc.CONSULT if direction == "forward"
                            else ~proc.isin(onc.CONSULT, onc.SIMULATION)).select(*_LINE_KEY, "clm_line_from_dt")
    return asof_join(rows, anchors, ["beneficiary_id"], "clm_line_from_dt", "sim_date", ["treatment_group"],
                     direction, tie_break=["treatment_group"], num_partitions=j.width).drop("sim_date")


_onc_query("asof_forward", lambda j: _asof(j, "forward"), onc.COURSE_COLS)
_onc_query("asof_backward", lambda j: _asof(j, "backward"), onc.COURSE_COLS)


def _priority(j: onc.OncologyJob) -> DataFrame:
    from caresight.functions.codes import MODALITY_PRIORITY, OTHER_MODALITY_RANK
    from caresight.operators.windows import priority_label
    return priority_label(j.grouped.where(F.col("treatment_group").isNotNull()), "treatment_group",
                          "treatment_type", MODALITY_PRIORITY, OTHER_MODALITY_RANK)


_onc_query("priority_label", _priority, onc.COURSE_COLS)


# ------------------------------------------------------------------ alert report

from caresight.oracle.alerts import SQL as ALERT_SQL  # noqa: E402
from caresight.plans.alerts import AlertReport  # noqa: E402
from caresight.operators.windows import best_flags  # noqa: E402


def _alerts(spark: SparkSession, sf_dir: str) -> AlertReport:
    return AlertReport(Inputs(spark, sf_dir), "2023-12-31", "2024-01-31", ["Alice", "Bob"])


def _alert_query(name: str, build: Callable[[AlertReport], DataFrame]) -> None:
    register(name, ALERT_SQL.get(name))(lambda spark, sf_dir: build(_alerts(spark, sf_dir)))


_alert_query("provider_roster", lambda r: r.doc_sub_info)
_alert_query("alerts_in_window", lambda r: r.alerts)
_alert_query("alert_actions", lambda r: r.actions)
_alert_query("no_action_exclusion", lambda r: r.no_action_pairs)
_alert_query("alerts_kept", lambda r: r.kept)
_alert_query("first_read_per_user", lambda r: r.first_reads)
_alert_query("response_buckets", lambda r: r.action_timings.select(
    "AlertId", "NpiId", "BenId", "UserId", "IsDoctor", "DateReceived", "DateAction", "HoursLapsed",
    "Less24", "OneToThreeBD", "MoreThreeBD"))
_alert_query("best_bucket_alert", lambda r: best_flags(r.read_timings, ["AlertId", "NpiId"], AlertReport.FLAGS))
_alert_query("best_bucket_patient", lambda r: best_flags(r.action_timings, ["BenId", "NpiId"], AlertReport.FLAGS))
_alert_query("bucket_totals", lambda r: r.bucket_totals[2])
_alert_query("engagement_counts", lambda r: r.statistics.select(
    "NpiId", "AlertsReceived", "PatientsReceived", "AlertsRead", "PatientsRead", "AlertsNotRead",
    "PatientsNotRead", "AlertsWActions", "AlertsWNoActions", "PatientsWActions", "PatientsWNoActions"))
_alert_query("alert_beneficiaries", lambda r: r.beneficiaries)
register("first_read_converted", ALERT_SQL["first_read_converted"])(
    lambda spark, sf_dir: AlertReport(Inputs(spark, sf_dir), "2023-12-31", "2024-01-31", ["Alice", "Bob"], convert_views=True).first_reads)
_alert_query("alerts_not_read", lambda r: r.alerts_not_read)
_alert_query("not_read_as_written", lambda r: r.not_read_as_written)
_alert_query("alert_statistics", lambda r: r.statistics)
_alert_query("consultant_maps", lambda r: r.tin_map.select(F.lit("tin").alias("kind"), "*").unionByName(
    r.npi_map.select(F.lit("npi").alias("kind"), "*")))
_alert_query("provider_entity_lookup", lambda r: r.entity_map)
_alert_query("straddle_snapshot", lambda r: r.straddle)
_alert_query("quality_pivot", lambda r: r.quality_table)
_alert_query("positional_pivot", lambda r: r.quality_metrics.withColumn("Rn", F.col("Rn").cast("long")))
_alert_query("alert_report", lambda r: r.report)
_alert_query("response_share", lambda r: r.response_share)
_alert_query("engagement_vs_quality", lambda r: r.engagement_vs_quality)
_alert_query("engagement_quality_corr", lambda r: r.engagement_quality_corr)


# ------------------------------------------------------------------ action completion

from caresight.oracle.actions import SQL as ACTION_SQL  # noqa: E402
from caresight.plans import actions as act  # noqa: E402
from caresight.operators.filters import in_window, optional_in  # noqa: E402
from caresight.functions.scalars import bit, flag_off  # noqa: E402

_BASE = dict(login=2)
_FILTERED = dict(login=5, payer="AUTOMOBILE;BUILDING;MACHINERY", category="URGENT;HIGH;LOW",
                 npi_type="AMERICA;EUROPE;ASIA;AFRICA")
_SELECTED = dict(login=3, selected=[1, 4, 7],
                 practice="GERMANY;FRANCE;CHINA;BRAZIL;CANADA;JAPAN;INDIA;KENYA")


def _act(spark: SparkSession, sf_dir: str, **params) -> act.ActionCompletion:
    return act.ActionCompletion(Inputs(spark, sf_dir), act.ActionParams(**params))


def _act_query(name: str, build: Callable[[act.ActionCompletion], DataFrame], params=None) -> None:
    p = params or _BASE
    register(name, ACTION_SQL.get(name))(lambda spark, sf_dir: build(_act(spark, sf_dir, **p)))


_act_query("action_completion", lambda a: a.result)
_act_query("action_completion_filtered", lambda a: a.result, _FILTERED)
_act_query("action_completion_selected", lambda a: a.result, _SELECTED)
_act_query("eligible_patients", lambda a: a.eligible)
_act_query("completed_by_status", lambda a: a.completed.select(
    "Status", "Id", F.col("ActionsCount").cast("long").alias("ActionsCount"),
    F.col("TotalActions").cast("long").alias("TotalActions")))
_act_query("grand_total_window", lambda a: a.completed.select(
    "Status", "Id", F.col("ActionsCount").cast("long").alias("ActionsCount"),
    F.col("TotalActions").cast("long").alias("TotalActions")), _FILTERED)
_act_query("total_available", lambda a: a.tracking.sparkSession.range(1).select(
    a.total_available.cast("long").alias("total_available")))
_act_query("aggregated_by_status", lambda a: a.aggregated_by_status)
_act_query("total_row", lambda a: a.aggregated_with_total)
_act_query("two_level_count", lambda a: a.status_row_count)
_act_query("count_by_category_status", lambda a: a.counts_by_category_status)
_act_query("rank_latest_ties", lambda a: a.open_latest.select(
    "CTBeneficiaryID", "CTBeneficiaryCategoryID", "Id", "CreatedDate"))
_act_query("percent_of_total", lambda a: a.result.where(~F.col("category").startswith("Total")).select(
    "category", "total_action", "total_act_percentage"))
_act_query("resolve_role", lambda a: act.role_tiers(a.inp["ct_user_roles"], a.inp["ct_roles"]))
_act_query("role_scope", lambda a: a.tracking.where(
    act.role_scope(F.col("CreatedBy"), a.role, a.p.login, [])).select("Id", "CreatedBy"))
_act_query("role_scope_strict", lambda a: a._scoped(a.tracking).select("Id", "CreatedBy"), dict(login=7, strict=True))
_act_query("exists_chain", lambda a: a.patients.select("ID"), dict(login=0))
_act_query("optional_multi_filter", lambda a: optional_in(
    a.inp["patients"], "Insurance", "AUTOMOBILE;BUILDING;MACHINERY".split(";")).select("ID", "Insurance"))
_act_query("default_date_range", lambda a: a.tracking.sparkSession.range(1).select(
    a.start.alias("start_date"), a.end.alias("end_date")))
_act_query("nullable_flag", lambda a: a.tracking.where(flag_off("IsCustomActionTaken")).select("Id"))
_act_query("date_window_variants", lambda a: a.tracking.select(
    "Id", *[bit(in_window("CreatedDate", "1996-03-01", "1998-06-30", m)).alias(m)
            for m in ("date_le", "date_between", "ts_next_day", "ts_at_most_next_day")]))


# ------------------------------------------------------------------ operator-level keys

from caresight.oracle.operators import SQL as OP_SQL  # noqa: E402
from caresight.functions import codes  # noqa: E402
from caresight.functions.params import split_param, string_split  # noqa: E402
from caresight.functions.sql import create_splitters  # noqa: E402
from caresight.functions.scalars import (boundary_diff, charindex, fallback, float_label, plus_concat,  # noqa: E402
                                         signed_amount, tsql_concat, tsql_len, utc_to_eastern, valid_npi,
                                         weekday_mon0, weekday_name)
from caresight.operators import filters as flt, joins as jn, windows as win  # noqa: E402
from caresight.operators.aggregates import count_if  # noqa: E402
from caresight.operators.snapshots import latest_snapshot, straddle_snapshots, top_n_distinct  # noqa: E402
from caresight.sources import tables as src  # noqa: E402


def op(name: str):
    return register(name, OP_SQL.get(name))


def _inp(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(spark, sf_dir)


_KEY = ["cur_clm_uniq_id", "clm_line_num"]


@op("scan_sources")
def _scan_sources(spark, sf_dir):
    dfs = src.load(spark, sf_dir)
    parts = [df.select(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in dfs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@op("claims_extract")
def _claims_extract(spark, sf_dir):
    return src.extract_claims(_inp(spark, sf_dir)["part_a"], since="1997-01-01",
                              cols=["beneficiary_id", "cur_clm_uniq_id", "clm_line_num", "clm_from_dt",
                                    "clm_line_hcpcs_cd", "clm_line_pmt_amnt"])


@op("cohort_roundtrip")
def _cohort_roundtrip(spark, sf_dir):
    import uuid
    from caresight.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return src.save_cohort(_onc(spark, sf_dir).cohort, f"{base}/cohort-{uuid.uuid4().hex}")


@op("report_sink")
def _report_sink(spark, sf_dir):
    import uuid
    from caresight.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/report-{uuid.uuid4().hex}"
    src.write_report(onc.cost_by_body_area(_cost(spark, sf_dir).final, "7"), path)
    return spark.read.parquet(path)


@register("published_report", ONC_SQL["cost_by_body_area"])
def _published_report(spark, sf_dir):
    """Published under its captions over a former result, and read back by column position."""
    path = src.scratch_folder(spark, "published")
    report = onc.cost_by_body_area(_cost(spark, sf_dir).final, "7")
    src.publish_report(report.limit(0), path, onc.BODY_AREA_CAPTIONS)
    src.publish_report(report, path, onc.BODY_AREA_CAPTIONS)
    return spark.read.parquet(path).withColumnsRenamed({caption: name for name, caption in onc.BODY_AREA_CAPTIONS.items()})


@register("catalog_report", ACTION_SQL["action_completion_filtered"])
def _catalog_report(spark, sf_dir):
    """The action report from catalog tables of two databases."""
    import hashlib
    mark = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    names = {**src.add_to_catalog(spark, sf_dir, f"caresight_care_{mark}", ["orders", "customer"]),
             **src.add_to_catalog(spark, sf_dir, f"caresight_network_{mark}", ["supplier", "nation", "region"])}
    return act.ActionCompletion(Inputs(spark, tables=src.CatalogTables(spark, names)), act.ActionParams(**_FILTERED)).result


@op("latest_snapshot")
def _latest_snapshot(spark, sf_dir):
    return latest_snapshot(_inp(spark, sf_dir)["master_view"], "ACOR").select("NPI", "TIN", "Entity", "ACOR")


@op("straddle_snapshot_flat")
def _straddle_flat(spark, sf_dir):
    return straddle_snapshots(_inp(spark, sf_dir)["assignment_flat"], "Year", "Period").distinct()


@op("top_n_distinct")
def _top_n(spark, sf_dir):
    a = _inp(spark, sf_dir)["assignment"]
    return top_n_distinct(a, F.concat("Year", "Period"), 2)


@op("project_claims")
def _project(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.select(F.lit("PartA").alias("source"), F.col("beneficiary_id").alias("patient_id"), *_KEY,
                    F.trim("clm_line_hcpcs_cd").alias("procedure_code"),
                    (F.col("clm_header_pmt_amnt") - F.col("clm_line_pmt_amnt")).alias("amount_gap"))


@op("classify_stage")
def _classify_stage(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"].withColumn("clm_line_hcpcs_cd", F.trim("clm_line_hcpcs_cd"))
    return onc.classify_stage(a).select(*_KEY, "clm_line_hcpcs_cd", "treatment_process")


@op("classify_body_area")
def _classify_body(spark, sf_dir):
    b = _inp(spark, sf_dir)["part_b"]
    return onc.classify_body_area(b, "clm_line_dgns_cd").select(*_KEY, "clm_line_dgns_cd", "body_area")


@op("classify_modality")
def _classify_modality(spark, sf_dir):
    b = _inp(spark, sf_dir)["part_b"].withColumn("clm_line_hcpcs_cd", F.trim("clm_line_hcpcs_cd"))
    return onc.classify_modality(b).select(*_KEY, "clm_line_hcpcs_cd", "treatment_type")


@op("filter_code_set")
def _filter_code_set(spark, sf_dir):
    return flt.filter_code_set(_inp(spark, sf_dir)["part_b"], "clm_line_hcpcs_cd", codes.LINE_CODES).select(*_KEY)


@op("first_matching_diagnosis")
def _first_matching(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    found = flt.first_matching(inp["part_b"], onc.PART_B_DX, inp["icd_codes"], "clm_dgns_cd", "description", code_col="icd_code")
    return found.select(*_KEY, "clm_dgns_cd", "description")


@op("any_column_in_set")
def _any_in_set(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    found = flt.any_in_set(inp["part_b"], [c for c, _ in onc.PART_B_DX], inp["icd_codes"], "hit", "icd_code")
    return found.select(*_KEY, F.col("hit").cast("int").alias("any_cancer"))


@op("sentinel_fallback")
def _sentinel(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.select(*_KEY, F.col("oprtg_prvdr_npi_num").alias("raw_npi"),
                    fallback("oprtg_prvdr_npi_num", "atndg_prvdr_npi_num").alias("resolved_npi"))


@op("signed_payment")
def _signed(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.select(*_KEY, "clm_adjsmt_type_cd",
                    signed_amount("clm_line_pmt_amnt", "clm_adjsmt_type_cd").alias("signed_amount"))


@op("exclude_type")
def _exclude_type(spark, sf_dir):
    return _inp(spark, sf_dir)["part_a"].where(F.col("clm_type_cd") != "50").select(*_KEY)


@op("null_and_range_predicates")
def _null_range(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.where(F.col("oprtg_prvdr_npi_num").isNotNull() & F.col("clm_line_srvc_unit_qty").between(10, 30)
                   & (F.col("clm_line_pmt_amnt") >= 30000) & (F.col("clm_adjsmt_type_cd") == "1")).select(*_KEY)


@op("valid_npi")
def _valid_npi(spark, sf_dir):
    n = _inp(spark, sf_dir)["npis"]
    return n.select("NpiId", "NpiNum", F.when(valid_npi("NpiNum"), 1).otherwise(0).alias("is_valid"))


@op("like_predicates")
def _like(spark, sf_dir):
    i = _inp(spark, sf_dir)
    n = i["npis"].where(~F.col("NpiNum").like("9%")).select(F.lit("npi").alias("kind"),
                                                             F.col("NpiId").cast("string").alias("id"))
    a = i["alert_actions"].where(F.col("Text").like("No Action Taken")).select(
        F.lit("action").alias("kind"), F.col("AlertActionId").cast("string").alias("id"))
    return n.unionByName(a)


@op("inner_join")
def _inner(spark, sf_dir):
    r = _alerts(spark, sf_dir)
    ua = r.inp["user_alerts"]
    return r.alerts.join(ua, "AlertId", "inner").select("AlertId", "NpiId", "UserId", "ViewedDate")


@op("left_join")
def _left(spark, sf_dir):
    r = _alerts(spark, sf_dir)
    return r.npis.select("NpiId").join(r.subs, "NpiId", "left").select("NpiId", "UserId")


@op("left_join_filtered")
def _left_filtered(spark, sf_dir):
    return _alerts(spark, sf_dir).doc_sub_info.select("NpiId", "UserId")


@op("anti_join")
def _anti(spark, sf_dir):
    return _alerts(spark, sf_dir).users.select("UserId")


@op("not_in_null_aware")
def _not_in(spark, sf_dir):
    i = _inp(spark, sf_dir)
    excl = i["exclusions"].where(F.col("BenId").isNotNull())
    return jn.not_in(i["alerts"], "BenId", excl, "BenId").select("AlertId", "BenId")


@op("semi_join_in")
def _semi_in(spark, sf_dir):
    i = _inp(spark, sf_dir)
    declined = i["tracking"].where(F.col("StatusId") == 3).select(F.col("CTBeneficiaryID").alias("_b"))
    return jn.semi(i["patients"], declined, F.col("ID") == F.col("_b")).select("ID")


@op("semi_join_either")
def _semi_either(spark, sf_dir):
    r = _alerts(spark, sf_dir)
    pm = r.inp["practice_mapping"]
    return jn.semi_either(pm, [("NPI", r.npi_map, "NPI"), ("TIN", r.tin_map, "TIN")]).select(
        "TIN", "NPI", "Metric", "Eligibility", "DATASET").distinct()


register("attach_group", OP_SQL["attach_group"])(
    lambda s, d: _onc(s, d, onc.COURSE_COLS).grouped.select("pta", *_KEY, "treatment_group"))
register("wide_metric_assembly", OP_SQL["wide_metric_assembly"])(lambda s, d: _alerts(s, d).statistics)


@op("precedence_lookup")
def _precedence(spark, sf_dir):
    r = _alerts(spark, sf_dir)
    return r.report_base.select("NpiId", "TIN", "ProviderConsultant")


@op("composite_join")
def _composite(spark, sf_dir):
    r = _alerts(spark, sf_dir)
    return r.doc_sub_info.join(r.first_reads, ["UserId", "NpiId"]).select("AlertId", "UserId", "NpiId")


@op("count_rows_left")
def _count_rows_left(spark, sf_dir):
    return _alerts(spark, sf_dir).action_totals.select("BenId", "NpiId", "TotalActionsPerPatient")


@op("multi_count_distinct")
def _multi_cd(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.groupBy("atndg_prvdr_npi_num").agg(
        F.countDistinct("beneficiary_id").alias("patients"), F.countDistinct("cur_clm_uniq_id").alias("claims"),
        F.countDistinct(F.trim("clm_line_hcpcs_cd")).alias("procedures"))


@op("sum_by_key")
def _sum_by_key(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.groupBy("beneficiary_id").agg(F.sum("clm_line_pmt_amnt").cast("decimal(38,2)").alias("total_paid"))


@op("conditional_sum")
def _cond_sum(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    return a.groupBy("atndg_prvdr_npi_num").agg(count_if(F.col("clm_adjsmt_type_cd") == "1").alias("adjustment_lines"),
                                                count_if(F.col("clm_type_cd") == "50").alias("type50_lines"))


@op("conditional_avg_pivot")
def _cond_avg(spark, sf_dir):
    from caresight.plans.alerts import METRICS
    m = _alerts(spark, sf_dir).quality_metrics
    aggs = []
    for q in range(1, 5):
        for label, metric in zip(("Readm", "PDV"), METRICS):
            aggs.append(F.avg(F.when(F.col("Metric") == metric, F.col(f"Q{q}Ptg"))).alias(f"Q{q}{label}Ptg"))
    return m.groupBy("TIN", "NPI").agg(*aggs)


@op("distinct_rows")
def _distinct(spark, sf_dir):
    return _inp(spark, sf_dir)["part_a"].select("beneficiary_id", "atndg_prvdr_npi_num").distinct()


@op("group_by_dedupe")
def _gb_dedupe(spark, sf_dir):
    return _inp(spark, sf_dir)["tracking"].select("CTBeneficiaryID", "StatusId").distinct()


@op("first_per_key")
def _first_per_key(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    c = inp["cclf4"].join(inp["icd_codes"], F.col("clm_dgns_cd") == F.col("icd_code"), "left_semi")
    return win.first_per_key(c, ["cur_clm_uniq_id"], ["clm_val_sqnc_num", "clm_dgns_cd"])


@op("best_bucket")
def _best_bucket(spark, sf_dir):
    from caresight.plans.alerts import AlertReport as AR
    return win.best_flags(_alerts(spark, sf_dir).read_timings, ["BenId", "NpiId"], AR.FLAGS)


@op("sorted_report")
def _sorted(spark, sf_dir):
    f = _onc(spark, sf_dir).final
    return (f.groupBy("treatment_process").agg(F.sum("clm_line_pmt_amnt").cast("decimal(38,2)").alias("total_cost"),
                                               F.count(F.lit(1)).alias("line_count"))
            .orderBy(F.col("total_cost").desc(), F.col("treatment_process").asc()))


@op("union_distinct")
def _union_distinct(spark, sf_dir):
    i = _inp(spark, sf_dir)
    a = flt.filter_code_set(i["part_a"], "clm_line_hcpcs_cd", codes.TREATMENT_CODES).select("beneficiary_id")
    b = flt.filter_code_set(i["part_b"], "clm_line_hcpcs_cd", codes.TREATMENT_CODES).select("beneficiary_id")
    return a.union(b).distinct()


@op("string_scalars")
def _string_scalars(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    o, t = "oprtg_prvdr_npi_num", "atndg_prvdr_npi_num"
    return a.select(*_KEY, F.trim("clm_line_hcpcs_cd").alias("code_trimmed"), charindex("~", o).alias("tilde_pos"),
                    F.left(F.col(t), F.lit(2)).alias("npi_head"), F.right(F.col(t), F.lit(2)).alias("npi_tail"),
                    tsql_len(o).alias("npi_len"), plus_concat(o, F.lit("-"), t).alias("plus_joined"),
                    tsql_concat(o, F.lit("-"), t).alias("concat_joined"))


@op("null_scalars")
def _null_scalars(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    kind = (F.when(F.col("clm_type_cd") == "50", "inpatient")
            .when(F.col("clm_adjsmt_type_cd") == "1",
                  F.when(F.col("clm_line_srvc_unit_qty") > 25, "big adjustment").otherwise("adjustment"))
            .otherwise("regular"))
    return a.select(*_KEY, F.coalesce("oprtg_prvdr_npi_num", "othr_prvdr_npi_num", "atndg_prvdr_npi_num").alias("first_npi"),
                    kind.alias("line_kind"))


@op("date_diff_units")
def _date_diff(spark, sf_dir):
    i = _inp(spark, sf_dir)
    a = i["alerts"].select("AlertId", F.col("CreatedDate").alias("_a"))
    j = i["action_logs"].join(a, "AlertId")
    return j.select("AlertActionLogId", *[boundary_diff(u, "_a", "CreatedDate").alias(n)
                                          for u, n in (("DAY", "days"), ("HOUR", "hours"), ("MINUTE", "minutes"))])


@op("date_scalars")
def _date_scalars(spark, sf_dir):
    t = _inp(spark, sf_dir)["tracking"]
    return t.select("Id", (F.col("CreatedDate") + F.expr("INTERVAL 1 DAY")).alias("next_day"),
                    weekday_name("CreatedDate").alias("weekday_name"), weekday_mon0("CreatedDate").alias("weekday_mon0"))


@op("utc_to_eastern")
def _utc_eastern(spark, sf_dir):
    a = _inp(spark, sf_dir)["alerts"]
    return a.select("AlertId", "CreatedDate", utc_to_eastern("CreatedDate").alias("eastern"))


@op("cast_scalars")
def _cast_scalars(spark, sf_dir):
    i = _inp(spark, sf_dir)
    pm = i["practice_mapping"].select(
        F.lit("pm").alias("src"), F.concat("TIN", "NPI", "Metric", "Eligibility", "DATASET").alias("k"),
        F.col("QTR1").cast("double").alias("as_float"),
        F.col("QTR1").cast("double").cast("decimal(10,2)").alias("as_decimal"), F.lit(None).cast("date").alias("as_date"))
    tr = i["tracking"].select(F.lit("tr").alias("src"), F.col("Id").cast("string").alias("k"),
                              F.col("Id").cast("double").alias("as_float"),
                              (F.col("Id") % 1000).cast("decimal(10,2)").alias("as_decimal"),
                              F.to_date("CreatedDate").alias("as_date"))
    return pm.unionByName(tr)


@op("arith_scalars")
def _arith(spark, sf_dir):
    a = _inp(spark, sf_dir)["part_a"]
    q = F.col("clm_line_srvc_unit_qty")
    return a.select(*_KEY, (F.col("clm_line_pmt_amnt") * 2).alias("doubled"), (-F.col("clm_line_pmt_amnt")).alias("negated"),
                    (F.col("clm_header_pmt_amnt") - F.col("clm_line_pmt_amnt")).alias("gap"),
                    (q + 1).alias("qty_plus_one"), (q * q).alias("qty_squared"))


@op("float_label")
def _float_label(spark, sf_dir):
    pm = _inp(spark, sf_dir)["practice_mapping"]
    return pm.select(F.concat("TIN", "NPI", "Metric", "Eligibility", "DATASET").alias("k"),
                     float_label(F.col("QTR4").cast("double") / 3).alias("label"))


def _split_src():
    return F.concat(F.col("p_name"), F.lit(","), F.col("p_brand"), F.lit(","),
                    F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_type")),
                    F.when(F.col("p_size") % 4 == 0, F.lit(",")).otherwise(F.lit("")))


@op("split_param")
def _split_param(spark, sf_dir):
    p = src.read_table(spark, sf_dir, "part").select("p_partkey", _split_src().alias("s"))
    return split_param(p, "s", ",").select("p_partkey", "ordinal", "Param")


@op("string_split")
def _string_split(spark, sf_dir):
    c = src.read_table(spark, sf_dir, "customer").select("c_custkey", F.concat(
        F.col("c_mktsegment"), F.lit(";"), F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(F.col("c_name")),
        F.when(F.col("c_custkey") % 6 == 0, F.lit(";")).otherwise(F.lit(""))).alias("s"))
    return string_split(c, "s", ";").select("c_custkey", "value")


@op("split_param_sql")
def _split_param_sql(spark, sf_dir):
    create_splitters(spark)
    p = src.read_table(spark, sf_dir, "part").select("p_partkey", _split_src().alias("s"))
    return spark.sql(f"SELECT p.p_partkey, t.ordinal, t.Param FROM {src.view(p)} p, LATERAL split_param(p.s, ',', 30) t")


@op("string_split_sql")
def _string_split_sql(spark, sf_dir):
    create_splitters(spark)
    c = src.read_table(spark, sf_dir, "customer")
    return spark.sql(f"""SELECT c.c_custkey, t.piece AS value FROM {src.view(c)} c, LATERAL string_split(concat(c.c_mktsegment, ';',
        CASE WHEN c.c_custkey % 4 = 0 THEN '' ELSE c.c_name END, CASE WHEN c.c_custkey % 6 = 0 THEN ';' ELSE '' END), ';') t""")


@op("split_join_sql")
def _split_join_sql(spark, sf_dir):
    create_splitters(spark)
    return spark.sql(f"""SELECT ID, Insurance FROM {src.view(_inp(spark, sf_dir)["patients"])}
        WHERE Insurance IN (SELECT trim(piece) FROM string_split('AUTOMOBILE;  BUILDING ;MACHINERY', ';'))""")


@op("split_join")
def _split_join(spark, sf_dir):
    param = spark.range(1).select(F.lit("AUTOMOBILE;  BUILDING ;MACHINERY").alias("p"))
    wanted = string_split(param, "p", ";").select(F.trim("value").alias("value"))
    return flt.optional_in(_inp(spark, sf_dir)["patients"], "Insurance", wanted).select("ID", "Insurance")
