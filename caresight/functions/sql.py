"""Splitters and parameterised reports as table functions of the SQL session.

``create_splitters`` and ``create_reports`` define SQL table functions (CREATE FUNCTION .. RETURNS
TABLE .. RETURN <query>), so SQL text calls them as the report scripts call theirs, with constants or
laterally over a column::

    SELECT p.p_partkey, s.ordinal, s.Param FROM part p, LATERAL split_param(p.labels, ',', 30) s
    SELECT * FROM cost_by_area_modality('3')

Their bodies are queries, so Spark plans them into the caller's query: a splitter is one generator over
the caller's rows, and a report's parameter is a filter that goes down to its scans.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from caresight.plans import oncology as onc

#: The delimiter as a literal regular expression: each character in a class of its own, ^ and \ escaped.
_QUOTED = r"regexp_replace(delim, '([\\^\\\\\\[\\]{}()*+?.|$-])', '\\\\$1')"

_SPLITTERS = {
    "string_split": ("value STRING, delim STRING", "ordinal INT, piece STRING", f"""
        SELECT pos + 1, col FROM posexplode(split(value, {_QUOTED}, -1)) AS t(pos, col)"""),
    # the order of the steps is split_param's: trailing blanks go, a trailing delimiter adds no piece
    "split_param": ("value STRING, delim STRING, max_len INT", "ordinal INT, Param STRING", f"""
        SELECT pos + 1, left(col, max_len) FROM posexplode_outer(
            CASE WHEN value IS NULL THEN NULL
                 WHEN endswith(rtrim(value), delim) THEN slice(split(rtrim(value), {_QUOTED}, -1), 1, size(split(rtrim(value), {_QUOTED}, -1)) - 1)
                 ELSE split(rtrim(value), {_QUOTED}, -1) END) AS t(pos, col)"""),
}

_MONEY = "CAST(sum(clm_line_pmt_amnt) AS DECIMAL(38,2))"
_DELIVERIES = f"count_if(treatment_process = '{onc.RADIATION}')"
_REPORTS = {
    "cost_by_body_area": ("provider STRING", "body_area STRING, total_cost DECIMAL(38,2), distinct_patients BIGINT, treatment_deliveries BIGINT", f"""
        SELECT body_area, {_MONEY}, count(DISTINCT beneficiary_id), {_DELIVERIES}
        FROM oncology_final WHERE oprtg_prvdr_npi_num = provider GROUP BY body_area"""),
    "cost_by_area_modality": (
        "provider STRING", "body_area STRING, treatment_type STRING, total_cost DECIMAL(38,2), total_treatments BIGINT, "
        "distinct_patients BIGINT, treatment_deliveries BIGINT", f"""
        SELECT body_area, treatment_type, {_MONEY}, count(DISTINCT treatment_group), count(DISTINCT beneficiary_id), {_DELIVERIES}
        FROM oncology_final WHERE treatment_group IS NOT NULL AND oprtg_prvdr_npi_num = provider GROUP BY body_area, treatment_type"""),
    "course_sessions": (
        "patient BIGINT", "treatment_group BIGINT, treatment_type STRING, delivery_sessions BIGINT, course_cost DECIMAL(38,2)", f"""
        SELECT treatment_group, min(treatment_type), {_DELIVERIES}, {_MONEY}
        FROM oncology_final WHERE treatment_group IS NOT NULL AND beneficiary_id = patient GROUP BY treatment_group"""),
}


def _create(spark: SparkSession, functions: dict[str, tuple[str, str, str]]) -> None:
    for name, (takes, gives, query) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS TABLE({gives}) RETURN {query}")


def create_splitters(spark: SparkSession) -> None:
    """``string_split(value, delim)`` and ``split_param(value, delim, max_len)`` for this session, with
    the rules of ``functions.params``; NULL for ``max_len`` is not allowed (pieces would be NULL)."""
    _create(spark, _SPLITTERS)


def create_reports(spark: SparkSession, job: onc.OncologyJob) -> None:
    """The cost reports over the job's final lines, by provider or patient, for this session.

    The lines are the temporary view ``oncology_final``: what a call filters is filtered there."""
    job.final.createOrReplaceTempView("oncology_final")
    _create(spark, _REPORTS)
