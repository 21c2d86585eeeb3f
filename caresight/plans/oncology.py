"""Radiation-oncology treatment courses and their cost (claims report).

Stages (lazy DataFrames; only the course numbering's pinned range pass runs a job when built, and the
steps before it for the cost reports, which keep these in files meanwhile):
  cohort          patients with a treatment code and a cancer diagnosis, Part A or Part B
  part_a_lines    Part A office-visit/treatment lines, one row and cancer diagnosis per line
  part_b_lines    Part B lines with the first matching cancer diagnosis of six columns
  filtered        A + B combined, modality added, office visits kept only when a treatment
                  of the same patient follows within 0-60 days, one row per visit line
  grouped         treatment course per line, anchored on simulation lines
  final           one modality per course, type-50 lines dropped, adjustments negated
Reports: cost by body area, cost by body area x modality, line detail, sessions per
course, cost by phase.

Shuffles: beneficiary for the cohort semi joins and the course scans, claim for the
diagnosis pick, claim and line for repeated rows. Procedure codes come trimmed from
``extract_claims``. Fixed code lists are CASE/IN-set
expressions; the cancer set is a table of the caller's.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresight.functions.codes import (LINE_CODES, MODALITY_CODES, MODALITY_PRIORITY,
                                       OTHER_MODALITY_RANK, STAGE_CODES, TREATMENT_CODES,
                                       BODY_AREA_CODES, UNKNOWN)
from caresight.functions.scalars import fallback, signed_amount
from caresight.operators.aggregates import count_if
from caresight.operators.filters import any_in_set, classify, code_table, filter_code_set, first_matching, has_code
from caresight.operators.scans import anchor_groups, nearest_within
from caresight.operators.windows import priority_label, row_number_per_key
from caresight.sources.tables import Owned, extract_claims, settle, stage

CONSULT, SIMULATION, RADIATION = "1-Consultation", "2-Simulation", "4-Radiation"
CODE = "clm_line_hcpcs_cd"
BENE = "beneficiary_id"
LINE_DATE = "clm_line_from_dt"

PART_B_DX = [("clm_line_dgns_cd", "clm_line_dgns"), ("clm_dgns_1_cd", "clm_dgns_1"),
             ("clm_dgns_2_cd", "clm_dgns_2_"), ("clm_dgns_3_cd", "clm_dgns3"),
             ("clm_dgns_4_cd", "clm_dgns_4"), ("clm_dgns_5_cd", "clm_dgns_5")]

COMBINED_COLS = ["pta", BENE, "cur_clm_uniq_id", "clm_from_dt", "clm_line_num", "clm_type_cd",
                 LINE_DATE, "clm_line_thru_dt", CODE, "treatment_process", "clm_dgns_cd",
                 "description", "body_area", "prncpl_dgns_cd", "prncpl_dgns", "fac_prvdr_npi_num",
                 "oprtg_prvdr_npi_num", "atndg_prvdr_npi_num", "othr_prvdr_npi_num",
                 "clm_adjsmt_type_cd", "clm_line_srvc_unit_qty", "clm_header_pmt_amnt",
                 "clm_line_pmt_amnt"]

# What the reports read of the combined lines. A visit line's repeated rows are ranked by all columns
# in their order: left out are only last ones, or such as the Part B rows all hold alike (a claim line
# has one Part A row).
COURSE_COLS = [*COMBINED_COLS[:COMBINED_COLS.index("treatment_process") + 1], "treatment_type"]
REPORT_COLS = [c for c in COMBINED_COLS if c not in ("prncpl_dgns_cd", "prncpl_dgns", "fac_prvdr_npi_num", "othr_prvdr_npi_num")] + ["treatment_type"]

FINAL_COLS = ["part_ab", BENE, "cur_clm_uniq_id", "clm_from_dt", "clm_line_num", "clm_type_cd",
              LINE_DATE, "clm_line_thru_dt", CODE, "treatment_group", "treatment_type",
              "treatment_process", "clm_dgns_cd", "description", "body_area",
              "oprtg_prvdr_npi_num", "atndg_prvdr_npi_num", "clm_adjsmt_type_cd",
              "clm_line_srvc_unit_qty", "clm_header_pmt_amnt", "clm_line_pmt_amnt"]

# What the cost reports read of the lines once each visit line's row is picked.
COST_COLS = [BENE, "cur_clm_uniq_id", "clm_line_num", "clm_type_cd", LINE_DATE, "treatment_type", "treatment_process", "body_area",
             "oprtg_prvdr_npi_num", "clm_adjsmt_type_cd", "clm_line_pmt_amnt"]

#: Every label that the lines can have.
LABELS = {"treatment_process": [*STAGE_CODES, UNKNOWN], "treatment_type": [*MODALITY_CODES, UNKNOWN], "body_area": [*BODY_AREA_CODES, UNKNOWN]}

# Captions of the published reports.
BODY_AREA_CAPTIONS = {"body_area": "Body_Area", "total_cost": "TOTAL_COST", "distinct_patients": "# Distince Patients",
                      "treatment_deliveries": "# Treatment Delivery"}
AREA_MODALITY_CAPTIONS = {"body_area": "Body_Area", "treatment_type": "Treatment_Type", "total_cost": "Total_Cost",
                          "total_treatments": "Total_Treatments", "distinct_patients": "# Distince Patients",
                          "treatment_deliveries": "# Treatment Delivery"}
DETAIL_CAPTIONS = {"part_ab": "PartA/B", BENE: "Beneficiary_ID", "treatment_group": "Treatment_Group", "treatment_type": "Treatment_Type",
                   "treatment_process": "Treatment_Process", "body_area": "Body_Area"}


def classify_stage(df: DataFrame, col: str = CODE, out: str = "treatment_process") -> DataFrame:
    return classify(df, col, STAGE_CODES, out, UNKNOWN)


def classify_body_area(df: DataFrame, col: str = "clm_dgns_cd", out: str = "body_area") -> DataFrame:
    return classify(df, col, BODY_AREA_CODES, out, UNKNOWN, trim=False)


def classify_modality(df: DataFrame, col: str = CODE, out: str = "treatment_type") -> DataFrame:
    return classify(df, col, MODALITY_CODES, out, UNKNOWN)


def _cancer_claims(cclf4: DataFrame, cancer: DataFrame) -> DataFrame:
    codes = code_table(cancer, "icd_code").select(F.xxhash64("code").alias("_key"), "code")
    return cclf4.join(codes, has_code("clm_dgns_cd", "_key", "code"), "left_semi")


def cohort(part_a: DataFrame, cclf4: DataFrame, part_b: DataFrame, cancer: DataFrame) -> DataFrame:
    """Distinct patients with a treatment line and a cancer diagnosis (A or B); ``cancer`` is the
    table of diagnosis codes (column icd_code).

    Part A: a treatment line whose claim carries a cancer diagnosis row — a semi join on
    the claim, so claims with many diagnosis rows do not multiply lines. Part B: any of the six
    diagnosis columns, looked up in place, so lines are not multiplied either.
    """
    a = (filter_code_set(part_a, CODE, TREATMENT_CODES, trim=False)
         .join(_cancer_claims(cclf4, cancer).hint("shuffle_hash"), "cur_clm_uniq_id", "left_semi").select(BENE))
    b = (any_in_set(filter_code_set(part_b, CODE, TREATMENT_CODES, trim=False), [c for c, _ in PART_B_DX], cancer, "_hit", "icd_code")
         .where("_hit").select(BENE))
    return a.union(b).distinct()


def one_per_key(df: DataFrame, keys: list[str], first_by: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per key: the least by ``first_by``, then by all columns in their order (NULLs
    first). Ranked by one sort per task of rows that are dealt by the key or by a part of it."""
    rest = [c for c in df.columns if c not in keys and c not in first_by]
    return row_number_per_key(df, keys, [F.col(c) for c in (*first_by, *rest)], "_rn").where("_rn = 1").drop("_rn")


def leading(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The first columns of ``df``, up to the last wanted one: the least row per key by all columns in
    their order has the least values of these."""
    return df.select(*df.columns[:1 + max(i for i, c in enumerate(df.columns) if c in wanted)])


LINE_KEY = ["cur_clm_uniq_id", "clm_line_num"]


def of_patients(lines: DataFrame, patients: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """The lines of the cohort's patients (a semi join), of those that have a claim. The different pairs of
    claim and patient meet the cohort and come back by claim, so the lines stay where their claim is, and are not sorted for it.
    ``among``: rows that hold all pairs of the lines (the lines themselves if not given)."""
    pairs = ((among or lines).select("cur_clm_uniq_id", BENE).distinct().join(patients, BENE, "left_semi")
             .select(F.col("cur_clm_uniq_id").alias("_claim"), F.col(BENE).alias("_patient")))
    # the patient is no key of this join, which the lines need not be dealt by
    return lines.join(pairs.hint("shuffle_hash"), (F.col("cur_clm_uniq_id") == F.col("_claim")) & F.array_contains(F.array("_patient"), F.col(BENE)), "left_semi")


def part_a_lines(part_a: DataFrame, patients: DataFrame, cclf4: DataFrame, lu_icd10: DataFrame,
                 cancer: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Part A lines of cohort patients with a line code, one row per (claim, line), each with the
    claim's cancer diagnosis of the lowest sequence number (ties: lowest code) and that code's
    description (of several the least). ``columns``: those that are read of them (all if not given)."""
    best_dx = (_cancer_claims(cclf4, cancer)
               .groupBy("cur_clm_uniq_id")
               .agg(F.min(F.struct("clm_val_sqnc_num", "clm_dgns_cd")).alias("_dx"))
               .select("cur_clm_uniq_id", F.col("_dx.clm_val_sqnc_num").alias("clm_val_sqnc_num"),
                       F.col("_dx.clm_dgns_cd").alias("clm_dgns_cd")))
    if columns:
        part_a = leading(part_a, [*columns, *LINE_KEY, BENE, CODE])
    lines = of_patients(filter_code_set(part_a, CODE, LINE_CODES, trim=False), patients)
    lines = one_per_key(lines, LINE_KEY).join(best_dx, "cur_clm_uniq_id", "inner")
    icd = lu_icd10.groupBy(F.col("ICD10").alias("_icd")).agg(F.min("description").alias("description"))
    icd = icd.withColumn("_key", F.xxhash64("_icd"))
    lines = lines.join(icd, has_code("clm_dgns_cd", "_key", "_icd"), "left").drop("_icd", "_key")
    return classify_body_area(classify_stage(lines))


def part_b_lines(part_b: DataFrame, patients: DataFrame, cancer: DataFrame) -> DataFrame:
    """Part B lines of cohort patients, each with the first of its six diagnoses that is a cancer's. That is
    picked where the lines are read, so one diagnosis instead of six goes on to the joins."""
    coded = filter_code_set(part_b, CODE, LINE_CODES, trim=False)
    lines = first_matching(coded, PART_B_DX, cancer, "clm_dgns_cd", "description", code_col="icd_code")
    loose = lines.where(F.col("cur_clm_uniq_id").isNull()).join(patients, BENE, "left_semi")
    return classify_body_area(classify_stage(of_patients(lines, patients, coded).unionByName(loose)))


def combined(a_lines: DataFrame, b_lines: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Part A and Part B lines in one shape, with the treatment modality; ``columns``: those to take."""
    same = {c: F.col(c) for c in COMBINED_COLS if c != "pta"}
    empty = F.lit("")
    a = {"pta": F.lit("PartA"), **same, "oprtg_prvdr_npi_num": fallback("oprtg_prvdr_npi_num", "atndg_prvdr_npi_num")}
    b = {"pta": F.lit("PartB"), **same, CODE: F.trim(CODE), "prncpl_dgns_cd": empty, "prncpl_dgns": empty,
         "fac_prvdr_npi_num": empty, "oprtg_prvdr_npi_num": F.col("rndrg_prvdr_npi_num"),
         "atndg_prvdr_npi_num": F.col("clm_rfrg_prvdr_npi_num"), "othr_prvdr_npi_num": empty,
         "clm_header_pmt_amnt": F.lit(None).cast("decimal(18,2)"), "clm_line_pmt_amnt": F.col("clm_line_cvrd_pd_amt")}
    taken = [c for c in COMBINED_COLS if not columns or c in columns or c == CODE]
    lines = classify_modality(a_lines.select(*[a[c].alias(c) for c in taken])
                              .unionByName(b_lines.select(*[b[c].alias(c) for c in taken])))
    return lines.select(*columns) if columns else lines


def filtered(comb: DataFrame, lo_days: int = 0, hi_days: int = 60, keep=stage) -> DataFrame:
    """Treatment lines, plus office visits followed by a treatment within the window; of a visit
    line's repeated rows the one with the nearest treatment. ``keep``: how the visits are kept."""
    visits = comb.where(F.col("treatment_process") == CONSULT)
    treatments = comb.where(F.col("treatment_process") != CONSULT)
    kept = nearest_within(visits, treatments, [BENE], LINE_DATE, LINE_DATE, lo_days, hi_days, out="_days")
    # staged: a range pass reads its rows twice (for the bounds, then for the ranges)
    return treatments.unionByName(keep(one_per_key(kept, LINE_KEY, ["_days"]).drop("_days")))


def as_numbers(lines: DataFrame) -> DataFrame:
    """The labels of the lines as numbers, which shuffles carry in less; ``label_of`` reads them."""
    return lines.withColumns({c: F.array_position(F.array(*map(F.lit, some)), F.col(c)).cast("int") for c, some in LABELS.items()})


def label_of(col: str) -> F.Column:
    return F.get(F.array(*map(F.lit, LABELS[col])), F.col(col) - 1)


def treatment_groups(lines: DataFrame, width: int | None = None, proc: F.Column | None = None) -> DataFrame:
    """Course number per line: simulation lines are numbered in (patient, date, claim,
    line) order; office visits take the first simulation on or after them, other lines
    the latest simulation on or before them (same-day ties: lowest course number).
    Numbering and both look-ups share one pinned range pass (``anchor_groups``). ``proc``: the lines'
    ``treatment_process``, if kept otherwise."""
    proc = F.col("treatment_process") if proc is None else proc
    look = (F.when(proc == CONSULT, F.lit("forward"))
            .when(~proc.isin(CONSULT, SIMULATION), F.lit("backward")))
    return anchor_groups(lines, [BENE], LINE_DATE, ["cur_clm_uniq_id", "clm_line_num"],
                         proc == SIMULATION, look, out="treatment_group", num_partitions=width)


def final_lines(grouped: DataFrame, columns: list[str] = FINAL_COLS) -> DataFrame:
    """One modality per course (IMRT > SBRT > 3D > others), type-50 lines dropped,
    adjustment lines negated. Lines without a course keep their own modality. ``columns``: those to give out."""
    course_type = priority_label(grouped, "treatment_group", "treatment_type", MODALITY_PRIORITY,
                                 OTHER_MODALITY_RANK, (UNKNOWN,), out="_course_type")
    lines = grouped.where(F.col("clm_type_cd") != "50")
    # Lines without a course can never match; they bypass the join instead of all hashing
    # to the one partition of the NULL key.
    grouped_lines = lines.where(F.col("treatment_group").isNotNull()).join(course_type, "treatment_group", "left")
    loose = lines.where(F.col("treatment_group").isNull()).withColumn("_course_type", F.lit(None).cast("string"))
    out = (grouped_lines.unionByName(loose)
           .withColumn("treatment_type", F.coalesce("_course_type", "treatment_type"))
           .withColumn("clm_line_pmt_amnt", signed_amount("clm_line_pmt_amnt", "clm_adjsmt_type_cd"))
           .withColumnRenamed("pta", "part_ab"))
    return out.select(*columns)


def _money(c: str) -> F.Column:
    return F.sum(c).cast("decimal(38,2)")


def cost_by_body_area(final: DataFrame, provider: str) -> DataFrame:
    return (final.where(F.col("oprtg_prvdr_npi_num") == provider)
            .groupBy("body_area")
            .agg(_money("clm_line_pmt_amnt").alias("total_cost"),
                 F.countDistinct(BENE).alias("distinct_patients"),
                 count_if(F.col("treatment_process") == RADIATION).alias("treatment_deliveries"))
            .orderBy(F.col("body_area").desc()))


def cost_by_area_modality(final: DataFrame, provider: str) -> DataFrame:
    return (final.where(F.col("treatment_group").isNotNull() & (F.col("oprtg_prvdr_npi_num") == provider))
            .groupBy("body_area", "treatment_type")
            .agg(_money("clm_line_pmt_amnt").alias("total_cost"),
                 F.countDistinct("treatment_group").alias("total_treatments"),
                 F.countDistinct(BENE).alias("distinct_patients"),
                 count_if(F.col("treatment_process") == RADIATION).alias("treatment_deliveries"))
            .orderBy(F.col("body_area").desc(), F.col("treatment_type").asc()))


def detail(final: DataFrame) -> DataFrame:
    return final.orderBy(BENE, LINE_DATE, "cur_clm_uniq_id", "treatment_process")


def sessions_per_course(final: DataFrame) -> DataFrame:
    """Delivery sessions (and lines, days, cost) per treatment course."""
    return (final.where(F.col("treatment_group").isNotNull())
            .groupBy("treatment_group")
            .agg(F.min(BENE).alias(BENE), F.min("treatment_type").alias("treatment_type"),
                 count_if(F.col("treatment_process") == RADIATION).alias("delivery_sessions"),
                 F.count(F.lit(1)).alias("course_lines"),
                 F.min(LINE_DATE).alias("first_date"), F.max(LINE_DATE).alias("last_date"),
                 _money("clm_line_pmt_amnt").alias("course_cost")))


def cost_by_phase(final: DataFrame) -> DataFrame:
    """Cost split by treatment phase (consultation, simulation, planning, delivery, ...)."""
    return (final.groupBy("treatment_process")
            .agg(_money("clm_line_pmt_amnt").alias("total_cost"),
                 F.count(F.lit(1)).alias("line_count"),
                 F.countDistinct(BENE).alias("distinct_patients")))


class OncologyJob:
    """Every stage of the report, built lazily from ``inputs`` (indexable by adapter name; the table
    ``icd_codes`` is the cancer set) for claims after ``since``.

    Stages are cached on the job object, so reports that share a stage share its plan. The cohort
    and the combined lines are staged, so the claim tables are read twice: once for each.
    """

    def __init__(self, inputs, since: str | None, width: int | None = None, columns: list[str] | None = None,
                 reported: list[str] | None = None, keep=stage):
        """``width``: tasks of the shuffles of lines (the session's number if not given); ``columns``:
        those of the combined lines that are staged (all, ``REPORT_COLS`` or ``COURSE_COLS``); ``reported``: those that
        the course pass and the final lines have (all of these if not given; else ``COST_COLS``). Then the job runs
        step by step while it is built: each step's lines are kept in files, which go when the next steps have read
        them. ``keep``: how the combined lines and the visits are kept."""
        self.inputs, self.since, self.width, self.columns, self.reported, self.keep = inputs, since, width, columns, reported, keep
        self.cancer = inputs["icd_codes"]

    @cached_property
    def part_a(self) -> DataFrame:
        return extract_claims(self.inputs["part_a"], self.since)

    @cached_property
    def part_b(self) -> DataFrame:
        return extract_claims(self.inputs["part_b"], self.since)

    @cached_property
    def cohort(self) -> DataFrame:
        patients = cohort(self.part_a, self.inputs["cclf4"], self.part_b, self.cancer)
        # so many tasks that the lines meet them in as many
        return stage(patients.repartition(self.width, BENE) if self.width else patients)

    @cached_property
    def a_lines(self) -> DataFrame:
        return part_a_lines(self.part_a, self.cohort, self.inputs["cclf4"], self.inputs["lu_icd10"], self.cancer,
                            self.columns if self.columns == COURSE_COLS else None)

    @cached_property
    def b_lines(self) -> DataFrame:
        return part_b_lines(self.part_b, self.cohort, self.cancer)

    @cached_property
    def combined(self) -> DataFrame:
        # read as visits, as their partners and as treatments
        return self.keep(combined(self.a_lines, self.b_lines, self.columns))

    @cached_property
    def filtered(self) -> DataFrame:
        return filtered(self.combined, keep=self.keep)

    @cached_property
    def grouped(self) -> DataFrame:
        if self.reported is None:
            return treatment_groups(self.filtered, self.width)
        with Owned(brief=True):  # the pinned ranges
            kept = Owned(brief=True)  # the combined lines and the visits
            try:
                with Owned(brief=True):  # the claim lines and the cohort
                    inputs = self.inputs.in_files() if hasattr(self.inputs, "in_files") else self.inputs
                    steps = OncologyJob(inputs, self.since, self.width, self.columns, keep=lambda df: settle(df, owner=kept))
                    steps.combined  # noqa: B018
                lines = as_numbers(steps.filtered.select(*self.reported))
                grouped = treatment_groups(lines, self.width, label_of("treatment_process"))
            finally:
                kept.release()
            return settle(grouped, owner=Owned()).withColumns({c: label_of(c) for c in LABELS})

    @cached_property
    def final(self) -> DataFrame:
        # read for the modality of each course, and for the lines
        if self.reported is None:
            return final_lines(stage(self.grouped))
        return final_lines(self.grouped, [c for c in FINAL_COLS if c in (*self.reported, "treatment_group")])
