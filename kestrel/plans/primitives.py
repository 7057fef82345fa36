"""Single-operator queries: each isolates one operator of the library on whole adapted tables.

The composite views use these operators in combination; here each one runs alone over a full
input (no sampling, no id subsets), so its result can be checked against the original SQL form
and its plan inspected on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.columns import (
    canon_text, norm, parse_iso_offset, regex_first, round_to_long, safe_double, safe_long, school_year_from_date,
    school_year_from_roster_year, split_part, trimmed, utc_date,
)
from kestrel.functions.rules import elpac_track, elpi_level, elpi_level_rank, grade_band
from kestrel.operators.hot_keys import hot_key_join
from kestrel.operators.joins import (
    anti_any_key, band_join, conditional_key_join, full_outer_null_safe, overlay,
)
from kestrel.operators.rollup import subgroup_counts as _subgroup_counts
from kestrel.operators.stack import union_distinct
from kestrel.plans.assessments import richest_diagnostic
from kestrel.plans.enrollment import SUBGROUPS
from kestrel.plans.meals import best_meal_record
from kestrel.plans.reloads import latest_reload
from kestrel.plans.state_testing import OVERLAY_KEYS
from kestrel.sources.fixtures import CAST_NAMES, EXCEPTION_STATE_ID
from kestrel.sources.registry import Inputs


# ---- W1 / W4 / W5: keep-best variants ---------------------------------------------------------------
def keep_best_latest(inputs: Inputs) -> DataFrame:
    """Latest row per (student_number, assessment) of the whole reload log."""
    return latest_reload(inputs["state_results_pascal"])


def keep_best_ranked(inputs: Inputs) -> DataFrame:
    """Best meal record per (student, normalised year): category, status, latest time, highest id."""
    return best_meal_record(inputs["meal_applications"])


def keep_best_richest(inputs: Inputs) -> DataFrame:
    """The diagnostic row with the most filled end-of-year, then middle, then beginning fields."""
    return richest_diagnostic(inputs["diagnostics"]).withColumnRenamed("__key", "local_student_id")


# ---- D3 / D4 / D5 / D7 / D8 / U6: joins ------------------------------------------------------------
def anti_any_key_query(inputs: Inputs) -> DataFrame:
    """Archived students matching no live summative ELA result on state id OR student number."""
    h = inputs["sbac_archive"].select("studentidentifier", "student_number", "ela_scalescore", "lastfirst", "school_name")
    live = inputs["state_results_snake"].where((F.col("subject") == "ELA") & (F.col("assessmenttype") == "Summative"))
    return anti_any_key(h, live, OVERLAY_KEYS)


def overlay_archive(inputs: Inputs) -> DataFrame:
    """Live rows, plus archived rows of students the live side lacks (either key), distinct."""
    live = inputs["state_results_snake"].select("studentidentifier", "student_number", "subject",
                                                "scalescoreachievementlevel")
    archive = inputs["cast_archive"].select("studentidentifier", "student_number", F.lit("CAST").alias("subject"),
                                            "scalescoreachievementlevel")
    return union_distinct([live, overlay(live, archive, OVERLAY_KEYS)])


def conditional_key_join_query(inputs: Inputs, exception_ids: list[int] | None = None) -> DataFrame:
    """Latest ELPAC results ⟕ prior-year ELPAC results, keyed by state id for the exception list, else by number.

    The log is reduced to the latest row per (student number, test) first, as the growth model does: a number that
    stands for many unknown students (0) then has one row per test, so the matches grow with the prior rows and not
    with the product of both sides.
    """
    log = latest_reload(inputs["state_results_pascal"].where(norm("Subject").contains("elpac")))
    cur = log.select(
        F.col("StudentIdentifier").alias("studentidentifier"), "student_number",
        F.col("AssessmentName").alias("assessmentname"), "file_name",
        F.col("ScaleScoreAchievementLevel").alias("scalescoreachievementlevel"), elpac_track("Subject").alias("elpac_track"),
    )
    prior = inputs["state_results_snake"].where(norm("subject").contains("elpac")).select(
        F.col("studentidentifier").alias("prev_studentidentifier"), F.col("student_number").alias("prev_student_number"),
        F.col("scalescoreachievementlevel").alias("prev_scalescoreachievementlevel"),
        elpac_track("subject").alias("prev_elpac_track"),
    )
    return conditional_key_join(
        cur, prior, left_id="studentidentifier", left_number="student_number", right_id="prev_studentidentifier",
        right_number="prev_student_number", exception_ids=exception_ids or [EXCEPTION_STATE_ID],
        also_on=[("elpac_track", "prev_elpac_track")],
    )


def band_lookup_join(inputs: Inputs) -> DataFrame:
    """D7 with E1-E3: ELPAC results ⟕ cut-score bands on (grade band, score BETWEEN lo AND hi); ELPI level and rank."""
    snake = inputs["state_results_snake"].where(norm("subject").contains("elpac"))
    base = snake.select(
        "studentidentifier", "student_number", "subject", "scalescoreachievementlevel", "gradelevelwhenassessed",
        safe_double("scalescore").alias("scalescore"), elpac_track("subject").alias("elpac_track"),
    )
    wants_band = (F.col("elpac_track") == "elpac") & trimmed("scalescoreachievementlevel").isin("Level 2", "Level 3")
    j = band_join(base, inputs["cut_scores"],
                  left_band=F.when(wants_band, grade_band("gradelevelwhenassessed", T.StringType())),
                  left_value=F.col("scalescore"), band_key="grade_band", low="min_score", high="max_score", prefix="cut_")
    level = elpi_level("scalescoreachievementlevel", "elpac_track", "cut_level_code")
    return j.withColumn("elpi_level", level).withColumn("elpi_level_rank", elpi_level_rank(F.col("elpi_level")))


def full_outer_coalesce(inputs: Inputs) -> DataFrame:
    """Summative ELA ⟗ Math on state id, ids coalesced; a NULL id never pairs, so it stays its own row."""
    summ = inputs["state_results_snake"].where(F.col("assessmenttype") == "Summative")
    ela = summ.where(F.col("subject") == "ELA").select(
        F.col("studentidentifier").alias("e_sid"), F.col("student_number").alias("e_sn"),
        F.col("scalescoreachievementlevel").alias("ela_level"), F.col("scalescore").alias("ela_scalescore")).distinct()
    math = summ.where(F.col("subject") == "Math").select(
        F.col("studentidentifier").alias("m_sid"), F.col("student_number").alias("m_sn"),
        F.col("scalescoreachievementlevel").alias("math_level"), F.col("scalescore").alias("math_scalescore")).distinct()
    j = full_outer_null_safe(ela, math, "e_sid", "m_sid")
    return j.select(F.coalesce("e_sid", "m_sid").alias("studentidentifier"),
                    F.coalesce("e_sn", "m_sn").alias("student_number"),
                    "ela_level", "ela_scalescore", "math_level", "math_scalescore")


def roster_right_join(inputs: Inputs) -> DataFrame:
    """D3: ``scores RIGHT JOIN roster`` — every roster row of every year, with its CAST results if any."""
    scores = inputs["state_results_snake"].where(F.col("assessmentname").isin(*CAST_NAMES)).select(
        "student_number", "assessmentname", "scalescore", "scalescoreachievementlevel")
    roster = inputs["roster"].select(F.col("student_number").alias("st_student_number"), "year", "grade_level",
                                     "school_name")
    return hot_key_join(roster, scores, [("st_student_number", "student_number")], "left")


# ---- A6, G4/G5, G7, G9: scans and aggregates ---------------------------------------------------------
def latest_snapshot(inputs: Inputs) -> DataFrame:
    """Rows of the latest load (``partitiontime = MAX(partitiontime)`` as a scalar subquery)."""
    sg = inputs["stored_grades"]
    return sg.where(F.col("partitiontime") == sg.select(F.max("partitiontime")).scalar())


def max_per_key(inputs: Inputs) -> DataFrame:
    """Per student number, each column maxed independently (a row may mix source rows)."""
    s = inputs["state_results_snake"].where(F.col("student_number").isNotNull())
    return s.groupBy("student_number").agg(
        F.max("studentidentifier").alias("max_studentidentifier"),
        F.max("scalescoreachievementlevel").alias("max_scalescoreachievementlevel"),
        F.max("dfs_ela").alias("max_dfs_ela"),
        F.max("proficiency").alias("max_proficiency"),
        F.max("scalescore").alias("max_scalescore"),
    )


def distinct_rows(inputs: Inputs) -> DataFrame:
    """Full-row DISTINCT of a projection of the reload log (NULLs compare equal)."""
    return inputs["state_results_pascal"].select("student_number", "AssessmentName", "Subject", "file_name").distinct()


def subgroup_counts(inputs: Inputs) -> DataFrame:
    """Head counts per school-year for five demographic cuts, long form, one scan."""
    return _subgroup_counts(inputs["roster"], ["school_name", "year"], SUBGROUPS)


# ---- scalar suites -----------------------------------------------------------------------------------
def safe_cast_suite(inputs: Inputs) -> DataFrame:
    """Strict and safe casts as the source dialect applies them, on every reload-log row."""
    p = inputs["state_results_pascal"]
    return p.select(
        "StudentIdentifier", "student_number", "file_name", "ScaleScore", "GradeLevelWhenAssessed",
        safe_double("ScaleScore").alias("scalescore_double"),
        safe_long("ScaleScore").alias("scalescore_long"),
        safe_long("GradeLevelWhenAssessed").alias("grade_long"),
        canon_text(F.col("dfs_ela"), T.DoubleType()).alias("dfs_ela_text"),
        round_to_long(F.col("dfs_math") / 4).alias("dfs_math_quarter"),
        F.col("LexileMeasure").cast("double").alias("lexile_double"),
        F.col("StudentIdentifier").cast("string").alias("sid_text"),
    )


def text_suite(inputs: Inputs) -> DataFrame:
    """S1-S12 and E8 on every roster row."""
    r = inputs["roster"]
    return r.select(
        "student_number", "year",
        F.upper("school_name").alias("school_upper"),
        F.lower("race").alias("race_lower"),
        F.trim("ishomeless").alias("homeless_trimmed"),
        F.concat(F.lit("Teacher: "), F.col("math_teacher"), F.lit(" / "), F.col("race")).alias("label"),
        split_part("lastfirst", ",", 0, safe=False).alias("last_name"),
        F.trim(split_part("lastfirst", ",", 1, safe=True)).alias("first_name"),
        F.replace(F.col("year"), F.lit("-"), F.lit("/")).alias("year_slash"),
        school_year_from_roster_year("year").alias("academic_year"),
        regex_first("school_name", r"([0-9]+)").alias("school_number"),
        F.regexp_replace("school_name", "School ", "S-").alias("school_code"),
        F.regexp_replace("lastfirst", r"([A-Z])[a-z]+", "$1").alias("initials"),
        F.col("lastfirst").rlike(r"[0-9]").alias("has_digit"),
        F.format_string("%d-%d", F.col("grade_level"), F.col("grade_level") + 1).alias("grade_span"),
        F.col("lastfirst").like("%, First%").alias("has_first_name"),
    )


def date_suite(inputs: Inputs) -> DataFrame:
    """S14-S17, E7, E9 on every meal application: offset timestamps, UTC dates, school years."""
    a = inputs["meal_applications"]
    ts = parse_iso_offset("application_date")
    day = utc_date(ts)
    return a.select(
        "mealapplicationid", "application_date", "academic_year",
        F.unix_timestamp(ts).alias("application_epoch"),
        day.alias("application_day"),
        F.month(day).alias("application_month"),
        F.year(day).alias("application_year"),
        school_year_from_date(day).alias("school_year"),
        F.replace(F.col("academic_year"), F.lit("/"), F.lit("-")).alias("academic_year_normalized"),
    )


def conditional_suite(inputs: Inputs) -> DataFrame:
    """CASE forms, COALESCE/IFNULL/NULLIF/IF, arithmetic, safe ratio rounded, boolean columns."""
    r = inputs["roster"]
    g = F.col("grade_level")
    return r.select(
        "student_number", "year",
        F.coalesce(F.col("race"), F.lit("Unknown")).alias("race_or_unknown"),
        F.ifnull(F.col("elastatus"), F.lit("None")).alias("elastatus_or_none"),
        F.nullif(g, F.lit(0)).alias("grade_nonzero"),
        F.when(norm("ishomeless") == "yes", 1).otherwise(0).alias("homeless_flag"),
        (g - 5).alias("grades_from_5"),
        F.round(F.try_divide(F.col("student_number").cast("double"), g.cast("double")), 3).alias("number_per_grade"),
        F.when(g <= 5, "elementary").when(g <= 8, "middle").otherwise("high").alias("school_level"),
        F.when(F.col("elastatus") == "EL", F.when(g < 6, "EL elementary").otherwise("EL secondary")).alias("el_group"),
        (F.col("sped_identifier") == "Yes").alias("is_sped"),
    )


def grade_band_query(inputs: Inputs) -> DataFrame:
    """E3 on every assessed-grade text of the 24-25 results."""
    s = inputs["state_results_snake"]
    return s.select("studentidentifier", "student_number", "gradelevelwhenassessed",
                    grade_band("gradelevelwhenassessed", T.StringType()).alias("grade_band"))
