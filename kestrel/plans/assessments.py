"""Unified assessment results (ten feeds → one 16-column text table) and its consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import canon_text, norm, safe_long, typed_null
from kestrel.functions.rules import ica_curriculum, score_label_split
from kestrel.operators.dedupe import all_columns_tiebreak
from kestrel.operators.stack import union_all
from kestrel.plans.reloads import best_row, latest_reload
from kestrel.sources.fixtures import ICA_MATH_11
from kestrel.sources.registry import Inputs

UNIFIED_COLUMNS = [
    "data_source", "assessment_id", "year", "date_taken", "grade", "local_student_id", "test_type", "curriculum",
    "unit", "unit_labels", "title", "standard_code", "score", "performance_band_level", "performance_band_label",
    "proficiency",
]
# feed name → whether rows with a NULL score are dropped
FEEDS = {
    "feed_illuminate": False, "feed_iready": False, "feed_star": False, "feed_dibels": False, "feed_sbac_prior": False,
    "feed_interim_2": False, "feed_interim_3": False, "feed_pear_responses": True, "feed_pear_summaries": True,
}


def to_unified(df: DataFrame) -> DataFrame:
    """Cast every column to text as the source dialect prints it; absent columns become typed NULLs."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select([
        (canon_text(F.col(c), types[c]) if c in types else typed_null("string")).alias(c) for c in UNIFIED_COLUMNS
    ])


def interim_ica(inputs: Inputs, year: str = "25-26", remap: tuple[str, str] = (ICA_MATH_11, "Algebra II")) -> DataFrame:
    """Latest interim (ICA) result per student + assessment, in the unified schema, rostered students only."""
    log = inputs["state_results_pascal"]
    ica = latest_reload(log.where(norm("AssessmentType").contains("ica")))
    st = inputs["roster"].where(F.col("year") == year).select(F.col("student_number").alias("st_number"), "grade_level")
    j = ica.join(st, ica["student_number"] == st["st_number"], "inner")
    return j.select(
        F.lit("CERS").alias("data_source"),
        typed_null("string").alias("assessment_id"),
        F.lit(year).alias("year"),
        typed_null("string").alias("date_taken"),
        F.col("grade_level").cast("string").alias("grade"),
        F.col("student_number").cast("string").alias("local_student_id"),
        F.lit("assessment").alias("test_type"),
        ica_curriculum("Subject", "AssessmentName", *remap).alias("curriculum"),
        F.lit("ICA").alias("unit"),
        typed_null("string").alias("unit_labels"),
        F.col("AssessmentName").cast("string").alias("title"),
        F.lit("percent").alias("standard_code"),
        F.col("ScaleScore").cast("string").alias("score"),
        typed_null("string").alias("performance_band_level"),
        typed_null("string").alias("performance_band_label"),
        F.col("ScaleScoreAchievementLevel").cast("string").alias("proficiency"),
    )


def unified_assessments(inputs: Inputs) -> DataFrame:
    """UNION ALL of the nine feeds and the interim results, all columns as text."""
    frames = []
    for name, drop_null_scores in FEEDS.items():
        df = inputs[name]
        if drop_null_scores:
            df = df.where(F.col("score").isNotNull())
        frames.append(to_unified(df))
    frames.append(interim_ica(inputs))
    return union_all(frames)


UNIFIED_INPUTS = list(FEEDS) + ["state_results_pascal", "roster"]

_ROSTER_COMMON = ["year", "elastatus"]
_ROSTER_TAIL = ["lastfirst", "school_name", "sped_identifier", "absenteeism_status"]
_BAND_TEACHERS = {
    "elementary": ["elem_teacher"],
    "middle": ["english_teacher", "math_teacher", "science_teacher", "history_teacher"],
    "high": ["english_teacher", "math_teacher", "science_teacher", "history_teacher"],
}
_BAND_FILTERS = {
    "elementary": (["0", "1", "2", "3", "4", "5"], ["illuminate", "CERS"]),
    "middle": (["6", "7", "8"], ["illuminate", "pear", "CERS"]),
    "high": (["9", "10", "11", "12"], ["illuminate", "pear", "CERS"]),
}


def _roster_with_text_key(inputs: Inputs) -> DataFrame:
    r = inputs["roster"]
    return r.withColumn("__student_text", F.col("student_number").cast("string")).withColumnRenamed("year", "__st_year")


def assessments_by_band(inputs: Inputs, band: str) -> DataFrame:
    """Roster × unified results for one grade band (the assessment's grade text, exact source names)."""
    grades, sources = _BAND_FILTERS[band]
    m = unified_assessments(inputs).where(F.col("grade").isin(grades) & F.col("data_source").isin(sources))
    st = _roster_with_text_key(inputs)
    # the source writes a LEFT JOIN but filters on the right side, so it is an inner join
    j = st.join(m, (st["__student_text"] == m["local_student_id"]) & (st["__st_year"] == m["year"]), "inner")
    return j.select(
        F.col("__st_year").cast("string").alias("year"),
        F.col("elastatus").cast("string"),
        *[F.col(t).cast("string") for t in _BAND_TEACHERS[band]],
        *[F.col(c).cast("string") for c in _ROSTER_TAIL],
        F.col("grade_level").cast("bigint").alias("grade_level"),
        F.col("student_number").cast("bigint").alias("student_number"),
        "data_source", "curriculum", "proficiency", "standard_code", "test_type", "unit", "title",
        safe_long("score").alias("score"),
    )


def assessments_elementary(inputs: Inputs) -> DataFrame:
    return assessments_by_band(inputs, "elementary")


def assessments_middle(inputs: Inputs) -> DataFrame:
    return assessments_by_band(inputs, "middle")


def assessments_high(inputs: Inputs) -> DataFrame:
    return assessments_by_band(inputs, "high")


def curriculum_assessments(inputs: Inputs) -> DataFrame:
    """Illuminate percent-correct results in core subjects, excluding checkpoints and exit tickets."""
    e = assessments_elementary(inputs)
    return e.where(
        (norm("data_source") == "illuminate")
        & norm("curriculum").isin("ela", "math", "science")
        & F.lower(F.col("standard_code").cast("string")).contains("percent")
        & ~F.coalesce(norm("test_type"), F.lit("")).isin("checkpoint", "exit ticket")
    )


DIAG_COLUMNS = [
    f"{term}_{measure}" for term in ("boy", "moy", "eoy")
    for measure in ("composite_dibels", "ela_overall_relative_placement", "math_overall_relative_placement")
]


def richest_diagnostic(diag: DataFrame) -> DataFrame:
    """One diagnostic row per student: most non-null end-of-year fields, then middle, then beginning."""
    from kestrel.functions.columns import non_null_count

    keyed = diag.withColumn("__key", F.col("local_student_id").cast("string"))
    order = [non_null_count(*[f"{t}_{m}" for m in ("composite_dibels", "ela_overall_relative_placement",
                                                 "math_overall_relative_placement")]).desc() for t in ("eoy", "moy", "boy")]
    return best_row(keyed, ["__key"], order, all_columns_tiebreak(diag)).drop("local_student_id")


def verified_assessments(inputs: Inputs) -> DataFrame:
    """iReady/DIBELS results per rostered student with their richest diagnostic row; score/label split."""
    m = unified_assessments(inputs).where(norm("data_source").isin("iready", "dibels"))
    st = _roster_with_text_key(inputs).where(F.col("grade_level").between(0, 12))
    d = richest_diagnostic(inputs["diagnostics"])
    j = st.join(m, (st["__student_text"] == m["local_student_id"]) & (st["__st_year"] == m["year"]), "inner")
    j = j.join(d, j["__student_text"] == d["__key"], "left")
    score, proficiency = score_label_split(F.col("score"), F.col("proficiency"))
    dc = lambda c: F.col(c).cast("string").alias(c)
    return j.select(
        F.col("__st_year").cast("string").alias("year"),
        dc("elastatus"), dc("english_teacher"), dc("math_teacher"), dc("lastfirst"), dc("school_name"),
        dc("sped_identifier"), dc("absenteeism_status"), dc("hit_tutoring"),
        F.col("grade_level").cast("bigint").alias("grade_level"),
        F.col("student_number").cast("bigint").alias("student_number"),
        dc("boy_composite_dibels"), dc("boy_ela_overall_relative_placement"), dc("boy_math_overall_relative_placement"),
        dc("data_source"), dc("curriculum"), dc("unit"),
        dc("eoy_composite_dibels"), dc("eoy_ela_overall_relative_placement"), dc("eoy_math_overall_relative_placement"),
        dc("moy_composite_dibels"), dc("moy_ela_overall_relative_placement"), dc("moy_math_overall_relative_placement"),
        score.alias("score"),
        proficiency.cast("string").alias("proficiency"),
        dc("standard_code"),
    )
