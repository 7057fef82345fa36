"""Data-quality queries declared for the sources and models (failing rows / per-check counts)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kestrel.functions.columns import norm
from kestrel.operators.checks import (
    RowCheck, accepted_range, accepted_values, duplicate_keys, missing_required_values, not_null, summarize,
)
from kestrel.operators.stack import union_all
from kestrel.plans import alignment, meals, operations, state_testing
from kestrel.session import checkpoint_dir
from kestrel.sources.registry import Inputs

ELIGIBILITY_CATEGORIES = ["Direct Certification", "Homeless", "Migrant", "Foster", "Meal Application"]
# invented school names standing in for the required list (parameter)
REQUIRED_SCHOOLS = ["School 0", "School 2", "School 4", "School 6", "School 8"]


def roster_source_checks(inputs: Inputs) -> DataFrame:
    r = inputs["roster"]
    return summarize(r, [not_null("student_number"), not_null("lastfirst")], unique=[["student_number", "year", "grade_level"]])


def state_results_source_checks(inputs: Inputs) -> DataFrame:
    return summarize(inputs["state_results_snake"], [not_null("studentidentifier"), not_null("student_number")])


def school_coverage(inputs: Inputs, required: list[str] | None = None) -> DataFrame:
    """Required school names missing from the state results."""
    snake = inputs["state_results_snake"]
    return missing_required_values(snake.sparkSession, snake, "schoolname", required or REQUIRED_SCHOOLS)


def elpac_reload_duplicates(inputs: Inputs) -> DataFrame:
    """Identical summative ELPAC reloads (same student, subject, submit time)."""
    log = inputs["state_results_pascal"]
    return duplicate_keys(
        log, ["student_number", "Subject", "SubmitDateTime"],
        where=norm("Subject").contains("elpac") & (norm("AssessmentType") == "summative"),
    )


def cast_duplicates(inputs: Inputs, model: DataFrame | None = None) -> DataFrame:
    model = model if model is not None else state_testing.cast_tabular(inputs)
    return duplicate_keys(model, ["year", "studentidentifier", "assessmentname"],
                          where=F.col("studentidentifier").isNotNull())


def sbac_duplicates(inputs: Inputs, model: DataFrame | None = None) -> DataFrame:
    model = model if model is not None else state_testing.sbac_tabular(inputs)
    return duplicate_keys(model, ["year", "studentidentifier"], where=F.col("studentidentifier").isNotNull())


def elpac_duplicates(inputs: Inputs) -> DataFrame:
    return duplicate_keys(state_testing.elpac_growth(inputs), ["student_number", "elpac_track"],
                          where=F.col("student_number").isNotNull())


def state_testing_year_checks(inputs: Inputs, cast_model: DataFrame | None = None,
                              sbac_model: DataFrame | None = None) -> DataFrame:
    years = ["24-25", "25-26"]
    cast_model = cast_model if cast_model is not None else state_testing.cast_tabular(inputs)
    sbac_model = sbac_model if sbac_model is not None else state_testing.sbac_tabular(inputs)
    c = summarize(cast_model, [not_null("year"), accepted_values("year", years)])
    s = summarize(sbac_model, [not_null("year"), accepted_values("year", years)])
    return c.select(F.concat(F.lit("cast_tabular."), "check").alias("check"), "failing_rows").unionByName(
        s.select(F.concat(F.lit("sbac_tabular."), "check").alias("check"), "failing_rows"))


def meal_checks(inputs: Inputs) -> DataFrame:
    best = summarize(meals.meal_applications_best(inputs), [not_null("student_id"), not_null("academic_year")],
                     unique=[["student_id", "academic_year"]])
    cov = summarize(
        meals.meal_coverage_roster(inputs),
        [not_null("student_id"), not_null("academic_year"),
         accepted_values("eligibility_category", ELIGIBILITY_CATEGORIES, where="eligibility_category IS NOT NULL")],
        unique=[["student_id", "academic_year"]],
    )
    return best.select(F.concat(F.lit("meal_applications_best."), "check").alias("check"), "failing_rows").unionByName(
        cov.select(F.concat(F.lit("meal_coverage_roster."), "check").alias("check"), "failing_rows"))


def ixl_checks(inputs: Inputs) -> DataFrame:
    return summarize(operations.ixl_scores(inputs), [
        not_null("local_student_id"), not_null("skill_name"), not_null("score"), accepted_range("score", 0, 100),
        not_null("subject"), not_null("curriculum"),
    ])


def participation_date_check(inputs: Inputs) -> DataFrame:
    """Participation dates that are missing, or that the strict ``yyyy-MM-dd`` parser would reject (one such row fails the view)."""
    day = F.col("participation_date")
    strict = RowCheck("strict_date:participation_date", day.isNotNull() & F.try_to_date(day, "yyyy-MM-dd").isNull())
    return summarize(inputs["meal_participation"], [strict, not_null("participation_date")])


def roster_subject_checks(inputs: Inputs) -> DataFrame:
    return summarize(alignment.roster_subject_assignment(inputs),
                     [not_null("student_number"), not_null("course_name"), not_null("subject")])


def reload_unusable_numbers(inputs: Inputs) -> DataFrame:
    """Per assessment: reload-log rows whose student number is NULL or 0.

    The latest-row rule partitions on the number, so all such rows of one assessment collapse to
    a single row; and 0 joins 0 in the prior-year match.  Counted, not changed.
    """
    log = inputs["state_results_pascal"]
    n = F.col("student_number")
    return log.where(n.isNull() | (n == 0)).groupBy("AssessmentName").agg(
        F.sum(F.when(n.isNull(), 1).otherwise(0)).cast("bigint").alias("null_number_rows"),
        F.sum(F.when(n == 0, 1).otherwise(0)).cast("bigint").alias("zero_number_rows"),
    )


# ---- the whole test run: one frame (check, failing_rows) -----------------------------------------
#: checks that already report (check, failing_rows)
SUMMARY_CHECKS = {
    "check_roster_source": roster_source_checks,
    "check_state_results_source": state_results_source_checks,
    "check_state_testing_years": state_testing_year_checks,
    "check_meals": meal_checks,
    "check_ixl_scores": ixl_checks,
    "check_participation_dates": participation_date_check,
    "check_roster_subjects": roster_subject_checks,
}
#: checks that return their failing rows (the result of a check is their count)
ROW_CHECKS = {
    "check_school_coverage": school_coverage,
    "check_elpac_reload_duplicates": elpac_reload_duplicates,
    "check_cast_duplicates": cast_duplicates,
    "check_sbac_duplicates": sbac_duplicates,
    "check_elpac_duplicates": elpac_duplicates,
    "check_reload_unusable_numbers": reload_unusable_numbers,
}


def checked_write(df: DataFrame, path: str, checks: list[RowCheck]) -> list[tuple[str, int]]:
    """Write ``df`` to ``path`` and count the failing rows of each check on the way: (check name, failing rows).

    The counts are metrics observed on the write itself, so no check costs a pass of its own.
    """
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    counts = [F.count_if(F.coalesce(c.fails, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    return [(c.name, seen.get[f"c{i}"]) for i, c in enumerate(checks)]


def _years() -> list[RowCheck]:
    return [not_null("year"), accepted_values("year", ["24-25", "25-26"])]


@dataclass(frozen=True)
class ModelChecks:
    """What is checked of one model: row checks and unique keys under ``label``, duplicate grains under names of their own."""

    model: Callable[[Inputs], DataFrame]
    label: str
    checks: Callable[[], list[RowCheck]] = list
    unique: tuple[tuple[str, ...], ...] = ()
    duplicates: tuple[tuple[str, tuple[str, ...], str], ...] = ()  # (check, keys, column that must be set)

    def columns(self) -> list[str]:
        named = [c.name.split(":", 1)[1] for c in self.checks()]
        keys = [k for ks in self.unique for k in ks] + [k for _, ks, c in self.duplicates for k in (*ks, c)]
        return list(dict.fromkeys([*named, *keys]))


MODEL_CHECKS = [
    ModelChecks(state_testing.cast_tabular, "check_state_testing_years.cast_tabular.", _years,
                duplicates=(("check_cast_duplicates", ("year", "studentidentifier", "assessmentname"), "studentidentifier"),)),
    ModelChecks(state_testing.sbac_tabular, "check_state_testing_years.sbac_tabular.", _years,
                duplicates=(("check_sbac_duplicates", ("year", "studentidentifier"), "studentidentifier"),)),
    ModelChecks(state_testing.elpac_growth, "", duplicates=(("check_elpac_duplicates", ("student_number", "elpac_track"), "student_number"),)),
    ModelChecks(meals.meal_applications_best, "check_meals.meal_applications_best.", lambda: [not_null("student_id"), not_null("academic_year")],
                unique=(("student_id", "academic_year"),)),
    ModelChecks(meals.meal_coverage_roster, "check_meals.meal_coverage_roster.", lambda: [
        not_null("student_id"), not_null("academic_year"), accepted_values("eligibility_category", ELIGIBILITY_CATEGORIES, where="eligibility_category IS NOT NULL")],
        unique=(("student_id", "academic_year"),)),
    ModelChecks(operations.ixl_scores, "check_ixl_scores.", lambda: [
        not_null("local_student_id"), not_null("skill_name"), not_null("score"), accepted_range("score", 0, 100), not_null("subject"), not_null("curriculum")]),
    ModelChecks(alignment.roster_subject_assignment, "check_roster_subjects.", lambda: [not_null("student_number"), not_null("course_name"), not_null("subject")]),
]
#: checks of the inputs themselves: one pass each
SOURCE_SUMMARIES = {k: SUMMARY_CHECKS[k] for k in ("check_roster_source", "check_state_results_source", "check_participation_dates")}
SOURCE_ROWS = {k: ROW_CHECKS[k] for k in ("check_school_coverage", "check_elpac_reload_duplicates", "check_reload_unusable_numbers")}


def all_checks(inputs: Inputs) -> DataFrame:
    """Every declared check in one frame ``(check, failing_rows)``; zero everywhere means the run passes.

    Each model is built once: its checked columns are written to the shared folder, row checks are counted on that
    write, and key checks read the narrow table it leaves.
    """
    spark = inputs["roster"].sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/kestrel-checks/{uuid.uuid4().hex}"
    counted, frames = [], []
    for i, m in enumerate(MODEL_CHECKS):
        path = f"{root}/{i}"
        narrow = m.model(inputs).select(m.columns())
        counted += [(m.label + name, n) for name, n in checked_write(narrow, path, m.checks())]
        written = spark.read.schema(narrow.schema).parquet(path)
        for keys in m.unique:
            repeated = duplicate_keys(written, keys).agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("failing_rows"))
            frames.append(repeated.select(F.lit(f"{m.label}unique_combination:{'+'.join(keys)}").alias("check"), "failing_rows"))
        for check, keys, set_column in m.duplicates:
            groups = duplicate_keys(written, keys, where=F.col(set_column).isNotNull()).agg(F.count(F.lit(1)).alias("failing_rows"))
            frames.append(groups.select(F.lit(check).alias("check"), "failing_rows"))
    frames += [fn(inputs).select(F.concat(F.lit(f"{key}."), F.col("check")).alias("check"), F.col("failing_rows").cast("bigint").alias("failing_rows"))
               for key, fn in SOURCE_SUMMARIES.items()]
    frames += [fn(inputs).agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(key).alias("check"), "failing_rows") for key, fn in SOURCE_ROWS.items()]
    return union_all([spark.createDataFrame(counted, "check string, failing_rows bigint"), *frames])
