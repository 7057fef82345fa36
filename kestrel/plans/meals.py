"""School-meal eligibility: best application per student-year, roster coverage, meals served."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import (
    parse_iso_offset, rank_of, round_to_long, school_year_from_date, school_year_from_roster_year, split_part, trimmed, utc_date,
)
from kestrel.functions.rules import (
    APPLICATION_STATUS_ORDER, ELIGIBILITY_CATEGORY_ORDER, RANK_DEFAULT, eligibility_category, homeless_backfill,
)
from kestrel.operators.dedupe import keep_best
from kestrel.operators.joins import equi_join
from kestrel.sources.registry import Inputs

BACKFILL_YEAR = "2026-2027"


def _with_int_student(df: DataFrame) -> DataFrame:
    # float ids: round half away from zero, keep the column position
    return df.withColumn("student_id", round_to_long("student_id"))


def meal_applications_best(inputs: Inputs) -> DataFrame:
    """One application per (student, raw academic_year): best status, then latest application time."""
    apps = _with_int_student(inputs["meal_applications"].where(F.col("student_id").isNotNull()))
    ts = parse_iso_offset("application_date")
    best = keep_best(
        apps.withColumn("application_date_parsed", utc_date(ts)).withColumn("__ts", ts),
        ["student_id", "academic_year"],
        [rank_of("application_status", APPLICATION_STATUS_ORDER, RANK_DEFAULT).asc(), F.col("__ts").desc_nulls_last()],
        [F.col("mealapplicationid").desc()],
    )
    return best.select(
        "student_id",
        F.col("personid").alias("person_id"),
        F.col("familymealapplicationid").alias("family_meal_application_id"),
        F.col("mealapplicationid").alias("meal_application_id"),
        "school",
        "grade",
        "application_status",
        (F.col("application_status") == "Processed").alias("is_finalized"),
        "eligibility_type",
        "eligibility_benefit_type",
        F.col("application_date_parsed").alias("application_date"),
        "academic_year",
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
    )


def best_meal_record(apps: DataFrame) -> DataFrame:
    """Best record per (student, normalised year): category, status, latest time, highest id."""
    ts = parse_iso_offset("application_date")
    cat = (
        _with_int_student(apps.where(F.col("student_id").isNotNull()))
        .withColumn("academic_year", F.replace(F.col("academic_year"), F.lit("/"), F.lit("-")))
        .withColumn("application_date_parsed", utc_date(ts))
        .withColumn("eligibility_category", eligibility_category("eligibility_benefit_type"))
        .withColumn("__ts", ts)
    )
    return keep_best(
        cat,
        ["student_id", "academic_year"],
        [
            rank_of("eligibility_category", ELIGIBILITY_CATEGORY_ORDER, RANK_DEFAULT).asc(),
            rank_of("application_status", APPLICATION_STATUS_ORDER, RANK_DEFAULT).asc(),
            F.col("__ts").desc_nulls_last(),
            F.col("mealapplicationid").desc_nulls_last(),
        ],
    ).drop("__ts")


def meal_coverage_roster(inputs: Inputs, backfill_year: str = BACKFILL_YEAR, first_year: str = "25-26") -> DataFrame:
    """Every roster student-year from ``first_year`` on, with the best meal record or a homeless backfill."""
    r = inputs["roster"].where((F.col("year") >= first_year) & F.col("student_number").isNotNull())
    roster = keep_best(
        r.select(
            F.col("student_number").cast("bigint").alias("student_number"),
            F.col("year").alias("roster_year"),
            school_year_from_roster_year("year").alias("academic_year"),
            "school_name", "grade_level", "lastfirst", "ishomeless",
        ),
        ["student_number", "roster_year"],
        [F.col("school_name").asc_nulls_first()],
        [F.col("grade_level").asc_nulls_first(), F.col("lastfirst").asc_nulls_first(), F.col("ishomeless").asc_nulls_first()],
    )
    best = best_meal_record(inputs["meal_applications"])
    m = best.select([F.col(c).alias(f"m_{c}") for c in best.columns])
    j = roster.join(
        m,
        (roster["student_number"] == m["m_student_id"]) & (roster["academic_year"] == m["m_academic_year"]),
        "left",
    )
    flag = homeless_backfill("academic_year", "ishomeless", backfill_year)
    fill = lambda v: F.when(flag, v)
    return j.select(
        F.col("student_number").alias("student_id"),
        F.col("m_personid").alias("person_id"),
        F.col("m_familymealapplicationid").alias("family_meal_application_id"),
        F.col("m_mealapplicationid").alias("meal_application_id"),
        F.col("school_name").alias("school"),
        F.col("grade_level").alias("grade"),
        F.coalesce(F.col("m_application_status"), fill(F.lit("Processed"))).alias("application_status"),
        F.coalesce(F.col("m_application_status") == "Processed", fill(F.lit(True))).alias("is_finalized"),
        F.col("m_eligibility_type").alias("eligibility_type"),
        F.coalesce(F.col("m_eligibility_benefit_type"), fill(F.lit("Homeless"))).alias("eligibility_benefit_type"),
        F.coalesce(F.col("m_eligibility_category"), fill(F.lit("Homeless"))).alias("eligibility_category"),
        F.col("m_application_date_parsed").alias("application_date"),
        "academic_year",
        F.coalesce(F.col("m_firstname"), F.nullif(trimmed(split_part("lastfirst", ",", 1, safe=True)), F.lit(""))).alias("first_name"),
        F.coalesce(F.col("m_lastname"), F.nullif(trimmed(split_part("lastfirst", ",", 0, safe=True)), F.lit(""))).alias("last_name"),
        F.when(F.col("m_student_id").isNotNull(), F.lit(False)).when(flag, F.lit(False)).otherwise(F.lit(True)).alias("needs_application"),
    )


def meals_with_application(inputs: Inputs) -> DataFrame:
    """Every meal served, with the student's preferred application for the meal's school year.

    (Disabled in the source project; built here with the same semantics.)  The date parser is
    strict: one malformed participation date fails the job, as in the source.
    """
    apps = _with_int_student(inputs["meal_applications"].where(F.col("student_id").isNotNull()))
    latest = keep_best(
        apps,
        ["student_id", "academic_year"],
        [F.when(F.col("application_status") == "Processed", 0).otherwise(1).asc(), F.col("application_date").desc_nulls_last()],
        [F.col("mealapplicationid").desc()],
    ).select(
        F.col("student_id").alias("a_student_id"), F.col("academic_year").alias("a_academic_year"),
        "application_status", F.col("eligibility_type").alias("application_eligibility_type"), "application_date",
    )
    p = inputs["meal_participation"]
    p = p.withColumn("student_id_int", round_to_long("student_id")).withColumn(
        "academic_year", school_year_from_date(F.to_date(F.col("participation_date"), "yyyy-MM-dd"))
    )
    # rows without a student id can never match: salted so they do not pile up in one partition
    j = equi_join(p, latest, [("student_id_int", "a_student_id"), ("academic_year", "a_academic_year")], "left")
    return j.select(
        F.col("student_id_int").alias("student_id"), "participation_date", "meal_type", "school", "grade",
        "eligibility_at_meal", "application_status", "application_eligibility_type", "application_date",
        "academic_year", F.col("personid").alias("person_id"), F.col("customerdocumentid").alias("customer_document_id"),
    )
