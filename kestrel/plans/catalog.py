"""Query catalog: name → (pipeline function, logical inputs it reads)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.plans import alignment, assessments, enrollment, meals, operations, primitives, quality, state_testing
from kestrel.session import checkpoint_dir, configure
from kestrel.sources.registry import load_inputs, register, unregister
from kestrel.sources.sinks import as_table, as_view, read_table, run_sql, vacuum

CATALOG: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "pear_best_submission": (operations.pear_best_submission, ["assignment_updates"]),
    "incoming_students": (operations.incoming_students, ["incoming_2025", "incoming_2026"]),
    "application_pipeline": (operations.application_pipeline, ["pipeline_2025", "pipeline_2026"]),
    "completed_registrations": (operations.completed_registrations, ["registrations_2025", "registrations_2026"]),
    "ixl_scores": (operations.ixl_scores, ["ixl_scores", "ixl_skill_names", "ixl_archive"]),
    "grade_audit": (operations.grade_audit, ["stored_grades", "roster_snapshots", "course_category", "teacher_aliases"]),
    "meal_applications_best": (meals.meal_applications_best, ["meal_applications"]),
    "meal_coverage_roster": (meals.meal_coverage_roster, ["roster", "meal_applications"]),
    "meals_with_application": (meals.meals_with_application, ["meal_applications", "meal_participation"]),
    "enrollment_demographics": (enrollment.enrollment_demographics, ["roster", "budget"]),
    "interim_ica": (assessments.interim_ica, ["state_results_pascal", "roster"]),
    "unified_assessments": (assessments.unified_assessments, assessments.UNIFIED_INPUTS),
    "assessments_elementary": (assessments.assessments_elementary, assessments.UNIFIED_INPUTS),
    "assessments_middle": (assessments.assessments_middle, assessments.UNIFIED_INPUTS),
    "assessments_high": (assessments.assessments_high, assessments.UNIFIED_INPUTS),
    "curriculum_assessments": (assessments.curriculum_assessments, assessments.UNIFIED_INPUTS),
    "verified_assessments": (assessments.verified_assessments, assessments.UNIFIED_INPUTS + ["diagnostics"]),
    "cast_tabular": (state_testing.cast_tabular, ["state_results_snake", "state_results_pascal", "roster", "cast_archive"]),
    "sbac_tabular": (state_testing.sbac_tabular, ["state_results_snake", "state_results_2324", "state_results_pascal",
                                                  "roster", "intervention", "sbac_archive"]),
    "elpac_growth": (state_testing.elpac_growth, ["state_results_pascal", "state_results_snake", "roster", "cut_scores"]),
    "align_and_stack_two_years": (alignment.align_and_stack_two_years, ["state_results_2425_full", "state_results_2526_full"]),
    "roster_subject_assignment": (alignment.roster_subject_assignment, ["stored_grades", "roster_snapshots"]),
    "check_roster_source": (quality.roster_source_checks, ["roster"]),
    "check_state_results_source": (quality.state_results_source_checks, ["state_results_snake"]),
    "check_school_coverage": (quality.school_coverage, ["state_results_snake"]),
    "check_elpac_reload_duplicates": (quality.elpac_reload_duplicates, ["state_results_pascal"]),
    "check_cast_duplicates": (quality.cast_duplicates, ["state_results_snake", "state_results_pascal", "roster", "cast_archive"]),
    "check_sbac_duplicates": (quality.sbac_duplicates, ["state_results_snake", "state_results_2324", "state_results_pascal",
                                                        "roster", "intervention", "sbac_archive"]),
    "check_elpac_duplicates": (quality.elpac_duplicates, ["state_results_pascal", "state_results_snake", "roster", "cut_scores"]),
    "check_state_testing_years": (quality.state_testing_year_checks, ["state_results_snake", "state_results_2324",
                                                                      "state_results_pascal", "roster", "intervention",
                                                                      "sbac_archive", "cast_archive"]),
    "check_meals": (quality.meal_checks, ["roster", "meal_applications"]),
    "check_ixl_scores": (quality.ixl_checks, ["ixl_scores", "ixl_skill_names", "ixl_archive"]),
    "check_participation_dates": (quality.participation_date_check, ["meal_participation"]),
    "check_roster_subjects": (quality.roster_subject_checks, ["stored_grades", "roster_snapshots"]),
    "check_reload_unusable_numbers": (quality.reload_unusable_numbers, ["state_results_pascal"]),
    "check_all": (quality.all_checks, ["roster", "state_results_snake", "state_results_2324", "state_results_pascal",
                                       "intervention", "sbac_archive", "cast_archive", "cut_scores", "meal_applications",
                                       "meal_participation", "ixl_scores", "ixl_skill_names", "ixl_archive",
                                       "stored_grades", "roster_snapshots"]),
    # single-operator queries (each operator alone over whole inputs)
    "keep_best_latest": (primitives.keep_best_latest, ["state_results_pascal"]),
    "keep_best_ranked": (primitives.keep_best_ranked, ["meal_applications"]),
    "keep_best_richest": (primitives.keep_best_richest, ["diagnostics"]),
    "anti_any_key": (primitives.anti_any_key_query, ["sbac_archive", "state_results_snake"]),
    "overlay_archive": (primitives.overlay_archive, ["state_results_snake", "cast_archive"]),
    "conditional_key_join": (primitives.conditional_key_join_query, ["state_results_pascal", "state_results_snake"]),
    "band_lookup_join": (primitives.band_lookup_join, ["state_results_snake", "cut_scores"]),
    "full_outer_coalesce": (primitives.full_outer_coalesce, ["state_results_snake"]),
    "roster_right_join": (primitives.roster_right_join, ["state_results_snake", "roster"]),
    "latest_snapshot": (primitives.latest_snapshot, ["stored_grades"]),
    "max_per_key": (primitives.max_per_key, ["state_results_snake"]),
    "distinct_rows": (primitives.distinct_rows, ["state_results_pascal"]),
    "subgroup_counts": (primitives.subgroup_counts, ["roster"]),
    "safe_cast_suite": (primitives.safe_cast_suite, ["state_results_pascal"]),
    "text_suite": (primitives.text_suite, ["roster"]),
    "date_suite": (primitives.date_suite, ["meal_applications"]),
    "conditional_suite": (primitives.conditional_suite, ["roster"]),
    "grade_band": (primitives.grade_band_query, ["state_results_snake"]),
}


#: views the source project switches off (disabled, or body commented out); built here, skipped by ``build_all``
DISABLED_IN_SOURCE = {"meals_with_application", "align_and_stack_two_years", "roster_subject_assignment"}
#: persisted as a table (full overwrite); every other model is a view, re-evaluated when read
TABLES = {"grade_audit"}


def is_enabled(name: str) -> bool:
    return name not in DISABLED_IN_SOURCE


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn, names = CATALOG[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(load_inputs(spark, sf_dir, names))

    run.__name__ = name
    return run


def build(spark: SparkSession, name: str, sf_dir: str, table_root: str) -> DataFrame:
    """Materialise one model as the source project declares it: a table (overwrite) or a temp view."""
    if name in TABLES:
        path = f"{table_root.rstrip('/')}/{name}"
        as_table(runner(name)(spark, sf_dir), path)
        return as_view(spark, name, lambda s: read_table(s, path))
    return as_view(spark, name, lambda s: runner(name)(s, sf_dir))


def grade_audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``grade_audit`` written as a table, replaced by itself (a table may read its own rows), and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/kestrel-tables/grade_audit-{uuid.uuid4().hex}"
    build(spark, "grade_audit", sf_dir, path)
    table = f"{path}/grade_audit"
    as_table(read_table(spark, table), table)
    vacuum(spark, table)
    return read_table(spark, table)


def enrollment_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``enrollment_demographics`` as a view, read through SQL over its sources as they are."""
    build(spark, "enrollment_demographics", sf_dir, "")
    return run_sql(spark, "SELECT * FROM enrollment_demographics")


def file_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines under a logical name of their own, each with the file it came from; rows and keys per file."""
    register("order_lines", f"{sf_dir.rstrip('/')}/lineitem.parquet", provenance_column="source_file")
    try:
        lines = load_inputs(spark, sf_dir, ["order_lines"])["order_lines"]
    finally:
        unregister("order_lines")
    return lines.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"), F.max("l_orderkey").alias("max_orderkey"),
                                            F.countDistinct("l_suppkey").alias("suppliers"))


#: queries over the sources and sinks themselves
SINK_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (grade_audit_table, enrollment_view, file_provenance)
}


def build_all(spark: SparkSession, sf_dir: str, table_root: str, *, include_disabled: bool = False) -> list[str]:
    """Build every enabled model (views are lazy; tables are written once)."""
    names = [n for n in CATALOG if include_disabled or is_enabled(n)]
    for n in names:
        build(spark, n, sf_dir, table_root)
    return names
