"""Operational views: best assignment submission, enrollment snapshots, skill scores, grade audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.rules import normalized_grade
from kestrel.operators.dedupe import keep_best
from kestrel.operators.stack import stack_tagged, union_distinct
from kestrel.sources.registry import Inputs


def pear_best_submission(inputs: Inputs) -> DataFrame:
    """One row per (assessment, student, teacher) among DONE assignments: graded first, then latest.

    The helper column ``rn`` stays in the output, as in the source view.
    """
    u = inputs["assignment_updates"].where(F.col("assignment_status") == "DONE")
    best = keep_best(
        u,
        ["assessment_id", "user_id", "teacher_username"],
        [F.when(F.col("status") == "GRADED", 1).otherwise(0).desc(), F.col("submitted_date").desc_nulls_last()],
        [F.col("event_id").desc()],
        rank_column="rn",
    )
    return best.withColumn("rn", F.col("rn").cast("bigint"))


def incoming_students(inputs: Inputs) -> DataFrame:
    return stack_tagged({"24-25": inputs["incoming_2025"], "25-26": inputs["incoming_2026"]})


def application_pipeline(inputs: Inputs) -> DataFrame:
    return stack_tagged({"24-25": inputs["pipeline_2025"], "25-26": inputs["pipeline_2026"]})


def completed_registrations(inputs: Inputs) -> DataFrame:
    """Stack two snapshots whose ``race`` differs in type: cast to text in place first."""
    frames = {
        year: df.withColumn("race", F.col("race").cast("string"))
        for year, df in (("24-25", inputs["registrations_2025"]), ("25-26", inputs["registrations_2026"]))
    }
    return stack_tagged(frames)


def ixl_scores(inputs: Inputs, year: str = "24-25") -> DataFrame:
    """Live scores joined to their skill (name + subject), plus the archive; distinct rows."""
    s, n = inputs["ixl_scores"], inputs["ixl_skill_names"]
    live = s.join(n, ["skill_name", "subject"], "inner").select(
        "local_student_id", "skill_name", "date_assigned", "score", "subject", "curriculum", F.lit(year).alias("year")
    )
    archive = inputs["ixl_archive"].select(
        "local_student_id", "skill_name", "date_assigned", "score", "subject", "curriculum", F.lit(year).alias("year")
    )
    return union_distinct([live, archive])


def grade_audit(inputs: Inputs) -> DataFrame:
    """Stored grades of the latest roster snapshot, with course category, clean teacher name, letter grade.

    The snapshot time is a scalar subquery, so it lands in the grade scan's filters
    (partition pruning when the table is partitioned by ``partitiontime``).
    """
    latest = inputs["roster_snapshots"].select(F.max("partitiontime")).scalar()
    sg = inputs["stored_grades"].where(F.col("partitiontime") == latest)
    cc = inputs["course_category"]
    out = sg.join(
        cc.select(F.col("course_name").alias("cc_course"), F.col("grade_level").cast("string").alias("cc_grade"), "category"),
        (F.col("course_name") == F.col("cc_course")) & (F.col("grade_level").cast("string") == F.col("cc_grade")),
        "inner",
    ).drop("cc_course", "cc_grade")
    names = inputs["teacher_aliases"].select(
        F.concat(F.col("last_name"), F.lit(", "), F.col("first_name")).alias("placeholder"),
        F.col("teacher_name").alias("clean_name"),
    )
    joined = out.join(names, out["teacher_name"] == names["placeholder"], "left")
    rest = [c for c in out.columns if c != "teacher_name"]
    return joined.select(
        F.coalesce(F.col("clean_name"), F.col("teacher_name")).alias("teacher_name"),
        *rest,
        normalized_grade("grade").alias("normalized_grade"),
    )
