"""Enrollment against budget: detail per school-grade, school totals, five subgroup cuts (long form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.rollup import subgroup_counts
from kestrel.sources.registry import Inputs

SUBGROUPS = ["race", "elastatus", "sped_identifier", "absenteeism_status", "frlstatus"]
_HEADS = "__heads"  # the cut that counts everybody


def _ratio(num, den):
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), 3)


def enrollment_demographics(inputs: Inputs, year: str = "25-26", ordered: bool = True) -> DataFrame:
    """Budget detail with head counts, a total per school over its detail, and the counts of five subgroup cuts.

    One linear plan over two scans: the head count is one more cut of the roster's single aggregation, the budget
    rows meet it in one full join, and the school totals come from a second grouping set of the same rows.
    """
    roster = inputs["roster"].where(F.col("year") == year).withColumn("grade_level", F.col("grade_level").cast("string"))
    counts = subgroup_counts(roster.withColumn(_HEADS, F.lit("")), ["school_name", "year", "grade_level"], [*SUBGROUPS, _HEADS])
    b = inputs["budget"]
    seats = b.select(F.col("school_name").alias("b_school"), F.col("grade_level").cast("string").alias("b_grade"), F.lit(_HEADS).alias("b_cut"),
                     F.col("budgeted_enrollment").cast("bigint").alias("budgeted_enrollment"), F.lit(True).alias("is_detail"))
    met = counts.join(seats, (counts["school_name"] == seats["b_school"]) & (counts["grade_level"] == seats["b_grade"]) & (counts["subgroup"] == seats["b_cut"]), "full")
    detail = F.coalesce(F.col("is_detail"), F.lit(False))
    budgeted = F.col("budgeted_enrollment")
    rows = met.where(detail | (F.col("subgroup") != _HEADS)).select(  # heads of a school-grade without a budget row go
        F.when(detail, F.col("b_school")).otherwise(F.col("school_name")).alias("school_name"), F.lit(year).alias("year"),
        F.when(detail, F.col("b_grade")).otherwise(F.col("grade_level")).alias("grade_level"),
        F.when(detail, F.lit("")).otherwise(F.col("subgroup")).alias("subgroup"), F.when(detail, F.lit("")).otherwise(F.col("demographic")).alias("demographic"),
        "student_count", "budgeted_enrollment", (budgeted - F.col("student_count")).alias("seats_remaining"), detail.alias("is_detail"))
    sums = ["student_count", "budgeted_enrollment", "seats_remaining"]
    own = [F.col(c) for c in rows.columns]
    both = rows.groupingSets([own, own[:2]], *own).agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("times"), F.count_if("is_detail").alias("details"),
        *[F.sum(F.when(F.col("is_detail"), F.col(c))).alias(f"total_{c}") for c in sums])
    total = F.col("level") > 0
    # a total per school that has budget rows; equal rows stay as often as they came
    out = both.where(~total | (F.col("details") > 0)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.when(total, F.lit(1).cast("bigint")).otherwise(F.col("times")))))
    value = {c: F.when(total, F.col(f"total_{c}")).otherwise(F.col(c)) for c in sums}
    shown = out.select(
        "school_name", "year", F.when(total, F.lit("total")).otherwise(F.col("grade_level")).alias("grade_level"),
        F.when(total, F.lit("")).otherwise(F.col("subgroup")).alias("subgroup"), F.when(total, F.lit("")).otherwise(F.col("demographic")).alias("demographic"),
        *[v.alias(c) for c, v in value.items()], _ratio(value["student_count"], value["budgeted_enrollment"]).alias("percent_of_seats_filled"))
    return shown.orderBy("school_name", "grade_level", "subgroup", "demographic") if ordered else shown
