"""Schema alignment across feed dialects, and subject assignment from the latest roster snapshot.

Both models are switched off in the source project; they are built here as generic forms
(naming rule and target schema; contains filter + name → subject lookup).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.columns import qcol, safe_double, split_part, trimmed
from kestrel.operators.stack import union_all
from kestrel.sources.registry import Inputs

# the 68 columns of a year's results, in their order (fixed values); all are text but those of the two sets below
TARGET_COLUMNS = [
    "studentidentifier", "firstname", "lastorsurname", "submitdatetime", "testsessionid", "schoolname", "schoolyear", "assessmenttype",
    "assessmentname", "subject", "gradelevelwhenassessed", "status", "scalescoreachievementlevel", "reporting_category", "scalescore",
    "error_band_min", "error_band_max", "lexilemeasure", "lexilerangemin", "lexilerangemax", "quantilemeasure", "quantilerangemin",
    "quantilerangemax", "elpac__oral_language_level", "elpac__oral_language_scale_score", "elpac__oral_language_standard_error",
    "elpac__written_language_level", "elpac__written_language_scale_score", "elpac__written_language_standard_error",
    "math__concepts_and_procedures", "math__mathematical_practices", "ela__reading_and_listening", "ela__writing_and_research",
    "math__concepts_and_procedures_1", "math__problem_solving_and_modeling___data_analysis", "math__communicating_reasoning",
    "ela__reading", "ela__writing", "ela__listening", "ela__research_and_inquiry", "elpac__listening", "elpac__listening_indicator",
    "elpac__speaking", "elpac__speaking_indicator", "elpac__reading", "elpac__reading_indicator", "elpac__writing",
    "elpac__writing_indicator", "cast__life_sciences", "cast__physical_sciences", "cast__earth_and_space_sciences", "migrantstatus",
    "englishlanguageacquisitionstatus", "language", "hispanicorlatinoethnicity", "americanindianoralaskanative", "asian",
    "blackorafricanamerican", "white", "nativehawaiianorotherpacificislander", "demographicracetwoormoreraces", "filipino",
    "file_name", "student_number", "dfs_math", "dfs_ela", "dfs_cast", "proficiency",
]
TARGET_LONGS = {"studentidentifier", "student_number"}
TARGET_DOUBLES = {
    "elpac__oral_language_scale_score", "elpac__oral_language_standard_error", "elpac__written_language_scale_score",
    "elpac__written_language_standard_error", "ela__reading", "ela__writing", "ela__listening", "ela__research_and_inquiry",
    "elpac__listening_indicator", "elpac__reading_indicator", "dfs_math", "dfs_ela", "dfs_cast", "proficiency",
}


class UnmappedColumns(ValueError):
    """A feed has columns that the target has no place for."""


def target_name(name: str) -> str:
    """The target's spelling of a feed's column: lower case, one underscore for each other sign."""
    return re.sub(r"[^0-9a-z]", "_", name.lower())


def mapping_report(columns: Sequence[str], target: Sequence[str] = TARGET_COLUMNS, mapping: Mapping[str, str] | None = None) -> tuple[dict[str, str], list[str], list[str]]:
    """(target column -> source column, source columns without a place in the target, target columns without a source).

    ``mapping`` (source -> target) goes before the rule of ``target_name``; two sources of one target column are unmapped.
    """
    named = {c: (mapping or {}).get(c, target_name(c)) for c in columns}
    times = Counter(named.values())
    used = {t: c for c, t in named.items() if t in set(target) and times[t] == 1}
    return used, [c for c in columns if c not in set(used.values())], [t for t in target if t not in used]


def align_year(df: DataFrame, *, mapping: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """A feed's rows in the 68 columns: renamed, typed (text that is no number becomes NULL), absent columns NULL.

    Columns without a place raise ``UnmappedColumns`` unless ``drop`` names them: nothing is left out silently.
    """
    used, unmapped, _ = mapping_report(df.columns, mapping=mapping)
    lost = [c for c in unmapped if c not in set(drop)]
    if lost:
        raise UnmappedColumns(f"no target column for {lost}; map them, or name them in drop")
    out = []
    for name in TARGET_COLUMNS:
        kind = "bigint" if name in TARGET_LONGS else "double" if name in TARGET_DOUBLES else "string"
        if name not in used:
            value = F.lit(None).cast(kind)
        elif kind == "double" and isinstance(df.schema[used[name]].dataType, T.StringType):
            value = safe_double(qcol(used[name]))
        else:
            value = qcol(used[name]).cast(kind)
        out.append(value.alias(name))
    return df.select(out)


def align_and_stack_two_years(inputs: Inputs, mapping: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """25-26 rows (47 columns) in the 24-25 schema (68 columns), stacked on the 24-25 rows."""
    return union_all([align_year(inputs["state_results_2526_full"], mapping=mapping, drop=drop), align_year(inputs["state_results_2425_full"])])


# invented teacher surnames → subject (parameter; no real names)
SUBJECT_BY_TEACHER = {"Algebra 1": ["Last1", "Last2"], "Geometry": ["Last3"], "English 9": ["Last4", "Last5"],
                      "English 10": ["Last6"]}


def roster_subject_assignment(inputs: Inputs, course_pattern: str = "Course 1",
                              subject_by_teacher: dict[str, list[str]] | None = None) -> DataFrame:
    """Latest roster snapshot, courses containing ``course_pattern``, subject from the teacher's surname."""
    mapping = subject_by_teacher or SUBJECT_BY_TEACHER
    latest = inputs["roster_snapshots"].select(F.max("partitiontime")).scalar()
    sg = inputs["stored_grades"].where((F.col("partitiontime") == latest) & F.col("course_name").contains(course_pattern))
    last = trimmed(split_part("teacher_name", ",", 0, safe=True))
    first = trimmed(split_part("teacher_name", ",", 1, safe=True))
    subject = None
    for subj, names in mapping.items():
        subject = F.when(last.isin(names), F.lit(subj)) if subject is None else subject.when(last.isin(names), F.lit(subj))
    return sg.select("student_number", "course_name", first.alias("first_name"), last.alias("last_name"),
                     subject.alias("subject"))
