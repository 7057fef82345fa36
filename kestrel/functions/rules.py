"""Business rules of the student-data models, as functions returning ``Column``.

Fixed values (state reporting labels and rank orders) are stated together below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.columns import col, norm, regex_first, safe_long, trimmed

# ---- fixed values -----------------------------------------------------------------------------
# ELPI levels and their rank order (plain 2 and 3 come from the alternate assessment)
ELPI_LEVEL_RANKS = {"1": 1, "2L": 2, "2H": 3, "3L": 4, "3H": 5, "4": 6, "2": 2, "3": 3}
MAINTAINED_LOW_LEVELS = ["1", "2L", "2H", "3L", "3H"]
GROWTH_DECREASED = "ELs who Decreased at Least One ELPI Level"
GROWTH_PROGRESSED = "ELs who Progressed at Least One ELPI Level"
GROWTH_MAINTAINED_4 = "ELs who Maintained ELPI Level 4"
GROWTH_MAINTAINED_LOW = "ELs who Maintained ELPI Levels 1, 2L, 2H, 3L, 3H"
KINDERGARTEN_FORMS = ["K", "KG", "KINDERGARTEN", "0", "G0"]
GRADES_9_10_FORMS = ["9", "10", "G9", "G10", "9-10"]
GRADES_11_12_FORMS = ["11", "12", "G11", "G12", "11-12"]
# meal applications: status closest to a final decision first
APPLICATION_STATUS_ORDER = [
    "Processed", "Reviewed", "Second Review", "Verification", "Submitted", "On Hold",
    "In Progress (Incomplete)", "In Progress (Draft)", "Invalid", "Duplicate",
]
DIRECT_CERTIFICATION_BENEFITS = ["calfresh (snap)", "calworks", "medicaid", "medicaid reduced"]
ELIGIBILITY_CATEGORY_ORDER = ["Direct Certification", "Homeless", "Migrant", "Foster", "Meal Application"]
RANK_DEFAULT = 50
LETTER_FOR_POINTS = {"0": "F", "1": "D", "2": "C", "3": "B", "4": "A"}


# ---- E1-E3: ELPI level, rank, grade band --------------------------------------------------------
def elpi_level(level: str | Column, track: str | Column, cut_code: str | Column) -> Column:
    """Alternate track: the digits of the level text; else Level 1/4 directly, Level 2/3 from the cut band."""
    lvl = trimmed(level)
    return (
        F.when(col(track) == "alternate", regex_first(lvl, r"(\d+)"))
        .when(lvl == "Level 1", F.lit("1"))
        .when(lvl == "Level 4", F.lit("4"))
        .when(lvl.isin("Level 2", "Level 3"), col(cut_code))
    )


def elpi_level_rank(level: str | Column) -> Column:
    lvl = trimmed(level)
    out = None
    for value, rank in ELPI_LEVEL_RANKS.items():
        out = F.when(lvl == value, F.lit(rank)) if out is None else out.when(lvl == value, F.lit(rank))
    return out


def _band_from_int(n: Column) -> Column:
    return (
        F.when(n == 0, F.lit("K"))
        .when(n.isin(9, 10), F.lit("9-10"))
        .when(n.isin(11, 12), F.lit("11-12"))
        .when(n.between(1, 8), n.cast("string"))
    )


def grade_band(grade: str | Column, dtype: T.DataType) -> Column:
    """Grade (int or text like 'K', '03', 'G5', '9-10') → ELPI band K, 1-8, 9-10, 11-12; else NULL."""
    g = col(grade)
    u = F.upper(trimmed(g))
    as_int = safe_long(g, dtype)
    stripped = safe_long(F.regexp_replace(u, r"^G", ""))
    return (
        F.when(g.isNull(), F.lit(None).cast("string"))
        .when(u.isin(KINDERGARTEN_FORMS), F.lit("K"))
        .when(u.isin(GRADES_9_10_FORMS), F.lit("9-10"))
        .when(u.isin(GRADES_11_12_FORMS), F.lit("11-12"))
        .when(as_int.between(0, 12), _band_from_int(as_int))
        .when(u.rlike(r"^G?\d+$"), _band_from_int(stripped))
    )


# ---- E6: letter grades ------------------------------------------------------------------------
def normalized_grade(grade: str | Column) -> Column:
    """'0'..'4' → F, D, C, B, A; else drop one '+'/'-' after every letter A-F."""
    g = col(grade)
    out = None
    for points, letter in LETTER_FOR_POINTS.items():
        out = F.when(g == points, F.lit(letter)) if out is None else out.when(g == points, F.lit(letter))
    return out.otherwise(F.regexp_replace(g, r"([A-F])[+-]", "$1"))


# ---- E10-E12, E21-E22: meals ---------------------------------------------------------------------
def eligibility_category(benefit: str | Column) -> Column:
    b = norm(benefit)
    return (
        F.when(b.isin(DIRECT_CERTIFICATION_BENEFITS), F.lit("Direct Certification"))
        .when(b == "homeless", F.lit("Homeless"))
        .when(b == "migrant", F.lit("Migrant"))
        .when(b == "foster", F.lit("Foster"))
        .otherwise(F.lit("Meal Application"))
    )


def homeless_backfill(academic_year: str | Column, ishomeless: str | Column, target_year: str) -> Column:
    """True when the roster flags the student homeless in the one backfill year."""
    return (col(academic_year) == target_year) & (norm(F.coalesce(col(ishomeless), F.lit(""))) == "yes")


# ---- E14: score / label split ----------------------------------------------------------------------
def score_label_split(score: str | Column, proficiency: str | Column) -> tuple[Column, Column]:
    """Numeric score text stays a score; otherwise the text moves into proficiency."""
    from kestrel.functions.columns import safe_double

    num = safe_double(trimmed(score))
    label = F.when(num.isNotNull(), col(proficiency).cast("string")).otherwise(
        F.coalesce(F.nullif(trimmed(proficiency), F.lit("")), F.nullif(trimmed(score), F.lit("")))
    )
    return num, label


# ---- E15-E18: ELPI growth --------------------------------------------------------------------------
def elpac_track(subject: str | Column) -> Column:
    return F.when(norm(subject).contains("alternate"), F.lit("alternate")).otherwise(F.lit("elpac"))


def elpi_growth_category(eligible: Column, level: Column, prev_level: Column) -> Column:
    r, pr = elpi_level_rank(level), elpi_level_rank(prev_level)
    return (
        F.when(eligible == 0, F.lit(None).cast("string"))
        .when(r < pr, F.lit(GROWTH_DECREASED))
        .when(r > pr, F.lit(GROWTH_PROGRESSED))
        .when((level == "4") & (prev_level == "4"), F.lit(GROWTH_MAINTAINED_4))
        .when((level == prev_level) & level.isin(MAINTAINED_LOW_LEVELS), F.lit(GROWTH_MAINTAINED_LOW))
    )


def advanced_elpi(eligible: Column, track: Column, level: Column, prev_level: Column,
                  score: Column, prev_score: Column) -> Column:
    r, pr = elpi_level_rank(level), elpi_level_rank(prev_level)
    alternate = (
        F.when(r > pr, F.lit(1))
        .when((level == "3") & (prev_level == "3"), F.lit(1))
        .when(score - prev_score >= 10, F.lit(1))
        .otherwise(F.lit(0))
    )
    standard = F.when(r > pr, F.lit(1)).when((level == "4") & (prev_level == "4"), F.lit(1)).otherwise(F.lit(0))
    # the prior row always has the same track (the join is on track), so only the current track matters
    return F.when(eligible == 0, F.lit(0)).when(track == "alternate", alternate).otherwise(standard)


# ---- E19, E20: responsible teacher, curriculum remap -------------------------------------------------
def cast_teacher(grade_level: str | Column, math_teacher: str | Column, science_teacher: str | Column) -> Column:
    g = col(grade_level)
    return F.when(g == 5, col(math_teacher)).when(g.isin(8, 12), col(science_teacher))


def ica_curriculum(subject: str | Column, assessment_name: str | Column, remapped_name: str, remapped_to: str) -> Column:
    s = col(subject).cast("string")
    return F.when((norm(s) == "math") & (col(assessment_name).cast("string") == remapped_name), F.lit(remapped_to)).otherwise(s)
