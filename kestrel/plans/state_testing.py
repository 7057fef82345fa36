"""State testing views: CAST and SBAC per roster student-year, ELPAC growth (ELPI).

Shapes shared by the three:
* the 25-26 reload log is reduced to its latest row per (student_number, assessment);
* rows are *roster preserving* (roster LEFT JOIN scores), filtered to the tested grades;
* the archived 24-25 output fills in students the live 24-25 branch no longer has
  (``overlay``: match on state id OR student number, rewritten as two anti-joins);
* the final UNION is DISTINCT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import norm, qcol, safe_double, trimmed, typed_null
from kestrel.functions.rules import (
    advanced_elpi, cast_teacher, elpac_track, elpi_growth_category, elpi_level, elpi_level_rank, grade_band,
)
from kestrel.operators.hot_keys import hot_key_join
from kestrel.operators.joins import band_join, conditional_key_join, equi_join, full_outer_null_safe, overlay
from kestrel.operators.stack import union_distinct
from kestrel.plans.reloads import latest_reload
from kestrel.sources.fixtures import CAST_NAMES, EXCEPTION_STATE_ID, EXCEPTION_STUDENT_NUMBER
from kestrel.sources.registry import Inputs

ROSTER_FIELDS = ["lastfirst", "grade_level", "elastatus", "race", "school_name", "sped_identifier",
                 "absenteeism_status", "hit_tutoring"]
OVERLAY_KEYS = [("studentidentifier", "studentidentifier"), ("student_number", "student_number")]


def _roster(inputs: Inputs, year: str, extra: list[str]) -> DataFrame:
    r = inputs["roster"].where(F.col("year") == year)
    return r.select(F.col("student_number").alias("st_student_number"), *ROSTER_FIELDS, *extra)


def _roster_join(roster: DataFrame, scores: DataFrame, grades: list[int], score_numbers: DataFrame | None = None) -> DataFrame:
    """roster LEFT JOIN scores ON number (the source's RIGHT JOIN), tested grades only.

    The score side may hold a hot number (0 = unknown), which AQE cannot split in a left join.  ``score_numbers``
    stands for the scores in the sketch of hot numbers: numbers that all occur in ``scores``.
    """
    r = roster.where(F.col("grade_level").isin(grades))
    return hot_key_join(r, scores, [("st_student_number", "student_number")], "left", right_sample=score_numbers)


# ---- CAST ------------------------------------------------------------------------------------------
CAST_GRADES = [5, 8, 12]
CAST_COLUMNS = [
    "studentidentifier", "student_number", "assessmentname", "scalescoreachievementlevel", "proficiency", "cast_dfs",
    "scalescore", "lexilemeasure", "cast__life_sciences", "cast__physical_sciences", "cast__earth_and_space_sciences",
    "lastfirst", "grade_level", "elastatus", "race", "school_name", "sped_identifier", "absenteeism_status",
    "hit_tutoring", "teacher", "year",
]
_CAST_DOMAINS = ["cast__life_sciences", "cast__physical_sciences", "cast__earth_and_space_sciences"]


def _cast_live(roster: DataFrame, scores: DataFrame, year: str, fill_number: bool) -> DataFrame:
    j = _roster_join(roster, scores, CAST_GRADES)
    number = F.coalesce(F.col("student_number"), F.col("st_student_number")) if fill_number else F.col("student_number")
    return j.select(
        "studentidentifier", number.alias("student_number"), "assessmentname", "scalescoreachievementlevel",
        "proficiency", "cast_dfs", "scalescore", F.col("lexilemeasure").cast("double").alias("lexilemeasure"),
        *_CAST_DOMAINS, *ROSTER_FIELDS, "teacher", F.lit(year).alias("year"),
    )


def cast_tabular(inputs: Inputs) -> DataFrame:
    snake, log = inputs["state_results_snake"], inputs["state_results_pascal"]
    c2425 = snake.where(F.col("assessmentname").isin(*CAST_NAMES)).select(
        "studentidentifier", "student_number", "assessmentname", "scalescoreachievementlevel", "proficiency",
        F.col("dfs_cast").alias("cast_dfs"), "scalescore", "lexilemeasure",
        *[F.col(c).cast("string").alias(c) for c in _CAST_DOMAINS],
    ).distinct()
    c2526 = latest_reload(log.where(F.col("AssessmentName").isin(*CAST_NAMES))).select(
        F.col("StudentIdentifier").alias("studentidentifier"), "student_number",
        F.col("AssessmentName").alias("assessmentname"),
        F.col("ScaleScoreAchievementLevel").alias("scalescoreachievementlevel"), "proficiency",
        F.col("dfs_cast").alias("cast_dfs"), F.col("ScaleScore").alias("scalescore"),
        F.col("LexileMeasure").alias("lexilemeasure"),
        qcol("CAST: Life Sciences").cast("string").alias("cast__life_sciences"),
        qcol("CAST: Physical Sciences").cast("string").alias("cast__physical_sciences"),
        qcol("CAST: Earth and Space Sciences").cast("string").alias("cast__earth_and_space_sciences"),
    )
    teacher = cast_teacher("grade_level", "math_teacher", "science_teacher").alias("teacher")
    r2425 = _roster(inputs, "24-25", ["science_teacher", "math_teacher"]).withColumn("teacher", teacher)
    r2526 = _roster(inputs, "25-26", ["science_teacher", "math_teacher"]).withColumn("teacher", teacher)
    # read by the union and by the archive overlay
    live_2425 = _cast_live(r2425, c2425, "24-25", fill_number=False)
    live_2526 = _cast_live(r2526, c2526, "25-26", fill_number=True)
    h = inputs["cast_archive"]
    archived = h.select(
        "studentidentifier", "student_number", "assessmentname", "scalescoreachievementlevel", "proficiency",
        "cast_dfs", "scalescore", F.col("lexilemeasure").cast("double").alias("lexilemeasure"),
        *[F.col(c).cast("string").alias(c) for c in _CAST_DOMAINS],
        "lastfirst", "grade_level", "elastatus", "race", "school_name", "sped_identifier", "absenteeism_status",
        typed_null("string").alias("hit_tutoring"), "teacher", F.lit("24-25").alias("year"),
    )
    return union_distinct([live_2425, live_2526, overlay(live_2425, archived, OVERLAY_KEYS).select(CAST_COLUMNS)])


# ---- SBAC ------------------------------------------------------------------------------------------
SBAC_GRADES = [3, 4, 5, 6, 7, 8, 11]
ELA_DOMAINS = ["ela__reading", "ela__writing", "ela__listening", "ela__research_and_inquiry"]
MATH_DOMAINS = ["math__concepts_and_procedures", "math__problem_solving_and_modeling___data_analysis",
                "math__communicating_reasoning"]
PASCAL_ELA = ["ELA: Reading", "ELA: Writing", "ELA: Listening", "ELA: Research and Inquiry"]
PASCAL_MATH = ["Math: Concepts and Procedures", "Math: Problem Solving and Modeling & Data Analysis",
               "Math: Communicating Reasoning"]
PRIOR = ["prev_year_ela_scalescoreachievementlevel", "prev_year_ela_dfs", "prev_year_math_scalescoreachievementlevel",
         "prev_year_math_dfs", "prev_year_ela_proficiency", "prev_year_math_proficiency"]
SBAC_COLUMNS = (
    ["studentidentifier", "student_number", "ela_assessmentname", "ela_scalescoreachievementlevel", "ela_proficiency",
     "ela_dfs", "ela_scalescore", "ela_lexilemeasure", *ELA_DOMAINS,
     "prev_year_ela_scalescoreachievementlevel", "prev_year_ela_dfs", "prev_year_ela_proficiency",
     "math_assessmentname", "math_scalescoreachievementlevel", "math_proficiency", "math_dfs", "math_scalescore",
     "math_lexilemeasure", *MATH_DOMAINS,
     "prev_year_math_scalescoreachievementlevel", "prev_year_math_dfs", "prev_year_math_proficiency"]
    + ROSTER_FIELDS + ["english_teacher", "math_teacher", "year", "intervention"]
)


def _subject_scores(df: DataFrame, subject: str, *, sid: str, name: str, level: str, score: str, lexile: str,
                    domains: list[tuple[str, str]]) -> DataFrame:
    p = subject
    return df.select(
        F.col(sid).alias("studentidentifier"), "student_number",
        F.col(name).alias(f"{p}_assessmentname"), F.col(level).alias(f"{p}_scalescoreachievementlevel"),
        F.col("proficiency").alias(f"{p}_proficiency"), F.col(f"dfs_{p}").alias(f"{p}_dfs"),
        F.col(score).alias(f"{p}_scalescore"), F.col(lexile).alias(f"{p}_lexilemeasure"),
        *[safe_double(qcol(src)).alias(dst) for src, dst in domains],
    )


def _ela_math_full_join(ela: DataFrame, math: DataFrame, ela_ids: DataFrame | None = None, math_ids: DataFrame | None = None, *,
                        split_hot: bool = True) -> DataFrame:
    """ELA FULL OUTER JOIN Math on state id; NULL ids never match, so each stays its own row.

    ``ela_ids`` (e_sid) and ``math_ids`` (m_sid) stand for the two sides in the sketch of hot ids; without
    ``split_hot`` only NULL ids are spread.
    """
    e = ela.withColumnRenamed("studentidentifier", "e_sid").withColumnRenamed("student_number", "e_sn")
    m = math.withColumnRenamed("studentidentifier", "m_sid").withColumnRenamed("student_number", "m_sn")
    if split_hot:
        j = full_outer_null_safe(e, m, "e_sid", "m_sid", left_sample=ela_ids, right_sample=math_ids)
    else:
        j = equi_join(e, m, [("e_sid", "m_sid")], "full")
    rest = [c for c in ela.columns if c not in ("studentidentifier", "student_number")] + \
           [c for c in math.columns if c not in ("studentidentifier", "student_number")]
    return j.select(
        F.coalesce("e_sid", "m_sid").alias("studentidentifier"), F.coalesce("e_sn", "m_sn").alias("student_number"), *rest
    )


def _snake_pair(df: DataFrame, ela_cols, math_cols) -> tuple[DataFrame, DataFrame]:
    base = df.where(F.col("assessmenttype") == "Summative")
    return (base.where(F.col("subject") == "ELA").select(*ela_cols).distinct(),
            base.where(F.col("subject") == "Math").select(*math_cols).distinct())


def sbac_tabular(inputs: Inputs) -> DataFrame:
    snake, s2324, log = inputs["state_results_snake"], inputs["state_results_2324"], inputs["state_results_pascal"]

    # 24-25 live scores (distinct rows; several per student are possible and kept)
    summative = snake.where(F.col("assessmenttype") == "Summative")
    ela = _subject_scores(summative.where(F.col("subject") == "ELA"), "ela", sid="studentidentifier",
                          name="assessmentname", level="scalescoreachievementlevel", score="scalescore",
                          lexile="lexilemeasure", domains=[(d, d) for d in ELA_DOMAINS]).distinct()
    math = _subject_scores(summative.where(F.col("subject") == "Math"), "math", sid="studentidentifier",
                           name="assessmentname", level="scalescoreachievementlevel", score="scalescore",
                           lexile="lexilemeasure", domains=[(d, d) for d in MATH_DOMAINS]).distinct()
    ids_of = lambda df, subject, name: df.where(
        (F.col("assessmenttype") == "Summative") & (F.col("subject") == subject)).select(F.col("studentidentifier").alias(name))
    # read by the 24-25 rows and by the 25-26 prior-year lookup
    joined = _ela_math_full_join(ela, math, ids_of(snake, "ELA", "e_sid"), ids_of(snake, "Math", "m_sid"))

    # prior year of 24-25: the 23-24 file, ELA ⟗ Math on state id
    e23, m23 = _snake_pair(
        s2324,
        ["studentidentifier", "student_number", F.col("scalescoreachievementlevel").alias("ela_level"),
         F.col("dfs_ela").alias("ela_dfs"), "proficiency"],
        ["studentidentifier", "student_number", F.col("scalescoreachievementlevel").alias("math_level"),
         F.col("dfs_math").alias("math_dfs"), "proficiency"],
    )
    e23 = e23.select(F.col("studentidentifier").alias("e_sid"), "ela_level", "ela_dfs", F.col("proficiency").alias("e_prof"))
    m23 = m23.select(F.col("studentidentifier").alias("m_sid"), "math_level", "math_dfs", F.col("proficiency").alias("m_prof"))
    ids_2324 = {c: ids_of(s2324, subject, c) for subject, c in (("ELA", "e_sid"), ("Math", "m_sid"))}
    prior_2324 = full_outer_null_safe(e23, m23, "e_sid", "m_sid", left_sample=ids_2324["e_sid"], right_sample=ids_2324["m_sid"]).select(
        F.coalesce("e_sid", "m_sid").alias("p_sid"),
        F.col("ela_level").alias(PRIOR[0]), F.col("ela_dfs").alias(PRIOR[1]),
        F.col("math_level").alias(PRIOR[2]), F.col("math_dfs").alias(PRIOR[3]),
        F.col("e_prof").alias(PRIOR[4]), F.col("m_prof").alias(PRIOR[5]),
    )
    # several prior rows per state id are possible (ELA x Math pairs): a hot id is split on both sides
    scores_2425 = hot_key_join(
        joined, prior_2324, [("studentidentifier", "p_sid")], "left", right_sample=ids_2324["e_sid"].union(ids_2324["m_sid"]).withColumnRenamed("e_sid", "p_sid")).drop("p_sid")

    # prior year of 25-26: the 24-25 scores, maxed per student number column by column
    prior_2425 = joined.where(F.col("student_number").isNotNull()).groupBy(
        F.col("student_number").alias("p_number")
    ).agg(
        F.max("ela_scalescoreachievementlevel").alias(PRIOR[0]), F.max("ela_dfs").alias(PRIOR[1]),
        F.max("math_scalescoreachievementlevel").alias(PRIOR[2]), F.max("math_dfs").alias(PRIOR[3]),
        F.max("ela_proficiency").alias(PRIOR[4]), F.max("math_proficiency").alias(PRIOR[5]),
    )

    # 25-26 scores: latest reload per student + assessment, ELA ⟗ Math
    summ26 = log.where(norm("AssessmentType") == "summative")
    ela26 = _subject_scores(latest_reload(summ26.where(norm("Subject") == "ela")), "ela", sid="StudentIdentifier",
                            name="AssessmentName", level="ScaleScoreAchievementLevel", score="ScaleScore",
                            lexile="LexileMeasure", domains=list(zip(PASCAL_ELA, ELA_DOMAINS)))
    math26 = _subject_scores(latest_reload(summ26.where(norm("Subject") == "math")), "math", sid="StudentIdentifier",
                             name="AssessmentName", level="ScaleScoreAchievementLevel", score="ScaleScore",
                             lexile="LexileMeasure", domains=list(zip(PASCAL_MATH, MATH_DOMAINS)))
    scores_2526 = _ela_math_full_join(ela26, math26, split_hot=False)  # one latest row per number and test
    sid_lookup = log.where(F.col("student_number").isNotNull()).groupBy(
        F.col("student_number").alias("l_number")).agg(F.max("StudentIdentifier").alias("l_sid"))
    intervention = inputs["intervention"].select(F.col("student_number").alias("i_number"), "intervention")

    teachers = ["english_teacher", "math_teacher"]
    score_cols = [c for c in SBAC_COLUMNS if c not in ROSTER_FIELDS + teachers + ["year", "intervention"] + PRIOR
                  and c not in ("studentidentifier", "student_number")]

    def out(j: DataFrame, sid, number, prior_prefix: str, year: str, intervention_col) -> DataFrame:
        cols = {c: F.col(c) for c in score_cols}
        cols["math_lexilemeasure"] = F.col("math_lexilemeasure").cast("double")
        for c in PRIOR:
            cols[c] = F.col(f"{prior_prefix}{c}")
        cols.update({c: F.col(c) for c in ROSTER_FIELDS + teachers})
        cols.update(studentidentifier=sid, student_number=number, year=F.lit(year), intervention=intervention_col)
        return j.select([cols[c].alias(c) for c in SBAC_COLUMNS])

    r2425 = _roster(inputs, "24-25", teachers)
    # every number of an ELA row comes through the joins above
    j25 = _roster_join(r2425, scores_2425, SBAC_GRADES, summative.where(F.col("subject") == "ELA").select("student_number"))
    # the intervention lookup is not unique per student (kept as in the source)
    j25 = equi_join(j25, intervention, [("st_student_number", "i_number")], "left")
    # read by the union and by the archive overlay
    live_2425 = out(j25, F.col("studentidentifier"), F.col("student_number"), "", "24-25", F.col("intervention"))

    r2526 = _roster(inputs, "25-26", teachers)
    # the latest rows have one row per number and test: no hot numbers
    j26 = equi_join(r2526.where(F.col("grade_level").isin(SBAC_GRADES)), scores_2526, [("st_student_number", "student_number")], "left")
    j26 = j26.join(sid_lookup, j26["st_student_number"] == sid_lookup["l_number"], "left")
    p = prior_2425.select(F.col("p_number"), *[F.col(c).alias(f"p_{c}") for c in PRIOR])
    j26 = j26.join(p, j26["st_student_number"] == p["p_number"], "left")
    live_2526 = out(j26, F.coalesce("studentidentifier", "l_sid"), F.coalesce("student_number", "st_student_number"),
                    "p_", "25-26", typed_null("string"))

    h = inputs["sbac_archive"]
    hcols = {c: F.col(c) for c in SBAC_COLUMNS if c in h.columns}
    hcols.update({
        "prev_year_ela_scalescoreachievementlevel": qcol("24_ela_scalescoreachievementlevel"),
        "prev_year_ela_dfs": qcol("24_ela_dfs"), "prev_year_ela_proficiency": qcol("24_proficiency"),
        "math_lexilemeasure": F.col("math_lexilemeasure").cast("double"),
        "prev_year_math_scalescoreachievementlevel": qcol("24_math_scalescoreachievementlevel"),
        "prev_year_math_dfs": qcol("24_math_dfs"), "prev_year_math_proficiency": typed_null("double"),
        "hit_tutoring": typed_null("string"), "year": F.lit("24-25"),
    })
    archived = h.select([hcols[c].alias(c) for c in SBAC_COLUMNS])
    return union_distinct([live_2425, live_2526, overlay(live_2425, archived, OVERLAY_KEYS).select(SBAC_COLUMNS)])


# ---- ELPAC growth ---------------------------------------------------------------------------------
ELPAC_DOMAINS = [("ELPAC: Oral Language Level", "elpac__oral_language_level"),
                 ("ELPAC: Written Language Level", "elpac__written_language_level"),
                 ("ELPAC: Listening", "elpac__listening"), ("ELPAC: Speaking", "elpac__speaking"),
                 ("ELPAC: Reading", "elpac__reading"), ("ELPAC: Writing", "elpac__writing")]
#: width of a score cell in the cut-score lookup: about the length of a band
CUT_CELL = 50.0
ELPAC_COLUMNS = [
    "studentidentifier", "student_number", "lastfirst", "grade_level", "elastatus", "race", "school_name",
    "sped_identifier", "absenteeism_status", "hit_tutoring", "english_teacher", "year", "subject", "prev_year_subject",
    "scalescoreachievementlevel", "scalescore", "prev_year_scalescoreachievementlevel", "prev_year_scalescore",
    *[d for _, d in ELPAC_DOMAINS], "elpac_track", "elpi_level", "prev_year_elpi_level", "elpi_eligible",
    "elpi_level_rank", "prev_year_elpi_level_rank", "elpi_growth_category", "advanced_elpi",
]


def elpac_growth(inputs: Inputs, exceptions: dict[int, int] | None = None) -> DataFrame:
    """One row per 25-26 summative ELPAC result with prior-year level, ELPI level, growth and advanced flag.

    ``exceptions`` maps state id → roster number for results whose number is unusable (0); those
    students are matched to their prior-year row by state id instead of number.
    """
    exceptions = exceptions or {EXCEPTION_STATE_ID: EXCEPTION_STUDENT_NUMBER}
    log, snake = inputs["state_results_pascal"], inputs["state_results_snake"]

    cur = latest_reload(log.where(norm("Subject").contains("elpac") & (norm("AssessmentType") == "summative"))).select(
        F.col("StudentIdentifier").alias("studentidentifier"), "student_number", F.col("Subject").alias("subject"),
        F.col("AssessmentName").alias("assessmentname"),
        F.col("ScaleScoreAchievementLevel").alias("scalescoreachievementlevel"),
        safe_double("ScaleScore").alias("scalescore"), F.col("GradeLevelWhenAssessed").alias("gradelevelwhenassessed"),
        elpac_track("Subject").alias("elpac_track"),
        *[qcol(src).cast("string").alias(dst) for src, dst in ELPAC_DOMAINS],
    )
    repair = F.nullif(F.col("student_number"), F.lit(0))
    for sid, number in exceptions.items():
        repair = F.when(F.col("studentidentifier") == sid, F.lit(number)).otherwise(repair)
    cur = cur.withColumn("roster_student_number", repair.cast("bigint"))

    prior = snake.where(norm("subject").contains("elpac") & (norm("assessmenttype") == "summative")).select(
        F.col("studentidentifier").alias("p_sid"), F.col("student_number").alias("p_number"),
        F.col("subject").alias("prev_year_subject"), F.col("assessmentname").alias("p_assessmentname"),
        F.col("scalescoreachievementlevel").alias("prev_year_scalescoreachievementlevel"),
        safe_double("scalescore").alias("prev_year_scalescore"),
        F.col("gradelevelwhenassessed").alias("prev_year_gradelevelwhenassessed"),
        elpac_track("subject").alias("prev_year_elpac_track"),
    ).distinct()
    j = conditional_key_join(
        cur, prior, left_id="studentidentifier", left_number="student_number", right_id="p_sid",
        right_number="p_number", exception_ids=list(exceptions), also_on=[("elpac_track", "prev_year_elpac_track")],
    )
    st = _roster(inputs, "25-26", ["english_teacher", "year"])
    j = equi_join(j, st, [("roster_student_number", "st_student_number")], "left")
    j = j.withColumn("student_number", F.coalesce("st_student_number", "roster_student_number", "student_number"))
    j = j.withColumn("elpi_eligible", F.when(F.col("p_sid").isNotNull(), 1).otherwise(0))

    cuts = inputs["cut_scores"]
    level_2_3 = lambda c: trimmed(c).isin("Level 2", "Level 3")
    is_elpac = F.col("elpac_track") == "elpac"
    j = band_join(j, cuts, left_band=F.when(is_elpac & level_2_3("scalescoreachievementlevel"),
                                            grade_band("grade_level", inputs["roster"].schema["grade_level"].dataType)),
                  left_value=F.col("scalescore"), band_key="grade_band", low="min_score", high="max_score", prefix="cc_", cell=CUT_CELL)
    prev_band = grade_band("prev_year_gradelevelwhenassessed", snake.schema["gradelevelwhenassessed"].dataType)
    j = band_join(j, cuts, left_band=F.when(is_elpac & level_2_3("prev_year_scalescoreachievementlevel"), prev_band),
                  left_value=F.col("prev_year_scalescore"), band_key="grade_band", low="min_score", high="max_score",
                  prefix="pc_", cell=CUT_CELL)
    lvl = elpi_level("scalescoreachievementlevel", "elpac_track", "cc_level_code")
    plvl = elpi_level("prev_year_scalescoreachievementlevel", "elpac_track", "pc_level_code")
    j = j.withColumn("elpi_level", lvl).withColumn("prev_year_elpi_level", plvl)
    e, L, PL = F.col("elpi_eligible"), F.col("elpi_level"), F.col("prev_year_elpi_level")
    j = j.withColumn("elpi_level_rank", elpi_level_rank(L)).withColumn("prev_year_elpi_level_rank", elpi_level_rank(PL))
    j = j.withColumn("elpi_growth_category", elpi_growth_category(e, L, PL))
    j = j.withColumn("advanced_elpi", advanced_elpi(e, F.col("elpac_track"), L, PL, F.col("scalescore"),
                                                    F.col("prev_year_scalescore")))
    return j.select(ELPAC_COLUMNS)
