"""Test-data adapters: the driver's retail-shaped tables → the logical inputs of the pipelines.

Each logical input is a list of branches ``(base_table, where, [(column, sql_expr), ...])``
stacked with UNION ALL; a branch may group its whole base table by key columns (lookup
dimensions: their size is bounded by the key domain, their scan grows with the table).  The expressions use only constructs that evaluate identically in
Spark SQL and DuckDB (``%``, CASE, ``concat``, ``lpad``, ``cast(.. as string|bigint|int|double|date)``,
``month/day/year/hour/minute/second``), so the same text feeds the Spark side (as a
DataFrame ``select`` of ``F.expr`` columns) and the DuckDB oracle (as CTEs).  All student,
staff and school values are invented.

Edge cases are placed deliberately (comments mark them): leavers, null and 0 ids, reloads,
whitespace/case noise, unparseable text, float ids, off-roster students.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Branch:
    table: str
    columns: list[tuple[str, str]]
    where: str | None = None
    #: names of the key columns when the branch aggregates its whole base table into a lookup
    #: dimension (every other column is then an aggregate expression)
    group_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Adapter:
    name: str
    branches: list[Branch] = field(default_factory=list)


# ---- fixed values used by the adapters ------------------------------------------------------
MONTHS = "CASE month({c}) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' ELSE 'Dec' END"
YEARS = [(0, "24-25"), (1, "25-26"), (2, "26-27")]
CAST_NAMES = ("CAST Summative Grade 5", "CAST Summative Grade 8", "CAST Summative Grade HS")
ICA_MATH_11 = "Grade 11 MATH - Interim Comprehensive Assessment (ICA)"
# state id whose results carry student_number 0; the roster knows the student under another number
EXCEPTION_STATE_ID = 9000000005
EXCEPTION_STUDENT_NUMBER = 100006

SNAKE_DOMAINS = [
    "ela__reading", "ela__writing", "ela__listening", "ela__research_and_inquiry",
    "math__concepts_and_procedures", "math__problem_solving_and_modeling___data_analysis",
    "math__communicating_reasoning",
    "cast__life_sciences", "cast__physical_sciences", "cast__earth_and_space_sciences",
]
PASCAL_DOMAINS = [
    "ELA: Reading", "ELA: Writing", "ELA: Listening", "ELA: Research and Inquiry",
    "Math: Concepts and Procedures", "Math: Problem Solving and Modeling & Data Analysis",
    "Math: Communicating Reasoning",
    "CAST: Life Sciences", "CAST: Physical Sciences", "CAST: Earth and Space Sciences",
    "ELPAC: Oral Language Level", "ELPAC: Written Language Level", "ELPAC: Listening",
    "ELPAC: Speaking", "ELPAC: Reading", "ELPAC: Writing",
]


def _s(expr: str) -> str:
    return f"cast({expr} as string)"


def _grade_text(k: str) -> str:
    # 'K', zero-padded, 'G'-prefixed, high-school and transitional-K forms
    return f"CASE {k} % 6 WHEN 0 THEN 'K' WHEN 1 THEN '03' WHEN 2 THEN 'G5' WHEN 3 THEN '9' WHEN 4 THEN '11' ELSE 'TK' END"


def _domain(k: str, i: int) -> str:
    # numeric text, or a band label that safe-casts to null
    return f"CASE WHEN ({k} + {i}) % 7 = 0 THEN 'Above Standard' ELSE {_s(f'1 + ({k} + {i}) % 3')} END"


# ---- roster (student_to_teacher): one row per student-year ----------------------------------
def _roster_branch(yi: int, year: str) -> Branch:
    k = "c_custkey"
    return Branch(
        "customer",
        [
            ("student_number", f"{k} + 100000"),
            # leavers: every tenth student's row is of an earlier year
            ("year", f"CASE WHEN ({k} + {yi}) % 10 = 0 THEN '23-24' ELSE '{year}' END"),
            ("grade_level", f"cast(({k} + {yi}) % 13 as int)"),
            ("school_name", f"concat('School ', {_s('c_nationkey % 7')})"),
            # no comma in the name for k % 19 = 0
            ("lastfirst", f"CASE WHEN {k} % 19 = 0 THEN concat('Solo', {_s(k)}) ELSE concat('Last', {_s(k)}, ', First', {_s(k)}) END"),
            ("race", f"CASE WHEN {k} % 17 = 0 THEN NULL ELSE c_mktsegment END"),
            ("elastatus", f"CASE {k} % 4 WHEN 0 THEN 'EL' WHEN 1 THEN 'EO' WHEN 2 THEN 'RFEP' ELSE NULL END"),
            ("sped_identifier", f"CASE WHEN {k} % 8 = 0 THEN 'Yes' ELSE 'No' END"),
            ("absenteeism_status", "CASE WHEN c_acctbal < 5000 THEN 'Chronic' ELSE 'Regular' END"),
            ("frlstatus", f"CASE {k} % 3 WHEN 0 THEN 'Free' WHEN 1 THEN 'Reduced' ELSE 'Paid' END"),
            ("ishomeless", f"CASE {k} % 11 WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes ' WHEN 2 THEN NULL ELSE 'No' END"),
            ("hit_tutoring", f"CASE WHEN {k} % 5 = 0 THEN 'Yes' ELSE NULL END"),
            ("elem_teacher", f"concat('Elem Teacher ', {_s('c_nationkey')})"),
            ("english_teacher", f"concat('English Teacher ', {_s('c_nationkey % 9')})"),
            ("math_teacher", f"concat('Math Teacher ', {_s('c_nationkey % 8')})"),
            ("science_teacher", f"concat('Science Teacher ', {_s('c_nationkey % 6')})"),
            ("history_teacher", f"concat('History Teacher ', {_s('c_nationkey % 5')})"),
        ],
    )


ROSTER = Adapter("roster", [_roster_branch(yi, y) for yi, y in YEARS])


# ---- state results, snake_case dialect (24-25 live and the 23-24 subset) --------------------
def _snake_columns() -> list[tuple[str, str]]:
    k, c = "o_orderkey", "o_custkey"
    cast_name = f"CASE {c} % 3 WHEN 0 THEN '{CAST_NAMES[0]}' WHEN 1 THEN '{CAST_NAMES[1]}' ELSE '{CAST_NAMES[2]}' END"
    cols = [
        ("studentidentifier", f"CASE WHEN {k} % 89 = 0 THEN NULL ELSE {c} + 9000000000 END"),
        ("student_number", f"CASE WHEN {k} % 101 = 0 THEN NULL WHEN {k} % 97 = 0 THEN 0 ELSE {c} + 100000 END"),
        ("subject", f"CASE {k} % 5 WHEN 0 THEN 'ELA' WHEN 1 THEN 'Math' WHEN 2 THEN 'CAST' WHEN 3 THEN 'Summative ELPAC' ELSE 'Summative Alternate ELPAC' END"),
        ("assessmenttype", "CASE WHEN o_orderstatus = 'O' THEN 'Interim' ELSE 'Summative' END"),
        ("assessmentname", f"CASE {k} % 5 WHEN 0 THEN 'ELA Summative' WHEN 1 THEN 'Math Summative' WHEN 2 THEN {cast_name} WHEN 3 THEN 'Summative ELPAC' ELSE 'Summative Alternate ELPAC' END"),
        ("schoolname", f"concat('School ', {_s(f'{c} % 7')})"),
        ("gradelevelwhenassessed", _grade_text(c)),
        # fractional scores fall between the integer cut bands
        ("scalescore", f"concat({_s(f'1370 + ({k} * 7) % 260')}, CASE WHEN {k} % 31 = 0 THEN '.5' ELSE '' END)"),
        ("scalescoreachievementlevel", f"concat('Level ', {_s(f'1 + {k} % 4')})"),
        ("proficiency", f"cast({k} % 2 as double)"),
        ("dfs_ela", f"cast({k} % 200 - 100 as double)"),
        ("dfs_math", f"cast({k} % 150 - 75 as double)"),
        ("dfs_cast", f"cast({k} % 120 - 60 as double)"),
        ("lexilemeasure", f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {_s(f'400 + {k} % 900')} END"),
    ]
    cols += [(d, _domain(k, i)) for i, d in enumerate(SNAKE_DOMAINS)]
    return cols


STATE_SNAKE = Adapter("state_results_snake", [Branch("orders", _snake_columns())])
STATE_2324 = Adapter("state_results_2324", [Branch("orders", _snake_columns())])


# ---- state results, PascalCase dialect (25-26 reload log) ----------------------------------
def _pascal_columns() -> list[tuple[str, str]]:
    k, p, n = "l_orderkey", "l_partkey", "l_linenumber"
    g = _s(f"3 + {p} % 6")
    cast_name = f"CASE {p} % 3 WHEN 0 THEN '{CAST_NAMES[0]}' WHEN 1 THEN '{CAST_NAMES[1]}' ELSE '{CAST_NAMES[2]}' END"
    day = "day(l_shipdate)"
    submit = (
        f"concat(CASE WHEN {n} = 7 THEN ' ' ELSE '' END, {MONTHS.format(c='l_shipdate')}, ' ', "
        # space-padded one-digit days on even line numbers
        f"CASE WHEN {day} < 10 AND {n} % 2 = 0 THEN ' ' ELSE '' END, {_s(day)}, ', ', {_s('year(l_shipdate) + 25')})"
    )
    level = _s(f"1 + ({k} + {n}) % 4")
    cols = [
        ("StudentIdentifier", f"CASE WHEN {k} % 89 = 0 THEN NULL ELSE {p} + 9000000000 END"),
        # 0 and null numbers; parts above the customer range are off the roster
        ("student_number", f"CASE WHEN {k} % 103 = 0 THEN NULL WHEN {k} % 97 = 0 THEN 0 ELSE {p} + 100000 END"),
        ("Subject", f"CASE {k} % 5 WHEN 0 THEN (CASE WHEN {n} = 1 THEN ' ELA ' ELSE 'ELA' END) WHEN 1 THEN (CASE WHEN {n} = 2 THEN 'math' ELSE 'Math' END) WHEN 2 THEN 'CAST' WHEN 3 THEN 'Summative ELPAC' ELSE 'Summative Alternate ELPAC' END"),
        ("AssessmentType", "CASE l_returnflag WHEN 'N' THEN 'Summative' WHEN 'A' THEN ' summative ' ELSE 'Interim ICA' END"),
        ("AssessmentName", f"CASE {k} % 5 WHEN 0 THEN concat('Grade ', {g}, ' ELA') WHEN 1 THEN (CASE WHEN {p} % 4 = 0 THEN '{ICA_MATH_11}' ELSE concat('Grade ', {g}, ' Math') END) WHEN 2 THEN {cast_name} WHEN 3 THEN 'Summative ELPAC' ELSE 'Summative Alternate ELPAC' END"),
        ("SubmitDateTime", f"CASE WHEN {k} % 53 = 0 THEN 'pending' ELSE {submit} END"),
        # reloads; text order of file names differs from numeric order (batch_9 > batch_10)
        ("file_name", f"concat('batch_', {_s(f'{n} + ({k} % 2) * 5')})"),
        ("GradeLevelWhenAssessed", _grade_text(p)),
        ("ScaleScore", f"CASE WHEN {k} % 61 = 0 THEN 'n/a' ELSE concat({_s(f'1370 + ({k} * 7 + {n} * 13) % 260')}, CASE WHEN {k} % 31 = 0 THEN '.5' ELSE '' END) END"),
        ("ScaleScoreAchievementLevel", f"CASE WHEN {n} = 4 THEN concat(' Level ', {level}, ' ') ELSE concat('Level ', {level}) END"),
        ("LexileMeasure", f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {_s(f'400 + ({k} + {n}) % 900')} END"),
        ("proficiency", f"cast(({k} + {n}) % 2 as double)"),
        ("dfs_ela", f"cast(({k} + {n}) % 200 - 100 as double)"),
        ("dfs_math", f"cast(({k} + {n}) % 150 - 75 as double)"),
        ("dfs_cast", f"cast(({k} + {n}) % 120 - 60 as double)"),
    ]
    cols += [(d, _domain(f"({k} + {n})", i)) for i, d in enumerate(PASCAL_DOMAINS)]
    return cols


STATE_PASCAL = Adapter("state_results_pascal", [Branch("lineitem", _pascal_columns())])


# ---- the whole feeds: 68 columns in 24-25, 47 in 25-26 ---------------------------------------
_PERSON_FIELDS = ["FirstName", "LastOrSurname", "TestSessionId", "SchoolYear", "Status", "Reporting Category"]
_SCORE_FIELDS = ["Error Band Min", "Error Band Max", "LexileRangeMin", "LexileRangeMax", "QuantileMeasure", "QuantileRangeMin", "QuantileRangeMax"]
_GROUP_FIELDS = ["MigrantStatus", "EnglishLanguageAcquisitionStatus", "Language", "HispanicOrLatinoEthnicity", "AmericanIndianOrAlaskaNative",
                 "Asian", "BlackOrAfricanAmerican", "White", "NativeHawaiianOrOtherPacificIslander", "DemographicRaceTwoOrMoreRaces", "Filipino"]
#: 24-25 only: ELPAC parts, and older ELA and Math claims (the doubles are scores, errors and two indicators)
_OLD_TEXT = ["elpac__oral_language_level", "elpac__written_language_level", "elpac__listening", "elpac__speaking", "elpac__speaking_indicator", "elpac__reading",
             "elpac__writing", "elpac__writing_indicator", "math__mathematical_practices", "ela__reading_and_listening", "ela__writing_and_research",
             "math__concepts_and_procedures_1"]
_OLD_DOUBLE = ["elpac__oral_language_scale_score", "elpac__oral_language_standard_error", "elpac__written_language_scale_score",
               "elpac__written_language_standard_error", "elpac__listening_indicator", "elpac__reading_indicator"]


def _more_columns(k: str, snake: bool) -> list[tuple[str, str]]:
    spelled = lambda name: name.lower().replace(" ", "_") if snake else name
    cols = [(spelled(f), f"concat('{f} ', {_s(f'{k} % {7 + i}')})") for i, f in enumerate(_PERSON_FIELDS)]
    # every column has rows without a value
    cols += [(spelled(f), f"CASE WHEN {k} % {5 + i} = 0 THEN NULL ELSE {_s(f'100 + ({k} * {3 + i}) % 800')} END") for i, f in enumerate(_SCORE_FIELDS)]
    cols += [(spelled(f), f"CASE {k} % {4 + i} WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE NULL END") for i, f in enumerate(_GROUP_FIELDS)]
    return cols


def _full_2425() -> list[tuple[str, str]]:
    k = "o_orderkey"
    cols = _snake_columns() + _more_columns(k, True)
    cols += [("submitdatetime", _s("o_orderdate")), ("file_name", f"concat('batch_', {_s(f'{k} % 9')})")]
    cols += [(f, _domain(k, i)) for i, f in enumerate(_OLD_TEXT)]
    return cols + [(f, f"CASE WHEN {k} % {6 + i} = 0 THEN NULL ELSE cast({k} % {90 + i} as double) END") for i, f in enumerate(_OLD_DOUBLE)]


def _full_2526() -> list[tuple[str, str]]:
    own = [(c, e) for c, e in _pascal_columns() if not c.startswith(("CAST: ", "ELPAC: "))]  # not out yet when the feeds are stacked
    return own + [("SchoolName", f"concat('School ', {_s('l_partkey % 7')})")] + _more_columns("l_orderkey", False)


FULL_2425 = Adapter("state_results_2425_full", [Branch("orders", _full_2425())])
FULL_2526 = Adapter("state_results_2526_full", [Branch("lineitem", _full_2526())])


# ---- archived 24-25 outputs (students no longer on the roster keep these rows) --------------
def _archive_common(k: str) -> list[tuple[str, str]]:
    return [
        ("studentidentifier", f"CASE WHEN {k} % 40 = 0 THEN NULL ELSE {k} + 9000000000 END"),
        ("student_number", f"{k} + 100000"),
    ]


def _archive_roster(k: str) -> list[tuple[str, str]]:
    return [
        ("lastfirst", f"concat('Last', {_s(k)}, ', First', {_s(k)})"),
        ("grade_level", f"cast({k} % 13 as int)"),
        ("elastatus", f"CASE {k} % 4 WHEN 0 THEN 'EL' WHEN 1 THEN 'EO' WHEN 2 THEN 'RFEP' ELSE NULL END"),
        ("race", f"CASE WHEN {k} % 17 = 0 THEN NULL ELSE c_mktsegment END"),
        ("school_name", f"concat('School ', {_s('c_nationkey % 7')})"),
        ("sped_identifier", f"CASE WHEN {k} % 8 = 0 THEN 'Yes' ELSE 'No' END"),
        ("absenteeism_status", "'Archived'"),
    ]


def _sbac_archive_columns() -> list[tuple[str, str]]:
    k = "c_custkey"
    d = lambda i: f"CASE WHEN ({k} + {i}) % 7 = 0 THEN NULL ELSE cast(1 + ({k} + {i}) % 3 as double) END"
    return _archive_common(k) + [
        ("ela_assessmentname", "'ELA Summative'"),
        ("ela_scalescoreachievementlevel", f"concat('Level ', {_s(f'1 + {k} % 4')})"),
        ("ela_proficiency", f"cast({k} % 2 as double)"),
        ("ela_dfs", f"cast({k} % 200 - 100 as double)"),
        ("ela_scalescore", _s(f"1400 + {k} % 200")),
        ("ela_lexilemeasure", _s(f"500 + {k} % 700")),
        ("ela__reading", d(0)), ("ela__writing", d(1)), ("ela__listening", d(2)), ("ela__research_and_inquiry", d(3)),
        ("24_ela_scalescoreachievementlevel", f"concat('Level ', {_s(f'1 + ({k} + 1) % 4')})"),
        ("24_ela_dfs", f"cast({k} % 90 - 45 as double)"),
        ("24_proficiency", f"cast(({k} + 1) % 2 as double)"),
        ("math_assessmentname", "'Math Summative'"),
        ("math_scalescoreachievementlevel", f"concat('Level ', {_s(f'1 + ({k} + 2) % 4')})"),
        ("math_proficiency", f"cast(({k} + 1) % 2 as double)"),
        ("math_dfs", f"cast({k} % 150 - 75 as double)"),
        ("math_scalescore", _s(f"1410 + {k} % 190")),
        ("math_lexilemeasure", f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {_s(f'450 + {k} % 600')} END"),
        ("math__concepts_and_procedures", d(4)), ("math__problem_solving_and_modeling___data_analysis", d(5)),
        ("math__communicating_reasoning", d(6)),
        ("24_math_scalescoreachievementlevel", f"concat('Level ', {_s(f'1 + ({k} + 3) % 4')})"),
        ("24_math_dfs", f"cast({k} % 80 - 40 as double)"),
    ] + _archive_roster(k) + [
        ("english_teacher", f"concat('English Teacher ', {_s('c_nationkey % 9')})"),
        ("math_teacher", f"concat('Math Teacher ', {_s('c_nationkey % 8')})"),
        ("intervention", f"CASE WHEN {k} % 23 = 0 THEN 'Group 1' ELSE NULL END"),
    ]


def _cast_archive_columns() -> list[tuple[str, str]]:
    k = "c_custkey"
    cast_name = f"CASE {k} % 3 WHEN 0 THEN '{CAST_NAMES[0]}' WHEN 1 THEN '{CAST_NAMES[1]}' ELSE '{CAST_NAMES[2]}' END"
    return _archive_common(k) + [
        ("assessmentname", cast_name),
        ("scalescoreachievementlevel", f"concat('Level ', {_s(f'1 + {k} % 4')})"),
        ("proficiency", f"cast({k} % 2 as double)"),
        ("cast_dfs", f"cast({k} % 120 - 60 as double)"),
        ("scalescore", _s(f"1390 + {k} % 210")),
        ("lexilemeasure", f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {_s(f'420 + {k} % 500')} END"),
        ("cast__life_sciences", "CAST(NULL AS STRING)"),
        ("cast__physical_sciences", f"CASE WHEN {k} % 2 = 0 THEN 'Near Standard' ELSE NULL END"),
        ("cast__earth_and_space_sciences", "CAST(NULL AS STRING)"),
    ] + _archive_roster(k) + [
        ("teacher", f"concat('Science Teacher ', {_s('c_nationkey % 6')})"),
    ]


# students without live results are kept from the archive; live ones are suppressed
SBAC_ARCHIVE = Adapter("sbac_archive", [Branch("customer", _sbac_archive_columns())])
CAST_ARCHIVE = Adapter("cast_archive", [Branch("customer", _cast_archive_columns())])

INTERVENTION = Adapter("intervention", [Branch("customer", [
    # null numbers match nobody
    ("student_number", "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey + 100000 END"),
    ("intervention", f"concat('Group ', {_s('c_custkey % 4')})"),
])])


# ---- assessment feeds for the unified table -------------------------------------------------
def _event_feed(source_expr: str, *, score: str, grade: str = "cast(user_id % 13 as int)",
                student: str = "user_id + 100000", partial: bool = False) -> list[tuple[str, str]]:
    e = "event_id"
    cols = [
        ("data_source", source_expr),
        ("assessment_id", e),
        ("year", f"CASE WHEN {e} % 2 = 0 THEN '24-25' ELSE '25-26' END"),
        ("date_taken", "cast(ts as date)"),
        ("grade", grade),
        ("local_student_id", student),
        ("test_type", f"CASE {e} % 5 WHEN 0 THEN 'Checkpoint' WHEN 1 THEN ' exit ticket ' WHEN 2 THEN NULL ELSE 'Unit Test' END"),
        ("curriculum", f"CASE {e} % 4 WHEN 0 THEN 'ELA' WHEN 1 THEN ' math ' WHEN 2 THEN 'Science' ELSE 'History' END"),
        ("unit", f"concat('Unit ', {_s(f'{e} % 6')})"),
        ("unit_labels", f"concat('U', {_s(f'{e} % 6')})"),
        ("title", f"concat('Assessment ', {_s(f'{e} % 40')})"),
        ("standard_code", f"CASE WHEN {e} % 3 = 0 THEN 'Percent correct' ELSE concat('STD.', {_s(f'{e} % 10')}) END"),
        ("score", score),
        ("performance_band_level", f"cast({e} % 4 as int)"),
        ("performance_band_label", f"CASE {e} % 4 WHEN 0 THEN 'Below' WHEN 1 THEN 'Approaching' WHEN 2 THEN 'Meets' ELSE 'Exceeds' END"),
        ("proficiency", f"CASE WHEN {e} % 6 = 0 THEN NULL WHEN {e} % 6 = 1 THEN ' ' ELSE 'Met' END"),
    ]
    if partial:
        drop = {"assessment_id", "date_taken", "unit_labels", "performance_band_level", "performance_band_label", "proficiency"}
        cols = [c for c in cols if c[0] not in drop]
    return cols


def _order_feed(source: str) -> list[tuple[str, str]]:
    k, c = "o_orderkey", "o_custkey"
    return [
        ("data_source", f"'{source}'"),
        ("assessment_id", k),
        ("year", f"CASE WHEN {k} % 2 = 0 THEN '24-25' ELSE '25-26' END"),
        ("date_taken", "cast(o_orderdate as date)"),
        ("grade", f"cast({c} % 13 as int)"),
        ("local_student_id", f"{c} + 100000"),
        ("test_type", f"CASE {k} % 3 WHEN 0 THEN 'Checkpoint' WHEN 1 THEN 'Interim' ELSE NULL END"),
        ("curriculum", f"CASE {k} % 3 WHEN 0 THEN 'ELA' WHEN 1 THEN 'Math' ELSE 'Science' END"),
        ("unit", f"concat('Unit ', {_s(f'{k} % 5')})"),
        ("unit_labels", f"concat('U', {_s(f'{k} % 5')})"),
        ("title", f"concat('Interim ', {_s(f'{k} % 12')})"),
        ("standard_code", f"CASE WHEN {k} % 2 = 0 THEN 'percent' ELSE concat('STD.', {_s(f'{k} % 8')}) END"),
        ("score", f"CASE WHEN {k} % 7 = 0 THEN NULL ELSE cast({k} % 101 as double) END"),
        ("performance_band_level", _s(f"{k} % 4")),
        ("performance_band_label", f"CASE {k} % 2 WHEN 0 THEN 'Low' ELSE 'High' END"),
        ("proficiency", f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE 'Standard Met' END"),
    ]


_LINE_FEED = [
    ("data_source", "'pear'"),
    ("assessment_id", "l_orderkey"),
    ("year", "CASE WHEN l_orderkey % 2 = 0 THEN '24-25' ELSE '25-26' END"),
    ("date_taken", "cast(l_shipdate as date)"),
    ("grade", "cast(l_partkey % 13 as int)"),
    ("local_student_id", "l_partkey + 100000"),
    ("test_type", "CASE WHEN l_linenumber = 3 THEN 'Checkpoint' ELSE 'Quiz' END"),
    ("curriculum", "CASE l_linenumber % 3 WHEN 0 THEN 'ELA' WHEN 1 THEN 'Math' ELSE 'Science' END"),
    ("unit", f"concat('Unit ', {_s('l_linenumber')})"),
    ("title", f"concat('Lesson ', {_s('l_suppkey % 25')})"),
    ("standard_code", "CASE WHEN l_linenumber % 2 = 0 THEN 'Percent correct' ELSE 'STD.P' END"),
    ("score", "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END"),
    ("performance_band_level", _s("l_linenumber % 4")),
    ("performance_band_label", "CASE WHEN l_quantity > 25 THEN 'High' ELSE 'Low' END"),
    ("proficiency", "CASE WHEN l_quantity > 25 THEN 'Proficient' ELSE 'Developing' END"),
]

FEEDS = {
    "feed_illuminate": Adapter("feed_illuminate", [Branch("events", _event_feed("'illuminate'", score="value"), where="event_type = 'view'")]),
    # float ids and whole-number float scores: text form must not carry '.0'
    "feed_iready": Adapter("feed_iready", [Branch("events", _event_feed(
        "CASE WHEN event_id % 9 = 0 THEN ' iReady ' ELSE 'iready' END", score="cast(round(value, 0) as double)",
        student="cast(user_id + 100000 as double)"), where="event_type = 'click'")]),
    "feed_star": Adapter("feed_star", [Branch("events", _event_feed(
        "'star'", score="value", grade="cast(user_id % 13 as double)"), where="event_type = 'signup'")]),
    # dibels scores are band labels, blanks or numbers
    "feed_dibels": Adapter("feed_dibels", [Branch("events", _event_feed(
        "CASE WHEN event_id % 9 = 0 THEN 'DIBELS' ELSE 'dibels' END",
        score=f"CASE event_id % 4 WHEN 0 THEN 'Well Below Benchmark' WHEN 1 THEN '' ELSE {_s('cast(round(value, 0) as bigint)')} END"),
        where="event_type = 'purchase'")]),
    "feed_sbac_prior": Adapter("feed_sbac_prior", [Branch("events", _event_feed("'CERS'", score="value", partial=True), where="event_type = 'error'")]),
    "feed_interim_2": Adapter("feed_interim_2", [Branch("orders", _order_feed("CERS"), where="o_orderstatus = 'F'")]),
    "feed_interim_3": Adapter("feed_interim_3", [Branch("orders", _order_feed("illuminate"), where="o_orderstatus = 'P'")]),
    "feed_pear_summaries": Adapter("feed_pear_summaries", [Branch("orders", [c for c in _order_feed("pear") if c[0] != "unit_labels"], where="o_orderstatus = 'O'")]),
    "feed_pear_responses": Adapter("feed_pear_responses", [Branch("lineitem", _LINE_FEED)]),
}


def _diag(k: str, mod: int, prefix: str) -> str:
    return f"CASE WHEN {k} % {mod} = 0 THEN NULL ELSE concat('{prefix}', {_s(f'{k} % 3')}) END"


DIAGNOSTICS = Adapter("diagnostics", [Branch("orders", [
    # several rows per student with different null patterns
    ("local_student_id", "o_custkey + 100000"),
    ("boy_composite_dibels", _diag("o_orderkey", 2, "BC")),
    ("boy_ela_overall_relative_placement", _diag("o_orderkey", 3, "BE")),
    ("boy_math_overall_relative_placement", _diag("o_orderkey", 5, "BM")),
    ("moy_composite_dibels", _diag("o_orderkey", 3, "MC")),
    ("moy_ela_overall_relative_placement", _diag("o_orderkey", 2, "ME")),
    ("moy_math_overall_relative_placement", _diag("o_orderkey", 7, "MM")),
    ("eoy_composite_dibels", _diag("o_orderkey", 5, "EC")),
    ("eoy_ela_overall_relative_placement", _diag("o_orderkey", 7, "EE")),
    ("eoy_math_overall_relative_placement", _diag("o_orderkey", 2, "EM")),
])])


# ---- meals ------------------------------------------------------------------------------------
def _iso_ts(ts: str, suffix: str) -> str:
    two = lambda e: f"lpad({_s(e)}, 2, '0')"
    return (f"concat({_s(f'cast({ts} as date)')}, 'T', {two(f'hour({ts})')}, ':', {two(f'minute({ts})')}, ':', "
            f"{two(f'cast(second({ts}) as int)')}, {suffix})")


MEAL_APPLICATIONS = Adapter("meal_applications", [Branch("events", [
    ("student_id", "CASE WHEN event_id % 41 = 0 THEN NULL ELSE cast(user_id + 100000 as double) END"),
    ("academic_year", "CASE event_id % 3 WHEN 0 THEN '2025-2026' WHEN 1 THEN '2026/2027' ELSE '2026-2027' END"),
    ("application_status", "CASE event_id % 12 WHEN 0 THEN 'Processed' WHEN 1 THEN 'Reviewed' WHEN 2 THEN 'Second Review' "
                           "WHEN 3 THEN 'Verification' WHEN 4 THEN 'Submitted' WHEN 5 THEN 'On Hold' "
                           "WHEN 6 THEN 'In Progress (Incomplete)' WHEN 7 THEN 'In Progress (Draft)' WHEN 8 THEN 'Invalid' "
                           "WHEN 9 THEN 'Duplicate' WHEN 10 THEN 'Unknown' ELSE NULL END"),
    ("eligibility_type", "CASE WHEN event_id % 2 = 0 THEN 'Free' ELSE 'Reduced' END"),
    ("eligibility_benefit_type", "CASE event_id % 9 WHEN 0 THEN 'CalFresh (SNAP)' WHEN 1 THEN ' calworks ' WHEN 2 THEN 'MEDICAID' "
                                 "WHEN 3 THEN 'Medicaid Reduced' WHEN 4 THEN 'Homeless' WHEN 5 THEN ' migrant ' "
                                 "WHEN 6 THEN 'Foster' WHEN 7 THEN 'Other' ELSE NULL END"),
    # UTC or -07:00 offsets (late evening local time is the next UTC day); unparseable text
    ("application_date", f"CASE WHEN event_id % 37 = 0 THEN 'bad' WHEN event_id % 2 = 0 THEN {_iso_ts('ts', chr(39) + 'Z' + chr(39))} "
                         f"ELSE {_iso_ts('ts', chr(39) + '-07:00' + chr(39))} END"),
    ("mealapplicationid", "event_id"),
    ("familymealapplicationid", "event_id % 500"),
    ("personid", "user_id + 700000"),
    ("school", f"concat('School ', {_s('user_id % 7')})"),
    ("firstname", f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('First', {_s('user_id')}) END"),
    ("lastname", f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('Last', {_s('user_id')}) END"),
    ("grade", _s("user_id % 13")),
])])

MEAL_PARTICIPATION = Adapter("meal_participation", [Branch("orders", [
    ("student_id", "CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE cast(o_custkey + 100000 as double) END"),
    # shifted by 28 years (a multiple of 4, so leap days stay valid)
    ("participation_date", f"concat({_s('year(o_orderdate) + 28')}, '-', lpad({_s('month(o_orderdate)')}, 2, '0'), '-', lpad({_s('day(o_orderdate)')}, 2, '0'))"),
    ("meal_type", "CASE o_orderkey % 3 WHEN 0 THEN 'Breakfast' WHEN 1 THEN 'Lunch' ELSE 'Snack' END"),
    ("school", f"concat('School ', {_s('o_custkey % 7')})"),
    ("grade", _s("o_custkey % 13")),
    ("eligibility_at_meal", "CASE WHEN o_orderkey % 4 = 0 THEN 'Free' ELSE 'Paid' END"),
    ("personid", "o_custkey + 700000"),
    ("customerdocumentid", "o_orderkey"),
])])


# ---- enrollment snapshots -----------------------------------------------------------------
def _split(name: str, table: str, cols: list[tuple[str, str]], key: str, parity: int) -> Adapter:
    return Adapter(name, [Branch(table, cols, where=f"{key} % 2 = {parity}")])


_INCOMING = [("student_name", "c_name"), ("nation", "c_nationkey"), ("balance", "c_acctbal"), ("segment", "c_mktsegment")]
_PIPELINE = [("applicant", "s_name"), ("nation", "s_nationkey"), ("balance", "s_acctbal")]
ENROLLMENT = {
    "incoming_2025": _split("incoming_2025", "customer", _INCOMING, "c_custkey", 0),
    "incoming_2026": _split("incoming_2026", "customer", _INCOMING, "c_custkey", 1),
    "pipeline_2025": _split("pipeline_2025", "supplier", _PIPELINE, "s_suppkey", 0),
    "pipeline_2026": _split("pipeline_2026", "supplier", _PIPELINE, "s_suppkey", 1),
    # race is an integer code one year and text the next
    "registrations_2025": _split("registrations_2025", "customer", [("student_name", "c_name"), ("race", "c_nationkey"), ("balance", "c_acctbal")], "c_custkey", 0),
    "registrations_2026": _split("registrations_2026", "customer", [("student_name", "c_name"), ("race", "c_mktsegment"), ("balance", "c_acctbal")], "c_custkey", 1),
}

BUDGET = Adapter("budget", [Branch("part", [
    ("school_name", f"concat('School ', {_s('p_partkey % 7')})"),
    # grades 0-13: grade 13 has no students
    # no budget row for grade 3 of School 6: its seats are those of grade 13
    ("grade_level", "cast(CASE WHEN p_partkey % 7 = 6 AND floor(p_partkey / 7) % 14 = 3 THEN 13 ELSE floor(p_partkey / 7) % 14 END as int)"),
    ("budgeted_enrollment", f"CASE WHEN min(p_partkey) = 8 THEN '0' ELSE {_s('20 + min(p_partkey) % 30')} END"),
], group_by=("school_name", "grade_level"))])


# ---- skill practice ---------------------------------------------------------------------------
IXL_SCORES = Adapter("ixl_scores", [Branch("lineitem", [
    ("local_student_id", _s("l_orderkey % 1500 + 100000")),
    ("skill_name", f"concat('skill ', {_s('l_partkey % 50')})"),
    ("score", "cast(l_quantity * 2 as bigint)"),
    ("subject", "CASE WHEN l_partkey % 2 = 0 THEN 'math' ELSE 'ela' END"),
    ("curriculum", "CASE WHEN l_linenumber % 2 = 0 THEN 'Core' ELSE 'Extension' END"),
])])
# 45 skill names; the scores use 50, so five never match
IXL_SKILLS = Adapter("ixl_skill_names", [Branch("supplier", [
    ("skill_name", f"concat('skill ', {_s('s_suppkey % 45')})"),
    ("subject", "CASE WHEN (s_suppkey % 45) % 2 = 0 THEN 'math' ELSE 'ela' END"),
    ("date_assigned", "cast(concat('2024-09-', lpad(" + _s("1 + (s_suppkey % 45) % 28") + ", 2, '0')) as date)"),
], group_by=("skill_name", "subject", "date_assigned"))])
IXL_ARCHIVE = Adapter("ixl_archive", [Branch("orders", [
    ("local_student_id", _s("o_custkey + 100000")),
    ("skill_name", f"concat('skill ', {_s('o_orderkey % 45')})"),
    ("date_assigned", "cast(concat('2024-09-', lpad(" + _s("1 + (o_orderkey % 45) % 28") + ", 2, '0')) as date)"),
    ("score", "cast(o_orderkey % 100 as bigint)"),
    ("subject", "CASE WHEN (o_orderkey % 45) % 2 = 0 THEN 'math' ELSE 'ela' END"),
    ("curriculum", "'Core'"),
])])


# ---- assignment updates, stored grades ----------------------------------------------------
ASSIGNMENT_UPDATES = Adapter("assignment_updates", [Branch("events", [
    ("assessment_id", "event_id % 40"),
    ("user_id", "user_id"),
    ("teacher_username", f"concat('t', {_s('event_id % 3')})"),
    ("status", "CASE WHEN event_id % 4 = 0 THEN 'GRADED' ELSE 'SUBMITTED' END"),
    ("assignment_status", "CASE WHEN event_id % 7 = 0 THEN 'IN_PROGRESS' ELSE 'DONE' END"),
    ("submitted_date", "ts"),
    ("event_id", "event_id"),
    ("points", "value"),
])])

STORED_GRADES = Adapter("stored_grades", [Branch("orders", [
    ("partitiontime", "cast(concat(" + _s("year(o_orderdate)") + ", '-01-01') as date)"),
    ("course_name", f"concat('Course ', {_s('o_orderkey % 30')})"),
    ("grade_level", "cast(o_custkey % 13 as int)"),
    ("grade", "CASE o_orderkey % 9 WHEN 0 THEN '0' WHEN 1 THEN '4' WHEN 2 THEN 'B+' WHEN 3 THEN 'A-' WHEN 4 THEN 'F' "
              "WHEN 5 THEN 'P' WHEN 6 THEN 'C+/D-' WHEN 7 THEN '' ELSE NULL END"),
    ("teacher_name", f"concat('Last', {_s('o_custkey % 40')}, ', First', {_s('o_custkey % 40')})"),
    ("student_number", "o_custkey + 100000"),
    ("storecode", "CASE WHEN o_orderkey % 2 = 0 THEN 'S1' ELSE 'S2' END"),
])])
ROSTER_SNAPSHOTS = Adapter("roster_snapshots", [Branch("orders", [
    ("partitiontime", "cast(concat(" + _s("year(o_orderdate)") + ", '-01-01') as date)"),
    ("student_number", "o_custkey + 100000"),
])])
COURSE_CATEGORY = Adapter("course_category", [Branch("part", [
    ("course_name", f"concat('Course ', {_s('p_partkey % 30')})"),
    ("grade_level", _s("p_partkey % 13")),
    ("category", "CASE min(p_partkey) % 5 WHEN 0 THEN 'Core' WHEN 1 THEN 'Elective' WHEN 2 THEN 'AP' WHEN 3 THEN 'Honors' ELSE 'Support' END"),
], group_by=("course_name", "grade_level"))])
# placeholder names of 20 teachers (of the 40 in the grade book) map to display names
TEACHER_ALIASES = Adapter("teacher_aliases", [Branch("supplier", [
    ("last_name", f"concat('Last', {_s('s_suppkey % 20')})"),
    ("first_name", f"concat('First', {_s('s_suppkey % 20')})"),
    ("teacher_name", f"concat('Teacher ', {_s('s_suppkey % 20')})"),
], group_by=("last_name", "first_name", "teacher_name"))])


ADAPTERS: dict[str, Adapter] = {
    a.name: a
    for a in [
        ROSTER, STATE_SNAKE, STATE_2324, STATE_PASCAL, FULL_2425, FULL_2526, SBAC_ARCHIVE, CAST_ARCHIVE, INTERVENTION,
        *FEEDS.values(), DIAGNOSTICS, MEAL_APPLICATIONS, MEAL_PARTICIPATION, *ENROLLMENT.values(), BUDGET,
        IXL_SCORES, IXL_SKILLS, IXL_ARCHIVE, ASSIGNMENT_UPDATES, STORED_GRADES, ROSTER_SNAPSHOTS,
        COURSE_CATEGORY, TEACHER_ALIASES,
    ]
}
