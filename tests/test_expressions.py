"""Layer 1: business expressions and dialect helpers on literal edge rows (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import columns as C
from kestrel.functions import rules as R


def one_col(spark, values, dtype=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def evaluate(spark, values, expr_fn, dtype=T.StringType()):
    df = one_col(spark, values, dtype)
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_elpi_level(spark):
    rows = [("Level 1", "elpac", None), ("Level 4", "elpac", None), ("Level 2", "elpac", "2H"),
            ("Level 3", "elpac", None), ("Level 2", "alternate", "2H"), ("None", "alternate", None),
            (" Level 1 ", "elpac", None), ("level 1", "elpac", None)]
    df = spark.createDataFrame(rows, "level string, track string, code string")
    got = [r[0] for r in df.select(R.elpi_level("level", "track", "code")).collect()]
    assert got == ["1", "4", "2H", None, "2", None, "1", None]


def test_elpi_level_rank(spark):
    got = evaluate(spark, ["1", "2L", "2H", "3L", "3H", "4", "2", "3", " 4 ", "2l", None], R.elpi_level_rank)
    assert got == [1, 2, 3, 4, 5, 6, 2, 3, 6, None, None]


def test_grade_band_text(spark):
    vals = [None, "K", "kg", "0", "G0", "9", "G10", "9-10", "12", "11-12", "03", "G5", "8", "TK", "-1", "13", "", "G09"]
    got = evaluate(spark, vals, lambda c: R.grade_band(c, T.StringType()))
    assert got == [None, "K", "K", "K", "K", "9-10", "9-10", "9-10", "11-12", "11-12", "3", "5", "8",
                   None, None, None, None, "9-10"]


def test_grade_band_int(spark):
    got = evaluate(spark, [None, 0, 1, 8, 9, 10, 11, 12, 13, -1], lambda c: R.grade_band(c, T.IntegerType()), T.IntegerType())
    assert got == [None, "K", "1", "8", "9-10", "9-10", "11-12", "11-12", None, None]


def test_submit_datetime(spark):
    vals = ["May 29, 2026", " May 29, 2026 ", "Jun  3, 2026", "Jun 03, 2026", "pending", None]
    got = evaluate(spark, vals, C.parse_month_day_year)
    assert got == [dt.date(2026, 5, 29), dt.date(2026, 5, 29), dt.date(2026, 6, 3), dt.date(2026, 6, 3), None, None]


def test_normalized_grade(spark):
    got = evaluate(spark, ["0", "4", "B+", "A-", "C+/D-", "P", "5", None], R.normalized_grade)
    assert got == ["F", "A", "B", "A", "C/D", "P", "5", None]


def test_school_years(spark):
    got = evaluate(spark, [dt.date(2025, 7, 1), dt.date(2025, 6, 30)], C.school_year_from_date, T.DateType())
    assert got == ["2025-2026", "2024-2025"]
    assert evaluate(spark, ["25-26"], C.school_year_from_roster_year) == ["2025-2026"]
    assert evaluate(spark, ["2026/2027"], lambda c: F.replace(c, F.lit("/"), F.lit("-"))) == ["2026-2027"]


def test_eligibility_category(spark):
    got = evaluate(spark, [" CalFresh (SNAP) ", "HOMELESS", None, "x", " migrant "], R.eligibility_category)
    assert got == ["Direct Certification", "Homeless", "Meal Application", "Meal Application", "Migrant"]


def test_score_label_split(spark):
    df = spark.createDataFrame([("85.5", "Met"), ("Well Below Benchmark", None), ("x", "Met"), ("", " "), ("85d", "Met")],
                               "score string, prof string")
    s, p = R.score_label_split(F.col("score"), F.col("prof"))
    got = [tuple(r) for r in df.select(s, p).collect()]
    # '85d' is not a plain numeric literal in the source dialect
    assert got == [(85.5, "Met"), (None, "Well Below Benchmark"), (None, "Met"), (None, None), (None, "Met")]


def _growth_rows(spark):
    rows = [  # eligible, track, level, prev_level, score, prev_score
        (1, "elpac", "2H", "2L", 1500.0, 1490.0),
        (1, "elpac", "4", "4", 1600.0, 1600.0),
        (1, "elpac", "3H", "3H", 1550.0, 1550.0),
        (1, "alternate", "2", "2", 20.0, 10.0),
        (1, "alternate", "2", "2", 19.0, 10.0),
        (1, "alternate", "3", "3", 10.0, 10.0),
        (0, "elpac", "2H", "2L", 1.0, 1.0),
        (1, "elpac", None, "2L", 1.0, 1.0),
        (1, "elpac", "2L", "2H", 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, "e int, track string, lvl string, plvl string, s double, ps double")


def test_growth_category(spark):
    df = _growth_rows(spark)
    got = [r[0] for r in df.select(R.elpi_growth_category(F.col("e"), F.col("lvl"), F.col("plvl"))).collect()]
    assert got == [R.GROWTH_PROGRESSED, R.GROWTH_MAINTAINED_4, R.GROWTH_MAINTAINED_LOW, None, None, None, None, None,
                   R.GROWTH_DECREASED]


def test_advanced_flag(spark):
    df = _growth_rows(spark)
    got = [r[0] for r in df.select(R.advanced_elpi(F.col("e"), F.col("track"), F.col("lvl"), F.col("plvl"),
                                                   F.col("s"), F.col("ps"))).collect()]
    assert got == [1, 1, 0, 1, 0, 1, 0, 0, 0]


def test_canon_text_floats(spark):
    vals = [85.0, 85.5, 8712345609.0, -0.0, 1e30, float("nan"), None, 12345678.5, 0.0001, 0.00012, -1.5e-7, 1.25e16]
    got = evaluate(spark, vals, lambda c: C.canon_text(c, T.DoubleType()), T.DoubleType())
    assert got[:4] == ["85", "85.5", "8712345609", "0"]
    assert got[4] == "1e+30" and got[5] == "NaN" and got[6] is None
    assert got[7:] == ["12345678.5", "0.0001", "0.00012", "-1.5e-07", "12500000000000000"]


def test_white_space_of_any_kind(spark):
    assert evaluate(spark, ["\tMath\n", "  x y ", "\u000b", None], C.norm) == ["math", "x y", "", None]
    got = evaluate(spark, ["\tJun  3, 2026\n", "Jun 3,\t2026"], C.parse_month_day_year)
    assert [str(d) for d in got] == ["2026-06-03", "2026-06-03"]


def test_long_fractions_are_cut(spark):
    got = evaluate(spark, ["2026-01-02T03:04:05.123456789Z", "2026-01-02T03:04:05.5+01:00"], C.parse_iso_offset)
    assert [g.microsecond for g in got] == [123456, 500000]


def test_round_to_long_half_away_from_zero(spark):
    assert evaluate(spark, [2.5, -2.5, 3.7, 3.2, None], C.round_to_long, T.DoubleType()) == [3, -3, 4, 3, None]


@pytest.mark.parametrize("text,expected", [("85", 85.0), ("-1.5e2", -150.0), (".5", 0.5), ("85d", None), ("n/a", None),
                                           (" 85", None), ("", None)])
def test_safe_double_strict(spark, text, expected):
    assert evaluate(spark, [text], C.safe_double) == [expected]


def test_safe_long(spark):
    assert evaluate(spark, ["12", "+3", "85.0", "x", None], C.safe_long) == [12, 3, None, None, None]
    assert evaluate(spark, [2.5, 85.0], lambda c: C.safe_long(c, T.DoubleType()), T.DoubleType()) == [3, 85]


def test_parse_iso_offset_and_utc_date(spark):
    vals = ["2025-08-01T23:30:00-07:00", "2025-08-01T10:00:00Z", "2025-08-01T10:00:00.123456+02:00", "2025-08-01", "bad", None]
    got = evaluate(spark, vals, lambda c: C.utc_date(C.parse_iso_offset(c)))
    assert got == [dt.date(2025, 8, 2), dt.date(2025, 8, 1), dt.date(2025, 8, 1), None, None, None]


def test_regex_first_null_on_no_match(spark):
    assert evaluate(spark, ["Level 3", "none", None], lambda c: C.regex_first(c, r"(\d+)")) == ["3", None, None]


def test_split_part_safe(spark):
    assert evaluate(spark, ["Last, First", "Solo"], lambda c: C.split_part(c, ",", 1, safe=True)) == [" First", None]


def test_rank_of_default(spark):
    got = evaluate(spark, ["Processed", "Duplicate", "Unknown", None], lambda c: C.rank_of(c, R.APPLICATION_STATUS_ORDER, 50))
    assert got == [1, 10, 50, 50]


def test_non_null_count(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, None)], "a int, b string, c string")
    assert [r[0] for r in df.select(C.non_null_count("a", "b", "c")).collect()] == [2, 0]


def test_cast_teacher_and_ica_curriculum(spark):
    df = spark.createDataFrame([(5, "M", "S"), (8, "M", "S"), (12, "M", "S"), (7, "M", "S")], "g int, m string, s string")
    assert [r[0] for r in df.select(R.cast_teacher("g", "m", "s")).collect()] == ["M", "S", "S", None]
    df2 = spark.createDataFrame([(" Math ", "X"), ("Math", "Y"), ("ELA", "X")], "subj string, name string")
    got = [r[0] for r in df2.select(R.ica_curriculum("subj", "name", "X", "Algebra II")).collect()]
    assert got == ["Algebra II", "Math", "ELA"]


def test_homeless_backfill(spark):
    df = spark.createDataFrame([("2026-2027", " yes "), ("2026-2027", "No"), ("2025-2026", "Yes"), ("2026-2027", None)],
                               "y string, h string")
    got = [r[0] for r in df.select(R.homeless_backfill("y", "h", "2026-2027")).collect()]
    assert got == [True, False, False, False]
