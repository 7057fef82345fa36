"""The 25-26 state-results reload log: latest row per (student_number, assessment).

Order: parsed submit date desc (NULLs last), then file name desc as *text*.  Where the
source leaves ties open (same day, same file), the row that lies last in its file wins if the
input has row references (``register(..., row_reference=True)``), else every remaining column
decides, ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import parse_month_day_year
from kestrel.operators.dedupe import all_columns_tiebreak, keep_best, keep_best_by_reference, keep_best_of_latest
from kestrel.sources.registry import ROW_REFERENCE

RELOAD_KEYS = ["student_number", "AssessmentName"]


def latest_row_order(submit: str = "SubmitDateTime", file_name: str = "file_name") -> list[Column]:
    return [parse_month_day_year(submit).desc_nulls_last(), F.col(file_name).desc_nulls_last()]


def best_row(df: DataFrame, keys: list[str], order: list[Column], tiebreak: list[Column] | None = None) -> DataFrame:
    """First row per key; inputs with row references are read in full for the winners only."""
    if set(ROW_REFERENCE) <= set(df.columns):
        return keep_best_by_reference(df, keys, order, ROW_REFERENCE)
    return keep_best(df, keys, order, all_columns_tiebreak(df) if tiebreak is None else tiebreak)


def latest_reload(df: DataFrame) -> DataFrame:
    """Latest row per (student_number, AssessmentName) of a (filtered) reload-log frame."""
    if set(ROW_REFERENCE) <= set(df.columns):
        return best_row(df, RELOAD_KEYS, latest_row_order())
    by_file = latest_row_order()[1]  # of the latest submit date
    return keep_best_of_latest(df, RELOAD_KEYS, parse_month_day_year("SubmitDateTime"), [by_file], all_columns_tiebreak(df))
