"""Scalar column helpers with the source dialect's semantics (all JVM-side, no UDFs).

The dialect differs from Spark defaults in a few places that matter for keys and scores:

* float → text prints whole numbers without ``.0`` (``canon_text``);
* float → integer rounds half away from zero (``round_to_long``);
* text → number is strict: only plain numeric literals convert (``safe_double``/``safe_long``);
* ``REGEXP_EXTRACT`` gives NULL, not '', when nothing matches (``regex_first``);
* ``%e`` in date formats allows a space-padded day (``parse_month_day_year``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed patterns
NUMERIC_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"
ISO_OFFSET_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"
MONTH_DAY_YEAR_FORMAT = "MMM d, yyyy"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qcol(name: str) -> Column:
    """Column by a name that may hold spaces, ':' or '&' (back-quoted)."""
    return F.col(f"`{name}`")


def trimmed(c: str | Column) -> Column:
    """``TRIM(x)``: white space of any kind at both ends goes."""
    return F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")


def norm(c: str | Column) -> Column:
    """``LOWER(TRIM(CAST(x AS STRING)))`` — case- and space-insensitive match key."""
    return F.lower(trimmed(c))


def canon_text(c: str | Column, dtype: T.DataType) -> Column:
    """``CAST(x AS STRING)`` as the source dialect prints it.

    Whole-number floats print without a fractional part (85.0 → '85'), so text keys built
    from float ids join with text keys built from integer ids.  Other floats print in plain digits
    from 0.0001 up to 1e15 (12345678.5), beyond that with a signed two-digit exponent (1e+30).
    """
    c = col(c)
    if not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.cast("string")
    as_long, text = c.try_cast("bigint"), c.cast("string")
    exponent = F.regexp_extract(text, r"E-?([0-9]+)$", 1)
    scientific = F.concat(F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)E", 1), r"\.0$", ""),
                          F.when(text.contains("E-"), F.lit("e-")).otherwise(F.lit("e+")),
                          F.when(F.length(exponent) < 2, F.concat(F.lit("0"), exponent)).otherwise(exponent))
    plain = F.regexp_replace(text.try_cast("decimal(38,22)").cast("string"), r"0+$", "")
    return (F.when(c == as_long, as_long.cast("string"))
            .when(~text.contains("E"), text)
            .when(F.abs(c).between(1e-4, 1e15), plain)
            .otherwise(scientific))


def round_to_long(c: str | Column) -> Column:
    """``CAST(float AS INT64)``: rounds half away from zero (Spark's plain cast truncates)."""
    return F.round(col(c), 0).cast("bigint")


def safe_double(c: str | Column) -> Column:
    """``SAFE_CAST(text AS FLOAT64)``: NULL unless the text is a plain numeric literal."""
    s = col(c).cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def safe_long(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """``SAFE_CAST(x AS INT64)`` for text (integer literals only) or numbers."""
    c = col(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.round(c, 0).try_cast("bigint")
        return c.cast("bigint")
    s = c.cast("string")
    return F.when(s.rlike(INTEGER_TEXT), s.try_cast("bigint"))


def regex_first(c: str | Column, pattern: str) -> Column:
    """``REGEXP_EXTRACT(x, r'(..)')``: first group, NULL when there is no match."""
    return F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit(""))


def parse_month_day_year(c: str | Column) -> Column:
    """``SAFE.PARSE_DATETIME('%b %e, %Y', TRIM(x))``: 'May 29, 2026' / 'Jun  3, 2026' → date, else NULL."""
    s = F.trim(F.regexp_replace(col(c).cast("string"), r"\s+", " "))
    return F.try_to_date(s, MONTH_DAY_YEAR_FORMAT)


def parse_iso_offset(c: str | Column) -> Column:
    """``SAFE.PARSE_TIMESTAMP('%Y-%m-%dT%H:%M:%E*S%Ez', x)`` → instant (NULL unless time and offset present).

    Any number of fractional digits is read; those past the sixth are cut off.
    """
    s = col(c)
    return F.when(s.rlike(ISO_OFFSET_TS), F.try_to_timestamp(F.regexp_replace(s, r"(\.[0-9]{6})[0-9]+", "$1"), F.lit(ISO_OFFSET_FORMAT)))


def utc_date(c: str | Column) -> Column:
    """``DATE(timestamp)`` — calendar date in UTC (the session runs in UTC)."""
    return F.to_date(col(c))


def split_part(c: str | Column, delim: str, index: int, *, safe: bool) -> Column:
    """``SPLIT(x, d)[OFFSET(i)]`` (strict) or ``[SAFE_OFFSET(i)]`` (NULL when absent); the delimiter is plain text, no pattern."""
    parts = F.split(col(c), re.escape(delim), -1)
    return F.get(parts, index) if safe else parts[index]


def school_year_from_date(d: str | Column) -> Column:
    """July-June school year: 2025-07-01 → '2025-2026', 2025-06-30 → '2024-2025'."""
    d = col(d)
    start = F.when(F.month(d) >= 7, F.year(d)).otherwise(F.year(d) - 1)
    # format_string prints a NULL argument as the text 'null': keep a missing date NULL
    return F.when(d.isNotNull(), F.format_string("%d-%d", start, start + 1))


def school_year_from_roster_year(y: str | Column) -> Column:
    """'25-26' → '2025-2026'."""
    y = col(y)
    return F.concat(F.lit("20"), split_part(y, "-", 0, safe=False), F.lit("-"), F.lit("20"), split_part(y, "-", 1, safe=False))


def non_null_count(*cols: str | Column) -> Column:
    """Number of non-null values among the columns (record richness)."""
    total = F.lit(0)
    for c in cols:
        total = total + col(c).isNotNull().cast("int")
    return total


def rank_of(c: str | Column, ranked: list[str], default: int) -> Column:
    """1-based position of the value in ``ranked``; ``default`` for anything else (NULL included)."""
    c = col(c)
    out = None
    for i, value in enumerate(ranked, start=1):
        out = F.when(c == value, F.lit(i)) if out is None else out.when(c == value, F.lit(i))
    return out.otherwise(F.lit(default))


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
