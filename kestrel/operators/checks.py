"""Data-quality checks.  Contract: a check is a query returning the *failing* rows; zero rows = pass.

Per-row checks (not null, accepted values, accepted range) compile to predicates and are
evaluated together in one aggregation pass by ``summarize``; key checks (unique combination,
no duplicates in a subset, required values present) cost one aggregation each.  Partial
aggregation runs before every shuffle, so a hot key is pre-counted map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RowCheck:
    """A per-row check: ``fails`` is true on a failing row."""

    name: str
    fails: Column


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null:{column}", F.col(column).isNull())


def accepted_values(column: str, values: Sequence, where: str | Column | None = None) -> RowCheck:
    """Values outside the list fail; NULL passes (as in SQL ``NOT IN`` with a row filter)."""
    c = F.col(column)
    fails = c.isNotNull() & ~c.isin(list(values))
    if where is not None:
        fails = fails & (F.expr(where) if isinstance(where, str) else where)
    return RowCheck(f"accepted_values:{column}", fails)


def accepted_range(column: str, min_value=None, max_value=None) -> RowCheck:
    c = F.col(column)
    fails = F.lit(False)
    if min_value is not None:
        fails = fails | (c < min_value)
    if max_value is not None:
        fails = fails | (c > max_value)
    return RowCheck(f"accepted_range:{column}", fails)


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: str | Column | None = None,
                   count_col: str = "row_count") -> DataFrame:
    """Key combinations occurring more than once (``GROUP BY keys HAVING COUNT(*) > 1``)."""
    if where is not None:
        df = df.where(F.expr(where) if isinstance(where, str) else where)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def missing_required_values(spark: SparkSession, df: DataFrame, column: str, required: Sequence[str]) -> DataFrame:
    """Required values absent from ``column`` (coverage check: required ▷ distinct existing)."""
    req = spark.createDataFrame([(v,) for v in required], T.StructType([T.StructField(column, T.StringType())]))
    existing = df.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct()
    return req.join(existing, column, "left_anti")


def summarize(df: DataFrame, checks: Sequence[RowCheck], unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One row per check: ``(check, failing_rows)``.

    Row checks and the first key check share one pass over ``df``: everything is counted per key, then
    totalled.  Each further key check is a pass of its own.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    fails = [total(F.when(F.coalesce(c.fails, F.lit(False)), 1).otherwise(0)).alias(f"__c{i}") for i, c in enumerate(checks)]
    names, unique = [c.name for c in checks], list(unique)
    if unique:
        first = unique.pop(0)
        per_key = df.groupBy(*first).agg(*fails, F.count(F.lit(1)).alias("__rows"))
        repeated = F.when(F.col("__rows") > 1, F.col("__rows")).otherwise(0)
        counts = per_key.agg(*[total(F.col(f"__c{i}")).alias(f"__c{i}") for i in range(len(checks))],
                             total(repeated).alias(f"__c{len(checks)}"))
        names.append(f"unique_combination:{'+'.join(first)}")
    else:
        counts = df.agg(*fails)
    stack = ", ".join(f"'{name}', __c{i}" for i, name in enumerate(names))
    out = counts.select(F.expr(f"stack({len(names)}, {stack}) AS (`check`, failing_rows)"))
    for keys in unique:
        dup = duplicate_keys(df, keys).agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("failing_rows"))
        out = out.unionByName(dup.select(F.lit(f"unique_combination:{'+'.join(keys)}").alias("check"), "failing_rows"))
    return out
