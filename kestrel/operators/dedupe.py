"""keep_best: one row per key, chosen by an ordered preference (top-1 per group).

Planned as ``row_number() over (partition by keys order by ...) = 1``.  Spark rewrites this
filter into ``WindowGroupLimit``: a *partial* group limit runs in every map task before the
shuffle (each task forwards at most one row per key), and the final limit after it.  A hot
key (e.g. every row with a NULL student number) therefore ships at most one row per map task
instead of all of its rows, so skew in the key does not pile up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.columns import col


def keep_best(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    tiebreak: Sequence[Column] = (),
    *,
    rank_column: str | None = None,
) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order`` (then ``tiebreak``).

    ``order`` items are sort expressions (``col.desc_nulls_last()`` etc.); ``tiebreak`` makes the
    choice deterministic where the source leaves ties open.  ``rank_column`` keeps the row
    number in the output under that name (always 1), as some views expose it.
    """
    rn = rank_column or "__kestrel_rn"
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order, *tiebreak)
    kept = df.withColumn(rn, F.row_number().over(window)).where(F.col(rn) == 1)
    return kept if rank_column else kept.drop(rn)


def keep_best_of_latest(df: DataFrame, keys: Sequence[str], latest: Column, order: Sequence[Column], tiebreak: Sequence[Column] = ()) -> DataFrame:
    """``keep_best`` under ``latest`` descending (NULL last), then ``order`` and ``tiebreak``.

    The greatest ``latest`` of each key is aggregated first, on narrow rows and without a sort; rows that do not have
    it leave in a hash semi join, so only the few that tie on it are sorted in full.  The value is a join key too, which
    spreads the rows of a hot key.
    """
    names = [f"__kestrel_k{i}" for i in range(len(keys))]
    valued = df.withColumn("__kestrel_latest", latest)
    best = valued.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(F.max("__kestrel_latest").alias("__kestrel_best"))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip([*keys, "__kestrel_latest"], [*names, "__kestrel_best"])]
    tied = valued.join(best.hint("shuffle_hash"), reduce(lambda a, b: a & b, same), "left_semi").drop("__kestrel_latest")
    return keep_best(tied, keys, order, tiebreak)


def keep_best_by_reference(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], reference: Sequence[str]) -> DataFrame:
    """``keep_best`` that reads only keys, order columns and the ``reference`` of a row to choose the winners.

    ``reference`` names columns that tell the rows of ``df`` apart (the file and the place of a row in it); of rows
    that tie, the last reference wins.  The winners' other columns are fetched by a semi join, so the window sorts
    narrow rows, and a column that nobody selects afterwards is never read.  ``reference`` is dropped.
    """
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order, *[F.col(f"`{r}`").desc_nulls_last() for r in reference])
    winners = df.withColumn("__kestrel_rn", F.row_number().over(window)).where("__kestrel_rn = 1").select(*[F.col(f"`{r}`").alias(f"__kestrel_ref_{i}") for i, r in enumerate(reference)])
    same = reduce(lambda a, b: a & b, [F.col(f"`{r}`") == F.col(f"__kestrel_ref_{i}") for i, r in enumerate(reference)])
    return df.join(winners, same, "left_semi").drop(*reference)


def all_columns_tiebreak(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """Total order over the remaining columns (ascending, nulls first) for deterministic ties."""
    return [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in set(exclude)]
