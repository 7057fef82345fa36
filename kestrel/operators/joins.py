"""Join operators the source models need beyond plain equi-joins.

* ``equi_join``      — equi-join whose NULL-key rows are *salted*: they can never match, so instead
                       of hashing them all to one shuffle partition (a hot NULL group would land in
                       one task) each gets a bucket 1..N from a hash of its row, while matchable rows
                       carry bucket 0 on both sides.  Same rows, one scan, no hot partition.
* ``full_outer_null_safe`` — ``FULL OUTER JOIN`` whose NULL and hot keys are split on both sides (AQE
                       does not split skewed full outer joins); see ``hot_keys``.
* ``anti_any_key``   — keep left rows matching the right side on *none* of several keys
                       (``ON a.k1 = b.k1 OR a.k2 = b.k2 ... WHERE b IS NULL``).  An OR condition
                       plans as a nested-loop join; chained ``left_anti`` equi-joins on the
                       de-duplicated right keys are exact (NULL never matches) and shuffle-based.
* ``overlay``        — live rows win; archived rows only for entities the live side lacks.
* ``conditional_key_join`` — left join whose key switches per row (an exception list joins on
                       one id, everyone else on another): computed (kind, value) key pair.
* ``band_join``      — left join to a lookup of any size on an equality key plus ``x BETWEEN lo AND hi``: an
                       equi-join on the key and a cell of the value axis.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.hot_keys import hot_key_join

#: NULL-key rows are spread over this many hash buckets (per join)
NULL_KEY_BUCKETS = 64
_LS, _RS = "__kestrel_lsalt", "__kestrel_rsalt"


def null_key_salt(df: DataFrame, keys: Sequence[str], buckets: int = NULL_KEY_BUCKETS,
                  spread_by: Sequence[str] | None = None) -> Column:
    """0 when every key is set; else a bucket 1..``buckets`` from a hash of ``spread_by`` (deterministic).

    ``spread_by`` defaults to the first three non-key columns: a few columns spread a NULL group
    well enough, and hashing every column would defeat column pruning below the join.  The 0 is
    written as ``pmod(hash(keys), 1)``: a literal (or anything the optimizer can reduce to one,
    e.g. on a non-nullable key) would be folded out of the join keys into a residual condition,
    and the shuffle would again hash on the bare key.
    """
    spread = list(spread_by) if spread_by else [c for c in df.columns if c not in set(keys)][:3]
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread_hash = F.xxhash64(*[F.col(f"`{c}`") for c in spread or keys])
    zero = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1))
    return F.when(any_null, F.pmod(spread_hash, F.lit(buckets)) + 1).otherwise(zero)


def equi_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str,
              buckets: int = NULL_KEY_BUCKETS, spread_by: Sequence[str] | None = None) -> DataFrame:
    """``left JOIN right ON l.a = r.b AND ...`` (``how``: inner, left, left_anti, left_semi, full) with salted NULL keys.

    Key names of the two sides must differ.  ``spread_by`` names left-side columns that spread
    the left side's NULL-key rows (see ``null_key_salt``).
    """
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    # Both sides carry the salt; NULL-key rows of a side the join does not preserve are dropped
    # by Spark's inferred IS NOT NULL filters before the shuffle.
    l2 = left.withColumn(_LS, null_key_salt(left, lkeys, buckets, spread_by))
    r2 = right.withColumn(_RS, null_key_salt(right, rkeys, buckets))
    cond = reduce(lambda a, b: a & b, [l2[a] == r2[b] for a, b in on]) & (l2[_LS] == r2[_RS])
    out = l2.join(r2, cond, how)
    return out.drop(_LS) if how in ("left_anti", "left_semi") else out.drop(_LS, _RS)


def full_outer_null_safe(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *,
                         left_sample: DataFrame | None = None, right_sample: DataFrame | None = None) -> DataFrame:
    """``left FULL OUTER JOIN right ON left_key = right_key``; NULL keys never pair and are spread, hot ids are split."""
    return hot_key_join(left, right, [(left_key, right_key)], "full", left_sample=left_sample, right_sample=right_sample)


def anti_any_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Left rows that match no right row on any of the ``(left_key, right_key)`` pairs.

    The right side is reduced to its distinct key tuples (an anti join only asks whether a partner
    exists, so the tuple set serves every pair).
    """
    names = [f"__kestrel_anti_{i}" for i in range(len(pairs))]
    keyset = right.select(*[F.col(rk).alias(n) for (_, rk), n in zip(pairs, names)]).distinct()
    out = left
    for (lk, _), name in zip(pairs, names):
        out = equi_join(out, keyset.select(name), [(lk, name)], "left_anti")
    return out


def overlay(live: DataFrame, archive: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Archive rows for entities absent from ``live`` (any key of ``pairs`` = (archive_key, live_key))."""
    return anti_any_key(archive, live, pairs)


def conditional_key_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_id: str,
    left_number: str,
    right_id: str,
    right_number: str,
    exception_ids: Sequence[int],
    also_on: Sequence[tuple[str, str]] = (),
    how: str = "left",
) -> DataFrame:
    """Join ``(l.id = r.id AND l.id IN exceptions) OR (l.id NOT IN exceptions AND l.number = r.number)``.

    Three-valued logic is kept: a NULL ``left_id`` satisfies neither branch.  Each right row is
    exploded (one scan) into its key under its number and, only for exception ids, under its id.  Numbers
    that many rows share (0 = unknown) are split on both sides (``hot_key_join``).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    exc = [F.lit(x) for x in exception_ids]
    lid = F.col(left_id)
    l_kind = F.when(lid.isin(*exc), F.lit("id")).when(lid.isNotNull(), F.lit("number"))
    l_val = F.when(lid.isin(*exc), lid).when(lid.isNotNull(), F.col(left_number))
    l2 = left.withColumn("__kestrel_kind", l_kind).withColumn("__kestrel_val", l_val.cast("bigint"))

    rid = F.col(right_id)
    keys = F.array(
        F.struct(F.lit("number").alias("k"), F.col(right_number).cast("bigint").alias("v")),
        F.struct(F.lit("id").alias("k"), F.when(rid.isin(*exc), rid).cast("bigint").alias("v")),
    )
    r2 = (
        right.withColumn("__kestrel_rkey", F.explode(keys))
        .where(F.col("__kestrel_rkey.v").isNotNull())
        .withColumn("__kestrel_rkind", F.col("__kestrel_rkey.k"))
        .withColumn("__kestrel_rval", F.col("__kestrel_rkey.v"))
        .drop("__kestrel_rkey")
    )
    on = [("__kestrel_kind", "__kestrel_rkind"), ("__kestrel_val", "__kestrel_rval"), *also_on]
    return hot_key_join(l2, r2, on, how).drop("__kestrel_kind", "__kestrel_val", "__kestrel_rkind", "__kestrel_rval")


def band_join(
    left: DataFrame,
    bands: DataFrame,
    *,
    left_band: Column,
    left_value: Column,
    band_key: str,
    low: str,
    high: str,
    prefix: str,
    cell: float | None = None,
) -> DataFrame:
    """Left join a band table on ``band_key = left_band AND left_value BETWEEN low AND high``.

    The value axis is cut into cells of equal width; a band stands in every cell it touches and a row in the one
    cell of its value, so band key and cell make an equi-join whatever the number of bands of a key, and each band
    that holds the value is met once.  ``cell`` is the width, by default the mean length of a band (a scalar
    subquery): then all bands together stand in at most twice as many cells as there are bands.  Bands may
    overlap (one row each); a band with a NULL bound, or low > high, matches nothing.

    ``left_band`` may be NULL for rows that must not look up a band (conditions of the original ON clause on the
    left side): they keep their row with NULL band columns.  Spark broadcasts the band table if its size allows.
    """
    lo, hi = F.col(f"`{low}`").cast("double"), F.col(f"`{high}`").cast("double")
    real = bands.where(lo <= hi)
    if cell is None:
        mean = real.select(F.avg(hi - lo).alias("mean")).scalar()
        width = F.when(mean > 0, mean).otherwise(F.lit(1.0))
    else:
        width = F.lit(float(cell))
    touched = F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))
    b = real.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in bands.columns], touched.alias(f"{prefix}__cell"))
    lb, lv, lc = f"{prefix}__band", f"{prefix}__value", f"{prefix}__at"
    l2 = left.withColumn(lb, left_band).withColumn(lv, left_value).withColumn(lc, F.floor(F.col(lv).cast("double") / width))
    cond = ((F.col(lb) == F.col(f"{prefix}{band_key}")) & (F.col(lc) == F.col(f"{prefix}__cell"))
            & F.col(lv).between(F.col(f"{prefix}{low}"), F.col(f"{prefix}{high}")))
    return l2.join(b, cond, "left").drop(lb, lv, lc, f"{prefix}__cell")
