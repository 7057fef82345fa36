"""Equi-joins that stay even when a key holds a large part of the rows, on either side.

A preserved side cannot be split by the engine at run time when the *other* side is the skewed one, and a
full outer join cannot be split at all.  ``hot_key_join`` splits both sides by one plan, whatever the sizes:

1. ``heavy_hitters`` sketches the keys of a side (``approx_top_k``: one row, at most ``HOT_ITEMS`` keys); the
   row is a scalar subquery, so nothing is collected or joined for it.
2. A key that holds more than one task's share of the left rows gets ``a`` > 1 left salts, of the right rows
   ``b`` > 1 right salts; every other key has one of each.
3. A left row draws its left salt from a hash of the row's columns and is copied once for each of the key's ``b`` right
   salts; a right row the other way round.  Every pair of a left and a right row meets in exactly one cell of
   the a x b grid, and no cell holds more than its share of either side.
4. In an outer join a copy whose cell is empty on the other side comes out unmatched.  A copied row's key is
   in the sketch of the other side, so it has a partner in another cell: its unmatched copies are left out.

NULL keys never match; they are spread over buckets of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: keys a sketch reports, and counters it keeps; a key with more than rows / HOT_TRACKED is never missed
HOT_ITEMS = 256
HOT_TRACKED = 16384
#: NULL-key rows are spread over this many buckets
NULL_BUCKETS = 64
_KEY, _OTHER, _COPY, _CELL, _COPIED = (f"__kestrel_hot_{x}" for x in ("key", "other", "copy", "cell", "copied"))


def key_text(keys: Sequence[Column]) -> Column:
    """One text per key tuple, NULL if any part is."""
    if len(keys) == 1:
        return keys[0].cast("string")
    any_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    return F.when(~any_null, F.to_json(F.struct(*[k.cast("string").alias(f"k{i}") for i, k in enumerate(keys)])))


def heavy_hitters(df: DataFrame, keys: Sequence[str], tasks: int, salts: int) -> DataFrame:
    """One row with ``fans``: key text -> number of salts, for the keys that hold more rows than one of ``tasks`` equal parts.

    At most ``HOT_ITEMS`` keys, whatever the size of ``df``; a key's salts are its share of ``salts``.
    """
    text = key_text([F.col(f"`{k}`") for k in keys])
    top = df.select(text.alias(_KEY)).agg(F.expr(f"approx_top_k({_KEY}, {HOT_ITEMS}, {HOT_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    return top.select(F.expr(f"map_from_entries(transform(filter(top, t -> t.item IS NOT NULL AND t.count * {tasks} > n), "
                             f"t -> struct(t.item, cast(ceil(t.count * {salts} / n) AS bigint))))").alias("fans"))


def _dealt(df: DataFrame, keys: Sequence[str], own: Column | None, other: Column | None, left: bool) -> DataFrame:
    """``df`` with its grid cell: the own salt drawn by hash, one copy for each salt of the other side (None: no hot keys there).

    The hash is over the first three other columns: enough to spread a key, and few enough to prune the rest.
    """
    p = "_l" if left else "_r"
    text, one = key_text([F.col(f"`{k}`") for k in keys]), F.lit(1).cast("bigint")
    spread = [c for c in df.columns if c not in set(keys)][:3] or list(keys)
    fan = lambda fans: one if fans is None else F.coalesce(F.try_element_at(fans, text), one)
    # a key without salts has 0 here, which is no literal: it has to stay a join key
    mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread]), F.when(text.isNull(), F.lit(NULL_BUCKETS).cast("bigint")).otherwise(fan(own)))
    row, column = F.lit(1 << 31).cast("bigint") if left else one, one if left else F.lit(1 << 31).cast("bigint")
    if other is None:
        return df.withColumn(_CELL + p, mine * row)
    out = df.withColumns({_CELL + p: mine * row, _OTHER: fan(other)})
    out = out.withColumn(_COPY, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(_OTHER) - 1)))
    return out.withColumns({_CELL + p: F.col(_CELL + p) + F.col(_COPY) * column, _COPIED + p: F.col(_OTHER) > 1}).drop(_OTHER, _COPY)


def hot_key_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str, *,
                 left_sample: DataFrame | None = None, right_sample: DataFrame | None = None, sides: str | None = None,
                 tasks: int | None = None) -> DataFrame:
    """``left JOIN right ON l.a = r.b AND ...`` (``how``: inner, left, full); column names of the two sides must differ.

    ``sides`` ("left", "right", "both") are the sides whose hot keys are split.  A left join splits those of the right
    side, since the engine itself splits a preserved side at run time; the other joins split both.

    ``left_sample`` / ``right_sample`` are frames to sketch instead of the sides themselves, where a side is dear to
    compute twice: they need the side's key columns, and every key in them must occur in the side.  ``tasks`` is the
    number of tasks to spread over (the session's shuffle partitions).
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = tasks * max(4, min(16, 65536 // tasks))  # several salts a task, so that hashing them stays even
    sides = sides or ("right" if how == "left" else "both")
    a = heavy_hitters(left if left_sample is None else left_sample, lkeys, tasks, salts).scalar() if sides != "right" else None
    b = heavy_hitters(right if right_sample is None else right_sample, rkeys, tasks, salts).scalar() if sides != "left" else None
    l2, r2 = _dealt(left, lkeys, a, b, True), _dealt(right, rkeys, b, a, False)
    cond = reduce(lambda m, n: m & n, [F.col(f"`{x}`") == F.col(f"`{y}`") for x, y in on]) & (F.col(_CELL + "_l") == F.col(_CELL + "_r"))
    out = l2.join(r2, cond, how)
    if how in ("left", "full") and b is not None:  # a copied left row has its partner in another cell
        out = out.where(F.col(_CELL + "_r").isNotNull() | ~F.col(_COPIED + "_l"))
    if how == "full" and a is not None:
        out = out.where(F.col(_CELL + "_l").isNotNull() | ~F.col(_COPIED + "_r"))
    return out.select(*[F.col(f"`{c}`") for c in [*left.columns, *right.columns]])
