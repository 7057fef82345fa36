"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector, in blocks: a task holds one block of vectors and one block of
queries, so no pair of rows ever goes through a shuffle.  A pass gives each query a histogram of its scores
inside the interval that is known to hold its k-th best one; the global sums of these histograms choose the
bin with the k-th best score, and that bin is the interval of the next pass.  After the pass whose bins are
one score wide the k-th best score of every query is known, with the number of scores above it.  A last pass
keeps what is above and, of the ties at the k-th score, the smallest ids.

Of a block's histogram only the bins down to the one that completes ``k`` are shuffled: the k-th best score
of all blocks cannot be lower than that of one block, and no bin below is ever summed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import renewed, stage

#: scores are clipped to this size, a double, so that sums of two of them fit 64 bits
CLIP = (1 << 62) - 512
#: whole numbers up to this size are exact as doubles
EXACT = 1 << 53
_STRIP = 1 << 20  # scores handled at a time in a task


def _quantised(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = column.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            keep, vectors, norms, tops = [], [], [], []
            with np.errstate(over="ignore", invalid="ignore"):
                floors = np.floor(values * scale)
                squares = np.square(floors)
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                part = floors[a:b]
                if not np.isfinite(part).all():  # a null component is read as NaN
                    continue
                top = float(np.abs(part).max(initial=0))
                keep.append(i)
                vectors.append(part.astype("<i4" if top < 1 << 31 else "<f8").tobytes())
                norms.append(float(np.sqrt(squares[a:b].sum())))
                tops.append(top)
            rows = batch.select(["row", "block", "id", "is_query"]).take(pa.array(keep, pa.int64()))
            sizes = (offsets[1:] - offsets[:-1])[keep]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(vectors, pa.binary()), pa.array(sizes, pa.int32()), pa.array(norms, pa.float64()), pa.array(tops, pa.float64())],
                names=["row", "block", "id", "is_query", "vec", "size", "norm", "top"])

    return run


def _matrix(table: pa.Table, width: int, exact: bool) -> np.ndarray:
    """The vectors of a block, filled up with zeros to ``width``."""
    out = np.zeros((table.num_rows, width), np.float64)
    for i, (raw, size) in enumerate(zip(table.column("vec").to_pylist(), table.column("size").to_pylist())):
        out[i, :size] = np.frombuffer(raw, "<i4" if len(raw) == 4 * size else "<f8")
    if exact:
        return out
    return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)


def _numbers(table: pa.Table, name: str, exact: bool) -> np.ndarray:
    values = table.column(name).to_numpy()
    return values.astype(np.float64) if exact else np.array([int(x) for x in values], dtype=object)


def _scores(vectors: pa.Table, queries: pa.Table, width: int, exact: bool) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(queries, scores, whether a score takes part) by strips of queries."""
    a, b = _matrix(vectors, width, exact), _matrix(queries, width, exact)
    rows, asked = vectors.column("row").to_numpy(), queries.column("row").to_numpy()
    step = max(1, _STRIP // max(1, len(a)))
    for first in range(0, len(b), step):
        part = slice(first, first + step)
        s = b[part] @ a.T
        if not exact:
            s = np.clip(s, -CLIP, CLIP)
        yield part, s, rows[None, :] != asked[part, None]


def _blockwise(vectors: DataFrame, queries: DataFrame, blocks: int, query_blocks: int, fn, schema: str) -> DataFrame:
    """``fn(block of vectors, block of queries)`` for every pair of blocks."""
    left = vectors.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("query_block", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("block", "query_block").cogroup(renewed(right).groupBy("block", "query_block")).applyInArrow(fn, schema)


def _histograms(bins: int, k: int, width: int, exact: bool):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        asked, found = queries.column("row").to_numpy(), ([], [], [])
        low, length, step = (_numbers(queries, c, exact)[:, None] for c in ("low", "length", "step"))
        need = k - queries.column("above").to_numpy()
        for part, s, takes_part in _scores(vectors, queries, width, exact) if queries.num_rows and vectors.num_rows else ():
            s = s - low[part]
            inside = takes_part & (s >= 0) & (s < length[part])  # what is higher is in ``above``
            place = np.arange(len(s))[:, None] * bins + np.where(inside, s // step[part], 0).astype(np.int64)
            counts = np.bincount(place[inside], minlength=len(s) * bins).reshape(-1, bins)
            higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
            q, b = np.nonzero((counts > 0) & (higher < need[part, None]))
            for out, values in zip(found, (asked[part][q], b, counts[q, b])):
                out.append(values)
        row, bin_, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        return pa.table({"row": pa.array(row, pa.int64()), "bin": pa.array(bin_, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def _selected(k: int, width: int, exact: bool):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        vectors = vectors.sort_by([("id", "ascending")])  # nulls last
        ids, asked = vectors.column("id").combine_chunks(), queries.column("row").to_numpy()
        names = queries.column("id").combine_chunks()
        low, need = _numbers(queries, "low", exact), k - queries.column("above").to_numpy()
        parts = []
        for part, s, takes_part in _scores(vectors, queries, width, exact) if queries.num_rows and vectors.num_rows else ():
            tie = takes_part & (s == low[part, None])
            keep = (takes_part & (s > low[part, None])) | (tie & (tie.cumsum(axis=1) <= need[part, None]))
            q, v = np.nonzero(keep)
            parts.append(pa.table({
                "row": pa.array(asked[part][q], pa.int64()), "query_id": names.take(pa.array(q + part.start)),
                "vec_id": ids.take(pa.array(v)), "score": pa.array([int(x) for x in s[q, v]], pa.int64())}))
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("row", "query_id", "vec_id", "score")})
        return pa.concat_tables([empty, *parts])

    return run


def exact_top_k(vectors: DataFrame, *, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                scale: int = 256, bins: int = 1024, block_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row where ``is_query``.

    A component x counts as floor(scale * x); a score is the inner product of these whole numbers.  Equal
    scores go to the smaller id.  Every row but the query's own is a candidate.

    * A vector that is null or holds a null or a non-finite component takes no part (also where scale * x is not finite).
    * Vectors of unequal length: the missing components count as 0; an empty vector scores 0.
    * A row without an id is a candidate (after all ids among ties) and never a query unless ``is_query`` says so.
    * Repeated ids and rows are rows of their own: each asks, and each can be found by the other.
    * Fewer than ``k`` candidates: all of them.  Empty table: no rows.  Other columns are not read.
    * Scores beyond 2^53 are computed in long integers; beyond 2^62 they are clipped.
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-vectors.count() // block_rows))
    dealt = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
                           F.col(vector_col).cast("array<double>").alias("vector")).where(F.col("vector").isNotNull()).repartition(blocks)
    rows = dealt.select(F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("block"), "id", "is_query", "vector")
    cells = stage(rows.mapInArrow(_quantised(scale), "row long, block int, id long, is_query boolean, vec binary, size int, norm double, top double"), "topk-cells")
    total = cells.agg(F.max("norm").alias("norm"), F.max("top").alias("top"), F.max("size").alias("size"),
                      F.count_if("is_query").alias("queries"), F.max(F.when(F.col("is_query"), F.col("norm"))).alias("asked")).first()
    if not total["queries"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = total["size"]
    exact = total["top"] * total["top"] * max(1, width) < EXACT
    query_blocks = -(-total["queries"] // block_rows)

    def reach(norm):  # no score of the query is larger: its norm times the largest one
        return F.least(F.lit(float(CLIP)), F.ceil(norm * F.lit(total["norm"] * (1 + 1e-9))).cast("double") + 1) if exact else F.lit(float(CLIP))

    found = cells.where("is_query").select("row", "id", "vec", "size", reach(F.col("norm")).cast("bigint").alias("reach"))
    # the k-th best score lies in [low, low + length); ``above`` scores are higher
    state = found.select("row", (-F.col("reach")).alias("low"), (2 * F.col("reach") + 1).alias("length"), F.lit(0).cast("bigint").alias("above"))
    longest = 2 * (int(np.ceil(total["asked"] * total["norm"] * (1 + 1e-9))) + 1 if exact else CLIP) + 1
    left = cells.select("block", "row", "id", "vec", "size")
    asked = found.select("row", "id", "vec", "size")
    while longest > 1:
        now = state.withColumn("step", F.expr(f"(length - 1) div {bins} + 1"))
        counts = _blockwise(left.drop("id"), asked.drop("id").join(now, "row"), blocks, query_blocks,
                            _histograms(bins, k, width, exact), "row long, bin long, n long")
        down = Window.partitionBy("row").orderBy(F.col("bin").desc())
        sums = counts.groupBy("row", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        placed = sums.join(now, "row").where("above + upto >= {0} and above + upto - n < {0}".format(k)).select(
            "row", (F.col("low") + F.col("bin") * F.col("step")).alias("low"), F.col("step").alias("length"), (F.col("above") + F.col("upto") - F.col("n")).alias("above"))
        # fewer than k candidates: the interval stays, and its lower end lets all of them through
        few = state.join(placed.select("row"), "row", "left_anti").withColumn("length", F.lit(1).cast("bigint"))
        state = stage(placed.unionByName(few), "topk-state")
        longest = -(-longest // bins)
    best = _blockwise(left, asked.join(state.drop("length"), "row"), blocks, query_blocks, _selected(k, width, exact),
                      "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
