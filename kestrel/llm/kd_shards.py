"""Sharding: k-d tree partitioning at distributed weighted medians.

A node with several shards is split along its widest metadata dimension (its range over the range of the
whole table) at the weighted median, or at the share of the shards that go left, until a leaf is one
shard of about the target bytes.  Medians of all nodes of a level are found together: each round is one
aggregation of sizes into bins of the interval in question, which returns bins, not rows, and the next
round looks into the bin that holds the median.  Rows that tie in the dimension are ordered by a hash of
the text, then by id, so large ties can still be cut.  The search stops when the cut is within
``tolerance`` of a shard, which bounds how unequal shards can be.

Rows of equal texts are one point of the tree, at the smallest of their values in each dimension, so no cut
parts them and they share a shard.  A group of more than ``whole`` of a shard's bytes would make shards unequal:
its rows are points of their own.

Defined results: a null text has no bytes; a null id or metadata value counts as -1 in the order; rows that
repeat an id are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import ID, stage

BINS = 8192
#: the rows of one text meet its group in this many parts
SALTS = 64
_TIE = "__tie"


def order_number(df: DataFrame, column: str) -> Column:
    """A whole number in the order of the column (for text: of its first six bytes)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 6)), 12, "0")
        number = F.conv(head, 16, 10).cast("bigint")
    else:
        number = F.col(column).cast("bigint")
    return F.coalesce(number, F.lit(-1).cast("bigint"))


@dataclass
class Node:
    shards: int
    first: int
    dim: str = ""
    #: the cut: rows before (value, tie, id) go left; as many of the three as were needed
    cut: list[int] = field(default_factory=list)
    left: Node | None = None
    right: Node | None = None


def _before(dim: str, cut: Sequence[int]) -> str:
    """(dim, tie, id) < cut, compared in that order over the parts the cut has."""
    names = (dim, _TIE, "__idn")
    out = f"{names[len(cut) - 1]} < {cut[-1]}L"
    for name, value in reversed(list(zip(names, cut[:-1]))):
        out = f"({name} < {value}L OR ({name} = {value}L AND {out}))"
    return out


def _leaf(node: Node) -> str:
    """The first shard of the leaf a row is in."""
    if node.left is None:
        return str(node.first)
    return f"CASE WHEN {_before(node.dim, node.cut)} THEN {_leaf(node.left)} ELSE {_leaf(node.right)} END"


@dataclass
class _Search:
    target: float  # weight that should lie before the cut
    slack: float
    lo: int
    hi: int  # the interval, both ends in
    fixed: list[int] = field(default_factory=list)  # the value, then the tie, once single
    before: float = 0.0


def _medians(rows: DataFrame, open_nodes: list[tuple[Node, _Search]], here: str, ranges: dict[str, tuple[int, int]]) -> None:
    """Find the cuts of all nodes of a level, one aggregation a round."""
    todo = dict(enumerate(open_nodes))
    while todo:
        which, binned, value = [], [], []
        for k, (node, s) in todo.items():
            names = (node.dim, _TIE, "__idn")
            x = names[len(s.fixed)]
            inside = " AND ".join([f"leaf = {node.first}", *[f"{c} = {v}L" for c, v in zip(names, s.fixed)], f"{x} BETWEEN {s.lo}L AND {s.hi}L"])
            which.append(f"WHEN {inside} THEN {k}")
            binned.append(f"WHEN k = {k} THEN ({x} - {s.lo}L) DIV {-(-(s.hi - s.lo + 1) // BINS)}L")
            value.append(f"WHEN k = {k} THEN {x}")
        got = rows.selectExpr("*", f"{here} AS leaf").selectExpr("*", f"CASE {' '.join(which)} END AS k").where("k IS NOT NULL").selectExpr(
            "k", f"CASE {' '.join(binned)} END AS b", f"CASE {' '.join(value)} END AS x", "__w").groupBy("k", "b").agg(
            F.sum("__w").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n")).collect()  # BINS rows a node at most
        for k, (node, s) in list(todo.items()):
            bins = sorted((r["b"], r["w"], r["lo"], r["hi"], r["n"]) for r in got if r["k"] == k)
            level = len(s.fixed)
            for _, w, lo, hi, n in bins:  # noqa: B007  (the bin it ends at is used below)
                if s.before + w > s.target:
                    break
                s.before += w
            else:  # all of it lies before the target
                node.cut = [*s.fixed, s.hi + 1]
                del todo[k]
                continue
            short, over = s.target - s.before, s.before + w - s.target
            if min(short, over) <= s.slack or n == 1 or (lo == hi and level == 2):
                node.cut = [*s.fixed, lo if short <= over else hi + 1]
                del todo[k]
            elif lo == hi:
                s.fixed.append(lo)
                s.lo, s.hi = ranges[[_TIE, "__idn"][level]]
            else:
                s.lo, s.hi = lo, hi


def _with_points(rows: DataFrame, columns: Sequence[str], shards: int, whole: float) -> DataFrame:
    """Rows of one text get the smallest value of each of ``columns`` among them, unless the text is too large for that."""
    limit = rows.select(F.sum("__w") * whole / shards).scalar()
    groups = rows.groupBy(F.col("__text_sha").alias("__sha")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__w").alias("w"), *[F.min(c).alias(f"least{c}") for c in columns]).where((F.col("n") > 1) & (F.col("w") <= limit))
    # texts that stand once have no partner; the rows of a common one are spread over salts
    salted = groups.drop("n", "w").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("__spread", F.pmod(F.xxhash64(ID, *columns), F.lit(SALTS)).cast("int"))
    joined = spread.join(salted, (F.col("__text_sha") == F.col("__sha")) & (F.col("__spread") == F.col("__salt")), "left")
    return stage(joined.withColumns({c: F.coalesce(f"least{c}", c) for c in columns}).select(*[c for c in rows.columns if c != "__text_sha"]), "kd-points")


def kd_shards(docs: DataFrame, *, dims: Sequence[str], shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
              tolerance: float = 0.001, whole: float = 0.5) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = [f"__dim{i}" for i in range(len(dims))]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias(ID), order_number(docs, id_col).alias("__idn"),
        (F.octet_length(text) + 1).cast("bigint").alias("__w"), F.crc32(text.cast("binary")).alias("__crc"),
        F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)).alias(_TIE),
        *[order_number(docs, d).alias(n) for d, n in zip(dims, names)], F.unhex(F.sha2(text.cast("binary"), 256)).alias("__text_sha"))
    every = [*names, _TIE, "__idn"]
    rows = _with_points(stage(rows, "kd-rows"), [*names, "__idn"], shards, whole)
    spread = [F.min(c).alias(f"lo{c}") for c in every] + [F.max(c).alias(f"hi{c}") for c in every]
    total = rows.agg(F.coalesce(F.sum("__w"), F.lit(0)).alias("w"), *spread).first()
    ranges = {c: (total[f"lo{c}"] or 0, total[f"hi{c}"] or 0) for c in every}
    root = Node(shards, 0)
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        here = _leaf(root)
        stats = {r["k"]: r for r in rows.groupBy(F.expr(here).alias("k")).agg(F.sum("__w").alias("w"), *spread).collect()}  # a row per node
        open_nodes = []
        for node in level:
            s = stats.get(node.first)
            width = {n: (s[f"hi{n}"] - s[f"lo{n}"]) / max(1, ranges[n][1] - ranges[n][0]) if s else 0 for n in names}
            node.dim = max(names, key=lambda n: width[n])  # noqa: B023  (used at once)
            k = node.shards // 2
            node.left, node.right = Node(k, node.first), Node(node.shards - k, node.first + k)
            lo, hi = (s[f"lo{node.dim}"], s[f"hi{node.dim}"]) if s else (0, 0)
            weight = s["w"] if s else 0
            open_nodes.append((node, _Search(weight * k / node.shards, tolerance * total["w"] / shards, lo, hi)))
        for node, _ in open_nodes:  # rows are still in the unsplit nodes while the cuts are sought
            node.cut = []
        halves = {id(n): (n.left, n.right) for n, _ in open_nodes}
        for n, _ in open_nodes:
            n.left = n.right = None
        _medians(rows, open_nodes, _leaf(root), ranges)
        for n, _ in open_nodes:
            n.left, n.right = halves[id(n)]
        level = [half for n, _ in open_nodes for half in (n.left, n.right)]

    # slots: rows in ranges of (shard, id); a slot is the prefix sum of the ranges before plus the place in the range
    placed = rows.select(ID, F.col("__w").alias("size"), "__crc", F.expr(_leaf(root)).cast("int").alias("shard"), _TIE)
    ranged = placed.repartitionByRange("shard", F.col(ID).asc_nulls_first(), _TIE)
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "kd-placed")
    counts = ranged.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))  # a row per range and shard
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("shard").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part", "shard").orderBy(F.col(ID).asc_nulls_first(), _TIE)
    numbered = ranged.withColumn("n", F.row_number().over(within))
    out = numbered.join(bases, (numbered["shard"] == bases["s"]) & (numbered["part"] == bases["p"]))
    return out.select(F.col(ID).alias("doc_id"), "size", F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                      (F.col("base") + F.col("n") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
