"""Merkle dataset manifest with incremental witnesses.

Leaves are appended in order to a list of open subtrees.  Each open subtree carries the leaves below it, and
each of these a partial witness: the siblings on its way up so far.  When an appended leaf completes a
sibling of the last open subtree, both become one, and every leaf on one side gets the other side's root
added to its witness.

Appends are aligned: a task appends one block of 2 ** ``block_bits`` consecutive leaves of a group, whose root
no other block shares.  The roots of blocks are then appended in the same way, block by block, until a group
has one root; the roots of the groups are appended last.  A leaf's whole witness is its own, followed by that
of its block, of the block of blocks, and so on.

Digests are sha256; those above the leaves are taken of the lowercase hex digests below, joined.  A witness is
a run of steps, each ``L`` or ``R`` and 32 bytes (a sibling on the left, on the right) or ``-`` alone (a level
where the node had no sibling).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import stage

_POSITION = (1 << 33) - 1  # low bits of monotonically_increasing_id: the place in the partition


def node(*below: bytes) -> bytes:
    """The digest of the digests ``below``."""
    return sha256(b"".join(d.hex().encode() for d in below)).digest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """sha256 over the fields: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


class Append:
    """Open subtrees over the leaves appended so far, each with the witnesses of its leaves."""

    def __init__(self):
        self.open: list[tuple[int, bytes, int]] = []  # (level, root, first leaf), levels falling
        self.witnesses: list[list[bytes]] = []

    def add(self, leaf: bytes) -> None:
        self.open.append((0, leaf, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def _join(self) -> None:
        (level, right, middle), (_, left, first) = self.open.pop(), self.open.pop()
        for witness in self.witnesses[first:middle]:
            witness.append(b"R" + right)
        for witness in self.witnesses[middle:]:
            witness.append(b"L" + left)
        self.open.append((level + 1, node(left, right), first))

    def close(self, level: int) -> bytes:
        """The root at ``level`` once nothing follows: a last node without a sibling goes up alone."""
        while len(self.open) > 1 or self.open[0][0] < level:
            at, root, first = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == at:
                self._join()
                continue
            for witness in self.witnesses[first:]:
                witness.append(b"-")
            self.open[-1] = (at + 1, node(root), first)
        return self.open[0][1]


def _with_binary(df: DataFrame, *names: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, T.BinaryType()) for n in names]])


def _append_block(block_bits: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending")])
        tree = Append()
        for digest in table.column("node").to_pylist():
            tree.add(digest)
        n = table.column("n")[0].as_py()
        root = tree.close(min(block_bits, (n - 1).bit_length()))
        table = table.append_column("witness", pa.array([b"".join(w) for w in tree.witnesses], pa.binary()))
        return table.append_column("root", pa.array([root] + [None] * (len(table) - 1), pa.binary()))

    return run


def _placed(nodes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``nodes`` with their place in their group (from 0) and the size ``n`` of the group.

    One range shuffle by group and order; a group takes as many partitions as it needs.  Places are those in
    the partition, moved by the rows of the group in earlier partitions.
    """
    by = [F.col("grp").asc(), *order]
    sorted_ = nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    rows = stage(sorted_, "merkle-order").withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(_POSITION))
    runs = rows.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    group = Window.partitionBy("grp").orderBy("part")
    before = F.coalesce(F.sum("rows").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("grp", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    return rows.join(runs, ["grp", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _climb(nodes: DataFrame, block_bits: int) -> list[DataFrame]:
    """Levels of blocks: (grp, place, n, node, witness, root, ...), ``root`` on the first row of a block."""
    width, levels = 1 << block_bits, []
    longest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        schema = _with_binary(nodes, "witness", "root")
        blocks = nodes.groupBy("grp", F.expr(f"place div {width}")).applyInArrow(_append_block(block_bits), schema)
        levels.append(stage(blocks, "merkle-level"))
        if longest <= width:
            return levels
        longest = -(-longest // width)
        nodes = levels[-1].where("root is not null").select(
            "grp", F.expr(f"place div {width}").alias("place"), F.expr(f"(n - 1) div {width} + 1").alias("n"), F.col("root").alias("node"))


def _joined_witness(levels: list[DataFrame], above: DataFrame, block_bits: int) -> DataFrame:
    """The rows of the lowest level, ``witness`` carried on to the top; ``above``: (grp, rest, ...) of whole groups."""
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for i, level in reversed(list(enumerate(levels))):
        rows = level.withColumn("block", F.expr(f"place div {1 << block_bits}"))
        joined = rows.drop("root").join(above, ["grp", "block"]).withColumn("rest", F.concat("witness", "rest")).drop("block", "witness", "n")
        above = joined.drop("node").withColumnRenamed("place", "block") if i else joined
    return above.withColumnRenamed("rest", "witness")


def merkle_manifest(docs: DataFrame, *, fields: Sequence[str], group: str, order: str, carry: Mapping[str, Column] | None = None,
                    block_bits: int = 12) -> DataFrame:
    """(``order`` column, leaf, subroot, root, witness, ``carry`` columns) for each row of ``docs``.

    A row's leaf covers its ``fields``.  Leaves of one ``group`` value ascend by ``order``; every two
    consecutive nodes become one until a group has its subroot, and the subroots, ordered by group, become the root.

    * Null fields are part of the leaf; a null group is a group of its own and the first one.
    * Rows without an ``order`` value come first; rows with equal ones are ordered by their leaf, so the roots do
      not depend on how the rows are dealt; repeated rows have equal leaves at places of their own.
    * A lone leaf is its group's subroot, a lone subroot the root.  Empty table: no rows.  Other columns are not read.
    * ``carry`` names further results, expressions over ``docs``; its names must differ from the others.
    """
    carried = dict(carry or {})
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # "-" sorts before "="
    leaves = docs.select(key.alias("grp"), F.col(order).cast("bigint").alias("doc"), leaf_digest([F.col(f) for f in fields]).alias("node"),
                         *[c.alias(f"carry_{name}") for name, c in carried.items()])
    levels = _climb(_placed(leaves, [F.col("doc").asc_nulls_first(), F.col("node").asc()]), block_bits)
    subroots = levels[-1].where("root is not null").select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node"))
    tops = _climb(_placed(subroots, [F.col("name").asc()]), block_bits)
    top = tops[-1].where("root is not null").select("grp", F.lit(b"").alias("rest"), F.col("root").alias("whole"))
    above = _joined_witness(tops, top, block_bits).select(F.col("name").alias("grp"), F.col("witness").alias("rest"), F.col("node").alias("subroot"), "whole")
    out = _joined_witness(levels, above, block_bits)
    return out.select(F.col("doc").alias(order), F.col("node").alias("leaf"), "subroot", F.col("whole").alias("root"), "witness",
                      *[F.col(f"carry_{name}").alias(name) for name in carried])


def steps(witness: bytes) -> Iterator[tuple[str, bytes]]:
    """(side, sibling) from the leaf up; side ``-`` has no sibling."""
    at = 0
    while at < len(witness):
        side = chr(witness[at])
        size = 0 if side == "-" else 32
        yield side, witness[at + 1: at + 1 + size]
        at += 1 + size


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for side, sibling in steps(witness):
        leaf = node(sibling, leaf) if side == "L" else node(leaf, sibling) if side == "R" else node(leaf)
    return leaf


def folded(manifest: DataFrame, leaf_col: str) -> DataFrame:
    """``manifest`` with ``folded`` (the root its ``leaf_col`` leads to) and ``proof`` (digest of the siblings)."""
    names = manifest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            witnesses = batch.column("witness").to_pylist()
            ends = [fold(leaf, w) for leaf, w in zip(batch.column(leaf_col).to_pylist(), witnesses)]
            proofs = [node(*[sibling for side, sibling in steps(w) if side != "-"]) for w in witnesses]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary()), pa.array(proofs, pa.binary())], names=[*names, "folded", "proof"])

    return manifest.mapInArrow(run, _with_binary(manifest, "folded", "proof"))
