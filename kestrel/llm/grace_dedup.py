"""Exact dedup: Grace hash deduplication.

Records are partitioned by the bits of a content hash into buckets (the shuffle files are the spill
files); a bucket whose content does not fit a table is partitioned again by the next bits, until each fits.
Each bucket's records then stream through an open-addressing table that compares complete content, so a
collision of hashes never merges two texts.  A bucket that further bits cannot split, because all of it has
one hash, is a group of copies: its records are dealt over several tables, each of which keeps one copy,
and those copies go through one more table.  So no task sees a whole large group.

Defined results: a null text is empty; rows that repeat an id count as rows of their own, and the first in
the order (most code points, smallest id, nulls last) stays, one of equal rows being chosen; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ID, ROW, TEXT, keyed_texts, stage, tidy

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
#: bits of the hash a level of partitioning takes
LEVEL_BITS = 8
#: content of a bucket that one table holds
TABLE_BYTES = 64 << 20
_HASH, _LEAF, _CONTENT = "__hash", "__leaf", "__content"


class ContentTable:
    """Open addressing with linear probing over (hash, complete content)."""

    def __init__(self, slots: int = 1024):
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[str] = []

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        for i, h in enumerate(self.hashes):
            at = h % len(self.slots)
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at] = i

    def find_or_add(self, h: int, content: str) -> tuple[int, bool]:
        """(entry, whether it is new)."""
        at = h % len(self.slots)
        while (i := int(self.slots[at])) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return i, False
            at = (at + 1) % len(self.slots)
        i = len(self.hashes)
        self.slots[at] = i
        self.hashes.append(h)
        self.contents.append(content)
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return i, True


def _prefix(level: int):
    """The bits of the first ``level`` + 1 levels."""
    return F.col(_HASH).bitwiseAND(F.lit((1 << (LEVEL_BITS * (level + 1))) - 1))


def leaves(sizes: DataFrame, table_bytes: int) -> tuple[list[set[int]], dict[int, int]]:
    """Partition level by level: the buckets too large at each level, and single hashes too large with their bytes.

    ``sizes`` has (hash, bytes).  A level asks only about buckets inside those too large at the level before,
    and the driver gets only buckets over ``table_bytes``: as many as the content is tables long.
    """
    levels: list[set[int]] = []
    hot: dict[int, int] = {}
    inside = sizes
    for level in range(63 // LEVEL_BITS):
        grouped = inside.groupBy(_prefix(level).alias("b")).agg(
            F.sum("bytes").alias("bytes"), F.min(_HASH).alias("lo"), F.max(_HASH).alias("hi"))
        large = grouped.where(F.col("bytes") > table_bytes).collect()
        hot |= {r["lo"]: r["bytes"] for r in large if r["lo"] == r["hi"]}
        split = {r["b"] for r in large if r["lo"] != r["hi"]}
        if not split:
            break
        levels.append(split)
        inside = inside.where(_prefix(level).isin(split))
    return levels, hot


_ROWS = f"{ID} long, row_no long, {ROW} long, points int, sha string, entry string, content string, {_HASH} long"


def _dedup_buckets(records: DataFrame, keep_content: bool) -> DataFrame:
    """Stream each bucket, sorted together, through a table; ``entry`` names the table entry of a record."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, table = None, ContentTable()
        task = TaskContext.get().partitionId()
        row_no = task << 40
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in (_LEAF, _HASH, _CONTENT, "salted")}
            entries, contents = [], []
            for at, h, content, salted in zip(*cols.values()):
                if at != leaf:
                    leaf, table = at, ContentTable()
                i, new = table.find_or_add(h, content)
                entries.append(f"{at}.{task}.{i}")
                contents.append(content if new and (keep_content and salted) else None)
            numbers = pa.array(np.arange(row_no, row_no + batch.num_rows))
            row_no += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(ID), numbers, batch.column(ROW), batch.column("points"), batch.column("sha"), pa.array(entries, pa.string()),
                                              pa.array(contents, pa.string()), batch.column(_HASH)],
                                             [ID, "row_no", ROW, "points", "sha", "entry", "content", _HASH])

    return records.repartition(F.col(_LEAF)).sortWithinPartitions(_LEAF, _HASH).mapInArrow(run, _ROWS)


def grace_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and a hash of the text as it is."""
    text = F.coalesce(F.col(TEXT), F.lit(""))
    content = text
    for blank in _BLANKS:
        content = F.replace(content, F.lit(blank), F.lit(""))
    records = keyed_texts(docs, id_col, text_col).select(ID, ROW, F.char_length(text).alias("points"), content.alias(_CONTENT)).withColumn(
        _HASH, F.xxhash64(_CONTENT).bitwiseAND(F.lit((1 << 63) - 1))).withColumn("sha", F.sha2(_CONTENT, 256))
    levels, hot = leaves(records.select(_HASH, (F.octet_length(_CONTENT) + 64).cast("long").alias("bytes")), table_bytes)

    # the leaf of a record: the bits down to the first level at which its bucket fits; the level tells prefixes apart
    leaf = F.concat_ws("-", F.lit(len(levels)), _prefix(len(levels)))
    for level in reversed(range(len(levels))):
        leaf = F.when(_prefix(level).isin(levels[level]), leaf).otherwise(F.concat_ws("-", F.lit(level), _prefix(level)))
    salt = F.lit(None).cast("string")
    for h, size in hot.items():  # at most as many as there are tables' lengths of content
        tables = 1 + size // table_bytes
        salt = F.when(F.col(_HASH) == h, F.concat_ws("-", F.lit("hot"), _HASH, F.pmod(F.xxhash64(ID, "points"), F.lit(tables)))).otherwise(salt)
    records = records.withColumn("salted", salt.isNotNull()).withColumn(_LEAF, F.coalesce(salt, leaf))

    rows = stage(_dedup_buckets(records, keep_content=True), "dedup-rows")
    if hot:
        # entries of a hot hash: one more table over one copy from each; all other entries are groups already
        copies = rows.where(F.col("content").isNotNull()).select(
            F.lit(None).cast("long").alias(ID), F.lit(0).cast("long").alias(ROW), F.lit(0).alias("points"), F.col("entry").alias("sha"), F.col("content").alias(_CONTENT),
            _HASH, F.concat_ws("-", F.lit("merge"), _HASH).alias(_LEAF), F.lit(False).alias("salted"))
        merged = _dedup_buckets(copies, keep_content=False).select(F.col("sha").alias("of"), F.col("entry").alias("into"))
        named = stage(rows.join(merged, rows["entry"] == merged["of"], "left").withColumn("entry", F.coalesce("into", "entry"))
                      .drop("of", "into"), "dedup-groups")
    else:
        named = rows
    named = named.select(ID, "row_no", ROW, "points", "sha", F.col("entry").alias("grp"))
    first = F.min(F.struct((-F.col("points")).alias("points"), F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), F.col("row_no").alias("row_no")))
    groups = named.groupBy("grp").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")).select(
        F.col("grp").alias("g"), F.col("first.id").alias("keep_id"), F.col("first.row_no").alias("keep_row"), "group_size")
    joined = named.join(groups, named["grp"] == groups["g"])
    return joined.select(F.col(ID).alias("doc_id"), "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"),
                         F.col("sha").alias("text_sha256"), F.col(ROW).alias("text_hash"))
