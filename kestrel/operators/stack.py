"""Stacking: schema alignment, positional UNION ALL, tagged snapshots, UNION DISTINCT."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_to(df: DataFrame, schema: T.StructType | Sequence[tuple[str, str]]) -> DataFrame:
    """Project ``df`` onto a target schema: cast present columns, NULL-fill absent ones, drop extras."""
    fields = [(f.name, f.dataType.simpleString()) for f in schema.fields] if isinstance(schema, T.StructType) else list(schema)
    present = {c.lower(): c for c in df.columns}
    cols = []
    for name, dtype in fields:
        src = present.get(name.lower())
        cols.append((F.col(f"`{src}`").cast(dtype) if src else F.lit(None).cast(dtype)).alias(name))
    return df.select(cols)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position (frames must already share one column order and types)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def stack_tagged(frames: Mapping[str, DataFrame], tag: str = "year") -> DataFrame:
    """UNION ALL of yearly snapshots, each tagged with its literal label in column ``tag``."""
    return union_all([df.withColumn(tag, F.lit(label)) for label, df in frames.items()])


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL then full-row DISTINCT (NULLs compare equal)."""
    return union_all(frames).distinct()
