"""Logical input registry.

A pipeline never names a physical table: it receives ``Inputs`` (logical name → DataFrame).
``load_inputs`` builds them from the driver's test tables through the adapters of
``fixtures`` — each a projection (plus filter) of one base table, so Spark prunes the scan
to the referenced columns and pushes the filter into the Parquet reader.  Production
deployments register real tables under the same logical names (``register``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.sources.fixtures import ADAPTERS, Adapter

Inputs = Mapping[str, DataFrame]

#: columns that tell the rows of a registered input apart: the file, and the place of the row in it
ROW_REFERENCE = ["__row_file", "__row_index"]


@dataclass(frozen=True)
class Registered:
    path: str
    provenance_column: str | None = None
    schema: T.StructType | None = None
    row_reference: bool = False


_REGISTERED: dict[str, Registered] = {}


class SchemaDrift(ValueError):
    """An input whose files do not have the declared columns."""


def register(logical_name: str, path: str, *, provenance_column: str | None = None, schema: T.StructType | str | None = None,
             row_reference: bool = False) -> None:
    """Point a logical input at a Parquet path (replaces the test-data adapter).

    The logical name is what pipelines use; ``path`` is the physical location, whatever it is
    called (names with hyphens, other projects).  ``provenance_column`` adds the name of the
    file each row was read from (``_metadata.file_name``) — the reload log breaks same-day ties
    on it.  ``schema`` (a StructType, or DDL text) declares the columns the files must have, no more and no fewer;
    it is checked against the files each time the input is read.  ``row_reference`` adds the columns
    ``ROW_REFERENCE``, by which a pipeline can choose rows before it reads their other columns.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    _REGISTERED[logical_name] = Registered(path, provenance_column, declared, row_reference)


def unregister(logical_name: str) -> None:
    _REGISTERED.pop(logical_name, None)


def read_registered(spark: SparkSession, logical_name: str) -> DataFrame:
    source = _REGISTERED[logical_name]
    df = spark.read.parquet(source.path)
    if source.schema is not None:
        problems = schema_drift(df.schema, source.schema)
        if problems:
            raise SchemaDrift(f"input {logical_name!r} at {source.path}: " + "; ".join(problems))
        df = df.select(*[F.col(_q(f.name)).alias(f.name) for f in source.schema.fields])
    extra = [F.col("_metadata.file_name").alias(source.provenance_column)] if source.provenance_column else []
    if source.row_reference:
        extra += [F.col("_metadata.file_path").alias(ROW_REFERENCE[0]), F.col("_metadata.row_index").alias(ROW_REFERENCE[1])]
    return df.select("*", *extra) if extra else df


def schema_drift(found: T.StructType, declared: T.StructType) -> list[str]:
    """What sets the columns of some files apart from the declared ones (names without regard to case), one text a column."""
    have = {f.name.lower(): f for f in found.fields}
    want = {f.name.lower(): f for f in declared.fields}
    out = [f"column {f.name!r} is missing" for k, f in want.items() if k not in have]
    out += [f"column {f.name!r} is not declared" for k, f in have.items() if k not in want]
    out += [f"column {f.name!r} is {have[k].dataType.simpleString()}, declared as {f.dataType.simpleString()}"
            for k, f in want.items() if k in have and have[k].dataType != f.dataType]
    return out


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The base table as a DataFrame, resolved anew each time (no reader is kept between queries)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def build_adapter(spark: SparkSession, sf_dir: str, adapter: Adapter) -> DataFrame:
    frames = []
    for br in adapter.branches:
        df = read_table(spark, sf_dir, br.table)
        if br.where:
            df = df.where(br.where)
        if br.group_by:
            keys = [F.expr(e).alias(n) for n, e in br.columns if n in br.group_by]
            aggs = [F.expr(e).alias(n) for n, e in br.columns if n not in br.group_by]
            grouped = df.groupBy(*keys)
            df = grouped.agg(*aggs) if aggs else grouped.agg(F.count(F.lit(1)).alias("__rows")).drop("__rows")
            frames.append(df.select(*[F.col(_q(n)) for n, _ in br.columns]))
            continue
        frames.append(df.selectExpr(*[f"{e} AS {_q(name)}" for name, e in br.columns]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def load_inputs(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Logical inputs by name (lazy DataFrames; nothing is read until an action runs)."""
    out = {}
    for name in names:
        if name in _REGISTERED:
            out[name] = read_registered(spark, name)
        elif name == "cut_scores":
            from kestrel.sources.seeds import cut_scores

            out[name] = cut_scores(spark)
        else:
            out[name] = build_adapter(spark, sf_dir, ADAPTERS[name])
    return out
