"""Sinks: views that follow their sources, and tables that are replaced in one step.

* A temp view over a DataFrame keeps the file listing of the moment it was made.  ``as_view`` therefore keeps
  *how* the view is built; ``read_view`` and ``run_sql`` build it anew, so rows appended to a source, and a source
  that was overwritten, are seen.  ``source_view`` is a view by SQL text, which Spark itself resolves on each read.
* ``as_table`` writes a new folder beside the old one and then replaces a small pointer file.  A write that fails
  leaves the old rows readable, and readers of the old version finish on the files they began with; ``vacuum``
  deletes versions that are no longer current.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession], DataFrame]

_VIEWS: dict[str, Build] = {}
_POINTER = "_current"


def as_view(spark: SparkSession, name: str, build: Build) -> DataFrame:
    """``materialized='view'``: a temp view over the lazy plan that ``build`` makes whenever the view is read."""
    _VIEWS[name] = build
    return read_view(spark, name)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """The view over its sources as they are now; the temp view of that name is replaced too."""
    df = _VIEWS[name](spark)
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """``spark.sql`` with every view as its sources are now (planning only; nothing is read for views not used)."""
    for name in _VIEWS:
        read_view(spark, name)
    return spark.sql(query)


def drop_view(spark: SparkSession, name: str) -> None:
    _VIEWS.pop(name, None)
    spark.catalog.dropTempView(name)


def source_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A temp view by SQL text over the files at ``path``: Spark lists them anew each time the view is read."""
    quote = lambda x: "`" + x.replace("`", "``") + "`"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quote(name)} AS SELECT * FROM {fmt}.{quote(path)}")
    return spark.table(name)


class _Files:
    """The file system of a path, through Hadoop, so any store that Spark can write to will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = path.getFileSystem(conf)
        self.root = self.fs.makeQualified(path)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), conf)
        self.overwrite = spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        self.overwrite[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside and rename over, which is one step on a file system (a store with atomic puts does it in the write)."""
        fresh = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(fresh), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.context.rename(self.path(fresh), self.path(name), self.overwrite)

    def folders(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.root) if s.isDirectory()) if self.fs.exists(self.root) else []


def as_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """``materialized='table'``: the rows at ``path`` are replaced by those of ``df``; the name of the new version.

    The table may read itself: its old version stays until the new one is complete.
    """
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path.rstrip('/')}/{version}")
    _Files(df.sparkSession, path).replace(_POINTER, version)
    return version


def read_table(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    """The current version of the table at ``path``."""
    version = _Files(spark, path).read(_POINTER)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{version}")


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete all versions but the current one (also what failed writes left); the names of those deleted."""
    files = _Files(spark, path)
    current = files.read(_POINTER)
    gone = [name for name in files.folders() if name.startswith("v-") and name != current]
    for name in gone:
        files.fs.delete(files.path(name), True)
    return gone
