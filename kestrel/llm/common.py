"""Shared pieces of the training-data operators: staged tables, shared files, word splitting.

Words are maximal runs of characters outside ``[\\x20\\x09-\\x0D]`` everywhere in this subpackage.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: internal names; callers' other columns are never carried through a shuffle, so they cannot clash
ID, TEXT, ROW = "__doc", "__text", "__row"

#: an Arrow batch is handled in slices of about this many text bytes, so memory does not follow the batch;
#: the arrays made from a slice are some twenty times as large
SLICE_BYTES = 2 << 20
#: the same where one executor's workers would together take too much
SMALL_SLICE_BYTES = 512 << 10


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once a session, wherever the driver imported it from."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        top = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="kestrel-ship-")) / f"{top.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a scratch folder serves a local session only: on a cluster a machine-local
    folder would lose rows, so that fails.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/kestrel-llm/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several later steps read one intermediate result that is dear to make again; it also
    cuts the lineage, so a lost executor costs a re-read instead of a recomputation.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, text): ``row`` is a hash of the text, so rows that repeat an id stay apart by text."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias(ID), text.alias(TEXT)).select(
        ID, F.coalesce(F.xxhash64(TEXT), F.lit(0)).alias(ROW), TEXT)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on (id, row); a null id equals a null id."""
    return left[ID].eqNullSafe(right[ID]) & (left[ROW] == right[ROW])


def text_slices(column: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, part) of a string column, each part of about ``max_bytes`` at most (one row at least).

    Only the part at hand is copied, never the batch.  It is copied by ``take`` so that its text begins at
    place 0: Arrow's kernels return wrong bytes for a large string that was cast from the middle of a column.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, n = 0, len(column)
    while first < n:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        part = column.take(pa.array(np.arange(first, last)))
        yield first, pc.fill_null(part, "").cast(pa.large_string())
        first = last
    pa.default_memory_pool().release_unused()  # workers live on for later stages


def release_memory() -> None:
    """Give the system what this process has freed: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it, and only glibc needs it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with its memory handed back when the task ends.

    Spark's workers live on for later stages, several an executor: what each keeps from its largest task adds up.
    """

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


class Words:
    """The words of some texts as codes into their distinct words (splitting and coding run in Arrow)."""

    def __init__(self, texts: pa.Array):
        self.lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
        flat = self.lists.flatten()
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # a text without words gives ""
        offsets = self.lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        if not full.all():
            offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
            flat = flat.filter(pa.array(full))
        coded = flat.dictionary_encode()
        self.offsets = offsets
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.distinct: pa.Array = coded.dictionary

    def joined(self) -> pa.Array:
        """The words of each text joined by one space."""
        return pc.binary_join(self.lists, pa.scalar(" ", self.lists.type.value_type))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        import xxhash

        words = self.distinct.to_numpy(zero_copy_only=False).tolist()
        each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        return each[self.codes]


_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the ``n`` consecutive word hashes from each place (none if there are fewer)."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        out = mix(out * _STEP + words[i: i + len(out)])
    return out


class Rolling:
    """64-bit hashes of any runs of words, from prefix sums of a polynomial in wrapping arithmetic."""

    _BASE = np.uint64(0x9E3779B97F4A7C15)
    _INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = np.full(n + 1, self._BASE, np.uint64)
        inverse = np.full(n + 1, self._INVERSE, np.uint64)
        powers[0] = inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.multiply.accumulate(powers)[:-1], dtype=np.uint64)])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def key_bitmap(keys: DataFrame, bits: int = 23) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits with the hashes of an id column set: at most a megabyte, whatever the table.

    It only spares a shuffle the rows that certainly have no partner; the join that follows decides.
    """
    place = F.pmod(F.xxhash64(F.col(keys.columns[0])), F.lit(1 << bits))
    rows = keys.select((place + 1).alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("b")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:  # a bucket has 4096 bytes; buckets count from 1
        got = np.frombuffer(r["bits"], np.uint8)
        at = (r["b"] - 1) * 4096
        out[at: at + len(got)] = got
    return out


def may_have(bitmap: np.ndarray, place: Column) -> Column:
    """Whether the bitmap has the place ``pmod(xxhash64(id), 2 ** bits)``; only that number goes through Python."""

    @F.pandas_udf("boolean")
    def test(p: pd.Series) -> pd.Series:
        at = p.to_numpy()
        return pd.Series((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return test(place)


def split_by_keys(df: DataFrame, id_col: str, keys: DataFrame, bits: int = 23) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in the one column of ``keys``, rows whose id certainly is not)."""
    place = F.pmod(F.xxhash64(F.col(id_col).cast("bigint")), F.lit(1 << bits))
    may = may_have(key_bitmap(keys, bits), place)
    return df.where(may), df.where(~may)


def narrowed(df: DataFrame, id_col: str, keys: DataFrame, bits: int = 23) -> DataFrame:
    """``df`` without most of the rows whose id is not in the one column of ``keys``."""
    return split_by_keys(df, id_col, keys, bits)[0]


def fresh_name(taken: Iterable[str], name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be none of ``taken`` (without regard to case)."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


def renewed(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, so that it can be cogrouped with a table it shares columns with."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def is_local(uri: str) -> bool:
    return urlparse(uri).scheme in ("", "file")


def local_path(uri: str) -> str:
    return urlparse(uri).path if uri.startswith("file:") else uri


def open_output(uri: str):
    """A binary output stream in the shared folder (a mounted path, or a store Arrow can open)."""
    if is_local(uri):
        path = local_path(uri)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def map_array(uri: str, dtype: str) -> np.ndarray:
    """The file as a flat array: memory-mapped on a mounted path, else read as one buffer."""
    if is_local(uri):
        path = local_path(uri)
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)
