"""Token-ID / binary output: flat unsigned integer files with 64-bit document offsets, memory-mapped.

Layout (little-endian), one set of files per range of ids:

* ``<name>.bin``  token ids one after another, ``uint16`` when the vocabulary fits, else ``uint32``
* ``<name>.off``  ``int64`` offsets of each document within the ``.bin``, one more than documents
* ``<name>.ids``  ``int64`` document ids in the same order; the first ``n_null`` documents of a set have none

A small index table holds one row per set of files (its path, type, documents, ``n_null`` and tokens); the global offset of a partition's first id is the
prefix sum of the id counts of the partitions before it.  Every task writes files under names of its own
and only the files named by the tasks that Spark committed are in the index, so a task that is retried
or run twice does no harm.

Defined results: a null text is an empty document (its end id only); a null id sorts before all others;
rows that repeat an id each keep their tokens, in the order of a hash of the text; an empty table gives
an empty index; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import ID, ROW, SMALL_SLICE_BYTES, TEXT, fresh_path, keyed_texts, map_array, open_output, stage, text_slices, tidy
from kestrel.llm.word_bpe import encoder

_INDEX = "part int, path string, dtype string, n_docs long, n_null long, n_tokens long"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: documents read back per Arrow batch
_BATCH_DOCS = 4096


def _with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after each document."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))


def _written(ordered: DataFrame, *, tokenizer: str, end_id: int, out: str) -> DataFrame:
    """A row per set of files: the documents of each partition, written in their order."""

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        dtype = "<u2" if max(enc.vocab_size - 1, end_id) < 1 << 16 else "<u4"
        part = TaskContext.get().partitionId()
        path = f"{out}/tokens-{part:06d}-{uuid.uuid4().hex}"
        n_docs = n_null = n_tokens = 0
        files = None
        for batch in batches:
            n_null += batch.column(0).null_count  # nulls come first
            ids_col = batch.column(0).fill_null(0).to_numpy()
            for first, texts in text_slices(batch.column(1), SMALL_SLICE_BYTES):
                if files is None:
                    files = [open_output(f"{path}.{x}") for x in ("bin", "off", "ids")]
                    files[1].write(np.zeros(1, "<i8").tobytes())
                ids, offsets = _with_end(*enc.encode(texts), end_id)
                files[0].write(ids.astype(dtype).tobytes())
                files[1].write((offsets[1:] + n_tokens).astype("<i8").tobytes())
                files[2].write(ids_col[first: first + len(texts)].astype("<i8").tobytes())
                n_docs, n_tokens = n_docs + len(texts), n_tokens + len(ids)
        if files:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path], "dtype": [dtype],
                                              "n_docs": [n_docs], "n_null": [n_null], "n_tokens": [n_tokens]})

    return ordered.mapInArrow(write, _INDEX)


def write_token_files(docs: DataFrame, id_col: str, text_col: str, *, tokenizer: str, end_id: int, out: str) -> DataFrame:
    """Tokenise and write all documents in ascending id order; returns the (staged) index with ``base``.

    One range shuffle of the texts.  Tokenising comes after it, so ranges are found without tokenising,
    and each task streams its sorted documents into its files: memory is one slice of a batch.
    """
    # a range shuffle without a count: small neighbouring ranges may be joined at run time, order is kept
    texts = keyed_texts(docs, id_col, text_col).repartitionByRange(F.col(ID).asc_nulls_first(), ROW)
    ordered = texts.sortWithinPartitions(F.col(ID).asc_nulls_first(), ROW).select(ID, TEXT)
    parts = stage(_written(ordered, tokenizer=tokenizer, end_id=end_id, out=out), "token-index")
    # one row per partition of the write: a running sum over so few rows is one small task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(dealt: DataFrame) -> DataFrame:
    """A row per document of the files that the rows of ``dealt`` name."""

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = map_array(row["path"] + ".bin", row["dtype"])
                offsets = map_array(row["path"] + ".off", "<i8")
                ids = map_array(row["path"] + ".ids", "<i8")
                for a in range(0, row["n_docs"], _BATCH_DOCS):
                    at = np.asarray(offsets[a: a + _BATCH_DOCS + 1])
                    crc = [zlib.crc32(tokens[x:y].astype("<u4").tobytes()) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                    own = np.asarray(ids[a: a + len(crc)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, mask=np.arange(a, a + len(own)) < row["n_null"]), pa.array(at[:-1] + row["base"]), pa.array(np.diff(at)),
                         pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(read, _READ)


def read_token_files(spark: SparkSession, index: DataFrame) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens and crc32 of its ids as uint32.

    Files are dealt over tasks (``index`` has a row per file) and mapped, so a task touches only the pages it reads.
    """
    n = max(1, index.count())
    return _read(index.repartition(n))  # a file a task


def token_files(spark: SparkSession, docs: DataFrame, *, tokenizer: str, end_id: int, id_col: str = "doc_id",
                text_col: str = "text", out: str | None = None) -> DataFrame:
    """Write the files, then read them back (see the two functions above)."""
    index = write_token_files(docs, id_col, text_col, tokenizer=tokenizer, end_id=end_id,
                              out=out or fresh_path(spark, "tokens"))
    return read_token_files(spark, index)
