"""Best-fit packing: bounded-space online best-fit over token pieces.

Each task packs a stream of pieces with at most ``open_bins`` open sequences, kept in a bitset keyed by
free space: a piece goes to the fullest open sequence it fits; if it fits none a new one is opened, and
when that is one too many the fullest is closed.  Pieces still in open sequences when a stream ends are
handed, as pieces, to the next round with fewer streams, so splitting the work over many tasks costs only
the open sequences of the last round.

Defined results: a null text is empty (a piece of the end id only); rows that repeat an id each get their
own pieces; a document longer than a sequence is cut into full pieces, its rest is packed like any
other; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ID, TEXT, keyed_texts, stage, text_slices, tidy
from kestrel.llm.word_bpe import encoder

_PIECE = f"{ID} long, row_no long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", sequence_id long, offset long, open boolean"


class BestFit:
    """Open bins by free space; bit ``f`` of ``free`` is set while some open bin has ``f`` free."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.free, self.count, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.fill: dict[int, list] = {}

    def put(self, size: int, item) -> tuple[int, list] | None:
        """Place an item; returns (bin, items) if that closes a bin."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = self._take(space)
        else:
            b, space = self.made, self.capacity
            self.made += 1
            self.fill[b] = []
        self.fill[b].append((item, self.capacity - space))
        space -= size
        if space == 0:
            return b, self.fill.pop(b)
        self.bins[space].append(b)
        self.free |= 1 << space
        self.count += 1
        if self.count > self.limit:
            return self.close()
        return None

    def _take(self, space: int) -> int:
        b = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.count -= 1
        return b

    def close(self) -> tuple[int, list]:
        """Close the fullest bin."""
        b = self._take((self.free & -self.free).bit_length() - 1)
        return b, self.fill.pop(b)


def token_pieces(docs: DataFrame, *, id_col: str, text_col: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids with ``end_id``, cut every ``capacity`` ids.

    ``row_no`` numbers the document within its task, and keeps rows that repeat an id apart.
    """

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids = batch.column(0)
            for first, texts in text_slices(batch.column(1)):
                ids, offsets = enc.encode(texts)
                ids = np.insert(ids, offsets[1:], end_id).astype("<u4")
                offsets = offsets + np.arange(len(offsets))
                n = np.diff(offsets)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                at = offsets[doc] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(doc + first)), pa.array(row_no + doc), pa.array(piece, pa.int32()),
                     pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    [ID, "row_no", "piece", "start", "length", "ids_crc32"])
                row_no += len(texts)
        enc.forget()  # the worker lives on for other stages

    return keyed_texts(docs, id_col, text_col).select(ID, TEXT).mapInArrow(cut, _PIECE)


def _pack_round(pieces: DataFrame, streams: int, round_no: int, capacity: int, open_bins: int) -> DataFrame:
    @tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, open_bins)
        first = (round_no << 56) | (TaskContext.get().partitionId() << 32)
        names = [f.split()[0] for f in _PLACED.split(", ")]
        schema = pa.schema([(n, pa.bool_() if n == "open" else pa.int32() if n == "piece" else pa.int64()) for n in names])

        def rows(closed: list[tuple[int, list]], is_open: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [item | {"sequence_id": first + b, "offset": at, "open": is_open} for b, items in closed for item, at in items], schema)

        for batch in batches:
            closed = [c for item in batch.to_pylist() if (c := bins.put(item["length"], item))]
            if closed:
                yield rows(closed, False)
        left = []
        while bins.count:
            left.append(bins.close())
        if left:
            yield rows(left, True)

    spread = F.xxhash64(ID, "row_no", "piece", F.lit(round_no))
    dealt = (pieces.repartition(streams, spread) if streams > 1 else pieces.coalesce(1)).sortWithinPartitions(spread, "row_no", "piece")
    return dealt.mapInArrow(pack, _PLACED)


def pack_best_fit(pieces: DataFrame, *, capacity: int, open_bins: int = 1024, per_stream: int = 100_000) -> DataFrame:
    """Place every piece in a sequence: adds ``sequence_id`` and ``offset``.

    A stream has about ``per_stream`` pieces, so the pieces that rounds hand on shrink by far each time and
    the last round, of one stream, has a bounded number of them.
    """
    done, round_no, rest = [], 0, pieces.where(F.col("length") < capacity)
    full = pieces.where(F.col("length") >= capacity).select(
        "*", (F.lit(127 << 56) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    n = rest.count()
    while True:
        streams = max(1, n // per_stream)
        placed = stage(_pack_round(rest, streams, round_no, capacity, open_bins), f"packed-{round_no}")
        left = placed.where("open").count() if streams > 1 else 0
        if left == 0 or left > n // 2:  # the last round, or one that no longer gains anything
            done.append(placed)
            break
        done.append(placed.where("not open"))
        rest, n, round_no = placed.where("open").drop("sequence_id", "offset", "open"), left, round_no + 1
    out = full
    for d in done:
        out = out.unionByName(d.drop("open"))
    return out


def best_fit_packing(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
                     text_col: str = "text", open_bins: int = 1024, per_stream: int = 100_000) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(token_pieces(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, end_id=end_id, capacity=capacity),
                   "pieces")
    placed = pack_best_fit(pieces, capacity=capacity, open_bins=open_bins, per_stream=per_stream)
    return placed.select(F.col(ID).alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
