"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel, stitched, then encoded.

A text longer than a chunk is cut into chunks that overlap.  Each chunk is pre-tokenised alone; its
pre-token boundaries are wrong at first if it begins inside a pre-token, but as the pattern never looks
back they are right from the first boundary it shares with the chunk before (as far as that one saw
enough of the text).  The text is cut at that boundary: the pieces are runs of whole pre-tokens, so they
encode alone, and their ids one after another are those of the text.  Where two chunks share no boundary
in their overlap (a pre-token as long as that), the document is tried again with chunks and overlaps
four times as long; at last it is a single chunk.  Decoding joins the raw bytes of each piece's tokens.

Defined results: a null text is empty (no ids); rows that repeat an id each give a row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import ID, TEXT, keyed_texts, stage

CHUNK, OVERLAP = 32_768, 1_024
#: boundaries this close to the end of a chunk may hang on characters it doesn't see (``'ll`` has three)
GUARD = 4
#: a chunk row: of documents of one chunk only the digests, of others the text of the chunk
_CHUNKS = (f"{ID} long, row_no long, chunk int, chunks int, at long, size int, overlap int, part string, "
           "n_tokens long, ids_sha256 string, decoded_sha256 string")
_OUT = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

_ENCODINGS: dict = {}


def encoding(ranks_path: str, pattern: str):
    """One per worker process and file."""
    if (ranks_path, pattern) not in _ENCODINGS:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        _ENCODINGS[ranks_path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[ranks_path, pattern]


def _encode(enc, text: str) -> np.ndarray:
    return np.asarray(enc.encode_to_numpy(text, disallowed_special=()), np.dtype("<u4"))


def _decode(enc, ids: np.ndarray) -> bytes:
    return enc.decode_bytes(ids.tolist())


def _to_batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in fields]))


def _chunked(docs: DataFrame, ranks: str, pattern: str, size: int, overlap: int) -> DataFrame:
    """Chunk rows of (ID, row_no, TEXT) rows; a row_no of -1 is given here (it keeps rows that repeat an id apart)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        fresh = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, row_no, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                if row_no < 0:
                    row_no, fresh = fresh, fresh + 1
                base = {ID: doc_id, "row_no": row_no, "size": size, "overlap": overlap}
                if len(text) <= size:
                    ids = _encode(enc, text)
                    rows.append(base | {"chunk": 0, "chunks": 1, "at": 0, "n_tokens": len(ids),
                                        "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(),
                                        "decoded_sha256": hashlib.sha256(_decode(enc, ids)).hexdigest()})
                else:
                    starts = range(0, len(text) - overlap, size - overlap)
                    rows += [base | {"chunk": i, "chunks": len(starts), "at": a, "part": text[a: a + size]}
                             for i, a in enumerate(starts)]
                if len(rows) >= 512:
                    yield _to_batch(rows, _CHUNKS)
                    rows = []
            if rows:
                yield _to_batch(rows, _CHUNKS)

    return docs.mapInArrow(cut, _CHUNKS)


_BOUNDS = f"{ID} long, row_no long, chunk int, chunks int, head array<long>, tail array<long>"


def _boundaries(chunks: DataFrame, pattern: str) -> DataFrame:
    """Where each chunk's pre-tokens begin within its two overlaps, at places of the whole text.

    Only places after a character that is not white space count: a piece that ended in white space
    would encode otherwise alone, as the pattern looks ahead from white space.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled = regex.compile(pattern)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, first_tail = r["part"], len(r["part"]) - r["overlap"]
                head, tail = [], []
                for m in compiled.finditer(text):
                    p = m.start()
                    if p and text[p - 1].isspace():
                        continue
                    if p < r["overlap"]:
                        head.append(r["at"] + p)
                    if first_tail <= p <= len(text) - GUARD:
                        tail.append(r["at"] + p)
                rows.append({k: r[k] for k in (ID, "row_no", "chunk", "chunks")} | {"head": head, "tail": tail})
            yield _to_batch(rows, _BOUNDS)

    return chunks.select(ID, "row_no", "chunk", "chunks", "at", "overlap", "part").mapInArrow(find, _BOUNDS)


_PIECE = f"{ID} long, row_no long, chunk int, n_tokens long, ids binary, raw binary"


def _encode_pieces(pieces: DataFrame, ranks: str, pattern: str) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            for r in batch.to_pylist():
                end = None if r["cut_end"] is None else r["cut_end"] - r["at"]
                ids = _encode(enc, r["part"][r["cut"] - r["at"]: end])
                yield _to_batch([{ID: r[ID], "row_no": r["row_no"], "chunk": r["chunk"], "n_tokens": len(ids), "ids": ids.tobytes(),
                                  "raw": _decode(enc, ids)}], _PIECE)

    return pieces.mapInArrow(encode, _PIECE)


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from its pieces in order, each fed to the digests as it comes: no text is held whole."""
    at, tokens, digests = None, 0, []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([tokens], pa.int64()), *[pa.array([d.hexdigest()]) for d in digests]], _OUT)

    for batch in batches:
        for i in range(batch.num_rows):
            doc, row_no, _, n, ids, raw = (column[i] for column in batch.columns)
            here = (doc.as_py(), row_no.as_py())
            if here != at:
                if at is not None:
                    yield row()
                at, tokens, digests = here, 0, [hashlib.sha256(), hashlib.sha256()]
            tokens += n.as_py()
            for digest, value in zip(digests, (ids, raw)):
                digest.update(value.as_buffer())
    if at is not None:
        yield row()


def chunked_bpe(docs: DataFrame, *, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 (hex, of the ids as little-endian uint32 and of the decoded bytes)."""

    todo = keyed_texts(docs, id_col, text_col).select(ID, F.lit(-1).cast("long").alias("row_no"), TEXT)
    done: list[DataFrame] = []
    key, size = [ID, "row_no"], chunk
    by_doc = Window.partitionBy(*key).orderBy("chunk")
    whole = Window.partitionBy(*key)
    while True:
        chunks = stage(_chunked(todo, ranks, pattern, size, overlap), "bpe-chunks")
        done.append(chunks.where("chunks = 1").select(F.col(ID).alias("doc_id"), *_OUT[1:]))
        parts = chunks.where("chunks > 1").select(*key, "chunk", "chunks", "at", "overlap", "part")
        # chunks, not documents, are dealt out here, so the chunks of one long text are read side by side
        bounds = _boundaries(parts.repartition(F.xxhash64(*key, "chunk")), pattern)
        shared = F.array_min(F.array_intersect("head", F.lag("tail").over(by_doc)))
        cuts = bounds.select(*key, "chunk", F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(shared).alias("cut"))
        cuts = stage(cuts.select(*key, "chunk", "cut", F.lead("cut").over(by_doc).alias("cut_end"),
                                 (F.count("cut").over(whole) == F.count(F.lit(1)).over(whole)).alias("stitched")), "bpe-cuts")
        right = [F.col(f"{k}").alias(f"{k}_c") for k in key] + [F.col("chunk").alias("chunk_c"), "cut", "cut_end", "stitched"]
        cut = cuts.select(*right)
        met = parts[ID].eqNullSafe(cut[f"{ID}_c"]) & (parts["row_no"] == cut["row_no_c"]) & (parts["chunk"] == cut["chunk_c"])
        pieces = _encode_pieces(parts.join(cut.where("stitched"), met).select(*key, "chunk", "at", "part", "cut", "cut_end"), ranks, pattern)
        in_order = pieces.repartition(*key).sortWithinPartitions(*key, "chunk")
        done.append(in_order.mapInArrow(_joined_digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
        if cuts.where("not stitched").limit(1).count() == 0:
            break
        # no boundary in an overlap: put those texts together again and take longer chunks and overlaps
        apart = parts.join(cut.where("not stitched"), met).select(*key, "chunk", "at", "part")
        own = F.when(F.col("chunk") == 0, F.col("part")).otherwise(F.expr(f"substring(part, {overlap} + 1)"))
        todo = apart.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("chunk", own.alias("t")))).alias("p")).select(
            *key, F.array_join(F.col("p.t"), "").alias(TEXT))
        size, overlap = size * 4, overlap * 4
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
