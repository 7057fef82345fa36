"""Substring dedup: seed and extend on winnowed anchors.

Every run of ``length`` words holds one chosen anchor: the ``gram``-word run of least hash in it (winnowing),
so equal runs hold the same anchor at the same place.  Anchors that more than one document has are the
seeds.  A seed is extended both ways over all the runs that chose it: occurrences whose whole surroundings
are equal form a class at once, and only one occurrence of each class goes on to be compared run by run with
the other classes of the seed.  So the work is linear in the occurrences, whatever the size of a group of
copies, and no pair of occurrences is ever made.  Runs found in a document with a smaller id join into maximal
repeats, which are cut out.

Defined results: a null or blank text has no words; a null id counts as larger than all ids; rows that
repeat an id are judged each by its own text (equal ids are not smaller); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ID, ROW, SMALL_SLICE_BYTES, TEXT, Rolling, Words, keyed_texts, narrowed, stage, text_slices, tidy

GRAM = 16
_DOCS = (f"{ID} long, {ROW} long, n_words long, sha string, seeds array<struct<hash: long, around: long, start: int, runs: int>>")
_SEED = pa.list_(pa.struct([("hash", pa.int64()), ("around", pa.int64()), ("start", pa.int32()), ("runs", pa.int32())]))
_MAX_ID = (1 << 63) - 1


def _anchors(hashes: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, first run, runs, anchor hash, hash of all words of the runs) of each stretch of runs with one anchor."""
    rolling = Rolling(hashes)
    span = length - gram + 1  # anchors to choose from in a run
    starts = np.arange(max(0, len(hashes) - gram + 1))
    grams = rolling.runs(starts, starts + gram)
    texts, firsts, chosen = [], [], []
    for t in np.flatnonzero(np.diff(offsets) >= length):
        a, b = offsets[t], offsets[t + 1]
        own = np.lib.stride_tricks.sliding_window_view(grams[a: b - gram + 1], span)
        at = own.argmin(axis=1) + np.arange(len(own))
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        texts.append(np.full(len(first), t))
        firsts.append(first + a)
        chosen.append(at[first] + a)
    if not texts:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, rolling
    text, first, chosen = (np.concatenate(x) for x in (texts, firsts, chosen))
    last = np.where(np.append(text[1:] != text[:-1], True), offsets[text + 1] - length, np.append(first[1:], 0) - 1)
    return text, first, last - first + 1, grams[chosen].view(np.int64), rolling.runs(first, last + length).view(np.int64), rolling


def _seeds(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per document: its words counted, the digest of the unchanged text, and its anchors."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(2), SMALL_SLICE_BYTES):
                w = Words(part)
                text, start, runs, anchor, around, _ = _anchors(w.hashes(), w.offsets, length, gram)
                ends = np.searchsorted(text, np.arange(len(part) + 1))
                items = pa.StructArray.from_arrays(
                    [pa.array(anchor), pa.array(around), pa.array((start - w.offsets[text] if len(text) else start).astype(np.int32)),
                     pa.array(runs.astype(np.int32))], fields=list(_SEED.value_type))
                sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in w.joined()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), batch.column(1).slice(first, len(part)), pa.array(np.diff(w.offsets)),
                     pa.array(sha), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)], [ID, ROW, "n_words", "sha", "seeds"])

    return texts.mapInArrow(run, _DOCS)


_RUNS = "run long, class long, ord long, i int"


def _run_hashes(texts: DataFrame, length: int) -> DataFrame:
    """The hash of every run of the classes that ``parts`` names in each text."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(2)
            for first, part in text_slices(batch.column(1), SMALL_SLICE_BYTES):
                w = Words(part)
                rolling = Rolling(w.hashes())
                lists = parts.slice(first, len(part))
                items, n = lists.flatten(), np.diff(lists.offsets.to_numpy())
                base = np.repeat(w.offsets[:-1], n)
                start, runs, cls = (items.field(f).to_numpy() for f in ("start", "runs", "class"))
                i = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
                at = np.repeat(base + start, runs) + i
                ord_ = np.repeat(np.repeat(batch.column(0).slice(first, len(part)).to_numpy(), n), runs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rolling.runs(at, at + length).view(np.int64)), pa.array(np.repeat(cls, runs)), pa.array(ord_),
                     pa.array(i.astype(np.int32))], ["run", "class", "ord", "i"])

    return texts.mapInArrow(run, _RUNS)


def _repeats(found: DataFrame, length: int) -> DataFrame:
    """Maximal repeats of each document from its marked runs: (ID, ROW, n_words, n_removed, repeats)."""
    schema = f"{ID} long, {ROW} long, n_words long, n_removed long, repeats array<struct<start: int, end: int>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans = [], []
            for n, marks in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                edge = np.zeros(n + 1, np.int64)
                for m in marks:
                    bits = m["mask"]
                    while bits:
                        low = (bits & -bits).bit_length() - 1
                        run = ((bits >> low) ^ ((bits >> low) + 1)).bit_length() - 1  # marked runs in a row
                        edge[m["start"] + low] += 1
                        edge[m["start"] + low + run - 1 + length] -= 1
                        bits &= ~(((1 << run) - 1) << low)
                covered = np.concatenate([[0], np.cumsum(edge)[:-1] > 0, [0]]).astype(np.int8)
                change = np.diff(covered)
                starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
                removed.append(int((ends - starts).sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(removed, pa.int64()), pa.array(spans, kind)],
                                             [ID, ROW, "n_words", "n_removed", "repeats"])

    return found.mapInArrow(run, schema)


def _cut(texts: DataFrame) -> DataFrame:
    """The texts without their repeats (words joined by one space)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for first, part in text_slices(batch.column(2), SMALL_SLICE_BYTES):
                lists = Words(part)
                for words, spans in zip(lists.lists.to_pylist(), batch.column(3).slice(first, len(part)).to_pylist()):
                    out, at = [], 0
                    for s in spans:
                        out += words[at: s["start"]]
                        at = s["end"]
                    kept.append(" ".join(out + words[at:]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.string())], [ID, ROW, "kept"])

    return texts.mapInArrow(run, f"{ID} long, {ROW} long, kept string")


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, repeats (word spans cut out), kept (text, null if unchanged)."""
    if not 1 <= length - gram + 1 <= 62:
        raise ValueError("a run must hold 1 to 62 anchors")
    texts = keyed_texts(docs, id_col, text_col)
    rows = stage(_seeds(texts, length, gram), "seed-docs")
    ord_ = F.coalesce(F.col(ID), F.lit(_MAX_ID)).alias("ord")
    anchors = rows.select(ID, ROW, ord_, F.explode("seeds").alias("s")).select(ID, ROW, "ord", "s.*")
    shared = anchors.groupBy("hash").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("hash")
    seeds = anchors.join(shared, "hash", "left_semi").withColumn("class", F.xxhash64("hash", "around", "runs"))
    seeds = stage(seeds, "seeds")

    classes = stage(seeds.groupBy("class").agg(F.min("hash").alias("hash"), F.min(F.struct("ord", ID, ROW, "start")).alias("one"),
                                               F.min("runs").alias("runs")), "seed-classes")
    first = classes.select("class", F.col("one.ord").alias("first"))
    member = seeds.join(first, "class")
    every = F.expr("shiftleft(1L, runs) - 1")
    # a later member of a class: all its runs are in the class's first document
    later = member.where("ord > first").select(ID, ROW, "start", every.alias("mask"))

    # classes of one seed: the runs of one occurrence of each
    several = classes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    ones = classes.join(several, "hash", "left_semi").select(
        F.col(f"one.{ID}").alias("o_id"), F.col(f"one.{ROW}").alias("o_row"), F.struct(F.col("one.start").alias("start"), "runs", "class").alias("p"))
    parts = stage(ones.groupBy("o_id", "o_row").agg(F.collect_list("p").alias("parts")), "seed-parts")
    near = narrowed(texts, ID, parts.select("o_id"))
    # merged, not broadcast: the filter of ``narrowed`` and the step after the join would run in one task, each with a Python worker
    near = near.join(parts.hint("merge"), near[ID].eqNullSafe(parts["o_id"]) & (near[ROW] == parts["o_row"]))
    runs = stage(_run_hashes(near.select(ord_, TEXT, "parts"), length), "seed-runs")
    earliest = runs.groupBy("run").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("run", "lo")
    marked = runs.join(earliest, "run").where("ord > lo").groupBy("class").agg(
        F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))
    earlier = member.where("ord = first").join(marked, "class").select(ID, ROW, "start", "mask")

    marks = later.unionByName(earlier).groupBy(ID, ROW).agg(F.collect_list(F.struct("start", "mask")).alias("marks"))
    marks = marks.select(F.col(ID).alias("m_id"), F.col(ROW).alias("m_row"), "marks")
    sizes = rows.select(ID, ROW, "n_words").dropDuplicates([ID, ROW])
    found = sizes.join(marks, sizes[ID].eqNullSafe(marks["m_id"]) & (sizes[ROW] == marks["m_row"])).select(ID, ROW, "n_words", "marks")
    repeats = stage(_repeats(found, length), "repeats")

    # only texts of which something is left have to be read again
    some = repeats.where("n_removed < n_words").select(F.col(ID).alias("r_id"), F.col(ROW).alias("r_row"), "repeats")
    todo = narrowed(texts, ID, some.select("r_id"))
    todo = todo.join(some.hint("merge"), todo[ID].eqNullSafe(some["r_id"]) & (todo[ROW] == some["r_row"])).select(ID, ROW, TEXT, "repeats")
    kept = _cut(todo).dropDuplicates([ID, ROW]).select(F.col(ID).alias("k_id"), F.col(ROW).alias("k_row"), "kept")
    changed = repeats.join(kept, repeats[ID].eqNullSafe(kept["k_id"]) & (repeats[ROW] == kept["k_row"]), "left").select(
        F.col(ID).alias("c_id"), F.col(ROW).alias("c_row"), "n_removed", "repeats", F.coalesce("kept", F.lit("")).alias("kept"))
    base = rows.select(ID, ROW, "n_words", "sha")
    out = base.join(changed, base[ID].eqNullSafe(changed["c_id"]) & (base[ROW] == changed["c_row"]), "left")
    return out.select(F.col(ID).alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(F.sha2("kept", 256), "sha").alias("kept_sha256"), "repeats", "kept")
