"""Quality rules: an isolation forest on rule statistics.

Rule statistics of every whole text are counted once.  Base rules (too few words, too much repetition)
reject on their own.  For the rest, trees of random splits, over the labelled rows, isolate a document by how
far its rule ratios lie outside the range of the labelled good rows: the shorter the mean path, the more
anomalous.  Each ratio counts on its bad side only, the mean length of words on either; all that lies within the
range is equally ordinary.  Bad rows weigh little in the trees (many alike would hide each other).  The threshold
is the one that best tells the labelled bad rows from the good at a bounded loss of good ones.

Range, trees and threshold come from all labelled rows that pass the base rules.  The ends of the range are order
statistics, found digit by digit from counts of all good rows.  Every labelled row goes to at least one tree, and
to so many that each tree has about ``draw`` rows or more; a tree is grown in a task of its own.  Scores are
steps of 1 / ``STEPS``, so the threshold is chosen from the good and bad rows counted at each step.

Defined results: a null or blank text has no words and fails the base rules; rows that repeat an id are
judged each by its own text; with no labelled row of either quality no threshold can be set and only the
base rules reject; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ID, ROW, TEXT, Words, grams, keyed_texts, mix, stage, text_slices, tidy

SYMBOLS = "[#*$%&|<>]"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
_STATS = f"{ID} long, {ROW} long, " + ", ".join(f"{c} long" for c in _COUNTS)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values between offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[offsets])


def rule_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text (see ``_COUNTS``)."""
    w = Words(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(w.offsets))

    def per_word(values: pa.Array) -> np.ndarray:
        return _sums(values.to_numpy(zero_copy_only=False).astype(np.int64)[w.codes], w.offsets)

    size = pc.utf8_length(w.distinct)
    out = {"n_words": np.diff(w.offsets), "word_chars": per_word(size),
           "n_symbols": per_word(pc.count_substring_regex(w.distinct, SYMBOLS)),
           "n_upper": per_word(pc.count_substring_regex(w.distinct, r"\p{Lu}")),
           "n_marks": per_word(pc.count_substring_regex(w.distinct, "[!?]"))}
    # words inside 3-word windows that the text has twice
    repeated = np.zeros(len(w.codes), bool)
    if len(w.codes) >= 3:
        keys = grams(w.hashes(), 3)
        own = doc[2:] == doc[:-2]
        keys = mix(keys ^ mix(doc[:-2].astype(np.uint64)))[own]
        _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
        at = np.flatnonzero(own)[times[back] > 1]
        for i in range(3):
            repeated[at + i] = True
    out["n_repeat_words"] = _sums(repeated, w.offsets)
    lines = pc.split_pattern(texts, "\n")
    coded = lines.flatten().dictionary_encode()
    worded = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy().astype(np.int64)
    ends = lines.offsets.to_numpy().astype(np.int64)
    line_doc = np.repeat(np.arange(n), np.diff(ends))
    with_word = worded[codes] if len(codes) else np.zeros(0, bool)
    pairs = np.unique(line_doc[with_word] * max(1, len(worded)) + codes[with_word]) // max(1, len(worded))
    out["n_lines"] = np.bincount(line_doc[with_word], minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(pairs, minlength=n)
    return out


def rule_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(2)):
                got = rule_counts(texts)
                keys = [batch.column(i).slice(first, len(texts)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*keys, *[pa.array(got[c].astype(np.int64)) for c in _COUNTS]],
                                                 [ID, ROW, *_COUNTS])

    return keyed_texts(docs, id_col, text_col).mapInArrow(count, _STATS)


#: ordinary documents repeat a line or a phrase now and then: only the share beyond this counts
ALLOWED_REPEATS = 0.3


def rule_ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """One row of ratios per document; lengths are no rule, so long documents are not anomalous by themselves."""
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    beyond = lambda x: np.maximum(0, x - ALLOWED_REPEATS)
    return np.stack([c["n_symbols"] / chars, c["n_upper"] / chars, c["n_marks"] / chars,
                     beyond(c["n_dup_lines"] / lines), beyond(c["n_repeat_words"] / words), chars / words, -chars / words], axis=1)


#: ratios of a document, and digits of a number in the search for an order statistic
_RATIOS, _DIGIT_BITS = 7, 11


def _sortable(x: np.ndarray) -> np.ndarray:
    """Numbers as unsigned integers in the same order."""
    bits = (x + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFF_FFFF_FFFF_FFFF))).view(np.uint64) ^ np.uint64(1 << 63)


def _unsorted(keys: np.ndarray) -> np.ndarray:
    bits = (keys ^ np.uint64(1 << 63)).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFF_FFFF_FFFF_FFFF))).view(np.float64)


def _batch_ratios(batch: pa.RecordBatch) -> np.ndarray:
    return rule_ratios({c: batch.column(c).to_numpy() for c in _COUNTS})


def good_limits(good: DataFrame, rows: int, clean_loss: float) -> np.ndarray:
    """The upper end of each ratio of all good rows (so many ``rows``), beyond which ``clean_loss`` of them at most lie in all.

    A digit of each end in a pass: the rows that agree with the digits so far are counted by their next one.
    """
    rank = np.full(_RATIOS, ceil((1 - clean_loss / _RATIOS) * (rows - 1)))
    known, left = np.zeros(_RATIOS, np.uint64), 64
    while left:
        bits = min(_DIGIT_BITS, left)
        left -= bits

        def count(batches: Iterator[pa.RecordBatch], known=known, shift=left, bits=bits) -> Iterator[pa.RecordBatch]:
            found = np.zeros((_RATIOS, 1 << bits), np.int64)
            for batch in batches:
                keys = _sortable(_batch_ratios(batch)) >> np.uint64(shift)
                for i in range(_RATIOS):
                    own = keys[:, i][(keys[:, i] >> np.uint64(bits)) == known[i]]
                    found[i] += np.bincount((own & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
            i, digit = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(digit), pa.array(found[i, digit])], ["ratio", "digit", "n"])

        counts = good.mapInArrow(count, "ratio long, digit long, n long").groupBy("ratio", "digit").agg(F.sum("n").alias("n")).collect()
        found = np.zeros((_RATIOS, 1 << bits), np.int64)
        for r in counts:
            found[r["ratio"], r["digit"]] = r["n"]
        below = np.cumsum(found, axis=1)
        digit = (below <= rank[:, None]).sum(axis=1)
        rank = rank - np.where(digit > 0, below[np.arange(_RATIOS), digit - 1], 0)
        known = (known << np.uint64(bits)) | digit.astype(np.uint64)
    return _unsorted(known)


def excess(ratios: np.ndarray, limits: np.ndarray) -> np.ndarray:
    return np.maximum(0, ratios - limits)


#: steps of the anomaly score, which lies between 0 and 1
STEPS = 1 << 16
_TREE = "feature array<long>, split array<double>, right array<long>, length array<double>"


def mean_path(n: float) -> float:
    """Mean path of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow_tree(x: np.ndarray, weight: np.ndarray, depth_limit: int, rng: np.random.Generator) -> tuple[list, list, list, list]:
    """A tree over weighted rows as flat arrays: feature (-1 in a leaf), split, right child (the left one is next), path length at a leaf."""
    feature, split, right, length = [], [], [], []

    def grow(rows: np.ndarray, depth: int) -> None:
        at, total = len(feature), weight[rows].sum()
        for part in (feature, split, right, length):
            part.append(0)
        own = x[rows]
        spread = np.flatnonzero(own.max(0) > own.min(0)) if len(rows) > 1 and total > 1 and depth < depth_limit else []
        if len(spread) == 0:
            feature[at], length[at] = -1, float(depth + mean_path(total))
            return
        f = int(rng.choice(spread))
        v = float(rng.uniform(own[:, f].min(), own[:, f].max()))
        feature[at], split[at] = f, v
        grow(rows[own[:, f] <= v], depth + 1)
        right[at] = len(feature)
        grow(rows[own[:, f] > v], depth + 1)

    grow(np.arange(len(x)), 0)
    return feature, [float(v) for v in split], right, [float(v) for v in length]


class IsolationForest:
    """Trees of ``grow_tree``, each over about ``size`` rows."""

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], size: float):
        self.trees, self.size = trees, size

    @classmethod
    def fit(cls, labelled: DataFrame, limits: np.ndarray, good_rows: int, bad_rows: int, *, trees: int, draw: int, bad_share: float,
            seed: int) -> IsolationForest:
        """Trees over all ``labelled`` rows (counts and ``good``); the bad ones together weigh ``bad_share`` of the good at most."""
        each = min(trees, max(1, ceil(trees * draw / (good_rows + bad_rows))))  # trees that a row goes to
        bad_weight = min(1.0, max(1.0, bad_share * good_rows) / max(1, bad_rows))
        depth_limit = ceil(log2(max(2, min(draw, good_rows + bad_rows))))
        names = [f"x{i}" for i in range(_RATIOS)]

        @tidy
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, max(1, 200_000 // each)):
                    part = batch.slice(first, max(1, 200_000 // each))
                    x = excess(_batch_ratios(part), limits)
                    tree = (part.column("tree").to_numpy()[:, None] + np.arange(each)) % trees
                    weight = np.where(part.column("good").to_numpy(zero_copy_only=False), 1.0, bad_weight)
                    yield pa.RecordBatch.from_arrays([pa.array(tree.ravel()), *[pa.array(np.repeat(c, each)) for c in x.T], pa.array(np.repeat(weight, each))],
                                                     ["tree", *names, "weight"])

        def grow(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            x = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
            order = np.lexsort(x.T)
            rng = np.random.default_rng([seed, key[0].as_py()])
            made = grow_tree(x[order], rows.column("weight").to_numpy()[order], depth_limit, rng)
            return pa.table([pa.array([key[0].as_py()]), *[pa.array([part]) for part in made]], names=["tree", "feature", "split", "right", "length"])

        dealt = labelled.withColumn("tree", F.pmod(F.xxhash64(ID, ROW, F.lit(seed)), F.lit(trees)))
        rows = dealt.mapInArrow(deal, "tree long, " + ", ".join(f"{c} double" for c in names) + ", weight double")
        # rows within the range are all alike, so a tree reads few of them; weights are multiples of two numbers, and summed as counts
        alike = rows.groupBy("tree", *names, "weight").agg(F.count(F.lit(1)).alias("n"))
        grown = alike.withColumn("weight", F.col("weight") * F.col("n")).drop("n").groupBy("tree").applyInArrow(grow, f"tree long, {_TREE}").collect()
        return cls([(np.array(r["feature"]), np.array(r["split"], float), np.array(r["right"]), np.array(r["length"], float))
                    for r in sorted(grown, key=lambda r: r["tree"])], (good_rows + bad_weight * bad_rows) * each / trees)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / mean path of a tree's rows), in ``STEPS``: near 1 for the anomalous, near 0.5 and less for the ordinary."""
        x, back = np.unique(x, axis=0, return_inverse=True)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, right, length in self.trees:
            at = np.zeros(len(x), int)
            while (inner := feature[at] >= 0).any():
                f = np.maximum(feature[at], 0)
                step = np.where(x[rows, f] <= split[at], at + 1, right[at])
                at = np.where(inner, step, at)
            total += length[at]
        return (np.round(STEPS * 2.0 ** -(total / max(1, len(self.trees)) / max(1e-9, mean_path(self.size)))) / STEPS)[back.ravel()]


def calibrate(score: np.ndarray, good: np.ndarray, bad: np.ndarray, clean_loss: float) -> float:
    """The threshold with the most bad rows above it less the share of good ones, of which ``clean_loss`` at most go.

    ``good`` and ``bad`` are the numbers of rows with each score, which ascends.
    """
    if not good.sum() or not bad.sum():
        return float("inf")
    cuts = np.concatenate([(score[1:] + score[:-1]) / 2, [np.inf]])
    lost, caught = (1 - np.cumsum(n) / n.sum() for n in (good, bad))
    gain = np.where(lost <= clean_loss, caught - lost, -1)
    return float(cuts[np.flatnonzero(gain == gain.max())[-1]])


def score_counts(labelled: DataFrame, forest: IsolationForest, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scores of all labelled rows, ascending, and how many good and bad ones have each (at most ``STEPS`` + 1)."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, good = forest.score(excess(_batch_ratios(batch), limits)), batch.column("good").to_numpy(zero_copy_only=False)
            at, back = np.unique(score, return_inverse=True)
            n = [np.bincount(back[own], minlength=len(at)) for own in (good, ~good)]
            yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(c) for c in n]], ["score", "good", "bad"])

    found = labelled.mapInArrow(count, "score double, good long, bad long").groupBy("score").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    rows = sorted(found.collect())
    return tuple(np.array([r[i] for r in rows]) for i in range(3))


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  trees: int = 200, draw: int = 1024, bad_share: float = 0.01, clean_loss: float = 0.005, min_words: int = 50,
                  max_repeat_percent: int = 50, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, the anomaly score and a hash of the text."""
    stats = stage(rule_statistics(docs, id_col, text_col), "rule-stats")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)
    label = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("l")).agg(
        F.min("quality").alias("quality"))
    labelled = stats.where("not base_failed").join(label, stats[ID] == label["l"]).select(ID, ROW, *_COUNTS, (F.col("quality") > 0).alias("good"))
    labelled = stage(labelled, "labelled-rows")
    rows = labelled.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).first()
    forest, limits, threshold = None, None, float("inf")
    if rows["good"] + rows["bad"]:
        limits = good_limits(labelled.where("good"), rows["good"], clean_loss) if rows["good"] else np.zeros(_RATIOS)
        forest = IsolationForest.fit(labelled, limits, rows["good"], rows["bad"], trees=trees, draw=draw, bad_share=bad_share, seed=seed)
        threshold = calibrate(*score_counts(labelled, forest, limits), clean_loss)

    @tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = {c: b.column(c).to_numpy() for c in _COUNTS}
            score = forest.score(excess(rule_ratios(counts), limits)) if forest else np.zeros(b.num_rows)
            failed = b.column("base_failed").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:7], pa.array(failed), pa.array(~failed & (score <= threshold)), pa.array(score), b.column(1)],
                                             ["doc_id", *_COUNTS[:5], "base_failed", "kept", "anomaly", "text_hash"])

    return stats.mapInArrow(judge, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS[:5])
                            + ", base_failed boolean, kept boolean, anomaly double, text_hash long")
