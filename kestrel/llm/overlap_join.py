"""N-gram Jaccard join: size-aware heavy-light overlap join of shingle sets.

Sets of up to a boundary size are *light*: for each pair of sizes that can link, a set enumerates all its
subsets of the size that two such sets must share at least, and sets with a common subset are linked.
Larger sets are *heavy*: they are written to inverted lists, and lists are scanned for candidates that are
then compared in full.  The boundary is the size up to which enumerating costs fewer rows than scanning the
lists, by the sizes and the list lengths counted over all sets.

Equal sets are collapsed first.  Two filters that lose no link go before the join.  Of the shingles in a fixed
part of the hash range, those that only one set has are counted for each set: a set with more of them than a
link allows has none.  For the sets left all shingles are counted, and a set keeps those that another has too;
it stays if they can reach the threshold.  Ordered from the rarest up, a heavy set is listed only under its
first shingles (two sets that reach the threshold share one of those).

Lists are scanned without making the pairs of a list: in each of some rounds a set meets some hubs of its
lists and is compared with the one it meets most often, and what links is one component from then on.  What is
then still apart within a list is paired, but only across components, and only where sizes, the places of a
shared shingle in both orders and the sketches of both sets leave the threshold possible, so the result is exact.
The sketch of a set is a bitmap in which each of its shingles flips a bit: two sets differ in at least as many
shingles as their sketches do in bits.

Defined results: an empty set (no words) links with nothing; fewer than ``n`` words make one shingle of the
whole text; a row with a null id links with nothing and has a null component; rows that repeat an id share a
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ID, ROW, TEXT, Words, grams, keyed_texts, mix, narrowed, stage, text_slices, tidy
from kestrel.llm.components import connected_components

#: sixteenths of the hash range whose shingles the first filter counts; any number loses no link, more filter better
SIEVE = 7
#: a shingle with at least this share of all occurrences is joined over salts; there are at most so many of them
HOT_SHARE = 50_000
#: a set of this size has more subsets than any table has rows, so the boundary is below it
_NEVER_LIGHT = 100
#: hubs of a list in a round
HUBS = 16
#: sets whose lists a task makes at once, so memory does not follow the Arrow batch
LISTED_SETS = 1000
#: numbers of 64 bits in the sketch of a set
SKETCH = 8


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts one after another, offsets)."""
    w = Words(pc.ascii_lower(texts))
    hashes, count = w.hashes(), np.diff(w.offsets)
    runs = grams(hashes, n)
    sets, short = [], np.flatnonzero(count < n)
    text = np.repeat(np.arange(len(texts)), np.maximum(count - n + 1, 0))
    at = np.arange(len(text)) - np.repeat(np.cumsum(np.maximum(count - n + 1, 0)) - np.maximum(count - n + 1, 0), np.maximum(count - n + 1, 0))
    values = runs[w.offsets[text] + at] if len(text) else np.zeros(0, np.uint64)
    for t in short:  # the whole sequence as one shingle; its length keeps it apart from longer ones
        if count[t]:
            sets.append((t, grams(hashes[w.offsets[t]: w.offsets[t + 1]], int(count[t]))[0] ^ np.uint64(count[t])))
    if sets:
        text = np.concatenate([text, [t for t, _ in sets]])
        values = np.concatenate([values, np.array([v for _, v in sets], np.uint64)])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    if len(text):
        first = np.concatenate([[True], (text[1:] != text[:-1]) | (values[1:] != values[:-1])])
        text, values = text[first], values[first]
    return values, np.searchsorted(text, np.arange(len(texts) + 1))


def need(a: int, b: int, percent: int) -> int:
    """Least overlap of linked sets of these sizes: 100 * o >= percent * (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """Sizes that can link with ``n``."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def light_rows(n: int, percent: int) -> int:
    return sum(comb(n, need(n, m, percent)) for m in partners(n, percent))


def boundary(sizes: dict[int, tuple[int, int]], percent: int) -> int:
    """The largest light size: rows made for subsets and rows scanned in lists are fewest there.

    ``sizes`` gives for each size the number of sets and the rows of the lists that they are in.
    """

    def cost(x: int) -> int:
        light = sum(count * light_rows(n, percent) for n, (count, _) in sizes.items() if n <= x)
        heavy = sum(scan + count * n for n, (count, scan) in sizes.items() if n > x or 100 * n >= percent * (x + 1))
        return light + heavy

    return min([0, *sorted(sizes)], key=cost)


def _sketches(items: list[np.ndarray]) -> np.ndarray:
    """For each set ``SKETCH`` numbers of 64 bits, in which each of its shingles flips one bit."""
    values = mix(np.concatenate([*items, np.zeros(0, np.int64)]).view(np.uint64))
    bit = (values % np.uint64(64 * SKETCH)).astype(np.int64)
    flips = np.bincount(np.repeat(np.arange(len(items)), [len(x) for x in items]) * 64 * SKETCH + bit, minlength=len(items) * 64 * SKETCH)
    return np.packbits((flips & 1).astype(np.uint8).reshape(len(items), 64 * SKETCH), axis=1).view(np.int64)


def _digests(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 bits of each set, as two numbers."""
    import xxhash

    raw = memoryview(values.tobytes())
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[8 * a: 8 * b]) for a, b in zip(offsets[:-1], offsets[1:])), np.int64).reshape(-1, 2)


def _set_rows(texts: DataFrame, n: int) -> DataFrame:
    """A row per document: size and digest of its set."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(2)):
                values, offsets = shingle_sets(part, n)
                digest, k = _digests(values, offsets), len(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, k), batch.column(1).slice(first, k), pa.array(np.diff(offsets).astype(np.int32)),
                     pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())], [ID, ROW, "n", "lo", "hi"])

    return texts.mapInArrow(run, f"{ID} long, {ROW} long, n int, lo long, hi long")


def _sieved(texts: DataFrame, n: int) -> DataFrame:
    """(token, lo): the shingles in the first part of the hash range, with half of the digest of the set."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in text_slices(batch.column(0)):
                values, offsets = shingle_sets(part, n)
                lo = np.repeat(_digests(values, offsets)[:, 0], np.diff(offsets))
                own = (values >> np.uint64(60)) < SIEVE
                yield pa.RecordBatch.from_arrays([pa.array(values[own].view(np.int64)), pa.array(lo[own])], ["token", "lo"])

    return texts.select(TEXT).mapInArrow(run, "token long, lo long")


def _tokens(texts: DataFrame, n: int) -> DataFrame:
    """(token, ord, row, n): every shingle of every text."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(2)):
                values, offsets = shingle_sets(part, n)
                size = np.diff(offsets)
                at = pa.array(np.repeat(np.arange(len(size)), size) + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.repeat(size, size).astype(np.int32))], ["token", "ord", "row", "n"])

    return texts.mapInArrow(run, "token long, ord long, row long, n int")


def _may_have_links(texts: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """(ord, row) of the sets with no more shingles of their own, in part of the hash range, than a link allows."""
    own = _sieved(texts, n).groupBy("token").agg(F.min("lo").alias("lo"), F.max("lo").alias("other")).where("lo = other")
    own = own.groupBy("lo").agg(F.count(F.lit(1)).alias("own"))
    # where two sets share half a digest their counts are not known, so both stay
    known = classes.groupBy("lo").agg(F.max("n").alias("n"), F.min("ord").alias("ord"), F.min("row").alias("row"), F.count(F.lit(1)).alias("c"))
    out = known.where("c = 1").join(own, "lo", "left_anti").unionByName(
        known.where("c = 1").join(own, "lo").where(100 * F.col("own") <= (100 - percent) * F.col("n")).drop("own"))
    twice = classes.join(known.where("c > 1").select("lo"), "lo", "left_semi").select("ord", "row")
    return out.select("ord", "row").unionByName(twice)


def _salted(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tokens, their counts) with a salt in both: a hot token is spread over as many salts as its count asks for."""
    counts = stage(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "shingle-counts")
    total = counts.agg(F.sum("c").alias("t")).first()["t"] or 0
    share = max(total // HOT_SHARE, 1 << 10)
    hot = counts.where(F.col("c") >= share).select("token", "c").toPandas().sort_values("token")  # HOT_SHARE rows at most
    salts = tokens.sparkSession.sparkContext.broadcast((hot["token"].to_numpy(np.int64), (hot["c"].to_numpy(np.int64) // share)))

    @F.pandas_udf("long")
    def salt(token: pd.Series, spread: pd.Series) -> pd.Series:
        keys, many = salts.value
        if not len(keys):
            return pd.Series(np.zeros(len(token), np.int64))
        t = token.to_numpy()
        at = np.minimum(np.searchsorted(keys, t), len(keys) - 1)
        return pd.Series(np.where(keys[at] == t, spread.to_numpy() % np.maximum(many[at], 1), 0))

    spread = F.pmod(F.xxhash64("ord", "row"), F.lit(1 << 31))
    every = F.when(F.col("c") >= share, F.sequence(F.lit(0).cast("long"), F.floor(F.col("c") / share) - 1)).otherwise(F.array(F.lit(0).cast("long")))
    return tokens.withColumn("salt", salt("token", spread)), counts.withColumn("salt", F.explode(every))


_BITS = [f"bits{i}" for i in range(SKETCH)]
_SETS = "ord long, row long, n int, items binary, listed int, scan long"


def _ordered_sets(tokens: DataFrame, percent: int) -> DataFrame:
    """A row per set that may link: its shingles that others have too, the rarest first, and how many of them it lists."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(cols: list[np.ndarray]) -> pa.RecordBatch:
            ord_, row, n, token, c = cols
            new = np.ones(len(ord_), bool)
            new[1:] = (ord_[1:] != ord_[:-1]) | (row[1:] != row[:-1])
            fresh = new.copy()
            fresh[1:] |= token[1:] != token[:-1]  # rows that repeat an id and a text
            ord_, row, n, token, c, new = (x[fresh] for x in (ord_, row, n, token, c, new))
            start = np.flatnonzero(new)
            k = np.diff(np.append(start, len(new)))
            size = n[start].astype(np.int64)
            least = -(-percent * size // 100)
            listed = k - least + 1  # of the first (size - least + 1) shingles, those that no other set has come first
            sums = np.concatenate([[0], np.cumsum(c)])
            ok = listed > 0
            start, k, size, listed = start[ok], k[ok], size[ok], listed[ok]
            raw = token.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array(ord_[start]), pa.array(row[start]), pa.array(size.astype(np.int32)),
                 pa.array([raw[8 * a: 8 * (a + b)] for a, b in zip(start, k)], pa.binary()), pa.array(listed.astype(np.int32)),
                 pa.array(sums[start + listed] - sums[start])], ["ord", "row", "n", "items", "listed", "scan"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last set may go on in the next batch
            if cut:
                yield made([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield made(held)

    rows = tokens.select("ord", "row", "n", "token", "c").repartition("ord", "row").sortWithinPartitions("ord", "row", "c", "token")
    return rows.mapInArrow(run, _SETS)


def _lists(sets: DataFrame) -> DataFrame:
    """A row for every shingle that a set lists, with its place in the order of the set, the one listed before it, and the set's sketch."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, LISTED_SETS) for b in batches for at in range(0, b.num_rows, LISTED_SETS)):
            listed = batch.column(4).to_numpy()
            own = batch.column(2).to_numpy() - pc.binary_length(batch.column(3)).to_numpy() // 8  # shingles that no other set has
            place = np.arange(listed.sum()) - np.repeat(np.cumsum(listed) - listed, listed) + np.repeat(own, listed)
            items = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(3)]
            token = np.concatenate([x[:m] for x, m in zip(items, listed)])
            sketch, shared = _sketches(items), np.array([len(x) for x in items], np.int32)
            at = pa.array(np.repeat(np.arange(len(listed)), listed))
            yield pa.RecordBatch.from_arrays([pa.array(token), *[batch.column(i).take(at) for i in (0, 1, 2)], pa.array(place.astype(np.int32)),
                 pa.array(np.roll(token, 1), mask=np.roll(np.diff(np.repeat(np.arange(len(listed)), listed), append=len(listed)) > 0, 1)),
                 pa.array(shared).take(at), *[pa.array(bits.copy()).take(at) for bits in sketch.T]],
                ["token", "ord", "row", "n", "pos", "before", "shared", *_BITS])

    return sets.mapInArrow(run, "token long, ord long, row long, n int, pos int, before long, shared int, " + ", ".join(f"{b} long" for b in _BITS))


def _subsets(sets: DataFrame, percent: int, light: int) -> DataFrame:
    """A light set under each subset that a set of a light size has to share with it; kind 1, 2: the smaller, larger size."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ord_, n, items in zip(*(batch.column(i) for i in (0, 2, 3))):
                k, own = n.as_py(), np.sort(np.frombuffer(items.as_buffer(), np.uint64))
                for m in partners(k, percent):
                    a, b = min(k, m), max(k, m)
                    if m > light or len(own) < need(a, b, percent):
                        continue
                    sub = np.array(list(combinations(own.tolist(), need(a, b, percent))), np.uint64)
                    key = np.full(len(sub), np.uint64(a * 1000 + b), np.uint64)
                    for c in range(sub.shape[1]):
                        key = mix(key * np.uint64(31) + sub[:, c])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(key), ord_.as_py(), np.int64)),
                         pa.array(np.full(len(key), 1 if k == a else 2, np.int8))], ["token", "ord", "kind"])

    return sets.where(F.col("n") <= light).mapInArrow(run, "token long, ord long, kind tinyint")


def _reaches(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes with this overlap are linked."""
    return overlap * (100 + percent) >= percent * (a + b)


def _meetings(labelled: DataFrame, percent: int, round_no: int | None) -> DataFrame:
    """Rows (one set, the other as ``hub``) of one list, not in one component, that may still link from this shingle on.

    With a round, each list gives up to ``HUBS`` hubs, by a hash of the set that is the same in all its lists and
    another each round; without, each two sets of a list meet.  A shingle after which too little of one of both
    sets is left for a link, were it their first common one, makes no row: nor would any later one.  Nor do sets
    whose sketches differ too much for the overlap of a link.
    """
    own = F.struct("ord", "row", "n", "label", "pos", "before", "shared", *_BITS)
    if round_no is None:
        # after a common shingle before it, this one is not the first common one
        met = labelled.join(labelled.select("token", own.alias("hub")), "token").where(
            "(hub.ord < ord or (hub.ord = ord and hub.row < row)) and not coalesce(hub.before = before, false)")
    else:
        h = F.xxhash64("ord", "row", F.lit(round_no))
        drawn = labelled.select("token", F.pmod(h, F.lit(HUBS)).alias("place"), F.struct(h.alias("h"), own.alias("hub")).alias("x"))
        met = labelled.join(drawn.groupBy("token", "place").agg(F.min("x").alias("x")).select("token", "x.hub"), "token")
    left = F.least(F.col("hub.n") - F.col("hub.pos"), F.col("n") - F.col("pos"))
    # the shingles that both sets have cancel out: at least ``differ`` of the others are in one set only
    differ = reduce(lambda a, b: a + b, [F.bit_count(F.col(b).bitwiseXOR(F.col(f"hub.{b}"))) for b in _BITS])
    most = F.floor((F.col("shared") + F.col("hub.shared") - differ) / 2)
    return met.where((F.col("hub.label") != F.col("label")) & _reaches(left, F.col("n"), F.col("hub.n"), percent)
                     & _reaches(most, F.col("n"), F.col("hub.n"), percent))


def _pairs(met: DataFrame) -> DataFrame:
    """The pairs that meet, and how often."""
    return met.groupBy(
        F.col("ord").alias("b"), F.col("row").alias("b_row"), F.col("label").alias("b_label"),
        F.col("hub.ord").alias("a"), F.col("hub.row").alias("a_row"), F.col("hub.label").alias("a_label"),
    ).agg(F.count(F.lit(1)).alias("times"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a_label, b_label) whose sets reach the threshold, compared in full."""
    left = sets.select("ord", "row", "n", "items").toDF("a", "a_row", "a_n", "a_items")
    right = sets.select("ord", "row", "n", "items").toDF("b", "b_row", "b_n", "b_items")
    both = pairs.join(left, ["a", "a_row"]).join(right, ["b", "b_row"]).select("a_label", "b_label", "a_n", "b_n", "a_items", "b_items")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            both = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), assume_unique=True))
                    for x, y in zip(batch.column(4), batch.column(5))]
            o = np.array(both, np.int64)
            yield batch.select([0, 1]).filter(pa.array(100 * o >= percent * (size - o)))

    return both.mapInArrow(run, "a_label long, b_label long")


def _relabelled(labels: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``labels`` (ord, label) after the labels that ``links`` joins have become the smallest of them."""
    component = connected_components(links, *links.columns)
    out = labels.join(component, labels["label"] == component["node"], "left")
    return stage(out.select("ord", F.coalesce("component", "label").alias("label")), label)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75,
                    hub_rounds: int = 3) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    texts = keyed_texts(docs, id_col, text_col)
    rows = stage(_set_rows(texts, n), "shingle-sets")

    # one document of each set, and of each document that repeats an id with other texts the sets
    known = rows.where(f"n > 0 and {ID} is not null")
    classes = known.groupBy("lo", "hi", "n").agg(F.min(F.struct(F.col(ID).alias("ord"), F.col(ROW).alias("row"))).alias("one"))
    classes = stage(classes.select("lo", "hi", "n", F.col("one.ord").alias("ord"), F.col("one.row").alias("row")), "set-classes")
    member = stage(known.join(classes.drop("n"), ["lo", "hi"]).select(F.col(ID).alias("id"), F.col("ord").alias("rep")).distinct(), "set-members")
    least = member.groupBy("id").agg(F.min("rep").alias("rep"), F.max("rep").alias("other")).where("rep < other").select("id", F.col("rep").alias("one"))
    links = member.join(least, "id").where("rep <> one").select(F.col("one").alias("a"), F.col("rep").alias("b"))

    # the sets that may link at all, with the shingles that others have too
    with_id = texts.where(F.col(ID).isNotNull())
    few = stage(_may_have_links(with_id, classes, n, percent), "sets-sieved")
    near = narrowed(with_id.select(F.col(ID).alias("ord"), F.col(ROW).alias("row"), TEXT), "ord", few.select("ord"))
    tokens, counts = _salted(stage(_tokens(near.join(few, ["ord", "row"], "left_semi"), n), "shingles"))
    sets = stage(_ordered_sets(tokens.join(counts, ["token", "salt"]), percent), "sets-ordered")
    sizes = {r["n"]: (r["c"], r["s"]) for r in sets.where(F.col("n") < _NEVER_LIGHT).groupBy("n").agg(
        F.count(F.lit(1)).alias("c"), F.sum("scan").alias("s")).collect()}
    light = boundary(sizes, percent)

    # light sets: a common subset of the size in its key is a link by itself
    if light:
        subsets = stage(_subsets(sets, percent, light), "subsets")
        hub = subsets.where("kind = 1").groupBy("token").agg(F.min("ord").alias("hub"))
        links = links.unionByName(subsets.join(hub, "token").where("ord <> hub").select(F.col("hub").alias("a"), F.col("ord").alias("b")))
    labels = member.select(F.col("rep").alias("ord")).distinct().withColumn("label", F.col("ord"))
    labels = _relabelled(labels, links, "labels-light")

    heavy = sets.where((F.col("n") > light) | (100 * F.col("n") >= percent * (light + 1)))
    lists = _lists(heavy)
    for round_no in range(hub_rounds + 1):
        labelled = lists.join(labels, "ord")
        apart = labelled.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token")
        labelled = stage(labelled.join(apart, "token", "left_semi"), f"lists-{round_no}")
        lists = labelled.drop("label")  # a list within one component stays so
        # the last round compares what is still apart within a list, in full
        pairs = _pairs(_meetings(labelled, percent, round_no if round_no < hub_rounds else None))
        if round_no < hub_rounds:  # of the hubs a set meets, the one it meets most often
            pairs = pairs.groupBy("b", "b_row", "b_label").agg(F.max(F.struct("times", "a", "a_row", "a_label")).alias("x")).select(
                "x.*", "b", "b_row", "b_label")
        pairs = pairs.select("a", "a_row", "a_label", "b", "b_row", "b_label")
        labels = _relabelled(labels, _linked(pairs, sets, percent), f"labels-{round_no}")

    # a document's component is that of one of its sets
    final = member.groupBy("id").agg(F.min("rep").alias("rep")).join(labels, F.col("rep") == F.col("ord")).select("id", "label")
    out = rows.join(final, rows[ID] == final["id"], "left")
    return out.select(F.col(ID).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("label", F.col(ID)).alias("component_id"))
