"""Ranked lexical search by pipelined term partitioning.

Documents are dealt into shards.  A shard's postings are owned by term owners: owner 0 holds the rarest terms,
each later one more frequent ones.  Bundles of items visit the owners one after another, once for every shard:
a stage cogroups the bundle, which carries sparse accumulators (places in the shard and 64-bit scores), with
its owner's postings of that shard, and adds integer contributions.  The last stage selects.

Contributions are never negative, so between stages the k-th best partial score of an item over all shards
bounds its k-th best score from below.  What cannot reach it any more, even with the largest contribution of
every term still to come, is not carried on, and where all that is still to come cannot reach it, no further
documents are opened.  Both tests are exact: ties are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import Words, renewed, stage, text_slices

#: a document frequency of more than N / share belongs to a later owner
OWNER_SHARES = (256, 32, 4)
BITS = 23

# every byte that is no part of a term becomes a blank, A-Z become a-z; bytes from 0x80 on stay
_FOLD = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_first:_last + 1] = np.arange(_first, _last + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def _terms(texts: pa.Array) -> Words:
    """The terms of some whole texts (``large_string`` without nulls)."""
    _, offsets, data = texts.buffers()
    if data is None:
        return Words(texts)
    spaced = _FOLD[np.frombuffer(data, np.uint8)]
    return Words(pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(spaced), offset=texts.offset))


def _counted(vocabulary: np.ndarray | None):
    """Rows (row, id, text) to (row, id, n, terms, tfs); terms that are certainly not asked for are left out."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column("text")):
                words = _terms(texts)
                size = max(1, len(words.distinct))
                doc = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
                pairs = doc * size + words.codes
                if vocabulary is not None:
                    spelled = words.distinct.to_pylist()
                    at = np.fromiter((xxhash.xxh3_64_intdigest(w) & ((1 << BITS) - 1) for w in spelled), np.int64, len(spelled))
                    asked = (vocabulary[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    pairs = pairs[asked[words.codes]]
                pairs, tfs = np.unique(pairs, return_counts=True)
                lists = pa.array(np.searchsorted(pairs, np.arange(len(texts) + 1) * size), pa.int32())
                terms = words.distinct.take(pa.array(pairs % size)).cast(pa.string())
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row"), rows.column("id"), pa.array(np.diff(words.offsets), pa.int64()),
                     pa.ListArray.from_arrays(lists, terms), pa.ListArray.from_arrays(lists, pa.array(tfs, pa.int64()))],
                    names=["row", "id", "n", "terms", "tfs"])

    return run


def _term_rows(table: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray | None) -> DataFrame:
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counted(vocabulary), "row long, id long, n long, terms array<string>, tfs array<long>")


def _vocabulary(terms: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** 23 bits (1 MB, whatever the items) of the term hashes; the join with the terms decides."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [xxhash.xxh3_64_intdigest(t) & ((1 << BITS) - 1) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["place"])

    places = terms.mapInArrow(run, "place long").select((F.col("place") + 1).alias("p"))
    rows = places.groupBy(F.expr("bitmap_bucket_number(p)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect()
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in rows:  # a bucket has 4096 bytes; buckets count from 1
        got = np.frombuffer(r["bits"], np.uint8)
        out[(r["b"] - 1) * 4096: (r["b"] - 1) * 4096 + len(got)] = got
    return out


_POSTINGS = "shard int, term string, df long, top_tf long, least_n long, docs binary, tfs binary, ids array<bigint>, lengths binary, n_docs long, n_terms long"


def _inverted(table: pa.Table) -> pa.Table:
    """One shard's documents to one row a term, and one row without a term for the documents themselves.

    Documents get places in ascending order of their id (null last), so places order ties as ids do.
    """
    table = table.sort_by([("id", "ascending"), ("row", "ascending")])
    shard, n = table.column("shard")[0].as_py(), table.column("n").to_numpy()
    lists = table.column("terms").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    codes, tfs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), table.column("tfs").combine_chunks().flatten().to_numpy()
    docs = np.repeat(np.arange(len(table)), pc.list_value_length(lists).to_numpy())
    by_term = np.argsort(codes, kind="stable")
    docs, tfs, ends = docs[by_term], tfs[by_term], np.searchsorted(codes[by_term], np.arange(len(coded.dictionary) + 1))
    rows = {name: [] for name in ("term", "df", "top_tf", "least_n", "docs", "tfs")}
    for term, a, b in zip(coded.dictionary.to_pylist(), ends[:-1], ends[1:]):
        values = (term, b - a, tfs[a:b].max(), n[docs[a:b]].min(), docs[a:b].astype("<i4").tobytes(), tfs[a:b].astype("<i8").tobytes())
        for column, value in zip(rows.values(), values):
            column.append(value)
    none = [None] * len(rows["term"])
    own = {"term": None, "df": None, "top_tf": None, "least_n": None, "docs": None, "tfs": None}
    return pa.table({
        "shard": pa.array([shard] * (len(none) + 1), pa.int32()),
        **{c: pa.array([*rows[c], own[c]], t) for c, t in (("term", pa.string()), ("df", pa.int64()), ("top_tf", pa.int64()), ("least_n", pa.int64()),
                                                           ("docs", pa.binary()), ("tfs", pa.binary()))},
        "ids": pa.array([*none, table.column("id").to_pylist()], pa.list_(pa.int64())),
        "lengths": pa.array([*none, n.astype("<i8").tobytes()], pa.binary()),
        "n_docs": pa.array([*none, int((n > 0).sum())], pa.int64()),
        "n_terms": pa.array([*none, int(n.sum())], pa.int64())})


def _part(tf, n, docs: int, terms: int):
    """What a term adds for each unit of its weight; on numbers and, through ``F.expr``, on column names."""
    if isinstance(tf, str):
        return F.expr(f"(1000000000 * {tf}) div (1000 * {tf} + 8 * (10 + (90 * {n} * {docs}) div {terms}))")
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))


_BUNDLE = "bundle int, shard int, item long, docs binary, scores binary, best array<bigint>"
_FOUND = "item long, doc_id long, score long"


def _visit(docs: int, terms: int, k: int, last: bool):
    """One owner's stage for one bundle and one shard."""

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        lists, lengths, ids = {}, np.zeros(0, np.int64), []
        for row in postings.to_pylist():
            if row["term"] is None:
                lengths, ids = np.frombuffer(row["lengths"], "<i8"), row["ids"]
            else:
                lists[row["term"]] = (np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["tfs"], "<i8"))
        adds = {t: _part(tf, lengths[at], docs, terms) for t, (at, tf) in lists.items()}
        carried = {r["item"]: r for r in bundle.to_pylist() if r["terms"] is None}
        out = {name: [] for name in ("bundle", "shard", "item", "docs", "scores", "best", "doc_id", "score")}
        for asked in bundle.filter(pc.is_valid(bundle.column("terms"))).to_pylist():
            scores = np.zeros(len(lengths), np.int64)
            before = carried.get(asked["item"])
            opened = np.frombuffer(before["docs"], "<i4") if before else np.zeros(0, "<i4")
            if before:
                scores[opened] = np.frombuffer(before["scores"], "<i8")
            bound, rest = asked["bound"] or 0, asked["rest"]
            if asked["now"] + rest >= bound or len(opened):
                for use in asked["terms"]:
                    if use["term"] in lists:
                        scores[lists[use["term"]][0]] += use["w"] * adds[use["term"]]
            if asked["now"] + rest >= bound:  # a document not yet opened may still get among the best
                opened = np.flatnonzero(scores)
            values = scores[opened]
            if len(values) >= k:  # the shard's own k-th best is a bound as well
                bound = max(bound, int(np.partition(values, -k)[-k]))
            keep = values + rest >= max(bound, 1)
            opened, values = opened[keep], values[keep]
            best = np.argsort(-values, kind="stable")[:k]  # equal scores in order of the places
            if not len(values):
                continue
            if last:
                out["item"] += [asked["item"]] * len(best)
                out["doc_id"] += [ids[i] for i in opened[best]]
                out["score"] += values[best].tolist()
                continue
            row = (asked["bundle"], asked["shard"], asked["item"], opened.astype("<i4").tobytes(), values.astype("<i8").tobytes(), values[best].tolist())
            for name, value in zip(("bundle", "shard", "item", "docs", "scores", "best"), row):
                out[name].append(value)
        if last:
            return pa.table({c: pa.array(out[c], pa.int64()) for c in ("item", "doc_id", "score")})
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table({c: pa.array(out[c], t) for c, t in zip(("bundle", "shard", "item", "docs", "scores", "best"), types)})

    return run


def term_pipeline(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", k: int = 10, shard_docs: int = 8192, bundle_items: int = 256) -> DataFrame:
    """(item, rank, document, score): the ``k`` best documents with a score above 0 for each item.

    Terms are the maximal runs of digits, ASCII letters (A-Z lower-cased) and characters from U+0080 on, of whole
    texts.  An item's terms count once each.  Equal scores go to the smaller document id, one without an id last.

    * A null or empty text has no terms: such a document is never found and not counted, such an item has no rows.
    * Repeated ids: every row is a document, or an item, of its own, so an id can come more than once in a list.
    * Fewer than ``k`` documents above 0: all of them.  Empty tables: no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    none = spark.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
    asked = stage(_term_rows(items, item_col, item_text_col, None).select("row", "id", F.explode("terms").alias("term")), "search-items")
    n_items = asked.select("row").distinct().count()
    if not n_items:
        return none
    shards, bundles = max(1, -(-docs.count() // shard_docs)), -(-n_items // bundle_items)
    rows = _term_rows(docs, id_col, text_col, _vocabulary(asked.select("term")))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    index = stage(dealt.groupBy("shard").applyInArrow(_inverted, _POSTINGS), "search-index")
    total = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    if not total["terms"]:
        return none
    n_docs, n_terms = total["docs"], total["terms"]
    found = index.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"), F.max("top_tf").alias("tf"), F.min("least_n").alias("n"))
    owner = reduce(lambda a, b: a + b, [(F.col("df") * share > n_docs).cast("int") for share in OWNER_SHARES])
    weights = found.select("term", F.floor(1000 * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1))).cast("bigint").alias("w"),
                           _part("tf", "n", n_docs, n_terms).alias("most"), owner.alias("owner"))
    uses = stage(asked.join(weights, "term").select(
        F.pmod(F.xxhash64("row"), F.lit(bundles)).cast("int").alias("bundle"), F.col("row").alias("item"), "id", "term", "w", (F.col("w") * F.col("most")).alias("most"), "owner"), "search-uses")
    names = uses.select("item", F.col("id").alias(item_col)).distinct()
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    carried = bounds = None
    for at in range(len(OWNER_SHARES) + 1):
        last = at == len(OWNER_SHARES)
        here = F.col("owner") == at
        wants = uses.groupBy("bundle", "item").agg(
            F.collect_list(F.when(here, F.struct("term", "w"))).alias("terms"), F.coalesce(F.sum(F.when(here, F.col("most"))), F.lit(0)).alias("now"),
            F.coalesce(F.sum(F.when(F.col("owner") > at, F.col("most"))), F.lit(0)).alias("rest"))
        wants = wants.join(bounds, "item", "left") if bounds is not None else wants.withColumn("bound", F.lit(None).cast("bigint"))
        empty: list[Column] = [F.lit(None).cast("binary").alias(c) for c in ("docs", "scores")]
        bundle = wants.select("bundle", all_shards, "item", "terms", "now", "rest", "bound", *empty)
        if carried is not None:
            blank = [F.lit(None).cast(bundle.schema[c].dataType).alias(c) for c in ("terms", "now", "rest", "bound")]
            bundle = bundle.unionByName(carried.select("bundle", "shard", "item", *blank, "docs", "scores"))
        owned = index.select("shard", "term", "docs", "tfs", "ids", "lengths")
        postings = owned.join(uses.where(here).select("bundle", "term").distinct(), "term").select("bundle", "shard", "term", "docs", "tfs", "ids", "lengths")
        own = owned.where("term is null").withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))))
        both = bundle.groupBy("bundle", "shard").cogroup(renewed(postings.unionByName(own)).groupBy("bundle", "shard"))
        result = both.applyInArrow(_visit(n_docs, n_terms, k, last), _FOUND if last else _BUNDLE)
        if not last:
            carried = stage(result, "search-bundles")
            down = Window.partitionBy("item").orderBy(F.col("score").desc())
            kth = carried.select("item", F.explode("best").alias("score")).withColumn("at", F.row_number().over(down)).where(F.col("at") <= k)
            bounds = kth.where(F.col("at") == k).select("item", F.col("score").alias("bound"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "item").select(item_col, "rank", F.col("doc_id").alias(id_col), "score")
