"""Manifest, exact top-k and ranked search against plain versions over small tables of awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kestrel.llm import histogram_topk, merkle_manifest, queries, term_pipeline
from kestrel.llm.common import ship_package
from tests.llm.conftest import ROWS
from pyspark.sql import functions as F


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, change):
    """(doc_id, leaf, subroot, root, proof, folded) of (doc_id, source, lang, n_chars, text) rows, level by level."""
    def leaf(row):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, place):
        for level in tree[:-1]:
            other = place ^ 1
            yield place & 1, level[other] if other < len(level) else None
            place >>= 1

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names]) if names else []
    out = Counter()
    for i, g in enumerate(names):
        for place, (_, _, own, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            way = [*path(trees[g], place), *path(top, i)]
            folded = leaf(change(row))
            for right, other in way:
                folded = h(folded) if other is None else h(other, folded) if right else h(folded, other)
            out[row[0], own, trees[g][-1][0], top[-1][0], h(*[o for _, o in way if o]), folded] += 1
    return out


def more_chars(row):
    hit = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
    return (*row[:3], row[3] + 1, row[4]) if hit else row


def manifest_rows(docs, block_bits):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = [(F.col(f) + 1) if f == "n_chars" else F.col(f) for f in fields]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    m = merkle_manifest.merkle_manifest(docs, fields=fields, group="lang", order="doc_id", block_bits=block_bits, carry={"tampered": F.when(hit, merkle_manifest.leaf_digest(more))})
    out = merkle_manifest.folded(m.withColumn("judged", F.coalesce("tampered", "leaf")), "judged").collect()
    return Counter((r["doc_id"], *(bytes(r[c]).hex() for c in ("leaf", "subroot", "root", "proof", "folded"))) for r in out)


@pytest.mark.parametrize("block_bits", [12, 2, 1])
def test_manifest_of_awkward_rows(spark, docs, empty, block_bits):
    docs = docs.withColumn("lang", F.expr("case when doc_id % 5 = 0 then 'ü' when doc_id = 21 then '' else lang end"))
    docs = docs.withColumn("n_chars", F.expr("case when doc_id % 3 > 0 then n_chars end"))
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert manifest_rows(docs, block_bits) == plain_manifest(rows, more_chars)
    if block_bits == 2:
        assert not manifest_rows(empty, block_bits)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 17, 33])
def test_manifest_sizes(spark, n):
    """Every shape of a last block, and the lone leaf and the lone group."""
    ship_package(spark)
    rows = [(i // 2, "s", None, None if i % 4 else i, "same") for i in range(n)]  # equal ids, and repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_rows(docs, 2) == plain_manifest(rows, more_chars)


def test_witnesses_grow_with_each_sibling():
    tree = merkle_manifest.Append()
    leaves = [bytes([i]) * 32 for i in range(4)]
    lengths = []
    for leaf in leaves:
        tree.add(leaf)
        lengths.append([len(w) for w in tree.witnesses])
    assert lengths == [[0], [1, 1], [1, 1, 0], [2, 2, 2, 2]]  # later siblings extend what is there
    root = tree.close(2)
    assert all(merkle_manifest.fold(leaf, b"".join(w)) == root for leaf, w in zip(leaves, tree.witnesses))
    assert merkle_manifest.fold(leaves[1], b"".join(tree.witnesses[0])) != root


VECTORS = [(i, [math.sin(i * j) for j in range(1, 7)]) for i in range(1, 140)]
VECTORS += [(200 + i, [0.5, -0.25, 0.125, 0.0, 1.0, -1.0]) for i in range(30)] + [(250, [0.5, -0.25, 0.125, 0.0, 1.0, -1.0])] * 2
VECTORS += [(300, None), (350, [1.0, None]), (400, [float("nan")] * 6), (450, [float("inf")] + [0.0] * 5), (500, []), (550, [2.0]), (None, [0.5, -0.25, 0.125, 0.0, 1.0, -1.0])]


def plain_top_k(rows, k):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)]
    out = Counter()
    for at, (i, v) in enumerate(kept):
        if i is None or i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for other, (j, w) in enumerate(kept) if other != at)
        out.update((i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k], 1))
    return out


def top_k(df, **more):
    got = histogram_topk.exact_top_k(df, is_query=F.col("vec_id") % 50 == 0, **more).collect()
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("bins,block_rows,k", [(1024, 8192, 5), (7, 16, 5), (16, 40, 1), (16, 40, 400)])
def test_top_k(spark, bins, block_rows, k):
    ship_package(spark)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in VECTORS], "vec_id long, embedding array<double>, row string, bin int").repartition(3)
    assert top_k(df, bins=bins, block_rows=block_rows, k=k) == plain_top_k(VECTORS, k)


def test_top_k_of_large_and_few_numbers(spark):
    ship_package(spark)
    schema = "vec_id long, embedding array<double>"
    large = [(50 * i, [(-1) ** i * 3.0e5 * (i + 1), 1.0e5 + i, 0.37]) for i in range(9)]  # products beyond 2^53, sums within 2^62
    assert top_k(spark.createDataFrame(large, schema), k=3) == plain_top_k(large, 3)
    assert top_k(spark.createDataFrame(VECTORS[:1], schema)) == Counter()
    assert top_k(spark.createDataFrame([(50, [1.0])], schema)) == Counter()
    assert top_k(spark.createDataFrame([], schema)) == Counter()
    beyond = histogram_topk.exact_top_k(spark.createDataFrame([(50, [1e300]), (51, [1e300])], schema), is_query=F.col("vec_id") == 50)
    assert [tuple(r) for r in beyond.collect()] == [(50, 1, 51, histogram_topk.CLIP)]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_search(docs, items, k):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for i, c in counted:
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * c.total() * n_docs) // total)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out.update((item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1))
    return out


def searched(docs, items, **more):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in term_pipeline.term_pipeline(docs, items, **more).collect())


ITEMS = [(i, t) for i, (_, t) in enumerate(ROWS[:12])]
ITEMS += [(20, None), (21, ""), (22, "?!"), (23, "plain WORDS only here"), (23, "plain words"), (24, "x" * 90_000), (25, "nowhere in any text"), (None, "that That THAT"), (26, "ann.b@mail.example.com ß ña")]


@pytest.mark.parametrize("shard_docs,bundle_items,k", [(8192, 256, 10), (5, 4, 10), (9, 256, 2), (5, 256, 100)])
def test_ranked_search(spark, docs, empty, shard_docs, bundle_items, k):
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, term int, shard string")
    assert searched(docs, items, shard_docs=shard_docs, bundle_items=bundle_items, k=k) == plain_search(ROWS, ITEMS, k)


def test_ranked_search_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "plain words")], "item_id long, text string")
    assert not searched(empty, items)
    assert not searched(docs, items.where("1 = 0"))
    assert not searched(docs.where("doc_id in (20, 21, 22)"), items)


def test_carried_accumulators_stay_exact(spark):
    """Many documents and small shards: bounds between owners drop most accumulators, never a winner."""
    ship_package(spark)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    draw = lambda n: " ".join(words[min(399, int(x))] for x in rng.pareto(0.7, n) * 3)
    rows = [(i, draw(int(rng.integers(1, 60)))) for i in range(1500)] + [(2000 + i, "w0 w1 w2 w390") for i in range(40)]
    asked = [(i, draw(25)) for i in range(12)] + [(50, "w0 w1 w2 w390")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert searched(spark.createDataFrame(rows, "doc_id long, text string"), items, shard_docs=100, bundle_items=5) == plain_search(rows, asked, 10)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_histogram_topk", "op13_term_pipeline"])
def test_registered_with_sql(name):
    assert name in queries.QUERIES and name in queries.ORACLE_SQL
