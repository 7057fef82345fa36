"""Registered queries of the training-data operators and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (
    best_fit, chunked_bpe, grace_dedup, histogram_topk, html_layout, isolation_rules, kd_shards, merkle_manifest, overlap_join, substring_dedup,
    surrogates, term_pipeline, token_files,
)
from kestrel.llm.common import documents, ship_package

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: the key of the surrogates; a run over real data reads its own from a secret store
SURROGATE_KEY = b"kestrel surrogate key"
SEQUENCE = 2048


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(spark, documents(spark, sf_dir), tokenizer=public_tokenizers.path(WORD_BPE), end_id=1)


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(documents(spark, sf_dir).select("doc_id", "text"), key=SURROGATE_KEY)


def op4_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation_rules.quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text_hash")


def op5_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.near_duplicates(documents(spark, sf_dir))


def op6_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.html_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit_packing(documents(spark, sf_dir), tokenizer=public_tokenizers.path(WORD_BPE), end_id=0, capacity=SEQUENCE)


def op8_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace_dedup.grace_dedup(documents(spark, sf_dir)).drop("text_hash")


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.kd_shards(documents(spark, sf_dir), dims=["n_chars", "doc_id", "lang", "source"], shards=8)


def op10_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.chunked_bpe(documents(spark, sf_dir), ranks=public_tokenizers.path(BYTE_BPE), pattern=public_tokenizers.PATTERN)


#: the columns of ``documents`` that a manifest leaf covers, in order
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    # every seventh document by crc32 has one more character in n_chars
    more = [(F.col(f).cast("decimal(20,0)") + 1) if f == "n_chars" else F.col(f) for f in LEAF_FIELDS]
    tampered = F.when((F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull(), merkle_manifest.leaf_digest(more))
    manifest = merkle_manifest.merkle_manifest(docs, fields=LEAF_FIELDS, group="lang", order="doc_id", carry={"tampered": tampered})
    out = merkle_manifest.folded(manifest.withColumn("judged", F.coalesce("tampered", "leaf")), "judged")
    digests = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof_sha256": "proof", "folded_root": "folded"}
    return out.select("doc_id", *[F.lower(F.hex(c)).alias(name) for name, c in digests.items()], (F.col("folded") == F.col("root")).alias("verified"))


def op12_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_topk.exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), is_query=F.col("vec_id") % 50 == 0, k=5)


def op13_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pipeline.term_pipeline(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship_package(spark), sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (op1_substring_dedup, op2_token_files, op3_surrogates, op4_isolation_rules, op5_overlap_join, op6_html_layout,
                            op7_best_fit, op8_grace_dedup, op9_kd_shards, op10_chunked_bpe, op11_merkle_manifest,
                            op12_histogram_topk, op13_term_pipeline)
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS place FROM d WHERE len(words) >= 50
), win AS (
  SELECT doc_id, place, array_to_string(words[place:place + 49], ' ') AS said FROM starts
), earliest AS (
  SELECT said, min(doc_id) AS doc_id FROM win GROUP BY said
), covered AS (
  SELECT DISTINCT w.doc_id, w.place + t.step AS place FROM win w JOIN earliest e ON e.said = w.said AND e.doc_id < w.doc_id, range(0, 50) t(step)
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS said FROM word ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op5_overlap_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(words) - 3, 2)), lambda i: array_to_string(words[i:i + 4], ' '))) AS s FROM d WHERE len(words) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id
    JOIN size a ON a.doc_id = x.doc_id JOIN size b ON b.doc_id = y.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(doc_id, met) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT link.b, reach.met FROM reach JOIN link ON link.a = reach.doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(met) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM d LEFT JOIN size USING (doc_id)
""",
    "op8_grace_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), k AS (
  SELECT norm, arg_min(doc_id, {'p': -points, 'd': doc_id}) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id AS kept, sha256(d.norm) AS text_sha256 FROM d JOIN k USING (norm)
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::UBIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))) AS crc
  FROM documents
), l AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS tampered
  FROM d
), a AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM l
), up AS (
  SELECT lang, 0 AS lvl, place, n, leaf AS h FROM a
  UNION ALL
  SELECT lang, lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM up WHERE n > 1 GROUP BY lang, lvl, place // 2, n
), sub AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, place, n, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM top WHERE n > 1 GROUP BY lvl, place // 2, n
), way AS (  -- the nodes from each leaf up that still have to be joined
  SELECT a.rid, 0 AS tier, u.lvl, u.place % 2 AS side, s.h
  FROM a JOIN up u ON u.lang IS NOT DISTINCT FROM a.lang AND u.n > 1 AND u.place = a.place >> u.lvl
  LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM u.lang AND s.lvl = u.lvl AND s.place = xor(u.place, 1)
  UNION ALL
  SELECT a.rid, 1, t.lvl, t.place % 2, s.h
  FROM a JOIN sub ON sub.lang IS NOT DISTINCT FROM a.lang JOIN top t ON t.n > 1 AND t.place = sub.place >> t.lvl
  LEFT JOIN top s ON s.lvl = t.lvl AND s.place = xor(t.place, 1)
), proof AS (
  SELECT rid, string_agg(coalesce(h, ''), '' ORDER BY tier, lvl) AS siblings,
    list(CASE WHEN h IS NULL THEN '-' WHEN side = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY tier, lvl) AS steps
  FROM way GROUP BY rid
), f AS (
  SELECT a.doc_id, a.leaf, sub.subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])), lambda acc, s: sha256(
      CASE s[1] WHEN 'L' THEN s[2:] || acc WHEN 'R' THEN acc || s[2:] ELSE acc END)) AS folded_root
  FROM a JOIN sub ON sub.lang IS NOT DISTINCT FROM a.lang LEFT JOIN proof p ON p.rid = a.rid
)
SELECT *, folded_root = root AS verified FROM f
""",
    "op12_histogram_topk": r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.rid <> b.rid
), r AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op13_term_pipeline": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), n AS (
  SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0
), p AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), n
), i AS (
  SELECT DISTINCT iid, item_id, term FROM (
    SELECT iid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS iid, * FROM benchmark))
), s AS (
  SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * p.n * docs) // total))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN p USING (term), n GROUP BY iid, item_id, rid, doc_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
""",
}
