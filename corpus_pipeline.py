"""A training corpus from ``documents``: quality rules, exact and near duplicates, private data, packing.

Every stage reads all that the one before kept and returns the columns of ``documents``; the last returns
the packed pieces.  Between stages the rows are written as Parquet in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.best_fit import best_fit_packing
from kestrel.llm.common import ship_package, stage
from kestrel.llm.grace_dedup import grace_dedup
from kestrel.llm.isolation_rules import quality_rules
from kestrel.llm.overlap_join import near_duplicates
from kestrel.llm.queries import SEQUENCE, SURROGATE_KEY, WORD_BPE
from kestrel.llm.surrogates import with_surrogates


def _rows_of(docs: DataFrame, verdicts: DataFrame, *, once: bool) -> DataFrame:
    """Rows of ``docs`` that are kept by (doc_id, hash of the text); with ``once``, equal rows stay once.

    Only rows that are repeated in the table go through a second shuffle.
    """
    keys = verdicts.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__times")).where("__kept")
    keys = keys.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__times")
    # columns by place, so that the table's names meet none of those used here
    own = docs.toDF(*[f"own_{i}" for i in range(len(docs.columns))])
    doc_id, text = (own.columns[docs.columns.index(c)] for c in ("doc_id", "text"))
    text_hash = F.xxhash64(own[text].cast("string"))
    kept = own.join(keys, own[doc_id].cast("bigint").eqNullSafe(keys["__id"]) & (text_hash == keys["__hash"]))
    if once:
        kept = kept.where("__times = 1").unionByName(kept.where("__times > 1").dropDuplicates(["__id", "__hash"]))
    return kept.select(own.columns).toDF(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _rows_of(docs, quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), once=False)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _rows_of(docs, grace_dedup(docs), once=True)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; a row without an id is in none."""
    ship_package(spark)
    groups = near_duplicates(docs)
    dropped = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(dropped, docs["doc_id"].cast("bigint") == dropped["__id"], "left_anti")


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = with_surrogates(docs, key=SURROGATE_KEY)
    changed = F.col(f"`{out.columns[-2]}`") > 0  # the number of entities
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return best_fit_packing(docs, tokenizer=public_tokenizers.path(WORD_BPE), end_id=0, capacity=SEQUENCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("exact_dedup", keep_first_copies),
    ("ngram_jaccard_join", keep_one_of_near),
    ("pii", replace_private),
    ("best_fit_packing", pack),
]

#: the forest of the first stage is beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
