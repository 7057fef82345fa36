from __future__ import annotations

import corpus_pipeline
from kestrel.llm import surrogates


def test_stages_and_empty_table(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, empty):
        before = table
        for name, step in corpus_pipeline.STAGES[:-1]:
            after = step(spark, before, str(tmp_path))
            assert after.columns == docs.columns, name
            assert after.count() <= before.count()
            before = spark.createDataFrame(after.collect(), docs.schema)
        packed = corpus_pipeline.STAGES[-1][1](spark, before, str(tmp_path))
        assert packed.where("doc_id is not null").select("doc_id").distinct().count() == before.where("doc_id is not null").select("doc_id").distinct().count()


def test_equal_rows_stay_once(spark, docs):
    kept = corpus_pipeline.keep_first_copies(spark, docs, "").select("doc_id").collect()
    ids = sorted(r[0] for r in kept if r[0] is not None)
    assert len(ids) == len(set(ids))
    assert 30 not in ids and 40 in ids  # the copy with the most code points stays


def test_clashing_column_names_come_through(spark, docs):
    """Columns with the names that stages use inside keep their values."""
    clashing = docs.select("doc_id", "text", "lang", "n_chars")
    for i, name in enumerate(["__id", "__hash", "__times", "__doc", "__row", "__n", "n_entities", "kinds", "text_hash", "__cid", "own_0"]):
        clashing = clashing.withColumn(name, clashing["doc_id"] * 10 + i)
    kept = corpus_pipeline.keep_first_copies(spark, clashing, "")
    out = corpus_pipeline.replace_private(spark, kept, "")
    assert out.columns == clashing.columns
    rows = out.collect()
    assert rows and all(r[c] == (None if r["doc_id"] is None else r["doc_id"] * 10 + i) for r in rows for i, c in enumerate(out.columns[4:]))
    counted = surrogates.with_surrogates(clashing.where("doc_id = 50"), key=b"k")
    assert counted.columns[-2:] == ["n_entities_", "kinds_"]
    row = counted.first()
    assert row["n_entities_"] > 3 and row["__doc"] == 503 and row["n_entities"] == 506
