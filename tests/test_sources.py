"""Sources and sinks: registered inputs with provenance, table/view sinks, streaming reload ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.plans.catalog import TABLES, build, is_enabled
from kestrel.plans.reloads import latest_reload
from kestrel.sources.registry import load_inputs, register, unregister
from kestrel.sources.seeds import cut_scores
from kestrel.streaming import ingest_reload_files

LOG_SCHEMA = "student_number bigint, AssessmentName string, SubmitDateTime string, ScaleScore string"


def test_registered_input_with_provenance(spark, tmp_path):
    path = str(tmp_path / "roster")
    spark.createDataFrame([(1, "24-25")], "student_number bigint, year string").write.parquet(path)
    register("roster", path, provenance_column="file_name")
    try:
        df = load_inputs(spark, "/nonexistent", ["roster"])["roster"]
        row = df.collect()[0]
        assert row.student_number == 1 and row.file_name.endswith(".parquet")
    finally:
        unregister("roster")


def test_seed_from_csv(spark, tmp_path):
    p = tmp_path / "cuts.csv"
    p.write_text("grade_band,level_code,min_score,max_score\nK,2L,1374,1397\n")
    df = cut_scores(spark, str(p))
    assert df.collect()[0].asDict() == {"grade_band": "K", "level_code": "2L", "min_score": 1374, "max_score": 1397}
    assert cut_scores(spark).count() == 44


def test_table_and_view_sinks(spark, sf_dir, tmp_path):
    assert "grade_audit" in TABLES and not is_enabled("meals_with_application")
    df = build(spark, "grade_audit", sf_dir, str(tmp_path))
    assert (tmp_path / "grade_audit").exists() and spark.table("grade_audit").count() == df.count()
    build(spark, "pear_best_submission", sf_dir, str(tmp_path))
    assert spark.table("pear_best_submission").count() > 0
    assert not (tmp_path / "pear_best_submission").exists()  # a view writes nothing


def test_streaming_reload_ingest_then_latest_row(spark, tmp_path):
    landing, log = tmp_path / "landing", tmp_path / "log"
    first = [(1, "ELA", "May 29, 2026", "1400"), (2, "ELA", "May 29, 2026", "1500")]
    spark.createDataFrame(first, LOG_SCHEMA).coalesce(1).write.parquet(str(landing / "batch_1"))
    schema = spark.createDataFrame([], LOG_SCHEMA).schema
    q = ingest_reload_files(spark, str(landing / "*"), schema, str(log), checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination(120)
    # a reload of student 1 on the same day lands later: the file name decides (text order)
    spark.createDataFrame([(1, "ELA", "May 29, 2026", "1450")], LOG_SCHEMA).coalesce(1).write.parquet(str(landing / "batch_2"))
    q = ingest_reload_files(spark, str(landing / "*"), schema, str(log), checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination(120)
    logged = spark.read.parquet(str(log))
    assert logged.count() == 3  # each file taken exactly once
    latest = {r.student_number: r.ScaleScore for r in latest_reload(logged).collect()}
    assert latest == {1: "1450", 2: "1500"}
    assert logged.where(F.col("file_name").isNotNull()).count() == 3


def test_latest_snapshot_prunes_partitions(spark, sf_dir, tmp_path):
    """Stored partitioned by load time, the latest-load filter becomes a partition filter (older loads unread)."""
    from kestrel.plans.catalog import runner

    path = str(tmp_path / "stored_grades")
    grades = load_inputs(spark, sf_dir, ["stored_grades"])["stored_grades"]
    grades.write.partitionBy("partitiontime").parquet(path)
    register("stored_grades", path)
    try:
        df = runner("latest_snapshot")(spark, sf_dir)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        part_filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
        assert any("partitiontime" in line and "subquery" in line.lower() for line in part_filters), part_filters
        assert df.count() == grades.where(F.col("partitiontime") == grades.agg(F.max("partitiontime")).first()[0]).count()
    finally:
        unregister("stored_grades")
