"""Views that follow their sources, tables that are replaced in one step, declared schemas, late materialisation."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from kestrel.operators.dedupe import keep_best_by_reference
from kestrel.plans.catalog import build, runner
from kestrel.plans.reloads import latest_reload
from kestrel.sources import sinks
from kestrel.sources.registry import ROW_REFERENCE, SchemaDrift, load_inputs, register, unregister


def scans(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return "\n".join(line for line in text.splitlines() if line.startswith("ReadSchema"))


def test_a_model_view_follows_appends_and_overwrites(spark, sf_dir, tmp_path):
    path = str(tmp_path / "updates")
    rows = load_inputs(spark, sf_dir, ["assignment_updates"])["assignment_updates"].where("assignment_status = 'DONE'").limit(40).cache()
    some = lambda a, b: spark.createDataFrame(rows.collect()[a:b], rows.schema)
    some(0, 10).write.parquet(path)
    register("assignment_updates", path)
    try:
        count = lambda: (sinks.read_view(spark, "pear_best_submission").count(),
                         sinks.run_sql(spark, "SELECT * FROM pear_best_submission").count())
        build(spark, "pear_best_submission", sf_dir, str(tmp_path))
        expected = lambda: runner("pear_best_submission")(spark, sf_dir).count()
        first = count()
        some(10, 40).write.mode("append").parquet(path)
        grown = count()
        assert first[0] < grown[0] and grown == (expected(), expected())
        some(5, 9).write.mode("overwrite").parquet(path)
        assert count() == (expected(), expected()) and count()[0] < first[0]
    finally:
        unregister("assignment_updates")
        sinks.drop_view(spark, "pear_best_submission")


def test_a_source_view_is_resolved_on_each_read(spark, tmp_path):
    path = str(tmp_path / "a `quoted` folder")
    spark.range(10).write.parquet(path)
    sinks.source_view(spark, "numbers_seen", path)
    spark.range(5).write.mode("append").parquet(path)
    assert spark.table("numbers_seen").count() == 15 == spark.sql("SELECT * FROM numbers_seen").count()
    spark.range(3).write.mode("overwrite").parquet(path)
    assert spark.table("numbers_seen").count() == 3
    spark.catalog.dropTempView("numbers_seen")


def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    sinks.as_table(spark.range(10), path)
    held = sinks.read_table(spark, path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.as_table(broken, path)
    assert sinks.read_table(spark, path).count() == 10
    sinks.as_table(sinks.read_table(spark, path).where("id < 4"), path)  # a table that reads itself
    assert sinks.read_table(spark, path).count() == 4 and held.count() == 10  # a reader ends on the version it began with
    assert len(sinks.vacuum(spark, path)) >= 1
    assert sinks.read_table(spark, path).count() == 4 and not sinks.vacuum(spark, path)
    sinks.as_table(spark.range(6).selectExpr("id", "id % 2 AS part"), path, partition_by=["part"])
    assert sinks.read_table(spark, path).where("part = 1").count() == 3


def test_drifted_files_fail_with_their_columns(spark, tmp_path):
    path = str(tmp_path / "roster")
    register("roster", path, schema="student_number bigint, YEAR string, grade_level int")
    read = lambda: load_inputs(spark, "/nonexistent", ["roster"])["roster"]
    try:
        spark.createDataFrame([(5, "24-25", 1)], "grade_level int, year string, student_number bigint").write.parquet(path)
        assert read().columns == ["student_number", "YEAR", "grade_level"] and read().first() == (1, "24-25", 5)
        spark.createDataFrame([("1", "24-25", "x")], "student_number string, year string, campus string").write.mode("overwrite").parquet(path)
        with pytest.raises(SchemaDrift) as e:
            read()
        for part in ("'grade_level' is missing", "'campus' is not declared", "'student_number' is string, declared as bigint", "input 'roster'"):
            assert part in str(e.value)
    finally:
        unregister("roster")


LOG = "student_number bigint, AssessmentName string, SubmitDateTime string, file_name string, ScaleScore string, Unused string"


def test_latest_row_by_reference_reads_wide_columns_of_winners_only(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(i % 20, "t", f"May {1 + i % 9}, 2026", f"f{i % 3}", str(i), "u" * 50) for i in range(400)] + [(None, "t", None, None, "n", "u")] * 3
    spark.createDataFrame(rows, LOG).repartition(3).write.parquet(path)
    register("state_results_pascal", path, row_reference=True)
    try:
        log = load_inputs(spark, "", ["state_results_pascal"])["state_results_pascal"]
        latest = latest_reload(log)
        assert latest.columns == [c.split()[0] for c in LOG.split(", ")]
        got = {r.student_number: (r.SubmitDateTime, r.file_name) for r in latest.collect()}
        best = {}
        for n, _, day, file, *_ in rows:
            best[n] = max(best.get(n, ("", "")), (day or "", file or ""))
        assert {k: (a or "", b or "") for k, (a, b) in got.items()} == best and latest.count() == 21
        assert "Unused" not in scans(latest.select("student_number", "ScaleScore"))
        assert "ScaleScore" in scans(latest.select("student_number", "ScaleScore"))
    finally:
        unregister("state_results_pascal")


def test_models_over_referenced_logs_read_what_they_show(spark, sf_dir, tmp_path):
    path = str(tmp_path / "log")
    load_inputs(spark, sf_dir, ["state_results_pascal"])["state_results_pascal"].write.parquet(path)
    plain = runner("interim_ica")(spark, sf_dir)
    register("state_results_pascal", path, row_reference=True)
    try:
        by_reference = runner("interim_ica")(spark, sf_dir)
        assert by_reference.columns == plain.columns and by_reference.count() == plain.count()
        read = scans(by_reference)
        assert "ELPAC: Listening" not in read and "CAST: Life Sciences" not in read
    finally:
        unregister("state_results_pascal")


def test_reference_choice_equals_the_plain_window(spark):
    df = spark.range(300).selectExpr("id % 17 AS k", "id % 5 AS d", "concat('f', id % 2) AS `__row_file`", "id AS `__row_index`", "id * 3 AS wide")
    got = keep_best_by_reference(df, ["k"], [F.col("d").desc_nulls_last()], ROW_REFERENCE)
    best = {}
    for r in df.collect():
        best[r.k] = max(best.get(r.k, (-1,)), (r.d, r["__row_file"], r["__row_index"], r.wide))
    assert Counter((r.k, r.wide) for r in got.collect()) == Counter((k, v[3]) for k, v in best.items())


def test_split_part_takes_plain_delimiters(spark):
    from kestrel.functions.columns import split_part

    df = spark.createDataFrame([("a.b|c,d",)], "x string")
    got = df.select(*[split_part("x", d, 1, safe=True).alias(f"d{i}") for i, d in enumerate([".", "|", ",", "\\", "b|c"])]).first()
    assert tuple(got) == ("b|c,d", "c,d", "d", None, ",d")


def test_checks_ride_on_the_write(spark, tmp_path):
    from kestrel.operators.checks import accepted_range, not_null
    from kestrel.plans.quality import checked_write

    df = spark.createDataFrame([(1, 5), (None, 700), (3, None)], "k int, score int")
    path = str(tmp_path / "out")
    assert checked_write(df, path, [not_null("k"), accepted_range("score", 0, 100)]) == [("not_null:k", 1), ("accepted_range:score", 1)]
    assert spark.read.parquet(path).count() == 3
    assert checked_write(df, str(tmp_path / "plain"), []) == []


def test_every_check_is_in_the_whole_run(spark, sf_dir):
    from kestrel.plans.catalog import runner
    from kestrel.plans.quality import ROW_CHECKS, SUMMARY_CHECKS

    found = {r.check for r in runner("check_all")(spark, sf_dir).collect()}
    assert set(ROW_CHECKS) <= found
    assert all(any(c.startswith(f"{key}.") for c in found) for key in SUMMARY_CHECKS)
