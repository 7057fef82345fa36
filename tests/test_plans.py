"""Plan-shape guards: what the physical plans of the registered queries must (not) contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_feed_filters_reach_the_scan(spark, sf_dir):
    df = QUERIES["unified_assessments"](spark, sf_dir)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for kind in ["view", "click", "signup", "purchase", "error"]:
        assert f"EqualTo(event_type,{kind})" in text


def test_scans_read_only_referenced_columns(spark, sf_dir):
    df = QUERIES["pear_best_submission"](spark, sf_dir)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "event_type" not in schema and "value" in schema and "event_id" in schema


def test_band_lookup_stays_an_equi_join(spark, sf_dir):
    # the band table's size decides how it is joined; the band key keeps it a hash or merge join either way
    plan = plan_of(QUERIES["band_lookup_join"](spark, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
