"""The 68-column schema, the naming rule and what is reported instead of dropped."""

from __future__ import annotations

import pytest

from kestrel.plans.alignment import TARGET_COLUMNS, UnmappedColumns, align_and_stack_two_years, align_year, mapping_report, target_name
from kestrel.sources.fixtures import ADAPTERS
from kestrel.sources.registry import load_inputs


def columns_of(feed):
    return [c for c, _ in ADAPTERS[feed].branches[0].columns]


def test_feeds_fill_the_target():
    assert len(TARGET_COLUMNS) == len(set(TARGET_COLUMNS)) == 68
    old, new = columns_of("state_results_2425_full"), columns_of("state_results_2526_full")
    assert len(old) == 68 and len(new) == 47
    assert mapping_report(old)[1:] == ([], [])
    used, unmapped, absent = mapping_report(new)
    assert len(used) == 47 and not unmapped
    assert all(c.startswith(("elpac__", "cast__", "math__", "ela__")) for c in absent) and len(absent) == 21


def test_naming_rule():
    assert target_name("Math: Problem Solving and Modeling & Data Analysis") == "math__problem_solving_and_modeling___data_analysis"
    assert target_name("ScaleScoreAchievementLevel") == "scalescoreachievementlevel"


def test_columns_without_a_place_are_reported(spark):
    df = spark.createDataFrame([(1, "x", "2", "n/a", 5)], "StudentIdentifier int, Campus string, `Scale Score` string, `ELA: Reading` string, scalescore int")
    with pytest.raises(UnmappedColumns, match="Campus.*Scale Score"):
        align_year(df)
    row = align_year(df, mapping={"Scale Score": "error_band_min"}, drop=["Campus"]).first()
    assert (row.studentidentifier, row.error_band_min, row.scalescore, row.ela__reading, row.asian) == (1, "2", "5", None, None)
    twice = spark.createDataFrame([(1, 2)], "`File Name` int, file_name int")
    assert mapping_report(twice.columns)[1] == ["File Name", "file_name"]


def test_stack_has_every_row_of_both_years(spark, sf_dir):
    inputs = load_inputs(spark, sf_dir, ["state_results_2425_full", "state_results_2526_full"])
    out = align_and_stack_two_years(inputs)
    assert out.columns == TARGET_COLUMNS
    assert out.count() == sum(df.count() for df in inputs.values())


def test_no_stage_runs_in_a_method_that_the_jvm_leaves_interpreted(spark, sf_dir):
    from kestrel.plans.catalog import runner
    from kestrel.session import configure

    configure(spark)
    plan = runner("align_and_stack_two_years")(spark, sf_dir)._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    used = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))  # a larger stage is generated projection by projection
    assert sizes and max(sizes) > 8000 and not [n for n in sizes if 8000 < n <= used]
