"""hot_key_join against the plain join, and how even its tasks are."""

from __future__ import annotations

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from kestrel.operators.hot_keys import heavy_hitters, hot_key_join


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture()
def shuffled(spark):
    """Shuffled joins as planned: no broadcast of small sides, no re-planning."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("hot_left,hot_right", [(200, 0), (0, 200), (60, 40), (0, 0)])
def test_rows_equal_the_plain_join(spark, how, hot_left, hot_right):
    rng = random.Random(hot_left + hot_right)
    key = lambda: rng.choice([None, *range(30)])
    lk = [(0, "a")] * hot_left + [(key(), rng.choice(["a", "b", None])) for _ in range(120)]
    rk = [(0, "a")] * hot_right + [(99, "b")] * hot_right + [(key(), rng.choice(["a", "b"])) for _ in range(60)]
    left = spark.createDataFrame([(i % 90, k, t) for i, (k, t) in enumerate(lk)], "lid int, lk int, lt string")
    right = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(rk)], "rid int, rk int, rt string")
    one = hot_key_join(left, right, [("lk", "rk")], how, tasks=8)
    assert one.columns == ["lid", "lk", "lt", "rid", "rk", "rt"]
    assert rows(one) == rows(left.join(right, left.lk == right.rk, how))
    two = hot_key_join(left, right, [("lk", "rk"), ("lt", "rt")], how, tasks=8, sides="both")
    assert rows(two) == rows(left.join(right, (left.lk == right.rk) & (left.lt == right.rt), how))
    nothing = right.where("rid < 0")
    assert rows(hot_key_join(left, nothing, [("lk", "rk")], how)) == rows(left.join(nothing, left.lk == nothing.rk, how))


@pytest.mark.parametrize("how,on_left", [("left", True), ("left", False), ("full", True), ("full", False)])
def test_no_task_has_twice_the_median(shuffled, how, on_left):
    """A third of one side's rows on one number; the other side names each number once."""
    n = 30_000
    big = shuffled.range(n).selectExpr("id AS x", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    small = shuffled.range(n).selectExpr("id AS k2", "id * 7 AS y")
    sides = (big, small, [("k", "k2")]) if on_left else (small, big, [("k2", "k")])
    out = hot_key_join(*sides, how, tasks=8, sides="both")
    sizes = out.rdd.glom().map(len).collect()
    naive = sides[0].join(sides[1], sides[0][sides[2][0][0]] == sides[1][sides[2][0][1]], how)
    assert sum(sizes) == naive.count() and max(sizes) <= 2 * median(sizes)
    assert max(naive.rdd.glom().map(len).collect()) > 2 * median(sizes)  # what it is for


def test_sketch_reports_hot_keys_only(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id END AS k")
    assert heavy_hitters(df, ["k"], 8, 100).first()["fans"] == {"7": 51}  # 501 of 1000 rows
    assert not heavy_hitters(df.where("k < 0"), ["k"], 8, 100).first()["fans"]


def test_a_sample_may_stand_for_a_side(spark):
    left = spark.range(400).selectExpr("id AS lid", "id % 2 AS lk")
    right = spark.range(50).selectExpr("id AS rid", "id % 5 AS rk", "'x' AS note")
    got = hot_key_join(left, right, [("lk", "rk")], "left", left_sample=left.where("lid < 40"), right_sample=right.select("rk").where("rk < 3"), tasks=8)
    assert rows(got) == rows(left.join(right, F.col("lk") == F.col("rk"), "left"))
