"""Layer 2a: each rewritten operator against its naive (original-SQL) form on small literal frames."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from kestrel.operators import (
    align_to, anti_any_key, band_join, conditional_key_join, keep_best, stack_tagged, subgroup_counts, union_distinct,
)
from kestrel.operators.checks import accepted_range, accepted_values, duplicate_keys, not_null, summarize
from kestrel.operators.dedupe import all_columns_tiebreak


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def _rand_keys(rng, n, hi, null_rate=0.2):
    return [None if rng.random() < null_rate else rng.randint(0, hi) for _ in range(n)]


def test_anti_any_key_matches_or_join(spark):
    rng = random.Random(7)
    left = spark.createDataFrame(list(zip(range(300), _rand_keys(rng, 300, 60), _rand_keys(rng, 300, 60))),
                                 "id int, k1 int, k2 int")
    right = spark.createDataFrame(list(zip(_rand_keys(rng, 80, 60), _rand_keys(rng, 80, 60))), "r1 int, r2 int")
    got = anti_any_key(left, right, [("k1", "r1"), ("k2", "r2")])
    # the original form: anti join on the OR condition (rows with no partner on either key)
    naive = left.join(right, (left.k1 == right.r1) | (left.k2 == right.r2), "left_anti")
    assert rows(got.select("id", "k1", "k2")) == rows(naive)
    # all-null key rows always survive
    assert got.where(F.col("k1").isNull() & F.col("k2").isNull()).count() == left.where("k1 is null and k2 is null").count()


def test_anti_any_key_plan_has_no_nested_loop(spark):
    left = spark.range(100).selectExpr("id", "id % 7 AS k1", "id % 11 AS k2")
    right = spark.range(10).selectExpr("id AS r1", "id * 2 AS r2")
    plan = anti_any_key(left, right, [("k1", "r1"), ("k2", "r2")])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_conditional_key_join_matches_naive(spark):
    rng = random.Random(11)
    exc = [5, 6]
    n = 400
    left = spark.createDataFrame(
        list(zip(range(n), [None if rng.random() < 0.1 else rng.choice([5, 6, 7, 8, 9, 10]) for _ in range(n)],
                 [rng.choice([0, 0, 1, 2, 3, None]) for _ in range(n)], [rng.choice(["a", "b"]) for _ in range(n)])),
        "lid int, sid bigint, num bigint, trk string")
    right = spark.createDataFrame(
        list(zip(range(60), [None if rng.random() < 0.1 else rng.choice([5, 6, 7, 8, 9]) for _ in range(60)],
                 [rng.choice([0, 1, 2, 3, None]) for _ in range(60)], [rng.choice(["a", "b"]) for _ in range(60)])),
        "rid int, psid bigint, pnum bigint, ptrk string")
    got = conditional_key_join(left, right, left_id="sid", left_number="num", right_id="psid", right_number="pnum",
                               exception_ids=exc, also_on=[("trk", "ptrk")])
    cond = (left.trk == right.ptrk) & (
        (left.sid.isin(exc) & right.psid.isin(exc) & (left.sid == right.psid))
        | (~left.sid.isin(exc) & (left.num == right.pnum))
    )
    naive = left.join(right, cond, "left")
    assert rows(got.select("lid", "rid")) == rows(naive.select("lid", "rid"))


def test_band_join_left_keeps_rows(spark):
    bands = spark.createDataFrame([("K", "2L", 10, 19), ("K", "2H", 20, 29), ("1", "2L", 15, 24)],
                                  "grade_band string, level_code string, min_score long, max_score long")
    left = spark.createDataFrame([(1, "K", 12.0), (2, "K", 19.5), (3, "1", 15.0), (4, None, 12.0), (5, "K", 29.0)],
                                 "id int, band string, score double")
    got = band_join(left, bands, left_band=F.col("band"), left_value=F.col("score"), band_key="grade_band",
                    low="min_score", high="max_score", prefix="c_")
    assert sorted((r.id, r.c_level_code) for r in got.collect()) == [(1, "2L"), (2, None), (3, "2L"), (4, None), (5, "2H")]
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_keep_best_order_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "f1"), (1, "a", 3, "f1"), (1, "a", 3, "f2"), (None, "a", 1, "f1"), (None, "a", 2, "f1"),
         (2, "b", None, "f9")],
        "k int, g string, d int, f string")
    got = keep_best(df, ["k", "g"], [F.col("d").desc_nulls_last(), F.col("f").desc()], all_columns_tiebreak(df))
    assert sorted(got.collect(), key=lambda r: (r.k is None, r.k)) == [
        (1, "a", 3, "f2"), (2, "b", None, "f9"), (None, "a", 2, "f1")]
    ranked = keep_best(df, ["k"], [F.col("d").desc_nulls_last()], rank_column="rn")
    assert set(r.rn for r in ranked.collect()) == {1}


def test_keep_best_plans_group_limit(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    plan = keep_best(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_subgroup_counts_equals_group_bys(spark):
    rng = random.Random(3)
    data = [(rng.choice(["s1", "s2"]), rng.choice(["A", "B", None]), rng.choice(["EL", None]), rng.choice([1, 2]))
            for _ in range(200)]
    df = spark.createDataFrame(data, "school string, race string, ela string, lvl int")
    got = subgroup_counts(df, ["school"], ["race", "ela", "lvl"])
    parts = [df.groupBy("school", F.col(s).cast("string").alias("demographic")).agg(F.count("*").alias("student_count"))
             .select("school", F.lit(s).alias("subgroup"), "demographic", "student_count") for s in ["race", "ela", "lvl"]]
    naive = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(got.select("school", "subgroup", "demographic", "student_count")) == rows(naive)


def test_align_to_and_stack(spark):
    a = spark.createDataFrame([(1, "x")], "ID int, name string")
    aligned = align_to(a, [("id", "bigint"), ("name", "string"), ("extra", "double")])
    assert aligned.dtypes == [("id", "bigint"), ("name", "string"), ("extra", "double")]
    assert aligned.collect()[0] == (1, "x", None)
    s = stack_tagged({"24-25": a, "25-26": a})
    assert sorted(r.year for r in s.collect()) == ["24-25", "25-26"]
    assert union_distinct([a, a]).count() == 1


def test_checks_contract(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 150), (None, "b", None), (2, None, 7)], "k int, v string, s int")
    assert not_null("k").name == "not_null:k"
    out = {r["check"]: r.failing_rows for r in summarize(
        df, [not_null("k"), accepted_values("v", ["a"]), accepted_range("s", 0, 100)], unique=[["k", "v"]]).collect()}
    # NULL passes accepted_values and accepted_range; the duplicate key (1, a) has 2 rows
    assert out == {"not_null:k": 1, "accepted_values:v": 1, "accepted_range:s": 1, "unique_combination:k+v": 2}
    assert duplicate_keys(df, ["k"]).collect()[0].row_count == 2


def test_equi_join_salting_matches_plain_join(spark):
    from kestrel.operators.joins import equi_join

    rng = random.Random(5)
    left = spark.createDataFrame(list(zip(range(500), _rand_keys(rng, 500, 30, 0.4), [rng.choice("ab") for _ in range(500)])),
                                 "lid int, lk int, lt string")
    right = spark.createDataFrame(list(zip(range(90), _rand_keys(rng, 90, 30, 0.4), [rng.choice("ab") for _ in range(90)])),
                                  "rid int, rk int, rt string")
    for how in ["inner", "left", "full", "left_anti", "left_semi"]:
        got = equi_join(left, right, [("lk", "rk"), ("lt", "rt")], how)
        plain = left.join(right, (left.lk == right.rk) & (left.lt == right.rt), how)
        assert sorted(got.columns) == sorted(plain.columns), how
        assert rows(got.select(plain.columns)) == rows(plain), how


def test_null_key_rows_spread_over_partitions(spark):
    from kestrel.operators.joins import equi_join

    left = spark.range(4000).selectExpr("id", "CASE WHEN id >= 0 THEN NULL ELSE id END AS k")  # NULL, not foldable
    right = spark.range(10).selectExpr("id AS rid", "id AS rk")
    # a shuffled join (no broadcast, no AQE re-planning), so partition sizes show the key distribution
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = equi_join(left, right, [("k", "rk")], "left")
        assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
        sizes = j.rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 4  # spread, not all in one partition


def test_scale_conf_sizes_partitions():
    from kestrel.session import scale_conf

    conf = scale_conf(100 * (1 << 40), executor_cores_total=8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 100 * (1 << 40) / parts <= 256 << 20
    assert int(scale_conf(1 << 30, executor_cores_total=8)["spark.sql.shuffle.partitions"]) == 16


def test_equi_join_equals_plain_join_with_hot_keys(spark):
    from kestrel.operators.joins import equi_join

    rng = random.Random(9)
    # right: key 0 is hot and absent on the left; key 1 is hot and present; NULLs on both sides
    rk = [0] * 300 + [1] * 200 + [rng.randint(2, 40) for _ in range(150)] + [None] * 40
    right = spark.createDataFrame([(i, k, rng.randint(0, 5)) for i, k in enumerate(rk)], "rid int, rk int, rv int")
    lk = [1, 1, 2, 3, None, None, 41, 7, 1] + [rng.randint(1, 45) for _ in range(80)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(lk)], "lid int, lk int")
    for how in ["left", "inner"]:
        got = equi_join(left, right, [("lk", "rk")], how)
        plain = left.join(right, left.lk == right.rk, how)
        assert sorted(got.columns) == sorted(plain.columns)
        assert rows(got.select(plain.columns)) == rows(plain), how


def test_band_join_of_many_overlapping_bands_equals_the_naive_join(spark):
    rng = random.Random(13)
    span = lambda: (lambda a: (a, a + rng.choice([0, 1, 3, 50, 4000])))(rng.randint(-5000, 5000))
    bands = [(rng.choice(["K", "1"]), f"c{i}", *span()) for i in range(300)] + [("K", "none", None, 5), ("K", "turned", 9, 3)]
    bands = spark.createDataFrame(bands, "k string, code string, lo long, hi long")
    rows_ = [(i, rng.choice(["K", "1", "2", None]), rng.choice([None, float("nan"), float(rng.randint(-5200, 5200)), rng.uniform(-6, 6)])) for i in range(500)]
    left = spark.createDataFrame(rows_, "id int, band string, v double")
    naive = left.join(bands, (left.band == bands.k) & left.v.between(bands.lo, bands.hi), "left").select("id", "code")
    for cell in (None, 7.5):
        got = band_join(left, bands, left_band=F.col("band"), left_value=F.col("v"), band_key="k", low="lo", high="hi", prefix="b_", cell=cell)
        assert got.columns == ["id", "band", "v", "b_k", "b_code", "b_lo", "b_hi"]
        assert rows(got.select("id", "b_code")) == rows(naive)


def test_band_join_of_a_large_band_table_is_a_merge_of_cells(spark):
    bands = spark.range(300_000).selectExpr("'K' AS k", "id AS code", "id * 10 AS lo", "id * 10 + 9 AS hi")
    left = spark.range(100_000).selectExpr("id", "'K' AS band", "cast(id * 31 AS double) AS v")
    got = band_join(left, bands, left_band=F.col("band"), left_value=F.col("v"), band_key="k", low="lo", high="hi", prefix="b_")
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("b_code = floor(v / 10) OR (b_code IS NULL AND v >= 3000000)").count() == 100_000


def test_enrollment_plans_two_scans(spark, sf_dir):
    from kestrel.plans.enrollment import enrollment_demographics
    from kestrel.sources.registry import load_inputs

    inputs = load_inputs(spark, sf_dir, ["roster", "budget"])
    one_year = {"roster": spark.createDataFrame(inputs["roster"].limit(300).collect(), inputs["roster"].schema).repartition(2), "budget": inputs["budget"]}
    plan = enrollment_demographics(one_year, ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 2  # the roster once, the budget once


def test_keep_best_of_latest_sorts_only_rows_that_tie_on_it(spark):
    from kestrel.operators.dedupe import keep_best_of_latest

    rows = [(None if i % 11 == 0 else i % 7, "a" if i % 3 else None, None if i % 5 == 0 else i % 4, f"f{i % 6}", i) for i in range(300)]
    rows += [(99, "only", None, "f1", 1000), (99, "only", None, "f2", 1001)]
    df = spark.createDataFrame(rows, "k1 long, k2 string, day int, file string, v long").repartition(5)
    order, tie = [F.col("file").desc_nulls_last()], [F.col("v").asc_nulls_first()]
    out = keep_best_of_latest(df, ["k1", "k2"], F.col("day"), order, tie)
    best = {}
    for r in rows:  # by day and file descending, NULL last, then v ascending
        place = (r[2] is not None, r[2] or 0, r[3], -r[4])
        if r[:2] not in best or place > best[r[:2]][0]:
            best[r[:2]] = (place, r)
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(str(r) for _, r in best.values())
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_coalesced_partitions_are_bounded_unless_the_session_asks_for_more(spark):
    from kestrel.session import COALESCED_BYTES, configure, scale_conf

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    assert configure(other).conf.get(key) == str(COALESCED_BYTES)  # Spark's default is 64 MB
    for asked, kept in (("64m", str(COALESCED_BYTES)), ("33554432", str(COALESCED_BYTES)), ("65536kb", str(COALESCED_BYTES)), ("8m", "8m"), ("16MB", "16MB"),
                        ("1048576b", "1048576b"), (scale_conf(1 << 40)[key], str(256 << 20)), ("1g", "1g")):
        other.conf.set(key, asked)
        assert configure(other).conf.get(key) == kept
