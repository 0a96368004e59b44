"""Ordered operators against brute force, with one group holding a third of the rows."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wayfare.operators import joins, sets, windows


def skewed_rows(n=900, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = 0 if i % 3 == 0 else rng.randrange(1, 40)
        # The first order key is tied for most rows of the large group.
        first = 5 if group == 0 and rng.random() < 0.8 else rng.randrange(100)
        rows.append((group, first, i, rng.randrange(-4, 9)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("order", [["k1", "id"], ["-k1", "id"], ["id"]])
def test_running_equals_brute_force(spark, order):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "g int, k1 int, id int, v int")
    out = windows.running(df, ["g"], order, {"seq": F.lit(1).cast("bigint"), "total": F.col("v")})
    got = {r["id"]: (r["seq"], r["total"]) for r in out.collect()}
    groups = defaultdict(list)
    for g, k1, i, v in rows:
        key = {"k1": (k1, i), "-k1": (-k1, i), "id": (i,)}[order[0]]
        groups[g].append((key, i, v))
    want = {}
    for members in groups.values():
        total = 0
        for n, (_, i, v) in enumerate(sorted(members), 1):
            total += v
            want[i] = (n, total)
    assert got == want


def test_null_groups_keys_and_values(spark):
    rows = [(None, None, 1, 5), (None, 3, 2, None), (1, None, 3, None), (1, 2, 4, 2), (1, 9, 5, 1)]
    df = spark.createDataFrame(rows, "g int, k int, id int, v int").repartition(3)
    out = windows.running(df, ["g"], ["k", "id"], {"total": F.col("v")})
    assert {r["id"]: r["total"] for r in out.collect()} == {1: 5, 2: 5, 3: None, 4: 2, 5: 3}
    assert windows.win_surrogate_id(df.filter("id > 9"), ["id"], "n").count() == 0


def test_text_keys(spark):
    df = spark.createDataFrame([(w,) for w in ("pear", "apple", "fig")], "w string")
    assert {r["w"]: r["n"] for r in windows.win_surrogate_id(df, ["w"], "n").collect()} == {"apple": 1, "fig": 2, "pear": 3}


def spread_cases():
    rng = random.Random(11)
    outlier = [(0, k) for k in range(8000)] + [(0, 10**15)]
    distant = [(0, k) for k in range(4000)] + [(1, 10**12 + k) for k in range(4000)]
    third = [(0 if i % 3 == 0 else rng.randrange(1, 500), i) for i in range(8000)]
    return {"outlier": outlier, "distant": distant, "third": third}


@pytest.mark.parametrize("case", ["outlier", "distant", "third"])
def test_no_range_holds_twice_the_mean(spark, case):
    rows = spread_cases()[case]
    df = spark.createDataFrame(rows, "g int, k long").repartition(8)
    # Small partitions are otherwise put together here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in windows.ranged(df, ["g"], ["k"]).groupBy("__range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 2 * len(rows) / len(sizes)
    got = {(r["g"], r["k"]): r["n"] for r in windows.win_group_seq(df, ["g"], ["k"], "n").collect()}
    seen: dict = defaultdict(int)
    for g, k in sorted(rows):
        seen[g] += 1
        assert got[(g, k)] == seen[g]


def test_surrogate_ids_are_dense_and_ordered(spark):
    keys = random.Random(1).sample(range(10**9), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    out = windows.win_surrogate_id(df, ["k"], "id", start=7).orderBy("k").collect()
    assert [r["id"] for r in out] == list(range(7, 507))


def test_global_running_needs_no_global_sort_of_the_rows(spark):
    plan = windows.win_surrogate_id(spark.range(1000), ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    # The only single-partition window runs on the totals of the ranges.
    assert plan.count("SinglePartition") == 1 and "hashpartitioning(__range" in plan


def test_largest_remainder_keeps_group_totals(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.random() * 4) for i in range(300) for g in [0 if i % 3 else i % 17]]
    df = spark.createDataFrame(rows, "g int, id int, x double")
    out = windows.win_largest_remainder(df, ["g"], "x", ["id"])
    for r in out.groupBy("g").agg(F.sum("x").alias("x"), F.sum("rounded").alias("n")).collect():
        assert r["n"] == round(r["x"])
    assert out.filter("abs(rounded - x) >= 1").count() == 0


def test_argmax_dedup_ranks_nulls_last(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, 5), (2, 4, None)], "k int, id int, c int")
    out = {r["k"]: (r["id"], r["c"]) for r in windows.win_argmax_dedup(df, ["k"], "c", "id").collect()}
    assert out == {1: (2, 5), 2: (4, None)}


def test_complete_grid_is_no_cross_join(spark):
    grid = sets.set_complete_grid(spark, ("x", -1, 2), ("y", 3, 5))
    assert sorted(map(tuple, grid.collect())) == [(x, y) for x in range(-1, 3) for y in range(3, 6)]
    assert "Join" not in grid._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("order", [["k"], ["-k"]])
def test_keys_may_span_the_whole_long_range(spark, order):
    keys = [-(2**63), -5, 0, 7, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    out = {r["k"]: r["n"] for r in windows.win_surrogate_id(df, order, "n").collect()}
    ranked = keys if order == ["k"] else keys[::-1]
    assert out == {k: i + 1 for i, k in enumerate(ranked)}


def test_expansion_in_blocks(spark):
    df = spark.createDataFrame([(1, 25_001), (2, 0), (3, None), (4, 10_000), (5, 1)], "id int, w int")
    out = joins.join_theta_expand(df, "w").groupBy("id").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.count_distinct("n").alias("u"))
    assert sorted(map(tuple, out.collect())) == [(1, 25_001, 1, 25_001, 25_001), (4, 10_000, 1, 10_000, 10_000), (5, 1, 1, 1, 1)]
