"""Totals and margins that must hold whatever the data."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfare.operators import aggregates, joins, spatial
from wayfare.plans import matrix, network, popsyn, survey
from wayfare.session import FitError


def margins(df, key):
    return {r[key]: r["s"] for r in df.groupBy(key).agg(F.sum("trips").alias("s")).collect()}


@pytest.fixture(scope="module")
def ends(spark):
    rows = spark.createDataFrame([(i, 10.0 + 3 * i) for i in range(6)], "o int, target double")
    total = sum(10.0 + 3 * i for i in range(6))
    cols = spark.createDataFrame([(i, total / 6) for i in range(6)], "d int, target double")
    return rows, cols


def test_gravity_meets_both_margins(spark, ends):
    rows, cols = ends
    skim = spark.createDataFrame([(o, d, 1.0 + abs(o - d)) for o in range(6) for d in range(6)], "o int, d int, imp double")
    out = matrix.mat_gravity(skim, rows, cols, 0.3, tol=1e-6)
    assert margins(out, "o") == pytest.approx({i: 10.0 + 3 * i for i in range(6)}, rel=1e-4)
    assert margins(out, "d") == pytest.approx({i: 17.5 for i in range(6)}, rel=1e-4)


def test_growth_factor_with_empty_margin(spark):
    seed = spark.createDataFrame([(0, 0, 5.0), (0, 1, 5.0), (1, 0, 4.0), (1, 1, 1.0)], "o int, d int, trips double")
    rows = spark.createDataFrame([(0, 0.0), (1, 8.0)], "o int, target double")
    cols = spark.createDataFrame([(0, 6.0), (1, 2.0)], "d int, target double")
    out = matrix.mat_growth_factor(seed, rows, cols, tol=1e-8)
    assert margins(out, "o") == pytest.approx({0: 0.0, 1: 8.0}, abs=1e-6)
    assert margins(out, "d") == pytest.approx({0: 6.0, 1: 2.0}, abs=1e-4)


def test_raking_meets_three_controls(spark):
    rng = random.Random(2)
    hh = spark.createDataFrame([(i, rng.randrange(3), rng.randrange(2), rng.randrange(2), 1 + rng.randrange(3)) for i in range(400)], "id int, size int, inc int, car int, w int")
    goals = spark.createDataFrame([(i, rng.randrange(3), rng.randrange(2), rng.randrange(2)) for i in range(900)], "id int, size int, inc int, car int")
    controls = [([k], goals.groupBy(k).agg(F.count("*").alias("target"))) for k in ("size", "inc", "car")]
    out = popsyn.pop_raking(hh, "w", controls, tol=1e-6)
    for k in ("size", "inc", "car"):
        got = {r[k]: r["s"] for r in out.groupBy(k).agg(F.sum("w").alias("s")).collect()}
        want = {r[k]: r["target"] for r in dict((ks[0], t) for ks, t in controls)[k].collect()}
        assert got == pytest.approx(want, rel=1e-4)


def test_expansion_counts_and_links(spark):
    hh = spark.createDataFrame([(1, 2), (2, 0), (3, 3)], "hhno int, w int")
    per = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "hhno int, pno int")
    homes, people = popsyn.pop_expand(hh, per, "hhno", "w", "pno")
    assert sorted(r["hhid"] for r in homes.collect()) == [1, 2, 3, 4, 5]
    got = sorted((r["perid"], r["hhid"], r["hhno"], r["pno"]) for r in people.collect())
    assert got == [(1, 1, 1, 1), (2, 1, 1, 2), (3, 2, 1, 1), (4, 2, 1, 2), (5, 3, 3, 1), (6, 4, 3, 1), (7, 5, 3, 1)]


def test_transposed_average_keeps_the_total(spark):
    od = spark.createDataFrame([(1, 2, 6.0), (2, 1, 2.0), (1, 1, 5.0)], "o int, d int, trips double")
    out = {(r["o"], r["d"]): r["trips"] for r in matrix.mat_pa_to_od(od).collect()}
    assert out == {(1, 2): 4.0, (2, 1): 4.0, (1, 1): 5.0}


def test_logit_shares_add_to_one(spark):
    util = spark.createDataFrame([(i, m, -0.1 * m * i) for i in range(5) for m in range(4)], "i int, m int, u double")
    out = matrix.mat_logit_shares(util, ["i"], "m", "u", {0: "car", 1: "car"}, 0.5)
    assert all(abs(r["s"] - 1) < 1e-12 for r in out.groupBy("i").agg(F.sum("share").alias("s")).collect())


def test_closed_form_equals_the_iteration(spark):
    rng = random.Random(9)
    o = [rng.uniform(10, 90) for _ in range(6)]
    s = [rng.uniform(1, 9) for _ in range(6)]
    obs = spark.createDataFrame(list(enumerate(o)), "k int, observed double")
    sam = spark.createDataFrame(list(enumerate(s)), "k int, sample double")
    got = {r["k"]: r["expanded"] for r in survey.sur_expand_closed_form(obs, sam, "k").collect()}
    x = list(s)
    for _ in range(3000):
        for i in range(6):
            x[i] += max(0.0, (x[i] * sum(o) - o[i] * sum(x)) / (o[i] - sum(o)))
    assert [got[i] for i in range(6)] == pytest.approx(x, rel=1e-6)


def test_sector_rollup_conserves_jobs(spark):
    jobs = spark.createDataFrame([("470650112040001", 3, 4, 5), ("470650112041002", 1, 0, 2)], "w_geocode string, cns05 int, cns16 int, cns18 int")
    row = survey.emp_sector_rollup(jobs).first()
    assert (row["tract_id"], row["emptot_p"], row["conserved"], row["empmed_p"], row["pro"]) == ("47065011204", 15, True, 4, 4)


def test_link_pairs_equal_brute_force_with_a_hub(spark):
    rng = random.Random(4)
    edges = [(i, 0 if i % 3 == 0 else rng.randrange(8), rng.randrange(8), rng.randrange(3)) for i in range(60)]
    edges = [(i, a, b if a != b else (b + 1) % 8, c) for i, a, b, c in edges]
    df = spark.createDataFrame(edges, "id int, from_id int, to_id int, cls int")
    got = {(r["node"], r["in_cls"], r["out_cls"]): r["n_pairs"] for r in joins.join_in_out_links(df, ["cls"]).collect()}
    want: dict = {}
    for _, a, b, c in edges:
        for _, a2, b2, c2 in edges:
            if b == a2 and a != b2:
                want[(b, c, c2)] = want.get((b, c, c2), 0) + 1
    assert got == want


def test_node_balance_sums(spark):
    df = spark.createDataFrame([(1, 2, 10), (3, 2, 5), (2, 4, 30), (4, 1, 0)], "from_id int, to_id int, v int")
    out = {r["node"]: (r["inflow"], r["outflow"], r["change"]) for r in network.net_node_balance(df, "v").collect()}
    assert out == {1: (0, 10, 0.0), 2: (15, 30, 100.0), 3: (0, 5, 0.0), 4: (30, 0, -100.0)}


def points(n, seed, spread=1.0):
    rng = random.Random(seed)
    # A third of all points lies in one small cluster.
    return [(i, *((0.5 + rng.random() * 0.01, 0.5 + rng.random() * 0.01) if i % 3 == 0 else (rng.random() * spread, rng.random() * spread))) for i in range(n)]


def test_nearest_equals_brute_force(spark):
    ps, ss = points(200, 1, 3.0), points(40, 2)
    out = spatial.join_nearest(spark.createDataFrame(ps, "id int, x double, y double"), spark.createDataFrame(ss, "site int, x double, y double"), "id", "site")
    got = {r["id"]: (r["site"], r["dist"]) for r in out.collect()}
    assert len(got) == 200
    for i, x, y in ps:
        d, s = min((math.dist((x, y), (a, b)), k) for k, a, b in ss)
        assert got[i][0] == s and got[i][1] == pytest.approx(d)


def test_buffers_equal_brute_force(spark):
    zs, ps = points(30, 3), points(300, 4)
    out = spatial.join_buffer_aggregate(
        spark.createDataFrame(zs, "z int, x double, y double"), spark.createDataFrame(ps, "id int, x double, y double"), "z", 0.17, {"n": F.lit(1), "ids": F.col("id")}
    )
    got = {r["z"]: (r["n"], r["ids"]) for r in out.collect()}
    for z, x, y in zs:
        near = [i for i, a, b in ps if math.dist((x, y), (a, b)) <= 0.17]
        assert got[z] == (len(near), sum(near))


def test_shared_border_belongs_to_one_polygon(spark):
    rings = [(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]), (2, [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)])]
    polys = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in rings], "pid int, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.5, 0.5), (3, 1.5, 0.0), (4, 5.0, 5.0)], "id int, x double, y double")
    out = spatial.join_point_in_polygon(pts, polys, "x", "y", "pid", "ring", 0.3, how="left")
    assert sorted((r["id"], r["pid"]) for r in out.collect()) == [(1, 2), (2, 1), (3, 2), (4, None)]


def test_points_may_be_equal_and_hold_nulls(spark):
    square = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 0.0, "y": 1.0}]
    polys = spark.createDataFrame([(1, square)], "pid int, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5, None), (1, 0.5, 0.5, None), (2, 0.2, 0.2, "a"), (2, 0.2, 0.2, "a"), (3, 9.0, 9.0, None)], "id int, x double, y double, tag string")
    out = spatial.join_point_in_polygon(pts, polys, "x", "y", "pid", "ring", 0.3, how="left")
    assert sorted((r["id"], r["pid"] or 0) for r in out.collect()) == [(1, 1), (1, 1), (2, 1), (2, 1), (3, 0)]


def test_raking_keeps_records_without_a_target(spark):
    hh = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, None, 1.0), (4, "c", 1.0)], "id int, seg string, w double")
    goal = spark.createDataFrame([("a", 8), ("b", 5)], "seg string, target int")
    out = {r["id"]: r["w"] for r in popsyn.pop_raking(hh, "w", [(["seg"], goal)]).collect()}
    assert out == {1: 2.0, 2: 6.0, 3: 0.0, 4: 0.0}


def test_fits_that_do_not_end_are_errors(spark):
    hh = spark.createDataFrame([(1, 0, 0, 1.0), (2, 1, 1, 1.0)], "id int, a int, b int, w double")
    a = spark.createDataFrame([(0, 10), (1, 10)], "a int, target int")
    b = spark.createDataFrame([(0, 5), (1, 15)], "b int, target int")
    with pytest.raises(FitError):
        popsyn.pop_raking(hh, "w", [(["a"], a), (["b"], b)], max_iter=4)
    seed = spark.createDataFrame([(0, 0, 1.0), (1, 1, 1.0)], "o int, d int, trips double")
    rows = spark.createDataFrame([(0, 10.0), (1, 10.0)], "o int, target double")
    cols = spark.createDataFrame([(0, 5.0), (1, 15.0)], "d int, target double")
    full = spark.createDataFrame([(0, 0, 1.0), (0, 1, 5.0), (1, 0, 9.0), (1, 1, 1.0)], "o int, d int, trips double")
    with pytest.raises(FitError):
        matrix.mat_growth_factor(full, rows, cols, max_iter=2, tol=1e-12)
    assert matrix.mat_growth_factor(full, rows, cols, tol=1e-9).count() == 4 and seed.count() == 2


def test_fits_by_key_meet_their_own_margins(spark):
    seed = spark.createDataFrame([(k, o, d, 1.0 + k * o + d) for k in (1, 2) for o in range(3) for d in range(3)], "k int, o int, d int, trips double")
    rows = spark.createDataFrame([(k, o, 10.0 * k + o) for k in (1, 2) for o in range(3)], "k int, o int, target double")
    cols = spark.createDataFrame([(k, d, 10.0 * k + 1) for k in (1, 2) for d in range(3)], "k int, d int, target double")
    out = matrix.mat_growth_factor(seed, rows, cols, tol=1e-10, keys=["k"])
    got = {(r["k"], r["o"]): r["s"] for r in out.groupBy("k", "o").agg(F.sum("trips").alias("s")).collect()}
    assert got == pytest.approx({(k, o): 10.0 * k + o for k in (1, 2) for o in range(3)}, rel=1e-6)


def test_districts_keep_the_trips_of_unmapped_zones(spark):
    od = spark.createDataFrame([(1, 1, 2.0), (1, 9, 3.0), (9, 9, 4.0)], "o int, d int, trips double")
    zones = spark.createDataFrame([(1, 7)], "taz int, district int")
    out = {(r["o_district"], r["d_district"]): r["trips"] for r in aggregates.agg_matrix_district(od, zones, "taz", "district").collect()}
    assert out == {(7, 7): 2.0, (7, None): 3.0, (None, None): 4.0}


def test_sector_rollup_skips_nulls(spark):
    jobs = spark.createDataFrame([("470650112040001", 3, None, 5), ("470650112040002", None, 4, 2)], "w_geocode string, cns05 int, cns07 int, cns18 int")
    row = survey.emp_sector_rollup(jobs).first()
    assert (row["emptot_p"], row["all_jobs"], row["conserved"], row["empret_p"]) == (14, 14, True, 4)


def test_dasymetric_keeps_the_total_of_a_zone_without_buildings(spark):
    square = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 0.0, "y": 1.0}]
    polys = spark.createDataFrame([(1, square)], "pid int, ring array<struct<x:double,y:double>>")
    homes = spark.createDataFrame(points(20, 6), "id int, x double, y double")
    stops = spark.createDataFrame([(1, 0.5, 0.5)], "site int, x double, y double")
    totals = spark.createDataFrame([(1, 100), (2, 55)], "pid int, total int")
    out = spatial.spa_dasymetric(homes, polys, stops, totals, "id", 0.25)
    assert {r["pid"]: r["u"] for r in out.groupBy("pid").agg(F.sum("units").alias("u")).collect()} == {1: 100, 2: 55}
    assert [r["id"] for r in out.filter("pid = 2").collect()] == [None]


def test_dasymetric_keeps_zone_totals(spark):
    square = [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 0.0, "y": 1.0}]
    polys = spark.createDataFrame([(1, square)], "pid int, ring array<struct<x:double,y:double>>")
    homes = spark.createDataFrame(points(50, 6), "id int, x double, y double")
    stops = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.1, 0.9)], "site int, x double, y double")
    totals = spark.createDataFrame([(1, 1234)], "pid int, total int")
    out = spatial.spa_dasymetric(homes, polys, stops, totals, "id", 0.25)
    assert out.agg(F.sum("units")).first()[0] == 1234


def capped_plain(cells, rows, cols, cap, rounds=4000):
    """Weights by cell: each margin in turn solved by bisection of its factor."""
    f, g = {a: 1.0 for a in rows}, {b: 1.0 for b in cols}
    def weight(a, b):
        return cells[a, b] * min(cap, f[a] * g[b])
    for _ in range(rounds):
        for own, targets, at in ((f, rows, 0), (g, cols, 1)):
            for k, target in targets.items():
                low, high = 0.0, 1e6
                for _ in range(60):
                    own[k] = (low + high) / 2
                    short = sum(weight(*c) for c in cells if c[at] == k) < target
                    low, high = (own[k], high) if short else (low, own[k])
    return {c: weight(*c) for c in cells}


def test_bounded_raking_against_bisection(spark):
    rng = random.Random(5)
    cells = {(a, b): float(1 + rng.randrange(9)) for a in range(3) for b in range(4)}
    cap = 1.5
    known = {(a, b): w * min(cap, (0.6 + 0.5 * a) * (0.7 + 0.25 * b)) for (a, b), w in cells.items()}
    rows = {a: sum(w for c, w in known.items() if c[0] == a) for a in range(3)}
    cols = {b: sum(w for c, w in known.items() if c[1] == b) for b in range(4)}
    records = [(i, a, b, w / 2) for i, ((a, b), w) in enumerate([*cells.items(), *cells.items()])]
    seed = spark.createDataFrame([*records, (90, None, 1, 1.0), (91, 7, 1, 1.0)], "id int, a int, b int, w double")
    controls = [([k], spark.createDataFrame(list(t.items()), f"{k} int, target double")) for k, t in (("a", rows), ("b", cols))]
    out = {(r["a"], r["b"]): r["w"] for r in popsyn.pop_raking_bounded(seed, "w", controls, cap, tol=1e-9).collect()}
    plain = capped_plain(cells, rows, cols, cap, 60)
    assert sum(abs(2 * out[c] - cap * cells[c]) < 1e-6 for c in cells) >= 3  # the cap binds
    for c in cells:
        assert 2 * out[c] == pytest.approx(plain[c], rel=1e-4) and 2 * out[c] == pytest.approx(known[c], rel=1e-5)
    assert out[None, 1] == 0.0 and out[7, 1] == 0.0
    wide = {r["id"]: r["w"] for r in popsyn.pop_raking_bounded(seed, "w", controls, 1e9, tol=1e-9).collect()}
    free = {r["id"]: r["w"] for r in popsyn.pop_raking(seed, "w", controls, tol=1e-9).collect()}
    assert wide == pytest.approx(free, rel=1e-6)


def test_targets_beyond_the_cap_are_listed(spark):
    seed = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "b", 2.0), (4, "b", 0.0)], "id int, seg string, w double")
    goal = spark.createDataFrame([("a", 100.0), ("b", 3.0), ("c", 5.0), ("d", None)], "seg string, target double")
    out = popsyn.pop_raking_bounded(seed, "w", [(["seg"], goal)], 4.0)
    assert {r["id"]: r["w"] for r in out.collect()} == {1: 4.0, 2: 12.0, 3: 3.0, 4: 0.0}
    gaps = {r["category"]: (r["reached"], r["gap"]) for r in popsyn.pop_control_gaps(out, "w", [(["seg"], goal)]).collect()}
    assert gaps == {"a": (16.0, 84.0), "b": (3.0, 0.0), "c": (0.0, 5.0), "d": (0.0, None)}
    assert popsyn.pop_raking_bounded(seed.limit(0), "w", [(["seg"], goal)], 4.0).count() == 0
