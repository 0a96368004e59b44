"""Nearest sites, edit logs, hourly profiles, fits and running measures on small tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from wayfare.functions import scalar
from wayfare.operators import spatial, windows
from wayfare.plans import highway, matrix, network


def brute_nearest(points, sites):
    return {k: min(((px - x) ** 2 + (py - y) ** 2, s) for s, x, y in sites) for k, px, py in points}


def clustered(n, centre, width, seed):
    rng = random.Random(seed)
    return [(i, centre + rng.uniform(0, width), centre + rng.uniform(0, width)) for i in range(n)]


@pytest.mark.parametrize(("centre", "width", "least_x"), [(0.0, 1e-6, 0.0), (5e5, 1e-3, 0.0), (0.0, 1e6, 0.0)])
def test_nearest_opens_few_groups(spark, centre, width, least_x):
    sites = clustered(900, centre, width, 1)
    points = clustered(300, 0.0, 1e6, 2)
    p = spark.createDataFrame(points, "k long, x double, y double")
    s = spark.createDataFrame(sites, "site long, x double, y double")
    pairs = spatial.nearest_candidates(p.select("x", "y"), s, "site")
    assert pairs.count() < 20 * len(points)
    got = {r["k"]: (r["dist"] ** 2, r["site"]) for r in spatial.join_nearest(p, s, "k", "site").collect()}
    want = brute_nearest(points, sites)
    assert all(abs(got[k][0] - d) <= 1e-9 * d for k, (d, _) in want.items())


def test_nearest_ties_copies_and_nulls(spark):
    sites = [(9, 0.0, 0.0), (3, 0.0, 0.0), (4, 2.0, 0.0), (5, None, 1.0), *[(100 + i, 50.0, float(i)) for i in range(40)]]
    points = [(1, 1.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 0.0), (3, None, 0.0), *[(10 + i, 3.0, 0.0) for i in range(50)]]
    p = spark.createDataFrame(points, "k long, x double, y double")
    s = spark.createDataFrame(sites, "site long, x double, y double")
    got = spatial.join_nearest(p, s, "k", "site").collect()
    assert len(got) == len(points)
    assert {(r["k"], r["site"], r["dist"]) for r in got if r["k"] < 10} == {(1, 3, 1.0), (2, 3, 0.0), (3, None, None)}
    assert {(r["site"], r["dist"]) for r in got if r["k"] >= 10} == {(4, 1.0)}
    assert {r["site"] for r in spatial.join_nearest(p, s.filter("site < 0"), "k", "site").collect()} == {None}


def test_profile_with_other_area_groups(spark):
    def profile(groups):
        return spark.createDataFrame([(g, 8, "am", 1.0, 1.0, 1.0) for g in groups], "area_group string, hour int, period string, car double, su double, mu double")

    classes = [1, 7, 12, 17]
    row = {f"{p}_{c}": 100 for p in ("am", "pm", "op") for c in ("car", "su", "mu")}
    links = spark.createDataFrame([(i, c, 1.0, 1.0, 900.0, 0.15, 4.0, *row.values()) for i, c in enumerate(classes)], ["id", "fc", "length", "fftime", "pm_cap", "bpr_a", "bpr_b", *row])
    some = [*[f"z{i}" for i in range(20)], *highway.AREA_GROUPS, *[f"a{i}" for i in range(20)]]
    assert sorted(r["id"] for r in highway.hwy_hourly_profile(links, profile(some)).collect()) == [0, 1, 2, 3]
    with pytest.raises(Exception, match="profile lacks area group uf"):
        highway.hwy_hourly_profile(links, profile(["rf", "ro", "uo"])).collect()


def replayed(rows, edits, base):
    """The log of a key, one edit after the other."""
    here = {k: base(k) for k in rows}
    fields = {k: dict(v) for k, v in rows.items()}
    for _, k, action, field, value in sorted(edits):
        if k not in rows:
            continue
        if action == "Modify":
            if field in fields[k] and (value is None or value.lstrip("-").isdigit()):
                fields[k][field] = None if value is None else int(value)
        elif action in ("Add", "Remove", "Delete"):
            here[k] = action == "Add"
    return {k: fields[k] for k in rows if here[k]}


def test_edit_logs_are_replayed_in_order(spark):
    rng = random.Random(7)
    rows = {k: {"lanes": k % 4, "speed": 30} for k in range(40)}
    actions = ["Add", "Remove", "Delete", "Modify", "Modify", "Other"]
    edits = [(i, rng.randrange(-2, 42), rng.choice(actions), rng.choice(["lanes", "speed", "colour"]), rng.choice(["1", "2", "x", None])) for i in range(400)]
    links = spark.createDataFrame([(k, v["lanes"], v["speed"]) for k, v in rows.items()], "id long, lanes int, speed int")
    log = spark.createDataFrame(edits, "seq long, id long, action string, field_name string, field_value string").repartition(5)
    net, errors = network.net_apply_projects(links, log, F.col("id") % 3 != 0)
    got = {r["id"]: {"lanes": r["lanes"], "speed": r["speed"]} for r in net.collect()}
    assert got == replayed(rows, edits, lambda k: k % 3 != 0)
    why = {r["seq"]: r["error"] for r in errors.collect()}
    for seq, k, action, field, value in edits:
        want = None
        if k not in rows:
            want = "does not exist"
        elif action == "Modify" and field == "colour":
            want = "field does not exist"
        elif action == "Modify" and value == "x":
            want = "value cannot be read"
        elif action == "Other":
            want = "unknown action"
        assert why.get(seq) == want


def test_node_edits_reach_the_links(spark):
    links = spark.createDataFrame([(1, 10, 11, 2), (2, 11, 12, 2), (3, 12, 10, 2), (4, 10, 13, 2)], "id long, from_id long, to_id long, lanes int")
    nodes = spark.createDataFrame([(10, 0), (11, 0), (12, 0), (13, 0)], "node long, control int")
    edits = [
        (1, 11, "Node", "Modify", "control", "5"), (2, 12, "Node", "Remove", None, None), (3, 12, "Node", "Add", None, None),
        (4, 13, "Node", "Add", None, None), (5, 13, "Node", "Delete", None, None), (6, 1, "Link", "Remove", None, None),
        (7, 1, None, "Add", None, None), (8, 1, "Link", "Modify", "lanes", "9"), (9, 99, "Node", "Remove", None, None), (10, 1, "Zone", "Remove", None, None),
    ]
    log = spark.createDataFrame(edits, "seq long, id long, layer string, action string, field_name string, field_value string")
    net, at, errors = network.net_apply_projects(links, log, F.lit(True), nodes=nodes)
    assert {tuple(r) for r in net.select("id", "lanes", "from_control", "to_control").collect()} == {(1, 9, 0, 5), (2, 2, 5, 0), (3, 2, 0, 0)}
    assert {tuple(r) for r in at.collect()} == {(10, 0), (11, 5), (12, 0)}
    assert {(r["seq"], r["error"]) for r in errors.collect()} == {(9, "does not exist"), (10, "unknown layer")}


def test_a_round_of_a_fit_exchanges_vectors_only(spark, monkeypatch):
    cells = [(o, d, 1.0 + (o * 7 + d * 3) % 5) for o in range(20) for d in range(20)]
    od = spark.createDataFrame(cells, "o int, d int, trips double")
    rows = spark.createDataFrame([(o, 10.0 + o) for o in range(20)], "o int, target double")
    cols = spark.createDataFrame([(d, 5.0 + 19.0 * 1.5 - d * 0.9473684210526315 + 0.0) for d in range(20)], "d int, target double")
    total = rows.agg(F.sum("target")).first()[0] / cols.agg(F.sum("target")).first()[0]
    cols = cols.withColumn("target", F.col("target") * total)
    plans = []
    cut = matrix.cut_lineage

    def seen(df, *a):
        out = cut(df, *a)
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return out

    monkeypatch.setattr(matrix, "cut_lineage", seen)
    fitted = matrix.mat_growth_factor(od, rows, cols, tol=1e-10, checkpoint_every=1).collect()
    for key, target in (("o", rows), ("d", cols)):
        for r in target.collect():
            assert sum(t["trips"] for t in fitted if t[key] == r[key]) == pytest.approx(r["target"], rel=1e-8)
    one = plans[1]
    exchanges = [line for line in one.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "(d#" in exchanges[0]


def test_fits_without_a_solution_or_with_zero_margins(spark):
    od = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0), (3, 3, 1.0), (4, 4, 0.0)], "o int, d int, trips double")
    rows = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, None)], "o int, target double")
    cols = spark.createDataFrame([(1, 2.0), (2, 2.0)], "d int, target double")
    got = {(r["o"], r["d"]): r["trips"] for r in matrix.mat_growth_factor(od, rows, cols, tol=1e-9).collect()}
    assert got == pytest.approx({(1, 1): 1.0, (1, 2): 2.0, (2, 1): 1.0, (3, 3): 0.0}, rel=1e-6)
    bad = spark.createDataFrame([(1, 9.0), (2, 2.0)], "d int, target double")
    with pytest.raises(matrix.FitError):
        matrix.mat_growth_factor(od, rows, bad, max_iter=6, tol=1e-12)


def test_whole_sums_beside_running_ones(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "hot", "hot", "hot", None, "b"]), rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "i long, g string, v long").repartition(7)
    got = windows.running(df, ["g"], ["i"], {"upto": F.col("v")}, {"whole": F.col("v")}).collect()
    upto, whole = {}, {}
    for _, g, v in rows:
        whole[g] = whole.get(g, 0) + v
    assert len(got) == len(rows)
    for r in sorted(got, key=lambda r: r["i"]):
        upto[r["g"]] = upto.get(r["g"], 0) + r["v"]
        assert (r["upto"], r["whole"]) == (upto[r["g"]], whole[r["g"]])


def test_headings_lengths_and_turns_of_polylines(spark):
    rows = [(1, [(0.0, 0.0), (0.0, 3.0), (4.0, 3.0)]), (2, [(0.0, 0.0), (-1.0, 1.0)]), (3, [(1.0, 1.0)]), (4, []), (5, None)]
    df = spark.createDataFrame(rows, "id int, line array<struct<x:double,y:double>>")
    got = df.select(
        "id", scalar.polyline_length("line").alias("len"), scalar.polyline_heading("line").alias("a"), scalar.polyline_heading("line", last=True).alias("b"),
        scalar.polyline_heading("line", reverse=True).alias("c"), scalar.polyline_heading("line", last=True, reverse=True).alias("d"),
    )
    out = {r["id"]: tuple(r)[1:] for r in got.collect()}
    assert out[1] == pytest.approx((7.0, 0.0, 90.0, 270.0, 180.0)) and out[2] == pytest.approx((2**0.5, 315.0, 315.0, 135.0, 135.0))
    assert out[3] == (0.0, None, None, None, None) and out[4] == out[5] == (None,) * 5
    turns = spark.createDataFrame([(350.0, 10.0), (10.0, 350.0), (0.0, 180.0), (90.0, 45.0)], "a double, b double")
    assert [r[0] for r in turns.select(scalar.turn_angle("a", "b")).collect()] == [20.0, -20.0, -180.0, -45.0]


def test_link_pairs_against_all_pairs(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3]), rng.choice([0, 0, 0, 1, 2, 4]), rng.choice([25, 35, 55, None]), rng.uniform(0, 360), rng.choice([0.0, 359.9, rng.uniform(0, 360), None])) for i in range(250)]
    rows.append((None, 1, 2, 55, 10.0, 20.0))
    df = spark.createDataFrame(rows, "id int, from_id int, to_id int, spd int, start_heading double, end_heading double")
    for limit, thresholds, keep in ((30.0, {"spd": 15}, None), (179.0, None, None), (47.0, None, {"spd": 55}), (180.0, {"spd": 10}, None)):
        want = []
        for i, o in ((i, o) for i in rows for o in rows if i[2] == o[1] and i[1] != o[2] and i[5] is not None):
            turn = (o[4] - i[5] + 180) % 360 - 180
            diff = None if i[3] is None or o[3] is None else abs(o[3] - i[3])
            far = thresholds is None or (diff is not None and diff >= thresholds["spd"])
            if abs(turn) <= limit and far and (keep is None or 55 in (i[3], o[3])):
                want.append((i[2], i[0], o[0], i[3], o[3]))
        got = [tuple(r)[:5] for r in network.net_link_pairs(df, "id", ["spd"], limit, thresholds, keep).collect()]
        assert sorted(got, key=str) == sorted(want, key=str) and got


def test_link_pairs_hand_no_table_of_links_to_every_task(spark, tmp_path):
    rows = spark.range(400).selectExpr("id", "id div 4 AS from_id", "1 + id div 5 AS to_id", "25 + 5 * (id % 10) AS spd", "CAST(id * 7 % 360 AS DOUBLE) AS start_heading", "CAST(id * 11 % 360 AS DOUBLE) AS end_heading")
    rows.write.parquet(str(tmp_path / "links"))
    df = network.net_link_pairs(spark.read.parquet(str(tmp_path / "links")), "id", ["spd"], 30.0, {"spd": 15})
    assert df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_rates_hold_from_the_nearest_lower_speed(spark):
    hourly = spark.createDataFrame([(20, 100.0, 10.0, 30.0, 50.0, 5.0, 7.0), (4, 9.0, 9.0, 9.0, 0.0, 0.0, 0.0)], "speed_row int, vmt_car double, vmt_su double, vmt_mu double, vol_car double, vol_su double, vol_mu double")
    rates = spark.createDataFrame([(c, m, s, r) for c in ("car", "trk") for m, s, r in (("co", 5, 2.0), ("co", 18, 1.5), ("co", 21, 9.0), ("fuel", 5, 0.1))], "cls string, measure string, speed int, rate double")
    out = highway.hwy_fuel_emissions(hourly, rates, {"co": 2.0, "fuel": {"car": 3.0, "trk": 4.0}}, non_fuel={"car": 0.5, "trk": 1.0}, classes=highway.ALL_CLASSES)
    got, g = {(r["cls"], r["measure"], r["kind"]): r["value"] for r in out.collect()}, highway.GRAMS_TO_TONS
    assert got == pytest.approx(
        {
            ("car", "co", "running"): 100 * 1.5 * 2 * g, ("trk", "co", "running"): 40 * 1.5 * 2 * g, ("car", "co", "start"): 50 * 2 * 2 * g, ("trk", "co", "start"): 12 * 2 * 2 * g,
            ("car", "fuel", "running"): 30.0, ("trk", "fuel", "running"): 16.0, ("car", "non_fuel", "running"): 54.5, ("trk", "non_fuel", "running"): 58.0,
        }
    )
