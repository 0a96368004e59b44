"""Reports and tabulations against a plain reckoning."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tools.plans import plan_text
from wayfare.operators import aggregates
from wayfare.plans import highway, reports

HOUR = (
    "id bigint, flow string, fc int, access int, hour int, length double, vc double, time double, lost double, speed_row int, "
    "vol_car double, vol_su double, vol_mu double, vmt_car double, vmt_su double, vmt_mu double, fatal double, injury double, pdo double"
)
NAMES = [c.split()[0] for c in HOUR.split(", ")]
COSTS = {"co": 100.0, "pm10": 900.0, "fuel": {"car": 3.5, "su": 3.75, "trk": 3.9}}
NON_FUEL = {"car": 0.25, "trk": 0.6}


def made(n=40, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        fc, access, length = rng.choice((1, 7, 11, 17, 95, 99)), rng.randint(1, 3), rng.choice((0.0, 0.4, 1.5))
        crash = (None, None, None) if i % 7 == 0 else (0.01 * i, 0.5, 1.25)
        for flow in ("AB", "BA")[: 1 + i % 2]:
            for hour in (1, 8, 17):
                vol = [rng.choice((0.0, 10.0, 250.0)) for _ in range(3)]
                vc = None if i % 11 == 0 else rng.random()
                rows.append((i, flow, fc, access, hour, length, vc, rng.uniform(1, 9), rng.uniform(0, 3), rng.choice((5, 20, 41, 80)), *vol, *[v * length for v in vol], *crash))
    return rows


RATES = [(c, m, s, k * m_k + 100.0 / s) for c, k in (("car", 1), ("su", 2), ("mu", 3), ("trk", 2.5)) for m, m_k in (("co", 5), ("pm10", 3), ("fuel", 1)) for s in (10, 40, 60)]


def brute(rows, keep):
    rows = [dict(zip(NAMES, r)) for r in rows]
    rows = [r for r in rows if 0 < r["fc"] < 95 and keep(r)]
    out = dict.fromkeys(reports.report_columns(), 0.0)
    links = {}
    for r in rows:
        links.setdefault(r["id"], []).append(r)
    out["links"] = len(links)
    out["vmt"] = sum(r["vmt_car"] + r["vmt_su"] + r["vmt_mu"] for r in rows)
    out["vht"] = sum((r["vol_car"] + r["vol_su"] + r["vol_mu"]) * r["time"] / 60 for r in rows)
    top = {i: max((r["vc"] for r in rs if r["vc"] is not None), default=0.0) for i, rs in links.items()}
    weighted = sum(top[r["id"]] * (r["vmt_car"] + r["vmt_su"] + r["vmt_mu"]) for r in rows)
    out["vc"] = weighted / out["vmt"] if out["vmt"] else 0.0
    out["miles"] = sum(rs[0]["length"] for rs in links.values())
    for c in reports.CRASHES:
        out[c] = sum(rs[0][c] or 0.0 for rs in links.values())
    out["crashes"] = sum(out[c] for c in reports.CRASHES)
    for cls, parts in highway.ALL_CLASSES.items():
        for r in rows:
            vol, vmt = sum(r[f"vol_{p}"] for p in parts), sum(r[f"vmt_{p}"] for p in parts)
            out[f"vmt_{cls}"] += vmt
            out[f"vht_{cls}"] += vol * r["time"] / 60
            out[f"delay_{cls}"] += vol * r["lost"] / 60
            out[f"non_fuel_{cls}"] += vmt * NON_FUEL.get(cls, 0.0)
            for m, cost in COSTS.items():
                table = sorted((s, v) for c, n, s, v in RATES if (c, n) == (cls, m))
                lower = [v for s, v in table if s <= r["speed_row"]]
                unit = (cost.get(cls, 1.0) if m == "fuel" else cost * highway.GRAMS_TO_TONS)
                if m == "fuel":
                    out[f"fuel_{cls}"] += vmt * lower[-1] * unit if lower else 0.0
                    continue
                out[f"{m}_running_{cls}"] += vmt * lower[-1] * unit if lower else 0.0
                out[f"{m}_start_{cls}"] += vol * table[0][1] * unit
    return out


ITEMS = [
    ("All", "all", "id >= 0", lambda r: True),
    ("SEP", "classes", None, None),
    ("Class", "freeway", "fc IN (1, 11)", lambda r: r["fc"] in (1, 11)),
    ("Access", "full", "access = 3", lambda r: r["access"] == 3),
    ("Null", "null test", "CASE WHEN access = 1 THEN NULL ELSE fc > 7 END", lambda r: r["access"] != 1 and r["fc"] > 7),
    ("None", "none", "fc = 50", lambda r: False),
    ("All", "all", "id >= 0", lambda r: True),
]


def test_report_against_a_plain_reckoning(spark):
    rows = made()
    hourly, rates = spark.createDataFrame(rows, HOUR), spark.createDataFrame(RATES, "cls string, measure string, speed int, rate double")
    items = [(k, n, F.expr(p) if p else None) for k, n, p, _ in ITEMS]
    got = reports.rep_network_report(hourly, items, rates, COSTS, NON_FUEL)
    assert got.columns == ["pos", "kind", "item", *reports.report_columns()]
    assert len(reports.report_columns()) == 85
    found = {r["pos"]: r for r in got.collect()}
    assert sorted(found) == list(range(len(ITEMS)))
    for pos, (_, name, p, keep) in enumerate(ITEMS):
        assert found[pos]["item"] == name
        if p is None:
            assert all(found[pos][c] is None for c in reports.report_columns())
            continue
        for c, want in brute(rows, keep).items():
            assert found[pos][c] == pytest.approx(want, rel=1e-9, abs=1e-9), (name, c)


def test_report_of_nothing(spark):
    hourly, rates = spark.createDataFrame([], HOUR), spark.createDataFrame([], "cls string, measure string, speed int, rate double")
    got = reports.rep_network_report(hourly, [("All", "all", F.expr("id >= 0")), ("SEP", "", None)], rates, COSTS, NON_FUEL).collect()
    assert [[r[c] for c in reports.report_columns()] for r in sorted(got)] == [[0.0] * 85, [None] * 85]


def test_report_reads_the_hours_once(spark):
    hourly = spark.createDataFrame(made(), HOUR)
    text = plan_text(reports.by_condition_set(hourly, [(k, n, F.expr(p) if p else None) for k, n, p, _ in ITEMS]))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"Scan ExistingRDD|LocalTableScan", text)) == 1


def even(values, passes=10):
    for _ in range(passes):
        values = [v if i in (0, len(values) - 1) else 0.25 * values[i - 1] + 0.5 * v + 0.25 * values[i + 1] for i, v in enumerate(values)]
    return values


def test_smoothing_against_a_plain_loop(spark):
    rng = random.Random(2)
    lines = {"a": [rng.random() for _ in range(30)], "b": [4.0], "c": [1.0, 9.0], "d": [0.0, 8.0, 0.0], None: [1.0, 2.0, 4.0, 8.0]}
    rows = [(k, i, v, f"{k}{i}") for k, vs in lines.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "y string, x int, v double, note string")
    got = aggregates.agg_smooth_distribution(df, ["y"], "x", "v")
    assert got.columns == df.columns
    found = {(r.y, r.x): (r.v, r.note) for r in got.collect()}
    assert len(found) == len(rows)
    for k, vs in lines.items():
        for i, v in enumerate(even(vs)):
            assert found[k, i] == (pytest.approx(v, rel=1e-12), f"{k}{i}")
    assert aggregates.agg_smooth_distribution(df.limit(0), ["y"], "x", "v").count() == 0


def test_templates_by_source_smooth_and_transposed(spark):
    t = aggregates.Template
    templates = [
        t(1, "band", (1, 6), "kind", (1, 2), "w", ("on", "==", 1), data="survey", smooth=True),
        t(2, "band", (1, 6), "kind", (1, 2), "w", ("on", "==", 1), data="model"),
        t(3, "v", (0, 0), "kind", (1, 2), "w", fun="sum", data="model", transpose=True),
        t(4, "v", (0, 0), "kind", (1, 2), "w", fun="mean", data="survey"),
        t(5, "band", (1, 6), data="elsewhere"),
    ]
    ddl = "band int, kind int, w double, v double, on int"
    rows = [(1, 1, 2.0, 5.0, 1), (4, 1, 8.0, None, 1), (4, 2, 1.0, 7.0, 0), (9, 2, 3.0, 1.0, 1), (None, 1, 1.0, 1.0, 1)]
    sides = {"survey": spark.createDataFrame(rows, ddl), "model": spark.createDataFrame(rows[:3], ddl), "unread": spark.createDataFrame([], ddl)}
    got = {(r.outnum, r.x, r.y): r.value for r in aggregates.agg_template_summaries(sides, templates).collect()}
    first = even([2.0, 0, 0, 8.0, 0, 0])
    want = {(1, i + 1, 1): v for i, v in enumerate(first)} | {(1, i, 2): 0.0 for i in range(1, 7)}
    want |= {(2, i, k): {(1, 1): 2.0, (4, 1): 8.0}.get((i, k), 0.0) for i in range(1, 7) for k in (1, 2)}
    want |= {(3, 1, 0): 10.0, (3, 2, 0): 7.0, (4, 0, 1): 11.0 / 3, (4, 0, 2): 10.0 / 4, (4, 0, 3): 21.0 / 7}
    assert got == {k: pytest.approx(v, rel=1e-12) for k, v in want.items()}
    for bad in (t(1, "v", (0, 0), "kind", (1, 2), fun="mean", smooth=True), t(1, "band", (1, 2), transpose=True)):
        with pytest.raises(ValueError):
            aggregates.agg_template_tabulate(sides["model"], [bad])
    for lists in ([templates[0], templates[0]], [templates[4]]):
        with pytest.raises(ValueError):
            aggregates.agg_template_summaries(sides, lists)
