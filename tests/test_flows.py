"""Home-to-work flows of several sources and levels against a plain reckoning."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tools.plans import plan_text
from wayfare.plans import survey

AREAS = [("t1", 1, "N"), ("t2", 1, "N"), ("t3", 2, "S"), ("t4", 2, "S"), ("t5", None, "S"), ("t6", 3, "W")]


def sources(spark, rows, twice=()):
    areas = spark.createDataFrame([*AREAS, *twice], "tract string, zone int, district string")
    zones = spark.createDataFrame([(1, "N"), (2, "S"), (3, "W")], "zone int, district string")
    coarse = [(z, w, n) for h, k, n in rows for z in [dict((a[0], a[1]) for a in AREAS).get(h)] for w in [dict((a[0], a[1]) for a in AREAS).get(k)]]
    return [
        survey.FlowSource("fine", spark.createDataFrame(rows, "h string, w string, n double"), areas, "tract", ("zone", "district"), "h", "w", "n"),
        survey.FlowSource("coarse", spark.createDataFrame(coarse, "o int, d int, trips double"), zones, "zone", ("district",)),
    ]


def made():
    rng = random.Random(8)
    ids = [a[0] for a in AREAS]
    hot = [("t1", "t3", 1.0)] * 300  # one pair holds most rows
    return hot + [(rng.choice(ids), rng.choice(ids), rng.choice((0.5, 2.0, None))) for _ in range(200)]


def test_flows_by_level_and_what_is_lost(spark):
    rows = [*made(), ("t9", "t1", 7.0), (None, "t1", 3.0)]
    want, before = Counter(), Counter()
    at = {a[0]: a for a in AREAS}
    for h, w, n in rows:
        before["fine"] += n or 0.0
        before["coarse"] += n or 0.0
        if h in at and w in at:
            for i, level in enumerate(("tract", "zone", "district")):
                if at[h][i] is not None and at[w][i] is not None:
                    want["fine", level, str(at[h][i]), str(at[w][i])] += n or 0.0
            if at[h][1] and at[w][1]:
                want["coarse", "zone", str(at[h][1]), str(at[w][1])] += n or 0.0
                want["coarse", "district", at[h][2], at[w][2]] += n or 0.0
    got = survey.flow_work_levels(sources(spark, rows)).collect()
    assert {(r.source, r.level, r.o, r.d): r.trips for r in got} == {k: pytest.approx(v) for k, v in want.items()}
    for r in got:
        after = sum(v for k, v in want.items() if k[:2] == (r.source, r.level))
        assert (r.before, r.after) == (pytest.approx(before[r.source]), pytest.approx(after))
        assert not r.conserved and r.pct == pytest.approx(100 * r.trips / after)


def test_conserved_unless_an_area_comes_twice(spark):
    rows = [r for r in made() if "t5" not in r[:2]]
    assert all(r.conserved for r in survey.flow_work_levels(sources(spark, rows)).collect())
    got = survey.flow_work_levels(sources(spark, rows, twice=[("t1", 1, "N")])).collect()
    assert {(r.source, r.conserved) for r in got} == {("fine", False), ("coarse", True)}
    assert all(r.after > r.before for r in got if r.source == "fine")


def test_flows_of_nothing(spark):
    assert survey.flow_work_levels(sources(spark, [])).count() == 0


def test_all_levels_in_one_exchange_of_the_rows(spark):
    text = plan_text(survey.flow_work_levels(sources(spark, made()[:5])))
    assert len(re.findall(r"Exchange hashpartitioning\(source#\d+, level#\d+, o#\d+, d#\d+", text)) <= 2  # once, and once more for the totals before reuse
