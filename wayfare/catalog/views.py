"""Driver views: the given tables seen as households, tours, trips, links and so on.

The text is valid in Spark SQL and DuckDB alike; ``ELEM(a, k)`` is the 1-based array
element, the one place where the two dialects differ. Node and zone numbers of
``v_link`` are built so that node degree stays bounded as the table grows.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import windows

SOURCES = tuple(
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations".split()
)

VIEWS: dict[str, str] = {
    "v_zone": """
SELECT n_nationkey AS taz, n_regionkey AS district, n_nationkey % 4 AS area_type, n_name AS zname FROM nation""",
    "v_household": """
SELECT c_custkey AS hhno, c_nationkey AS hhtaz, CAST(c_custkey % 6 AS INT) AS hhvehs, c_acctbal * 10 AS hhincome,
       CAST(1 + c_custkey % 3 AS INT) AS hhexpfac, CAST(c_custkey % 97 AS INT) AS hhparcel, c_mktsegment AS hhseg FROM customer""",
    "v_person": """
SELECT h.c_custkey AS hhno, s.pno AS pno, CAST((h.c_custkey * 7 + s.pno * 13) % 90 AS INT) AS pagey,
       CAST(1 + (h.c_custkey + s.pno) % 8 AS INT) AS pptyp, CAST((h.c_custkey + s.pno) % 3 AS INT) AS pwtyp,
       CAST(CASE WHEN (h.c_custkey + s.pno) % 11 = 0 THEN -1 ELSE (h.c_custkey * 3 + s.pno) % 25 END AS INT) AS pwtaz,
       CAST((h.c_custkey * 5 + s.pno) % 97 AS INT) AS pwpcl, CAST((h.c_custkey * 11 + s.pno) % 120 - 5 AS INT) AS pwaudist,
       CAST(1 + s.pno % 2 AS INT) AS psexpfac
FROM customer h JOIN (SELECT 0 AS m, 1 AS pno UNION ALL SELECT 1, 1 UNION ALL SELECT 1, 2 UNION ALL SELECT 2, 1 UNION ALL SELECT 2, 2
  UNION ALL SELECT 2, 3 UNION ALL SELECT 3, 1 UNION ALL SELECT 3, 2 UNION ALL SELECT 3, 3 UNION ALL SELECT 3, 4) s ON s.m = h.c_custkey % 4""",
    "v_person_place": """
SELECT hhno, pno, pptyp, psexpfac, pwtyp, pwtaz, pwpcl, pwaudist, CAST((hhno * 17 + pno) % 130 - 6 AS INT) AS pwautime, CAST((hhno * 7 + pno * 5) % 28 - 2 AS INT) AS pstaz,
       CAST((hhno * 13 + pno * 3) % 97 AS INT) AS pspcl, CAST((hhno * 19 + pno) % 110 - 4 AS INT) AS psaudist, CAST((hhno * 23 + pno) % 140 - 7 AS INT) AS psautime FROM v_person""",
    "v_surveyed": """
SELECT o_custkey AS hhno, o_orderkey AS pno, CAST(1 + o_orderkey % 8 AS INT) AS pptyp, CAST(1 + o_orderkey % 5 AS INT) AS psexpfac, CAST(o_orderkey % 3 AS INT) AS pwtyp,
       CAST((o_orderkey * 3 + o_custkey) % 27 - 2 AS INT) AS pwtaz, CAST((o_orderkey * 5) % 97 AS INT) AS pwpcl, CAST((o_orderkey * 11) % 120 - 5 AS INT) AS pwaudist,
       CAST((o_orderkey * 29) % 130 - 6 AS INT) AS pwautime, CAST((o_orderkey * 7 + o_custkey) % 28 - 2 AS INT) AS pstaz, CAST((o_orderkey * 13) % 97 AS INT) AS pspcl,
       CAST((o_orderkey * 19) % 110 - 4 AS INT) AS psaudist, CAST((o_orderkey * 31) % 140 - 7 AS INT) AS psautime FROM orders""",
    "v_tour": """
SELECT t.o_orderkey AS tour_key, t.o_custkey AS hhno, CAST(1 + t.o_orderkey % (1 + t.o_custkey % 4) AS INT) AS pno, t.rn AS tour,
       CASE WHEN t.rn % 4 = 0 THEN t.rn - 1 ELSE 0 END AS parent, CAST(t.o_orderkey % 10 AS INT) AS pdpurp,
       CAST(1 + t.o_orderkey % 8 AS INT) AS tmodetp, CAST((t.o_orderkey * 37) % 1440 AS INT) AS tardest,
       CAST((t.o_orderkey * 37) % 1440 + 30 + t.o_orderkey % 600 AS INT) AS tlvdest,
       CAST(t.o_custkey % 25 AS INT) AS totaz, CAST(t.o_orderkey % 25 AS INT) AS tdtaz,
       CAST(t.o_orderkey % 95 AS INT) - 2 AS tautodist, CAST(1 + t.o_orderkey % 4 AS INT) AS tripsh1, CAST(1 + t.o_orderkey % 3 AS INT) AS tripsh2
FROM v_order_seq t""",
    "v_order_seq": """
SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders""",
    "v_trip": """
SELECT o.o_custkey AS hhno, CAST(1 + l.l_orderkey % (1 + o.o_custkey % 4) AS INT) AS pno, l.l_orderkey AS tour_key, l.l_linenumber AS tseg,
       1 + l.l_linenumber % 2 AS half, CAST(1 + l.l_partkey % 8 AS INT) AS tmode, CAST(3 + l.l_suppkey % 5 AS INT) AS pathtype,
       CAST(l.l_partkey % 11 AS INT) AS dpurp, CAST(l.l_suppkey % 25 AS INT) AS otaz, CAST(o.o_custkey % 25 AS INT) AS dtaz,
       CAST((l.l_orderkey * 37 + l.l_linenumber * 60) % 1440 AS INT) AS deptm,
       CAST((l.l_orderkey * 37 + l.l_linenumber * 60 + l.l_partkey % 90) % 1440 AS INT) AS arrtm,
       CAST((l.l_orderkey * 41 + l.l_linenumber * 75) % 1440 AS INT) AS endacttm, l.l_quantity AS travdist, 1 AS trexpfac
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "v_personday": """
SELECT user_id AS hhno, CAST(ts AS DATE) AS day, SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS wktours,
       SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS sctours, SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS wkstops,
       SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS scstops FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "v_link": """
SELECT p_partkey AS id, CAST(FLOOR(p_partkey / 4.0) AS BIGINT) AS from_id, CAST(1 + FLOOR(p_partkey / 5.0) AS BIGINT) AS to_id,
       CAST(p_size AS DOUBLE) / CAST(10 AS DOUBLE) AS length,
       CAST(p_partkey % 3 AS INT) - 1 AS dir, CAST(1 + p_partkey % 7 AS INT) AS funcclass, CAST(1 + p_partkey % 2 AS INT) AS fcarea,
       CAST(p_partkey % 4 AS INT) AS ab_lanes, CAST((p_partkey + 1) % 4 AS INT) AS ba_lanes, CAST(25 + 5 * (p_partkey % 10) AS INT) AS spd_lmt,
       CAST(1 + p_partkey % 3 AS INT) AS access, CAST(p_partkey % 2 AS INT) AS median, CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS ramp,
       CAST((p_partkey * 31) % 5000 AS INT) AS ab_am_auto, CAST((p_partkey * 17) % 5000 AS INT) AS ba_am_auto,
       CAST((p_partkey * 29) % 5000 AS INT) AS ab_pm_auto, CAST((p_partkey * 13) % 5000 AS INT) AS ba_pm_auto,
       CAST((p_partkey * 7) % 900 AS INT) AS ab_am_sut, CAST((p_partkey * 5) % 900 AS INT) AS ba_am_sut,
       CASE WHEN p_partkey % 3 = 0 THEN CAST((p_partkey * 97) % 60000 AS INT) END AS aadt, p_type AS rte_name FROM part""",
    "v_edit": """
SELECT event_id AS seq, CAST(1 + user_id * 3 AS BIGINT) AS id, CASE WHEN event_type = 'error' AND value < 1 THEN 'Remove' WHEN event_type = 'signup' THEN 'Add' ELSE 'Modify' END AS action,
       CASE event_type WHEN 'click' THEN 'spd_lmt' WHEN 'view' THEN 'ab_lanes' ELSE 'ba_lanes' END AS field_name, CAST(event_id % 7 AS STRING) AS field_value FROM events""",
    "v_tract": """
SELECT tract, tract % 25 AS zone, tract % 5 AS district, CASE WHEN tract % 5 < 3 THEN 1 ELSE 2 END AS super_district FROM v_cwalk WHERE tract % 20 <> 19 GROUP BY tract""",
    "v_taz": """
SELECT taz AS zone, district, CASE WHEN district < 3 THEN 1 ELSE 2 END AS super_district FROM v_zone""",
    "v_census_flow": """
SELECT l_suppkey % 103 AS home, l_partkey % 103 AS work, l_quantity AS workers FROM lineitem""",
    "v_payroll_flow": """
SELECT o_custkey % 103 AS home, CASE WHEN o_orderkey % 103 % 20 = 19 THEN 5 ELSE o_orderkey % 103 END AS work, CASE WHEN o_custkey % 103 % 20 = 19 THEN 0 ELSE CAST(1 + o_orderkey % 4 AS INT) END AS jobs FROM orders""",
    "v_od": """
SELECT s.s_nationkey AS o, c.c_nationkey AS d, YEAR(l.l_shipdate) AS core, SUM(l.l_quantity) AS trips
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_nationkey, c.c_nationkey, YEAR(l.l_shipdate)""",
    "v_skim": """
SELECT o, d, period, 1 + ABS(o - d) * 2 + period AS imp
FROM (SELECT CAST(l_suppkey % 25 AS INT) AS o, CAST(l_orderkey % 25 AS INT) AS d, 1 + l_linenumber % 3 AS period FROM lineitem) x
GROUP BY o, d, period""",
    "v_apc": """
SELECT CAST(ts AS DATE) AS survey_date, CAST(user_id % 19 AS INT) AS route, user_id AS stop_id, HOUR(ts) * 3600 + MINUTE(ts) * 60 AS start_sec,
       CAST(FLOOR(value) AS INT) AS passengers_on, CAST(FLOOR(value / 2) AS INT) AS passengers_off, event_id AS milepost FROM events""",
    "v_probe": """
SELECT l_orderkey * 10 + l_linenumber AS trip_id, l_shipdate AS start_date, CAST(1 + l_partkey % 3 AS INT) AS veh_class, CAST(l_suppkey % 6 AS INT) - 1 AS start_district,
       CAST(l_partkey % 6 AS INT) - 1 AS end_district, CASE WHEN l_suppkey % 4 = 0 THEN 'E' ELSE 'I' END AS geo_start,
       CASE WHEN l_partkey % 4 = 0 THEN 'E' ELSE 'I' END AS geo_end FROM lineitem""",
    "v_survey": """
SELECT c_custkey AS respondent, CAST(c_custkey % 19 AS INT) AS route, CAST(c_custkey % 9 AS DOUBLE) / CAST(2 AS DOUBLE) AS linked_weight,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 11 AS INT) END AS confidence,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(1 + c_custkey % 12 AS INT) END AS hr, CASE WHEN c_custkey % 2 = 0 THEN 'AM' ELSE 'PM' END AS ampm FROM customer""",
    "v_jobs": """
SELECT CONCAT('47065', LPAD(CAST(s_nationkey * 100 AS STRING), 6, '0'), LPAD(CAST(s_suppkey AS STRING), 4, '0')) AS w_geocode, CAST(s_suppkey % 13 AS INT) AS cns05,
       CAST(s_suppkey % 7 AS INT) AS cns06, CAST(s_suppkey % 5 AS INT) AS cns07, CAST(s_suppkey % 3 AS INT) AS cns18 FROM supplier""",
    "v_cwalk": """
SELECT l_partkey AS mz_id, CAST(l_partkey % 103 AS INT) AS tract, CAST(l_suppkey % 3 AS INT) AS puma, SUM(l_quantity) AS pop
FROM lineitem GROUP BY l_partkey, l_partkey % 103, l_suppkey % 3""",
    "v_hwy": """
SELECT l.id, l.from_id, l.to_id, l.length, l.dir, l.fcarea, l.ab_lanes, l.ba_lanes, l.access, l.median, l.ramp, l.aadt,
       CASE WHEN l.id % 23 = 0 THEN NULL ELSE l.spd_lmt END AS pspeed,
       CASE WHEN l.fcarea = 1 THEN CASE l.funcclass WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 6 WHEN 5 THEN 7 WHEN 6 THEN 8 ELSE 9 END
        ELSE CASE l.funcclass WHEN 1 THEN 11 WHEN 2 THEN 12 WHEN 3 THEN 14 WHEN 4 THEN 16 WHEN 5 THEN 17 WHEN 6 THEN 17 ELSE 19 END END AS fc, CAST(l.id % 2 AS INT) AS turnlane, CAST(8 + l.id % 6 AS INT) AS lnwidth,
       CASE WHEN l.id % 9 = 0 THEN NULL ELSE CAST(l.id % 8 AS INT) END AS rswidth, CAST(l.from_id % 6 AS INT) AS a_ctrl, CAST(l.to_id % 6 AS INT) AS b_ctrl,
       CAST(1 + l.id % 3 AS INT) AS a_prio, CAST(1 + (l.id + 1) % 3 AS INT) AS b_prio, CAST(l.id % 4 AS INT) % 2 AS a_sync, CAST(l.id % 5 AS INT) % 2 AS b_sync,
       CASE WHEN l.id % 8 = 1 THEN 1 ELSE 0 END AS auxlane, CASE WHEN l.id % 10 = 1 AND l.ab_lanes >= 2 THEN 1 ELSE 0 END AS weavelane,
       CASE WHEN l.id % 6 = 5 THEN 1 ELSE 0 END AS truckclimb, CASE l.id % 40 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS correction, CAST(l.id % 3 AS INT) AS rail,
       l.ab_am_auto AS ab_basevol, l.ba_am_auto AS ba_basevol, l.ab_am_auto AS ab_am_car, l.ba_am_auto AS ba_am_car, l.ab_pm_auto AS ab_pm_car, l.ba_pm_auto AS ba_pm_car,
       CAST((l.id * 41) % 9000 AS INT) AS ab_op_car, CAST((l.id * 43) % 9000 AS INT) AS ba_op_car, l.ab_am_sut AS ab_am_su, l.ba_am_sut AS ba_am_su,
       CAST((l.id * 3) % 300 AS INT) AS ab_pm_su, CAST((l.id * 11) % 300 AS INT) AS ba_pm_su, CAST((l.id * 19) % 700 AS INT) AS ab_op_su, CAST((l.id * 23) % 700 AS INT) AS ba_op_su,
       CAST(l.id % 90 AS INT) AS ab_am_mu, CAST(l.id % 70 AS INT) AS ba_am_mu, CAST(l.id % 50 AS INT) AS ab_pm_mu, CAST(l.id % 60 AS INT) AS ba_pm_mu,
       CAST(l.id % 200 AS INT) AS ab_op_mu, CAST(l.id % 210 AS INT) AS ba_op_mu
FROM v_link l""",
    "v_dlink": """
SELECT id, 'AB' AS flow, from_id, to_id, length, dir, fc, fcarea, access, median, ramp, ab_lanes AS lanes, ab_am_car AS am_car, ab_pm_car AS pm_car, ab_op_car AS op_car, ab_am_su AS am_su, ab_pm_su AS pm_su,
       ab_op_su AS op_su, ab_am_mu AS am_mu, ab_pm_mu AS pm_mu, ab_op_mu AS op_mu, 60 * length / (25 + id % 40) AS fftime, CAST(800 + (id * 7) % 4000 AS DOUBLE) AS am_cap,
       CAST(900 + (id * 13) % 4000 AS DOUBLE) AS pm_cap, CAST(0.15 AS DOUBLE) AS bpr_a, CAST(4 AS DOUBLE) AS bpr_b FROM v_hwy WHERE ab_lanes > 0
UNION ALL
SELECT id, 'BA' AS flow, to_id, from_id, length, dir, fc, fcarea, access, median, ramp, ba_lanes, ba_am_car, ba_pm_car, ba_op_car, ba_am_su, ba_pm_su, ba_op_su, ba_am_mu, ba_pm_mu, ba_op_mu,
       60 * length / (25 + id % 40), CAST(800 + (id * 7) % 4000 AS DOUBLE), CAST(900 + (id * 13) % 4000 AS DOUBLE), CAST(0.15 AS DOUBLE), CAST(4 AS DOUBLE) FROM v_hwy WHERE ba_lanes > 0""",
    "v_saf": """
SELECT id, from_id, to_id, length, dir, fc, access, median, median AS divided, CASE WHEN dir = 0 THEN CAST(2 * (1 + id % 5) + CASE WHEN id % 9 = 0 THEN 1 ELSE 0 END AS INT) ELSE CAST(1 + id % 5 AS INT) END AS lanes,
       ab_op_car + ba_op_car AS flow, lnwidth AS lane_width, COALESCE(rswidth, 4) AS shoulder, turnlane AS turn_lane, COALESCE(pspeed, 30) AS speed_limit,
       CASE WHEN id % 7 = 0 THEN CAST(0.1 AS DOUBLE) END AS entry_ramp, CASE WHEN id % 11 = 0 THEN CAST(0.25 AS DOUBLE) END AS exit_ramp FROM v_hwy""",
    "v_saf_node": """
SELECT node, COUNT(*) AS legs, CAST(node % 3 AS INT) AS control, CAST(CASE WHEN node % 5 = 0 THEN 2 ELSE 1 END AS INT) AS access, CAST(CASE WHEN node % 2 = 0 THEN 1 ELSE 0 END AS INT) AS urban,
       CAST(CASE WHEN node % 4 < 2 THEN 1 ELSE 0 END AS INT) AS multilane, CASE WHEN node % 19 = 0 THEN node END AS zone, CAST(SUM(flow) AS DOUBLE) / 2 AS int_adt,
       LEAST(COALESCE(MIN(CASE WHEN side = 1 THEN flow END), 0), COALESCE(MIN(CASE WHEN side = 2 THEN flow END), 0)) AS min_adt, MAX(flow) AS max_adt
FROM (SELECT from_id AS node, 1 AS side, flow FROM v_saf UNION ALL SELECT to_id AS node, 2 AS side, flow FROM v_saf) e GROUP BY node""",
    "v_onoff": """
SELECT route, CAST(1 + route % 3 AS INT) AS mode, CASE WHEN start_sec < 32400 THEN 'AM' WHEN start_sec BETWEEN 54000 AND 64800 THEN 'PM' ELSE 'OP' END AS period, milepost AS stop, milepost, passengers_on AS ons,
       passengers_off AS offs, CAST(1 + milepost % 7 AS INT) AS ivtt FROM v_apc""",
    "v_profile": """
SELECT area_group, hour, period, CAST(car AS DOUBLE) / SUM(car) OVER (PARTITION BY area_group, period) AS car, CAST(su AS DOUBLE) / SUM(su) OVER (PARTITION BY area_group, period) AS su,
       CAST(mu AS DOUBLE) / SUM(mu) OVER (PARTITION BY area_group, period) AS mu
FROM (SELECT g.area_group, HOUR(e.ts) + 1 AS hour, CASE WHEN HOUR(e.ts) BETWEEN 6 AND 8 THEN 'am' WHEN HOUR(e.ts) BETWEEN 15 AND 17 THEN 'pm' ELSE 'op' END AS period,
  SUM(g.k + CASE WHEN e.event_type = 'view' THEN 3 ELSE 1 END) AS car, SUM(1 + CASE WHEN e.event_type = 'click' THEN g.k ELSE 1 END) AS su, SUM(1 + CASE WHEN e.event_type = 'error' THEN 5 ELSE 1 END) AS mu
 FROM events e JOIN (SELECT 'rf' AS area_group, 1 AS k, 1 AS one UNION ALL SELECT 'ro', 2, 1 UNION ALL SELECT 'uf', 3, 1 UNION ALL SELECT 'uo', 4, 1) g ON g.one = 1
 GROUP BY g.area_group, HOUR(e.ts) + 1, CASE WHEN HOUR(e.ts) BETWEEN 6 AND 8 THEN 'am' WHEN HOUR(e.ts) BETWEEN 15 AND 17 THEN 'pm' ELSE 'op' END) h""",
    "v_pums_hh": """
SELECT c_custkey AS serialno, CAST(c_custkey % 3 AS INT) AS puma, CAST(1 + c_custkey % 5 AS INT) AS wgtp, CAST(1 + c_custkey % 4 AS INT) AS np,
       CASE c_nationkey % 6 WHEN 0 THEN 1080470 WHEN 1 THEN 1073449 WHEN 2 THEN 1054606 WHEN 3 THEN 1031452 WHEN 4 THEN 1010145 ELSE 1 END AS adjinc,
       ROUND(c_acctbal) AS hincp, CAST(c_custkey % 5 AS INT) - 1 AS ten, CAST(1 + c_custkey % 11 AS INT) AS bld, CAST(c_custkey % 4 AS INT) - 1 AS veh,
       CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 2 ELSE 1 END AS type, CAST(1 + c_custkey % 5 AS INT) AS hupac FROM customer""",
    "v_pums_per": """
SELECT hhno AS serialno, pno AS sporder, pagey AS agep, 1 + (hhno + pno) % 2 AS sex, (hhno * 3 + pno * 7) % 60 AS wkhp, CASE WHEN pagey >= 16 THEN 1 + (hhno + pno) % 6 END AS esr,
       CASE WHEN pagey < 30 THEN (hhno + 2 * pno) % 8 ELSE 0 END AS schg, 1 + (hhno + pno) % 4 AS mil, 1 + (hhno * 5 + pno) % 9 AS pwgtp,
       CASE WHEN hhno % 3 = 0 THEN 'N.A.' ELSE CONCAT(CAST(11 + 2 * ((hhno + pno) % 23) AS STRING), '1011 ') END AS socp00,
       CONCAT(CAST(11 + 2 * ((hhno + 3 * pno) % 23) AS STRING), '2022') AS socp10 FROM v_person""",
    "v_point": """
SELECT vec_id AS id, CAST(ELEM(embedding, 1) AS DOUBLE) AS x, CAST(ELEM(embedding, 2) AS DOUBLE) AS y, label FROM embeddings""",
    "v_hour_profile": """
SELECT HOUR(ts) + 1 AS hour, event_type AS cls, COUNT(*) AS n FROM events GROUP BY HOUR(ts) + 1, event_type""",
}

KNOWN = set(SOURCES) | set(VIEWS)


def spark_text(sql: str) -> str:
    return sql.replace("ELEM(", "element_at(")


def duck_text(sql: str) -> str:
    return sql.replace("ELEM(", "list_extract(")


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the common table expressions it refers to."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return duck_text(sql)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    return duck_text(f"WITH {ctes}\n{sql}")


def _order_seq(t):
    seq = windows.win_group_seq(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], ["o_orderkey"], "rn")
    return seq.select("o_orderkey", "o_custkey", "rn")


AREA_GROUPS = (("rf", 1), ("ro", 2), ("uf", 3), ("uo", 4))


def _profile(t):
    cls, n = F.col("cls"), F.col("n")
    groups = F.explode(F.array(*[F.struct(F.lit(g).alias("area_group"), F.lit(k).alias("k")) for g, k in AREA_GROUPS]))
    long = t.v_hour_profile.select("hour", "cls", "n", groups.alias("g")).select("hour", "cls", "n", "g.*")
    period = F.when(F.col("hour").between(7, 9), "am").when(F.col("hour").between(16, 18), "pm").otherwise("op")
    rate = {
        "car": F.col("k") + F.when(cls == "view", 3).otherwise(1),
        "su": 1 + F.when(cls == "click", F.col("k")).otherwise(1),
        "mu": 1 + F.when(cls == "error", 5).otherwise(1),
    }
    hours = long.groupBy("area_group", "hour", period.alias("period")).agg(*[F.sum(n * r).alias(c) for c, r in rate.items()])
    for c in rate:
        hours = windows.win_share_in_group(hours, ["area_group", "period"], c, c)
    return hours


# Views whose Spark form is an operator, without a window over one key or a cross join.
SPARK_VIEWS = {"v_order_seq": _order_seq, "v_profile": _profile}
