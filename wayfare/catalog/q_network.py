"""Driver forms: road network and highway operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import polyline_heading, polyline_length
from ..plans import highway as hwy
from ..plans import network as net
from .registry import query

_SCORE = "CASE WHEN ramp = 1 THEN 2 WHEN fc IN (1, 11, 12) THEN 9 WHEN fc IN (2, 6, 14) THEN 8 WHEN fc IN (7, 16) THEN 6 WHEN fc IN (8, 17) THEN 5 WHEN fc IN (9, 19) THEN 3 ELSE 2 END"
_LANES = "CASE dir WHEN 1 THEN CAST(ab_lanes AS DOUBLE) WHEN -1 THEN CAST(ba_lanes AS DOUBLE) ELSE CAST(ab_lanes + ba_lanes AS DOUBLE) / 2 END"
VOLUMES = ["am_car", "pm_car", "op_car", "am_su", "pm_su", "op_su", "am_mu", "pm_mu", "op_mu"]


@query("id:i flow:s from_id:i to_id:i lanes:i am_car:i", "SELECT id, flow, from_id, to_id, lanes, am_car FROM v_dlink")
def net_directional(t):
    return net.net_directional(t.v_hwy, ["am_car"])


@query(
    "node:i in_funcclass:i out_funcclass:i in_spd_lmt:i out_spd_lmt:i diff_spd_lmt:i n_pairs:i",
    """
SELECT a.to_id AS node, a.funcclass AS in_funcclass, b.funcclass AS out_funcclass, a.spd_lmt AS in_spd_lmt, b.spd_lmt AS out_spd_lmt, b.spd_lmt - a.spd_lmt AS diff_spd_lmt, COUNT(*) AS n_pairs
FROM v_link a JOIN v_link b ON a.to_id = b.from_id WHERE a.from_id <> b.to_id AND ABS(b.spd_lmt - a.spd_lmt) >= 15 AND (a.funcclass = 3 OR b.funcclass = 3) GROUP BY 1, 2, 3, 4, 5, 6""",
)
def net_attribute_change(t):
    return net.net_attribute_change(t.v_link, ["funcclass", "spd_lmt"], {"spd_lmt": 15}, {"funcclass": 3})


# Links drawn by three points: both ends on a raster by node number, a bend between them.
_DRAWN = """(SELECT *, CAST(from_id % 40 AS DOUBLE) AS x1, CAST(FLOOR(from_id / 40.0) AS DOUBLE) AS y1, CAST(to_id % 40 AS DOUBLE) AS x3, CAST(FLOOR(to_id / 40.0) AS DOUBLE) AS y3,
  CAST(from_id % 40 + to_id % 40 AS DOUBLE) / 2 + id % 7 - 3 AS x2, CAST(FLOOR(from_id / 40.0) + FLOOR(to_id / 40.0) AS DOUBLE) / 2 + id % 11 - 5 AS y2 FROM v_link)"""


def _drawn(t):
    line = F.array(*[F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2, 3)])
    return t.sql(f"SELECT * FROM {_DRAWN} d").withColumn("line", line)


def _bearing(a, b):
    return f"CASE WHEN DEGREES(ATAN2(x{b} - x{a}, y{b} - y{a})) < 0 THEN DEGREES(ATAN2(x{b} - x{a}, y{b} - y{a})) + 360 ELSE DEGREES(ATAN2(x{b} - x{a}, y{b} - y{a})) END"


@query(
    "node:i in_id:i out_id:i in_spd_lmt:i out_spd_lmt:i in_heading:f6 out_heading:f6 turn:f6",
    f"""
WITH e AS (SELECT id, from_id, to_id, spd_lmt, {_bearing(1, 2)} AS sh, {_bearing(2, 3)} AS eh FROM {_DRAWN} d),
 p AS (SELECT a.to_id AS node, a.id AS in_id, b.id AS out_id, a.spd_lmt AS in_spd_lmt, b.spd_lmt AS out_spd_lmt, a.eh AS in_heading, b.sh AS out_heading,
  CASE WHEN b.sh - a.eh >= 180 THEN b.sh - a.eh - 360 WHEN b.sh - a.eh < -180 THEN b.sh - a.eh + 360 ELSE b.sh - a.eh END AS turn
  FROM e a JOIN e b ON a.to_id = b.from_id WHERE a.from_id <> b.to_id AND ABS(b.spd_lmt - a.spd_lmt) >= 15)
SELECT * FROM p WHERE ABS(turn) <= 31.7""",
)
def net_link_pairs(t):
    edges = _drawn(t).withColumns({"start_heading": polyline_heading("line"), "end_heading": polyline_heading("line", last=True)})
    return net.net_link_pairs(edges, "id", ["spd_lmt"], 31.7, {"spd_lmt": 15})


@query(
    "funcclass:i n:i mean:f8 sd:f8 lowest:f8 highest:f8",
    f"""
SELECT funcclass, COUNT(r) AS n, AVG(r) AS mean, STDDEV_SAMP(r) AS sd, MIN(r) AS lowest, MAX(r) AS highest FROM (
 SELECT funcclass, (SQRT((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) + SQRT((x3 - x2) * (x3 - x2) + (y3 - y2) * (y3 - y2)) - length) / length AS r FROM {_DRAWN} d) x GROUP BY funcclass""",
)
def net_length_check(t):
    return net.net_length_check(_drawn(t).withColumn("drawn", polyline_length("line")), "length", "drawn", ["funcclass"])


@query(
    "in_funcclass:i out_1:i out_2:i out_3:i",
    """
SELECT a.funcclass AS in_funcclass, SUM(CASE WHEN b.funcclass = 1 THEN 1 END) AS out_1, SUM(CASE WHEN b.funcclass = 2 THEN 1 END) AS out_2, SUM(CASE WHEN b.funcclass = 3 THEN 1 END) AS out_3
FROM v_link a JOIN v_link b ON a.to_id = b.from_id WHERE a.from_id <> b.to_id AND a.funcclass <> b.funcclass AND b.funcclass IN (1, 2, 3) GROUP BY 1""",
)
def net_linkage_summary(t):
    return net.net_linkage_summary(t.v_link, "funcclass", [1, 2, 3], filter_out=[1, 2, 3])


@query(
    "node:i inflow:i outflow:i change:f2",
    """
SELECT node, SUM(i) AS inflow, SUM(o) AS outflow, COALESCE(ROUND(CAST(SUM(o) - SUM(i) AS DOUBLE) / NULLIF(SUM(i), 0) * 100, 2), 0) AS change FROM
 (SELECT to_id AS node, am_car AS i, 0 AS o FROM v_dlink UNION ALL SELECT from_id, 0, am_car FROM v_dlink) x GROUP BY node""",
)
def net_node_balance(t):
    return net.net_node_balance(t.v_dlink.select("from_id", "to_id", "am_car"), "am_car")


@query(
    "funcclass:s rte_name:s n:i n_name:s",
    """
SELECT CAST(funcclass AS VARCHAR) AS funcclass, COALESCE(rte_name, 'EMPTY') AS rte_name, COUNT(*) AS n, MIN(n_name) AS n_name FROM v_link LEFT JOIN nation ON n_nationkey = funcclass GROUP BY 1, 2""",
)
def net_coding_audit(t):
    return net.net_coding_audit(t.v_link, "funcclass", "rte_name", t.nation, "n_nationkey")


_CONTROL_SQL = f"""
WITH l AS (SELECT *, CAST(10 * ({_LANES} + {_SCORE}) AS INT) AS pc FROM v_hwy),
 e AS (SELECT from_id AS node, 'A' AS side, access, pc FROM l UNION ALL SELECT to_id, 'B', access, pc FROM l),
 n AS (SELECT node, COUNT(*) AS legs, MAX(access) AS access, MAX(pc) AS mx, LEAST(COALESCE(NULLIF(MIN(CASE WHEN side = 'A' THEN pc END), 0), 11), COALESCE(NULLIF(MIN(CASE WHEN side = 'B' THEN pc END), 0), 11)) AS mn FROM e GROUP BY node),
 c AS (SELECT *, CASE WHEN node % 4 = 0 THEN 1 WHEN access = 3 OR legs < 3 THEN 0 WHEN mx = mn THEN 4 ELSE 2 END AS ctl FROM n),
 p AS (SELECT l.id, a.ctl AS ac, b.ctl AS bc, CASE WHEN a.ctl = 0 THEN 0 WHEN a.mx = a.mn THEN 2 WHEN a.mx = pc THEN 1 ELSE 3 END AS ap, CASE WHEN b.ctl = 0 THEN 0 WHEN b.mx = b.mn THEN 2 WHEN b.mx = pc THEN 1 ELSE 3 END AS bp
  FROM l JOIN c a ON a.node = l.from_id JOIN c b ON b.node = l.to_id)
SELECT id, ac AS a_control, bc AS b_control, ap AS a_priority, bp AS b_priority, CASE WHEN ap = 1 AND bp = 1 AND ac = 1 AND bc IN (1, 2) THEN 1 ELSE 0 END AS a_sync,
 CASE WHEN ap = 1 AND bp = 1 AND ac IN (1, 2) AND bc = 1 THEN 1 ELSE 0 END AS b_sync FROM p"""


@query("id:i a_control:i b_control:i a_priority:i b_priority:i a_sync:i b_sync:i", _CONTROL_SQL)
def net_node_controls(t):
    links = t.v_hwy
    nodes = net.net_node_legs(links).select("node", F.when(F.col("node") % 4 == 0, 1).alias("control"))
    return net.net_node_controls(links, nodes)[1]


@query(
    "taz:i legs:i density:f6",
    """
WITH g AS (SELECT node, COUNT(*) AS legs FROM (SELECT from_id AS node FROM v_link UNION ALL SELECT to_id FROM v_link) x GROUP BY node HAVING COUNT(*) > 2)
SELECT taz, COALESCE(SUM(legs), 0) AS legs, COALESCE(SUM(legs), 0) / 25.0 AS density FROM (SELECT n_nationkey AS taz, CAST(n_nationkey % 5 * 8 AS DOUBLE) AS x, FLOOR(n_nationkey / 5.0) * 4 AS y FROM nation) z
LEFT JOIN (SELECT legs, CAST(node % 40 AS DOUBLE) AS x, FLOOR(node / 40.0) AS y FROM g) n ON (n.x - z.x) * (n.x - z.x) + (n.y - z.y) * (n.y - z.y) <= 9 GROUP BY taz""",
)
def net_intersection_density(t):
    k = F.col("n_nationkey")
    zones = t.nation.select(k.alias("taz"), (k % 5 * 8).cast("double").alias("x"), (F.floor(k / 5.0) * 4).cast("double").alias("y"), F.lit(25.0).alias("area"))
    node = F.col("node")
    nodes = net.net_node_legs(t.v_link).select(node, (node % 40).cast("double").alias("x"), F.floor(node / 40.0).cast("double").alias("y"))
    return net.net_intersection_density(t.v_link, nodes, zones, 3.0)


def _last(field, key):
    on = f"CASE WHEN action = 'Modify' AND field_name = '{field}' THEN"
    return f"ARG_MAX({on} field_value END, {on} seq END) AS {key}"


_STANDS = "ARG_MAX(CASE WHEN action <> 'Modify' THEN CASE WHEN action = 'Add' THEN 1 ELSE 0 END END, CASE WHEN action <> 'Modify' THEN seq END) AS st"


@query(
    "id:i kind:s spd_lmt:i ab_lanes:i ba_lanes:i from_control:i to_control:i error:s",
    f"""
WITH e AS (SELECT *, seq % 3 = 0 AS nd FROM v_edit),
 m AS (SELECT id, {_STANDS}, {_last('spd_lmt', 's')}, {_last('ab_lanes', 'a')}, {_last('ba_lanes', 'b')} FROM e WHERE NOT nd GROUP BY id),
 k AS (SELECT from_id AS node FROM v_link UNION SELECT to_id FROM v_link),
 nm AS (SELECT id AS node, {_STANDS}, {_last('control', 'c')} FROM (SELECT seq, id, action, 'control' AS field_name, field_value FROM e WHERE nd) q GROUP BY id),
 n AS (SELECT k.node, COALESCE(CAST(c AS INT), CAST(k.node % 4 AS INT)) AS control FROM k LEFT JOIN nm ON nm.node = k.node WHERE COALESCE(st, CASE WHEN k.node % 11 = 0 THEN 0 ELSE 1 END) = 1)
SELECT l.id, 'link' AS kind, COALESCE(CAST(s AS INT), spd_lmt) AS spd_lmt, COALESCE(CAST(a AS INT), ab_lanes) AS ab_lanes, COALESCE(CAST(b AS INT), ba_lanes) AS ba_lanes,
 f.control AS from_control, t.control AS to_control, NULL AS error
FROM v_link l LEFT JOIN m ON m.id = l.id JOIN n f ON f.node = l.from_id JOIN n t ON t.node = l.to_id WHERE COALESCE(st, CASE WHEN dir >= 0 THEN 1 ELSE 0 END) = 1
UNION ALL SELECT node, 'node', NULL, NULL, NULL, control, NULL, NULL FROM n
UNION ALL SELECT id, 'error', NULL, NULL, NULL, NULL, NULL, 'does not exist' FROM e WHERE NOT nd AND id NOT IN (SELECT id FROM v_link)
UNION ALL SELECT id, 'error', NULL, NULL, NULL, NULL, NULL, 'does not exist' FROM e WHERE nd AND id NOT IN (SELECT node FROM k)""",
)
def net_apply_projects(t):
    """Every third edit is one of nodes; logs hold Adds after Removes and the other way round."""
    edits = t.v_edit.withColumn("layer", F.when(F.col("seq") % 3 == 0, "Node").otherwise("Link"))
    edits = edits.withColumn("field_name", F.when(F.col("layer") == "Node", "control").otherwise(F.col("field_name")))
    links = t.v_link.select("id", "from_id", "to_id", "dir", "spd_lmt", "ab_lanes", "ba_lanes")
    nodes = net.net_node_legs(links).select("node", (F.col("node") % 4).cast("int").alias("control"))
    kept, at, errors = net.net_apply_projects(links, edits, F.col("dir") >= 0, nodes=nodes, node_base=F.col("node") % 11 != 0)
    lanes, ends, nothing = ["spd_lmt", "ab_lanes", "ba_lanes"], ["from_control", "to_control"], F.lit(None).cast("int")
    good = kept.select("id", F.lit("link").alias("kind"), *lanes, *ends, F.lit(None).cast("string").alias("error"))
    placed = at.select(F.col("node").alias("id"), F.lit("node").alias("kind"), *[nothing.alias(c) for c in lanes], F.col("control").alias("from_control"), nothing.alias("to_control"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(placed).unionByName(errors.select("id", F.lit("error").alias("kind"), *[nothing.alias(c) for c in [*lanes, *ends]], "error"))


_FAC = f"""(SELECT *, CASE WHEN ramp = 1 THEN 'ramp' WHEN fc IN (1, 11) OR (fc = 12 AND median = 1) THEN 'fwy' WHEN access = 3 AND dl > 1 AND median = 1 THEN 'fwy'
  WHEN dir = 0 AND dl = 1 AND turnlane = 1 AND median <> 1 THEN 'tw3l' WHEN dir = 0 AND dl = 1 THEN 'twtl' WHEN dl > 1 AND median <> 1 THEN 'twmlu' WHEN dl > 1 THEN 'twmld'
  WHEN dir <> 0 AND dl = 1 THEN 'owol' ELSE 'bad' END AS fac, CASE WHEN fc < 10 THEN -1 WHEN fc > 10 AND fc < 30 THEN 1 ELSE 0 END AS ar FROM (SELECT *, {_LANES} AS dl FROM v_hwy) x0)"""
_FFS = f"""(SELECT *, CASE WHEN pspeed IS NULL THEN 20.0 WHEN fac = 'owol' OR fac = 'tw3l' THEN 1 / (0.119687 - 0.023365 * LN(pspeed)) + 0.373821 * pspeed
  WHEN fac = 'twtl' AND ar = -1 THEN 0.009751 * pspeed * pspeed + 28.4 WHEN fac = 'twtl' THEN 6.6 + 0.9437 * pspeed
  WHEN fac = 'twmlu' AND ar = -1 THEN 3.6 * POW(pspeed, 0.857638) - 113 * EXP(-41.803252 / pspeed) WHEN fac = 'twmlu' THEN 3.0 * POW(pspeed, 0.857638) - 75 * EXP(-41.803252 / pspeed)
  WHEN fac = 'twmld' AND access = 2 THEN 0.009 * pspeed * pspeed + 35
  WHEN fac = 'fwy' THEN -0.0175 * pspeed * pspeed + 2.75 * pspeed - 33.5 WHEN fac = 'ramp' THEN 12.4892 + 1.3776 * pspeed - 0.0061 * pspeed * pspeed ELSE 1.1 * pspeed END AS v FROM {_FAC} x1)"""


@query("id:i factype:s ffspeed:f6 fftime:f6", f"SELECT id, fac AS factype, v AS ffspeed, 60 * length / v AS fftime FROM {_FFS} x2")
def hwy_free_flow_speed(t):
    return hwy.hwy_free_flow_speed(t.v_hwy)


_LANECAP = f"""(SELECT *, CASE WHEN fac = 'ramp' AND dl < 2 THEN 1000.0
   WHEN ct = 'fwy' THEN ic * hv * wv * ax * tc * fw * lw
   WHEN ct = 'multi' THEN ic * hv * wv * ax * tc * fw * lw * CASE WHEN fac = 'twmld' THEN 1 ELSE 0.9695 END * CASE WHEN ar = -1 THEN 1 ELSE LEAST(1, GREATEST(0.8333, 1.07209 - 0.00481 * CASE WHEN access = 2 THEN 2.5 ELSE 25 END - 3.75 / v)) END
   ELSE ic * hv * wv * ax * tc * CASE WHEN sw < 4 THEN LEAST(1, GREATEST(0.88, 1.43621 * POW(v, 0.26354 - 0.09366 * LN(wd)) - 8.06484 / wd))
      WHEN sw < 6 THEN LEAST(1, GREATEST(0.9125, 1.58362 * POW(v, 0.24881 - 0.09472 * LN(wd)) - 8.34158 / wd)) WHEN wd = 9 THEN 0.9537 WHEN wd = 10 THEN 0.9768 WHEN wd = 11 THEN 0.9916 ELSE 1 END
     * LEAST(1, GREATEST(0.826, 0.71 + 0.58 * (1 - CASE WHEN ar = -1 THEN 0.55 ELSE 0.5 END)))
     * CASE WHEN ar = -1 THEN 1 ELSE LEAST(1, GREATEST(0.8125, 1.07984 - CASE WHEN fac = 'tw3l' THEN 0.00266 ELSE 0.00532 END * CASE WHEN access = 2 THEN 2.5 ELSE 25 END - 3.75 / v)) END END AS lcap
 FROM (SELECT *, 1 / (1 + 0.5 * CASE WHEN ct = 'twy' AND ar = -1 THEN 0.05 WHEN ar = -1 THEN 0.06 ELSE 0.04 END) AS hv,
   CASE WHEN ct = 'twy' THEN 1700 WHEN ct = 'multi' THEN CASE WHEN v < 50 THEN 1900 WHEN v < 55 THEN 2000 WHEN v < 60 THEN 2100 ELSE 2200 END
    WHEN ramp = 1 AND pspeed < 40 THEN 1700 ELSE CASE WHEN v < 60 THEN 2250 WHEN v < 65 THEN 2300 WHEN v < 70 THEN 2350 ELSE 2400 END END AS ic,
   CASE WHEN ct = 'fwy' THEN CASE WHEN dl < 3 THEN LEAST(1, GREATEST(0.9345, (-6.00001 + sw) / (0.0001 + 1.66667 * v) + 1)) WHEN dl = 3 THEN LEAST(1, GREATEST(0.9564, (-5.99999 + sw) / (-0.00084 + 2.50001 * v) + 1)) END
    ELSE LEAST(1, GREATEST(0.88, (1095.74797 + v) / (1280.33942 + 6.53454 * sw * sw) + 0.03975 * sw)) END AS fw,
   CASE WHEN wd = 12 THEN 1 WHEN wd = 11 THEN 0.9708 ELSE 0.8985 END AS lw, CASE WHEN weavelane = 0 THEN 1 WHEN dl >= 3 THEN 0.8 WHEN dl >= 2 THEN 0.88 END AS wv,
   CASE WHEN auxlane = 0 THEN 1 ELSE (dl - 0.5) / NULLIF(dl, 0) END AS ax,
   CASE WHEN truckclimb = 0 THEN 1 WHEN ct = 'fwy' THEN LEAST(1, 1.140849 - 2.33864 * POW(0.044, 1.095345) - 0.68344 * POW(0.1, 0.53738))
    WHEN fc IN (2, 6, 14, 16) THEN LEAST(0.9795 - 7.822222 * 0.044 + 0.0003343 * 0.1 * (ab_basevol + ba_basevol), 0.958672 + 0.783068 * 0.044 - 0.0000256 * 0.1 * (ab_basevol + ba_basevol), 1)
    WHEN fc IN (7, 8, 9, 17, 19) THEN LEAST(1, 0.958672 + 0.783068 * 0.044 - 0.0000256 * 0.1 * (ab_basevol + ba_basevol)) ELSE 1 END AS tc
  FROM (SELECT *, CASE WHEN fac IN ('fwy', 'ramp') THEN 'fwy' WHEN fac IN ('owol', 'twtl', 'tw3l') THEN 'twy' ELSE 'multi' END AS ct,
    CAST(GREATEST(LEAST(COALESCE(rswidth, 2), 6), 2) AS DOUBLE) AS sw, CAST(GREATEST(LEAST(lnwidth, 12), 9) AS DOUBLE) AS wd FROM {_FFS} y0) y1) y2)"""

_CAPACITY = f"""
WITH b AS (SELECT * FROM {_LANECAP} z0), w AS (SELECT *, 'AB' AS flow, ab_lanes AS ln, b_ctrl AS cc, b_prio AS pr, b_sync AS sy FROM b UNION ALL SELECT *, 'BA', ba_lanes, a_ctrl, a_prio, a_sync FROM b),
 d AS (SELECT *, v * 5280 / 3600 * 0.3 AS sc FROM w WHERE ln > 0),
 e AS (SELECT *, CASE WHEN access = 3 AND fac <> 'ramp' THEN 0 WHEN cc = 1 THEN (0.5 * 90 * POW(1 - CASE pr WHEN 1 THEN 0.6 WHEN 2 THEN 0.5 ELSE 0.4 END, 2) + 0.5 * sc) * CASE WHEN sy = 1 THEN CASE pr WHEN 1 THEN 0.5 * 0.333 * 0.256 WHEN 2 THEN 0.333 * 0.256 ELSE 0.256 END ELSE 1 END
   WHEN (cc = 2 AND pr > 2) OR cc = 4 THEN 10 + 0.5 * sc WHEN cc = 5 THEN 0.5 * sc ELSE 0 END / 60 AS dly FROM d),
 f AS (SELECT *, 60 * length / v + dly AS aft, 60 * length / (60 * length / v + dly) AS afs FROM e),
 g AS (SELECT *, COALESCE(lcap, 0) * LEAST(1, (-460 + 745 * LN(GREATEST(0.25, afs / v) * v)) / (-460 + 745 * LN(v))) * CASE correction WHEN 1 THEN 1.3 WHEN 2 THEN 1.6 ELSE 1 END * ln AS hc FROM f)
SELECT id, flow, lcap AS lanecap, dly AS delay, aft AS afftime, GREATEST(1, hc * 2.8) AS am_cap, GREATEST(1, hc * 2.9) AS pm_cap, GREATEST(1, hc * k) AS dly_cap,
 GREATEST(1, GREATEST(1, hc * k) - GREATEST(1, hc * 2.8) - GREATEST(1, hc * 2.9)) AS op_cap,
 CASE WHEN fac = 'fwy' THEN 0.83 WHEN fac = 'ramp' OR access = 2 THEN 0.71 WHEN cc = 1 THEN 0.6 WHEN cc > 1 AND dly > 0 THEN 0.6 WHEN dly = 0 THEN 0.15 END AS bpr_a
FROM (SELECT *, CASE WHEN ct = 'fwy' THEN 11.36 WHEN ar = 1 THEN 10.86 ELSE 10 END AS k FROM g) h"""


@query("id:i flow:s lanecap:f4 delay:f9 afftime:f9 am_cap:f4 pm_cap:f4 dly_cap:f4 op_cap:f4 bpr_a:f2", _CAPACITY)
def hwy_capacity(t):
    return hwy.hwy_capacity(hwy.hwy_free_flow_speed(t.v_hwy))


_FCP = (1.1, 1.05, 1.02, 1.04, 1.03, 0.2)


@query(
    "id:i flow:s ftb:f9 toll:f9 gctime:f9",
    """
SELECT id, flow, ftb, GREATEST(ftb * 0.3 - 0.3 * 0.4 * fft, 0) AS toll, 1.4 * tt + fft * (1 - 1.4) + ftb AS gctime FROM (
 SELECT v.id, flow, fftime AS fft, fftime * 1.25 AS tt, GREATEST(0, v.length * CASE WHEN v.fc IN (1, 11) THEN 0.2 * 1.03 * 1.04 * 1.02 * 1.05 * 1.1 WHEN v.fc IN (2, 12) THEN 0.2 * 1.03 * 1.04 * 1.02 * 1.05
   WHEN v.fc IN (6, 14) THEN 0.2 * 1.03 * 1.04 * 1.02 WHEN v.fc IN (7, 16) THEN 0.2 * 1.03 * 1.04 WHEN v.fc IN (8, 17) THEN 0.2 * 1.03 ELSE 0.2 END) + h.rail * 0.5 AS ftb
 FROM v_dlink v JOIN v_hwy h ON h.id = v.id) x""",
)
def hwy_generalised_cost(t):
    links = t.v_dlink.join(t.v_hwy.select("id", "rail"), "id").withColumn("time", F.col("fftime") * 1.25)
    return hwy.hwy_generalised_cost(links, _FCP, 0.5, 18.0, 1.4)


_PARTS = [f"{d}_{p}_{c}" for d in ("ab", "ba") for p in ("am", "pm", "op") for c in ("car", "su", "mu")]


@query(
    "id:i ab_am_tot:i ba_pm_tot:i ab_car:i ba_mu:i flow:i",
    f"SELECT id, ab_am_car + ab_am_su + ab_am_mu + aadt0 AS ab_am_tot, ba_pm_car + ba_pm_su + ba_pm_mu + aadt0 AS ba_pm_tot, ab_am_car + ab_pm_car + ab_op_car AS ab_car, ba_am_mu + ba_pm_mu + ba_op_mu AS ba_mu, {' + '.join(_PARTS)} AS flow FROM (SELECT *, COALESCE(aadt, 0) AS aadt0 FROM v_hwy) x",
)
def hwy_flow_rollup(t):
    return hwy.hwy_flow_rollup(t.v_hwy, _PARTS, preload="aadt")


@query(
    "id:i flow:s ctime:f6",
    """
SELECT id, flow, (fftime * 1.5 * GREATEST(am_car, 1) + fftime * 1.75 * GREATEST(pm_car, 1) + fftime * GREATEST(op_car, 1)) / GREATEST(am_car + pm_car + op_car, 3) AS ctime FROM v_dlink""",
)
def hwy_congested_time(t):
    d = t.v_dlink.withColumns({"am_time": F.col("fftime") * 1.5, "pm_time": F.col("fftime") * 1.75, "op_time": F.col("fftime")})
    return hwy.hwy_congested_time(d.withColumnsRenamed({"am_car": "am_flow", "pm_car": "pm_flow", "op_car": "op_flow"}))


@query(
    "id:i am_voc:f6 op_voc:f6 dly_voc:f6",
    """
SELECT id, CASE dir WHEN 0 THEN GREATEST(ab_am_car / 1800.0, ba_am_car / 1500.0) WHEN 1 THEN ab_am_car / 1800.0 ELSE ba_am_car / 1500.0 END AS am_voc,
 CASE dir WHEN 0 THEN GREATEST(ab_op_car / 1800.0, ba_op_car / 1500.0) WHEN 1 THEN ab_op_car / 1800.0 ELSE ba_op_car / 1500.0 END AS op_voc,
 GREATEST((ab_am_car + ab_pm_car + ab_op_car) / 9000.0, (ba_am_car + ba_pm_car + ba_op_car) / 8000.0) AS dly_voc FROM v_hwy""",
)
def hwy_voc(t):
    caps = {f"{d}_{p}_cap": F.lit(1800.0 if d == "ab" else 1500.0) for d in ("ab", "ba") for p in ("am", "pm", "op")}
    caps |= {"ab_dly_cap": F.lit(9000.0), "ba_dly_cap": F.lit(8000.0)}
    flows = {f"{d}_{p}_car": f"{d}_{p}_flow" for d in ("ab", "ba") for p in ("am", "pm", "op")}
    return hwy.hwy_voc(t.v_hwy.withColumns(caps).withColumnsRenamed(flows))


def _vol(c):
    raw = f"CASE p.period WHEN 'am' THEN d.am_{c} WHEN 'pm' THEN d.pm_{c} ELSE d.op_{c} END"
    return f"CASE WHEN {raw} < 1 THEN 0 ELSE {raw} END * p.{c} AS vol_{c}"


HOURLY = f"""(SELECT *, 60 * length / time AS speed, CAST(GREATEST(LEAST(FLOOR(60 * length / time), 80), 5) AS INT) AS speed_row, vol * length AS vmt, vol * time / 60 AS vht, lost * vol / 60 AS delay_hours,
  vol_car * length AS vmt_car, vol_su * length AS vmt_su, vol_mu * length AS vmt_mu FROM (SELECT *, lost + fftime AS time FROM (
 SELECT *, GREATEST(CASE WHEN fc IN (1, 11, 12) AND 60 * length / rt < 6 THEN length * 60 / 6 - fftime WHEN fc NOT IN (1, 11, 12) AND rt - fftime > 5 THEN 5 ELSE rt - fftime END, 0) AS lost FROM (
  SELECT *, fftime * (1 + 0.15 * POW(vc, 4)) AS rt FROM (SELECT *, pce / (pm_cap / 3) AS vc FROM (SELECT *, vol_car + vol_su + vol_mu AS vol, vol_car + 1.5 * vol_su + 2.5 * vol_mu AS pce FROM (
   SELECT d.*, p.hour, p.period, {_vol('car')}, {_vol('su')}, {_vol('mu')} FROM v_dlink d JOIN v_profile p
    ON p.area_group = CASE WHEN fc = 1 THEN 'rf' WHEN fc < 11 THEN 'ro' WHEN fc < 14 THEN 'uf' ELSE 'uo' END) h1) h2) h3) h4) h5) h6)"""


def hourly(t):
    return hwy.hwy_hourly_profile(t.v_dlink, t.v_profile)


@query(
    "hour:i fc:i vol:f4 vmt:f4 vht:f4 delay_hours:f4 links:i",
    f"SELECT hour, fc, SUM(vol) AS vol, SUM(vmt) AS vmt, SUM(vht) AS vht, SUM(delay_hours) AS delay_hours, COUNT(*) AS links FROM {HOURLY} x GROUP BY hour, fc",
)
def hwy_hourly_profile(t):
    h = hourly(t)
    return h.groupBy("hour", "fc").agg(*[F.sum(c).alias(c) for c in ("vol", "vmt", "vht", "delay_hours")], F.count("*").alias("links"))


def _peak(n, a, b):
    on = f"hour BETWEEN {a} AND {b}"
    return f"""MAX(CASE WHEN {on} THEN vol END) AS {n}pk_vol, MIN(CASE WHEN {on} THEN speed_row END) AS {n}pk_speed, SUM(CASE WHEN {on} THEN vol END) AS {n}pd_vol,
 SUM(CASE WHEN {on} THEN pce END) / MAX({n}_cap) AS {n}pd_vc, SUM(CASE WHEN {on} THEN vmt END) / NULLIF(SUM(CASE WHEN {on} THEN vht END), 0) AS {n}pd_speed"""


@query(
    "id:i flow:s ampk_vol:f4 ampk_speed:i ampd_vol:f4 ampd_vc:f10 ampd_speed:f8 pmpk_vol:f4 pmpk_speed:i pmpd_vol:f4 pmpd_vc:f10 pmpd_speed:f8 max_vc:f10 low_speed:i delay:f4",
    f"SELECT id, flow, {_peak('am', 7, 9)}, {_peak('pm', 16, 18)}, MAX(vc) AS max_vc, MIN(speed_row) AS low_speed, SUM(delay_hours) AS delay FROM {HOURLY} x GROUP BY id, flow",
)
def hwy_peak_stats(t):
    return hwy.hwy_peak_stats(hourly(t))


# Rates by class, measure and speed row; rows are missing for every third speed, where the row below holds.
_MEASURES = {"co": 5, "co2": 11, "nox": 7, "pm10": 3, "pm25": 2, "sox": 4, "voc": 6, "fuel": 1}
UNIT_COST = {"co": 100.0, "co2": 40.0, "nox": 700.0, "pm10": 900.0, "pm25": 1200.0, "sox": 800.0, "voc": 300.0}
FUEL = {"car": 3.5, "su": 3.75, "mu": 4.0, "trk": 3.9}
NON_FUEL = {"car": 0.25, "su": 0.5, "mu": 0.75, "trk": 0.6}


def values(name, value, table):
    return "(" + " UNION ALL ".join(f"SELECT '{k}' AS {name}, CAST({v} AS DOUBLE) AS {value}, 1 AS one" for k, v in table.items()) + ")"


RATES = f"""(SELECT c.cls, m.measure, s.speed, m.k * c.k + CAST(200 AS DOUBLE) / s.speed AS rate
 FROM (SELECT CAST(p_size + 4 AS INT) AS speed FROM part WHERE p_size % 3 < 2 GROUP BY p_size UNION SELECT CAST(p_size + 54 AS INT) FROM part WHERE p_size <= 26 AND p_size % 3 < 2 GROUP BY p_size) s
 JOIN {values("cls", "k", {"car": 1, "su": 2, "mu": 3, "trk": 2.5})} c ON c.one = 1 JOIN {values("measure", "k", _MEASURES)} m ON m.one = c.one)"""


@query(
    "cls:s measure:s kind:s value:f3",
    f"""
WITH h AS (SELECT speed_row AS speed, vol_car, vol_su, vol_mu, vmt_car, vmt_su, vmt_mu FROM {HOURLY} x),
 l AS (SELECT 'car' AS cls, speed, SUM(vmt_car) AS vmt, SUM(vol_car) AS vol FROM h GROUP BY 2 UNION ALL SELECT 'su', speed, SUM(vmt_su), SUM(vol_su) FROM h GROUP BY 2
  UNION ALL SELECT 'mu', speed, SUM(vmt_mu), SUM(vol_mu) FROM h GROUP BY 2 UNION ALL SELECT 'trk', speed, SUM(vmt_su + vmt_mu), SUM(vol_su + vol_mu) FROM h GROUP BY 2),
 r AS (SELECT * FROM {RATES} q), u AS (SELECT measure, CAST(1.10231131e-6 AS DOUBLE) * cost AS unit FROM {values("measure", "cost", UNIT_COST)} x),
 f AS (SELECT cls, price FROM {values("cls", "price", FUEL)} x), n AS (SELECT cls, cost FROM {values("cls", "cost", NON_FUEL)} x),
 a AS (SELECT l.cls, l.speed, r.measure, l.vmt * ARG_MAX(r.rate, r.speed) AS amount FROM l JOIN r ON r.cls = l.cls AND r.speed <= l.speed GROUP BY l.cls, l.speed, r.measure, l.vmt)
SELECT a.cls, a.measure, 'running' AS kind, SUM(amount * unit) AS value FROM a JOIN u ON u.measure = a.measure GROUP BY 1, 2
UNION ALL SELECT a.cls, 'fuel', 'running', SUM(amount * price) FROM a JOIN f ON f.cls = a.cls WHERE measure = 'fuel' GROUP BY 1
UNION ALL SELECT l.cls, 'non_fuel', 'running', SUM(vmt) * MAX(cost) FROM l JOIN n ON n.cls = l.cls GROUP BY 1
UNION ALL SELECT v.cls, x.measure, 'start', v.vol * x.rate * u.unit FROM (SELECT cls, SUM(vol) AS vol FROM l GROUP BY cls) v
 JOIN (SELECT cls, measure, ARG_MIN(rate, speed) AS rate FROM r GROUP BY 1, 2) x ON x.cls = v.cls JOIN u ON u.measure = x.measure""",
)
def hwy_fuel_emissions(t):
    rates = t.sql(f"SELECT * FROM {RATES} q")
    return hwy.hwy_fuel_emissions(hourly(t), rates, UNIT_COST | {"fuel": FUEL}, non_fuel=NON_FUEL, classes=hwy.ALL_CLASSES)
