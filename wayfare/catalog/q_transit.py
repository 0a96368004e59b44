"""Driver forms: transit, emission inputs, reports and dasymetric spreading."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.scalar import fn_road_type
from ..operators import spatial
from ..plans import highway as hwy
from ..plans import moves as mov
from ..plans import reports as rep
from ..plans import safety as saf
from ..plans import transit as trn
from ..session import scratch_path
from ..sources import scan
from .q_joins import PIP_SQL, SITES_SQL, rings, sites
from .q_network import FUEL, HOURLY, NON_FUEL, RATES, UNIT_COST, hourly, values
from .q_safety import SEGMENT_SQL
from .registry import query

_ONOFF_MODES = [(1, 0.5), (2, 0.25), (3, 1.5)]


@query(
    "stop:i am_dwell:f4 op_dwell:f4 layover:i",
    """
SELECT stop, CASE WHEN route % 4 > 0 THEN (stop % 7) / 10.0 * CASE mode WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 ELSE 1.5 END END AS am_dwell, (stop % 7) / 10.0 * CASE mode WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 ELSE 1.5 END AS op_dwell,
 COALESCE(CASE WHEN stop % 5 = 0 THEN 4 END, 0) AS layover FROM v_onoff""",
)
def trn_dwell_time(t):
    k = F.col("stop")
    stops = t.v_onoff.withColumns(
        {"last_distance": k % 7 / 10.0, "layover": F.when(k % 5 == 0, 4), "am_headway": F.col("route") % 4, "op_headway": F.lit(30)}
    )
    return trn.trn_dwell_time(stops, dict(_ONOFF_MODES), ["am", "op"])


@query(
    "route:i period:s pass_hours:f4 pass_miles:f2 run_time:i route_miles:f2",
    """
SELECT route, period, SUM(CAST(ivtt AS DOUBLE) / 60 * ons) AS pass_hours, SUM((milepost + 1 - milepost) * ons) AS pass_miles, SUM(ivtt) AS run_time, MAX(milepost + 1) - MIN(milepost) AS route_miles FROM v_onoff GROUP BY 1, 2""",
)
def trn_segment_load(t):
    segs = t.v_onoff.select("route", "period", "ivtt", F.col("ons").alias("flow"), F.col("milepost").alias("from_mp"), (F.col("milepost") + 1).alias("to_mp"))
    return trn.trn_segment_load(segs)


@query(
    "route:i mode:i on_AM:i on_PM:i off_OP:i on_total:i off_total:i",
    """
SELECT route, mode, SUM(CASE WHEN period = 'AM' THEN ons ELSE 0 END) AS "on_AM", SUM(CASE WHEN period = 'PM' THEN ons ELSE 0 END) AS "on_PM", SUM(CASE WHEN period = 'OP' THEN offs ELSE 0 END) AS "off_OP",
 SUM(ons) AS on_total, SUM(offs) AS off_total FROM v_onoff GROUP BY 1, 2""",
)
def trn_route_boardings(t):
    return trn.trn_route_boardings(t.v_onoff, ["AM", "PM", "OP"])


@query(
    "period:s trips:f2 boardings:i transfers:f2 rate:f6",
    """
WITH b AS (SELECT period, SUM(ons) AS boardings FROM v_onoff GROUP BY period), q AS (SELECT CASE WHEN deptm >= 360 AND deptm < 540 THEN 'AM' WHEN deptm >= 900 AND deptm < 1080 THEN 'PM' ELSE 'OP' END AS period, SUM(trexpfac) AS trips FROM v_trip WHERE tmode = 6 GROUP BY 1),
 j AS (SELECT q.period, trips, boardings FROM q JOIN b ON b.period = q.period), a AS (SELECT * FROM j UNION ALL SELECT 'TOTAL', SUM(trips), SUM(boardings) FROM j)
SELECT period, trips, boardings, boardings - trips AS transfers, (CAST(boardings AS DOUBLE) / trips - 1) * 100 AS rate FROM a""",
)
def trn_system_stats(t):
    from ..functions.scalar import fn_tod_period

    trips = t.v_trip.filter("tmode = 6").select(fn_tod_period("deptm").alias("period"), F.col("trexpfac").alias("trips"))
    return trn.trn_system_stats(trips, t.v_onoff)


@query(
    "route:i period:s stop:i load:i run_time:i",
    """
SELECT route, period, stop, SUM(ons - offs) OVER (PARTITION BY route, period ORDER BY milepost ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS load, ivtt AS run_time FROM v_onoff""",
)
def trn_stop_profile(t):
    stops = t.v_onoff
    return trn.trn_stop_profile(stops.select("route", "period", "stop", "milepost", "ons", "offs"), stops.select("route", "period", "stop", "ivtt"))


@query(
    "route:i AM:f6 OP:f6 PM:f6",
    """
SELECT route, COALESCE(SUM(CASE WHEN tod = 'AM' THEN m END), 0) AS "AM", COALESCE(SUM(CASE WHEN tod = 'OP' THEN m END), 0) AS "OP", COALESCE(SUM(CASE WHEN tod = 'PM' THEN m END), 0) AS "PM" FROM (
 SELECT route, tod, AVG(s) AS m FROM (SELECT route, survey_date, CASE WHEN start_sec BETWEEN 21600 AND 32400 THEN 'AM' WHEN start_sec BETWEEN 54000 AND 64800 THEN 'PM' ELSE 'OP' END AS tod, SUM(passengers_on) AS s
  FROM v_apc WHERE DAYOFWEEK(survey_date) BETWEEN 2 AND 4 GROUP BY 1, 2, 3) x GROUP BY 1, 2) y GROUP BY route""",
)
def trn_apc_route_tod(t):
    return trn.trn_apc_route_tod(t.v_apc)


def _feed(t):
    """A transit feed seen in the given tables: orders are trips, line items are stop times."""
    k, r = F.col("o_orderkey"), F.col("r_regionkey")
    sec = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 600) % 86400
    clock = F.concat_ws(
        ":", F.lpad(F.floor(sec / 3600).cast("string"), 2, "0"), F.lpad(F.floor(sec % 3600 / 60).cast("string"), 2, "0"), F.lpad((sec % 60).cast("string"), 2, "0")
    )
    days = {d: F.lit(1).alias(d) if i % 2 else (r % 2).alias(d) for i, d in enumerate(trn.DAYS)}
    return {
        "routes": t.supplier.select(F.col("s_suppkey").cast("string").alias("route_id"), F.lit("A").alias("agency_id"), F.col("s_name").alias("route_short_name"), F.col("s_name").alias("route_long_name"), F.lit(3).alias("route_type")),
        "trips": t.orders.select(
            (F.col("o_custkey") % 19).cast("string").alias("route_id"), F.concat(F.lit("S"), (k % 5).cast("string")).alias("service_id"), k.cast("string").alias("trip_id"),
            (F.col("o_custkey") % 40).cast("string").alias("shape_id"), (k % 2).cast("int").alias("direction_id"),
        ),
        "stops": t.v_point.select(F.col("id").cast("string").alias("stop_id"), F.col("label").cast("string").alias("stop_name"), F.col("y").alias("stop_lat"), F.col("x").alias("stop_lon")),
        "stop_times": t.lineitem.select(F.col("l_orderkey").cast("string").alias("trip_id"), clock.alias("arrival_time"), clock.alias("departure_time"), F.col("l_suppkey").cast("string").alias("stop_id"), F.col("l_linenumber").alias("stop_sequence")),
        "calendar": t.region.select(F.concat(F.lit("S"), r.cast("string")).alias("service_id"), *days.values(), F.lit("20190815").alias("start_date"), F.lit("20191231").alias("end_date")),
        "calendar_dates": t.nation.select(
            F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("service_id"),
            F.when(F.col("n_nationkey") < 2, "20191016").otherwise("20191225").alias("date"),
            (F.col("n_nationkey") % 2 + 1).cast("int").alias("exception_type"),
        ),
    }


_SEC = "((l_partkey * 37 + l_linenumber * 600) % 86400)"


@query(
    "tod:s route_id:s direction_id:i shape_id:s n_trips:i",
    f"""
SELECT tod, CAST(o_custkey % 19 AS VARCHAR) AS route_id, o_orderkey % 2 AS direction_id, CAST(o_custkey % 40 AS VARCHAR) AS shape_id, COUNT(*) AS n_trips FROM (
 SELECT o.*, CASE WHEN d BETWEEN 21600 AND 32399 THEN 'AM' WHEN d BETWEEN 32400 AND 53999 THEN 'MD' WHEN d BETWEEN 54000 AND 64799 THEN 'PM' END AS tod
 FROM orders o JOIN (SELECT l_orderkey, MIN({_SEC}) AS d FROM lineitem GROUP BY 1) f ON f.l_orderkey = o.o_orderkey WHERE o_orderkey % 5 IN (0, 2, 3, 4)) x WHERE tod IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def trn_gtfs_service_trips(t):
    # Wednesday 16 October 2019: all services run by weekday; S0 is also added and S1 removed.
    return trn.trn_gtfs_service_trips(_feed(t), "20191016")


@query(
    "name:s n:i",
    """
SELECT 'routes' AS name, COUNT(*) AS n FROM supplier UNION ALL SELECT 'trips', COUNT(*) FROM orders UNION ALL SELECT 'stops', COUNT(*) FROM embeddings UNION ALL SELECT 'stop_times', COUNT(*) FROM lineitem
UNION ALL SELECT 'calendar', COUNT(*) FROM region UNION ALL SELECT 'calendar_dates', COUNT(*) FROM nation""",
)
def scan_gtfs(t):
    folder = scratch_path(t.spark, "feed")
    for name, df in _feed(t).items():
        df.write.csv(os.path.join(folder, f"{name}.txt"), header=True)
    out = None
    for name, df in scan.scan_gtfs(t.spark, folder).items():
        part = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "o:i d:i period:i ivt:f2 wait:f2 fare:f2",
    """
SELECT o, d, period, CASE WHEN u THEN imp ELSE 0 END AS ivt, CASE WHEN u AND period <> 2 THEN imp * 2 ELSE 0 END AS wait, CASE WHEN u THEN 150 ELSE 0 END AS fare
FROM (SELECT *, (o + d) % 4 > 0 AS u FROM v_skim) x""",
)
def trn_skim_clean(t):
    k = (F.col("o") + F.col("d")) % 4
    wide = t.v_skim.withColumns(
        {"ivt": F.col("imp"), "wait": F.when(F.col("period") != 2, F.col("imp") * 2), "fare": F.lit(1.5), "bus_time": F.when(k == 0, F.lit(0)).otherwise(F.col("imp"))}
    )
    return trn.trn_skim_clean(wide, ["ivt", "wait", "fare"], "bus_time", "fare")


@query(
    "id:i flow:s base_time:f6 walk_link:i walk_time:f6 ttf:i transit_time:f6",
    """
SELECT id, flow, bt AS base_time, CASE WHEN iw = 1 THEN 98 ELSE 250 END AS walk_link, CASE WHEN iw = 1 THEN length * 20 ELSE 99999 END AS walk_time, ttf,
 CASE ttf WHEN 3 THEN length * 3 WHEN 2 THEN bt * 1.25 ELSE bt * 1.5 END AS transit_time FROM (
 SELECT *, CASE WHEN id % 13 = 0 THEN length * 60 / 25 ELSE fftime END AS bt, id % 2 AS iw, CASE WHEN id % 31 = 0 THEN 3 WHEN fc <= 2 OR ramp = 1 THEN 2 ELSE 1 END AS ttf FROM v_dlink) x""",
)
def trn_link_times(t):
    k = F.col("id")
    links = t.v_dlink.withColumns({"afftime": F.when(k % 13 != 0, F.col("fftime")), "in_walk": k % 2, "in_transit": (k % 31 == 0).cast("int")})
    return trn.trn_link_times(links, 3.0, {1: 1.5, 2: 1.25}, 20.0)


@query(
    "tmode:i trips:i mean_time:f6",
    "SELECT tmode, COUNT(*) AS trips, AVG(CASE WHEN pagey BETWEEN 20 AND 74 THEN travdist END) AS mean_time FROM v_trip t LEFT JOIN v_person p ON p.hhno = t.hhno AND p.pno = t.pno GROUP BY tmode",
)
def rep_active_travel(t):
    return trn.rep_active_travel(t.v_trip, t.v_person, minutes="travdist")


_REP = [("All", "All", "id >= 0"), ("Class", "freeway", "fc IN (1, 11, 12)"), ("Access", "full", "access = 3"), ("Area", "urban", "fc > 10"), ("None", "none", "fc = 99")]
_REP_MEASURES = ["vmt_car", "vmt_su", "vmt_mu", "delay_hours"]


@query(
    "kind:s item:s links:i miles:f4 lane_miles:f4 vmt:f2 vht:f2 vmt_car:f2 vmt_su:f2 vmt_mu:f2 delay_hours:f2 speed:f6 wtd_vc:f6 max_vc:f6",
    f"WITH l AS (SELECT id, flow, MAX(fc) AS fc, MAX(access) AS access, MAX(length) AS length, MAX(lanes) AS lanes, SUM(vmt) AS vmt, SUM(vht) AS vht, SUM(vmt_car) AS vmt_car, SUM(vmt_su) AS vmt_su, SUM(vmt_mu) AS vmt_mu, SUM(delay_hours) AS delay_hours, MAX(vc) AS vc FROM {HOURLY} x GROUP BY id, flow)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{k}' AS kind, '{i}' AS item, COUNT(*) AS links, COALESCE(SUM(length), 0) AS miles, COALESCE(SUM(length * lanes), 0) AS lane_miles, COALESCE(SUM(vmt), 0) AS vmt, COALESCE(SUM(vht), 0) AS vht, COALESCE(SUM(vmt_car), 0) AS vmt_car, COALESCE(SUM(vmt_su), 0) AS vmt_su, COALESCE(SUM(vmt_mu), 0) AS vmt_mu, COALESCE(SUM(delay_hours), 0) AS delay_hours, COALESCE(SUM(vmt) / SUM(vht), 0) AS speed, COALESCE(SUM(vmt * vc) / SUM(vmt), 0) AS wtd_vc, COALESCE(MAX(vc), 0) AS max_vc FROM l WHERE {p}"
        for k, i, p in _REP
    ),
)
def rep_network_summary(t):
    sums = [F.sum(c).alias(c) for c in ("vmt", "vht", *_REP_MEASURES)]
    firsts = [F.max(c).alias(c) for c in ("fc", "access", "length", "lanes", "vc")]
    links = hourly(t).groupBy("id", "flow").agg(*sums, *firsts)
    return mov.rep_network_summary(links, [(k, i, F.expr(p)) for k, i, p in _REP], _REP_MEASURES)


_ITEMS = [
    ("All", "All links", "id >= 0"), ("SEP", "By class", None), ("Class", "Freeways", "fc IN (1, 11, 12)"), ("Class", "Arterials", "fc IN (2, 6, 14, 16)"), ("Class", "Collectors", "fc IN (7, 8, 17)"),
    ("Class", "Local", "fc IN (9, 19)"), ("SEP", "By access", None), ("Access", "Full", "access = 3"), ("Area", "Urban", "fc > 10"), ("Area", "Rural", "fc <= 10"), ("Ramp", "Ramps", "ramp = 1"), ("None", "None", "fc = 99"),
]


def _report_sql():
    """The report as SQL: links selected by each item, joined with their sums and, by speed, with the rates."""
    kept = [(i, k, n, p) for i, (k, n, p) in enumerate(_ITEMS) if p]
    chosen = " UNION ALL ".join(f"SELECT {i} AS pos, id FROM l WHERE {p}" for i, _, _, p in kept)
    spec = ", ".join(f"({i}, '{k}', '{n}', {1 if p is None else 0})" for i, (k, n, p) in enumerate(_ITEMS))
    of = {"car": ("car",), "su": ("su",), "mu": ("mu",), "trk": ("su", "mu")}

    def add(m, c):
        return " + ".join(f"{m}_{p}" for p in of[c])

    hour = {"vht": "vol_{c} * time / 60", "delay": "lost * vol_{c} / 60", "vmt": "vmt_{c}"}
    link = ", ".join(f"SUM({e.format(c=c)}) AS {m}_{c}" for m, e in hour.items() for c in ("car", "su", "mu"))
    speed = " UNION ALL ".join(f"SELECT id, '{c}' AS cls, speed_row AS speed, SUM({add('vmt', c)}) AS vmt, SUM({add('vol', c)}) AS vol FROM h GROUP BY id, speed_row" for c in of)
    sums = [f"SUM({add(m, c)}) AS {m}_{c}" for m in ("vmt", "vht", "delay") for c in of]
    crashes = [f"SUM({c}) AS {c}" for c in ("fatal", "injury", "pdo")]
    burnt = [f"SUM(CASE WHEN cls = '{c}' AND measure = '{m}' THEN value END) AS {m}_{c}" for m in ("fuel", "non_fuel") for c in of]
    burnt += [f"SUM(CASE WHEN cls = '{c}' AND measure = '{p}' AND kind = '{k}' THEN value END) AS {p}_{k}_{c}" for c in of for p in UNIT_COST for k in ("running", "start")]
    cols = ", ".join(f"CASE WHEN s.blank = 0 THEN COALESCE({n}, 0) END AS {n}" for n in rep.report_columns())
    return f"""
WITH h AS (SELECT * FROM {HOURLY} x WHERE fc > 0 AND fc < 95), c AS ({SEGMENT_SQL}),
 l AS (SELECT l0.*, fatal, injury, pdo FROM (SELECT id, MAX(fc) AS fc, MAX(access) AS access, MAX(ramp) AS ramp, MAX(length) AS length, MAX(vc) AS top, {link} FROM h GROUP BY id) l0 LEFT JOIN c ON c.id = l0.id),
 q AS ({chosen}), v AS ({speed}), r AS (SELECT * FROM {RATES} q0),
 u AS (SELECT measure, CAST(1.10231131e-6 AS DOUBLE) * cost AS unit FROM {values("measure", "cost", UNIT_COST)} x), f AS (SELECT cls, price FROM {values("cls", "price", FUEL)} x), n AS (SELECT cls, cost FROM {values("cls", "cost", NON_FUEL)} x),
 b AS (SELECT pos, cls, speed, SUM(vmt) AS vmt, SUM(vol) AS vol FROM q JOIN v ON v.id = q.id GROUP BY 1, 2, 3),
 a AS (SELECT b.pos, b.cls, b.speed, r.measure, b.vmt * ARG_MAX(r.rate, r.speed) AS amount FROM b JOIN r ON r.cls = b.cls AND r.speed <= b.speed GROUP BY b.pos, b.cls, b.speed, r.measure, b.vmt),
 e AS (SELECT pos, a.cls, a.measure, 'running' AS kind, amount * unit AS value FROM a JOIN u ON u.measure = a.measure UNION ALL SELECT pos, a.cls, 'fuel', 'running', amount * price FROM a JOIN f ON f.cls = a.cls WHERE measure = 'fuel'
  UNION ALL SELECT pos, b.cls, 'non_fuel', 'running', vmt * cost FROM b JOIN n ON n.cls = b.cls
  UNION ALL SELECT pos, b.cls, z.measure, 'start', b.vol * z.rate * u.unit FROM b JOIN (SELECT cls, measure, ARG_MIN(rate, speed) AS rate FROM r GROUP BY 1, 2) z ON z.cls = b.cls JOIN u ON u.measure = z.measure),
 w AS (SELECT pos, {', '.join(burnt)} FROM e GROUP BY pos),
 m AS (SELECT pos, COUNT(*) AS links, SUM(length) AS miles, SUM(top * (vmt_car + vmt_su + vmt_mu)) / SUM(vmt_car + vmt_su + vmt_mu) AS vc, SUM(vmt_car + vmt_su + vmt_mu) AS vmt, SUM(vht_car + vht_su + vht_mu) AS vht,
  {', '.join(sums + crashes)}, COALESCE(SUM(fatal), 0) + COALESCE(SUM(injury), 0) + COALESCE(SUM(pdo), 0) AS crashes FROM q JOIN l ON l.id = q.id GROUP BY pos)
SELECT s.pos, s.kind, s.item, {cols} FROM (SELECT * FROM (VALUES {spec}) AS s0(pos, kind, item, blank)) s LEFT JOIN m ON m.pos = s.pos LEFT JOIN w ON w.pos = s.pos"""


_LARGE = ("vmt", "vht", "delay", "fuel")  # sums whose last digits depend on the order of adding


@query("pos:i kind:s item:s links:i vc:f6 " + " ".join(f"{n}:{'f1' if n.startswith(_LARGE) else 'f3'}" for n in rep.report_columns()[2:]), _report_sql())
def rep_network_report(t):
    crashes = saf.saf_segment_crashes(t.v_saf).select("id", "fatal", "injury", "pdo")
    hours = hwy.hwy_hourly_profile(t.v_dlink.join(crashes, "id", "left"), t.v_profile)
    items = [(k, n, F.expr(p) if p else None) for k, n, p in _ITEMS]
    return rep.rep_network_report(hours, items, t.sql(f"SELECT * FROM {RATES} q"), UNIT_COST | {"fuel": FUEL}, NON_FUEL)


@query(
    "core:s vmt:f2",
    """
SELECT core, SUM(trips * miles * CASE WHEN core = 'car' THEN 1 WHEN o < 20 AND d < 20 THEN 1 WHEN o >= 20 AND d >= 20 THEN 0 ELSE 0.5 END) AS vmt FROM (
 SELECT v.o, v.d, CASE core % 3 WHEN 0 THEN 'car' WHEN 1 THEN 'su' ELSE 'mu' END AS core, trips, miles FROM v_od v JOIN (SELECT o, d, AVG(imp) AS miles FROM v_skim GROUP BY o, d) s ON s.o = v.o AND s.d = v.d) x GROUP BY core""",
)
def mov_county_vmt(t):
    """Daily trips travel the mean distance of the periods."""
    core = F.when(F.col("core") % 3 == 0, "car").when(F.col("core") % 3 == 1, "su").otherwise("mu")
    skim = t.v_skim.groupBy("o", "d").agg(F.avg("imp").alias("miles"))
    return mov.mov_county_vmt(t.v_od.withColumn("core", core), skim, lambda zone: zone >= 20)


_RT = "CASE WHEN ramp > 0 THEN CASE WHEN fcarea + 2 < 4 THEN 4 ELSE 2 END WHEN fc < 10 THEN CASE WHEN fc = 1 OR access = 3 THEN 2 ELSE 3 END ELSE CASE WHEN fc = 11 OR access = 3 THEN 4 ELSE 5 END END"


def _road_type():
    return fn_road_type("fc", "ramp", "access", F.col("fcarea") + 2)


def _class_vmt(t):
    day = {c: sum((F.coalesce(F.col(f"{p}_{c}"), F.lit(0)) for p in ("am", "pm", "op")), F.lit(0)) for c in ("car", "su", "mu")}
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("cls"), vol.alias("vol")) for c, vol in day.items()]))
    links = t.v_dlink.withColumns({"road_type": _road_type(), "speed_limit": (25 + 5 * (F.col("id") % 10)).cast("int")})
    return links.select("id", "fc", "ramp", "road_type", "speed_limit", "length", parts.alias("p")).select(
        "id", "fc", "ramp", "road_type", "speed_limit", "p.cls", (F.col("p.vol") * F.col("length")).alias("vmt")
    )


_CLS = f"(SELECT id, fc, ramp, {_RT} AS road_type, 25 + 5 * (id % 10) AS speed_limit, cls, vol * length AS vmt FROM (SELECT *, 'car' AS cls, am_car + pm_car + op_car AS vol FROM v_dlink UNION ALL SELECT *, 'su', am_su + pm_su + op_su FROM v_dlink UNION ALL SELECT *, 'mu', am_mu + pm_mu + op_mu FROM v_dlink) x)"
_DEFAULTS = ", ".join(f"({s}, {i + 1}, CAST({v} AS DOUBLE))" for s, vs in mov.DEFAULT_ROAD_TYPES.items() for i, v in enumerate(vs))


@query(
    "source:i road_type:i share:f8",
    f"""
WITH c AS (SELECT cls, road_type, SUM(vmt) AS vmt FROM {_CLS} q GROUP BY 1, 2), s AS (SELECT cls, road_type, vmt / SUM(vmt) OVER (PARTITION BY cls) AS share FROM c),
 g AS (SELECT k.source, k.cls, r.rt FROM (SELECT * FROM (VALUES (11, 'car'), (21, 'car'), (31, 'car'), (61, 'mu'), (62, 'mu')) AS k(source, cls)) k CROSS JOIN (SELECT UNNEST(RANGE(1, 6)) AS rt) r)
SELECT g.source, g.rt AS road_type, COALESCE(s.share, 0) AS share FROM g LEFT JOIN s ON s.cls = g.cls AND s.road_type = g.rt UNION ALL SELECT * FROM (VALUES {_DEFAULTS}) AS d(a, b, c)""",
)
def mov_road_type_dist(t):
    return mov.mov_road_type_dist(_class_vmt(t))


_POP = ", ".join(f"({s}, '{mov.GROWS_WITH[s]}', CAST({v} AS DOUBLE))" for s, v in mov.BASE_POPULATION.items())


@query(
    "source:i population:i",
    f"""
WITH g AS (SELECT 'vehicles' AS driver, SUM(hhvehs) / CAST(278689 AS DOUBLE) AS growth FROM v_household UNION ALL SELECT 'people', CAST(1.07 AS DOUBLE)
 UNION ALL SELECT core, SUM(trips) / CAST(CASE core WHEN 'commercial' THEN 17166.42 WHEN 'su' THEN 32758.49 ELSE 1741.19 END AS DOUBLE) FROM (SELECT CASE core % 3 WHEN 0 THEN 'commercial' WHEN 1 THEN 'su' ELSE 'mu' END AS core, trips FROM v_od) x GROUP BY core)
SELECT source, CAST(ROUND(base * growth) AS BIGINT) AS population FROM (SELECT * FROM (VALUES {_POP}) AS p(source, driver, base)) p JOIN g ON g.driver = p.driver""",
)
def mov_source_population(t):
    core = F.when(F.col("core") % 3 == 0, "commercial").when(F.col("core") % 3 == 1, "su").otherwise("mu")
    return mov.mov_source_population(t.v_household, t.v_od.withColumn("core", core), 1.07)


@query(
    "road_type:i hour:i fraction:f8",
    """
WITH c AS (SELECT otaz AS o, dtaz AS d, CAST(FLOOR(deptm / 60.0) AS INT) + 1 AS hour, SUM(trexpfac) AS trips FROM v_trip GROUP BY 1, 2, 3),
 h AS (SELECT period + 1 AS road_type, hour, SUM(trips * imp) AS v FROM c JOIN v_skim s ON s.o = c.o AND s.d = c.d GROUP BY 1, 2), m AS (SELECT road_type, hour, CAST(v AS DOUBLE) / SUM(v) OVER (PARTITION BY road_type) AS mine FROM h),
 p AS (SELECT hour, CAST(SUM(n) AS DOUBLE) AS n FROM v_hour_profile GROUP BY hour), f AS (SELECT r.rt, hour, n / SUM(n) OVER (PARTITION BY r.rt) AS share FROM p CROSS JOIN (SELECT UNNEST(RANGE(2, 5)) AS rt) r)
SELECT f.rt AS road_type, f.hour, (share + COALESCE(mine, 0)) / 2 AS fraction FROM f LEFT JOIN m ON m.road_type = f.rt AND m.hour = f.hour""",
)
def mov_hour_vmt_fraction(t):
    trips = t.v_trip.select(F.col("otaz").alias("o"), F.col("dtaz").alias("d"), (F.floor(F.col("deptm") / 60.0) + 1).cast("int").alias("hour"), F.col("trexpfac").alias("trips"))
    skim = t.v_skim.select("o", "d", (F.col("period") + 1).alias("road_type"), F.col("imp").alias("miles"))
    per_hour = t.v_hour_profile.groupBy("hour").agg(F.sum("n").cast("double").alias("n"))
    whole = per_hour.agg(F.sum("n")).scalar()
    types = F.explode(F.array(*[F.lit(r) for r in (2, 3, 4)])).alias("road_type")
    default = per_hour.select("hour", (F.col("n") / whole).alias("share"), types)
    return mov.mov_hour_vmt_fraction(trips, skim, default)


_SPEEDS = f"(SELECT cls, {_RT} AS road_type, ramp, hour, speed, vol0 * time / 60 AS vht FROM (SELECT *, 'car' AS cls, vol_car AS vol0 FROM {HOURLY} a UNION ALL SELECT *, 'su', vol_su FROM {HOURLY} b UNION ALL SELECT *, 'mu', vol_mu FROM {HOURLY} c) z)"


@query(
    "cls:s road_type:i hour:i bin:i share:f8",
    f"""
WITH v AS (SELECT cls, road_type, hour, CASE WHEN speed < 2.5 THEN 1 WHEN speed >= 72.5 THEN 16 ELSE CAST(FLOOR((speed - 2.5) / 5) AS INT) + 2 END AS bin, SUM(vht) AS vht FROM {_SPEEDS} s WHERE ramp = 0 GROUP BY 1, 2, 3, 4),
 w AS (SELECT *, vht / GREATEST(SUM(vht) OVER (PARTITION BY cls, road_type, hour), 1) AS share FROM v),
 g AS (SELECT * FROM (SELECT UNNEST(['car', 'su', 'mu']) AS cls) a CROSS JOIN (SELECT UNNEST(RANGE(2, 6)) AS road_type) b CROSS JOIN (SELECT UNNEST(RANGE(1, 25)) AS hour) c CROSS JOIN (SELECT UNNEST(RANGE(1, 17)) AS bin) d)
SELECT g.cls, g.road_type, g.hour, g.bin, COALESCE(share, 0) AS share FROM g LEFT JOIN w ON w.cls = g.cls AND w.road_type = g.road_type AND w.hour = g.hour AND w.bin = g.bin""",
)
def mov_speed_distribution(t):
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("cls"), (F.col(f"vol_{c}") * F.col("time") / 60).alias("vht")) for c in ("car", "su", "mu")]))
    long = hourly(t).withColumn("road_type", _road_type()).select("road_type", "ramp", "hour", "speed", parts.alias("p"))
    return mov.mov_speed_distribution(long.select("p.cls", "road_type", "ramp", "hour", "speed", "p.vht"))


@query(
    "road_type:i fraction:f8",
    f"SELECT road_type, SUM(CASE WHEN ramp = 1 AND speed_limit <= 50 THEN vmt ELSE 0 END) / SUM(vmt) AS fraction FROM {_CLS} q WHERE road_type IN (2, 4) GROUP BY road_type",
)
def mov_ramp_fraction(t):
    return mov.mov_ramp_fraction(_class_vmt(t))


@query(
    "hpms:i vmt:f1",
    f"""
WITH s AS (SELECT cls, ROUND(SUM(CASE WHEN fc IN (1, 2) THEN vmt ELSE 0 END), 1) AS f, ROUND(SUM(CASE WHEN fc IN (1, 2) THEN 0 ELSE vmt END), 1) AS o FROM {_CLS} q GROUP BY cls)
SELECT 10 AS hpms, (f + o * 1.5) * 342 * ROUND(20468573.0 / (20468573 + 3379781269), 5) AS vmt FROM s WHERE cls = 'car' UNION ALL SELECT 25, (f + o * 1.5) * 342 * ROUND(3379781269.0 / (20468573 + 3379781269), 5) FROM s WHERE cls = 'car'
UNION ALL SELECT 40, ROUND(2845725 * 1.07, 1) UNION ALL SELECT 50, 73157979 * (f + o) / 340106 FROM s WHERE cls = 'su' UNION ALL SELECT 60, 247042469 * (f + o) / 687994 FROM s WHERE cls = 'mu'""",
)
def mov_hpms_vmt(t):
    return mov.mov_hpms_vmt(_class_vmt(t), 1.07)


_DECAY = "SUM(label * CASE WHEN dd <= {r} THEN {w} ELSE 0 END)"


@query(
    "id:i label_flat:f6 label_soft:f6 label_exp:f6",
    f"""
WITH c AS (SELECT FLOOR(x / 0.02) AS cx, FLOOR(y / 0.02) AS cy, SUM(label) AS label FROM v_point GROUP BY 1, 2),
 p AS (SELECT a.cx, a.cy, b.label, SQRT((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)) * 0.02 AS dd FROM c a, c b),
 s AS (SELECT cx, cy, {_DECAY.format(r=0.05, w='1')} AS label_flat, {_DECAY.format(r=0.05, w='1 / (1 + EXP(dd / 0.05 - 0.5))')} AS label_soft, {_DECAY.format(r=0.1, w='EXP(-dd / 0.1)')} AS label_exp FROM p WHERE dd <= 0.1 GROUP BY cx, cy)
SELECT v.id, s.label_flat, s.label_soft, s.label_exp FROM v_point v JOIN s ON s.cx = FLOOR(v.x / 0.02) AND s.cy = FLOOR(v.y / 0.02)""",
)
def spa_buffer_decay(t):
    buffers = [("flat", 0.05, "flat"), ("soft", 0.05, "logistic"), ("exp", 0.1, "exponential")]
    return spatial.spa_buffer_decay(t.v_point, "id", 0.02, buffers, {"label": F.col("label")})


@query(
    "id:i pid:i units:i",
    f"""
WITH s AS ({SITES_SQL}), p AS ({PIP_SQL}), n AS (SELECT id, ARG_MIN(site, dd) AS site FROM (SELECT DISTINCT p.id, s.site, SQRT((s.x - p.x) * (s.x - p.x) + (s.y - p.y) * (s.y - p.y)) AS dd FROM p, s) q GROUP BY id),
 m AS (SELECT p.id, p.pid, EXP(-0.5 * 2 * 3956 * ASIN(SQRT(POW(SIN(RADIANS(s.y - p.y) / 2), 2) + COS(RADIANS(p.y)) * COS(RADIANS(s.y)) * POW(SIN(RADIANS(s.x - p.x) / 2), 2)))) AS u FROM p JOIN n ON n.id = p.id JOIN s ON s.site = n.site),
 q AS (SELECT id, pid, t.total * u / SUM(u) OVER (PARTITION BY pid) AS part FROM m JOIN (SELECT l_linenumber AS tp, CAST(SUM(l_quantity) AS BIGINT) AS total FROM lineitem GROUP BY 1) t ON t.tp = pid)
SELECT id, pid, CAST(FLOOR(part) AS BIGINT) + CASE WHEN ROW_NUMBER() OVER (PARTITION BY pid ORDER BY part - FLOOR(part) DESC, id) <= ROUND(SUM(part) OVER (PARTITION BY pid) - SUM(FLOOR(part)) OVER (PARTITION BY pid)) THEN 1 ELSE 0 END AS units FROM q
UNION ALL SELECT NULL, l_linenumber, CAST(SUM(l_quantity) AS BIGINT) FROM lineitem WHERE l_linenumber NOT IN (SELECT pid FROM p) GROUP BY l_linenumber""",
)
def spa_dasymetric(t):
    totals = t.lineitem.groupBy(F.col("l_linenumber").alias("pid")).agg(F.sum("l_quantity").cast("bigint").alias("total"))
    return spatial.spa_dasymetric(t.v_point.select("id", "x", "y"), rings(t.spark), sites(t), totals, "id", 0.05)
