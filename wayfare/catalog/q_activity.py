"""Driver forms: activity summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..plans import activity as act
from .registry import query

PERSON = """(SELECT p.hhno, p.pno, p.pptyp, p.psexpfac, z.district AS hhdistrict,
  CASE WHEN h.hhincome < 0 THEN 0 WHEN h.hhincome < 15000 THEN 1 WHEN h.hhincome < 50000 THEN 2 WHEN h.hhincome < 75000 THEN 3 ELSE 4 END AS inccat,
  CASE WHEN h.hhvehs = 0 THEN 1 WHEN h.hhvehs < d.drivers THEN 2 WHEN h.hhvehs = d.drivers THEN 3 ELSE 4 END AS vehsuf
 FROM v_person p JOIN v_household h ON h.hhno = p.hhno LEFT JOIN v_zone z ON z.taz = h.hhtaz
 JOIN (SELECT hhno, LEAST(SUM(CASE WHEN pagey >= 16 THEN 1 ELSE 0 END), 4) AS drivers FROM v_person GROUP BY hhno) d ON d.hhno = h.hhno)"""


def people(t):
    return act.person_attributes(t.v_household, t.v_person, t.v_zone)


@query(
    "vehcat:i inccat:i value:i",
    """
SELECT g.vehcat, i.inccat, COALESCE(v, 0) AS value FROM (SELECT UNNEST(RANGE(0, 5)) AS vehcat) g CROSS JOIN (SELECT UNNEST(RANGE(1, 5)) AS inccat) i LEFT JOIN
 (SELECT LEAST(hhvehs, 4) AS vehcat, CASE WHEN hhincome < 15000 THEN 1 WHEN hhincome < 50000 THEN 2 WHEN hhincome < 75000 THEN 3 ELSE 4 END AS inccat, SUM(hhexpfac) AS v
  FROM v_household h WHERE hhno IN (SELECT hhno FROM v_person) GROUP BY 1, 2) a ON a.vehcat = g.vehcat AND a.inccat = i.inccat""",
)
def act_vehicle_availability(t):
    hh = act.act_vehicle_availability(t.v_household, t.v_person, t.v_zone)
    return act.act_summary(hh, "vehcat", (0, 4), "inccat", (1, 4), "hhexpfac")


@query(
    "place_district:i hhdistrict:i active:i out_of_home:i at_home:i value:i dist:i far:i",
    """
SELECT place_district, hhdistrict, active, out_of_home, at_home, SUM(psexpfac) AS value, SUM(dist) AS dist, SUM(CASE WHEN band = 91 THEN 1 ELSE 0 END) AS far FROM (
 SELECT p.psexpfac, CASE WHEN pwtaz < 0 THEN 13 ELSE w.district END AS place_district, z.district AS hhdistrict, CASE WHEN pwtyp > 0 AND pwtaz <> 0 THEN 1 ELSE 0 END AS active,
  CASE WHEN pwtaz > 0 AND hhparcel <> pwpcl THEN 1 ELSE 0 END AS out_of_home, CASE WHEN pwtyp > 0 AND pwtaz <> 0 AND hhparcel = pwpcl THEN 1 ELSE 0 END AS at_home,
  CASE WHEN pwaudist >= 0 THEN pwaudist END AS dist, CASE WHEN pwtaz < 0 THEN 91 ELSE LEAST(pwaudist + 1, 90) END AS band
 FROM v_person p LEFT JOIN v_household h ON h.hhno = p.hhno LEFT JOIN v_zone z ON z.taz = h.hhtaz LEFT JOIN v_zone w ON w.taz = p.pwtaz) x GROUP BY 1, 2, 3, 4, 5""",
)
def act_work_school_location(t):
    p = act.act_work_school_location(t.v_person, t.v_household, t.v_zone)
    far = F.sum((F.col("distcat") == act.OUTSIDE_BAND).cast("int")).alias("far")
    keys = ["place_district", "hhdistrict", "active", "out_of_home", "at_home"]
    return p.groupBy(*keys).agg(F.sum("psexpfac").alias("value"), F.sum("dist").alias("dist"), far)


_LOCATION_TEMPLATES = [
    *act.location_templates("work", ("survey", "model"), 4, smooth=True),
    *act.location_templates("school", ("survey", "model"), 4, first=101),
]


def _located(persons):
    def place(tag, p, active, kinds):
        taz, home = f"{p}taz", f"hhparcel = {p}pcl"
        on = f"({active}) AND {taz} <> 0"
        bands = ", ".join(
            f"CASE WHEN {taz} < 0 THEN 91 WHEN {p}au{m} < 0 THEN 0 ELSE LEAST({p}au{m} + 1, 90) END AS {tag}_{m}cat, CASE WHEN {p}au{m} >= 0 THEN {p}au{m} END AS {tag}_{m}" for m in ("dist", "time")
        )
        return f"""CASE WHEN {on} THEN 1 ELSE 0 END AS {tag}_active, CASE WHEN {on} AND {home} THEN 1 ELSE 0 END AS {tag}_at_home, {bands},
 list_extract([{', '.join(map(str, kinds.values()))}], pptyp) AS {tag}_place_type"""

    return f"""(SELECT p.psexpfac, hz.district AS hhdistrict, CASE WHEN pwtaz < 0 THEN 13 ELSE wz.district END AS wrk_district, CASE WHEN pstaz < 0 THEN 13 ELSE sz.district END AS sch_district,
 {place('wrk', 'pw', 'pwtyp > 0', act.WORKER_TYPE)}, {place('sch', 'ps', 'pptyp BETWEEN 5 AND 7', act.STUDENT_TYPE)}
 FROM {persons} p LEFT JOIN v_household h ON h.hhno = p.hhno LEFT JOIN v_zone hz ON hz.taz = hhtaz LEFT JOIN v_zone wz ON wz.taz = pwtaz LEFT JOIN v_zone sz ON sz.taz = pstaz)"""


def _template_sql(t):
    base, test = f"s_{t.data}", f"{t.subset[0]} = {t.subset[2]}"
    if t.fun == "mean":
        both = f"{t.x} IS NOT NULL AND {t.weight} IS NOT NULL"
        mean = f"SUM(CASE WHEN {both} THEN {t.x} * {t.weight} END) * 1.0 / SUM(CASE WHEN {both} THEN {t.weight} END)"
        low, high = t.y_range
        return f"SELECT {t.outnum} AS outnum, 0 AS x, {t.y} AS y, {mean} AS value FROM {base} WHERE {test} AND {t.y} BETWEEN {low} AND {high} GROUP BY {t.y} UNION ALL SELECT {t.outnum}, 0, {high + 1}, {mean} FROM {base} WHERE {test}"
    (a, b), (c, d) = t.x_range, t.y_range
    cells = f"""SELECT g.x, h.y, CAST(COALESCE(v, 0) AS DOUBLE) AS v FROM (SELECT UNNEST(RANGE({a}, {b + 1})) AS x) g CROSS JOIN (SELECT UNNEST(RANGE({c}, {d + 1})) AS y) h
 LEFT JOIN (SELECT {t.x} AS x, {t.y} AS y, SUM({t.weight}) AS v FROM {base} WHERE {test} GROUP BY 1, 2) k ON k.x = g.x AND k.y = h.y"""
    win = "OVER (PARTITION BY y ORDER BY x)"
    for _ in range(10 if t.smooth else 0):
        cells = f"SELECT x, y, COALESCE(0.25 * LAG(v) {win} + 0.5 * v + 0.25 * LEAD(v) {win}, v) AS v FROM ({cells}) n"
    return f"SELECT {t.outnum} AS outnum, x, y, v AS value FROM ({cells}) m"


@query(
    "outnum:i x:i y:i value:f6",
    f"WITH s_survey AS (SELECT * FROM {_located('v_surveyed')} a), s_model AS (SELECT * FROM {_located('v_person_place')} b)\n" + "\nUNION ALL ".join(_template_sql(t) for t in _LOCATION_TEMPLATES),
)
def act_location_tables(t):
    """Work and school places, surveyed (orders) beside modelled persons, through stored templates; work bands smoothed."""
    sides = {side: act.act_location_persons(p, t.v_household, t.v_zone) for side, p in (("survey", t.v_surveyed), ("model", t.v_person_place))}
    return agg.agg_template_summaries(sides, _LOCATION_TEMPLATES)


@query(
    "place_district:i hhdistrict:i place_type:i active:i out_of_home:i at_home:i value:i dist:i time:i far:i",
    """
SELECT CASE WHEN pstaz < 0 THEN 13 ELSE w.district END AS place_district, z.district AS hhdistrict, CASE WHEN pptyp < 5 OR pptyp = 8 THEN 4 ELSE 8 - pptyp END AS place_type,
 CASE WHEN pptyp BETWEEN 5 AND 7 AND pstaz <> 0 THEN 1 ELSE 0 END AS active, CASE WHEN pstaz > 0 AND hhparcel <> pspcl THEN 1 ELSE 0 END AS out_of_home,
 CASE WHEN pptyp BETWEEN 5 AND 7 AND pstaz <> 0 AND hhparcel = pspcl THEN 1 ELSE 0 END AS at_home, SUM(psexpfac) AS value, SUM(CASE WHEN psaudist >= 0 THEN psaudist END) AS dist,
 SUM(CASE WHEN psautime >= 0 THEN psautime END) AS time, SUM(CASE WHEN pstaz < 0 OR psautime + 1 > 90 THEN 1 ELSE 0 END) AS far
FROM v_person_place p LEFT JOIN v_household h ON h.hhno = p.hhno LEFT JOIN v_zone z ON z.taz = h.hhtaz LEFT JOIN v_zone w ON w.taz = p.pstaz GROUP BY 1, 2, 3, 4, 5, 6""",
)
def act_school_location(t):
    p = act.act_work_school_location(t.v_person_place, t.v_household, t.v_zone, "school")
    far = F.sum(((F.col("timecat") == act.OUTSIDE_BAND) | (F.col("psautime") + 1 > 90)).cast("int")).alias("far")
    keys = ["place_district", "hhdistrict", "place_type", "active", "out_of_home", "at_home"]
    return p.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in (("value", "psexpfac"), ("dist", "dist"), ("time", "time"))], far)


@query(
    "hhno:i drivers:i vehsuf:i",
    """
SELECT h.hhno, drivers, CASE WHEN hhvehs = 0 THEN 1 WHEN hhvehs < drivers THEN 2 WHEN hhvehs = drivers THEN 3 ELSE 4 END AS vehsuf FROM v_household h
JOIN (SELECT hhno, LEAST(SUM(CASE WHEN pagey >= 16 THEN 1 ELSE 0 END), 4) AS drivers FROM v_person GROUP BY hhno) d ON d.hhno = h.hhno""",
)
def act_vehicle_sufficiency(t):
    return act.act_vehicle_sufficiency(t.v_household, t.v_person)


@query(
    "hhno:i day:t pptyp:i tottours:i totstops:i tourstop:i wktostp:i sctostp:i wktopt:i estopt:i",
    f"""
SELECT hhno, day, pptyp, tt AS tottours, ts AS totstops, CASE tt WHEN 0 THEN CASE WHEN ts = 0 THEN 0 END ELSE 4 * tt - 3 + LEAST(ts, 3) END AS tourstop,
 CASE WHEN wktours = 0 AND wkstops = 0 THEN 1 WHEN wktours = 0 THEN 2 WHEN wkstops = 0 THEN 3 ELSE 4 END AS wktostp,
 CASE WHEN sctours = 0 AND scstops = 0 THEN 1 WHEN sctours = 0 THEN 2 WHEN scstops = 0 THEN 3 ELSE 4 END AS sctostp, LEAST(wktours, 3) + 1 AS wktopt, 1 AS estopt
FROM (SELECT d.*, p.pptyp, LEAST(wktours + sctours, 3) AS tt, wkstops + scstops AS ts FROM v_personday d JOIN {PERSON} p ON p.hhno = d.hhno AND p.pno = 1 WHERE p.pptyp < 8) x""",
)
def act_day_pattern_pday(t):
    return act.act_day_pattern_pday(t.v_personday.withColumn("pno", F.lit(1)), people(t))


@query(
    "tour_key:i pdpurp:i pdpurp2:i ftwind:i stopscat:i h1stopscat:i h2stopscat:i vehsuf:i",
    f"""
SELECT tour_key, pu AS pdpurp, CASE WHEN parent = 0 THEN pu ELSE 8 END AS pdpurp2, CASE WHEN pptyp = 1 THEN 1 ELSE 2 END AS ftwind, LEAST(tripsh1 + tripsh2 - 2, 6) AS stopscat,
 tripsh1 - 1 AS h1stopscat, tripsh2 - 1 AS h2stopscat, vehsuf FROM (SELECT t.*, p.pptyp, p.vehsuf, CASE pdpurp WHEN 8 THEN 7 WHEN 9 THEN 4 ELSE pdpurp END AS pu
 FROM v_tour t JOIN {PERSON} p ON p.hhno = t.hhno AND p.pno = t.pno WHERE p.pptyp < 8) x""",
)
def act_day_pattern_tour(t):
    return act.act_day_pattern_tour(t.v_tour, people(t))


@query(
    "dpurp:i inccat:i odistrict:i value:i",
    f"""
SELECT CASE dpurp WHEN 8 THEN 7 WHEN 9 THEN 4 WHEN 0 THEN 8 ELSE dpurp END AS dpurp, inccat, z.district AS odistrict, SUM(psexpfac) AS value
FROM v_trip t JOIN {PERSON} p ON p.hhno = t.hhno AND p.pno = t.pno LEFT JOIN v_zone z ON z.taz = t.otaz WHERE pptyp < 8 GROUP BY 1, 2, 3""",
)
def act_day_pattern_trip(t):
    full = act.act_day_pattern_trip(t.v_trip, people(t), t.v_zone)
    return full.groupBy("dpurp", "inccat", "odistrict").agg(F.sum("psexpfac").alias("value"))


@query(
    "purpose:s stops:i band:i value:i",
    """
SELECT purpose, stops, hhno % 8 AS band, COUNT(*) AS value FROM (SELECT 'wkstops' AS purpose, wkstops AS stops, hhno FROM v_personday UNION ALL SELECT 'scstops', scstops, hhno FROM v_personday
 UNION ALL SELECT 'wktours', wktours, hhno FROM v_personday UNION ALL SELECT 'sctours', sctours, hhno FROM v_personday) x WHERE stops > 0 GROUP BY 1, 2, 3""",
)
def act_stops_by_purpose(t):
    days = t.v_personday.withColumn("band", F.col("hhno") % 8)
    return act.act_stops_by_purpose(days, ["wkstops", "scstops", "wktours", "sctours"], "band", F.lit(1))


_TM = "CASE {} WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 7 THEN 4 WHEN 6 THEN 5 WHEN 2 THEN 6 WHEN 1 THEN 7 WHEN 8 THEN 8 ELSE 0 END"


@query(
    "tour_key:i tourmode:i vehcat:i pdpurp2:i parentmode:i",
    f"""
WITH f AS (SELECT t.tour_key, t.hhno, t.pno, t.tour, t.parent, {_TM.format('t.tmodetp')} AS tourmode, CASE WHEN h.hhvehs > 0 THEN 1 ELSE 0 END AS vehcat,
  CASE pdpurp WHEN 8 THEN 7 WHEN 9 THEN 4 ELSE pdpurp END AS pu FROM v_tour t JOIN v_person p ON p.hhno = t.hhno AND p.pno = t.pno JOIN v_household h ON h.hhno = t.hhno WHERE pptyp < 8)
SELECT f.tour_key, f.tourmode, f.vehcat, CASE WHEN f.parent = 0 THEN f.pu ELSE 8 END AS pdpurp2, CASE WHEN f.parent = 0 THEN 0 ELSE g.tourmode END AS parentmode
FROM f LEFT JOIN f g ON g.pu = 1 AND g.hhno = f.hhno AND g.pno = f.pno AND g.tour = f.parent""",
)
def act_tour_mode(t):
    return act.act_tour_mode(t.v_tour, t.v_household, t.v_person)


@query(
    "tripmode:i tourmode:i pdpurp2:i value:i",
    f"""
SELECT CASE tmode WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 6 THEN pathtype + 1 WHEN 8 THEN 9 WHEN 2 THEN 10 WHEN 1 THEN 11 ELSE 0 END AS tripmode, {_TM.format('u.tmodetp')} AS tourmode,
  CASE WHEN u.parent = 0 THEN u.pdpurp ELSE 8 END AS pdpurp2, SUM(psexpfac) AS value
FROM v_trip r JOIN v_tour u ON u.tour_key = r.tour_key JOIN v_person p ON p.hhno = u.hhno AND p.pno = u.pno WHERE pptyp < 8 GROUP BY 1, 2, 3""",
)
def act_trip_mode(t):
    trips = t.v_trip.drop("hhno", "pno")
    full = act.act_trip_mode(trips, t.v_tour, t.v_person, ["tour_key"])
    return full.groupBy("tripmode", "tourmode", "pdpurp2").agg(F.sum("psexpfac").alias("value"))


@query(
    "pdpurp2:i odistrict:i ddistrict:i distcat:i value:i known_dist:i",
    f"""
SELECT CASE WHEN parent > 0 THEN 8 WHEN pdpurp = 8 THEN 7 WHEN pdpurp = 9 THEN 4 ELSE pdpurp END AS pdpurp2, a.district AS odistrict, b.district AS ddistrict,
  CASE WHEN tautodist < 0 THEN 0 ELSE LEAST(tautodist + 1, 91) END AS distcat, SUM(psexpfac) AS value, SUM(CASE WHEN tautodist >= 0 THEN tautodist END) AS known_dist
FROM v_tour t JOIN {PERSON} p ON p.hhno = t.hhno AND p.pno = t.pno LEFT JOIN v_zone a ON a.taz = totaz LEFT JOIN v_zone b ON b.taz = tdtaz WHERE pptyp < 8 GROUP BY 1, 2, 3, 4""",
)
def act_tour_destination(t):
    full = act.act_tour_destination(t.v_tour, people(t), t.v_zone, t.v_skim)
    return full.groupBy("pdpurp2", "odistrict", "ddistrict", "distcat").agg(F.sum("psexpfac").alias("value"), F.sum("known_dist").alias("known_dist"))


@query(
    "wrkrtyp:i odistrict:i ddistrict:i distcat:i value:i",
    f"""
SELECT CASE pptyp WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS wrkrtyp, a.district AS odistrict, b.district AS ddistrict, LEAST(CAST(travdist AS INT) + 1, 91) AS distcat, SUM(psexpfac) AS value
FROM v_trip t JOIN {PERSON} p ON p.hhno = t.hhno AND p.pno = t.pno LEFT JOIN v_zone a ON a.taz = otaz LEFT JOIN v_zone b ON b.taz = dtaz WHERE pptyp < 8 GROUP BY 1, 2, 3, 4""",
)
def act_trip_destination(t):
    full = act.act_trip_destination(t.v_trip, people(t), t.v_zone)
    return full.groupBy("wrkrtyp", "odistrict", "ddistrict", "distcat").agg(F.sum("psexpfac").alias("value"))


_HALF = "CASE WHEN {0} < 0 THEN 0 WHEN {0} < 180 THEN 1 ELSE LEAST(CAST(FLOOR(({0} - 180) / 30.0) AS INT) + 2, 51) END"


@query(
    "pdpurp2:i arrtimecat:i deptimecat:i durdestcat:i value:i",
    f"""
SELECT CASE WHEN parent > 0 THEN 4 WHEN pdpurp > 7 THEN NULL WHEN pdpurp >= 3 THEN 3 ELSE pdpurp END AS pdpurp2, {_HALF.format('tardest')} AS arrtimecat, {_HALF.format('tlvdest')} AS deptimecat,
  LEAST(CAST(FLOOR((tlvdest - tardest) / 30.0) AS INT) + 1, 49) AS durdestcat, SUM(psexpfac) AS value
FROM v_tour t JOIN {PERSON} p ON p.hhno = t.hhno AND p.pno = t.pno WHERE pptyp < 8 GROUP BY 1, 2, 3, 4""",
)
def act_tour_tod(t):
    full = act.act_tour_tod(t.v_tour, people(t))
    return full.groupBy("pdpurp2", "arrtimecat", "deptimecat", "durdestcat").agg(F.sum("psexpfac").alias("value"))


@query(
    "arrtimecat:i deptimecat:i durdestcat:i arrflag:i depflag:i durflag:i value:i",
    f"""
SELECT {_HALF.format('arrtm')} AS arrtimecat, {_HALF.format('deptm')} AS deptimecat, LEAST(CAST(FLOOR((endacttm - arrtm + CASE WHEN endacttm < arrtm THEN 1440 ELSE 0 END) / 30.0) AS INT) + 1, 48) AS durdestcat,
  CASE WHEN half = 1 AND tseg <> m THEN 1 ELSE 0 END AS arrflag, CASE WHEN half = 2 AND tseg <> 1 THEN 1 ELSE 0 END AS depflag, CASE WHEN tseg < m THEN 1 ELSE 0 END AS durflag, SUM(psexpfac) AS value
FROM (SELECT *, MAX(tseg) OVER (PARTITION BY hhno, pno, tour_key, half) AS m FROM v_trip) t JOIN {PERSON} p ON p.hhno = t.hhno AND p.pno = t.pno WHERE pptyp < 8 GROUP BY 1, 2, 3, 4, 5, 6""",
)
def act_trip_tod(t):
    full = act.act_trip_tod(t.v_trip, people(t), ["hhno", "pno", "tour_key"])
    return full.groupBy("arrtimecat", "deptimecat", "durdestcat", "arrflag", "depflag", "durflag").agg(F.sum("psexpfac").alias("value"))
