"""Driver forms: population synthesis, surveys, employment, flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import popsyn as pop
from ..plans import survey as sur
from .registry import query

_CW = """(SELECT l_partkey AS mz_id, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_partkey % 103 AS INT) END AS tract,
  CASE WHEN l_partkey % 7 < 5 THEN CAST(l_partkey % 103 AS INT) % 3 ELSE CAST(l_partkey % 3 AS INT) END AS puma, SUM(l_quantity) AS pop FROM lineitem GROUP BY l_partkey)"""
_MAJOR = f"""(SELECT tract, puma FROM (SELECT tract, puma, w, SUM(w) OVER (PARTITION BY tract) AS total, ROW_NUMBER() OVER (PARTITION BY tract ORDER BY w DESC, puma) AS r
 FROM (SELECT tract, puma * 100 + 47 AS puma, SUM(pop) AS w FROM {_CW} c WHERE tract IS NOT NULL GROUP BY 1, 2) x) y WHERE r = 1 AND total > 0 AND w / total >= 0.5)"""


@query(
    "mz_id:i maz:i taz:i puma:i popngq:f2",
    f"""
SELECT a.mz_id, b.maz, b.taz, b.puma, GREATEST(a.pop - 700, 0) AS popngq FROM {_CW} a LEFT JOIN
 (SELECT c.mz_id, DENSE_RANK() OVER (ORDER BY c.mz_id) AS maz, DENSE_RANK() OVER (ORDER BY c.tract) AS taz, COALESCE(m.puma, c.puma * 100 + 47) AS puma
  FROM {_CW} c LEFT JOIN {_MAJOR} m ON m.tract = c.tract WHERE c.tract IS NOT NULL) b ON b.mz_id = a.mz_id""",
)
def pop_crosswalk(t):
    k = F.col("l_partkey")
    tract = (k % 103).cast("int")
    blocks = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("pop"))
    cw = blocks.select(
        k.alias("mz_id"), F.when(k % 50 != 0, tract).alias("tract"), F.when(k % 7 < 5, tract % 3).otherwise((k % 3).cast("int")).alias("puma"), F.lit(47).alias("state")
    )
    maz = blocks.select(k.alias("mz_id"), "pop", (F.col("pop") - 700).alias("popngq"))
    return pop.pop_crosswalk(cw, maz)[1]


_ROLL = """(SELECT serialno, COUNT(CASE WHEN esr IN (1, 2, 4, 5) THEN 1 END) AS wk, MAX(schg) AS schg, MAX(mil) AS mil, MAX(pwgtp) AS pwgtp FROM v_pums_per GROUP BY serialno)"""
_SEED = f"""(SELECT h.serialno, h.type, CASE WHEN type = 3 THEN 0 ELSE wgtp END AS wgtp, CASE WHEN type = 3 THEN pwgtp ELSE 0 END AS gqwgtp, CASE WHEN type = 3 THEN 1 ELSE 0 END AS gqflag,
 CASE WHEN type = 1 THEN 0 WHEN schg IN (6, 7) THEN 1 WHEN mil = 1 THEN 2 ELSE 4 END AS gqtype, COALESCE(wk, 0) AS nwrkrs_esr, bld, hupac, adjinc, hincp
 FROM v_pums_hh h LEFT JOIN {_ROLL} r ON r.serialno = h.serialno WHERE np > 0 AND type IN (1, 3))"""


@query(
    "serialno:i wgtp:i gqwgtp:i hhinc_adj:f2 nwrkrs_esr:i gqflag:i gqtype:i htype:s hhchild:s",
    f"""
SELECT serialno, wgtp, gqwgtp, nwrkrs_esr, gqflag, gqtype,
 CASE WHEN type = 3 THEN NULL ELSE CASE adjinc {" ".join(f"WHEN {k} THEN CAST(hincp * CAST({a * b!r} AS DOUBLE) AS DECIMAL(9,2))" for k, (a, b) in pop.INCOME_FACTORS.items())} ELSE 999 END END AS hhinc_adj,
 CASE WHEN type = 3 THEN '999' WHEN bld = 2 THEN '1' WHEN bld BETWEEN 4 AND 9 THEN '2' WHEN bld IN (1, 10) THEN '3' WHEN bld = 3 THEN '4' ELSE '999' END AS htype,
 CASE WHEN type = 3 THEN '999' WHEN hupac = 4 THEN '1' WHEN hupac IN (1, 2, 3) THEN '2' ELSE '999' END AS hhchild FROM {_SEED} s""",
)
def pop_seed_households(t):
    return pop.pop_seed_households(t.v_pums_hh, t.v_pums_per)


@query(
    "serialno:i sporder:i employed:i soc:s occp:s wgtp:i gqwgtp:i gqflag:i",
    f"""
SELECT *, CASE WHEN soc IN ('11','13','15','17','19','27','39') THEN '1' WHEN soc IN ('21','23','25','29','31') THEN '2' WHEN soc IN ('33','35','37') THEN '3' WHEN soc IN ('41','43') THEN '4'
 WHEN soc IN ('45','47','49') THEN '5' WHEN soc IN ('51','53','55') THEN '6' ELSE '999' END AS occp FROM (
 SELECT p.serialno, sporder, CASE WHEN esr IN (1, 2, 4, 5) THEN 1 ELSE 0 END AS employed,
  CASE WHEN esr IS NULL OR esr NOT IN (1, 2, 4, 5) THEN '999' WHEN SUBSTRING(socp00, 1, 2) = 'N.' THEN SUBSTRING(socp10, 1, 2) ELSE SUBSTRING(socp00, 1, 2) END AS soc,
  s.wgtp, CASE WHEN s.gqflag = 1 THEN pwgtp ELSE s.gqwgtp END AS gqwgtp, s.gqflag FROM v_pums_per p JOIN {_SEED} s ON s.serialno = p.serialno) x""",
)
def pop_seed_persons(t):
    return pop.pop_seed_persons(t.v_pums_per, pop.pop_seed_households(t.v_pums_hh, t.v_pums_per))


def _raking_sql(n):
    seg = "SELECT hhseg, SUM(hhvehs + 1) AS target FROM v_household GROUP BY hhseg"
    taz = "SELECT hhtaz, SUM(hhvehs + 1) AS target FROM v_household GROUP BY hhtaz"
    ctes = [
        f"ts AS MATERIALIZED ({seg})",
        f"tz AS MATERIALIZED ({taz})",
        "c0 AS MATERIALIZED (SELECT hhseg, hhtaz, CAST(SUM(hhexpfac) AS DOUBLE) AS w, CAST(1 AS DOUBLE) AS f FROM v_household GROUP BY 1, 2)",
    ]
    for i in range(1, n + 1):
        for side, src, key, tt in (("a", f"c{i - 1}", "hhseg", "ts"), ("c", f"a{i}", "hhtaz", "tz")):
            ctes.append(
                f"{side}{i} AS MATERIALIZED (SELECT c.hhseg, c.hhtaz, c.w, c.f * COALESCE(t.target / NULLIF(s.s, 0), 0) AS f FROM {src} c JOIN (SELECT {key}, SUM(w * f) AS s FROM {src} GROUP BY {key}) s USING ({key}) LEFT JOIN {tt} t USING ({key}))"
            )
    return "WITH " + ",\n".join(ctes) + f"\nSELECT h.hhno, h.hhexpfac * c.f AS weight FROM v_household h JOIN c{n} c ON c.hhseg = h.hhseg AND c.hhtaz = h.hhtaz"


# The query ends by its tolerance, far below the digits compared; the SQL runs more rounds.
@query("hhno:i weight:f4", _raking_sql(30))
def pop_raking(t):
    hh = t.v_household
    seg = hh.groupBy("hhseg").agg(F.sum(F.col("hhvehs") + 1).alias("target"))
    taz = hh.groupBy("hhtaz").agg(F.sum(F.col("hhvehs") + 1).alias("target"))
    seed = hh.select("hhno", "hhseg", "hhtaz", F.col("hhexpfac").alias("weight"))
    return pop.pop_raking(seed, "weight", [(["hhseg"], seg), (["hhtaz"], taz)], tol=1e-10)


# Targets are the sums of weights cut off at the cap, so the fit must find these very weights.
_CAP = 2.0
_SEG_FACTOR, _TAZ_FACTOR = "CAST(LENGTH(hhseg) AS DOUBLE) / 8", "(CAST(0.5 AS DOUBLE) + CAST(0.35 AS DOUBLE) * (hhtaz % 5))"
_CAPPED = f"(SELECT hhno, hhseg, hhtaz, hhexpfac, hhexpfac * LEAST(CAST({_CAP} AS DOUBLE), {_SEG_FACTOR} * {_TAZ_FACTOR}) AS weight FROM v_household)"


def _capped(t):
    known = t.sql(f"SELECT * FROM {_CAPPED} x")
    controls = [([k], known.groupBy(k).agg(F.sum("weight").alias("target"))) for k in ("hhseg", "hhtaz")]
    seed = t.v_household.select("hhno", "hhseg", "hhtaz", F.col("hhexpfac").alias("weight"))
    return pop.pop_raking_bounded(seed, "weight", controls, _CAP, tol=1e-9), controls


@query("hhno:i hhseg:s hhtaz:i weight:f5", f"SELECT hhno, hhseg, hhtaz, weight FROM {_CAPPED} x")
def pop_raking_bounded(t):
    return _capped(t)[0]


# Weights fitted to the targets, held against the segment targets and twice the zone targets.
@query(
    "control:s category:s target:f5 reached:f5 gap:f5",
    f"""
SELECT 'hhseg' AS control, hhseg AS category, SUM(weight) AS target, SUM(weight) AS reached, 0 AS gap FROM {_CAPPED} x GROUP BY hhseg
UNION ALL SELECT 'hhtaz', CAST(hhtaz AS VARCHAR), 2 * SUM(weight), SUM(weight), SUM(weight) FROM {_CAPPED} x GROUP BY hhtaz""",
)
def pop_control_gaps(t):
    fitted, (seg, (_, taz)) = _capped(t)
    return pop.pop_control_gaps(fitted, "weight", [seg, (["hhtaz"], taz.withColumn("target", F.col("target") * 2))])


@query(
    "hhno:i n:i hhid:i pno:i perid:i",
    """
WITH hh AS (SELECT hhno, n, ROW_NUMBER() OVER (ORDER BY hhno, n) AS hhid FROM (SELECT hhno, UNNEST(RANGE(1, hhexpfac + 1)) AS n FROM v_household) x)
SELECT h.hhno, h.n, h.hhid, p.pno, ROW_NUMBER() OVER (ORDER BY h.hhid, p.pno) AS perid FROM hh h JOIN v_person p ON p.hhno = h.hhno""",
)
def pop_expand(t):
    return pop.pop_expand(t.v_household, t.v_person, "hhno", "hhexpfac", "pno")[1]


@query(
    "file:s hhno:i pno:i a:i b:i c:i d:i",
    """
SELECT 'person' AS file, hhno, pno, CASE WHEN agep < 5 THEN 8 WHEN agep < 16 THEN 7 WHEN pw = 1 THEN 1 WHEN st = 1 AND agep < 18 THEN 6 WHEN schg BETWEEN 1 AND 5 AND agep <= 25 THEN 6 WHEN st = 1 THEN 5
  WHEN pw > 0 THEN 2 WHEN agep >= 65 THEN 3 ELSE 4 END AS a, pw AS b, st AS c, agep AS d FROM (
 SELECT serialno AS hhno, sporder AS pno, agep, schg, CASE WHEN esr IS NULL OR esr NOT IN (1, 2, 4, 5) OR wkhp <= 0 THEN 0 WHEN wkhp BETWEEN 32 AND 150 THEN 1 ELSE 2 END AS pw,
  CASE WHEN schg > 0 OR agep BETWEEN 5 AND 17 THEN 1 ELSE 0 END AS st FROM v_pums_per) x
UNION ALL SELECT 'household', serialno, 0, CASE WHEN bld = 2 THEN 1 WHEN bld = 3 THEN 2 WHEN bld BETWEEN 4 AND 9 THEN 3 WHEN bld = 1 THEN 4 WHEN bld = 10 THEN 6 ELSE 9 END,
 CASE WHEN ten < 0 THEN 9 WHEN ten <= 2 THEN 1 WHEN ten = 3 THEN 2 ELSE 3 END, GREATEST(veh, 0), GREATEST(hincp, 0) FROM v_pums_hh""",
)
def pop_format(t):
    employed = F.coalesce(F.col("esr").isin(*pop.EMPLOYED), F.lit(False)).cast("int")
    per = t.v_pums_per.select("*", employed.alias("employed"), F.col("serialno").alias("hhid"), F.col("sporder").alias("perid"))
    persons = pop.pop_format_persons(per)
    hh = t.v_pums_hh.select("*", F.col("serialno").alias("hhid"), F.lit(0).alias("nwrkrs_esr"), F.col("hincp").alias("hhinc_adj"), F.lit(1).alias("maz"), F.lit(1).alias("tz_id"))
    homes = pop.pop_format_households(hh)
    a = persons.select(F.lit("person").alias("file"), "hhno", "pno", F.col("pptyp").alias("a"), F.col("pwtyp").alias("b"), F.col("pstyp").alias("c"), F.col("pagey").alias("d"))
    b = homes.select(F.lit("household").alias("file"), "hhno", F.lit(0).alias("pno"), F.col("hrestype").alias("a"), F.col("hownrent").alias("b"), F.col("hhvehs").alias("c"), F.col("hhincome").alias("d"))
    return a.unionByName(b)


@query(
    "geoid10:s hh:i consistent:b hh_child_new:i hh_no_child_new:i",
    """
SELECT geoid10, hh, hh = w AS consistent, CAST(ROUND_EVEN(hh * (CAST(ch AS DOUBLE) / al), 0) AS BIGINT) AS hh_child_new, hh - CAST(ROUND_EVEN(hh * (CAST(ch AS DOUBLE) / al), 0) AS BIGINT) AS hh_no_child_new FROM (
 SELECT CONCAT('47065', LPAD(CAST(hhtaz AS VARCHAR), 6, '0')) AS geoid10, COUNT(*) AS hh, COUNT(CASE WHEN hhvehs < 5 THEN 1 END) AS w FROM v_household GROUP BY hhtaz) a
JOIN (SELECT CONCAT('47065', LPAD(CAST(o_custkey % 25 AS VARCHAR), 6, '0')) AS g, COUNT(*) AS al, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS ch FROM orders GROUP BY 1) b ON a.geoid10 = b.g""",
)
def pop_control_targets(t):
    geoid = F.concat(F.lit("47065"), F.lpad(F.col("hhtaz").cast("string"), 6, "0")).alias("geoid10")
    size, veh = F.col("hhparcel") % 4, F.col("hhvehs")
    tracts = t.v_household.groupBy(geoid).agg(
        *[F.count(F.when(size == i, 1)).alias(f"hh_{i + 1}") for i in range(4)], F.count(F.when(veh < 3, 1)).alias("w_low"), F.count(F.when((veh >= 3) & (veh < 5), 1)).alias("w_high")
    )
    zone = (F.col("o_custkey") % 25).cast("int").alias("tract")
    flags = F.explode(F.when(F.col("o_orderstatus") == "F", F.array(F.lit("hh_all"), F.lit("hh_child"))).otherwise(F.array(F.lit("hh_all"))))
    acs = t.orders.select(zone, flags.alias("variable")).groupBy("tract", "variable").agg(F.count("*").alias("value"))
    acs = acs.withColumns({"state": F.lit(47), "county": F.lit(65)})
    return pop.pop_control_targets(tracts, acs, ["hh_1", "hh_2", "hh_3", "hh_4"], ["w_low", "w_high"])


@query(
    "route:i observed:i sample:f2 expanded:f6",
    """
WITH b AS (SELECT a.route, observed, sample FROM (SELECT route, SUM(passengers_on) AS observed FROM v_apc GROUP BY route) a JOIN (SELECT route, SUM(linked_weight) AS sample FROM v_survey GROUP BY route) s ON s.route = a.route)
SELECT *, observed * (SELECT MAX(sample / observed) FROM b) AS expanded FROM b""",
)
def sur_expand_closed_form(t):
    obs = t.v_apc.groupBy("route").agg(F.sum("passengers_on").alias("observed"))
    return sur.sur_expand_closed_form(obs, t.v_survey.groupBy("route").agg(F.sum("linked_weight").alias("sample")), "route")


@query(
    "respondent:i copy:i",
    "SELECT respondent, UNNEST(RANGE(1, GREATEST(CAST(ROUND_EVEN(linked_weight, 0) AS BIGINT), 1) + 1)) AS copy FROM v_survey",
)
def sur_explode_linked(t):
    return sur.sur_explode_linked(t.v_survey, "linked_weight")


@query(
    "route:s insufficient_data:i no_pass:i pass:i total:i",
    """
SELECT COALESCE(CAST(route AS VARCHAR), 'Total') AS route, COUNT(CASE WHEN confidence IS NULL THEN 1 END) AS insufficient_data, COUNT(CASE WHEN confidence < 8 THEN 1 END) AS no_pass,
       COUNT(CASE WHEN confidence >= 8 THEN 1 END) AS pass, COUNT(*) AS total FROM v_survey GROUP BY ROLLUP (route)""",
)
def sur_geocode_grade(t):
    return sur.sur_geocode_grade(t.v_survey, "confidence", "route")


@query(
    "tract_id:s empfoo_p:i empind_p:i empret_p:i emptrn_p:i emptot_p:i conserved:b ind:i pro:i",
    """
SELECT SUBSTRING(w_geocode, 1, 11) AS tract_id, SUM(cns18) AS empfoo_p, SUM(cns05 + cns06) AS empind_p, SUM(cns07) AS empret_p, SUM(cns06) AS emptrn_p,
       SUM(cns18) + SUM(cns05) + SUM(cns06) + SUM(cns07) AS emptot_p, SUM(cns18) + SUM(cns05 + cns06) + SUM(cns07) = SUM(cns05 + cns06 + cns07 + cns18) AS conserved, SUM(cns05 + cns06) AS ind, 0 AS pro FROM v_jobs GROUP BY 1""",
)
def emp_sector_rollup(t):
    return sur.emp_sector_rollup(t.v_jobs)


@query(
    "level:s o_district:i d_district:i trips:f2",
    """
SELECT 'district' AS level, a.district AS o_district, b.district AS d_district, SUM(trips) AS trips FROM v_od JOIN v_zone a ON a.taz = o JOIN v_zone b ON b.taz = d GROUP BY 2, 3
UNION ALL SELECT 'area_type', a.area_type, b.area_type, SUM(trips) FROM v_od JOIN v_zone a ON a.taz = o JOIN v_zone b ON b.taz = d GROUP BY 2, 3""",
)
def flow_home_work(t):
    return sur.flow_home_work(t.v_od, t.v_zone, ["district", "area_type"])


_FLOWS = {
    "census": ("v_census_flow", "home", "work", "workers", "v_tract", ("tract", "zone", "district", "super_district")),
    "payroll": ("v_payroll_flow", "home", "work", "jobs", "v_tract", ("tract", "zone", "district", "super_district")),
    "survey": ("v_trip", "otaz", "dtaz", "trexpfac", "v_taz", ("zone", "district", "super_district")),
}
_LEVEL_FLOWS = "\nUNION ALL ".join(
    f"SELECT '{s}' AS source, '{x}' AS level, CAST(a.{x} AS VARCHAR) AS o, CAST(b.{x} AS VARCHAR) AS d, CAST(SUM(f.{w}) AS DOUBLE) AS trips FROM {v} f JOIN {areas} a ON a.{xs[0]} = f.{o} JOIN {areas} b ON b.{xs[0]} = f.{d} GROUP BY 3, 4"
    for s, (v, o, d, w, areas, xs) in _FLOWS.items()
    for x in xs
)


@query(
    "source:s level:s o:s d:s trips:f2 pct:f6 before:f2 after:f2 conserved:b",
    f"WITH f AS ({_LEVEL_FLOWS}), b AS ("
    + " UNION ALL ".join(f"SELECT '{s}' AS source, CAST(SUM({w}) AS DOUBLE) AS before FROM {v}" for s, (v, _, _, w, _, _) in _FLOWS.items())
    + """), t AS (SELECT source, level, SUM(trips) AS after FROM f GROUP BY 1, 2)
SELECT f.source, f.level, o, d, trips, 100 * trips / after AS pct, before, after, ABS(after - before) <= 1e-9 * ABS(before) AS conserved FROM f JOIN t ON t.source = f.source AND t.level = f.level JOIN b ON b.source = f.source""",
)
def flow_work_levels(t):
    """Tracts ending in 19 lie outside: the census flows lose some, the payroll flows have none there."""
    return sur.flow_work_levels([sur.FlowSource(s, getattr(t, v), getattr(t, areas), xs[0], xs[1:], o, d, w) for s, (v, o, d, w, areas, xs) in _FLOWS.items()])


@query(
    "month:i cls:s start_district:i end_district:i geo_start:s geo_end:s total:i pct:f6",
    """
SELECT month, cls, start_district, end_district, geo_start, geo_end, COUNT(*) AS total, 100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY month, cls) AS pct FROM (
 SELECT *, MONTH(start_date) AS month, CASE WHEN veh_class = 1 THEN 'personal' ELSE 'truck' END AS cls FROM v_probe
 WHERE MONTH(start_date) IN (5, 10) AND DAYOFWEEK(start_date) BETWEEN 2 AND 4 AND start_district >= 0 AND end_district >= 0) x GROUP BY 1, 2, 3, 4, 5, 6""",
)
def probe_trip_patterns(t):
    """District matrices of both months and vehicle classes, the unknown district (-1) left out."""
    cls = F.when(F.col("veh_class") == 1, "personal").otherwise("truck").alias("cls")
    unknown = (F.col("start_district") < 0) | (F.col("end_district") < 0)
    return sur.probe_trip_patterns(t.v_probe, (5, 10), [cls], ["start_district", "end_district", "geo_start", "geo_end"], unknown)


@query("hhno:i n:i", "SELECT hhno, COUNT(*) AS n FROM v_personday GROUP BY hhno HAVING COUNT(*) > 1")
def lbl_dedupe_ids(t):
    return sur.lbl_dedupe_ids(t.v_personday, "hhno")
