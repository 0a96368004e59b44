"""Driver forms: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fn
from .q_joins import SITES_SQL, sites
from .registry import query


@query(
    "hhno:i band:i",
    """
SELECT hhno, CASE WHEN hhincome < 0 THEN 0 WHEN hhincome < 15000 THEN 1 WHEN hhincome < 50000 THEN 2 WHEN hhincome < 75000 THEN 3 ELSE 4 END AS band FROM v_household""",
)
def fn_find_interval(t):
    return t.v_household.select("hhno", fn.fn_find_interval("hhincome", [0, 15000, 50000, 75000]).alias("band"))


@query(
    "hhno:i band:i",
    """
SELECT hhno, CASE WHEN hhincome > 0 AND hhincome <= 15000 THEN 0 WHEN hhincome > 15000 AND hhincome <= 50000 THEN 15000
  WHEN hhincome > 50000 AND hhincome <= 75000 THEN 50000 WHEN hhincome > 75000 AND hhincome <= 90000 THEN 75000 END AS band FROM v_household""",
)
def fn_cut_right(t):
    return t.v_household.select("hhno", fn.fn_cut_right("hhincome", [0, 15000, 50000, 75000, 90000]).alias("band"))


@query(
    "kind:s key:i hours:f6",
    """
SELECT 'tour' AS kind, tour_key AS key, CASE WHEN (SELECT MAX(tlvdest % 100) FROM v_tour) > 60 THEN CAST(tlvdest AS DOUBLE) / 60 ELSE FLOOR(CAST(tlvdest AS DOUBLE) / 100) + CAST(tlvdest % 100 AS DOUBLE) / 60 END AS hours FROM v_tour
UNION ALL SELECT 'count', milepost, FLOOR(CAST(start_sec AS DOUBLE) / 3600) + FLOOR(CAST(start_sec % 3600 AS DOUBLE) / 60) / 60 FROM v_apc""",
)
def fn_time_decode(t):
    tours = fn.fn_time_decode(t.v_tour, "tlvdest", "hours").select(F.lit("tour").alias("kind"), F.col("tour_key").alias("key"), "hours")
    hhmm = (F.floor(F.col("start_sec") / 3600) * 100 + F.floor((F.col("start_sec") % 3600) / 60)).cast("int")
    counts = fn.fn_time_decode(t.v_apc.withColumn("clock", hhmm), "clock", "hours")
    return tours.unionByName(counts.select(F.lit("count").alias("kind"), F.col("milepost").alias("key"), "hours"))


@query(
    "tour_key:i tseg:i hours:f6",
    "SELECT tour_key, tseg, CAST(CASE WHEN endacttm < arrtm THEN endacttm - arrtm + 1440 ELSE endacttm - arrtm END AS DOUBLE) / 60 AS hours FROM v_trip",
)
def fn_duration_wrap(t):
    return t.v_trip.select("tour_key", "tseg", fn.fn_duration_wrap("arrtm", "endacttm").alias("hours"))


@query(
    "period:s n:i",
    "SELECT CASE WHEN deptm >= 360 AND deptm < 540 THEN 'AM' WHEN deptm >= 900 AND deptm < 1080 THEN 'PM' ELSE 'OP' END AS period, COUNT(*) AS n FROM v_trip GROUP BY 1",
)
def fn_tod_period(t):
    return t.v_trip.groupBy(fn.fn_tod_period("deptm").alias("period")).agg(F.count("*").alias("n"))


@query(
    "period:s n:i",
    "SELECT CASE WHEN start_sec BETWEEN 21600 AND 32400 THEN 'AM' WHEN start_sec BETWEEN 54000 AND 64800 THEN 'PM' ELSE 'OP' END AS period, COUNT(*) AS n FROM v_apc GROUP BY 1",
)
def fn_tod_inclusive(t):
    return t.v_apc.groupBy(fn.fn_tod_inclusive("start_sec").alias("period")).agg(F.count("*").alias("n"))


@query("hr:s n:i", "SELECT CONCAT('hr', LPAD(CAST(CAST(FLOOR(deptm / 60.0) AS INT) + 1 AS VARCHAR), 2, '0')) AS hr, COUNT(*) AS n FROM v_trip GROUP BY 1")
def fn_hour_bucket(t):
    return t.v_trip.groupBy(fn.fn_hour_bucket("deptm").alias("hr")).agg(F.count("*").alias("n"))


@query(
    "s_suppkey:i geoid:s",
    """
SELECT s_suppkey, CASE WHEN n_nationkey <> 7 THEN CONCAT('4', CAST(n_regionkey AS VARCHAR), LPAD(CAST(n_nationkey AS VARCHAR), 3, '0'), LPAD(CAST(s_suppkey * 100 + s_suppkey % 100 AS VARCHAR), 6, '0')) END AS geoid
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def fn_geo_id_build(t):
    zones = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    number = F.concat(F.col("s_suppkey").cast("string"), F.lit("."), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"))
    places = t.supplier.join(zones, F.col("s_nationkey") == F.col("n_nationkey"))
    named = F.when(F.col("n_nationkey") == 7, "Nowhere").otherwise(F.col("n_name"))
    desc = places.select("s_suppkey", F.concat(F.lit("Census Tract "), number, F.lit(", "), named, F.lit(", "), "r_name").alias("desc"))
    code = F.concat(F.lit("4"), F.col("r_regionkey").cast("string"))
    states = t.region.select(F.col("r_name").alias("state_name"), code.alias("state_code"))
    counties = zones.select(
        code.alias("state_code"), F.col("n_name").alias("county_name"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("county_code")
    )
    return fn.fn_geo_id_build(desc, "desc", states, counties)


@query(
    "w_geocode:s state:s county:s tract:s block:s tract_id:s",
    """
SELECT w_geocode, SUBSTRING(w_geocode, 1, 2) AS state, SUBSTRING(w_geocode, 3, 3) AS county, SUBSTRING(w_geocode, 6, 6) AS tract,
       SUBSTRING(w_geocode, 12, 4) AS block, SUBSTRING(w_geocode, 1, 11) AS tract_id FROM v_jobs""",
)
def fn_geo_id_slice(t):
    return t.v_jobs.select("w_geocode", *[c.alias(k) for k, c in fn.fn_geo_id_slice("w_geocode").items()])


@query(
    "mz_id:i geoid:s puma_id:i",
    "SELECT DISTINCT mz_id, CONCAT('47', LPAD(CAST(puma AS VARCHAR), 3, '0'), LPAD(CAST(tract AS VARCHAR), 6, '0')) AS geoid, puma * 100 + 47 AS puma_id FROM v_cwalk",
)
def fn_geo_id_concat(t):
    geo = fn.fn_geo_id_concat([F.lit(47), "puma", "tract"], [2, 3, 6])
    return t.v_cwalk.select("mz_id", geo.alias("geoid"), (F.col("puma") * 100 + 47).alias("puma_id")).distinct()


@query(
    "p_partkey:i clean:s",
    """
SELECT p_partkey, REPLACE(REPLACE(REPLACE(REPLACE(REPLACE(TRIM(CONCAT(' [', p_name, '], ', p_type, '/', p_brand, ' ')), '[', ''), ']', ''), ',', ''), ' ', ''), '/', ' + ') AS clean FROM part""",
)
def fn_text_clean(t):
    messy = F.concat(F.lit(" ["), "p_name", F.lit("], "), "p_type", F.lit("/"), "p_brand", F.lit(" "))
    return t.part.select("p_partkey", fn.fn_text_clean(messy).alias("clean"))


@query(
    "p_partkey:i address:s",
    """
SELECT p_partkey, CONCAT(TRIM(CASE WHEN home THEN CONCAT_WS(' ', place, '12345') ELSE place END), ', Springfield') AS address FROM (
 SELECT p_partkey, p_partkey % 2 = 0 AS home, CASE WHEN street IS NOT NULL THEN CONCAT_WS(' ', nm, CAST(p_size AS VARCHAR), street) ELSE CONCAT_WS(' ', nm, crossing) END AS place
 FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END AS nm, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS street,
   CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CONCAT(p_type, ' & 4th') END AS crossing FROM part) a) b""",
)
def fn_address_compose(t):
    k = F.col("p_partkey")
    stops = t.part.select(
        k,
        F.when(k % 5 != 0, F.col("p_name")).alias("nm"),
        F.col("p_size").cast("string").alias("no"),
        F.when(k % 3 != 0, F.col("p_brand")).alias("street"),
        F.when(k % 7 != 0, F.concat("p_type", F.lit(" & 4th"))).alias("crossing"),
        F.lit("12345").alias("zip"),
    )
    line = fn.fn_address_compose("nm", "no", "street", "crossing", "zip", k % 2 == 0, "Springfield")
    return stops.select("p_partkey", line.alias("address"))


@query(
    "respondent:i half_even:i half_away:i",
    "SELECT respondent, CAST(ROUND_EVEN(linked_weight, 0) AS BIGINT) AS half_even, CAST(ROUND(linked_weight) AS BIGINT) AS half_away FROM v_survey",
)
def fn_round_modes(t):
    return t.v_survey.select(
        "respondent", fn.fn_round_half_even("linked_weight").alias("half_even"), fn.fn_round_half_away("linked_weight").alias("half_away")
    )


# Income adjustment factor pairs by vintage code.
FACTORS = {0: (1.0, 1.0), 1: (1.25, 1.0), 2: (1.5, 1.0), 3: (1.25, 1.5)}


@query(
    "c_custkey:i income:f2",
    """
SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN CAST(bal AS DECIMAL(9,2)) WHEN 1 THEN CAST(bal * 1.25 AS DECIMAL(9,2)) WHEN 2 THEN CAST(bal * 1.5 AS DECIMAL(9,2))
  WHEN 3 THEN CAST(bal * 1.875 AS DECIMAL(9,2)) ELSE 999 END AS income FROM (SELECT c_custkey, c_nationkey, ROUND(c_acctbal) AS bal FROM customer) x""",
)
def fn_decimal_money(t):
    bal = t.customer.withColumn("bal", F.round("c_acctbal"))
    return bal.select("c_custkey", fn.fn_decimal_money("bal", F.col("c_nationkey") % 5, FACTORS).alias("income"))


@query(
    "id:i heading:f4",
    f"""
SELECT id, (h + 720) - 360 * FLOOR((h + 720) / 360) AS heading FROM (
 SELECT v.id, DEGREES(ATAN2(s.x - v.x, s.y - v.y)) AS h FROM v_point v JOIN ({SITES_SQL}) s ON s.site = v.label) q""",
)
def fn_heading(t):
    s = sites(t).withColumnsRenamed({"x": "sx", "y": "sy", "site": "label"})
    return t.v_point.join(s, "label").select("id", fn.fn_heading("x", "y", "sx", "sy").alias("heading"))


@query(
    "id:i miles:f4",
    f"""
SELECT v.id, 2 * 3956 * ASIN(SQRT(POW(SIN(RADIANS(s.y - v.y) * 5), 2) + COS(RADIANS(35 + v.y * 10)) * COS(RADIANS(35 + s.y * 10)) * POW(SIN(RADIANS(s.x - v.x) * 5), 2))) AS miles
FROM v_point v JOIN ({SITES_SQL}) s ON s.site = v.label""",
)
def fn_haversine(t):
    s = sites(t).withColumnsRenamed({"x": "sx", "y": "sy", "site": "label"})
    deg = [F.col("x") * 10 - 85, F.col("y") * 10 + 35, F.col("sx") * 10 - 85, F.col("sy") * 10 + 35]
    return t.v_point.join(s, "label").select("id", fn.fn_haversine(*deg).alias("miles"))


@query("event_id:i k:i", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json_field(t):
    return t.events.select("event_id", fn.fn_json_field("props", "$.k", "bigint").alias("k"))


_FC = "CASE WHEN fcarea = 1 THEN CASE funcclass WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 6 WHEN 5 THEN 7 WHEN 6 THEN 8 ELSE 9 END ELSE CASE funcclass WHEN 1 THEN 11 WHEN 2 THEN 12 WHEN 3 THEN 14 WHEN 4 THEN 16 WHEN 5 THEN 17 WHEN 6 THEN 17 ELSE 19 END END"


@query("id:i fc:i", f"SELECT id, {_FC} AS fc FROM v_link")
def fn_fclass_crosswalk(t):
    return t.v_link.select("id", fn.fn_fclass_crosswalk("funcclass", "fcarea").alias("fc"))


@query(
    "id:i road_type:i",
    f"""
SELECT id, CASE WHEN ramp > 0 THEN CASE WHEN fcarea + 2 < 4 THEN 4 ELSE 2 END WHEN fc < 10 THEN CASE WHEN fc = 1 OR access = 3 THEN 2 ELSE 3 END
  ELSE CASE WHEN fc = 11 OR access = 3 THEN 4 ELSE 5 END END AS road_type FROM (SELECT *, {_FC} AS fc FROM v_link) x""",
)
def fn_road_type(t):
    links = t.v_link.withColumns({"fc": fn.fn_fclass_crosswalk("funcclass", "fcarea"), "area": F.col("fcarea") + 2})
    return links.select("id", fn.fn_road_type("fc", "ramp", "access", "area").alias("road_type"))


@query(
    "id:i bin:i",
    "SELECT id, CASE WHEN v < 2.5 THEN 1 WHEN v >= 72.5 THEN 16 ELSE CAST(FLOOR((v - 2.5) / 5) AS INT) + 2 END AS bin FROM (SELECT id, spd_lmt * 1.25 - 30 AS v FROM v_link) x",
)
def fn_speed_bin(t):
    return t.v_link.select("id", fn.fn_speed_bin(F.col("spd_lmt") * 1.25 - 30).alias("bin"))


@query(
    "id:i speed:f6",
    "SELECT id, CASE dir WHEN 0 THEN 2 / (1.0 / ab + 1.0 / ba) WHEN 1 THEN ab ELSE ba END AS speed FROM (SELECT id, dir, CAST(spd_lmt AS DOUBLE) AS ab, CAST(spd_lmt + 5 * ba_lanes AS DOUBLE) AS ba FROM v_link) x",
)
def fn_harmonic_speed(t):
    both = t.v_link.withColumn("ba", F.col("spd_lmt") + 5 * F.col("ba_lanes"))
    return both.select("id", fn.fn_harmonic_speed("spd_lmt", "ba", "dir").alias("speed"))


@query(
    "id:i pct:f2",
    "SELECT id, ROUND(COALESCE(CAST(ab_pm_auto - ab_am_auto AS DOUBLE) / NULLIF(ab_am_auto, 0) * 100, 0), 2) AS pct FROM v_link",
)
def fn_pct_change_safe(t):
    return t.v_link.select("id", fn.fn_pct_change_safe("ab_pm_auto", "ab_am_auto").alias("pct"))
