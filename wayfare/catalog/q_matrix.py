"""Driver forms: origin-destination matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import matrix as mat
from ..session import cut_lineage
from .registry import query

_PER = "CASE WHEN tm >= 360 AND tm < 540 THEN 'AM' WHEN tm >= 900 AND tm < 1080 THEN 'PM' ELSE 'OP' END"
_TRIP = "(SELECT *, CASE WHEN half = 1 THEN arrtm ELSE deptm END AS tm FROM v_trip)"
PCE_SQL = f"""SELECT otaz AS o, dtaz AS d, CONCAT({_PER}, '_Pass') AS core, SUM(trexpfac * CASE tmode WHEN 3 THEN 1.0 WHEN 4 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) / 3.5 END) AS trips
FROM {_TRIP} x WHERE tmode IN (3, 4, 5) GROUP BY 1, 2, 3"""
TRANSIT_SQL = f"""SELECT otaz AS o, dtaz AS d, CONCAT({_PER}, CASE pathtype WHEN 3 THEN '_Local' ELSE '_Shuttle' END) AS core, SUM(trexpfac) AS trips
FROM {_TRIP} x WHERE tmode = 6 AND pathtype IN (3, 7) GROUP BY 1, 2, 3"""


@query("o:i d:i core:s trips:f6", PCE_SQL)
def mat_pce_trips(t):
    return mat.mat_pce_trips(t.v_trip)


@query("o:i d:i core:s trips:i", TRANSIT_SQL)
def mat_transit_trips(t):
    return mat.mat_transit_trips(t.v_trip)


@query(
    "o:i d:i core:s trips:f6",
    f"""
WITH u AS (SELECT o, d, core, SUM(trips) AS trips FROM (SELECT * FROM ({PCE_SQL}) a UNION ALL SELECT o, d, 'AM_Pass', trips FROM v_od WHERE core % 2 = 0
 UNION ALL SELECT o, d, 'PM_SUT', trips FROM v_od WHERE core % 2 = 1) y GROUP BY 1, 2, 3)
SELECT o, d, core, trips FROM u UNION ALL SELECT o, d, UPPER(SPLIT_PART(core, '_', 2)), SUM(trips) FROM u GROUP BY 1, 2, 3""",
)
def mat_trip_table(t):
    """Car trips with the matrices of all years, even ones as external trips and odd ones as trucks."""
    more = t.v_od.withColumn("core", F.when(F.col("core") % 2 == 0, "AM_Pass").otherwise("PM_SUT"))
    return mat.mat_trip_table(mat.mat_pce_trips(t.v_trip), more)


def _tod_sql():
    parts = []
    for i, p in enumerate(mat.PERIODS):
        inner = " ".join(f"WHEN '{k}' THEN CAST({v[i]} AS DOUBLE)" for k, v in mat.INTERNAL_FACTORS.items())
        outer = " ".join(f"WHEN '{k}' THEN CAST({v[i]} AS DOUBLE)" for k, v in mat.EXTERNAL_FACTORS.items())
        parts.append(f"SELECT o, d, CONCAT('{p}_', cl) AS core, trips * CASE WHEN o >= 20 OR d >= 20 THEN CASE cl {outer} END ELSE CASE cl {inner} END END AS trips FROM u")
    cls = "CASE core % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'SUT' ELSE 'MUT' END"
    return f"WITH u AS (SELECT o, d, {cls} AS cl, SUM(trips) AS trips FROM v_od GROUP BY 1, 2, 3)\n" + " UNION ALL ".join(parts)


@query("o:i d:i core:s trips:f6", _tod_sql())
def mat_tod_factors(t):
    cls = F.when(F.col("core") % 3 == 0, "PASS").when(F.col("core") % 3 == 1, "SUT").otherwise("MUT")
    daily = t.v_od.groupBy("o", "d", cls.alias("core")).agg(F.sum("trips").alias("trips"))
    return mat.mat_tod_factors(daily, (F.col("o") >= 20) | (F.col("d") >= 20))


@query(
    "o:i d:i core:i trips:f4",
    """
SELECT COALESCE(a.o, b.d) AS o, COALESCE(a.d, b.o) AS d, COALESCE(a.core, b.core) AS core, (COALESCE(a.trips, 0) + COALESCE(b.trips, 0)) / 2 AS trips
FROM v_od a FULL JOIN v_od b ON a.o = b.d AND a.d = b.o AND a.core = b.core""",
)
def mat_pa_to_od(t):
    return mat.mat_pa_to_od(t.v_od, ["core"])


# The year, the one after it and the one after that as base, seed and scenario, for every year.
_YEARS = """SELECT core, o, d, trips AS b, 0 AS s, 0 AS x FROM v_od UNION ALL SELECT core - 1, o, d, 0, trips, 0 FROM v_od UNION ALL SELECT core - 2, o, d, 0, 0, trips FROM v_od"""


@query(
    "core:i o:i d:i trips:f6",
    f"""
SELECT core, o, d, CASE WHEN b <= 0.01 AND x <= 0.01 THEN s WHEN b <= 0.01 THEN s + x WHEN x <= 0.01 THEN 0 WHEN s <= 0.01 THEN GREATEST(x - b, 0)
  WHEN x <= 1.5 * b THEN s * x / b ELSE s * 1.5 + x - 1.5 * b END AS trips
FROM (SELECT core, o, d, SUM(b) AS b, SUM(s) AS s, SUM(x) AS x FROM ({_YEARS}) q GROUP BY core, o, d) y""",
)
def mat_pivot_point(t):
    """Every year pivoted by the change to the second year after it."""
    od = t.od
    seed, new = (od.withColumn("core", F.col("core") - ahead) for ahead in (1, 2))
    return mat.mat_pivot_point(od, seed, new, 1.5, keys=["core"])


@query(
    "core:i o:i pivoted:f6 growth:f6",
    f"""
SELECT core, o, GREATEST(p, 0) AS pivoted, GREATEST(GREATEST(p, 0) - s, 0) AS growth FROM (
 SELECT core, o, s, CASE WHEN f < 0.5 THEN s * f WHEN f > 1.5 THEN s + x - b ELSE (f - 0.5) * (s + x - b) + (1.5 - f) * s * f END AS p FROM (
  SELECT core, o, s, b, x, COALESCE(x / NULLIF(b, 0), 0) AS f FROM (SELECT core, o, SUM(b) AS b, SUM(s) AS s, SUM(x * (1 + o % 3) / 2) AS x FROM ({_YEARS}) v GROUP BY core, o) q) r) w""",
)
def vec_pivot_blend(t):
    trips, core = F.col("trips"), F.col("core")
    grown = trips * (1 + F.col("o") % 3) / 2
    years = F.explode(F.array(*[F.struct((core - ahead).alias("core"), F.lit(n).alias("as"), v.alias("v")) for ahead, n, v in ((0, "base", trips.cast("double")), (1, "seed", trips.cast("double")), (2, "scen", grown.cast("double")))]))
    rows = t.v_od.select("o", years.alias("y")).groupBy("y.core", "o").agg(*[F.sum(F.when(F.col("y.as") == n, F.col("y.v")).otherwise(0.0)).alias(n) for n in ("base", "seed", "scen")])
    return mat.vec_pivot_blend(rows, "seed", "base", "scen")


@query(
    "hhtaz:i ei_gen:f6 sut_gen:f6 mut_gen:f6 cv_gen:f6",
    """
SELECT hhtaz, GREATEST(337.826 - 28.8085 * gen_access + 3.3727 * SQRT(totemp) + 0.6764 * fdl, 0) AS ei_gen, GREATEST(0.983 * bas + 2.429 * ind + 1.6 * ret + 0.3 * srvc + 0.008 * hh, 0) AS sut_gen,
  GREATEST(0.1276 * totemp - 0.1177 * pro + 0.0823 * ind, 0) AS mut_gen, GREATEST(1.11 * bas + 0.938 * ind + 0.888 * ret + 0.437 * srvc + 0.251 * hh, 0) AS cv_gen
FROM (SELECT hhtaz, COUNT(*) AS hh, SUM(hhvehs) AS bas, SUM(hhexpfac) AS ind, SUM(hhparcel) AS ret, SUM(hhparcel % 7) AS srvc, SUM(hhvehs % 2) AS pro, SUM(hhparcel % 5) AS fdl,
 SUM(hhvehs + hhexpfac) AS totemp, CAST(12 + hhtaz % 4 AS DOUBLE) AS gen_access FROM v_household GROUP BY hhtaz) x""",
)
def vec_trip_generation(t):
    parcel, vehs = F.col("hhparcel"), F.col("hhvehs")
    zones = t.v_household.groupBy("hhtaz").agg(
        F.count("*").alias("hh"), F.sum(vehs).alias("bas"), F.sum("hhexpfac").alias("ind"), F.sum(parcel).alias("ret"), F.sum(parcel % 7).alias("srvc"),
        F.sum(vehs % 2).alias("pro"), F.sum(parcel % 5).alias("fdl"), F.sum(vehs + F.col("hhexpfac")).alias("totemp"),
    ).withColumn("gen_access", (12 + F.col("hhtaz") % 4).cast("double"))
    return mat.vec_trip_generation(zones)


@query(
    "core:i z:i a:f6 p50:f6 a50:f6",
    """
WITH m AS (SELECT p.core, p.z, p.p, a.a FROM (SELECT core, o AS z, SUM(trips) AS p FROM v_od GROUP BY 1, 2) p JOIN (SELECT core - 1 AS core, d AS z, SUM(trips) AS a FROM v_od GROUP BY 1, 2) a ON a.z = p.z AND a.core = p.core),
 s AS (SELECT core, SUM(p) AS p, SUM(a) AS a, SUM(CASE WHEN z >= 20 THEN a ELSE 0 END) AS held FROM m GROUP BY core)
SELECT m.core, z, CASE WHEN z >= 20 THEN m.a ELSE m.a * COALESCE((s.p - held) / NULLIF(s.a - held, 0), 0) END AS a, m.p * (0.5 * s.p + 0.5 * s.a) / s.p AS p50, m.a * (0.5 * s.p + 0.5 * s.a) / s.a AS a50
FROM m JOIN s ON s.core = m.core""",
)
def mat_balance_vectors(t):
    """The productions of each year against the attractions of the next."""
    od = t.od
    p = od.groupBy("core", F.col("o").alias("z")).agg(F.sum("trips").alias("p"))
    a = od.groupBy((F.col("core") - 1).alias("core"), F.col("d").alias("z")).agg(F.sum("trips").alias("a"))
    both = p.join(a, ["core", "z"])
    held = mat.mat_balance_vectors(both, "p", "a", hold=F.col("z") >= 20, keys=["core"]).select("core", "z", "a")
    mixed = mat.mat_balance_vectors(both, "p", "a", weight=0.5, keys=["core"]).select("core", "z", F.col("p").alias("p50"), F.col("a").alias("a50"))
    return held.join(mixed, ["core", "z"])


def fit_sql(base, rows, cols, n, key):
    """The fitting iterations written out as common table expressions, a fit for each ``key``."""
    ctes = [f"base AS MATERIALIZED ({base})", f"rt AS MATERIALIZED ({rows})", f"ct AS MATERIALIZED ({cols})", f"b0 AS (SELECT {key}, d, CAST(1 AS DOUBLE) AS f FROM ct)"]
    for i in range(1, n + 1):
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT s.{key}, s.o, COALESCE(target / NULLIF(s, 0), 0) AS f FROM (SELECT {key}, o, SUM(base * f) AS s FROM base JOIN b{i - 1} USING ({key}, d) WHERE base > 0 GROUP BY {key}, o) s LEFT JOIN rt ON rt.o = s.o AND rt.{key} = s.{key})"
        )
        ctes.append(
            f"b{i} AS MATERIALIZED (SELECT s.{key}, s.d, COALESCE(target / NULLIF(s, 0), 0) AS f FROM (SELECT {key}, d, SUM(base * f) AS s FROM base JOIN a{i} USING ({key}, o) WHERE base > 0 GROUP BY {key}, d) s LEFT JOIN ct ON ct.d = s.d AND ct.{key} = s.{key})"
        )
    return (
        "WITH " + ",\n".join(ctes)
        + f"\nSELECT base.{key}, base.o, base.d, base * a{n}.f * b{n}.f AS trips FROM base JOIN a{n} ON a{n}.o = base.o AND a{n}.{key} = base.{key} JOIN b{n} ON b{n}.d = base.d AND b{n}.{key} = base.{key} WHERE base > 0"
    )


# The queries end by their tolerance, far below the digits compared; the SQL runs more rounds.
_TOLERANCE, _SQL_ROUNDS = 1e-11, 40


@query(
    "core:i o:i d:i trips:f4",
    fit_sql(
        "SELECT y.core, s.o, s.d, s.base FROM (SELECT o, d, SUM(trips) AS base FROM v_od GROUP BY o, d) s JOIN (SELECT DISTINCT core FROM v_od) y ON y.core > 0",
        "SELECT core, o, SUM(trips) AS target FROM v_od GROUP BY core, o",
        "SELECT core, d, SUM(trips) AS target FROM v_od GROUP BY core, d",
        12,
        "core",
    ),
)
def mat_growth_factor(t):
    """The matrix of all years grown to the trip ends of each year."""
    od = t.od
    years = od.groupBy("o", "d").agg(F.sum("trips").alias("trips"))
    known = od.agg(F.array_sort(F.collect_set("core"))).scalar()
    seed = years.select(F.explode(known).alias("core"), "o", "d", "trips")
    rows = od.groupBy("core", "o").agg(F.sum("trips").alias("target"))
    cols = od.groupBy("core", "d").agg(F.sum("trips").alias("target"))
    return mat.mat_growth_factor(seed, rows, cols, tol=_TOLERANCE, keys=["core"])


_SHIPPED = "(SELECT CAST(l_suppkey % 25 AS INT) AS o, CAST(l_orderkey % 25 AS INT) AS d, 1 + l_linenumber % 3 AS period, l_quantity AS q FROM lineitem)"


@query(
    "period:i o:i d:i trips:f4",
    fit_sql(
        "SELECT period, o, d, EXP(-0.3126 * imp / 5) * (1 + (o + d) % 3) AS base FROM v_skim",
        f"SELECT period, o, SUM(q) AS target FROM {_SHIPPED} x GROUP BY period, o",
        f"SELECT period, d, SUM(q) AS target FROM {_SHIPPED} x GROUP BY period, d",
        _SQL_ROUNDS,
        "period",
    ),
)
def mat_gravity(t):
    """Trips of each period between the zones of its skim."""
    ends = t.lineitem.select((F.col("l_suppkey") % 25).cast("int").alias("o"), (F.col("l_orderkey") % 25).cast("int").alias("d"), (1 + F.col("l_linenumber") % 3).alias("period"), "l_quantity")
    ends = cut_lineage(ends.groupBy("period", "o", "d").agg(F.sum("l_quantity").alias("q")))
    rows = ends.groupBy("period", "o").agg(F.sum("q").alias("target"))
    cols = ends.groupBy("period", "d").agg(F.sum("q").alias("target"))
    skim = t.v_skim.withColumn("k", 1 + (F.col("o") + F.col("d")) % 3)
    return mat.mat_gravity(skim, rows, cols, 0.3126 / 5, "k", tol=_TOLERANCE, keys=["period"])


@query(
    "period:i o:i d:i imp:f6",
    """
SELECT period, o, d, CAST(imp AS DOUBLE) AS imp FROM v_skim WHERE o <> d UNION ALL
SELECT period, o, o, 0.25 * AVG(imp) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY period, o ORDER BY imp, d) AS r FROM v_skim WHERE o <> d) x WHERE r <= 3 GROUP BY period, o""",
)
def mat_intrazonal(t):
    return mat.mat_intrazonal(t.v_skim, ["period"], neighbours=3)


@query(
    "o:i d:i period:i share:f8",
    """
SELECT o, d, period, EXP((u - m) / 0.6) / s * EXP(l) / (SUM(EXP(l) / n) OVER (PARTITION BY o, d)) AS share FROM (
 SELECT *, m + 0.6 * LN(s) AS l FROM (SELECT *, SUM(EXP((u - m) / 0.6)) OVER (PARTITION BY o, d, nest) AS s, COUNT(*) OVER (PARTITION BY o, d, nest) AS n FROM (
  SELECT *, MAX(u) OVER (PARTITION BY o, d, nest) AS m FROM (SELECT o, d, period, -0.1 * imp - 0.2 * period AS u, CASE WHEN period <= 2 THEN 'car' ELSE 'bus' END AS nest FROM v_skim) a) b) c) e""",
)
def mat_logit_shares(t):
    util = t.v_skim.withColumn("u", -0.1 * F.col("imp") - 0.2 * F.col("period"))
    return mat.mat_logit_shares(util, ["o", "d"], "period", "u", {1: "car", 2: "car", 3: "bus"}, 0.6)


@query(
    "o:i d:i core:i same:i",
    "SELECT o, d, core, CASE WHEN a.district = b.district THEN 1 ELSE 0 END AS same FROM v_od JOIN v_zone a ON a.taz = o JOIN v_zone b ON b.taz = d",
)
def mat_common_value(t):
    return mat.mat_common_value(t.v_od, t.v_zone, "taz", "district")


@query(
    "o:i d:i trips:f6",
    """
WITH cell AS (SELECT CAST(l_suppkey % 25 AS INT) AS o, CAST(l_orderkey % 25 AS INT) AS d, SUM(l_quantity) AS trips FROM lineitem GROUP BY 1, 2),
 path AS (SELECT DISTINCT CAST(l_suppkey % 25 AS INT) AS o, CAST(l_orderkey % 25 AS INT) AS d, l_partkey AS link FROM lineitem),
 r AS (SELECT id AS link, CASE WHEN ab_am_auto > 1 THEN LEAST(CAST(aadt AS DOUBLE) / ab_am_auto, 10) END AS r FROM v_link WHERE aadt > 0),
 f AS (SELECT o, d, SUM(r) / COUNT(*) AS f FROM path JOIN r USING (link) GROUP BY 1, 2)
SELECT c.o, c.d, LEAST(GREATEST(trips * COALESCE(f, 1), trips * 0.5), trips * 8) AS trips FROM cell c LEFT JOIN f ON f.o = c.o AND f.d = c.d""",
)
def mat_odme_factor(t):
    li = t.lineitem.select((F.col("l_suppkey") % 25).cast("int").alias("o"), (F.col("l_orderkey") % 25).cast("int").alias("d"), F.col("l_partkey").alias("link"), "l_quantity")
    od = li.groupBy("o", "d").agg(F.sum("l_quantity").alias("trips")).withColumns({"low": F.col("trips") * 0.5, "high": F.col("trips") * 8})
    links = t.v_link.select(F.col("id").alias("link"), F.col("aadt").alias("count"), F.col("ab_am_auto").alias("volume"))
    return mat.mat_odme_factor(od, li.select("o", "d", "link").distinct(), links, "low", "high")
