"""Driver forms: joins and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, spatial
from .registry import query


@query(
    "l_orderkey:i l_linenumber:i o_custkey:i",
    "SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
)
def join_left_multi(t):
    return joins.join_left_multi(t.lineitem, t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"])


@query("o_orderkey:i c_name:s", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t):
    return joins.join_inner(t.orders, t.customer.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


@query(
    "c_custkey:i n:i spent:f2",
    """
SELECT c_custkey, COALESCE(n, 0) AS n, COALESCE(spent, 0) AS spent FROM customer LEFT JOIN
 (SELECT o_custkey, COUNT(*) AS n, SUM(o_totalprice) AS spent FROM orders GROUP BY o_custkey) s ON c_custkey = o_custkey""",
)
def join_left_outer_sub(t):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return joins.join_left_outer_sub(t.customer, orders, ["c_custkey"], {"n": F.count("*"), "spent": F.sum("o_totalprice")})


@query(
    "zone:i customers:i suppliers:i",
    """
SELECT COALESCE(a.zone, b.zone) AS zone, customers, suppliers FROM (SELECT c_custkey AS zone, COUNT(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY 1) a
FULL JOIN (SELECT s_suppkey AS zone, COUNT(*) AS suppliers FROM supplier GROUP BY 1) b ON a.zone = b.zone""",
)
def join_outer(t):
    a = t.customer.filter("c_acctbal > 0").groupBy(F.col("c_custkey").alias("zone")).agg(F.count("*").alias("customers"))
    b = t.supplier.groupBy(F.col("s_suppkey").alias("zone")).agg(F.count("*").alias("suppliers"))
    return joins.join_outer(a, b, ["zone"])


@query(
    "p_partkey:i sold:b",
    "SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) AS sold FROM part",
)
def join_semi_anti(t):
    keys = t.lineitem.filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    kept = joins.join_semi_anti(t.part, keys, ["p_partkey"]).withColumn("sold", F.lit(True))
    return kept.unionByName(joins.join_semi_anti(t.part, keys, ["p_partkey"], keep=False).withColumn("sold", F.lit(False)))


@query(
    "c_custkey:i region:s",
    """
SELECT c_custkey, COALESCE(z.n_name, 'none') AS region FROM customer LEFT JOIN
 (SELECT n_regionkey, MIN(n_name) AS n_name FROM nation GROUP BY n_regionkey) z ON c_nationkey = z.n_regionkey""",
)
def join_lookup_broadcast(t):
    return joins.join_lookup_broadcast(t.customer, t.nation, "c_nationkey", "n_regionkey", "n_name", "region", "none")


@query(
    "tour_key:i period:i imp:i",
    """
SELECT t.tour_key, t.period, s.imp FROM (SELECT tour_key, totaz AS o, tdtaz AS d, CASE WHEN tardest BETWEEN 360 AND 539 THEN 1 WHEN tardest BETWEEN 900 AND 1079 THEN 2 ELSE 3 END AS period FROM v_tour) t
LEFT JOIN v_skim s ON s.o = t.o AND s.d = t.d AND s.period = t.period""",
)
def join_lookup_composite(t):
    am, pm = F.col("tardest").between(360, 539), F.col("tardest").between(900, 1079)
    tours = t.v_tour.select("tour_key", F.col("totaz").alias("o"), F.col("tdtaz").alias("d"), F.when(am, 1).when(pm, 2).otherwise(3).alias("period"))
    return joins.join_lookup_composite(tours, t.v_skim, ["period", "o", "d"], ["imp"])


@query(
    "mz_id:i tract:i puma:i pop:f2",
    """
SELECT c.mz_id, c.tract, COALESCE(n.size1, c.puma) AS puma, c.pop FROM v_cwalk c LEFT JOIN
 (SELECT p_partkey % 103 AS tract, MIN(p_size) AS size1 FROM part WHERE p_retailprice > 950 GROUP BY 1) n ON n.tract = c.tract""",
)
def join_update_from(t):
    src = t.part.filter("p_retailprice > 950").select((F.col("p_partkey") % 103).cast("int").alias("tract"), F.col("p_size").alias("puma"))
    return joins.join_update_from(t.v_cwalk, src, ["tract"], ["puma"], ["puma"])


@query(
    "tour_key:i tour:i parent_mode:i",
    """
SELECT a.tour_key, a.tour, CASE WHEN a.parent > 0 THEN b.tmodetp ELSE 9 END AS parent_mode
FROM v_tour a LEFT JOIN v_tour b ON a.hhno = b.hhno AND a.parent = b.tour""",
)
def join_self_parent(t):
    return joins.join_self_parent(t.v_tour, ["hhno"], "tour", "parent", "tmodetp", 9, "parent_mode")


@query(
    "l_orderkey:i l_linenumber:i c_nationkey:i zname:s",
    """
SELECT l_orderkey, l_linenumber, c_nationkey, n_name AS zname FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def join_chain3(t):
    trips = t.lineitem.select("l_orderkey", "l_linenumber")
    tours = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    full = joins.join_chain3(trips, tours, t.customer.select("c_custkey", "c_nationkey"), ["l_orderkey"], ["c_custkey"])
    return joins.join_inner(full, t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("zname")), ["c_nationkey"])


@query(
    "p_partkey:i status:s stop:i",
    """
WITH stops AS (SELECT p_name AS nm, MIN(p_partkey) AS stop FROM part WHERE p_size <= 25 GROUP BY 1
  UNION ALL SELECT REPLACE(p_name, ' ', '') AS nm, MIN(p_partkey) AS stop FROM part WHERE p_size > 40 GROUP BY 1),
 ex AS (SELECT nm, MIN(stop) AS stop FROM stops GROUP BY nm), nrm AS (SELECT REPLACE(nm, ' ', '') AS nm, MIN(stop) AS stop FROM stops GROUP BY 1)
SELECT p_partkey, CASE WHEN ex.stop IS NOT NULL THEN 'exact' WHEN nrm.stop IS NOT NULL THEN 'normalised' ELSE 'unmatched' END AS status, COALESCE(ex.stop, nrm.stop) AS stop
FROM (SELECT p_partkey, CASE WHEN p_size >= 45 THEN CONCAT(p_name, ' x') WHEN p_size > 25 THEN CONCAT(' ', p_name) ELSE p_name END AS nm FROM part) p
LEFT JOIN ex ON ex.nm = p.nm LEFT JOIN nrm ON nrm.nm = REPLACE(p.nm, ' ', '')""",
)
def join_key_fallback(t):
    def plain(c):
        return F.replace(c, F.lit(" "), F.lit(""))

    named = F.when(F.col("p_size") >= 45, F.concat("p_name", F.lit(" x"))).when(F.col("p_size") > 25, F.concat(F.lit(" "), "p_name"))
    a = t.part.select("p_partkey", named.otherwise(F.col("p_name")).alias("nm"))
    b = t.part.filter("p_size <= 25").groupBy(F.col("p_name").alias("nm")).agg(F.min("p_partkey").alias("stop"))
    c = t.part.filter("p_size > 40").groupBy(plain(F.col("p_name")).alias("nm")).agg(F.min("p_partkey").alias("stop"))
    return joins.join_key_fallback(a, b.unionByName(c), "nm", plain, "stop")


@query(
    "respondent:i route_id:i n_stops:i",
    """
SELECT s.respondent, s.route_id, a.n_stops FROM (SELECT respondent, CASE WHEN respondent % 10 = 0 THEN CAST(SPLIT_PART(label, '-', 1) AS INT) ELSE route END AS route_id
  FROM (SELECT respondent, route, CONCAT(CAST(route AS VARCHAR), '-line') AS label FROM v_survey) q) s
LEFT JOIN (SELECT route, COUNT(DISTINCT stop_id) AS n_stops FROM v_apc GROUP BY route) a ON a.route = s.route_id""",
)
def join_null_key_repair(t):
    sv = t.v_survey.select(
        "respondent",
        F.when(F.col("respondent") % 10 != 0, F.col("route")).alias("route_id"),
        F.concat(F.col("route").cast("string"), F.lit("-line")).alias("label"),
    )
    fixed = joins.join_null_key_repair(sv, "route_id", "label")
    stops = t.v_apc.select("route", "stop_id").distinct().groupBy(F.col("route").alias("route_id")).agg(F.count("*").alias("n_stops"))
    return joins.join_left_multi(fixed, stops, ["route_id"])


@query("respondent:i grade:i", "SELECT respondent, COALESCE(confidence, hr) AS grade FROM v_survey")
def join_override_precedence(t):
    return joins.join_override_precedence(t.v_survey, "hr", "confidence", "grade")


@query(
    "hhno:i n:i",
    "SELECT hhno, n FROM (SELECT hhno, UNNEST(RANGE(1, CAST(hhvehs AS BIGINT) + 1)) AS n FROM v_household) x",
)
def join_theta_expand(t):
    return joins.join_theta_expand(t.v_household, "hhvehs")


@query(
    "node:i in_funcclass:i out_funcclass:i n_pairs:i",
    """
SELECT a.to_id AS node, a.funcclass AS in_funcclass, b.funcclass AS out_funcclass, COUNT(*) AS n_pairs
FROM v_link a JOIN v_link b ON a.to_id = b.from_id WHERE a.from_id <> b.to_id GROUP BY 1, 2, 3""",
)
def join_in_out_links(t):
    return joins.join_in_out_links(t.v_link, ["funcclass"])


@query(
    "id:i n_upstream:i first_upstream:i n_downstream:i first_downstream:i",
    """
SELECT l.id, COALESCE(u.n, 0) AS n_upstream, u.f AS first_upstream, COALESCE(w.n, 0) AS n_downstream, w.f AS first_downstream FROM v_link l
LEFT JOIN (SELECT to_id, COUNT(*) AS n, MIN(id) AS f FROM v_link GROUP BY 1) u ON u.to_id = l.from_id
LEFT JOIN (SELECT from_id, COUNT(*) AS n, MIN(id) AS f FROM v_link GROUP BY 1) w ON w.from_id = l.to_id""",
)
def join_endpoint_match(t):
    return joins.join_endpoint_match(t.v_link)


# A rectangle, a triangle and a concave hexagon over the range of the points.
RINGS = [
    (1, [(-0.30, -0.30), (0.00, -0.30), (0.00, 0.00), (-0.30, 0.00)]),
    (2, [(0.01, -0.30), (0.30, -0.20), (0.02, 0.05)]),
    (3, [(-0.25, 0.02), (0.00, 0.06), (0.28, 0.02), (0.20, 0.30), (0.00, 0.12), (-0.20, 0.30)]),
]


def rings(spark):
    return spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in RINGS], "pid int, ring array<struct<x:double,y:double>>")


RINGS_SQL = "(SELECT * FROM (VALUES {}) AS e(pid, x1, y1, x2, y2))".format(
    ", ".join(
        f"({i}, CAST({a[0]} AS DOUBLE), CAST({a[1]} AS DOUBLE), CAST({b[0]} AS DOUBLE), CAST({b[1]} AS DOUBLE))"
        for i, r in RINGS
        for a, b in zip(r, r[1:] + r[:1], strict=True)
    )
)
PIP_SQL = f"""SELECT p.id, p.x, p.y, p.label, e.pid FROM v_point p, {RINGS_SQL} e
WHERE (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
GROUP BY p.id, p.x, p.y, p.label, e.pid HAVING COUNT(*) % 2 = 1"""


@query("id:i pid:i", f"SELECT v.id, q.pid FROM v_point v LEFT JOIN ({PIP_SQL}) q ON q.id = v.id")
def join_point_in_polygon(t):
    return spatial.join_point_in_polygon(t.v_point, rings(t.spark), "x", "y", "pid", "ring", 0.05, how="left")


SITES_SQL = "SELECT label AS site, ROUND(AVG(x), 9) AS x, ROUND(AVG(y), 9) AS y FROM v_point GROUP BY label"


def sites(t):
    return t.v_point.groupBy(F.col("label").alias("site")).agg(F.round(F.avg("x"), 9).alias("x"), F.round(F.avg("y"), 9).alias("y"))


@query(
    "id:i site:i dist:f6",
    f"""
SELECT id, ARG_MIN(site, dd) AS site, MIN(dd) AS dist FROM (
 SELECT p.id, s.site, SQRT((s.x - p.x) * (s.x - p.x) + (s.y - p.y) * (s.y - p.y)) AS dd FROM v_point p, ({SITES_SQL}) s) q GROUP BY id""",
)
def join_nearest(t):
    return spatial.join_nearest(t.v_point, sites(t), "id", "site")


@query(
    "site:i n:i weight:i",
    f"""
SELECT s.site, COALESCE(SUM(CASE WHEN q.id IS NOT NULL THEN 1 END), 0) AS n, COALESCE(SUM(q.label), 0) AS weight FROM ({SITES_SQL}) s
LEFT JOIN v_point q ON (q.x - s.x) * (q.x - s.x) + (q.y - s.y) * (q.y - s.y) <= 0.08 * 0.08 GROUP BY s.site""",
)
def join_buffer_aggregate(t):
    return spatial.join_buffer_aggregate(sites(t), t.v_point, "site", 0.08, {"n": F.lit(1), "weight": F.col("label")})
