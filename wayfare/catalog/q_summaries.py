"""Driver forms: aggregations, tabulations and fit statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import recode
from ..operators import aggregates as agg
from .registry import query


@query("dtaz:i dist:f2 trips:i", "SELECT dtaz, SUM(travdist * trexpfac) AS dist, SUM(trexpfac) AS trips FROM v_trip GROUP BY dtaz")
def agg_group_sum(t):
    return agg.agg_group_sum(t.v_trip, ["dtaz"], {"dist": F.col("travdist") * F.col("trexpfac"), "trips": F.col("trexpfac")})


@query(
    "l_returnflag:s mean:f4",
    """
SELECT l_returnflag, SUM(l_extendedprice * l_quantity) / SUM(l_quantity) AS mean FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'total', SUM(l_extendedprice * l_quantity) / SUM(l_quantity) FROM lineitem""",
)
def agg_group_mean_weighted(t):
    return agg.agg_group_mean_weighted(t.lineitem, "l_returnflag", "l_extendedprice", "l_quantity")


@query("route:i n:i", "SELECT route, COUNT(*) AS n FROM v_survey GROUP BY route")
def agg_count(t):
    return agg.agg_count(t.v_survey, ["route"])


@query("route:i n:i", "SELECT route, COUNT(confidence) AS n FROM v_survey GROUP BY route")
def agg_count_nonnull(t):
    return agg.agg_count_nonnull(t.v_survey, ["route"], "confidence")


@query("n_ids:i n_rows:i", "SELECT COUNT(DISTINCT hhno) AS n_ids, COUNT(*) AS n_rows FROM v_trip")
def agg_distinct_count(t):
    return agg.agg_distinct_count(t.v_trip, ["hhno"])


@query(
    "l_partkey:i sum_l_quantity:f2 max_l_quantity:f2 min_l_extendedprice:f2 avg_l_extendedprice:f7 count_l_quantity:i",
    """
SELECT l_partkey, SUM(l_quantity) AS sum_l_quantity, MAX(l_quantity) AS max_l_quantity, MIN(l_extendedprice) AS min_l_extendedprice,
       AVG(l_extendedprice) AS avg_l_extendedprice, COUNT(l_quantity) AS count_l_quantity FROM lineitem GROUP BY l_partkey""",
)
def agg_multi_stat(t):
    return agg.agg_multi_stat(t.lineitem, ["l_partkey"], {"l_quantity": ["sum", "max", "count"], "l_extendedprice": ["min", "avg"]})


@query(
    "tract_id:s county:s cns05:i cns07:i",
    """
SELECT SUBSTRING(w_geocode, 1, 11) AS tract_id, MIN(SUBSTRING(w_geocode, 3, 3)) AS county, SUM(cns05) AS cns05, SUM(cns07) AS cns07 FROM v_jobs GROUP BY 1""",
)
def agg_first_by_key(t):
    jobs = t.v_jobs.withColumns({"tract_id": F.substring("w_geocode", 1, 11), "county": F.substring("w_geocode", 3, 3)})
    return agg.agg_first_by_key(jobs, ["tract_id"], ["county"], ["cns05", "cns07"])


@query(
    "user_id:i mean:f6",
    "SELECT user_id, AVG(s) AS mean FROM (SELECT user_id, CAST(ts AS DATE) AS day, SUM(value) AS s FROM events GROUP BY 1, 2) x GROUP BY user_id",
)
def agg_two_level(t):
    return agg.agg_two_level(t.events.withColumn("day", F.col("ts").cast("date")), ["user_id"], ["day"], "value")


@query(
    "shipyear:i qty_A:f2 qty_N:f2 qty_R:f2",
    """
SELECT YEAR(l_shipdate) AS shipyear, SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS "qty_A",
       SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS "qty_N", SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS "qty_R" FROM lineitem GROUP BY 1""",
)
def agg_pivot(t):
    return agg.agg_pivot(t.lineitem.withColumn("shipyear", F.year("l_shipdate")), ["shipyear"], "l_returnflag", "l_quantity", ["A", "N", "R"], "qty_")


@query(
    "o_orderpriority:s st_F:i st_O:i st_P:i total:i",
    """
SELECT COALESCE(o_orderpriority, 'Total') AS o_orderpriority, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS "st_F", COUNT(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS "st_O",
       COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS "st_P", COUNT(*) AS total FROM orders GROUP BY ROLLUP (o_orderpriority)""",
)
def agg_pivot_margins(t):
    return agg.agg_pivot_margins(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], "st_")


@query(
    "band:i l_linenumber:i value:f2",
    """
SELECT g.band, h.l_linenumber, COALESCE(v, 0) AS value FROM (SELECT UNNEST(RANGE(0, 8)) AS band) g CROSS JOIN (SELECT UNNEST(RANGE(1, 10)) AS l_linenumber) h
LEFT JOIN (SELECT CAST(FLOOR(l_quantity / 8) AS INT) AS band, l_linenumber, SUM(l_quantity) AS v FROM lineitem WHERE l_discount > 0.02 GROUP BY 1, 2) a
 ON a.band = g.band AND a.l_linenumber = h.l_linenumber""",
)
def agg_crosstab_complete(t):
    banded = t.lineitem.withColumn("band", F.floor(F.col("l_quantity") / 8).cast("int"))
    return agg.agg_crosstab_complete(banded, "band", (0, 7), "l_linenumber", (1, 9), "l_quantity", F.col("l_discount") > 0.02)


TEMPLATES = [
    agg.Template(1, "qty", (1, 51), "l_linenumber", (1, 7), "l_quantity"),
    agg.Template(2, "qty", (1, 60)),
    agg.Template(3, "l_linenumber", (1, 7), None, (1, 1), None, ("l_discount", ">", 0.05)),
    agg.Template(4, "l_linenumber", (1, 4), "qty", (1, 10), None, ("l_tax", "<=", 0.04)),
    agg.Template(5, "l_extendedprice", (0, 0), "l_linenumber", (1, 7), "l_quantity", None, "mean"),
    agg.Template(6, "l_quantity", (0, 0), "l_linenumber", (1, 7), None, ("l_linenumber", "!=", 4), "sum"),
]

_BASE = "(SELECT *, CAST(l_quantity AS INT) AS qty FROM lineitem) b"


def _grid(n, xs, ys, body):
    return f"""SELECT {n} AS outnum, g.x, h.y, COALESCE(v, 0) AS value FROM (SELECT UNNEST(RANGE({xs[0]}, {xs[1] + 1})) AS x) g
CROSS JOIN (SELECT UNNEST(RANGE({ys[0]}, {ys[1] + 1})) AS y) h LEFT JOIN ({body}) a ON a.x = g.x AND a.y = h.y"""


TEMPLATE_SQL = "\nUNION ALL ".join(
    [
        _grid(1, (1, 51), (1, 7), f"SELECT qty AS x, l_linenumber AS y, SUM(l_quantity) AS v FROM {_BASE} GROUP BY 1, 2"),
        _grid(2, (1, 60), (1, 1), f"SELECT qty AS x, 1 AS y, COUNT(*) AS v FROM {_BASE} GROUP BY 1, 2"),
        _grid(3, (1, 7), (1, 1), f"SELECT l_linenumber AS x, 1 AS y, COUNT(*) AS v FROM {_BASE} WHERE l_discount > 0.05 GROUP BY 1, 2"),
        _grid(4, (1, 4), (1, 10), f"SELECT l_linenumber AS x, qty AS y, COUNT(*) AS v FROM {_BASE} WHERE l_tax <= 0.04 GROUP BY 1, 2"),
        "SELECT 5, 0, l_linenumber, SUM(l_extendedprice * l_quantity) / SUM(l_quantity) FROM lineitem GROUP BY l_linenumber",
        "SELECT 5, 0, 8, SUM(l_extendedprice * l_quantity) / SUM(l_quantity) FROM lineitem",
        "SELECT 6, 0, l_linenumber, SUM(l_quantity) FROM lineitem WHERE l_linenumber <> 4 GROUP BY l_linenumber",
    ]
)


@query("outnum:i x:i y:i value:f4", TEMPLATE_SQL)
def agg_template_tabulate(t):
    return agg.agg_template_tabulate(t.lineitem.withColumn("qty", F.col("l_quantity").cast("int")), TEMPLATES)


def _smooth_sql(passes):
    steps = [
        """h0 AS (SELECT h.y, g.x, CAST(COALESCE(v, 0) AS DOUBLE) AS v FROM (SELECT UNNEST(RANGE(1, 52)) AS x) g CROSS JOIN (SELECT UNNEST(RANGE(1, 8)) AS y) h
 LEFT JOIN (SELECT l_linenumber AS y, CAST(l_quantity AS INT) AS x, COUNT(*) AS v FROM lineitem GROUP BY 1, 2) a ON a.x = g.x AND a.y = h.y)"""
    ]
    for i in range(1, passes + 1):
        win = "OVER (PARTITION BY y ORDER BY x)"
        steps.append(f"h{i} AS (SELECT y, x, COALESCE(0.25 * LAG(v) {win} + 0.5 * v + 0.25 * LEAD(v) {win}, v) AS v FROM h{i - 1})")
    return "WITH " + ",\n".join(steps) + f"\nSELECT y, x, v FROM h{passes}"


@query("y:i x:i v:f6", _smooth_sql(10))
def agg_smooth_distribution(t):
    hist = t.lineitem.withColumns({"x": F.col("l_quantity").cast("int"), "y": F.col("l_linenumber")})
    cells = agg.agg_crosstab_complete(hist, "x", (1, 51), "y", (1, 7), F.lit(1), out="v")
    return agg.agg_smooth_distribution(cells, ["y"], "x", "v")


@query(
    "o_district:i d_district:i trips:f2",
    "SELECT a.district AS o_district, b.district AS d_district, SUM(trips) AS trips FROM v_od JOIN v_zone a ON a.taz = o JOIN v_zone b ON b.taz = d GROUP BY 1, 2",
)
def agg_matrix_district(t):
    return agg.agg_matrix_district(t.v_od, t.v_zone, "taz", "district")


@query(
    "o:i d:i core:s trips:f6",
    """
SELECT otaz AS o, dtaz AS d, CONCAT(CASE WHEN tmode <= 3 THEN 'auto' ELSE 'other' END, '_', CASE WHEN deptm >= 360 AND deptm < 540 THEN 'AM' WHEN deptm >= 900 AND deptm < 1080 THEN 'PM' ELSE 'OP' END) AS core,
       SUM(CASE WHEN tmode = 2 THEN 0.5 ELSE 1.0 END) AS trips FROM v_trip GROUP BY 1, 2, 3""",
)
def agg_matrix_build(t):
    from ..functions.scalar import fn_tod_period

    core = F.concat_ws("_", F.when(F.col("tmode") <= 3, "auto").otherwise("other"), fn_tod_period("deptm"))
    return agg.agg_matrix_build(t.v_trip, "otaz", "dtaz", core, F.when(F.col("tmode") == 2, 0.5).otherwise(1.0))


@query(
    "core:i total:f2 cells:i largest:f2 diagonal:f2 n_rows:i largest_row:f2",
    """
SELECT core, SUM(s) AS total, SUM(n) AS cells, MAX(m) AS largest, SUM(g) AS diagonal, COUNT(*) AS n_rows, MAX(s) AS largest_row FROM
 (SELECT core, o, SUM(trips) AS s, COUNT(*) AS n, MAX(trips) AS m, SUM(CASE WHEN o = d THEN trips ELSE 0 END) AS g FROM v_od GROUP BY core, o) x GROUP BY core""",
)
def agg_matrix_stats(t):
    return agg.agg_matrix_stats(t.v_od)


@query(
    "start_district:i end_district:i total:i pct:f6",
    """
SELECT start_district, end_district, COUNT(*) AS total, 100.0 * COUNT(*) / SUM(COUNT(*)) OVER () AS pct FROM v_probe
WHERE start_district <> -1 AND end_district <> -1 GROUP BY 1, 2""",
)
def agg_percent_of_total(t):
    unknown = (F.col("start_district") == -1) | (F.col("end_district") == -1)
    return agg.agg_percent_of_total(t.v_probe, ["start_district", "end_district"], F.count("*"), unknown)


# Volume bands of the count comparison, [from, to).
BANDS = [
    ("<1,000", 0, 1000),
    ("1,000-2,500", 1000, 2500),
    ("2,500-5,000", 2500, 5000),
    ("5,000-10,000", 5000, 10000),
    ("10,000-25,000", 10000, 25000),
    ("25,000-50,000", 25000, 50000),
    (">50,000", 50000, float("inf")),
]


@query(
    "band:s n:i mean_flow:f4 mean_count:f4 pct_error:f4",
    """
SELECT band, COUNT(*) AS n, AVG(vol) AS mean_flow, AVG(aadt) AS mean_count, (AVG(vol) / AVG(aadt) - 1) * 100 AS pct_error FROM (
 SELECT CASE WHEN aadt < 1000 THEN '<1,000' WHEN aadt < 2500 THEN '1,000-2,500' WHEN aadt < 5000 THEN '2,500-5,000' WHEN aadt < 10000 THEN '5,000-10,000'
  WHEN aadt < 25000 THEN '10,000-25,000' WHEN aadt < 50000 THEN '25,000-50,000' ELSE '>50,000' END AS band, aadt, 6 * ab_am_auto AS vol FROM v_link WHERE aadt IS NOT NULL) x GROUP BY band""",
)
def agg_band_performance(t):
    return agg.agg_band_performance(t.v_link.withColumn("vol", 6 * F.col("ab_am_auto")), "aadt", "vol", BANDS)


_VAL_PREDS = [
    ("All", "All", "l_quantity > 0"),
    ("Flag", "A", "l_returnflag = 'A'"),
    ("Flag", "R", "l_returnflag = 'R'"),
    ("Line", "first", "l_linenumber = 1"),
    ("Line", "none", "l_linenumber > 99"),
]


@query(
    "kind:s item:s num_obs:i tot_cnt:f2 tot_mod:f2 avg_cnt:f4 avg_mod:f4 tstat:f4 pct_err:f4 pct_rmse:f4 mape:f4 corr:f6 miles:f2 vmt:f2 avg_cnt_miles:f2",
    "\nUNION ALL ".join(
        f"""
SELECT '{k}' AS kind, '{i}' AS item, n AS num_obs, COALESCE(tc, 0) AS tot_cnt, COALESCE(tm, 0) AS tot_mod, COALESCE(ac, 0) AS avg_cnt, COALESCE(am, 0) AS avg_mod,
 COALESCE((am - ac) / SQRT((sc * sc + sm * sm) / n), 0) AS tstat, COALESCE(100 * (am - ac) / ac, 0) AS pct_err, COALESCE(100 * SQRT(mse) / ac, 0) AS pct_rmse, COALESCE(mape, 0) AS mape,
 COALESCE((n - 1) * cv / GREATEST(1, (n - 1) * sc * sm), 0) AS corr, COALESCE(mi, 0) AS miles, COALESCE(vm, 0) AS vmt, COALESCE(ac * mi, 0) AS avg_cnt_miles
FROM (SELECT COUNT(c) AS n, SUM(c) AS tc, SUM(CASE WHEN c IS NOT NULL THEN v END) AS tm, AVG(c) AS ac, AVG(CASE WHEN c IS NOT NULL THEN v END) AS am, STDDEV_SAMP(c) AS sc,
  STDDEV_SAMP(CASE WHEN c IS NOT NULL THEN v END) AS sm, AVG((v - c) * (v - c)) AS mse, 100 * AVG(ABS(v - c) / c) AS mape, COVAR_SAMP(c, v) AS cv, SUM(mi) AS mi, SUM(v * mi) AS vm
 FROM (SELECT CASE WHEN l_extendedprice > 20000 THEN l_extendedprice END AS c, l_quantity * 1500 AS v, l_quantity / 10 AS mi FROM lineitem WHERE {p}) x) y"""
        for k, i, p in _VAL_PREDS
    ),
)
def agg_validation_stats(t):
    counts = t.lineitem.withColumns(
        {"cnt": F.when(F.col("l_extendedprice") > 20000, F.col("l_extendedprice")), "vol": F.col("l_quantity") * 1500, "miles": F.col("l_quantity") / 10}
    )
    return agg.agg_validation_stats(counts, [(k, i, F.expr(p)) for k, i, p in _VAL_PREDS], "cnt", "vol", "miles")


@query(
    "cells:i rmse:f4 rel_rmse:f4 pct_diff:f6 prmsd:f6",
    """
SELECT cells, SQRT(sse / cells) AS rmse, 100 * SQRT(sse / cells) / (b / cells) AS rel_rmse, 100 * (a - b) / b AS pct_diff, SQRT(sse / cells) / (a / cells) AS prmsd FROM (
 SELECT COUNT(*) AS cells, SUM((x - y) * (x - y)) AS sse, SUM(x) AS a, SUM(y) AS b FROM (SELECT COALESCE(p.trips, 0) AS x, COALESCE(q.trips, 0) AS y
  FROM (SELECT * FROM v_od WHERE core = 1997) p FULL JOIN (SELECT * FROM v_od WHERE core = 1996) q ON p.o = q.o AND p.d = q.d) u) w""",
)
def agg_matrix_rmse(t):
    od = t.od
    return agg.agg_matrix_rmse(od.filter("core = 1997"), od.filter("core = 1996"))


@query(
    "veh:s tod:s flow:i vmt:f2 vht:f4",
    "SELECT veh, tod, SUM(flow) AS flow, SUM(flow * length) AS vmt, SUM(flow * (60 * length / spd_lmt) / 60) AS vht FROM ("
    + " UNION ALL ".join("SELECT '{2}' AS veh, '{1}' AS tod, {3} AS flow, length, spd_lmt FROM v_link".format(*c.split("_"), c) for c in ("ab_am_auto", "ba_am_auto", "ab_pm_auto", "ba_pm_auto", "ab_am_sut", "ba_am_sut"))
    + ") x WHERE flow > 0 GROUP BY veh, tod",
)
def agg_vmt_vht(t):
    cols = ["ab_am_auto", "ba_am_auto", "ab_pm_auto", "ba_pm_auto", "ab_am_sut", "ba_am_sut"]
    long = recode.project_unpivot(t.v_link, ["id", "length", "spd_lmt"], cols, ["dir", "tod", "veh"], "flow").filter("flow > 0")
    return agg.agg_vmt_vht(long, ["veh", "tod"], "flow", "length", 60 * F.col("length") / F.col("spd_lmt"))


_VC = [("All", "All", "id >= 0"), ("Access", "full", "access = 3"), ("Class", "1", "funcclass = 1"), ("Class", "none", "funcclass = 42")]


@query(
    "kind:s item:s miles:f4 vmt:f2 vht:f4 wtd_vc:f6 avg_speed:f4",
    "\nUNION ALL ".join(
        f"""
SELECT '{k}' AS kind, '{i}' AS item, COALESCE(SUM(length), 0) AS miles, COALESCE(SUM(vol * length), 0) AS vmt, COALESCE(SUM(vol * length / spd_lmt), 0) AS vht,
  COALESCE(SUM(vol * length * vol / 1800) / SUM(vol * length), 0) AS wtd_vc, COALESCE(SUM(vol * length) / SUM(vol * length / spd_lmt), 0) AS avg_speed
FROM (SELECT *, ab_am_auto + ab_am_sut AS vol FROM v_link) x WHERE {p}"""
        for k, i, p in _VC
    ),
)
def agg_weighted_vc(t):
    vol = F.col("ab_am_auto") + F.col("ab_am_sut")
    preds = [(k, i, F.expr(p)) for k, i, p in _VC]
    return agg.agg_weighted_vc(t.v_link, preds, vol, F.col("length"), 60 * F.col("length") / F.col("spd_lmt"), vol / 1800)


@query(
    "user_id:i total:i diversity:f6",
    """
SELECT user_id, SUM(a) AS total, 1 - CAST(SUM(a * a) AS DOUBLE) / (SUM(a) * SUM(a)) AS diversity FROM (SELECT user_id, event_type, COUNT(*) AS a FROM events GROUP BY 1, 2) x GROUP BY user_id""",
)
def agg_diversity(t):
    return agg.agg_diversity(t.events, ["user_id"], "event_type", F.count("*"))


@query(
    "period:i o:i logsum:f6",
    """
SELECT period, o, GREATEST(0, LN(SUM(size * EXP(-0.13 * imp)))) AS logsum FROM v_skim JOIN (SELECT c_nationkey AS d, COUNT(*) AS size FROM customer GROUP BY 1) s ON s.d = v_skim.d
GROUP BY period, o""",
)
def agg_accessibility_logsum(t):
    size = t.customer.groupBy(F.col("c_nationkey").alias("d")).agg(F.count("*").alias("size"))
    return agg.agg_accessibility_logsum(t.v_skim, size, -0.13, keys=["period"])


@query(
    "hhno:i inc_low:i inc_high:i veh_none:i pers:i kids:i has_worker:i",
    """
SELECT h.hhno, CASE WHEN hhincome < 15000 THEN 1 ELSE 0 END AS inc_low, CASE WHEN hhincome >= 50000 THEN 1 ELSE 0 END AS inc_high, CASE WHEN hhvehs >= 0 AND hhvehs < 1 THEN 1 ELSE 0 END AS veh_none,
  COALESCE(p.pers, 0) AS pers, COALESCE(p.kids, 0) AS kids, COALESCE(LEAST(p.w, 1), 0) AS has_worker FROM v_household h LEFT JOIN
 (SELECT hhno, COUNT(*) AS pers, SUM(CASE WHEN pagey < 18 THEN 1 ELSE 0 END) AS kids, SUM(CASE WHEN pwtyp >= 1 THEN 1 ELSE 0 END) AS w FROM v_person GROUP BY hhno) p ON p.hhno = h.hhno""",
)
def agg_control_incidence(t):
    c = agg.Constraint
    rows = [
        c("inc_low", "household", "hhincome", None, 15000),
        c("inc_high", "household", "hhincome", 50000, None),
        c("veh_none", "household", "hhvehs", 0, 1),
        c("pers", "person", "pno", None, None, True),
        c("kids", "person", "pagey", None, 18, True),
        c("has_worker", "person", "pwtyp", 1, None),
    ]
    return agg.agg_control_incidence(t.v_household, t.v_person, "hhno", rows)


@query(
    "l_partkey:i puma:i share:f6",
    """
SELECT l_partkey, puma, CAST(w AS DOUBLE) / total AS share FROM (SELECT l_partkey, puma, w, SUM(w) OVER (PARTITION BY l_partkey) AS total, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY w DESC, puma) AS r
 FROM (SELECT l_partkey, l_suppkey % 3 AS puma, SUM(l_quantity) AS w FROM lineitem GROUP BY 1, 2) x) y WHERE r = 1 AND CAST(w AS DOUBLE) / total >= 0.5""",
)
def agg_majority_assign(t):
    return agg.agg_majority_assign(t.lineitem.withColumn("puma", F.col("l_suppkey") % 3), "l_partkey", "puma", "l_quantity")
