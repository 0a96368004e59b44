"""Driver forms: ordered operators, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets, windows
from .registry import query


@query("c_custkey:i id:i", "SELECT c_custkey, 99 + ROW_NUMBER() OVER (ORDER BY c_custkey) AS id FROM customer")
def win_surrogate_id(t):
    return windows.win_surrogate_id(t.customer.select("c_custkey"), ["c_custkey"], "id", 100)


@query(
    "o_orderkey:i o_custkey:i pno:i",
    "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pno FROM orders",
)
def win_group_seq(t):
    return windows.win_group_seq(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "pno")


@query(
    "l_orderkey:i l_linenumber:i last_seq:i not_last:i not_first:i",
    """
SELECT l_orderkey, l_linenumber, m AS last_seq, CASE WHEN l_linenumber < m THEN 1 ELSE 0 END AS not_last, CASE WHEN l_linenumber > f THEN 1 ELSE 0 END AS not_first
FROM (SELECT l_orderkey, l_linenumber, MAX(l_linenumber) OVER (PARTITION BY l_orderkey) AS m, MIN(l_linenumber) OVER (PARTITION BY l_orderkey) AS f FROM lineitem) x""",
)
def win_group_max_flag(t):
    return windows.win_group_max_flag(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey"], "l_linenumber")


@query(
    "user_id:i event_id:i event_type:s",
    """
SELECT user_id, event_id, event_type FROM (SELECT user_id, event_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) x WHERE r = 1""",
)
def win_argmin_row(t):
    return windows.win_argmin_row(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"])


@query(
    "route:i respondent:i confidence:i",
    """
SELECT route, respondent, confidence FROM (SELECT route, respondent, confidence, ROW_NUMBER() OVER (PARTITION BY route ORDER BY confidence DESC NULLS LAST, respondent) AS r FROM v_survey) x WHERE r = 1""",
)
def win_argmax_dedup(t):
    return windows.win_argmax_dedup(t.v_survey.select("route", "respondent", "confidence"), ["route"], "confidence", "respondent")


@query(
    "o:i d:i period:i share:f8",
    "SELECT o, d, period, CAST(imp AS DOUBLE) / SUM(imp) OVER (PARTITION BY o, period) AS share FROM v_skim",
)
def win_share_in_group(t):
    return windows.win_share_in_group(t.v_skim, ["o", "period"], "imp")


@query(
    "route:i milepost:i load:i",
    "SELECT route, milepost, SUM(passengers_on - passengers_off) OVER (PARTITION BY route ORDER BY milepost ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS load FROM v_apc",
)
def win_running_load(t):
    return windows.win_running_load(t.v_apc, ["route"], ["milepost"], "passengers_on", "passengers_off")


@query(
    "l_orderkey:i l_linenumber:i rounded:i",
    """
SELECT l_orderkey, l_linenumber, CAST(FLOOR(q) AS BIGINT) + CASE WHEN ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY q - FLOOR(q) DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) <= ROUND(s) THEN 1 ELSE 0 END AS rounded
FROM (SELECT *, SUM(q) OVER (PARTITION BY l_orderkey) - SUM(FLOOR(q)) OVER (PARTITION BY l_orderkey) AS s
 FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity / 8 AS q FROM lineitem) y) x""",
)
def win_largest_remainder(t):
    shares = t.lineitem.withColumn("q", F.col("l_quantity") / 8)
    return windows.win_largest_remainder(shares, ["l_orderkey"], "q", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@query(
    "id:i am:f6 pm:f6",
    """
SELECT id, am * f AS am, pm * f AS pm FROM (SELECT id, CAST(ab_am_auto AS DOUBLE) AS am, CAST(ab_pm_auto AS DOUBLE) AS pm,
  CASE WHEN ab_am_auto + ab_pm_auto > aadt THEN CAST(aadt AS DOUBLE) / (ab_am_auto + ab_pm_auto) ELSE 1.0 END AS f FROM v_link) x""",
)
def win_harmonise_parts(t):
    parts = t.v_link.select("id", F.col("ab_am_auto").alias("am"), F.col("ab_pm_auto").alias("pm"), "aadt")
    return windows.win_harmonise_parts(parts, ["am", "pm"], "aadt")


@query(
    "hour:i cls:s hour_share:f8",
    """
SELECT hour, cls, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY cls, CASE WHEN hour BETWEEN 7 AND 9 THEN 'AM' WHEN hour BETWEEN 16 AND 18 THEN 'PM' ELSE 'OP' END) AS hour_share FROM v_hour_profile""",
)
def win_hourly_normalise(t):
    period = F.when(F.col("hour").between(7, 9), "AM").when(F.col("hour").between(16, 18), "PM").otherwise("OP")
    return windows.win_hourly_normalise(t.v_hour_profile.withColumn("period", period), "n", ["cls", "period"])


@query("c_name:s num:i", "SELECT c_name, CAST(SPLIT_PART(c_name, '#', 2) AS BIGINT) AS num FROM customer ORDER BY num")
def sort_numeric_text(t):
    keyed = t.customer.select("c_name", F.split("c_name", "#").getItem(1).alias("num"))
    return sets.sort_numeric_text(keyed, "num")


@query("o_custkey:i o_orderkey:i", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey")
def sort_export(t):
    return sets.sort_export(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])


@query("stop_id:i ons:i", "SELECT stop_id, SUM(passengers_on) AS ons FROM v_apc GROUP BY stop_id ORDER BY ons DESC, stop_id LIMIT 20")
def topk_by_measure(t):
    return sets.topk_by_measure(t.v_apc, ["stop_id"], F.sum("passengers_on"), 20, "ons")


@query(
    "route:i respondent:i confidence:i rank:i",
    """
SELECT * FROM (SELECT route, respondent, confidence, ROW_NUMBER() OVER (PARTITION BY route ORDER BY confidence DESC NULLS LAST, respondent) AS rank FROM v_survey) x WHERE rank <= 3""",
)
def topk_per_group(t):
    return sets.topk_per_group(t.v_survey, ["route"], [F.desc_nulls_last("confidence"), F.asc("respondent")], 3)


@query("id:i length:f2", "SELECT id, length FROM v_link ORDER BY id LIMIT 10")
def limit_sample_rows(t):
    return sets.limit_sample_rows(t.v_link, ["id"], 10)


@query(
    "id:i lanes:i toll:i source:s",
    "SELECT id, ab_lanes AS lanes, CAST(NULL AS INT) AS toll, 'AB' AS source FROM v_link UNION ALL SELECT id, ba_lanes, 0, 'BA' FROM v_link",
)
def set_union_all(t):
    ab = t.v_link.select("id", F.col("ab_lanes").alias("lanes"))
    ba = t.v_link.select("id", F.col("ba_lanes").alias("lanes"), F.lit(0).alias("toll"))
    return sets.set_union_all(("AB", ab), ("BA", ba))


@query("hhtaz:i hhseg:s", "SELECT DISTINCT hhtaz, hhseg FROM v_household")
def set_distinct(t):
    return sets.set_distinct(t.v_household, ["hhtaz", "hhseg"])


@query("key:i", "SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_except(t):
    return sets.set_except(t.customer.select(F.col("c_custkey").alias("key")), t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key")))


@query("key:i", "SELECT c_custkey AS key FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_intersect(t):
    return sets.set_intersect(t.customer.select(F.col("c_custkey").alias("key")), t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key")))


@query(
    "x:i y:i n:i",
    """
SELECT g.x, h.y, COALESCE(n, 0) AS n FROM (SELECT UNNEST(RANGE(1, 61)) AS x) g CROSS JOIN (SELECT UNNEST(RANGE(1, 8)) AS y) h
LEFT JOIN (SELECT CAST(l_quantity AS INT) AS x, l_linenumber AS y, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) a ON a.x = g.x AND a.y = h.y""",
)
def set_complete_grid(t):
    cells = t.lineitem.groupBy(F.col("l_quantity").cast("int").alias("x"), F.col("l_linenumber").alias("y")).agg(F.count("*").alias("n"))
    return sets.set_complete_grid(t.spark, ("x", 1, 60), ("y", 1, 7)).join(cells, ["x", "y"], "left").na.fill(0, ["n"])
