"""Driver forms: sources, sinks, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import recode
from ..session import scratch_path
from ..sources import scan, sink
from .registry import query

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def _text(t, df, name, sep=",", header=True):
    path = scratch_path(t.spark, name)
    sink.sink_delimited(df, path, sep=sep, header=header)
    return path


@query(
    "c_custkey:i c_name:s c_nationkey:i c_acctbal:f2 c_mktsegment:s",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_delimited(t):
    return scan.scan_delimited(t.spark, _text(t, t.customer, "scan-delimited"), CUSTOMER)


@query(
    "c_custkey:i c_name:s c_nationkey:i c_acctbal:f2 c_mktsegment:s",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_multi_append(t):
    even = F.col("c_custkey") % 2 == 0
    paths = [_text(t, t.customer.filter(even), "state-a"), _text(t, t.customer.filter(~even), "state-b")]
    return scan.scan_multi_append(t.spark, paths, CUSTOMER)


@query(
    "o_orderkey:i o_custkey:i o_totalprice:f2 o_orderpriority:s",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def scan_delim_variants(t):
    path = _text(t, t.orders, "orders-tsv", sep="\t")
    registry = {"orders": {"path": path, "schema": ORDERS, "delimiter": 9}}
    return scan.scan_delim_variants(t.spark, registry, "orders")


@query(
    "l_orderkey:i l_linenumber:i part_id:s supp_id:s",
    """
SELECT l_orderkey, l_linenumber, CONCAT(CAST(l_partkey AS VARCHAR), '-000') AS part_id, CONCAT(CAST(l_suppkey AS VARCHAR), '-000') AS supp_id
FROM lineitem
WHERE l_partkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def scan_prefix_filtered(t):
    flows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.col("l_partkey").cast("string"), F.lit("-000")).alias("part_id"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("-000")).alias("supp_id"),
    )
    path = scratch_path(t.spark, "flows-gz")
    flows.write.csv(path, header=True, compression="gzip")
    keys = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("zone"))
    schema = "l_orderkey bigint, l_linenumber int, part_id string, supp_id string"
    return scan.scan_prefix_filtered(t.spark, path, schema, ["part_id", "supp_id"], 4, keys)


@query(
    "event_id:i user_id:i value:f2",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value IS NOT NULL AND event_id IS NOT NULL AND user_id IS NOT NULL",
)
def scan_skip_junk(t):
    body = t.events.select(F.concat_ws(",", "event_id", "user_id", "event_type", "value", F.lit("x")).alias("value"))
    junk = t.spark.createDataFrame([("Report of events",), ("id,user,type,value,note",)], "value string")
    path = scratch_path(t.spark, "with-preamble")
    junk.unionByName(body).write.text(path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double, note string")
    return scan.scan_skip_junk(t.spark, path, schema, "event_id", lambda df: df["event_type"] == "purchase", drop=["event_type", "note"])


@query("custkey:i balance:f2 segment:s", "SELECT c_custkey AS custkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def scan_positional_types(t):
    path = _text(t, t.customer, "headerless", header=False)
    return scan.scan_positional_types(t.spark, path, {0: ("custkey", "bigint"), 3: ("balance", "double"), 4: ("segment", "string")}, 5)


@query("id:i name:s nation:i", "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier")
def scan_fixed_width(t):
    line = F.concat(F.rpad(F.col("s_suppkey").cast("string"), 12, " "), F.rpad("s_name", 30, " "), F.lpad(F.col("s_nationkey").cast("string"), 4, " "))
    path = scratch_path(t.spark, "report-lines")
    t.supplier.select(line.alias("value")).write.text(path)
    return scan.scan_fixed_width(t.spark, path, [("id", 1, 12, "bigint"), ("name", 13, 30, "string"), ("nation", 43, 4, "int")])


@query("l_returnflag:s n:i", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def scan_parquet(t):
    path = scratch_path(t.spark, "merged-trips")
    t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").write.parquet(path)
    return scan.scan_parquet(t.spark, path).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query(
    "o_orderkey:i priced:f2",
    """
SELECT o_orderkey, o_totalprice * (SELECT CAST(MAX(p.value) AS DOUBLE) FROM (SELECT r_name AS name, CAST(r_regionkey + 1 AS VARCHAR) AS value FROM region) p WHERE p.name = 'AMERICA') AS priced
FROM orders""",
)
def scan_params(t):
    table = t.region.select(F.col("r_name").alias("name"), (F.col("r_regionkey") + 1).cast("string").alias("value"))
    params = scan.scan_params(table, "name", "value")
    return t.orders.select("o_orderkey", (F.col("o_totalprice") * params["AMERICA"]).alias("priced"))


@query(
    "s_name:s s_suppkey:i s_acctbal:f2 c_name:s",
    "SELECT s_name, s_suppkey, s_acctbal, CAST(NULL AS VARCHAR) AS c_name FROM supplier",
)
def sink_delimited(t):
    path = scratch_path(t.spark, "sink-delimited")
    sink.sink_delimited(t.supplier.withColumn("c_name", F.lit(None).cast("string")), path, ["s_name", "s_suppkey", "s_acctbal", "c_name"], sep="\t")
    return scan.scan_delimited(t.spark, path, "s_name string, s_suppkey bigint, s_acctbal double, c_name string", sep="\t")


@query(
    "c_custkey:i o_orderkey:i o_orderpriority:s",
    """
SELECT c_custkey, COALESCE(o_orderkey, -9) AS o_orderkey,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '-8' WHEN o_orderpriority IS NULL THEN '-9' ELSE o_orderpriority END AS o_orderpriority
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def sink_sentinel_nulls(t):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_orderpriority")
    path = scratch_path(t.spark, "sentinels")
    sink.sink_sentinel_nulls(joined, path, ["c_custkey", "o_orderkey"], -9, {"4-NOT SPECIFIED": -8})
    return scan.scan_delimited(t.spark, path, "c_custkey bigint, o_orderkey bigint, o_orderpriority string")


@query(
    "scenario:s l_returnflag:s qty:f2",
    """
SELECT 'base' AS scenario, l_returnflag, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'build', l_returnflag, SUM(l_quantity * 2) FROM lineitem GROUP BY l_returnflag""",
)
def sink_scenario_snapshot(t):
    path = scratch_path(t.spark, "scenarios")
    flags = t.lineitem.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("qty"))
    double = t.lineitem.groupBy("l_returnflag").agg(F.sum(F.col("l_quantity") * 2).alias("qty"))
    for name, df in (("base", double), ("build", double), ("base", flags)):
        sink.sink_scenario_snapshot(df, path, name)
    return scan.scan_parquet(t.spark, path)


@query(
    "taz:i n:i qty:f2",
    """
SELECT z.n_nationkey AS taz, COALESCE(a.n, 0) AS n, COALESCE(a.qty, 0) AS qty FROM nation z LEFT JOIN
 (SELECT l_suppkey % 50 AS taz, COUNT(*) AS n, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1) a ON z.n_nationkey = a.taz""",
)
def sink_empty_grid(t):
    got = t.lineitem.groupBy((F.col("l_suppkey") % 50).cast("int").alias("taz")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    return sink.sink_empty_grid(t.nation.select(F.col("n_nationkey").alias("taz")), got, ["taz"])


@query(
    "sign:s n:i",
    """
SELECT sign, SUM(hit) AS n FROM (
 SELECT '==' AS sign, CASE WHEN l_quantity = 25 THEN 1 ELSE 0 END AS hit FROM lineitem UNION ALL SELECT '!=', CASE WHEN l_quantity <> 25 THEN 1 ELSE 0 END FROM lineitem
 UNION ALL SELECT '>', CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END FROM lineitem UNION ALL SELECT '<', CASE WHEN l_quantity < 25 THEN 1 ELSE 0 END FROM lineitem
 UNION ALL SELECT '>=', CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END FROM lineitem UNION ALL SELECT '<=', CASE WHEN l_quantity <= 25 THEN 1 ELSE 0 END FROM lineitem) x GROUP BY sign""",
)
def filter_dynamic(t):
    # One pass: a row is tagged with the signs it meets and kept for each by the operator itself.
    signs = F.explode(F.array(*[F.lit(s) for s in recode.SIGNS])).alias("sign")
    tagged = t.lineitem.groupBy("l_quantity").agg(F.count("*").alias("k")).select("l_quantity", "k", signs)
    kept = [recode.SIGNS[s](F.col("l_quantity"), F.lit(25)) & (F.col("sign") == s) for s in recode.SIGNS]
    hit = kept[0]
    for k in kept[1:]:
        hit = hit | k
    return tagged.groupBy("sign").agg(F.sum(F.when(hit, F.col("k")).otherwise(0)).alias("n"))


_PREDS = [
    ("Flag", "A", "l_returnflag = 'A'"),
    ("Flag", "N", "l_returnflag = 'N'"),
    ("Flag", "R", "l_returnflag = 'R'"),
    ("Status", "open", "l_linestatus = 'O'"),
    ("Qty", "small", "l_quantity < 10"),
    ("Qty", "large", "l_quantity >= 40"),
    ("Price", "over 50k", "l_extendedprice > 50000"),
    ("None", "never", "l_quantity < 0"),
]


@query(
    "kind:s item:s n:i qty:f2",
    "\nUNION ALL ".join(f"SELECT '{k}' AS kind, '{i}' AS item, COUNT(*) AS n, COALESCE(SUM(l_quantity), 0) AS qty FROM lineitem WHERE {p}" for k, i, p in _PREDS),
)
def filter_query_list(t):
    preds = [(k, i, F.expr(p)) for k, i, p in _PREDS]
    return recode.filter_query_list(t.lineitem, preds, {"n": F.count("*"), "qty": F.sum("l_quantity")}).na.fill(0)


@query(
    "mz_id:i tract:i puma:i pop:f2",
    "SELECT mz_id, tract, puma, pop FROM v_cwalk WHERE NOT (pop < 100) AND tract IN (SELECT CAST(p_size AS INT) FROM part)",
)
def filter_rows_delete(t):
    keys = t.part.select(F.col("p_size").alias("tract"))
    return recode.filter_rows_delete(t.v_cwalk, F.col("pop") < 100, keys, ["tract"])


@query("tour_key:i pdpurp:i", "SELECT tour_key, pdpurp FROM v_tour WHERE pdpurp IN (1, 2, 4, 5)")
def filter_isin_const(t):
    return recode.filter_isin_const(t.v_tour, "pdpurp", [1, 2, 4, 5])


@query("event_id:i day:t", "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE MONTH(ts) = 1 AND DAYOFWEEK(ts) BETWEEN 2 AND 4")
def filter_weekday_month(t):
    return recode.filter_weekday_month(t.events, "ts", 1).select("event_id", F.col("ts").cast("date").alias("day"))


@query(
    "p_partkey:i code:i size_class:s",
    """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'PROMO' THEN 3 ELSE 9 END AS code,
       CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'more' END AS size_class FROM part""",
)
def project_case_map(t):
    return t.part.select(
        "p_partkey",
        recode.project_case_map("p_type", {"ECONOMY": 1, "STANDARD": 2, "PROMO": 3}, 9).alias("code"),
        recode.project_case_map("p_size", {1: "one", 2: "two"}, "more").alias("size_class"),
    )


@query(
    "o_orderkey:i ptype:i",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 300000 THEN 1 WHEN o_orderpriority = '1-URGENT' THEN 2
  WHEN o_totalprice > 300000 THEN 3 WHEN o_orderpriority = '5-LOW' THEN 4 WHEN o_totalprice > 100000 THEN 5 ELSE 8 END AS ptype FROM orders""",
)
def project_ordered_ladder(t):
    urgent, rich = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 300000
    rules = [(urgent & rich, 1), (urgent, 2), (rich, 3), (F.col("o_orderpriority") == "5-LOW", 4), (F.col("o_totalprice") > 100000, 5)]
    return t.orders.select("o_orderkey", recode.project_ordered_ladder(rules, 8).alias("ptype"))


@query(
    "event_id:i mode:i",
    """
SELECT event_id, CASE WHEN value > 40 THEN 4 WHEN event_type = 'error' THEN 3 WHEN event_type = 'purchase' THEN 2 WHEN value > 10 THEN 1 ELSE 0 END AS mode FROM events""",
)
def project_overwrite_recodes(t):
    rules = [(F.col("value") > 10, 1), (F.col("event_type") == "purchase", 2), (F.col("event_type") == "error", 3), (F.col("value") > 40, 4)]
    return t.events.select("event_id", recode.project_overwrite_recodes(rules, 0).alias("mode"))


@query(
    "tour_key:i purp:i",
    "SELECT tour_key, CASE WHEN parent > 0 THEN 8 WHEN pdpurp = 8 THEN 7 WHEN pdpurp = 9 THEN 4 ELSE pdpurp END AS purp FROM v_tour",
)
def project_purpose_merge(t):
    return t.v_tour.select("tour_key", recode.project_purpose_merge("pdpurp", {8: 7, 9: 4}, "parent").alias("purp"))


@query("hhno:i hhtaz:i hwkrs:i fraction:f2 samptype:i", "SELECT hhno, hhtaz, -1 AS hwkrs, 1.0 AS fraction, 0 AS samptype FROM v_household")
def project_default_columns(t):
    return recode.project_default_columns(t.v_household.select("hhno", "hhtaz"), {"hwkrs": -1, "fraction": 1.0, "samptype": 0})


@query(
    "hhno:i income:f2 vehs:i",
    "SELECT hhno, CASE WHEN hhincome < 0 THEN 0 ELSE hhincome END AS income, LEAST(hhvehs, 4) AS vehs FROM v_household",
)
def project_clamp(t):
    return t.v_household.select("hhno", recode.project_clamp("hhincome", lo=0.0).alias("income"), recode.project_clamp("hhvehs", hi=4).alias("vehs"))


@query(
    "c_mktsegment:s mean_known:f4 n_known:i",
    "SELECT c_mktsegment, AVG(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) AS mean_known, COUNT(CASE WHEN c_acctbal >= 0 THEN 1 END) AS n_known FROM customer GROUP BY 1",
)
def project_missing_sentinel(t):
    known = t.customer.withColumn("bal", recode.project_missing_sentinel("c_acctbal"))
    return known.groupBy("c_mktsegment").agg(F.avg("bal").alias("mean_known"), F.count("bal").alias("n_known"))


@query("cns07:i w_geocode:s cns20:f2 cns05:i", "SELECT cns07, w_geocode, CAST(NULL AS DOUBLE) AS cns20, cns05 FROM v_jobs")
def project_reorder(t):
    return recode.project_reorder(t.v_jobs, ["cns07", "w_geocode", "cns20", "cns05"])


@query("supplier_id:i Nation_Key:i s_name:s", 'SELECT s_suppkey AS supplier_id, s_nationkey AS "Nation_Key", s_name FROM supplier')
def project_header_clean(t):
    messy = t.supplier.select(F.col("s_suppkey").alias(" s_suppkey "), F.col("s_nationkey").alias("Nation  Key"), F.col("s_name").alias("s_name "))
    return recode.project_header_clean(messy, {"s_suppkey": "supplier_id"})


_FLOWS = ["ab_am_auto", "ba_am_auto", "ab_pm_auto", "ba_pm_auto", "ab_am_sut", "ba_am_sut"]


@query(
    "id:i dir:s tod:s veh:s flow:i",
    "\nUNION ALL ".join("SELECT id, '{}' AS dir, '{}' AS tod, '{}' AS veh, {} AS flow FROM v_link".format(*c.split("_"), c) for c in _FLOWS),
)
def project_unpivot(t):
    return recode.project_unpivot(t.v_link.select("id", *_FLOWS), ["id"], _FLOWS, ["dir", "tod", "veh"], "flow")


@query(
    "id:i dir:s tod:s veh:s flow:i lanes:i",
    "\nUNION ALL ".join(
        "SELECT id, '{0}' AS dir, '{1}' AS tod, '{2}' AS veh, {3} AS flow, {0}_lanes AS lanes FROM v_link".format(*c.split("_"), c) for c in _FLOWS
    ),
)
def project_pick_by_tag(t):
    long = recode.project_unpivot(t.v_link, ["id", "ab_lanes", "ba_lanes"], _FLOWS, ["dir", "tod", "veh"], "flow")
    return recode.project_pick_by_tag(long, ["dir"], {("ab",): "ab_lanes", ("ba",): "ba_lanes"}, "lanes")
