"""Road network operators on link frames with from_id and to_id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ..functions.recode import first_match
from ..functions.scalar import fn_pct_change_safe, turn_angle
from ..operators.joins import join_in_out_links
from ..operators.spatial import join_buffer_aggregate

# Priority scores by functional class.
CLASS_SCORES = (((1, 11, 12), 9), ((2, 6, 14), 8), ((7, 16), 6), ((8, 17), 5), ((9, 19), 3))
RAMP_SCORE = OTHER_SCORE = 2
LOCAL_SCORE, LOCAL_FROM = 1, 90
EMPTY_SIDE_CLASS = 11
NO_CONTROL, SIGNAL, TWO_WAY_STOP, ALL_WAY_STOP = 0, 1, 2, 4
FULL_ACCESS_CONTROL = 3


def net_directional(links: DataFrame, attrs: Sequence[str], lanes: str = "lanes") -> DataFrame:
    """One row per link and direction with lanes; ``ab_``/``ba_`` columns lose their prefix.

    The BA row runs from the link's to-node to its from-node. One scan, no union.
    """
    names = [lanes, *[a for a in attrs if a != lanes]]
    ends = {"AB": ("from_id", "to_id"), "BA": ("to_id", "from_id")}
    rows = [
        F.struct(F.lit(d).alias("flow"), F.col(a).alias("from_id"), F.col(b).alias("to_id"), *[F.col(f"{d.lower()}_{n}").alias(n) for n in names])
        for d, (a, b) in ends.items()
    ]
    drop = {"from_id", "to_id", *[f"{p}_{n}" for p in ("ab", "ba") for n in names]}
    rest = [c for c in links.columns if c not in drop]
    return links.select(*rest, F.explode(F.array(*rows)).alias("r")).select(*rest, "r.*").filter(F.col(lanes) > 0)


def net_attribute_change(edges: DataFrame, attrs: Sequence[str], thresholds: dict[str, float] | None = None, keep: dict[str, str] | None = None) -> DataFrame:
    """Changes of attributes from in-link to out-link profiles at each node.

    Numeric attributes give a difference, text gives SAME or CHANGES. ``thresholds`` keeps
    differences of at least that size, ``keep`` rows where either side has the value.
    """
    pairs = join_in_out_links(edges, attrs)
    for a in attrs:
        i, o = F.col(f"in_{a}"), F.col(f"out_{a}")
        text = edges.schema[a].dataType.typeName() == "string"
        pairs = pairs.withColumn(f"diff_{a}", F.when(i == o, "SAME").otherwise("CHANGES") if text else o - i)
    for a, least in (thresholds or {}).items():
        pairs = pairs.filter(F.abs(F.col(f"diff_{a}")) >= least)
    for a, value in (keep or {}).items():
        pairs = pairs.filter((F.col(f"in_{a}") == value) | (F.col(f"out_{a}") == value))
    return pairs


def net_link_pairs(
    edges: DataFrame,
    link_id: str,
    attrs: Sequence[str],
    turn: float,
    thresholds: dict[str, float] | None = None,
    keep: dict[str, str] | None = None,
    start: str = "start_heading",
    end: str = "end_heading",
) -> DataFrame:
    """Pairs of in-link and out-link that turn by at most ``turn`` degrees, with both ids and headings.

    The filters of :func:`net_attribute_change` go by attributes. They are decided on profiles: attributes and
    a sector of the compass no narrower than ``turn``, so only profiles in the same or a neighbouring sector
    meet. Links are joined to the profile pairs that passed, and the angle is tested on them: a hub
    costs the square of its profiles and the pairs it returns or turns down at a sector's edge. No U-turns; a null heading never pairs.

    Both sides of each join grow with the links, so they are merged: going by the size of a packed file,
    Spark would hand all links to every task.
    """
    n = max(1, int(360.0 // (turn + 1e-6)))

    def side(node: str, far: str, heading: str, name: str) -> DataFrame:
        sector = F.least(F.floor(F.col(heading) * n / 360.0), F.lit(n - 1)).cast("int")
        profile = F.struct(F.col(node).alias("node"), sector.alias("sector"), *attrs)
        rows = edges.filter(F.col(heading).isNotNull() & F.col(node).isNotNull())
        return rows.select(profile.alias(f"{name}_p"), F.col(far).alias(f"{name}_far"), F.col(link_id).alias(f"{name}_{link_id}"), F.col(heading).alias(f"{name}_heading"))

    ins, outs = side("to_id", "from_id", end, "in"), side("from_id", "to_id", start, "out")
    a, b = F.col("in_p.sector"), F.col("out_p.sector")
    near = [F.array_distinct(F.array(*[F.pmod(a + d, F.lit(n)) for d in (-1, 0, 1)]))]
    met = ins.select("in_p").distinct().withColumn("sector", F.explode(*near)).withColumn("node", F.col("in_p.node"))
    met = met.join(outs.select("out_p").distinct().withColumns({"node": F.col("out_p.node"), "sector": b}).hint("merge"), ["node", "sector"])
    for name in attrs:
        i, o = F.col(f"in_p.{name}"), F.col(f"out_p.{name}")
        if name in (thresholds or {}):
            met = met.filter(F.abs(o - i) >= thresholds[name])
        if name in (keep or {}):
            met = met.filter((i == keep[name]) | (o == keep[name]))
    pairs = met.select("in_p", "out_p").join(ins.hint("merge"), "in_p").join(outs.hint("merge"), "out_p")
    pairs = pairs.withColumn("turn", turn_angle("in_heading", "out_heading")).filter((F.abs("turn") <= turn) & ~F.col("in_far").eqNullSafe(F.col("out_far")))
    sides = [c for name in attrs for c in (F.col(f"in_p.{name}").alias(f"in_{name}"), F.col(f"out_p.{name}").alias(f"out_{name}"))]
    return pairs.select(F.col("in_p.node").alias("node"), f"in_{link_id}", f"out_{link_id}", *sides, "in_heading", "out_heading", "turn")


def net_linkage_summary(
    edges: DataFrame, attr: str, values: Sequence, filter_in: Sequence | None = None, filter_out: Sequence | None = None, include_same: bool = False
) -> DataFrame:
    """Link pairs by in-class (rows) and out-class (columns ``out_<value>``)."""
    pairs = join_in_out_links(edges, [attr])
    i, o = F.col(f"in_{attr}"), F.col(f"out_{attr}")
    if not include_same:
        pairs = pairs.filter(i != o)
    if filter_in is not None:
        pairs = pairs.filter(i.isin(*filter_in))
    if filter_out is not None:
        pairs = pairs.filter(o.isin(*filter_out))
    cells = [F.sum(F.when(o == F.lit(v), F.col("n_pairs"))).alias(f"out_{v}") for v in values]
    return pairs.groupBy(f"in_{attr}").agg(*cells)


def net_node_balance(edges: DataFrame, flow: str) -> DataFrame:
    """Flow into and out of each node and the change in per cent."""
    side = F.explode(
        F.array(
            F.struct(F.col("to_id").alias("node"), F.col(flow).alias("inflow"), F.lit(0).cast(edges.schema[flow].dataType).alias("outflow")),
            F.struct(F.col("from_id").alias("node"), F.lit(0).cast(edges.schema[flow].dataType).alias("inflow"), F.col(flow).alias("outflow")),
        )
    )
    sums = edges.select(side.alias("s")).groupBy("s.node").agg(F.coalesce(F.sum("s.inflow"), F.lit(0)).alias("inflow"), F.coalesce(F.sum("s.outflow"), F.lit(0)).alias("outflow"))
    return sums.withColumn("change", fn_pct_change_safe("outflow", "inflow"))


def net_coding_audit(links: DataFrame, code: str, name: str, codes: DataFrame, code_key: str) -> DataFrame:
    """How often each code goes with each name, beside the code table; null shows as EMPTY."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("EMPTY")).alias(c) for c in (code, name)]
    counts = links.groupBy(*text).agg(F.count("*").alias("n"))
    table = codes.withColumn(code_key, F.col(code_key).cast("string")).withColumnRenamed(code_key, code)
    return counts.join(table, code, "left")


def net_length_check(links: DataFrame, length: str, geometry_length: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distribution of the relative difference between coded and drawn length, by ``keys``."""
    rel = F.try_divide(F.col(geometry_length) - F.col(length), F.col(length))
    return links.groupBy(*keys).agg(F.count(rel).alias("n"), F.avg(rel).alias("mean"), F.stddev_samp(rel).alias("sd"), F.min(rel).alias("lowest"), F.max(rel).alias("highest"))


def net_node_controls(links: DataFrame, signals: DataFrame, coordinated: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Node legs and imputed control, and link priority and signal progression at both ends.

    ``signals`` is (node, control); a node without control gets none if fully access
    controlled or with fewer than three legs, all-way stop if all legs rank alike, else
    two-way stop.
    """
    fc = F.col("fc")
    score = first_match(
        [(F.col("ramp") == 1, RAMP_SCORE), *[(fc.isin(*codes), s) for codes, s in CLASS_SCORES], (fc > LOCAL_FROM, LOCAL_SCORE)], OTHER_SCORE
    )
    lanes = F.when(F.col("dir") == 1, F.col("ab_lanes")).when(F.col("dir") == -1, F.col("ba_lanes")).when(F.col("dir") == 0, (F.col("ab_lanes") + F.col("ba_lanes")) / 2)
    ranked = links.withColumn("pclass", (10 * (lanes + score)).cast("int"))
    ends = F.explode(F.array(F.struct(F.col("from_id").alias("node"), F.lit("A").alias("side")), F.struct(F.col("to_id").alias("node"), F.lit("B").alias("side"))))
    at_node = ranked.select(ends.alias("e"), "access", "pclass").select("e.node", "e.side", "access", "pclass")

    def lowest(side: str) -> Column:
        least = F.coalesce(F.min(F.when(F.col("side") == side, F.col("pclass"))), F.lit(0))
        return F.when(least == 0, EMPTY_SIDE_CLASS).otherwise(least)

    nodes = at_node.groupBy("node").agg(
        F.count("*").alias("legs"), F.max("access").alias("access"), F.max("pclass").alias("max_pclass"), F.least(lowest("A"), lowest("B")).alias("min_pclass")
    ).join(signals, "node", "left")
    open_node = (F.col("access") == FULL_ACCESS_CONTROL) | (F.col("legs") < 3)
    imputed = F.when(open_node, NO_CONTROL).when(F.col("max_pclass") == F.col("min_pclass"), ALL_WAY_STOP).otherwise(TWO_WAY_STOP)
    nodes = nodes.withColumn("control", F.coalesce("control", imputed))
    out = ranked
    for side, key in (("a", "from_id"), ("b", "to_id")):
        here = nodes.select(
            F.col("node").alias(key), F.col("control").alias(f"{side}_control"), F.col("max_pclass").alias(f"{side}_max"), F.col("min_pclass").alias(f"{side}_min")
        )
        rank = (
            F.when(F.col(f"{side}_control") == NO_CONTROL, 0)
            .when(F.col(f"{side}_max") == F.col(f"{side}_min"), 2)
            .when(F.col(f"{side}_max") == F.col("pclass"), 1)
            .otherwise(3)
        )
        out = out.join(here, key, "left").withColumn(f"{side}_priority", rank).drop(f"{side}_max", f"{side}_min")
    first = (F.col("a_priority") == 1) & (F.col("b_priority") == 1)
    a, b = F.col("a_control"), F.col("b_control")
    sync = (a == SIGNAL) & (b == SIGNAL) & first
    if coordinated is not None:
        sync = sync | F.coalesce(F.col(coordinated) == 1, F.lit(False))
    out = out.withColumns(
        {
            "a_sync": (((a == SIGNAL) & (b == TWO_WAY_STOP) & first) | sync).cast("int"),
            "b_sync": (((a == TWO_WAY_STOP) & (b == SIGNAL) & first) | sync).cast("int"),
        }
    )
    return nodes, out


def net_node_legs(links: DataFrame) -> DataFrame:
    """Number of link ends at each node."""
    return links.select(F.explode(F.array("from_id", "to_id")).alias("node")).groupBy("node").agg(F.count("*").alias("legs"))


def net_intersection_density(links: DataFrame, nodes: DataFrame, zones: DataFrame, radius: float) -> DataFrame:
    """Legs of true intersections (more than two legs) near each zone per zone area.

    ``nodes`` is (node, x, y), ``zones`` (taz, x, y, area).
    """
    legs = net_node_legs(links).filter("legs > 2").join(nodes, "node")
    near = join_buffer_aggregate(zones, legs, "taz", radius, {"legs": F.col("legs")})
    return zones.select("taz", "area").join(near, "taz").withColumn("density", F.try_divide(F.col("legs").cast("double"), F.col("area")))


def _replayed(table: DataFrame, edits: DataFrame, base: Column, key: str) -> tuple[DataFrame, DataFrame]:
    """``table`` after the edits of its keys in the order of ``seq``, and the edits that cannot be made.

    The log of a key is replayed as it stands: Add puts the row in, Remove or Delete takes it out until a
    later Add, and a Modify counts whether the row is in or out. So the last Add or Remove decides
    on the row (``base`` where there is none), and the last readable Modify on each field: one aggregate, whatever
    the length of a log.
    """
    fields = [f for f in table.schema if f.name != key]
    action, seq = F.col("action"), F.col("seq")

    def unreadable(field: StructField) -> Column:
        return F.col("field_value").isNotNull() & F.col("field_value").try_cast(field.dataType).isNull()

    def last(field: StructField) -> Column:
        # A struct, so that a value set to null is told from no edit.
        mine = (action == "Modify") & (F.col("field_name") == field.name) & ~unreadable(field)
        return F.max_by(F.when(mine, F.struct("field_value")), F.when(mine, seq)).alias(f"__{field.name}")

    stands = action.isin("Add", "Remove", "Delete")
    per_key = edits.groupBy(key).agg(F.max_by(F.when(stands, action == "Add"), F.when(stands, seq)).alias("__in"), *[last(f) for f in fields])
    joined = table.join(per_key, key, "left").filter(F.coalesce("__in", base))
    made = [
        F.when(F.col(f"__{f.name}").isNotNull(), F.col(f"__{f.name}.field_value").try_cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) for f in fields
    ]
    names = F.lit([f.name for f in fields]) if fields else F.array()
    modify = action == "Modify"
    bad = first_match([(F.col("field_name") == f.name, unreadable(f)) for f in fields], F.lit(False))
    known = table.select(key).distinct().withColumn("__known", F.lit(True))
    told = edits.join(known, key, "left").withColumn(
        "error",
        F.when(F.col("__known").isNull(), "does not exist")
        .when(modify & ~F.coalesce(F.array_contains(names, F.col("field_name")), F.lit(False)), "field does not exist")
        .when(modify & bad, "value cannot be read")
        .when(~F.coalesce(modify | stands, F.lit(False)), "unknown action"),
    )
    return joined.select(key, *made), told.drop("__known").filter("error IS NOT NULL")


def net_apply_projects(
    links: DataFrame, edits: DataFrame, base: Column, key: str = "id", nodes: DataFrame | None = None, node_base: Column | None = None, node_key: str = "node"
) -> tuple[DataFrame, ...]:
    """A scenario network from the master links and an ordered edit list, and the edits that fail.

    ``edits`` is (seq, id, action, field_name, field_value): Add, Remove (or Delete) and Modify, replayed in
    the order of ``seq``, so that an Add after a Remove brings the link back. Links are in the scenario if
    ``base`` holds and no edit says otherwise. An edit whose value does not fit the field's type, of an unknown
    field, action or id, is returned with its error; the rest of a log counts.

    With ``nodes`` the list has a column ``layer`` (``Link``, or null, and ``Node``), Node edits are replayed on
    the nodes in the same way (``node_base``: all nodes by default), and the result is (links, nodes, errors): links carry
    the fields of their end nodes as ``from_<field>`` and ``to_<field>``, and a link goes where an end is gone.
    """
    if nodes is None:
        return _replayed(links, edits, base, key)
    layer = F.coalesce(F.col("layer"), F.lit("Link"))
    kept_links, link_errors = _replayed(links, edits.filter(layer == "Link"), base, key)
    of_nodes = edits.filter(layer == "Node").withColumnRenamed(key, node_key)
    kept_nodes, node_errors = _replayed(nodes, of_nodes, F.lit(True) if node_base is None else node_base, node_key)
    other = edits.filter(~layer.isin("Link", "Node")).withColumn("error", F.lit("unknown layer"))
    fields = [c for c in nodes.columns if c != node_key]
    placed = kept_links
    for end in ("from", "to"):
        at = kept_nodes.select(F.col(node_key).alias(f"{end}_id"), *[F.col(c).alias(f"{end}_{c}") for c in fields])
        placed = placed.join(at, f"{end}_id")
    errors = link_errors.unionByName(node_errors.withColumnRenamed(node_key, key)).unionByName(other)
    return placed.select(*kept_links.columns, *[f"{end}_{c}" for end in ("from", "to") for c in fields]), kept_nodes, errors
