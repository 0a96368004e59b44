"""Predictive crash models for road segments and intersections.

Coefficients stand in tables by site type; a site's type picks its line, so each model is
one expression however many types there are. A type without a line gives no crashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import first_match

# Share of fatal crashes, calibration by severity.
FATAL_SHARE = 0.0188
CALIBRATION = {"fatal": 1.20, "injury": 1.79, "pdo": 2.59}

# Freeway models, slope on ln(ADT / 1000) and intercepts by area and lanes per direction.
FREEWAY = {
    "mv_fi": (1.492, {"r2": -5.975, "r3": -6.092, "r4": -6.140, "u2": -5.470, "u3": -5.587, "u4": -5.635, "u5": -5.842}),
    "mv_pdo": (1.936, {"r2": -6.882, "r3": -7.141, "r4": -7.329, "u2": -6.548, "u3": -6.809, "u4": -6.997, "u5": -7.260}),
    "sv_fi": (0.646, {"r2": -2.126, "r3": -2.055, "r4": -1.985, "u2": -2.126, "u3": -2.055, "u4": -1.985, "u5": -1.915}),
    "sv_pdo": (0.876, {"r2": -2.235, "r3": -2.274, "r4": -2.312, "u2": -2.235, "u3": -2.274, "u4": -2.312, "u5": -2.351}),
}
FREEWAY_LANE_SLOPE, FREEWAY_WIDE_LANE = -0.0376, 0.963
FREEWAY_MEDIAN = {"fi": 0.131, "pdo": 0.169}

# Rural multilane models (intercept, slope on ln ADT), divided and undivided.
MULTILANE = {"total": ((-9.025, 1.049), (-9.653, 1.176)), "fi": ((-8.837, 0.958), (-9.410, 1.094))}

# Factors by width (at least), as (ADT < 400, ADT > 2000, slope between).
LANE_FACTORS = {
    "divided": ((12, (1.0, 1.0, 0.0)), (11, (1.01, 1.03, 0.0000125)), (10, (1.01, 1.15, 0.0000875)), (None, (1.03, 1.25, 0.0001380))),
    "undivided": ((12, (1.0, 1.0, 0.0)), (11, (1.01, 1.04, 0.0000188)), (10, (1.02, 1.23, 0.0001310)), (None, (1.04, 1.38, 0.0002130))),
    "two_lane": ((12, (1.0, 1.0, 0.0)), (11, (1.01, 1.05, 0.000025)), (10, (1.02, 1.30, 0.000175)), (None, (1.05, 1.50, 0.000281))),
}
SHOULDER_FACTORS = (
    (8, (0.98, 0.87, -0.00006875)), (6, (1.0, 1.0, 0.0)), (4, (1.02, 1.15, 0.00008125)), (2, (1.07, 1.30, 0.00014300)), (None, (1.10, 1.50, 0.00025)),
)
DIVIDED_SHOULDER = ((8, 1.00), (6, 1.04), (4, 1.09), (2, 1.13), (None, 1.18))
RELATED = {"divided": 0.5, "undivided": 0.27, "two_lane": 0.574}
TWO_LANE = {"base": -0.312, "turn_lane": 0.882, "pdo": 0.679, "fatal": 0.013}

# Urban arterial models by type, (intercept, slope on ln ADT).
ARTERIAL = {
    "mv": {"2U": (-15.22, 1.68), "3T": (-12.40, 1.41), "4U": (-11.63, 1.33), "4D": (-12.34, 1.36), "5T": (-9.70, 1.17)},
    "mv_fi": {"2U": (-16.22, 1.66), "3T": (-16.45, 1.69), "4U": (-12.08, 1.25), "4D": (-12.76, 1.28), "5T": (-10.47, 1.12)},
    "mv_pdo": {"2U": (-15.62, 1.69), "3T": (-11.95, 1.33), "4U": (-12.53, 1.38), "4D": (-12.81, 1.38), "5T": (-9.97, 1.17)},
    "sv": {"2U": (-5.47, 0.56), "3T": (-5.74, 0.54), "4U": (-7.99, 0.81), "4D": (-5.05, 0.47), "5T": (-4.82, 0.54)},
    "sv_fi": {"2U": (-3.96, 0.23), "3T": (-6.37, 0.47), "4U": (-7.37, 0.61), "4D": (-8.71, 0.66), "5T": (-4.43, 0.35)},
    "sv_pdo": {"2U": (-6.51, 0.64), "3T": (-6.29, 0.56), "4U": (-8.50, 0.84), "4D": (-5.04, 0.45), "5T": (-5.83, 0.61)},
}
# Driveway crash rates (six driveway kinds), exponent on ADT / 15000, fatal-injury share.
DRIVEWAY_DENSITY = 0.01
DRIVEWAYS = {
    "2U": ((0.158, 0.050, 0.172, 0.023, 0.083, 0.016), 1.0, 0.323),
    "3T": ((0.102, 0.032, 0.110, 0.015, 0.053, 0.010), 1.0, 0.243),
    "4U": ((0.182, 0.058, 0.198, 0.026, 0.096, 0.018), 1.172, 0.342),
    "4D": ((0.033, 0.011, 0.036, 0.005, 0.018, 0.003), 1.106, 0.284),
    "5T": ((0.165, 0.053, 0.181, 0.024, 0.087, 0.016), 1.172, 0.269),
}
# Night shares for the lighting factor: of all crashes, injury, property damage.
NIGHT = {"2U": (0.316, 0.424, 0.576), "3T": (0.304, 0.429, 0.571), "4U": (0.365, 0.517, 0.438), "4D": (0.410, 0.364, 0.636), "5T": (0.274, 0.432, 0.568)}
# Pedestrian and bicycle factors, posted speed up to 30 and above.
PEDESTRIAN = {"2U": (0.036, 0.005), "3T": (0.041, 0.013), "4U": (0.022, 0.009), "4D": (0.067, 0.019), "5T": (0.030, 0.023)}
BICYCLE = {"2U": (0.018, 0.004), "3T": (0.027, 0.007), "4U": (0.011, 0.002), "4D": (0.013, 0.005), "5T": (0.050, 0.012)}
SLOW_STREET = 30

# Intersection models by type, (intercept, slope on ln(max + 1), slope on ln(min + 1)).
RURAL_NODES = {
    "two_lane": {"3ST": (-9.86, 0.79, 0.49), "4ST": (-8.56, 0.60, 0.61), "SG": (-5.13, 0.60, 0.20)},
    "multi": {"3ST": (-12.526, 1.204, 0.236), "4ST": (-10.008, 0.848, 0.448), "SG": (-7.182, 0.722, 0.337)},
    "multi_fi": {"3ST": (-12.664, 1.107, 0.272), "4ST": (-11.554, 0.888, 0.525), "SG": (-6.393, 0.638, 0.232)},
}
RURAL_FATAL = {"3ST": 0.017, "4ST": 0.018, "SG": 0.009}
RURAL_PDO = {"3ST": 0.585, "4ST": 0.569, "SG": 0.660}
URBAN_NODES = {
    "mv": {"3ST": (-13.36, 1.11, 0.41), "3SG": (-12.13, 1.11, 0.26), "4ST": (-8.90, 0.82, 0.25), "4SG": (-10.99, 1.07, 0.23)},
    "mv_fi": {"3ST": (-14.01, 1.16, 0.30), "3SG": (-11.58, 1.02, 0.17), "4ST": (-11.13, 0.93, 0.28), "4SG": (-13.14, 1.18, 0.22)},
    "mv_pdo": {"3ST": (-15.38, 1.20, 0.51), "3SG": (-13.24, 1.14, 0.30), "4ST": (-8.74, 0.77, 0.23), "4SG": (-11.02, 1.02, 0.24)},
    "sv": {"3ST": (-6.81, 0.16, 0.51), "3SG": (-9.02, 0.42, 0.40), "4ST": (-5.33, 0.33, 0.12), "4SG": (-10.21, 0.68, 0.27)},
    "sv_fi": {"3SG": (-9.75, 0.27, 0.51), "4SG": (-9.25, 0.43, 0.29)},
    "sv_pdo": {"3ST": (-8.36, 0.25, 0.55), "3SG": (-9.08, 0.45, 0.33), "4ST": (-7.04, 0.36, 0.25), "4SG": (-11.34, 0.78, 0.25)},
}
SINGLE_FI_SHARE = {"3ST": 0.31, "4ST": 0.28}
NODE_PEDESTRIAN_SHARE = {"3ST": 0.021, "4ST": 0.022}
# Signal pedestrian model: intercept, ln ADT, ln(min / max), crossing volume slope and volume, lanes.
NODE_PEDESTRIAN = {"3SG": (-6.60, 0.05, 0.24, 0.41, 400, 0.09), "4SG": (-9.53, 0.40, 0.26, 0.45, 700, 0.04)}
NODE_BICYCLE = {"3ST": 0.016, "3SG": 0.011, "4ST": 0.018, "4SG": 0.015}


def _with_terms(df: DataFrame, kind: Column, terms: dict[str, dict[str, float]]) -> DataFrame:
    """The coefficients of each row's site type as columns; a type without a value gets null.

    Looked up in literal maps, so no row moves.
    """

    def value(table: dict[str, float]) -> Column:
        entries = F.create_map(*[x for k, v in sorted(table.items()) for x in (F.lit(k), F.lit(float(v)))])
        return F.try_element_at(entries, F.col("__kind"))

    return df.withColumn("__kind", kind).withColumns({n: value(table) for n, table in terms.items()}).drop("__kind")


def _columns(models: dict[str, dict[str, tuple]], prefix: str = "__") -> dict[str, dict[str, float]]:
    """One coefficient column per model and position: ``__mv0``, ``__mv1`` ..."""
    n = max(len(v) for t in models.values() for v in t.values())
    return {f"{prefix}{m}{i}": {k: v[i] for k, v in t.items()} for m, t in models.items() for i in range(n)}


def _interpolated(width: Column, table, adt: Column) -> Column:
    def line(lo: float, hi: float, slope: float) -> Column:
        return F.when(adt < 400, lo).when(adt > 2000, hi).otherwise(lo + slope * (adt - 400))

    rules = [(width >= w, line(*f)) for w, f in table if w is not None]
    return first_match(rules, line(*table[-1][1]))


def _freeway(df: DataFrame) -> DataFrame:
    lanes, two_way, adt = F.col("lanes"), F.col("dir") == 0, F.col("adt")
    per_side = F.when(two_way, lanes / 2).otherwise(lanes.cast("double"))
    rural = F.col("fc") < 10
    many = F.when(rural, "r4").when(two_way & (lanes == 8), "u4").when(two_way & (lanes >= 10), "u5").when(~two_way, "u4")
    side = F.when(rural, F.lit("r")).otherwise(F.lit("u"))
    kind = F.when(per_side == 2, F.concat(side, F.lit("2"))).when(per_side == 3, F.concat(side, F.lit("3"))).when(per_side >= 4, many)
    df = _with_terms(df, kind, {f"__{m}": table for m, (_, table) in FREEWAY.items()})
    ramps = 0.5 * (F.coalesce("entry_ramp", F.lit(0.0)) + F.coalesce("exit_ramp", F.lit(0.0)))
    width = F.col("lane_width")
    narrow = F.when(width < 13, F.exp(FREEWAY_LANE_SLOPE * (width - 12))).otherwise(FREEWAY_WIDE_LANE)
    df = df.withColumns(
        {"__miles": F.when(F.col("length") - ramps > 0, F.col("length") - ramps).otherwise(F.col("length")), "__ln": F.ln(0.001 * adt), "__narrow": narrow}
    )

    def model(name: str) -> Column:
        return F.coalesce(F.col("__miles") * F.exp(F.col(f"__{name}") + FREEWAY[name][0] * F.col("__ln")), F.lit(0.0))

    barrier = {k: F.when(F.col("median") == 1, f).otherwise(1.0) for k, f in FREEWAY_MEDIAN.items()}
    return df.withColumns(
        {
            "freeway_fi": (model("sv_fi") + model("mv_fi")) * F.col("__narrow") * barrier["fi"],
            "freeway_pdo": (model("sv_pdo") + model("mv_pdo")) * barrier["pdo"],
        }
    ).drop("__miles", "__ln", "__narrow", *[f"__{m}" for m in FREEWAY])


def _rural_multilane(df: DataFrame) -> DataFrame:
    divided, miles, adt = F.col("divided") == 1, F.col("length"), F.col("adt")

    def model(name: str) -> Column:
        (a1, b1), (a0, b0) = MULTILANE[name]
        return F.when(divided, F.exp(a1 + b1 * F.ln(adt))).otherwise(F.exp(a0 + b0 * F.ln(adt))) * miles

    width, shoulder = F.col("lane_width"), F.col("shoulder")
    f_lane = F.when(divided, (_interpolated(width, LANE_FACTORS["divided"], adt) - 1) * RELATED["divided"] + 1).otherwise(
        (_interpolated(width, LANE_FACTORS["undivided"], adt) - 1) * RELATED["undivided"] + 1
    )
    steps = first_match([(shoulder >= w, f) for w, f in DIVIDED_SHOULDER if w is not None], DIVIDED_SHOULDER[-1][1])
    f_side = F.when(divided, steps).otherwise((_interpolated(shoulder, SHOULDER_FACTORS, adt) - 1) * RELATED["undivided"] + 1)
    df = df.withColumn("__f", f_lane * f_side)
    df = df.withColumns({f"__{n}": F.coalesce(model(n) * F.col("__f"), F.lit(0.0)) for n in ("total", "fi")})
    return df.withColumns({"multi_fi": F.col("__fi"), "multi_pdo": F.col("__total") - F.col("__fi")}).drop("__f", "__fi", "__total")


def _rural_two_lane(adt: Column) -> Column:
    p = RELATED["two_lane"]
    f_lane = (_interpolated(F.col("lane_width"), LANE_FACTORS["two_lane"], adt) - 1) * p + 1
    f_side = (_interpolated(F.col("shoulder"), SHOULDER_FACTORS, adt) - 1) * p + 1
    f_turn = F.when(F.col("turn_lane") == 1, TWO_LANE["turn_lane"]).otherwise(1.0)
    return adt * F.col("length") * 365e-6 * F.exp(F.lit(TWO_LANE["base"])) * f_lane * f_side * f_turn


def _split(total: Column, fi: Column, pdo: Column) -> Column:
    """Fatal-injury part of the total model in the proportion of the severity models."""
    return total * F.try_divide(fi, fi + pdo)


def _urban(df: DataFrame) -> DataFrame:
    lanes, two_way, divided, adt = F.col("lanes"), F.col("dir") == 0, F.col("divided") == 1, F.col("adt")
    kind = (
        F.when(two_way & (lanes == 2) & ~divided, "2U")
        .when((two_way & (lanes < 4)) | (~two_way & (lanes == 1)), "3T")
        .when((two_way & lanes.isin(5, 7)) | (~two_way & (lanes > 1)), "5T")
        .when(two_way & (lanes > 3) & ~divided, "4U")
        .when(two_way & (lanes > 3), "4D")
    )
    lighting = {k: 1 - share * (1 - 0.72 * injury - 0.83 * damage) for k, (share, injury, damage) in NIGHT.items()}
    terms = {
        **_columns(ARTERIAL),
        "__rate": {k: DRIVEWAY_DENSITY * sum(v[0]) for k, v in DRIVEWAYS.items()},
        "__power": {k: v[1] for k, v in DRIVEWAYS.items()},
        "__severe": {k: v[2] for k, v in DRIVEWAYS.items()},
        "__lit": lighting,
        "__slow": {k: PEDESTRIAN[k][0] + BICYCLE[k][0] for k in PEDESTRIAN},
        "__fast": {k: PEDESTRIAN[k][1] + BICYCLE[k][1] for k in PEDESTRIAN},
    }
    df = _with_terms(df, kind, terms).withColumn("__ln", F.ln(adt))
    df = df.withColumns({f"__{m}": F.exp(F.col(f"__{m}0") + F.col(f"__{m}1") * F.col("__ln")) * F.col("length") for m in ARTERIAL})
    df = df.withColumn("__drive", F.col("__rate") * F.pow(adt / 15000, "__power"))
    c = F.col
    df = df.withColumns(
        {
            "__all": (c("__mv") + c("__sv") + c("__drive")) * c("__lit"),
            "__hurt": (_split(c("__mv"), c("__mv_fi"), c("__mv_pdo")) + _split(c("__sv"), c("__sv_fi"), c("__sv_pdo")) + c("__drive") * c("__severe")) * c("__lit"),
            "__out": F.when(c("speed_limit") <= SLOW_STREET, c("__slow")).otherwise(c("__fast")),
        }
    )
    walked = c("__all") * c("__out")
    df = df.withColumn("urban_fi", F.coalesce(c("__hurt") + walked, F.lit(0.0)))
    df = df.withColumn("urban_pdo", F.coalesce(c("__all") + walked, F.lit(0.0)) - c("urban_fi"))
    return df.drop(*terms, *[f"__{m}" for m in ARTERIAL], "__ln", "__drive", "__all", "__hurt", "__out")


def saf_segment_crashes(links: DataFrame) -> DataFrame:
    """Expected fatal, injury and property-damage crashes per link and year.

    Needs id, length, dir, lanes, fc, access, flow, divided, median, lane_width, shoulder,
    turn_lane, speed_limit, entry_ramp, exit_ramp. One-way links are modelled as half of a
    two-way road with twice the flow.
    """
    two_way, fc, lanes = F.col("dir") == 0, F.col("fc"), F.col("lanes")
    df = links.withColumn("adt", F.when(two_way, F.col("flow")).otherwise(2 * F.col("flow")).cast("double"))
    half = F.when(two_way, 1.0).otherwise(0.5)
    closed = F.col("access") == 3
    few = (two_way & (lanes < 4)) | (~two_way & (lanes == 1))
    several = (two_way & (lanes > 3)) | (~two_way & (lanes > 1))
    on = {
        "freeway": fc.isin(1, 11, 12) | closed,
        "multi": ~closed & (fc < 10) & several,
        "urban": ~closed & (fc > 10) & (fc < 20),
    }
    df = _urban(_rural_multilane(_freeway(df)))
    two = F.when(~closed & (fc < 10) & few, F.coalesce(_rural_two_lane(F.col("adt")), F.lit(0.0))).otherwise(0.0)
    for part in ("fi", "pdo"):
        added = sum((F.when(test, F.col(f"{k}_{part}")).otherwise(0.0) for k, test in on.items()), F.lit(0.0))
        df = df.withColumn(f"__{part}", half * added)
    df = df.withColumn("__two", half * two).drop(*[f"{k}_{part}" for k in on for part in ("fi", "pdo")])
    rest = 1 - TWO_LANE["pdo"] - TWO_LANE["fatal"]
    df = df.withColumns(
        {
            "fatal": F.col("__fi") * FATAL_SHARE + F.col("__two") * TWO_LANE["fatal"],
            "injury": F.col("__fi") * (1 - FATAL_SHARE) + F.col("__two") * rest,
            "pdo": F.col("__pdo") + F.col("__two") * TWO_LANE["pdo"],
        }
    )
    return df.withColumn("crashes", F.col("fatal") + F.col("injury") + F.col("pdo")).drop("__fi", "__pdo", "__two")


def node_volumes(links: DataFrame, flow: str = "flow") -> DataFrame:
    """Entering volume of each node (half the sum of its link flows), smallest and largest link flow.

    A node without links on one side has smallest flow 0.
    """
    ends = F.explode(F.array(F.struct(F.col("from_id").alias("node"), F.lit("A").alias("side")), F.struct(F.col("to_id").alias("node"), F.lit("B").alias("side"))))
    at = links.select(ends.alias("e"), F.col(flow).alias("v")).select("e.node", "e.side", "v")

    def low(side: str) -> Column:
        return F.coalesce(F.min(F.when(F.col("side") == side, F.col("v"))), F.lit(0))

    return at.groupBy("node").agg(
        F.count("*").alias("legs"), (F.sum("v") / 2).alias("int_adt"), F.least(low("A"), low("B")).alias("min_adt"), F.coalesce(F.max("v"), F.lit(0)).alias("max_adt")
    )


def saf_node_crashes(nodes: DataFrame) -> DataFrame:
    """Expected crashes at intersections.

    Needs node, legs, control, access, urban, multilane, zone, int_adt, min_adt, max_adt.
    Only controlled open intersections of more than two legs that are no zone centroid count.
    """
    use = nodes.filter(F.col("zone").isNull() & (F.col("legs") > 2) & (F.col("access") == 1) & (F.col("control") > 0))
    c, signal, three = F.col, F.col("control") == 1, F.col("legs") == 3
    use = use.withColumns({"__hi": F.ln(c("max_adt") + 1), "__lo": F.ln(c("min_adt") + 1)})
    rural_kind = F.when(signal, "SG").when(three, "3ST").otherwise("4ST")
    urban_kind = F.concat(F.when(three, "3").otherwise("4"), F.when(signal, "SG").otherwise("ST"))
    rural_terms = {**_columns(RURAL_NODES), "__fatal": RURAL_FATAL, "__damage": RURAL_PDO}
    urban_terms = {
        **_columns(URBAN_NODES),
        **_columns({"walk": NODE_PEDESTRIAN}),
        "__single": SINGLE_FI_SHARE,
        "__foot": NODE_PEDESTRIAN_SHARE,
        "__bike": NODE_BICYCLE,
    }
    df = _with_terms(_with_terms(use, rural_kind, rural_terms), urban_kind, urban_terms)
    models = [*RURAL_NODES, *URBAN_NODES]
    df = df.withColumns({f"__{m}": F.exp(c(f"__{m}0") + c(f"__{m}1") * c("__hi") + c(f"__{m}2") * c("__lo")) for m in models})
    lanes = F.when(c("multilane") == 1, 4).otherwise(2)
    crossing = F.exp(
        c("__walk0") + c("__walk1") * F.ln(c("int_adt") + 1) + c("__walk2") * (c("__lo") - c("__hi")) + c("__walk3") * F.ln("__walk4") + c("__walk5") * lanes
    )
    df = df.withColumn("__base", c("__mv") + c("__sv"))
    df = df.withColumn("__out", F.coalesce(c("__base") * c("__foot"), crossing) + c("__base") * c("__bike"))
    single = F.coalesce(c("__sv_fi"), c("__sv") * c("__single"))
    df = df.withColumn("__hurt", _split(c("__mv"), c("__mv_fi"), c("__mv_pdo")) + _split(c("__sv"), single, c("__sv_pdo")) + c("__out"))
    urban, wide = c("urban") == 1, c("multilane") == 1
    out = df.withColumns(
        {
            "fatal": F.when(urban, c("__hurt") * FATAL_SHARE).when(wide, c("__multi") * c("__fatal")).otherwise(c("__two_lane") * c("__fatal")),
            "injury": F.when(urban, c("__hurt") * (1 - FATAL_SHARE))
            .when(wide, c("__multi_fi") - c("__multi") * c("__fatal"))
            .otherwise(c("__two_lane") * (1 - c("__fatal") - c("__damage"))),
            "pdo": F.when(urban, c("__base") + c("__out") - c("__hurt")).when(wide, c("__multi") - c("__multi_fi")).otherwise(c("__two_lane") * c("__damage")),
        }
    )
    helpers = [*rural_terms, *urban_terms, *[f"__{m}" for m in models], "__hi", "__lo", "__base", "__out", "__hurt"]
    return out.withColumn("crashes", c("fatal") + c("injury") + c("pdo")).drop(*helpers)


def saf_distribute_nodes(links: DataFrame, nodes: DataFrame, calibration: dict[str, float] | None = None) -> DataFrame:
    """Intersection crashes added to the incident links by their share of the node's flow, calibrated."""
    kinds = ("fatal", "injury", "pdo")
    ends = links.select("id", F.coalesce("flow", F.lit(0)).alias("flow"), F.explode(F.array("from_id", "to_id")).alias("node"))
    totals = ends.groupBy("node").agg(F.sum("flow").alias("node_flow")).filter("node_flow <> 0")
    at = nodes.select("node", *[F.col(k).alias(f"__{k}") for k in kinds]).join(totals, "node")
    shares = ends.join(at, "node")
    added = shares.groupBy("id").agg(*[F.sum(F.col("flow") * F.col(f"__{k}") / F.col("node_flow")).alias(f"__{k}") for k in kinds])
    factors = calibration or CALIBRATION
    joined = links.join(added, "id", "left")
    out = joined.withColumns({k: factors[k] * (F.coalesce(F.col(k), F.lit(0.0)) + F.coalesce(F.col(f"__{k}"), F.lit(0.0))) for k in kinds})
    return out.withColumn("crashes", F.col("fatal") + F.col("injury") + F.col("pdo")).drop(*[f"__{k}" for k in kinds])
