"""Highway operators: speeds, capacities, costs, hourly volumes, fuel and emissions.

Links are handled one row per direction (:func:`wayfare.plans.network.net_directional`),
so every formula is stated once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import SIGNS, first_match, project_case_map

RURAL, URBAN = -1, 1

# Free-flow speed curves by facility, area and access control (None = any).
# inverse: 1 / (a - b ln s) + c s; quadratic: a + b s + c s^2; power: a s^0.857638 - b exp(-41.803252 / s)
SPEED_CURVES = (
    (("owol", None, None), "inverse", (0.119687, 0.023365, 0.373821)),
    (("owml", None, None), "inverse", (0.081714, 0.016217, 0.0)),
    (("twtl", RURAL, None), "quadratic", (28.4, 0.0, 0.009751)),
    (("twtl", URBAN, None), "quadratic", (6.6, 0.9437, 0.0)),
    (("tw3l", None, None), "inverse", (0.119687, 0.023365, 0.373821)),
    (("twmlu", RURAL, None), "power", (3.6, 113.0)),
    (("twmlu", URBAN, None), "power", (3.0, 75.0)),
    (("twmld", RURAL, 3), "quadratic", (9.0, 0.95, 0.0)),
    (("twmld", URBAN, 3), "inverse", (0.081714, 0.016217, 0.0)),
    (("twmld", None, 2), "quadratic", (35.0, 0.0, 0.009)),
    (("fwy", None, None), "quadratic", (-33.5, 2.75, -0.0175)),
    (("ramp", None, None), "quadratic", (12.4892, 1.3776, -0.0061)),
)
DEFAULT_CURVE = ("quadratic", (0.0, 1.1, 0.0))
UNPOSTED_SPEED = 20

# Capacity types and ideal lane capacities (upper speed, capacity).
CAPACITY_TYPE = {
    "cc": "cc", "fwy": "fwy", "ramp": "fwy", "rndabt2": "rndabt", "rndabt1": "rndabt", "gis": "gis", "owol": "twy", "twtl": "twy", "tw3l": "twy",
}
IDEAL_FIXED = {"cc": 20000, "twy": 1700}
IDEAL_ROUNDABOUT = {"rndabt2": 1000, "rndabt1": 1300}
IDEAL_BY_SPEED = {"multi": ((50, 1900), (55, 2000), (60, 2100), (None, 2200)), "fwy": ((60, 2250), (65, 2300), (70, 2350), (None, 2400))}
SLOW_RAMP_SPEED, SLOW_RAMP_CAPACITY, ONE_LANE_RAMP = 40, 1700, 1000

# Lateral clearance curves by lanes.
# freeway: (a + w) / (b + c v) + 1; multilane: (a + v) / (b + c w^2) + d w; not below the first value.
FREEWAY_CLEARANCE = (
    (("<", 3), (0.9345, -6.00001, 0.00010, 1.66667)),
    (("==", 3), (0.9564, -5.99999, -0.00084, 2.50001)),
    (("==", 4), (0.9782, -6.00001, -0.00002, 5.0)),
    ((">=", 5), (0.9891, -6.00002, 0.00371, 9.99994)),
)
MULTILANE_CLEARANCE = (
    (("<", 6), (0.8800, 1095.74797, 1280.33942, 6.53454, 0.03975)),
    ((">=", 6), (0.9133, 1485.43810, 1660.34815, 3.09810, 0.02166)),
)
LANE_WIDTH_FACTOR = {12: 1.0000, 11: 0.9708}
NARROW_LANE_FACTOR = 0.8985
WIDE_SHOULDER_FACTOR = {9: 0.9537, 10: 0.9768, 11: 0.9916, 12: 1.0000}
SHOULDER_CURVES = ((4, (0.8800, 1.43621, 0.26354, 0.09366, 8.06484)), (6, (0.9125, 1.58362, 0.24881, 0.09472, 8.34158)))
WEAVE = ((5, 0.66), (4, 0.73), (3, 0.80), (2, 0.88))
CLIMB_GRADE, CLIMB_TRUCKS, CLIMB_FLOW_SHARE = 0.044, 0.10, 0.10
CORRECTION = {1: 1.3, 2: 1.6}
PEAK_HOURS = {"am": 2.8, "pm": 2.9}
INVERSE_K = {"fwy": 11.36, "urban": 10.86, "other": 10.0}
DELAY_CURVE = (-460.0, 745.0)

# Run parameters; a run passes its own values over these.
PARAMETERS = {
    "clen": 90.0, "higc": 0.6, "hipf": 0.5, "mdpf": 0.333, "lopf": 0.256, "sgad": 0.5, "stpd": 10.0, "stad": 0.5,
    "fwya": 0.83, "fwyb": 5.5, "paca": 0.71, "pacb": 4.0, "siga": 0.60, "sigb": 4.0, "stpa": 0.60, "stpb": 4.0, "otha": 0.15, "othb": 4.0,
    "supce": 1.5, "mupce": 2.5,
}

# Functional classes by cost rank; grams to US tons.
COST_RANKS = (((1, 11), 1), ((2, 12, 10, 20), 2), ((6, 14), 3), ((7, 16), 4), ((8, 17), 5))
GRAMS_TO_TONS = 1.10231131e-6


def _curve(kind: str, k: Sequence[float], s: Column) -> Column:
    if kind == "inverse":
        return 1.0 / (k[0] - k[1] * F.ln(s)) + k[2] * s
    if kind == "power":
        return k[0] * F.pow(s, F.lit(0.857638)) - k[1] * F.exp(-41.803252 / s)
    return k[0] + k[1] * s + k[2] * s * s


def hwy_facility(links: DataFrame) -> DataFrame:
    """Lanes per direction, area type and facility type."""
    fc, d, one, median = F.col("fc"), F.col("dir"), F.col("dirlanes") == 1, F.col("median") == 1
    lanes = F.when(d == 1, F.col("ab_lanes")).when(d == -1, F.col("ba_lanes")).when(d == 0, (F.col("ab_lanes") + F.col("ba_lanes")) / 2)
    many = F.col("dirlanes") > 1
    kinds = [
        (fc.isNull(), "gis"),
        (fc > 97, "cc"),
        (fc == 92, "rndabt2"),
        (fc == 91, "rndabt1"),
        (F.col("ramp") == 1, "ramp"),
        (fc.isin(1, 11) | ((fc == 12) & median), "fwy"),
        ((F.col("access") == 3) & many & median, "fwy"),
        ((d == 0) & one & (F.col("turnlane") == 1) & ~median, "tw3l"),
        ((d == 0) & one, "twtl"),
        (many & ~median, "twmlu"),
        (many & median, "twmld"),
        ((d != 0) & one, "owol"),
        ((d != 0) & many, "owml"),
    ]
    area = F.when(fc < 10, RURAL).when((fc > 10) & (fc < 30), URBAN).otherwise(0)
    return links.withColumn("dirlanes", lanes.cast("double")).withColumns({"area": area, "factype": first_match(kinds, "bad")})


def hwy_free_flow_speed(links: DataFrame, adjust: dict[str, float] | None = None) -> DataFrame:
    """Free-flow speed and time without control delay; connectors go by zone size.

    ``adjust`` adds miles per hour per facility type.
    """
    full = hwy_facility(links)
    s, fac = F.col("pspeed").cast("double"), F.col("factype")
    rules = [(s.isNull(), F.lit(float(UNPOSTED_SPEED)))]
    for (kind, area, access), form, k in SPEED_CURVES:
        test = fac == kind
        test = test if area is None else test & (F.col("area") == area)
        test = test if access is None else test & (F.col("access") == access)
        rules.append((test, _curve(form, k, s) + float((adjust or {}).get(kind, 0.0))))
    speed = first_match(rules, _curve(*DEFAULT_CURVE, s))
    radius = F.sqrt(F.col("taz_area") / 3.14159) if "taz_area" in links.columns else F.lit(0.0)
    radius = F.coalesce(radius, F.lit(0.0))
    is_cc = fac == "cc"
    full = full.withColumn("ffspeed", F.when(is_cc, F.greatest(F.lit(45.0), 20 + 20 * F.ln(radius + 1))).otherwise(speed))
    miles = F.when(is_cc, F.greatest(radius, F.col("length"))).otherwise(F.col("length"))
    return full.withColumn("fftime", 60 * miles / F.col("ffspeed"))


def _lane_capacity(df: DataFrame) -> DataFrame:
    """Peak-hour capacity per lane without control delay."""
    fac, cap, v, lanes = F.col("factype"), F.col("captype"), F.col("ffspeed"), F.col("dirlanes")
    urban, rural = F.col("area") == URBAN, F.col("area") == RURAL
    ideal = [(cap == k, float(c)) for k, c in IDEAL_FIXED.items()] + [(fac == k, float(c)) for k, c in IDEAL_ROUNDABOUT.items()]
    for k, steps in IDEAL_BY_SPEED.items():
        if k == "fwy":
            ideal.append(((F.col("ramp") == 1) & (F.col("pspeed") < SLOW_RAMP_SPEED), float(SLOW_RAMP_CAPACITY)))
        ideal += [((cap == k) if top is None else (cap == k) & (v < top), float(c)) for top, c in steps]
    shoulder = F.greatest(F.least(F.coalesce(F.col("rswidth"), F.lit(2)), F.lit(6)), F.lit(2)).cast("double")
    width = F.greatest(F.least(F.coalesce(F.col("lnwidth"), F.lit(11)), F.lit(12)), F.lit(9)).cast("double")
    narrow = cap == "twy"
    trucks = F.when(narrow & rural, 0.05).when(narrow & urban, 0.04).when(rural, 0.06).otherwise(0.04)
    f_hv = 1 / (1 + 0.5 * trucks)
    points = F.when(cap == "fwy", 0.0).when(F.col("access") == 2, 2.5).when(rural, 10.0).when(urban, 25.0).otherwise(16.0)
    split = F.when(rural, 0.55).otherwise(0.5)
    f_d = F.least(F.lit(1.0), F.greatest(F.lit(0.826), 0.71 + 0.58 * (1 - split)))

    def clamp(lo: float, x: Column) -> Column:
        return F.least(F.lit(1.0), F.greatest(F.lit(lo), x))

    side = []
    for (sign, n), (lo, a, b, c) in FREEWAY_CLEARANCE:
        side.append(((cap == "fwy") & SIGNS[sign](lanes, n), clamp(lo, (a + shoulder) / (b + c * v) + 1)))
    for (sign, n), (lo, a, b, c, d) in MULTILANE_CLEARANCE:
        side.append(((cap == "multi") & SIGNS[sign](lanes, n), clamp(lo, (a + v) / (b + c * shoulder * shoulder) + d * shoulder)))
    f_w = first_match(side)
    f_lw = project_case_map(width, LANE_WIDTH_FACTOR, F.when(width < 11, NARROW_LANE_FACTOR))
    f_ls = first_match(
        [(shoulder < top, clamp(lo, a * F.pow(v, b - c * F.ln(width)) - d / width)) for top, (lo, a, b, c, d) in SHOULDER_CURVES],
        project_case_map(width, WIDE_SHOULDER_FACTOR),
    )
    divided = fac.isin("fwy", "twmld", "owol", "owml")
    f_m = F.when(divided, 1.0).otherwise(0.9695)
    per_point = F.when(fac == "tw3l", 0.00266).otherwise(0.00532)
    f_a = (
        F.when(rural, 1.0)
        .when(cap == "multi", clamp(0.8333, 1.07209 - 0.00481 * points - 3.75 / v))
        .when(narrow, clamp(0.8125, 1.07984 - per_point * points - 3.75 / v))
        .otherwise(1.0)
    )
    f_weave = F.when(F.coalesce(F.col("weavelane"), F.lit(0)) == 0, 1.0).otherwise(first_match([(lanes >= n, f) for n, f in WEAVE]))
    f_aux = F.when(F.coalesce(F.col("auxlane"), F.lit(0)) == 0, 1.0).otherwise(F.try_divide(lanes - 0.5, lanes))
    flow = CLIMB_FLOW_SHARE * (F.coalesce("ab_basevol", F.lit(0)) + F.coalesce("ba_basevol", F.lit(0)))
    rolling = 0.9586720 + 0.783068 * CLIMB_GRADE - 0.0000256 * flow
    steep = 0.979500 - 7.822222 * CLIMB_GRADE + 0.0003343 * flow
    freeway_climb = min(1.0, 1.140849 - 2.33864 * math.pow(CLIMB_GRADE, 1.095345) - 0.68344 * math.pow(CLIMB_TRUCKS, 0.53738))
    f_tcl = (
        F.when(F.coalesce(F.col("truckclimb"), F.lit(0)) == 0, 1.0)
        .when(cap == "fwy", freeway_climb)
        .when(F.col("fc").isin(2, 6, 14, 16), F.least(steep, rolling, F.lit(1.0)))
        .when(F.col("fc").isin(7, 8, 9, 17, 19), F.least(F.lit(1.0), rolling))
        .otherwise(1.0)
    )
    df = df.withColumn("idealcap", first_match(ideal, 1.0))
    common = F.col("idealcap") * f_hv * f_weave * f_aux * f_tcl
    lane = (
        F.when((fac == "ramp") & (lanes < 2), float(ONE_LANE_RAMP))
        .when(cap == "fwy", common * f_w * f_lw)
        .when(cap == "multi", common * f_w * f_lw * f_m * f_a)
        .when(narrow, common * f_ls * f_d * f_a)
        .when(cap.isin("cc", "rndabt"), F.col("idealcap"))
    )
    return df.withColumn("lanecap", lane)


def hwy_capacity(links: DataFrame, params: dict[str, float] | None = None) -> DataFrame:
    """Control delay, adjusted time, period capacities and volume-delay terms per direction.

    Input is the output of :func:`hwy_free_flow_speed`; a direction is delayed by the
    control at its far end, and only directions with lanes are returned.
    """
    p = {**PARAMETERS, **(params or {})}
    typed = links.withColumn("captype", project_case_map("factype", CAPACITY_TYPE, "multi"))
    both = _lane_capacity(typed)
    far = [
        F.struct(F.lit(d).alias("flow"), F.col(f"{d.lower()}_lanes").alias("lanes"), F.col(f"{e}_ctrl").alias("ctrl"), F.col(f"{e}_prio").alias("prio"), F.col(f"{e}_sync").alias("sync"))
        for d, e in (("AB", "b"), ("BA", "a"))
    ]
    df = both.withColumn("way", F.explode(F.array(*far))).select(*both.columns, "way.*").filter("lanes > 0")
    ctrl, prio, v = F.col("ctrl"), F.col("prio"), F.col("ffspeed")
    speed_change = v * 5280 / 3600 * (1 / 10 + 1 / 5)
    green = F.when(prio == 1, p["higc"]).when(prio == 2, 0.5).when(prio == 3, 1 - p["higc"])
    progress = F.when(F.col("sync") == 1, project_case_map(prio, {1: p["hipf"] * p["mdpf"] * p["lopf"], 2: p["mdpf"] * p["lopf"], 3: p["lopf"]}, 1.0)).otherwise(1.0)
    signal = (0.5 * p["clen"] * F.pow(1 - green, F.lit(2)) + p["sgad"] * speed_change) * progress
    stop = p["stpd"] + p["stad"] * speed_change
    seconds = (
        F.when((F.col("access") == 3) & (F.col("factype") != "ramp"), 0.0)
        .when(ctrl == 1, signal)
        .when(((ctrl == 2) & (prio > 2)) | (ctrl == 4), stop)
        .when((ctrl == 5) | (F.col("captype") == "rndabt"), p["stad"] * speed_change)
        .otherwise(0.0)
    )
    is_cc = F.col("factype") == "cc"
    df = df.withColumn("delay", seconds / 60)
    df = df.withColumn("afftime", F.when(is_cc, F.col("fftime")).otherwise(F.col("fftime") + F.col("delay")))
    df = df.withColumn("affspeed", F.when(is_cc, v).otherwise(F.try_divide(60 * F.col("length"), F.col("afftime"))))
    ratio = F.greatest(F.lit(0.25), F.col("affspeed") / v)
    c0, c1 = DELAY_CURVE
    f_delay = F.least(F.lit(1.0), (c0 + c1 * F.ln(ratio * v)) / (c0 + c1 * F.ln(v)))
    hourly = F.coalesce("lanecap", F.lit(0.0)) * f_delay * project_case_map("correction", CORRECTION, 1.0) * F.col("lanes")
    k = F.when(F.col("captype") == "fwy", INVERSE_K["fwy"]).when(F.col("area") == URBAN, INVERSE_K["urban"]).otherwise(INVERSE_K["other"])
    df = df.withColumn("hourcap", hourly)
    one = F.lit(1.0)
    df = df.withColumns({f"{n}_cap": F.greatest(one, F.col("hourcap") * h) for n, h in PEAK_HOURS.items()} | {"dly_cap": F.greatest(one, F.col("hourcap") * k)})
    df = df.withColumn("op_cap", F.greatest(one, F.col("dly_cap") - (F.col("am_cap") + F.col("pm_cap"))))

    def term(x: str, cc: float) -> Column:
        return (
            F.when(is_cc, cc)
            .when(F.col("factype") == "fwy", p[f"fwy{x}"])
            .when((F.col("factype") == "ramp") | (F.col("access") == 2), p[f"pac{x}"])
            .when(ctrl == 1, p[f"sig{x}"])
            .when((ctrl > 1) & (F.col("delay") > 0), p[f"stp{x}"])
            .when(F.col("delay") == 0, p[f"oth{x}"])
        )

    return df.withColumns({"bpr_a": term("a", 0.15), "bpr_b": term("b", 4.0)})


def hwy_generalised_cost(links: DataFrame, factors: Sequence[float], rail_delay: float, vot: float, delay_factor: float) -> DataFrame:
    """Distance penalty, fixed toll and generalised time of one vehicle class per direction.

    ``factors`` are the six class factors; a rank's penalty per mile is the product of its
    own factor and those of all lower ranks. Needs fc, length, rail, fftime and time.
    """
    products = {r: math.prod(factors[r - 1 :]) for r in range(1, 7)}
    fc = F.col("fc")
    rank = first_match([(fc.isin(*codes) | (fc > 70) if r == 1 else fc.isin(*codes), r) for codes, r in COST_RANKS], 6)
    ftb = F.greatest(F.lit(0.0), F.col("length") * project_case_map(rank, products)) + F.coalesce("rail", F.lit(0)) * rail_delay
    out = links.withColumn("ftb", ftb)
    per_minute = vot / 60
    toll = F.greatest(F.col("ftb") * per_minute - per_minute * (delay_factor - 1) * F.col("fftime"), F.lit(0.0))
    gct = delay_factor * F.col("time") + F.col("fftime") * (1 - delay_factor) + F.col("ftb")
    return out.withColumns({"toll": toll, "gctime": gct})


def hwy_flow_rollup(links: DataFrame, parts: Sequence[str], preload: str | None = None) -> DataFrame:
    """Class and period flows (``ab_am_auto`` ...) added up per period, class and direction; nulls are 0."""
    tags = [p.split("_") for p in parts]

    def total(name: str, keep: list[str]) -> Column:
        cols = sum((F.coalesce(F.col(k), F.lit(0)) for k in keep), F.lit(0))
        if preload is not None and name.endswith("tot"):
            cols = cols + F.coalesce(F.col(preload), F.lit(0))
        return cols.alias(name)

    out = []
    for d in sorted({t[0] for t in tags}):
        for tod in sorted({t[1] for t in tags}):
            out.append(total(f"{d}_{tod}_tot", [p for p, t in zip(parts, tags, strict=True) if t[0] == d and t[1] == tod]))
        for veh in sorted({t[2] for t in tags}):
            out.append(total(f"{d}_{veh}", [p for p, t in zip(parts, tags, strict=True) if t[0] == d and t[2] == veh]))
    return links.select("id", *out, total("flow", list(parts)))


def hwy_congested_time(df: DataFrame, periods: Sequence[str] = ("am", "pm", "op")) -> DataFrame:
    """Flow-weighted time over the periods; a period weighs at least one vehicle."""
    weighted = sum((F.col(f"{p}_time") * F.greatest(F.col(f"{p}_flow"), F.lit(1)) for p in periods), F.lit(0.0))
    flows = sum((F.col(f"{p}_flow") for p in periods), F.lit(0))
    return df.withColumn("ctime", weighted / F.greatest(flows, F.lit(len(periods))))


def hwy_voc(df: DataFrame, periods: Sequence[str] = ("am", "pm", "op")) -> DataFrame:
    """Volume over capacity by period and for the day, the worse direction of two-way links.

    Needs ``ab_/ba_<period>_flow`` and ``_cap``, ``ab_/ba_dly_cap`` and ``dir``.
    """

    def ratio(side: str, flow: Column, cap: str) -> Column:
        return F.try_divide(flow.cast("double"), F.col(f"{side}_{cap}_cap"))

    def flow(side: str, p: str) -> Column:
        return F.coalesce(F.col(f"{side}_{p}_flow"), F.lit(0))

    out = {}
    for p in periods:
        ab, ba = ratio("ab", flow("ab", p), p), ratio("ba", flow("ba", p), p)
        out[f"{p}_voc"] = F.when(F.col("dir") == 0, F.greatest(ab, ba)).when(F.col("dir") == 1, ab).when(F.col("dir") == -1, ba)
    day = {s: sum((flow(s, p) for p in periods), F.lit(0)) for s in ("ab", "ba")}
    out["dly_voc"] = F.greatest(ratio("ab", day["ab"], "dly"), ratio("ba", day["ba"], "dly"))
    return df.withColumns(out)


AREA_GROUPS = ("rf", "ro", "uf", "uo")


def area_group(fc: str = "fc") -> Column:
    """Profile group: rural freeway, other rural, urban freeway, other urban."""
    c = F.col(fc)
    return F.when(c == 1, "rf").when(c < 11, "ro").when(c < 14, "uf").otherwise("uo")


def hwy_hourly_profile(dlinks: DataFrame, profile: DataFrame, params: dict[str, float] | None = None) -> DataFrame:
    """Directed links by hour: class volumes, congested time, lost time, speed.

    ``dlinks`` has ``<period>_<car|su|mu>`` volumes, length, fftime, pm_cap, bpr_a, bpr_b and
    fc. ``profile`` is (area_group, hour, period, car, su, mu) with shares that add to one
    within a period; other area groups are left out, and one that is missing is an error as
    soon as a link needs it. Volumes below one vehicle are dropped. Loss is capped by 6 mph on
    freeways and 5 minutes elsewhere.
    """
    p = {**PARAMETERS, **(params or {})}
    # One row for each of the four area groups, with its hours in an array: four rows whatever the
    # profile holds, and a link meets one of them. An hour that comes twice is an error of the profile.
    hours = F.array_sort(F.collect_list(F.struct("hour", "period", "car", "su", "mu")))
    twice = F.raise_error(F.concat(F.lit("profile has an hour twice in area group "), F.first("area_group")))
    by_area = profile.filter(F.col("area_group").isin(*AREA_GROUPS)).groupBy("area_group").agg(F.when(F.count("hour") == F.count_distinct("hour"), hours).otherwise(twice).alias("hours"))
    met = dlinks.withColumn("area_group", area_group()).join(F.broadcast(by_area), "area_group", "left")
    missing = F.raise_error(F.concat(F.lit("profile lacks area group "), "area_group"))
    full = met.withColumn("h", F.explode(F.when(F.col("hours").isNull(), missing).otherwise(F.col("hours")))).drop("hours").select("*", "h.*").drop("h")

    def volume(cls: str) -> Column:
        return first_match([(F.col("period") == t, F.col(f"{t}_{cls}")) for t in ("am", "pm", "op")])

    raw = {c: volume(c) for c in ("car", "su", "mu")}
    v = {c: F.when(F.coalesce(x, F.lit(0)) < 1, 0.0).otherwise(x.cast("double")) for c, x in raw.items()}
    full = full.withColumns({f"vol_{c}": x * F.col(c) for c, x in v.items()}).drop("car", "su", "mu")
    full = full.withColumns(
        {
            "vol": F.col("vol_car") + F.col("vol_su") + F.col("vol_mu"),
            "pce": F.col("vol_car") + p["supce"] * F.col("vol_su") + p["mupce"] * F.col("vol_mu"),
        }
    )
    full = full.withColumn("vc", F.when(F.col("pm_cap") == 0, 0.0).otherwise(F.try_divide("pce", F.col("pm_cap") / 3)))
    fft, miles, freeway = F.col("fftime"), F.col("length"), F.col("fc").isin(1, 11, 12)
    full = full.withColumn("raw_time", fft * (1 + F.col("bpr_a") * F.pow("vc", "bpr_b")))
    loss = F.col("raw_time") - fft
    slow = F.try_divide(miles * 60, F.col("raw_time")) < 6
    capped = F.when(freeway & slow, miles * 60 / 6 - fft).when(~freeway & (loss > 5), 5.0).otherwise(loss)
    full = full.withColumn("lost", F.greatest(capped, F.lit(0.0))).withColumn("time", F.col("lost") + fft).drop("raw_time")
    full = full.withColumn("speed", F.try_divide(miles * 60, F.col("time")))
    full = full.withColumns({f"vmt_{c}": F.col(f"vol_{c}") * miles for c in ("car", "su", "mu")})
    return full.withColumns(
        {
            "speed_row": F.greatest(F.least(F.floor("speed"), F.lit(80)), F.lit(5)).cast("int"),
            "vmt": F.col("vol") * miles,
            "vht": F.col("vol") * F.col("time") / 60,
            "delay_hours": F.col("lost") * F.col("vol") / 60,
        }
    )


# First and last hour of the peaks.
PEAKS = {"am": (7, 9), "pm": (16, 18)}


def hwy_peak_stats(hourly: DataFrame, keys: Sequence[str] = ("id", "flow")) -> DataFrame:
    """Peak-hour and peak-period volumes, ratios and speeds per directed link in one pass."""
    aggs = []
    for n, (a, b) in PEAKS.items():
        inside = F.col("hour").between(a, b)

        def pick(c: str, inside: Column = inside) -> Column:
            return F.when(inside, F.col(c))

        aggs += [
            F.max(pick("vol")).alias(f"{n}pk_vol"),
            F.max(pick("pce")).alias(f"{n}pk_pce"),
            F.max(pick("vc")).alias(f"{n}pk_vc"),
            F.min(pick("speed_row")).alias(f"{n}pk_speed"),
            F.sum(pick("vol")).alias(f"{n}pd_vol"),
            F.try_divide(F.sum(pick("pce")), F.max(f"{n}_cap")).alias(f"{n}pd_vc"),
            F.try_divide(F.sum(pick("vmt")), F.sum(pick("vht"))).alias(f"{n}pd_speed"),
        ]
    return hourly.groupBy(*keys).agg(*aggs, F.max("vc").alias("max_vc"), F.max("vol").alias("max_vol"), F.min("speed_row").alias("low_speed"), F.sum("delay_hours").alias("delay"))


# Vehicle classes, and the columns their miles and volumes are summed from; all trucks have rates of their own.
CLASSES = {"car": ("car",), "su": ("su",), "mu": ("mu",)}
ALL_CLASSES = CLASSES | {"trk": ("su", "mu")}


def hwy_fuel_emissions(
    hourly: DataFrame, rates: DataFrame, costs: dict, keys: Sequence[str] = (), non_fuel: dict[str, float] | None = None, classes: dict = CLASSES
) -> DataFrame:
    """Running and start emissions by class and pollutant, fuel and non-fuel cost, as amount times unit cost.

    ``rates`` is (cls, measure, speed, rate); a speed without a row takes the nearest lower one, none
    below the first. Rates depend on class and speed only, so miles are added up by speed first; the
    rates of a class and measure are one short sorted array, in which each speed finds its row. Starts are
    valued at the rate of the first row; ``fuel`` is not a pollutant, has no starts and is not
    converted to tons. A cost is one number or one for each class, 1 if not given; ``non_fuel`` is a cost a mile by class.
    """
    parts = [
        F.struct(F.lit(c).alias("cls"), *[reduce(add, [F.col(f"{m}_{p}") for p in of]).alias(m) for m in ("vmt", "vol")]) for c, of in classes.items()
    ]
    long = hourly.select(*keys, "speed_row", F.explode(F.array(*parts)).alias("c"))
    binned = long.groupBy(*keys, F.col("speed_row").alias("speed"), "c.cls").agg(F.sum("c.vmt").alias("vmt"), F.sum("c.vol").alias("vol"))
    unit = project_case_map("measure", {m: project_case_map("cls", c, 1.0) if isinstance(c, dict) else c for m, c in costs.items()}, 1.0)
    unit = unit * F.when(F.col("measure") == "fuel", 1.0).otherwise(GRAMS_TO_TONS)
    steps = F.array_sort(F.collect_set(F.struct("speed", "rate")))  # whole speeds only: at most some 80
    table = rates.groupBy("cls", "measure").agg(steps.alias("steps"))
    valued = binned.join(table, "cls").withColumn("rate", F.try_element_at(F.filter("steps", lambda s: s["speed"] <= F.col("speed")), F.lit(-1))["rate"])
    running = valued.filter("rate IS NOT NULL").groupBy(*keys, "cls", "measure").agg(F.sum(F.col("vmt") * F.col("rate") * unit).alias("value"))
    out = running.withColumn("kind", F.lit("running"))
    by_class = binned.groupBy(*keys, "cls").agg(F.sum("vmt").alias("vmt"), F.sum("vol").alias("vol"))
    first = table.filter("measure <> 'fuel'").select("cls", "measure", F.col("steps")[0]["rate"].alias("rate"))
    starts = by_class.join(first, "cls").select(*keys, "cls", "measure", (F.col("vol") * F.col("rate") * unit).alias("value"))
    out = out.unionByName(starts.withColumn("kind", F.lit("start")))
    if non_fuel:
        worn = by_class.withColumn("value", F.col("vmt") * project_case_map("cls", non_fuel)).filter("value IS NOT NULL")
        out = out.unionByName(worn.select(*keys, "cls", F.lit("non_fuel").alias("measure"), "value", F.lit("running").alias("kind")))
    return out
