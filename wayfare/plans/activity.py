"""Activity summaries: prepared household, person, day, tour and trip frames.

Each ``act_*`` joins the person attributes it needs and adds the coded columns that the
crosstabs of :func:`act_summary` count. Zone districts come from a (taz, district) frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..functions.recode import project_case_map, project_clamp, project_missing_sentinel, project_overwrite_recodes, project_purpose_merge
from ..operators.aggregates import Template, agg_crosstab_complete
from ..operators.windows import group_totals

# Codes of the activity summaries.
INCOME_CUTS = (15000, 50000, 75000)
DRIVING_AGE = 16
MAX_CARS = 4
PURPOSES = ("wk", "sc", "es", "pb", "sh", "ml", "so")
FOLDED = {"me": "pb", "re": "so"}
TOUR_PURPOSE_MERGE = {8: 7, 9: 4}
TRIP_PURPOSE_MERGE = {8: 7, 9: 4, 0: 8}
WORKER_TYPE = {1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 8: 3}
STUDENT_TYPE = {1: 4, 2: 4, 3: 4, 4: 4, 5: 3, 6: 2, 7: 1, 8: 4}
OUTSIDE_DISTRICT = 13
OUTSIDE_BAND = 91
TOUR_MODE = {3: 1, 4: 2, 5: 3, 7: 4, 6: 5, 2: 6, 1: 7, 8: 8}
TRIP_MODE = {3: 1, 4: 2, 5: 3, 8: 9, 2: 10, 1: 11}
TRANSIT_PATH_MODE = {3: 4, 4: 5, 5: 6, 6: 7, 7: 8}
TRANSIT = 6
TOUR_TOD_PURPOSE = {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3}
HALF_HOURS = [0.0] + [3 + i / 2 for i in range(50)]
TOUR_DURATIONS = [i / 2 for i in range(49)]
TRIP_DURATIONS = [i / 2 for i in range(48)]
SKIM_PERIOD_CUTS = (360, 540, 930, 1110)


def _band(col: str | Column, last: int) -> Column:
    """findInterval over 0..last: the whole part plus one, 0 below zero, capped at the top."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c < 0, 0).otherwise(F.least(F.floor(c) + 1, F.lit(last + 1)))


def _district(df: DataFrame, zones: DataFrame, taz: str, out: str) -> DataFrame:
    return df.join(zones.select(F.col("taz").alias(taz), F.col("district").alias(out)), taz, "left")


def _drivers(hh: DataFrame, per: DataFrame, how: str) -> DataFrame:
    count = per.groupBy("hhno").agg(F.sum((F.col("pagey") >= DRIVING_AGE).cast("int")).alias("drivers"))
    return hh.join(count, "hhno", how).withColumn("drivers", project_clamp("drivers", hi=MAX_CARS))


def act_summary(df: DataFrame, x: str, x_range: tuple[int, int], y: str, y_range: tuple[int, int], weight: str, subset: Column | None = None) -> DataFrame:
    return agg_crosstab_complete(df, x, x_range, y, y_range, weight, subset)


def act_vehicle_availability(hh: DataFrame, per: DataFrame, zones: DataFrame) -> DataFrame:
    """Households with vehicles and drivers capped at 4, income band 1-4 and district."""
    out = _drivers(hh, per, "inner").withColumns(
        {"vehcat": project_clamp("hhvehs", hi=MAX_CARS), "inccat": fn.fn_find_interval("hhincome", INCOME_CUTS) + 1}
    )
    return _district(out, zones, "hhtaz", "hhdistrict")


def act_vehicle_sufficiency(hh: DataFrame, per: DataFrame) -> DataFrame:
    """1 no vehicle, 2 fewer vehicles than drivers, 3 as many, 4 more; null without persons."""
    v, d = F.col("hhvehs"), F.col("drivers")
    code = F.when(v == 0, 1).when(v < d, 2).when(v == d, 3).when(v > d, 4)
    return _drivers(hh, per, "left").withColumn("vehsuf", code)


def person_attributes(hh: DataFrame, per: DataFrame, zones: DataFrame) -> DataFrame:
    """Persons with type, weight and their household's district, income band and sufficiency."""
    full = act_vehicle_sufficiency(hh, per).withColumn("inccat", fn.fn_find_interval("hhincome", (0, *INCOME_CUTS)))
    full = _district(full, zones, "hhtaz", "hhdistrict").select("hhno", "hhdistrict", "inccat", "vehsuf")
    return per.select("hhno", "pno", "pptyp", "psexpfac").join(full, "hhno", "left")


def _place(kind: str, have: Sequence[str]) -> dict[str, Column]:
    """Flags, type and bands of the usual work or school place; times only if the persons have them."""
    p = "pw" if kind == "work" else "ps"
    taz, at_home = F.col(f"{p}taz"), F.col("hhparcel") == F.col(f"{p}pcl")
    active = ((F.col("pwtyp") > 0) if kind == "work" else F.col("pptyp").between(5, 7)) & (taz != 0)
    out = {
        "active": F.when(active, 1).otherwise(0),
        "out_of_home": F.when((taz > 0) & (F.col("hhparcel") != F.col(f"{p}pcl")), 1).otherwise(0),
        "place_type": project_case_map("pptyp", WORKER_TYPE if kind == "work" else STUDENT_TYPE),
        "at_home": F.when(active & at_home, 1).otherwise(0),
    }
    for name, col in (("dist", f"{p}audist"), ("time", f"{p}autime")):
        if col in have:
            out |= {f"{name}cat": F.when(taz < 0, OUTSIDE_BAND).otherwise(_band(col, 89)), name: project_missing_sentinel(col)}
    return out


def _place_district(df: DataFrame, zones: DataFrame, taz: str, out: str) -> DataFrame:
    df = _district(df, zones, taz, out)
    return df.withColumn(out, F.when(F.col(taz) < 0, OUTSIDE_DISTRICT).otherwise(F.col(out)))


def act_work_school_location(per: DataFrame, hh: DataFrame, zones: DataFrame, kind: str = "work") -> DataFrame:
    """Work (or school) place flags, distance and time bands and home-to-place district pair."""
    full = per.join(hh, "hhno", "left").withColumns(_place(kind, per.columns))
    return _place_district(_district(full, zones, "hhtaz", "hhdistrict"), zones, "pwtaz" if kind == "work" else "pstaz", "place_district")


def act_location_persons(per: DataFrame, hh: DataFrame, zones: DataFrame) -> DataFrame:
    """Persons with the place columns of work (``wrk_``) and school (``sch_``) side by side, households joined once."""
    full = _district(per.join(hh, "hhno", "left"), zones, "hhtaz", "hhdistrict")
    for kind, tag, taz in (("work", "wrk", "pwtaz"), ("school", "sch", "pstaz")):
        full = full.withColumns({f"{tag}_{n}": c for n, c in _place(kind, per.columns).items()})
        full = _place_district(full, zones, taz, f"{tag}_district")
    return full


def location_templates(kind: str, sides: Sequence[str], districts: int, first: int = 1, smooth: bool = False) -> list[Template]:
    """Tables of usual work or school places for each side of the data, numbered from ``first``.

    Distance and time bands by type, mean distance and time by type, district flows, and the active and
    those at home by district and type. ``smooth`` evens the bands out.
    """
    tag = "wrk" if kind == "work" else "sch"
    types, weight, active = (1, 3), "psexpfac", (f"{tag}_active", "==", 1)
    out = []

    def add(x: str, x_range: tuple[int, int], y: str, y_range: tuple[int, int], subset: tuple = active, **more) -> None:
        numbers = range(first + len(out), first + len(out) + len(sides))
        out.extend(Template(n, x, x_range, y, y_range, weight, subset, data=side, **more) for n, side in zip(numbers, sides))

    for m in ("dist", "time"):
        add(f"{tag}_{m}cat", (1, OUTSIDE_BAND), f"{tag}_place_type", types, smooth=smooth)
    for m in ("dist", "time"):
        add(f"{tag}_{m}", (0, 0), f"{tag}_place_type", types, fun="mean")
    add("hhdistrict", (1, districts), f"{tag}_district", (1, OUTSIDE_DISTRICT))
    add("hhdistrict", (1, districts), f"{tag}_place_type", types)
    add("hhdistrict", (1, districts), f"{tag}_place_type", types, (f"{tag}_at_home", "==", 1))
    return out


def act_day_pattern_pday(pday: DataFrame, persons: DataFrame, capped: str = "band") -> DataFrame:
    """Person days coded by tours and stops.

    ``<purpose>topt`` counts tours as 1-4 (``band``) or 0-3 (``cap``), the two conventions in use.
    """
    full = pday.join(persons, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    have = set(pday.columns)

    def count(purpose: str, what: str) -> Column:
        names = [purpose, *[k for k, v in FOLDED.items() if v == purpose]]
        return sum((F.col(f"{n}{what}") for n in names if f"{n}{what}" in have), F.lit(0))

    for p in PURPOSES:
        full = full.withColumns({f"n_{p}tours": count(p, "tours"), f"n_{p}stops": count(p, "stops")})
    tours = F.least(sum((F.col(f"n_{p}tours") for p in PURPOSES), F.lit(0)), F.lit(3))
    stops = sum((F.col(f"n_{p}stops") for p in PURPOSES), F.lit(0))
    full = full.withColumns({"tottours": tours, "totstops": stops})
    several = 1 + 4 * (F.col("tottours") - 1) + F.least("totstops", F.lit(3))
    coded = {"tourstop": F.when(F.col("tottours") > 0, several).when(F.col("totstops") == 0, 0)}
    for p in PURPOSES:
        t, s = F.col(f"n_{p}tours"), F.col(f"n_{p}stops")
        coded[f"{p}tostp"] = 1 + 2 * (t >= 1).cast("int") + (s >= 1).cast("int")
        coded[f"{p}topt"] = F.least(t, F.lit(3)) + (1 if capped == "band" else 0)
    return full.withColumns(coded)


def act_day_pattern_tour(tours: DataFrame, persons: DataFrame) -> DataFrame:
    """Tours with stop counts on each half, subtour count and the full-time indicator."""
    full = tours.join(persons, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    merged = full.withColumn("pdpurp", project_purpose_merge("pdpurp", TOUR_PURPOSE_MERGE))

    def stopcat(n: Column) -> Column:
        return F.least(F.greatest(n, F.lit(0)), F.lit(6))

    h1, h2 = F.col("tripsh1"), F.col("tripsh2")
    coded = {
        "ftwind": F.when(F.col("pptyp") == 1, 1).otherwise(2),
        "stops": h1 + h2 - 2,
        "stopscat": stopcat(h1 + h2 - 2),
        "h1stopscat": stopcat(h1 - 1),
        "h2stopscat": stopcat(h2 - 1),
        "pdpurp2": F.when(F.col("parent") == 0, F.col("pdpurp")).otherwise(8),
    }
    if "subtrs" in tours.columns:
        coded["stcat"] = _band("subtrs", 3)
    return merged.withColumns(coded)


def act_day_pattern_trip(trips: DataFrame, persons: DataFrame, zones: DataFrame) -> DataFrame:
    full = trips.join(persons, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    merged = full.withColumn("dpurp", project_case_map("dpurp", TRIP_PURPOSE_MERGE, F.col("dpurp")))
    return _district(merged, zones, "otaz", "odistrict")


def act_stops_by_purpose(pday: DataFrame, columns: Sequence[str], by: str, weight: str | Column) -> DataFrame:
    """Stops per purpose column against an attribute; the zero-stop line is left out."""
    w = F.col(weight) if isinstance(weight, str) else weight
    long = pday.withColumn("__w", w).select(by, "__w", *columns).unpivot([by, "__w"], list(columns), "purpose", "stops")
    return long.filter(F.col("stops") > 0).groupBy("purpose", "stops", by).agg(F.sum("__w").alias("value"))


def act_tour_mode(tours: DataFrame, hh: DataFrame, per: DataFrame) -> DataFrame:
    """Tours with mode code, household vehicle flag and the mode of the parent work tour."""
    veh = hh.select("hhno", (F.col("hhvehs") > 0).cast("int").alias("vehcat"))
    people = per.select("hhno", "pno", "pptyp", "psexpfac").join(veh, "hhno", "left")
    full = tours.join(people, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    full = full.withColumns(
        {"tourmode": project_case_map("tmodetp", TOUR_MODE, 0), "pdpurp": project_purpose_merge("pdpurp", TOUR_PURPOSE_MERGE)}
    ).withColumn("pdpurp2", F.when(F.col("parent") == 0, F.col("pdpurp")).otherwise(8))
    work = full.filter("pdpurp = 1").select("hhno", "pno", F.col("tour").alias("parent"), F.col("tourmode").alias("parentmode"))
    based = full.filter("parent > 0").join(work, ["hhno", "pno", "parent"], "left")
    return full.filter("parent = 0").withColumn("parentmode", F.lit(0)).unionByName(based)


def act_trip_mode(trips: DataFrame, tours: DataFrame, per: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trips with trip mode, tour mode and tour purpose; transit is split by path type."""
    people = per.select("hhno", "pno", "pptyp", "psexpfac")
    t = tours.join(people, ["hhno", "pno"], "left").select(
        *keys,
        project_case_map("tmodetp", TOUR_MODE, 0).alias("tourmode"),
        F.when(F.col("parent") == 0, F.col("pdpurp")).otherwise(8).alias("pdpurp2"),
        "pptyp",
        "psexpfac",
    )
    mode = project_overwrite_recodes(
        [(F.col("tmode") == TRANSIT, project_case_map("pathtype", TRANSIT_PATH_MODE, 0)), *[(F.col("tmode") == k, v) for k, v in TRIP_MODE.items()]], 0
    )
    joined = trips.withColumn("tripmode", mode).join(t, list(keys), "left")
    return joined.filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))


def _destination(df: DataFrame, persons: DataFrame, zones: DataFrame, o: str, d: str, dist: str) -> DataFrame:
    full = df.join(persons, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    full = _district(_district(full, zones, o, "odistrict"), zones, d, "ddistrict")
    return full.withColumns(
        {"distcat": _band(dist, 90), "wrkrtyp": project_case_map("pptyp", WORKER_TYPE), "known_dist": project_missing_sentinel(dist)}
    )


def act_tour_destination(tours: DataFrame, persons: DataFrame, zones: DataFrame, skim: DataFrame | None = None) -> DataFrame:
    """Tours with district pair and length band.

    With a skim (period, o, d, imp) the length is the sum of both halves' impedances,
    which replaces the tour's own length only if that is 0 over the whole table.
    """
    merged = tours.withColumn("pdpurp", project_purpose_merge("pdpurp", TOUR_PURPOSE_MERGE))
    merged = merged.withColumn("pdpurp2", F.when(F.col("parent") == 0, F.col("pdpurp")).otherwise(8))
    if skim is not None:
        blank = tours.agg(F.coalesce(F.sum("tautodist"), F.lit(0)) == 0).scalar()
        per_half = {}
        for half, clock in (("h1", "tardest"), ("h2", "tlvdest")):
            k = fn.fn_find_interval(clock, SKIM_PERIOD_CUTS)
            merged = merged.withColumn(f"{half}p", F.when(k == 0, len(SKIM_PERIOD_CUTS)).otherwise(k))
            side = skim.groupBy(F.col("period").alias(f"{half}p"), F.col("o").alias("totaz"), F.col("d").alias("tdtaz"))
            merged = merged.join(side.agg(F.min("imp").alias(f"{half}d")), [f"{half}p", "totaz", "tdtaz"], "left")
            per_half[half] = F.col(f"{half}d")
        merged = merged.withColumn("tautodist", F.when(blank, per_half["h1"] + per_half["h2"]).otherwise(F.col("tautodist")))
    return _destination(merged, persons, zones, "totaz", "tdtaz", "tautodist")


def act_trip_destination(trips: DataFrame, persons: DataFrame, zones: DataFrame) -> DataFrame:
    return _destination(trips, persons, zones, "otaz", "dtaz", "travdist")


def act_tour_tod(tours: DataFrame, persons: DataFrame) -> DataFrame:
    """Half-hour bands of arrival, departure and stay; purposes 8 and 9 have no class."""
    full = tours.join(persons, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    full = full.withColumn("pdpurp2", F.when(F.col("parent") > 0, 4).otherwise(project_case_map("pdpurp", TOUR_TOD_PURPOSE)))
    minutes = tours.agg(F.max(F.col("tlvdest") % 100) > 60).scalar()
    full = full.withColumns({"deptime": _hours("tlvdest", minutes), "arrtime": _hours("tardest", minutes)})
    return full.withColumns(
        {
            "arrtimecat": fn.fn_find_interval("arrtime", HALF_HOURS),
            "deptimecat": fn.fn_find_interval("deptime", HALF_HOURS),
            "durdestcat": fn.fn_find_interval(F.col("deptime") - F.col("arrtime"), TOUR_DURATIONS),
        }
    )


def _hours(col: str, minutes: Column) -> Column:
    c = F.col(col)
    return F.when(minutes, c / 60.0).otherwise(F.floor(c / 100.0) + (c % 100) / 60.0)


def act_trip_tod(trips: DataFrame, persons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Half-hour bands of trips with flags for the stops that are not tour ends.

    ``keys`` name a tour of one person, so a tour half is kept or dropped as a whole.
    """
    ranked = group_totals(trips, [*keys, "half"], [F.max("tseg").alias("maxtseg")])
    full = ranked.join(persons, ["hhno", "pno"], "left").filter(F.coalesce(F.col("pptyp") < 8, F.lit(False)))
    minutes = trips.agg(F.max(F.col("deptm") % 100) > 60).scalar()
    full = full.withColumn("in_minutes", minutes)
    full = full.withColumns({f"{c}_hours": _hours(c, F.col("in_minutes")) for c in ("deptm", "arrtm", "endacttm")}).drop("in_minutes")
    gap = F.col("endacttm_hours") - F.col("arrtm_hours")
    full = full.withColumn("stay_hours", F.round(F.when(gap < 0, gap + 24).otherwise(gap), 9))
    half, seg, last = F.col("half"), F.col("tseg"), F.col("maxtseg")
    return full.withColumns(
        {
            "arrtimecat": fn.fn_find_interval("arrtm_hours", HALF_HOURS),
            "deptimecat": fn.fn_find_interval("deptm_hours", HALF_HOURS),
            "durdestcat": fn.fn_find_interval("stay_hours", TRIP_DURATIONS),
            "arrflag": ((half == 1) & (seg != last)).cast("int"),
            "depflag": ((half == 2) & (seg != 1)).cast("int"),
            "durflag": (seg < last).cast("int"),
        }
    )
