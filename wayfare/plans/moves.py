"""Inputs of the emission model and network reports from link-hour and matrix frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import filter_query_list, project_case_map
from ..functions.scalar import fn_speed_bin

# Truck miles inside the county, internal and cordon-crossing trips.
TRUCK_SHARE = {"II": 1.0, "EI": 0.5, "IE": 0.5}

# Source types by model class, and default road type shares (types 1 to 5) of the others.
MODELLED_SOURCES = {"car": (11, 21, 31), "mu": (61, 62)}
DEFAULT_ROAD_TYPES = {
    32: (0.00000, 0.00000, 0.03681, 0.35895, 0.60424),
    41: (0.00000, 0.00000, 0.02689, 0.75679, 0.21632),
    42: (0.00000, 0.00000, 0.02689, 0.75679, 0.21632),
    43: (0.00000, 0.00000, 0.02689, 0.75679, 0.21632),
    51: (0.00000, 0.00000, 0.03951, 0.48170, 0.47878),
    52: (0.00000, 0.00000, 0.03951, 0.48170, 0.47878),
    53: (0.00000, 0.00000, 0.03951, 0.48170, 0.47878),
    54: (0.00000, 0.00000, 0.03951, 0.48170, 0.47878),
}
ROAD_TYPES = (2, 3, 4, 5)

# Base-year vehicles by source type, and what they grow with.
BASE_POPULATION = {
    11: 8795, 21: 119783, 31: 101718, 32: 18104, 41: 4, 42: 89, 43: 306, 51: 121, 52: 5532, 53: 185, 54: 1164, 61: 1867, 62: 2022,
}
GROWS_WITH = {
    11: "vehicles", 21: "vehicles", 31: "vehicles", 32: "commercial", 41: "people", 42: "people", 43: "people",
    51: "su", 52: "su", 53: "su", 54: "su", 61: "mu", 62: "mu",
}
BASE_TOTALS = {"vehicles": 278689, "commercial": 17166.42, "su": 32758.49, "mu": 1741.19}

# Reported yearly miles by vehicle type, base-year model miles, local roads and days per year.
REPORTED_VMT = {10: 20468573, 25: 3379781269, 40: 2845725, 50: 73157979, 60: 247042469}
BASE_VMT = {"su": 340106, "mu": 687994}
LOCAL_SCALE, DAYS_PER_YEAR = 1.50, 342
SYSTEM_RAMP_SPEED = 50


def _spec(df: DataFrame, rows: Sequence[tuple], ddl: str) -> DataFrame:
    return df.sparkSession.createDataFrame(list(rows), ddl)


def mov_county_vmt(od: DataFrame, skim: DataFrame, external: Callable[[Column], Column]) -> DataFrame:
    """County miles by class: car trips in full, trucks by the share of their movement.

    ``od`` is (o, d, core, trips) with cores car, su, mu; ``skim`` (o, d, miles);
    ``external`` tells whether a zone lies outside.
    """
    side = F.concat(*[F.when(external(F.col(z)), "E").otherwise("I") for z in ("o", "d")])
    share = F.when(F.col("core") == "car", 1.0).otherwise(project_case_map(side, TRUCK_SHARE, 0.0))
    joined = od.join(skim.select("o", "d", "miles"), ["o", "d"])
    return joined.groupBy("core").agg(F.sum(F.col("trips") * F.col("miles") * share).alias("vmt"))


def mov_road_type_dist(links: DataFrame) -> DataFrame:
    """Share of miles by road type per source type; unmodelled types keep their defaults.

    ``links`` is (cls, road_type, vmt).
    """
    sums = links.filter(F.col("road_type").isin(*ROAD_TYPES)).groupBy("cls", "road_type").agg(F.sum("vmt").alias("vmt"))
    whole = sums.groupBy("cls").agg(F.sum("vmt").alias("all"))
    shares = sums.join(whole, "cls").select("cls", "road_type", F.coalesce(F.try_divide("vmt", "all"), F.lit(0.0)).alias("share"))
    modelled = [(s, r, c) for c, ss in MODELLED_SOURCES.items() for s in ss for r in (1, *ROAD_TYPES)]
    grid = _spec(links, modelled, "source int, road_type int, cls string")
    ours = grid.join(shares, ["cls", "road_type"], "left").select("source", "road_type", F.coalesce("share", F.lit(0.0)).alias("share"))
    fixed = _spec(links, [(s, i + 1, v) for s, vs in DEFAULT_ROAD_TYPES.items() for i, v in enumerate(vs)], "source int, road_type int, share double")
    return ours.unionByName(fixed)


def mov_source_population(households: DataFrame, totals: DataFrame, people_growth: float, base: dict[str, float] | None = None) -> DataFrame:
    """Vehicles by source type: base year times the growth that drives the type.

    ``households`` has hhvehs; ``totals`` is (core, trips) for commercial, su and mu.
    """
    b = {**BASE_TOTALS, **(base or {})}
    cars = households.agg(F.lit("vehicles").alias("driver"), F.sum("hhvehs").cast("double").alias("now"))
    trips = totals.groupBy(F.col("core").alias("driver")).agg(F.sum("trips").cast("double").alias("now"))
    growth = cars.unionByName(trips).withColumn("growth", F.col("now") / project_case_map("driver", b)).select("driver", "growth")
    growth = growth.unionByName(_spec(households, [("people", float(people_growth))], "driver string, growth double"))
    rows = _spec(households, [(s, GROWS_WITH[s], float(v)) for s, v in BASE_POPULATION.items()], "source int, driver string, base double")
    return rows.join(growth, "driver", "left").select("source", F.round(F.col("base") * F.col("growth")).cast("bigint").alias("population"))


def mov_hour_vmt_fraction(trips: DataFrame, skim: DataFrame, default: DataFrame) -> DataFrame:
    """Hourly share of miles per road type, averaged with the default profile.

    ``trips`` is (o, d, hour, trips), ``skim`` (o, d, road_type, miles), ``default``
    (road_type, hour, share). Trips are folded to zone pairs before the join.
    """
    cells = trips.groupBy("o", "d", "hour").agg(F.sum("trips").alias("trips"))
    hourly = cells.join(skim, ["o", "d"]).groupBy("road_type", "hour").agg(F.sum(F.col("trips") * F.col("miles")).alias("vmt"))
    whole = hourly.groupBy("road_type").agg(F.sum("vmt").alias("all"))
    got = hourly.join(whole, "road_type").select("road_type", "hour", F.try_divide("vmt", "all").alias("mine"))
    joined = default.join(got, ["road_type", "hour"], "left")
    return joined.select("road_type", "hour", ((F.col("share") + F.coalesce("mine", F.lit(0.0))) / 2).alias("fraction"))


def mov_speed_distribution(hourly: DataFrame) -> DataFrame:
    """Share of hours in each of 16 speed bins by class, road type and hour; ramps left out.

    ``hourly`` is (cls, road_type, ramp, hour, speed, vht). All combinations are returned.
    """
    kept = hourly.filter(F.col("ramp") == 0).withColumn("bin", fn_speed_bin("speed").cast("int"))
    cells = kept.groupBy("cls", "road_type", "hour", "bin").agg(F.sum("vht").alias("vht"))
    whole = cells.groupBy("cls", "road_type", "hour").agg(F.sum("vht").alias("all"))
    shares = cells.join(whole, ["cls", "road_type", "hour"])
    shares = shares.select("cls", "road_type", "hour", "bin", (F.col("vht") / F.greatest(F.col("all"), F.lit(1.0))).alias("share"))
    n = 3 * len(ROAD_TYPES) * 24 * 16
    k = F.col("id")
    classes, types = F.array(*[F.lit(c) for c in ("car", "su", "mu")]), F.array(*[F.lit(r) for r in ROAD_TYPES])
    per_type, per_class = 24 * 16, len(ROAD_TYPES) * 24 * 16
    grid = hourly.sparkSession.range(n).select(
        F.element_at(classes, (F.floor(k / per_class) + 1).cast("int")).alias("cls"),
        F.element_at(types, (F.floor(k % per_class / per_type) + 1).cast("int")).alias("road_type"),
        (F.floor(k % per_type / 16) + 1).cast("int").alias("hour"),
        (k % 16 + 1).cast("int").alias("bin"),
    )
    return grid.join(shares, ["cls", "road_type", "hour", "bin"], "left").na.fill(0.0, ["share"])


def mov_ramp_fraction(links: DataFrame) -> DataFrame:
    """Ramp share of restricted-access miles per road type (2 rural, 4 urban).

    Fast ramps between freeways count as freeway. ``links`` is (road_type, ramp, speed_limit, vmt).
    """
    ramp = (F.col("ramp") == 1) & (F.col("speed_limit") <= SYSTEM_RAMP_SPEED)
    kept = links.filter(F.col("road_type").isin(2, 4))
    return kept.groupBy("road_type").agg(F.coalesce(F.try_divide(F.sum(F.when(ramp, F.col("vmt")).otherwise(0.0)), F.sum("vmt")), F.lit(0.0)).alias("fraction"))


def mov_hpms_vmt(links: DataFrame, people_growth: float) -> DataFrame:
    """Yearly miles by vehicle type from daily class miles on freeways and other roads.

    ``links`` is (cls, fc, vmt). Cars are scaled up for local roads and split between
    motorcycles and light vehicles as reported; the others grow from the reported miles.
    """
    freeway = F.col("fc").isin(1, 2)
    sums = links.groupBy("cls").agg(
        F.round(F.sum(F.when(freeway, F.col("vmt")).otherwise(0.0)), 1).alias("fwy"), F.round(F.sum(F.when(freeway, 0.0).otherwise(F.col("vmt"))), 1).alias("oth")
    )
    car = (F.col("fwy") + F.col("oth") * LOCAL_SCALE) * DAYS_PER_YEAR
    truck = F.col("fwy") + F.col("oth")
    light = REPORTED_VMT[10] + REPORTED_VMT[25]
    per_type = F.when(
        F.col("cls") == "car",
        F.array(*[F.struct(F.lit(t).alias("hpms"), (car * round(REPORTED_VMT[t] / light, 5)).alias("vmt")) for t in (10, 25)]),
    )
    for cls, t in (("su", 50), ("mu", 60)):
        per_type = per_type.when(F.col("cls") == cls, F.array(F.struct(F.lit(t).alias("hpms"), (REPORTED_VMT[t] * truck / BASE_VMT[cls]).alias("vmt"))))
    ours = sums.select(F.explode(per_type).alias("t")).select("t.hpms", F.round("t.vmt", 1).alias("vmt"))
    buses = _spec(links, [(40, round(REPORTED_VMT[40] * people_growth, 1))], "hpms int, vmt double")
    return ours.unionByName(buses)


def rep_network_summary(links: DataFrame, predicates: Sequence[tuple[str, str, Column]], measures: Sequence[str], vc: str = "vc") -> DataFrame:
    """Totals of all measures per stored predicate with speeds and miles-weighted ratios, one pass.

    Needs length, lanes, vmt and vht among the columns; classes are further measures.
    """
    aggs = {m: F.sum(m) for m in measures}
    aggs |= {
        "links": F.count("*"),
        "miles": F.sum("length"),
        "lane_miles": F.sum(F.col("length") * F.col("lanes")),
        "vmt": F.sum("vmt"),
        "vht": F.sum("vht"),
        "__vc": F.sum(F.col("vmt") * F.col(vc)),
        "max_vc": F.max(vc),
    }
    out = filter_query_list(links, predicates, aggs).na.fill(0)
    return out.withColumns(
        {"speed": F.coalesce(F.try_divide("vmt", "vht"), F.lit(0.0)), "wtd_vc": F.coalesce(F.try_divide("__vc", "vmt"), F.lit(0.0))}
    ).drop("__vc")
