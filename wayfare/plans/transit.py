"""Transit operators: stop, segment, route and system measures, counts, schedules, skims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import first_match, project_case_map
from ..functions.scalar import fn_tod_inclusive
from ..operators.aggregates import agg_pivot, agg_two_level
from ..operators.windows import running

DAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")

# Departure windows in seconds, both ends included.
DEPARTURE_WINDOWS = {"AM": (6 * 3600, 9 * 3600 - 1), "MD": (9 * 3600, 15 * 3600 - 1), "PM": (15 * 3600, 18 * 3600 - 1)}

# Default speeds and codes of transit and walk links.
DEFAULT_SPEED, DEFAULT_TRANSIT_SPEED = 25, 15
CONNECTOR_CLASS, LONG_CONNECTOR = 98, 0.5
NO_WALK_LINK, NO_WALK_TIME, WALK_LINK = 250, 99999, 98
NO_TIME = 0.001


def trn_dwell_time(stops: DataFrame, modes: dict[int, float], periods: Sequence[str]) -> DataFrame:
    """Dwell time per period with service: distance since the last stop times the mode factor.

    ``stops`` has mode, last_distance, layover and ``<period>_headway``; ``modes`` the factor by mode.
    """
    joined = stops.withColumns({"factor": project_case_map("mode", modes), "layover": F.coalesce("layover", F.lit(0))})
    dwell = {f"{p}_dwell": F.when(F.col(f"{p}_headway") > 0, F.col("last_distance") * F.col("factor")) for p in periods}
    return joined.withColumns(dwell)


def trn_segment_load(segments: DataFrame) -> DataFrame:
    """Passenger hours and miles, run time and length per route and period.

    ``segments`` is (route, period, ivtt, flow, from_mp, to_mp), time in minutes.
    """
    flow = F.col("flow")
    return segments.groupBy("route", "period").agg(
        F.sum(F.col("ivtt") / 60 * flow).alias("pass_hours"),
        F.sum((F.col("to_mp") - F.col("from_mp")) * flow).alias("pass_miles"),
        F.sum("ivtt").alias("run_time"),
        (F.max("to_mp") - F.min("from_mp")).alias("route_miles"),
    )


def trn_route_boardings(onoff: DataFrame, period_values: Sequence[str]) -> DataFrame:
    """Boardings and alightings per route and mode, by period and in total."""
    on = [F.sum(F.when(F.col("period") == p, F.col("ons")).otherwise(0)).alias(f"on_{p}") for p in period_values]
    off = [F.sum(F.when(F.col("period") == p, F.col("offs")).otherwise(0)).alias(f"off_{p}") for p in period_values]
    return onoff.groupBy("route", "mode").agg(*on, *off, F.sum("ons").alias("on_total"), F.sum("offs").alias("off_total"))


def trn_system_stats(trips: DataFrame, onoff: DataFrame) -> DataFrame:
    """Trips, boardings, transfers and transfer rate in per cent by period, with a total line.

    ``trips`` is (period, trips), ``onoff`` (period, ons).
    """
    t = trips.groupBy("period").agg(F.sum("trips").alias("trips"), F.lit(0).cast("bigint").alias("boardings"))
    b = onoff.groupBy("period").agg(F.lit(0).cast("double").alias("trips"), F.sum("ons").alias("boardings"))
    both = t.withColumn("trips", F.col("trips").cast("double")).unionByName(b)
    rolled = both.rollup("period").agg(F.sum("trips").alias("trips"), F.sum("boardings").alias("boardings"), F.grouping("period").alias("g"))
    return rolled.select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("period")).alias("period"),
        "trips",
        "boardings",
        (F.col("boardings") - F.col("trips")).alias("transfers"),
        ((F.try_divide("boardings", "trips") - 1) * 100).alias("rate"),
    )


def trn_stop_profile(stops: DataFrame, segments: DataFrame) -> DataFrame:
    """Ons, offs and load along each route and period, with the run time from the stop.

    ``stops`` is (route, period, stop, milepost, ons, offs), ``segments`` (route, period, stop, ivtt).
    """
    net = F.coalesce(F.col("ons"), F.lit(0)) - F.coalesce(F.col("offs"), F.lit(0))
    loaded = running(stops, ["route", "period"], ["milepost"], {"load": net})
    times = segments.groupBy("route", "period", "stop").agg(F.sum("ivtt").alias("run_time"))
    return loaded.join(times, ["route", "period", "stop"], "left").na.fill(0, ["run_time"])


def trn_apc_route_tod(apc: DataFrame, weekdays: Sequence[int] = (3, 4, 5)) -> DataFrame:
    """Mean weekday boardings per route by clock window; days without counts do not weigh in."""
    days = apc.filter(F.dayofweek("survey_date").isin(*weekdays)).withColumn("tod", fn_tod_inclusive("start_sec"))
    means = agg_two_level(days, ["route", "tod"], ["survey_date"], "passengers_on", "boardings")
    return agg_pivot(means, ["route"], "tod", "boardings", ["AM", "OP", "PM"])


def trn_gtfs_service_trips(feed: dict[str, DataFrame], date: str) -> DataFrame:
    """Route shapes in service on a date (yyyymmdd) by departure window.

    Services run by weekday within their dates, plus added and less removed exceptions; a
    trip belongs to the window of its first departure.
    """
    on = F.to_date(F.lit(date), "yyyyMMdd")
    weekday = first_match([(F.dayofweek(on) == i + 1, F.col(d)) for i, d in enumerate(DAYS)])
    regular = feed["calendar"].filter((weekday == 1) & (F.col("start_date") <= date) & (F.col("end_date") >= date)).select("service_id")
    extra = feed["calendar_dates"].filter(F.col("date") == date)
    added = extra.filter("exception_type = 1").select("service_id")
    removed = extra.filter("exception_type = 2").select("service_id")
    services = regular.unionByName(added).distinct().join(removed, "service_id", "left_anti")
    trips = feed["trips"].join(services, "service_id", "left_semi")
    clock = F.split("departure_time", ":")
    seconds = clock.getItem(0).cast("int") * 3600 + clock.getItem(1).cast("int") * 60 + clock.getItem(2).cast("int")
    first = feed["stop_times"].filter(F.col("departure_time").isNotNull()).groupBy("trip_id").agg(F.min(seconds).alias("departure"))
    window = first_match([(F.col("departure").between(a, b), name) for name, (a, b) in DEPARTURE_WINDOWS.items()])
    timed = trips.join(first, "trip_id").withColumn("tod", window).filter(F.col("tod").isNotNull())
    return timed.groupBy("tod", "route_id", "direction_id", "shape_id").agg(F.count("*").alias("n_trips"))


def trn_skim_clean(skim: DataFrame, cores: Sequence[str], mode_time: str, fare: str) -> DataFrame:
    """Nulls to 0, every core to 0 where the defining mode is not used, fare in cents."""
    used = F.coalesce(F.col(mode_time), F.lit(0)) > 0
    cols = {c: F.when(used, F.coalesce(F.col(c).cast("double"), F.lit(0.0))).otherwise(0.0) for c in cores}
    cols[fare] = cols[fare] * 100
    return skim.withColumns(cols)


def trn_link_times(links: DataFrame, walk_speed: float, factors: dict[int, float], only_speed: float) -> DataFrame:
    """Base, walk and transit time per directed link.

    Freeways and ramps have their own time factor (2); transit-only links (3) run at their
    default speed. Needs length, afftime, fc, ramp, in_walk, in_transit.
    """
    miles, time = F.col("length"), F.col("afftime")
    missing = time.isNull() | (time < NO_TIME)
    base = F.when(missing, miles * 60 / DEFAULT_SPEED).otherwise(time)
    connector = F.col("fc") == CONNECTOR_CLASS
    walkable = (F.col("in_walk") == 1) | connector
    walk = F.when(connector & (miles > LONG_CONNECTOR), LONG_CONNECTOR * 60 / walk_speed).when(walkable, miles * 60 / walk_speed).otherwise(float(NO_WALK_TIME))
    kind = F.when(F.col("in_transit") == 1, 3).when((F.col("fc") <= 2) | (F.col("ramp") == 1), 2).otherwise(1)
    df = links.withColumns({"base_time": base, "walk_link": F.when(walkable, WALK_LINK).otherwise(NO_WALK_LINK), "walk_time": walk, "ttf": kind})
    slow = F.when(F.col("base_time") < NO_TIME, miles * 60 / DEFAULT_TRANSIT_SPEED).otherwise(
        F.col("base_time") * first_match([(F.col("ttf") == k, float(f)) for k, f in factors.items()])
    )
    return df.withColumn("transit_time", F.when(F.col("ttf") == 3, miles * 60 / only_speed).otherwise(slow))


def rep_active_travel(trips: DataFrame, persons: DataFrame, ages: tuple[int, int] = (20, 74), minutes: str = "travtime") -> DataFrame:
    """Trips per mode, and mean travel time per mode of persons in the age range."""
    people = persons.select("hhno", "pno", "pagey")
    joined = trips.join(people, ["hhno", "pno"], "left")
    within: Column = F.coalesce(F.col("pagey").between(*ages), F.lit(False))
    return joined.groupBy("tmode").agg(F.count("*").alias("trips"), F.avg(F.when(within, F.col(minutes))).alias("mean_time"))
