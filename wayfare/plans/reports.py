"""The report of a network run: every measure of the links each stored condition selects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import highway as hwy

POLLUTANTS = ("co", "co2", "nox", "pm10", "pm25", "sox", "voc")
CRASHES = ("fatal", "injury", "pdo")
# Functional classes that are reported, both ends left out.
REPORTED_FC = (0, 95)
PARTS = ("car", "su", "mu")
SUMMED = ("vmt", "vht", "delay")

Item = tuple[str, str, Column | None]


def report_columns() -> list[str]:
    """The measures in the order of the report."""
    by_class = [f"{m}_{c}" for m in (*SUMMED, "fuel", "non_fuel") for c in hwy.ALL_CLASSES]
    emitted = [f"{p}_{k}_{c}" for c in hwy.ALL_CLASSES for p in POLLUTANTS for k in ("running", "start")]
    return ["links", "vc", "miles", "vmt", "vht", *by_class, *CRASHES, "crashes", *emitted]


def by_condition_set(hourly: DataFrame, items: Sequence[Item]) -> DataFrame:
    """Sums by set of conditions met (``hits``) and speed row, and one row a set about its links.

    A row of the source counts for its link and for its speed. Both come from one read: grouping
    sets add up by link (largest ratio, attributes once) and by speed (class miles, volumes) before anything is
    exchanged, so what moves is two rows a directed link and 76 speeds a set. Rows of the result with a null ``speed_row`` hold the
    measures of links. There are at most as many sets as links, and as many as the conditions cut the
    network into.
    """
    low, high = REPORTED_FC
    tests = [F.when(p, F.lit(i)) for i, (_, _, p) in enumerate(items) if p is not None]
    hits = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<int>")
    tagged = hourly.filter((F.col("fc") > low) & (F.col("fc") < high)).withColumn("hits", hits).filter(F.size("hits") > 0)
    for c in PARTS:
        tagged = tagged.withColumns({f"vht_{c}": F.col(f"vol_{c}") * F.col("time") / 60, f"delay_{c}": F.col("lost") * F.col(f"vol_{c}") / 60})
    sums = [f"{m}_{c}" for m in (*SUMMED, "vol") for c in PARTS]
    once = ["vc", "length", *CRASHES]
    first = tagged.groupingSets([["hits", "id"], ["hits", "speed_row"]], "hits", "id", "speed_row").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in once], (F.grouping("speed_row") == 1).alias("of_link")
    )
    of_link = F.col("of_link")
    miles = sum((F.coalesce(F.col(f"vmt_{c}"), F.lit(0.0)) for c in PARTS), F.lit(0.0))
    return first.groupBy("hits", "speed_row").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count_if(of_link).alias("links"),
        F.sum(F.when(of_link, F.col("length"))).alias("miles"),
        F.sum(F.when(of_link, F.coalesce("vc", F.lit(0.0)) * miles)).alias("vc_miles"),
        *[F.sum(F.when(of_link, F.col(c))).alias(c) for c in CRASHES],
    )


def rep_network_report(
    hourly: DataFrame, items: Sequence[Item], rates: DataFrame, costs: dict, non_fuel: dict[str, float]
) -> DataFrame:
    """One row an item with all measures of :func:`report_columns`, in the order of ``items``.

    ``hourly`` is the result of :func:`highway.hwy_hourly_profile` with the yearly ``fatal``, ``injury`` and
    ``pdo`` crashes of each link beside it; ``items`` are (kind, item, condition), the conditions on
    attributes both directions share. An item without a condition is a separator with null
    measures; one that selects nothing has zeros. Links outside the reported functional classes
    count nowhere. A link counts once, with the largest ratio of its directions and hours; ``vc`` is
    that ratio weighted by the miles driven. Trucks are the sum of both truck classes, but burn and emit at
    rates of their own (see :func:`highway.hwy_fuel_emissions`).
    """
    sets = cut_lineage(by_condition_set(hourly, items))  # as small as the sets; read three times below
    each = sets.withColumn("pos", F.explode("hits"))
    links, speeds = each.filter("speed_row IS NULL"), each.filter("speed_row IS NOT NULL")

    def total(m: str, of: Sequence[str]) -> Column:
        return sum((F.coalesce(F.sum(f"{m}_{p}"), F.lit(0.0)) for p in of), F.lit(0.0))

    sums = {f"{m}_{c}": total(m, of) for m in SUMMED for c, of in hwy.ALL_CLASSES.items()}
    sums |= {"vmt": total("vmt", PARTS), "vht": total("vht", PARTS), "links": F.sum("links").cast("double")}
    sums |= {c: F.sum(c) for c in ("miles", *CRASHES)}
    sums["crashes"] = sum((F.coalesce(F.sum(c), F.lit(0.0)) for c in CRASHES), F.lit(0.0))
    sums["vc"] = F.try_divide(F.sum("vc_miles"), total("vmt", PARTS))
    found = links.groupBy("pos").agg(*[c.alias(n) for n, c in sums.items()])
    named = [F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in sums]
    counted = found.select("pos", F.inline(F.array(*named)))
    burnt = hwy.hwy_fuel_emissions(speeds, rates, costs, ("pos",), non_fuel, hwy.ALL_CLASSES)
    name = F.when(F.col("measure").isin("fuel", "non_fuel"), F.concat_ws("_", "measure", "cls")).otherwise(F.concat_ws("_", "measure", "kind", "cls"))
    long = counted.unionByName(burnt.select("pos", name.alias("name"), "value"))
    wide = long.groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("m"))  # a bounded map: the columns
    rows = [(i, k, n, p is None) for i, (k, n, p) in enumerate(items)]
    spec = hourly.sparkSession.createDataFrame(rows, "pos int, kind string, item string, blank boolean")
    value = {n: F.when(~F.col("blank"), F.coalesce(F.try_element_at("m", F.lit(n)), F.lit(0.0))) for n in report_columns()}
    return spec.join(wide, "pos", "left").select("pos", "kind", "item", *[v.alias(n) for n, v in value.items()])
