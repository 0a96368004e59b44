"""Planar joins on grid cells: points in polygons, nearest sites, buffers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import fn_haversine
from ..session import cut_lineage
from .windows import win_largest_remainder, win_share_in_group, win_surrogate_id


def _cell(x: str | Column, size: float) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.floor(c / size).cast("bigint")


def inside_ring(x: str, y: str, ring: str) -> Column:
    """Even-odd test with half-open edges: a shared border belongs to one side only."""
    px, py = F.col(x), F.col(y)
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))
        spans = (a["y"] > py) != (b["y"] > py)
        at = a["x"] + F.try_divide((py - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return spans & (px < at)

    return F.size(F.filter(F.sequence(F.lit(1), n), crosses)) % 2 == 1


def join_point_in_polygon(
    points: DataFrame, polygons: DataFrame, x: str, y: str, pid: str, ring: str, cell: float, how: str = "inner"
) -> DataFrame:
    """Points with the id of the polygon they lie in; a polygon is copied to the cells of its box.

    The exact test is part of the join condition, so with ``how="left"`` each point row comes
    back once for each polygon it lies in, or once with a null id, whatever its other columns hold.
    """
    xs = F.transform(F.col(ring), lambda p: p["x"])
    ys = F.transform(F.col(ring), lambda p: p["y"])
    boxed = polygons.select(
        pid,
        F.col(ring).alias("__ring"),
        F.explode(F.sequence(_cell(F.array_min(xs), cell), _cell(F.array_max(xs), cell))).alias("__bx"),
        ys.alias("__ys"),
    ).select(pid, "__ring", "__bx", F.explode(F.sequence(_cell(F.array_min("__ys"), cell), _cell(F.array_max("__ys"), cell))).alias("__by"))
    keyed = points.withColumns({"__cx": _cell(x, cell), "__cy": _cell(y, cell)})
    same = (F.col("__cx") == F.col("__bx")) & (F.col("__cy") == F.col("__by")) & inside_ring(x, y, "__ring")
    return keyed.join(boxed, same, how).select(*points.columns, pid)


# Sites in a group of the pyramid, and groups in a group of the level above.
FAN = 4


def _spread(c: Column) -> Column:
    """The low 31 bits of a number with a zero between any two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return c


def _box(x0: Column, x1: Column, y0: Column, y1: Column) -> list[Column]:
    return [F.min(x0).alias("x0"), F.max(x1).alias("x1"), F.min(y0).alias("y0"), F.max(y1).alias("y1")]


def site_pyramid(sites: DataFrame, site: str) -> list[DataFrame]:
    """Groups of ``FAN`` neighbouring sites, groups of ``FAN`` such groups and so on, up to at most ``FAN`` at the top.

    Neighbours follow each other on a Z curve over the ranks of x and of y, so that groups are compact at any
    density: a cluster however tight takes as many levels as the same sites spread out. Each level is
    (id, x0, x1, y0, y1, kids), the kids of the lowest one being sites (id, x, y).
    """
    ranked = win_surrogate_id(win_surrogate_id(sites, ["x", "y"], "__rx"), ["y", "x"], "__ry")
    curve = ranked.withColumn("__z", _spread(F.col("__rx")).bitwiseOR(F.shiftleft(_spread(F.col("__ry")), 1)))
    placed = win_surrogate_id(curve, ["__z"], "__id", start=0)
    x, y = F.col("x"), F.col("y")
    group = F.floor(F.col("__id") / FAN).cast("bigint").alias("id")
    kids = F.collect_list(F.struct(F.col(site).alias("id"), "x", "y")).alias("kids")
    levels = [cut_lineage(placed.groupBy(group).agg(*_box(x, x, y, y), kids))]
    left = levels[0].count()
    while left > FAN:
        below = levels[-1]
        group = F.floor(F.col("id") / FAN).cast("bigint").alias("__up")
        kids = F.collect_list(F.struct("id", "x0", "x1", "y0", "y1")).alias("kids")
        above = below.groupBy(group).agg(*_box(*(F.col(c) for c in ("x0", "x1", "y0", "y1"))), kids)
        levels.append(cut_lineage(above.withColumnRenamed("__up", "id")))
        left = -(-left // FAN)
    return levels


def nearest_candidates(places: DataFrame, sites: DataFrame, site: str) -> DataFrame:
    """``x, y, site, dist`` for the sites that may be the nearest of a place; both frames hold each (x, y) once.

    From the top of the pyramid down, a group is opened only where its least distance does not
    exceed the largest distance at which any group met so far must have a site: every side of a group's box touches one.
    """
    levels = site_pyramid(sites, site)

    def square(c: Column) -> Column:
        return c * c

    def bounds(b: str) -> tuple[Column, Column]:
        px, py, x0, x1, y0, y1 = (F.col(c) for c in ("x", "y", f"{b}.x0", f"{b}.x1", f"{b}.y0", f"{b}.y1"))
        out_x, out_y = F.greatest(x0 - px, px - x1, F.lit(0.0)), F.greatest(y0 - py, py - y1, F.lit(0.0))
        near = [F.least(square(p - lo), square(p - hi)) for p, lo, hi in ((px, x0, x1), (py, y0, y1))]
        far = [F.greatest(square(p - lo), square(p - hi)) for p, lo, hi in ((px, x0, x1), (py, y0, y1))]
        return square(out_x) + square(out_y), F.least(near[0] + far[1], near[1] + far[0])

    def kept(pairs: DataFrame) -> DataFrame:
        """Groups ``b`` of a place that may hold its nearest site; ``least`` and ``most`` are squares."""
        least, most = bounds("b")
        pairs = pairs.withColumns({"least": least, "most": most})
        best = F.min("most").over(W.partitionBy("x", "y"))  # a few rows for each group opened
        return pairs.withColumn("best", best).filter(F.col("least") <= F.col("best") * (1 + 4e-15)).select("x", "y", F.col("b.id").alias("id"))

    top = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("id", "x0", "x1", "y0", "y1")]) for r in levels[-1].drop("kids").collect()])
    open_groups = kept(places.select("x", "y", F.explode(top).alias("b")))
    for i in range(len(levels) - 1, 0, -1):
        open_groups = kept(open_groups.join(levels[i].select("id", "kids"), "id").select("x", "y", F.explode("kids").alias("b")))
    pairs = open_groups.join(levels[0].select("id", "kids"), "id").select("x", "y", F.explode("kids").alias("s"))
    dist = F.sqrt(F.pow(F.col("s.x") - F.col("x"), 2) + F.pow(F.col("s.y") - F.col("y"), 2))
    return pairs.select("x", "y", F.col("s.id").alias(site), dist.alias("dist"))


def join_nearest(points: DataFrame, sites: DataFrame, key: str, site: str) -> DataFrame:
    """Nearest site of each point by planar distance; points and sites have x and y.

    Sites stand in a pyramid of boxes that is walked from the top, so that a point is compared with
    a few groups of sites at each level, however clustered the sites and far the points are. Points at one
    place are looked up once. Ties go to the smaller site id; a point without place, and every point
    where there are no sites, gets null.
    """
    at = sites.filter("x IS NOT NULL AND y IS NOT NULL").select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), site)
    one_per_place = cut_lineage(at.groupBy("x", "y").agg(F.min(site).alias(site)))
    if one_per_place.isEmpty():
        return points.withColumns({site: F.lit(None).cast(sites.schema[site].dataType), "dist": F.lit(None).cast("double")})
    places = points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL").distinct()
    best = nearest_candidates(places, one_per_place, site).groupBy("x", "y").agg(F.min(F.struct("dist", site)).alias("best"))
    found = best.select(F.col("x").alias("__x"), F.col("y").alias("__y"), f"best.{site}", "best.dist")
    here = (F.col("x").cast("double") == F.col("__x")) & (F.col("y").cast("double") == F.col("__y"))
    return points.join(found, here, "left").select(*points.columns, site, "dist")


def join_buffer_aggregate(zones: DataFrame, points: DataFrame, zone: str, radius: float, sums: dict[str, Column], split: int = 4) -> DataFrame:
    """Sums of point attributes within ``radius`` of each zone point.

    Grid cells wholly inside a buffer contribute their cell totals; single points are
    compared only in the cells the circle cuts. Zones without points get 0.
    """
    size = radius / split
    at = points.withColumns({"cx": _cell("x", size), "cy": _cell("y", size), **{f"__{n}": c for n, c in sums.items()}})
    by_cell = at.groupBy("cx", "cy").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in sums])
    span = F.sequence(F.lit(-split - 1), F.lit(split + 1))
    z = zones.select(zone, F.col("x").alias("zx"), F.col("y").alias("zy"))
    z = z.withColumn("dx", F.explode(span)).withColumn("dy", F.explode(span))
    z = z.select(zone, "zx", "zy", (_cell("zx", size) + F.col("dx")).alias("cx"), (_cell("zy", size) + F.col("dy")).alias("cy"))

    def far(axis: str, cell: str) -> Column:
        lo, hi = F.col(cell) * size, (F.col(cell) + 1) * size
        return F.greatest(F.abs(F.col(axis) - lo), F.abs(F.col(axis) - hi))

    def close(axis: str, cell: str) -> Column:
        lo, hi = F.col(cell) * size, (F.col(cell) + 1) * size
        return F.greatest(lo - F.col(axis), F.col(axis) - hi, F.lit(0.0))

    edge = radius * (1 - 1e-9)
    whole = F.pow(far("zx", "cx"), 2) + F.pow(far("zy", "cy"), 2) <= edge * edge
    touch = F.pow(close("zx", "cx"), 2) + F.pow(close("zy", "cy"), 2) <= (radius * (1 + 1e-9)) ** 2
    measures = [f"__{n}" for n in sums]
    full = z.filter(whole).join(by_cell, ["cx", "cy"]).select(zone, *measures)
    part = z.filter(touch & ~whole).join(at, ["cx", "cy"])
    part = part.filter(F.pow(F.col("x") - F.col("zx"), 2) + F.pow(F.col("y") - F.col("zy"), 2) <= radius * radius).select(zone, *measures)
    got = full.unionByName(part).groupBy(zone).agg(*[F.sum(f"__{n}").alias(n) for n in sums])
    return zones.select(zone).join(got, zone, "left").na.fill(0, list(sums))


def decay(kind: str, dist: Column, radius: float, slope: float = 1.0, offset: float = 0.5) -> Column:
    """Weight by distance within a buffer: flat, logistic or exponential; 0 outside."""
    rel = dist / radius
    if kind == "flat":
        w = F.lit(1.0)
    elif kind == "logistic":
        w = 1.0 / (1.0 + F.exp(slope * (rel - offset)))
    elif kind == "exponential":
        w = F.exp(-slope * rel)
    else:
        raise ValueError(f"unknown decay {kind}")
    return F.when(dist <= radius, w).otherwise(F.lit(0.0))


def spa_buffer_decay(
    points: DataFrame, key: str, grid: float, buffers: Sequence[tuple[str, float, str]], sums: dict[str, Column], slope: float = 1.0, offset: float = 0.5
) -> DataFrame:
    """Distance-weighted sums of nearby attributes in buffers (name, radius, decay) per parcel.

    Parcels are snapped to a grid and the grid cells are compared, so the work is bounded
    by occupied cells times the cells of a buffer, however many parcels share a cell.
    """
    at = points.withColumns({"cx": _cell("x", grid), "cy": _cell("y", grid)})
    cells = at.groupBy("cx", "cy").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    reach = max(r for _, r, _ in buffers)
    steps = int(math.floor(reach / grid))
    span = F.sequence(F.lit(-steps), F.lit(steps))
    here = cells.select("cx", "cy").withColumn("dx", F.explode(span)).withColumn("dy", F.explode(span))
    dist = F.sqrt((F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")).cast("double")) * grid
    here = here.withColumn("dist", dist).filter(F.col("dist") <= reach)
    here = here.select(F.col("cx").alias("hx"), F.col("cy").alias("hy"), (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"), "dist")
    aggs = [
        F.sum(F.col(f"__{n}") * decay(kind, F.col("dist"), r, slope, offset)).alias(f"{n}_{name}")
        for name, r, kind in buffers
        for n in sums
    ]
    around = here.join(cells, ["cx", "cy"]).groupBy("hx", "hy").agg(*aggs)
    around = around.withColumnsRenamed({"hx": "cx", "hy": "cy"})
    return at.select(key, "cx", "cy").join(around, ["cx", "cy"]).drop("cx", "cy")


def spa_dasymetric(buildings: DataFrame, polygons: DataFrame, stations: DataFrame, totals: DataFrame, key: str, cell: float, dispersion: float = -0.5) -> DataFrame:
    """Zone totals spread over the buildings inside by distance to the nearest station.

    Shares fall off as exp(dispersion x miles); the whole numbers keep each zone's total, and a
    zone without buildings keeps its own in a row with a null key. ``buildings`` is (key, x, y)
    in degrees, ``polygons`` (pid, ring), ``totals`` (pid, total).
    """
    inside = cut_lineage(join_point_in_polygon(buildings, polygons, "x", "y", "pid", "ring", cell))
    near = join_nearest(inside.select(key, "x", "y").distinct(), stations, key, "site").select(key, "site")
    at = stations.select("site", F.col("x").alias("sx"), F.col("y").alias("sy"))
    far = inside.join(near, key).join(at, "site").withColumn("miles", fn_haversine("x", "y", "sx", "sy"))
    shared = win_share_in_group(far.withColumn("utility", F.exp(dispersion * F.col("miles"))), ["pid"], "utility")
    units = cut_lineage(shared.join(totals, "pid").withColumn("part", F.col("total") * F.col("share")))
    spread = win_largest_remainder(units, ["pid"], "part", [key], "units")
    empty = totals.join(inside.select("pid").distinct(), "pid", "left_anti").withColumn("units", F.round("total").cast("bigint"))
    return spread.unionByName(empty, allowMissingColumns=True)
