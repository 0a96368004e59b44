"""Scalar functions of the planning tables as Column expressions.

Names that look alike in the source dialects keep their differences: left-closed
``fn_find_interval`` against right-closed ``fn_cut_right``, half-open periods against
inclusive windows, half-even against half-away rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .recode import first_match

MINUTES_PER_DAY = 1440

# Assignment periods in minutes after midnight, half-open.
TOD_PERIODS = {"AM": (360, 540), "PM": (900, 1080)}

# Transit count windows in seconds after midnight, inclusive.
TOD_WINDOWS = {"AM": (6 * 3600, 9 * 3600), "PM": (15 * 3600, 18 * 3600)}

# Functional class code by road rank, in rural (1) and urban (2) areas.
FUNCTIONAL_CLASS = {
    1: {1: 1, 2: 2, 3: 2, 4: 6, 5: 7, 6: 8, 7: 9},
    2: {1: 11, 2: 12, 3: 14, 4: 16, 5: 17, 6: 17, 7: 19},
}

# Emission road types by (rural, urban).
RESTRICTED = (2, 4)
UNRESTRICTED = (3, 5)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fn_find_interval(col: str | Column, cuts: Sequence[float]) -> Column:
    """Number of cut points at or below the value; 0 below the first, null for null.

    An evenly spaced run of cuts at the end is computed instead of listed, provided its
    start and step are exact binary fractions.
    """
    c, cuts = _c(col), sorted(cuts)
    n = len(cuts)
    first = _even_from(cuts)
    rules = [(c < cut, i) for i, cut in enumerate(cuts[: first + 1])]
    if first + 1 == n:
        return first_match([*rules, (c.isNotNull(), n)])
    step = cuts[-1] - cuts[-2]
    steps = F.least(F.floor((c - cuts[first]) / step), F.lit(n - 1 - first)).cast("int")
    return first_match([*rules, (c.isNotNull(), steps + (first + 1))])


def _even_from(cuts: Sequence[float]) -> int:
    """Index from which the cuts are evenly spaced, or the last index if not worth it."""
    last = len(cuts) - 1
    if last < 4:
        return last
    step = cuts[-1] - cuts[-2]
    first = last
    while first > 0 and cuts[first] - cuts[first - 1] == step and all(float(x * 1024).is_integer() for x in (step, cuts[first - 1])):
        first -= 1
    return first if last - first >= 4 else last


def fn_cut_right(col: str | Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """Interval (a, b] labelled by its left edge unless labels are given; null outside."""
    c = _c(col)
    labels = list(edges[:-1]) if labels is None else list(labels)
    bins = zip(edges[:-1], edges[1:], labels, strict=True)
    return first_match([((c > a) & (c <= b), label) for a, b, label in bins])


def fn_time_decode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Decimal hours from HHMM or minutes after midnight.

    Which of the two a column holds is decided over the whole column: any value whose
    last two digits exceed 60 cannot be HHMM, so the column is in minutes.
    """
    widest = df.agg(F.max(F.col(col) % 100)).scalar()
    minutes = F.col(col) / 60.0
    clock = F.floor(F.col(col) / 100.0) + (F.col(col) % 100) / 60.0
    return df.withColumn(out, F.when(widest > 60, minutes).otherwise(clock))


def fn_duration_wrap(start: str | Column, end: str | Column) -> Column:
    """Hours from start to end minute, across midnight where the end comes first."""
    gap = _c(end) - _c(start)
    return F.when(gap < 0, gap + MINUTES_PER_DAY).otherwise(gap) / 60.0


def fn_tod_period(col: str | Column, periods: dict[str, tuple[int, int]] = TOD_PERIODS, other: str = "OP") -> Column:
    c = _c(col)
    return first_match([((c >= a) & (c < b), name) for name, (a, b) in periods.items()], other)


def fn_tod_inclusive(col: str | Column, windows: dict[str, tuple[int, int]] = TOD_WINDOWS, other: str = "OP") -> Column:
    return first_match([(_c(col).between(a, b), name) for name, (a, b) in windows.items()], other)


def fn_hour_bucket(col: str | Column) -> Column:
    return F.concat(F.lit("hr"), F.lpad((F.floor(_c(col) / 60.0) + 1).cast("string"), 2, "0"))


def fn_geo_id_build(df: DataFrame, desc: str, states: DataFrame, counties: DataFrame, out: str = "geoid") -> DataFrame:
    """``Census Tract 112.04, County, State`` to its 11-digit id.

    ``states`` has (state_name, state_code), ``counties`` (state_code, county_name,
    county_code); a name missing from either leaves the id null.
    """
    part = F.split(F.col(desc), ",")
    number = F.regexp_extract(part.getItem(0), r"([0-9.]+)\s*$", 1)
    tract = F.lpad(F.round(number.try_cast("double") * 100).cast("bigint").cast("string"), 6, "0")
    named = df.withColumns(
        {"__tract": tract, "county_name": F.trim(part.getItem(1)), "state_name": F.trim(part.getItem(2))}
    )
    coded = named.join(states, "state_name", "left").join(counties, ["state_code", "county_name"], "left")
    return coded.withColumn(out, F.concat("state_code", "county_code", "__tract")).drop("__tract")


def fn_geo_id_slice(col: str | Column) -> dict[str, Column]:
    """State, county, tract and block parts of a 15-digit id, and the 11-digit tract id."""
    c = _c(col)
    return {
        "state": F.substring(c, 1, 2),
        "county": F.substring(c, 3, 3),
        "tract": F.substring(c, 6, 6),
        "block": F.substring(c, 12, 4),
        "tract_id": F.substring(c, 1, 11),
    }


def fn_geo_id_concat(parts: Sequence[str | Column], widths: Sequence[int]) -> Column:
    return F.concat(*[F.lpad(_c(p).cast("string"), w, "0") for p, w in zip(parts, widths, strict=True)])


def fn_text_clean(col: str | Column, drop: str = "[](),", spaces: bool = True) -> Column:
    """Trim, drop listed characters (and blanks), and spell ``/`` as `` + ``."""
    c = F.translate(F.trim(_c(col)), drop, "")
    c = F.replace(c, F.lit(" "), F.lit("")) if spaces else c
    return F.replace(c, F.lit("/"), F.lit(" + "))


def fn_address_compose(name, number, street, crossing, postcode, at_home: Column, city: str) -> Column:
    """Address line of a stop: street address where the street is known, else the crossing.

    A bare crossing is joined to the street by `` & ``; the postcode is added for homes.
    """
    street_c, cross_c = _c(street), _c(crossing)
    corner = F.when(street_c.isNotNull() & ~F.contains(cross_c, F.lit("&")), F.concat_ws(" & ", street_c, cross_c))
    place = F.when(street_c.isNotNull(), F.concat_ws(" ", _c(name), _c(number), street_c)).otherwise(
        F.concat_ws(" ", _c(name), F.coalesce(corner, cross_c))
    )
    line = F.when(at_home, F.concat_ws(" ", place, _c(postcode))).otherwise(place)
    return F.concat(F.trim(line), F.lit(f", {city}"))


def fn_round_half_even(col: str | Column, scale: int = 0) -> Column:
    return F.bround(_c(col), scale)


def fn_round_half_away(col: str | Column, scale: int = 0) -> Column:
    return F.round(_c(col), scale)


def fn_decimal_money(col: str | Column, code: str | Column, factors: dict, missing: float = 999) -> Column:
    """Amount times the two factors of its vintage code as decimal(9,2); 999 for an unknown code."""
    c, k = _c(col), _c(code)
    money = [(k == F.lit(v), (c * (f * g)).cast("decimal(9,2)")) for v, (f, g) in factors.items()]
    return first_match(money, F.lit(missing).cast("decimal(9,2)"))


def fn_heading(x1, y1, x2, y2) -> Column:
    """Compass bearing from the first to the second point, 0-360 clockwise from north."""
    return F.pmod(F.degrees(F.atan2(_c(x2) - _c(x1), _c(y2) - _c(y1))) + 360.0, F.lit(360.0))


def polyline_heading(points: str | Column, last: bool = False, reverse: bool = False) -> Column:
    """Bearing of the first (or last) segment of an ``array<struct<x,y>>``, walked backwards if ``reverse``.

    Null for fewer than two points.
    """
    line = _c(points)
    at_end = last != reverse
    a, b = (F.get(line, F.size(line) - k if at_end else F.lit(2 - k)) for k in (2, 1))
    if reverse:
        a, b = b, a
    return fn_heading(a["x"], a["y"], b["x"], b["y"])


def polyline_length(points: str | Column) -> Column:
    """Length of an ``array<struct<x,y>>``: a fold that carries the point before. 0 for one point, null for none."""
    line = _c(points)
    first = F.get(line, F.lit(0))
    start = F.struct(F.lit(0.0).alias("length"), first["x"].cast("double").alias("x"), first["y"].cast("double").alias("y"))

    def further(so_far: Column, p: Column) -> Column:
        dx, dy = p["x"].cast("double") - so_far["x"], p["y"].cast("double") - so_far["y"]
        return F.struct((so_far["length"] + F.sqrt(dx * dx + dy * dy)).alias("length"), p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))

    return F.when(F.size(line) >= 1, F.aggregate(line, start, further, lambda done: done["length"]))


def turn_angle(heading_in: str | Column, heading_out: str | Column) -> Column:
    """Change of bearing in [-180, 180): right turns are positive, 350 to 10 degrees is a turn of 20."""
    return F.pmod(_c(heading_out) - _c(heading_in) + 180.0, F.lit(360.0)) - 180.0


def fn_haversine(lon1, lat1, lon2, lat2, radius: float = 3956.0) -> Column:
    """Great-circle distance; the default radius gives miles."""
    a1, a2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat, dlon = a2 - a1, F.radians(_c(lon2)) - F.radians(_c(lon1))
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(dlon / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def fn_json_field(col: str | Column, path: str, kind: str) -> Column:
    return F.get_json_object(_c(col), path).try_cast(kind)


def fn_fclass_crosswalk(fc: str | Column, area: str | Column) -> Column:
    """Twelve-category functional class; a rank without an entry keeps its code."""
    f, a = _c(fc), _c(area)
    rules = [((a == g) & (f == k), v) for g, codes in FUNCTIONAL_CLASS.items() for k, v in codes.items()]
    return first_match(rules, f)


def fn_road_type(fc: str | Column, ramp: str | Column, access: str | Column, area: str | Column) -> Column:
    """Emission road type: ramps by area type, other links by class and full access control."""
    f, urban = _c(fc), _c(fc) >= 11
    closed = f.isin(1, 11) | (_c(access) == 3)
    by_class = F.when(closed, F.when(urban, RESTRICTED[1]).otherwise(RESTRICTED[0])).otherwise(
        F.when(urban, UNRESTRICTED[1]).otherwise(UNRESTRICTED[0])
    )
    by_area = F.when(_c(area) < 4, RESTRICTED[1]).otherwise(RESTRICTED[0])
    return F.when(_c(ramp) > 0, by_area).when(f.between(1, 9) | f.between(11, 19), by_class)


def fn_speed_bin(speed: str | Column) -> Column:
    """Sixteen bins: the first ends at 2.5 mph, each next is 5 mph wide, the last is open."""
    return F.least(F.greatest(F.floor((_c(speed) + 2.5) / 5.0) + 1, F.lit(1)), F.lit(16))


def fn_harmonic_speed(ab: str | Column, ba: str | Column, direction: str | Column) -> Column:
    """Harmonic mean of both directions on a two-way link, else the open direction."""
    a, b, d = _c(ab), _c(ba), _c(direction)
    both = F.try_divide(F.lit(2.0), F.try_divide(F.lit(1.0), a) + F.try_divide(F.lit(1.0), b))
    return F.when(d == 0, both).when(d == 1, a.cast("double")).when(d == -1, b.cast("double"))


def fn_pct_change_safe(new: str | Column, old: str | Column) -> Column:
    """Per cent change to two decimals; 0 where the base is zero or a side is missing."""
    change = F.try_divide((_c(new) - _c(old)).cast("double"), _c(old).cast("double")) * 100
    return F.round(F.coalesce(change, F.lit(0.0)), 2)
