"""Origin-destination matrices as long frames (o, d[, core], trips).

A missing cell is 0 and need not be stored. Iterative fitting keeps the cells fixed and
iterates only the row and column factors, so an iteration moves vectors, not matrices.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.recode import first_match, project_case_map
from ..functions.scalar import fn_tod_period
from ..operators.aggregates import agg_matrix_build
from ..operators.sets import topk_per_group
from ..session import FitError, cut_lineage, dealt_out

# Vehicle trips per person trip by mode, transit cores by path type.
VEHICLES_PER_TRIP = {3: 1.0, 4: 1 / 2, 5: 1 / 3.5}
TRANSIT_MODE = 6
TRANSIT_CORES = {3: "Local", 7: "Shuttle"}

# Share of daily trips by period, for internal and external movements.
PERIODS = ("AM", "PM", "OP")
INTERNAL_FACTORS = {"PASS": (0.1980, 0.2744, 0.5276), "SUT": (0.1980, 0.2744, 0.5276), "MUT": (0.1980, 0.2744, 0.5276)}
EXTERNAL_FACTORS = {"PASS": (0.167, 0.222, 0.611), "SUT": (0.162, 0.222, 0.616), "MUT": (0.152, 0.204, 0.644)}

# Trip-end equations; "const" is the intercept.
TRIP_ENDS = {
    "ei_gen": {"const": 337.826, "gen_access": -28.8085, "sqrt_totemp": 3.3727, "fdl": 0.6764},
    "sut_gen": {"bas": 0.9830, "ind": 2.4290, "ret": 1.6000, "srvc": 0.3000, "hh": 0.0080},
    "mut_gen": {"totemp": 0.1276, "pro": -0.1177, "ind": 0.0823},
    "cv_gen": {"bas": 1.110, "ind": 0.938, "ret": 0.888, "srvc": 0.437, "hh": 0.251},
}


def _movement_period() -> Column:
    """Outbound trips count at their arrival, returning trips at their departure."""
    return fn_tod_period(F.when(F.col("half") == 1, F.col("arrtm")).otherwise(F.col("deptm")))


def mat_pce_trips(trips: DataFrame) -> DataFrame:
    """Vehicle trips by period from person trips by car, occupancy taken off."""
    cars = trips.filter(F.col("tmode").isin(*VEHICLES_PER_TRIP))
    weight = F.col("trexpfac") * project_case_map("tmode", VEHICLES_PER_TRIP)
    return agg_matrix_build(cars, "otaz", "dtaz", F.concat(_movement_period(), F.lit("_Pass")), weight)


def mat_transit_trips(trips: DataFrame) -> DataFrame:
    """Transit trips by period and path type."""
    rides = trips.filter((F.col("tmode") == TRANSIT_MODE) & F.col("pathtype").isin(*TRANSIT_CORES))
    core = F.concat_ws("_", _movement_period(), project_case_map("pathtype", TRANSIT_CORES))
    return agg_matrix_build(rides, "otaz", "dtaz", core, "trexpfac")


def mat_trip_table(*matrices: DataFrame) -> DataFrame:
    """All matrices added up by core (``<period>_<class>``), with daily class cores."""
    stacked = reduce(lambda a, b: a.unionByName(b), [m.select("o", "d", "core", F.col("trips").cast("double").alias("trips")) for m in matrices])
    cores = stacked.groupBy("o", "d", "core").agg(F.sum("trips").alias("trips"))
    daily = F.upper(F.element_at(F.split("core", "_"), -1))
    names = F.explode(F.array(F.col("core"), daily))
    return cores.select("o", "d", names.alias("core"), "trips").groupBy("o", "d", "core").agg(F.sum("trips").alias("trips"))


def mat_tod_factors(od: DataFrame, external: Column) -> DataFrame:
    """Daily class cores to periods; ``external`` tells movements that cross the cordon."""
    parts = []
    for i, period in enumerate(PERIODS):
        inner = project_case_map("core", {k: v[i] for k, v in INTERNAL_FACTORS.items()})
        outer = project_case_map("core", {k: v[i] for k, v in EXTERNAL_FACTORS.items()})
        parts.append(F.struct(F.lit(period).alias("period"), F.when(external, outer).otherwise(inner).alias("factor")))
    long = od.withColumn("p", F.explode(F.array(*parts)))
    return long.select("o", "d", F.concat_ws("_", "p.period", "core").alias("core"), (F.col("trips") * F.col("p.factor")).alias("trips"))


def mat_pa_to_od(od: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Average of the matrix and its transpose."""
    ways = F.explode(F.array(F.struct(F.col("o").alias("o"), F.col("d").alias("d")), F.struct(F.col("d").alias("o"), F.col("o").alias("d"))))
    both = od.select(*keys, ways.alias("w"), (F.col("trips") / 2).alias("trips"))
    return both.groupBy(*keys, F.col("w.o").alias("o"), F.col("w.d").alias("d")).agg(F.sum("trips").alias("trips"))


def mat_pivot_point(base: DataFrame, seed: DataFrame, new: DataFrame, k2: float, zero: float = 0.01, keys: Sequence[str] = ()) -> DataFrame:
    """Pivot the seed cells by the modelled change from base to new, for each of ``keys`` by itself.

    Growth applies to the seed in proportion up to ``k2`` times the base, and is added
    beyond it; cells that were empty in the base or the seed take the change itself.
    """
    cell = [*keys, "o", "d"]
    sides = [m.select(*cell, F.col("trips").cast("double").alias(n)) for m, n in ((base, "base"), (seed, "seed"), (new, "inp"))]
    cells = reduce(lambda a, b: a.join(b, cell, "full"), sides).na.fill(0.0, ["base", "seed", "inp"])
    b, s, x = F.col("base"), F.col("seed"), F.col("inp")
    limit = k2 * b
    grown = s * F.least(x, limit) / b + F.greatest(x - limit, F.lit(0.0))
    out = first_match(
        [
            ((b <= zero) & (x <= zero), s),
            (b <= zero, s + x),
            (x <= zero, F.lit(0.0)),
            (s <= zero, F.greatest(x - b, F.lit(0.0))),
        ],
        grown,
    )
    return cells.select(*cell, out.alias("trips"))


def vec_pivot_blend(zones: DataFrame, seed: str, base: str, scenario: str) -> DataFrame:
    """Zone totals pivoted by factor below 0.5, by difference above 1.5, blended between."""
    s, b, x = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in (seed, base, scenario))
    factor = F.coalesce(F.try_divide(x, b), F.lit(0.0))
    times, plus = s * factor, s + (x - b)
    mixed = (factor - 0.5) * plus + (1.5 - factor) * times
    pivot = F.greatest(F.when(factor < 0.5, times).when(factor > 1.5, plus).otherwise(mixed), F.lit(0.0))
    return zones.withColumn("pivoted", pivot).withColumn("growth", F.greatest(F.col("pivoted") - s, F.lit(0.0)))


def vec_trip_generation(zones: DataFrame, equations: dict[str, dict[str, float]] | None = None, internal: Column | None = None) -> DataFrame:
    """Trip ends per zone from linear equations, not below 0; only internal zones generate."""
    cols = {}
    for out, terms in (equations or TRIP_ENDS).items():
        value = F.lit(float(terms.get("const", 0.0)))
        for name, coef in terms.items():
            if name != "const":
                x = F.sqrt(name[5:]) if name.startswith("sqrt_") else F.col(name)
                value = value + coef * x
        value = F.greatest(value, F.lit(0.0))
        cols[out] = value if internal is None else F.when(internal, value).otherwise(0.0)
    return zones.withColumns(cols)


def mat_balance_vectors(zones: DataFrame, p: str, a: str, hold: Column | None = None, weight: float | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Scale attractions to the production total, held zones kept; or both to a weighted total; for each of ``keys`` by itself."""
    keep = F.lit(False) if hold is None else F.coalesce(hold, F.lit(False))
    sums = {"p": F.sum(p), "free": F.sum(F.when(~keep, F.col(a))), "held": F.sum(F.when(keep, F.col(a)).otherwise(0)), "a": F.sum(a)}
    whole = F.struct(*[c.cast("double").alias(n) for n, c in sums.items()])
    if keys:
        zones = zones.join(zones.groupBy(*keys).agg(whole.alias("__t")), list(keys))
        t = F.col("__t")
    else:
        t = zones.agg(whole).scalar()
    if weight is None:
        ratio = F.coalesce(F.try_divide(t["p"] - t["held"], t["free"]), F.lit(0.0))
        out = zones.withColumn(a, F.when(keep, F.col(a)).otherwise(F.col(a) * ratio))
    else:
        total = weight * t["p"] + (1 - weight) * t["a"]
        out = zones.withColumns({p: F.col(p) * F.try_divide(total, t["p"]), a: F.col(a) * F.try_divide(total, t["a"])})
    return out.drop("__t")


# Rows of a factor vector that are broadcast to the cells; longer vectors are joined by shuffle.
VECTOR_ROWS = 200_000


def fit_margins(
    cells: DataFrame, rows: DataFrame, cols: DataFrame, max_iter: int, tol: float, checkpoint_every: int = 4, keys: Sequence[str] = ()
) -> DataFrame:
    """Factors a(o), b(d) so that a x base x b meets the row and column targets.

    ``cells`` is (o, d, base), ``rows`` (o, target), ``cols`` (d, target); with ``keys`` each
    frame has them too and every key combination is a fit of its own, all in the same rounds.
    Stops when no column factor moves by more than ``tol`` in a round; a margin of 0, or a line
    without cells, gives 0. Raises :class:`FitError` if ``max_iter`` rounds do not get there.

    Cells with their targets are dealt out by origin once, in buckets. A round is one pass over them: the row factor of an origin is a sum over its own cells, and
    the cells so scaled add up to partial column sums. Only those, as long as the zones, are exchanged.
    """
    keys = list(keys)
    line, across = [*keys, "o"], [*keys, "d"]
    whole = cells.filter("base > 0").select(*line, "d", F.col("base").cast("double").alias("base"))
    for by, targets, name in ((line, rows, "rt"), (across, cols, "ct")):
        whole = whole.join(targets.select(*by, F.col("target").cast("double").alias(name)), by, "left")
    dealt = dealt_out(whole, line)

    def ratio(target: str, s: Column) -> Column:
        return F.coalesce(F.try_divide(target, s), F.lit(0.0))

    def lifted(frame: DataFrame) -> DataFrame:
        """The row factors that go with the column factors ``f``."""
        return frame.withColumn("a", ratio("rt", F.sum(F.col("base") * F.col("f")).over(W.partitionBy(*line))))

    def columns(frame: DataFrame) -> DataFrame:
        """The next column factors ``f``, beside those they came from as ``g``."""
        sums = lifted(frame).groupBy(*across).agg(F.sum(F.col("base") * F.col("a")).alias("s"), F.first("ct").alias("ct"), F.first("f").alias("g"))
        return sums.select(*across, ratio("ct", F.col("s")).alias("f"), "g")

    def meet(b: DataFrame) -> DataFrame:
        return dealt.join(F.broadcast(b) if short else b, across)

    b = columns(dealt.withColumn("f", F.when(F.col("ct").isNotNull(), 1.0).otherwise(0.0)))
    b, moved = cut_lineage(b), None
    short = b.count() <= VECTOR_ROWS
    for i in range(2, max_iter + 1):
        b = columns(meet(b.drop("g")))
        if i % checkpoint_every and i < max_iter:
            continue
        b = cut_lineage(b)
        moved = b.agg(F.max(F.abs(F.try_divide("f", "g") - 1))).first()[0]
        if moved is None or moved <= tol:
            break
    else:
        raise FitError(f"after {max_iter} rounds a factor still moves by {moved if moved is None else format(moved, '.3g')}")
    last = cut_lineage(columns(meet(b.drop("g"))).select(*across, F.col("g").alias("f"), F.col("f").alias("fb")))
    return lifted(meet(last)).select(*line, "d", (F.col("base") * F.col("a") * F.col("fb")).alias("trips"))


def mat_growth_factor(
    od: DataFrame, rows: DataFrame, cols: DataFrame, max_iter: int = 100, tol: float = 0.001, checkpoint_every: int = 4, keys: Sequence[str] = ()
) -> DataFrame:
    """Doubly constrained growth of a seed matrix (or one for each of ``keys``) to new trip ends."""
    return fit_margins(od.select(*keys, "o", "d", F.col("trips").alias("base")), rows, cols, max_iter, tol, checkpoint_every, keys)


def mat_gravity(
    skim: DataFrame, rows: DataFrame, cols: DataFrame, c: float, k: str | None = None, max_iter: int = 500, tol: float = 0.001,
    checkpoint_every: int = 4, keys: Sequence[str] = (),
) -> DataFrame:
    """Doubly constrained gravity model with friction exp(-c x impedance) and optional K factors."""
    friction = F.exp(-c * F.col("imp"))
    base = friction if k is None else friction * F.col(k)
    return fit_margins(skim.select(*keys, "o", "d", base.alias("base")), rows, cols, max_iter, tol, checkpoint_every, keys)


def mat_intrazonal(skim: DataFrame, keys: Sequence[str] = (), factor: float = 0.25, neighbours: int = 1) -> DataFrame:
    """Diagonal impedance from the mean of the nearest other zones; replaces any diagonal."""
    apart = skim.filter(F.col("o") != F.col("d"))
    near = topk_per_group(apart, [*keys, "o"], [F.col("imp"), F.col("d")], neighbours, "__r")
    inner = near.groupBy(*keys, "o").agg((factor * F.avg("imp")).alias("imp"))
    cols = [*keys, "o", "d", "imp"]
    return apart.withColumn("imp", F.col("imp").cast("double")).select(*cols).unionByName(inner.withColumn("d", F.col("o")).select(*cols))


def mat_logit_shares(util: DataFrame, choice: Sequence[str], mode: str, utility: str, nests: dict | None = None, theta: float = 1.0) -> DataFrame:
    """Choice shares per choice situation; with nests, shares within nest times nest shares.

    A situation holds one row per mode, so its window partition is as small as the mode list.
    """
    u = F.col(utility)
    situation = W.partitionBy(*choice)
    if not nests:
        e = F.exp(u - F.max(u).over(situation))
        return util.withColumn("share", e / F.sum(e).over(situation))
    nest = project_case_map(mode, nests, F.col(mode).cast("string"))
    nested = util.withColumn("nest", nest)
    inside = W.partitionBy(*choice, "nest")
    nested = nested.withColumn("__m", F.max(u).over(inside))
    e = F.exp((u - F.col("__m")) / theta)
    nested = nested.withColumns({"__e": e, "__s": F.sum(e).over(inside), "__n": F.count("*").over(inside)})
    nested = nested.withColumn("__l", F.col("__m") + theta * F.ln("__s"))
    top = F.exp(F.col("__l") - F.max("__l").over(situation))
    return (
        nested.withColumn("__t", top)
        .withColumn("share", F.col("__e") / F.col("__s") * F.col("__t") / F.sum(F.col("__t") / F.col("__n")).over(situation))
        .drop("__m", "__e", "__s", "__n", "__l", "__t")
    )


def mat_common_value(od: DataFrame, zones: DataFrame, zone: str, attr: str) -> DataFrame:
    """1 for the cells whose two zones share the attribute, else 0."""
    side = zones.groupBy(F.col(zone).alias("z")).agg(F.min(attr).alias("v"))
    o = side.withColumnsRenamed({"z": "o", "v": "ov"})
    d = side.withColumnsRenamed({"z": "d", "v": "dv"})
    return od.join(o, "o", "left").join(d, "d", "left").withColumn("same", F.coalesce((F.col("ov") == F.col("dv")).cast("int"), F.lit(0))).drop("ov", "dv")


def mat_odme_factor(od: DataFrame, paths: DataFrame, links: DataFrame, low: str, high: str, cap: float = 10.0) -> DataFrame:
    """Cells scaled by the mean count/volume ratio along their path, kept within bounds.

    ``paths`` is (o, d, link), ``links`` (link, count, volume). A counted link without
    volume has no ratio but counts as a link; a cell without counted links is unchanged.
    """
    ratio = F.when(F.col("volume") > 1, F.least(F.try_divide(F.col("count").cast("double"), F.col("volume")), F.lit(cap)))
    counted = links.filter("count > 0").select("link", ratio.alias("r"))
    along = paths.join(counted, "link").groupBy("o", "d").agg(F.try_divide(F.sum("r"), F.count("*")).alias("f"))
    scaled = od.join(along, ["o", "d"], "left").withColumn("trips", F.col("trips") * F.coalesce("f", F.lit(1.0)))
    return scaled.withColumn("trips", F.least(F.greatest(F.col("trips"), F.col(low)), F.col(high))).drop("f")
