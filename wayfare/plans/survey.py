"""Transit survey, employment, commuting and probe-trip summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fn_geo_id_slice
from ..operators.aggregates import agg_matrix_district, agg_pivot_margins
from ..operators.joins import expanded
from ..operators.windows import win_share_in_group

MIDWEEK = (3, 4, 5)  # Tuesday to Thursday

# Industry columns of each model sector; transport overlaps industrial.
SECTORS = {
    "empfoo_p": ("cns18",),
    "empgov_p": ("cns20",),
    "empind_p": ("cns03", "cns05", "cns06", "cns08"),
    "empmed_p": ("cns16",),
    "empofc_p": ("cns09", "cns10", "cns11", "cns12", "cns13", "cns14"),
    "empret_p": ("cns07",),
    "empsvc_p": ("cns17", "cns19"),
    "empoth_p": ("cns01", "cns02", "cns04"),
    "empedu_p": ("cns15",),
}
OVERLAP = {"emptrn_p": ("cns06", "cns08")}

# Trip model sectors from the employment sectors.
MODEL_SECTORS = {
    "bas": ("empoth_p",),
    "ind": ("empind_p",),
    "ret": ("empret_p",),
    "fdl": ("empfoo_p",),
    "pro": ("empofc_p", "empmed_p", "empgov_p"),
    "osv": ("empedu_p", "empsvc_p"),
}
GRADES = ("insufficient_data", "no_pass", "pass")
PASS_CONFIDENCE = 8
CONSERVED_WITHIN = 1e-9  # of the total, for sums added in another order


def sur_expand_closed_form(obs: DataFrame, sur: DataFrame, key: str) -> DataFrame:
    """Smallest survey totals not below the sample whose shares equal the observed ones.

    Raising each group until its share fits ends at observed x max(sample / observed).
    """
    both = obs.join(sur, key)
    scale = both.agg(F.max(F.try_divide(F.col("sample").cast("double"), F.col("observed")))).scalar()
    return both.withColumn("expanded", F.col("observed") * scale)


def sur_explode_linked(df: DataFrame, weight: str, out: str = "copy") -> DataFrame:
    """One row per half-even rounded weight, at least one."""
    return expanded(df, F.greatest(F.bround(weight).cast("bigint"), F.lit(1)), out)


def sur_geocode_grade(df: DataFrame, conf: str, route: str) -> DataFrame:
    """Route by geocoding grade with totals."""
    c = F.col(conf)
    grade = F.when(c >= PASS_CONFIDENCE, "pass").when(c < PASS_CONFIDENCE, "no_pass").otherwise("insufficient_data")
    return agg_pivot_margins(df.withColumn("grade", grade), route, "grade", GRADES)


def emp_sector_rollup(jobs: DataFrame, level: str = "tract_id") -> DataFrame:
    """Jobs by model sector per block area, with totals and a conservation flag.

    Industry columns the input lacks count 0. ``level`` is a part of the 15-digit id.
    """
    have = set(jobs.columns)

    def added(names: Sequence[str]) -> Column:
        return sum((F.coalesce(F.col(c), F.lit(0)) for c in names if c in have), F.lit(0))

    keyed = jobs.withColumn(level, fn_geo_id_slice("w_geocode")[level])
    sectors = {s: added(cols) for s, cols in {**SECTORS, **OVERLAP}.items()}
    industries = added([c for cols in SECTORS.values() for c in cols])
    sums = keyed.groupBy(level).agg(*[F.sum(v).alias(s) for s, v in sectors.items()], F.sum(industries).alias("all_jobs"))
    # Sectors are summed by column first, all jobs by row first; both skip nulls.
    total = sum((F.col(s) for s in SECTORS), F.lit(0))
    out = sums.withColumns({"emptot_p": total, "conserved": total == F.col("all_jobs")})
    return out.withColumns({m: sum((F.col(s) for s in parts), F.lit(0)) for m, parts in MODEL_SECTORS.items()})


def flow_home_work(od: DataFrame, zones: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Commuting flows at each zone grouping, all levels tagged in one frame."""
    pairs = od.groupBy("o", "d").agg(F.sum("trips").alias("trips"))
    out = None
    for level in levels:
        flows = agg_matrix_district(pairs, zones, "taz", level).withColumn("level", F.lit(level))
        out = flows if out is None else out.unionByName(flows)
    return out


@dataclass(frozen=True)
class FlowSource:
    """One source of home-to-work flows: rows (``o``, ``d``, ``weight``) between areas of its finest level.

    ``areas`` holds one row an area: its id in the column ``base`` and the area it lies in at each of the coarser
    ``levels``. ``base`` is a level itself.
    """

    name: str
    od: DataFrame
    areas: DataFrame
    base: str
    levels: tuple[str, ...]
    o: str = "o"
    d: str = "d"
    weight: str = "trips"


def flow_work_levels(sources: Sequence[FlowSource]) -> DataFrame:
    """Flows of every source at each of its levels: (source, level, o, d, trips, pct, before, after, conserved).

    Each row is rolled up to all levels before the one shuffle, so a source is added up once, however many levels there are.
    ``before`` is the total of the source and ``after`` that of the flows of the level; ``pct`` is of ``after``. A flow
    with an end outside the areas counts in ``before`` only; an area that is listed twice counts
    twice in ``after``. Both show as ``conserved`` false. Null weights count nothing; a level no flow reaches has no rows.
    Area ids come back as text.
    """
    long, before = None, None
    for s in sources:
        names = (s.base, *[x for x in s.levels if x != s.base])

        def ends(side: str, names: tuple[str, ...] = names, s: FlowSource = s) -> DataFrame:
            ids = [F.col(n).cast("string").alias(f"{side}_{i}") for i, n in enumerate(names)]
            return s.areas.select(F.col(s.base).alias(f"__{side}"), *ids)

        od = s.od.select(F.col(s.o).alias("__o"), F.col(s.d).alias("__d"), F.col(s.weight).cast("double").alias("trips"))
        met = od.join(ends("o"), "__o").join(ends("d"), "__d")
        cells = F.array(*[F.struct(F.lit(n).alias("level"), F.col(f"o_{i}").alias("o"), F.col(f"d_{i}").alias("d")) for i, n in enumerate(names)])
        part = met.select(F.lit(s.name).alias("source"), F.explode(cells).alias("c"), "trips").select("source", "c.*", "trips").filter("o IS NOT NULL AND d IS NOT NULL")
        whole = od.agg(F.coalesce(F.sum("trips"), F.lit(0.0)).alias("before")).select(F.lit(s.name).alias("source"), "before")
        long, before = (part, whole) if long is None else (long.unionByName(part), before.unionByName(whole))
    flows = long.groupBy("source", "level", "o", "d").agg(F.coalesce(F.sum("trips"), F.lit(0.0)).alias("trips"))
    after = flows.groupBy("source", "level").agg(F.sum("trips").alias("after"))
    totals = after.join(before, "source").withColumn("conserved", F.abs(F.col("after") - F.col("before")) <= CONSERVED_WITHIN * F.abs("before"))
    pct = F.coalesce(F.try_divide(100 * F.col("trips"), F.col("after")), F.lit(0.0))
    return flows.join(totals, ["source", "level"]).withColumn("pct", pct)


def probe_trip_patterns(trips: DataFrame, months: Sequence[int], within: Sequence[Column], keys: Sequence[str], unknown: Column | None = None) -> DataFrame:
    """Midweek probe trips: counts by the keys and their share of each month and ``within`` group.

    All months and groups (vehicle classes, say) come from one pass; rows that are ``unknown``
    count in neither the group nor its total.
    """
    day = F.dayofweek("start_date")
    kept = trips.filter(F.month("start_date").isin(*months) & day.isin(*MIDWEEK))
    if unknown is not None:
        kept = kept.filter(~F.coalesce(unknown, F.lit(False)))
    sums = kept.groupBy(F.month("start_date").alias("month"), *within, *keys).agg(F.count("*").alias("total"))
    groups = [c for c in sums.columns if c not in keys and c != "total"]
    return win_share_in_group(sums, groups, "total", "share").withColumn("pct", 100 * F.col("share")).drop("share")


def lbl_dedupe_ids(df: DataFrame, key: str) -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
