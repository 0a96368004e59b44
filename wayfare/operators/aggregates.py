"""Grouped summaries, crosstabs and model-versus-observed statistics.

Each summary is one grouped aggregate over the fact table (partial aggregation before
the shuffle); completion, smoothing, shares and totals run on the aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.recode import SIGNS, first_match
from .sets import set_complete_grid

STATS = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "count": F.count,
}


def agg_group_sum(df: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """All sums by group in one pass."""
    return df.groupBy(*keys).agg(*[F.sum(v).alias(n) for n, v in sums.items()])


def agg_group_mean_weighted(df: DataFrame, key: str, val: str, weight: str, total: bool = True, total_label: str = "total") -> DataFrame:
    """Weighted mean by group over pairs with both sides present, with an all-rows line."""
    both = F.col(val).isNotNull() & F.col(weight).isNotNull()
    mean = F.try_divide(F.sum(F.when(both, F.col(val) * F.col(weight))), F.sum(F.when(both, F.col(weight)))).alias("mean")
    if not total:
        return df.groupBy(key).agg(mean)
    rolled = df.rollup(key).agg(mean, F.grouping(key).alias("all_rows"))
    label = F.when(F.col("all_rows") == 1, F.lit(total_label)).otherwise(F.col(key).cast("string"))
    return rolled.select(label.alias(key), "mean")


def agg_count(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def agg_count_nonnull(df: DataFrame, keys: Sequence[str], col: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(col).alias(out))


def agg_distinct_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct ids against rows, in two levels so no task holds a whole id set."""
    per_id = df.groupBy(*cols).agg(F.count("*").alias("rows_of_id"))
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return per_id.agg(F.count(F.when(known, 1)).alias("n_ids"), F.sum("rows_of_id").alias("n_rows"))


def agg_multi_stat(df: DataFrame, keys: Sequence[str], stats: dict[str, Sequence[str]]) -> DataFrame:
    """Columns ``<stat>_<column>`` in one pass."""
    aggs = [STATS[s](c).alias(f"{s}_{c}") for c, names in stats.items() for s in names]
    return df.groupBy(*keys).agg(*aggs)


def agg_first_by_key(df: DataFrame, key: Sequence[str], firsts: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Attributes that depend on the key once per group, with sums of the measures."""
    return df.groupBy(*key).agg(*[F.min(c).alias(c) for c in firsts], *[F.sum(c).alias(c) for c in sums])


def agg_two_level(df: DataFrame, outer: Sequence[str], inner: Sequence[str], val: str, out: str = "mean") -> DataFrame:
    """Mean over inner keys of their sums; an inner key without rows does not count as 0."""
    per_inner = df.groupBy(*outer, *inner).agg(F.sum(val).alias("__sum"))
    return per_inner.groupBy(*outer).agg(F.avg("__sum").alias(out))


def agg_pivot(df: DataFrame, row: Sequence[str], col: str, val: str, col_values: Sequence, prefix: str = "") -> DataFrame:
    """Long to wide over a declared list of column values; empty cells are 0."""
    cells = [F.coalesce(F.sum(F.when(F.col(col) == F.lit(v), F.col(val))), F.lit(0)).alias(f"{prefix}{v}") for v in col_values]
    return df.groupBy(*row).agg(*cells)


def agg_pivot_margins(df: DataFrame, row: str, col: str, col_values: Sequence, prefix: str = "") -> DataFrame:
    """Count crosstab with row totals and a total line."""
    cells = [F.count(F.when(F.col(col) == F.lit(v), 1)).alias(f"{prefix}{v}") for v in col_values]
    rolled = df.rollup(row).agg(*cells, F.count("*").alias("total"), F.grouping(row).alias("all_rows"))
    label = F.when(F.col("all_rows") == 1, F.lit("Total")).otherwise(F.col(row).cast("string"))
    return rolled.withColumn(row, label).drop("all_rows")


def agg_crosstab_complete(
    df: DataFrame,
    x: str,
    x_range: tuple[int, int],
    y: str,
    y_range: tuple[int, int],
    weight: str | Column,
    subset: Column | None = None,
    out: str = "value",
) -> DataFrame:
    """Weighted crosstab over declared ranges: absent cells are 0, cells outside are left out."""
    if subset is not None:
        df = df.filter(subset)
    w = F.col(weight) if isinstance(weight, str) else weight
    xc, yc = F.col(x).cast("int"), F.col(y).cast("int")
    cells = df.filter(xc.between(*x_range) & yc.between(*y_range)).groupBy(xc.alias(x), yc.alias(y)).agg(F.sum(w).alias(out))
    grid = set_complete_grid(df.sparkSession, (x, *x_range), (y, *y_range))
    return grid.join(cells, [x, y], "left").na.fill(0, [out])


@dataclass(frozen=True)
class Template:
    """One tabulation: a crosstab of ``x`` (by ``y``), or the mean or sum of ``x`` by ``y``.

    ``data`` names the source it reads where there are several; ``smooth`` runs the smoothing of
    :func:`agg_smooth_distribution` over the cells of a crosstab along ``x``; ``transpose`` lays an
    aggregate out along ``x`` instead of ``y``.
    """

    outnum: int
    x: str
    x_range: tuple[int, int]
    y: str | None = None
    y_range: tuple[int, int] = (1, 1)
    weight: str | None = None
    subset: tuple[str, str, float] | None = None
    fun: str = "crosstab"
    data: str | None = None
    smooth: bool = False
    transpose: bool = False


def agg_template_summaries(sources: dict[str, DataFrame], templates: Sequence[Template]) -> DataFrame:
    """All templates over the sources they name, one pass a source: (outnum, x, y, value).

    A template whose source is not there is left out, as a run that prepares only one side leaves out
    the other; a source without templates is not read. Output numbers tell the templates apart.
    """
    numbers = [t.outnum for t in templates]
    if len(set(numbers)) < len(numbers):
        raise ValueError("two templates share an output number")
    out = None
    for name, df in sources.items():
        mine = [t for t in templates if t.data == name]
        if mine:
            part = agg_template_tabulate(df, mine)
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no template names one of the sources")
    return out


def agg_template_tabulate(df: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """All templates over one source in a single pass: (outnum, x, y, value).

    Rows are folded to the distinct combinations of the cell variables and subset tests
    first; only the folded rows are exploded into the cells they feed. Crosstab cells
    without data are completed with 0 before they are smoothed; ``mean`` and ``sum`` templates give one line per
    ``y``, a mean also an all-rows line one past the range. A transposed aggregate swaps ``x`` and ``y``;
    smoothing an aggregate or transposing a crosstab is an error.
    """
    for t in templates:
        if (t.smooth and t.fun != "crosstab") or (t.transpose and t.fun == "crosstab"):
            raise ValueError(f"template {t.outnum} smooths an aggregate or transposes a crosstab")
    cells, flags, sums = {}, {}, {}

    def dim(name: str) -> Column:
        cells[f"__d_{name}"] = F.col(name).cast("int")
        return F.col(f"__d_{name}")

    def test(subset: tuple[str, str, float] | None) -> Column:
        if subset is None:
            return F.lit(True)
        name = f"__t{[*flags].index(subset) if subset in flags else len(flags)}"
        flags[subset] = name
        return F.col(name)

    def total(key: tuple, value: Column) -> Column:
        name = f"__m{[*sums].index(key) if key in sums else len(sums)}"
        sums[key] = (name, value)
        return F.col(name)

    feeds = []
    for t in templates:
        w = F.lit(1.0) if t.weight is None else F.col(t.weight).cast("double")
        yv = F.lit(1) if t.y is None else dim(t.y)
        keep = test(t.subset)
        if t.fun == "crosstab":
            xv = dim(t.x)
            inside = keep & xv.between(*t.x_range) & yv.between(*t.y_range)
            feeds.append(F.when(inside, _feed(t.outnum, xv, yv, total(("w", t.weight), F.sum(w)), F.lit(0.0))))
            continue
        measure = F.col(t.x).cast("double")
        both = measure.isNotNull() & w.isNotNull()
        num = total(("num", t.x, t.weight), F.sum(F.when(both, measure * w)))
        den = total(("den", t.x, t.weight), F.sum(F.when(both, w)))
        feeds.append(F.when(keep & yv.between(*t.y_range), _feed(t.outnum, F.lit(0), yv, num, den)))
        if t.fun == "mean":
            feeds.append(F.when(keep, _feed(t.outnum, F.lit(0), F.lit(t.y_range[1] + 1), num, den)))
    tests = {name: SIGNS[sign](F.col(var), F.lit(val)) for (var, sign, val), name in flags.items()}
    keys = [*[c.alias(n) for n, c in cells.items()], *[c.alias(n) for n, c in tests.items()]]
    folded = df.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.values()])
    long = folded.select(F.explode(F.array(*feeds)).alias("f")).filter(F.col("f").isNotNull())
    got = long.groupBy("f.outnum", "f.x", "f.y").agg(F.sum("f.num").alias("num"), F.sum("f.den").alias("den"))
    means = [t.outnum for t in templates if t.fun == "mean"]
    value = F.when(F.col("outnum").isin(*means), F.try_divide("num", "den")).otherwise(F.col("num")) if means else F.col("num")
    turned = F.col("outnum").isin(*[t.outnum for t in templates if t.transpose]) if any(t.transpose for t in templates) else F.lit(False)
    found = got.select("outnum", F.when(turned, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(turned, F.col("x")).otherwise(F.col("y")).alias("y"), value.alias("value"))
    grids = None
    for t in templates:
        if t.fun != "crosstab":
            continue
        grid = set_complete_grid(df.sparkSession, ("x", *t.x_range), ("y", *t.y_range)).select(F.lit(t.outnum).alias("outnum"), "x", "y")
        grids = grid if grids is None else grids.unionByName(grid)
    if grids is None:
        return found
    whole = grids.join(found, ["outnum", "x", "y"], "full").na.fill(0.0, ["value"])
    smooth = [t.outnum for t in templates if t.smooth]
    if not smooth:
        return whole
    rough = F.col("outnum").isin(*smooth)
    evened = agg_smooth_distribution(whole.filter(rough), ["outnum", "y"], "x", "value")
    return whole.filter(~rough).unionByName(evened)


def _feed(outnum: int, x: Column, y: Column, num: Column, den: Column) -> Column:
    return F.struct(F.lit(outnum).alias("outnum"), x.alias("x"), y.alias("y"), num.alias("num"), den.alias("den"))


def smoothed(cells: Column, passes: int = 10) -> Column:
    """An array of cells after repeated (1/4, 1/2, 1/4) moving averages with both ends pinned.

    A cell with a null neighbour keeps its value in that pass.
    """

    def once(values: Column, _: Column) -> Column:
        before, after = F.concat(F.array(F.lit(None).cast("double")), values), F.slice(values, 2, F.size(values))
        beside = F.arrays_zip(before.alias("b"), values.alias("v"), after.alias("a"))  # one longer than the cells
        return F.transform(F.slice(beside, 1, F.size(values)), lambda c: F.coalesce(0.25 * c["b"] + 0.5 * c["v"] + 0.25 * c["a"], c["v"]))

    return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), cells, once) if passes > 0 else cells


def agg_smooth_distribution(df: DataFrame, part: Sequence[str], order: str, val: str, passes: int = 10) -> DataFrame:
    """Repeated (1/4, 1/2, 1/4) moving average with both end cells pinned.

    Works on a completed distribution, so a partition is one declared range of cells: they are put into one array
    in order, and all passes are one fold over it.
    """
    rest = [c for c in df.columns if c not in (*part, order, val)]
    cell = F.struct(F.col(order).alias("o"), F.col(val).cast("double").alias("v"), *[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])
    lines = df.groupBy(*part).agg(F.array_sort(F.collect_list(cell), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)).alias("__cells"))
    even = smoothed(F.transform("__cells", lambda c: c["v"]), passes)
    # The smoothed cells are a column of their own first: zipping them in place would fold anew for each cell.
    flat = lines.withColumn("__even", even).select(*part, F.explode(F.arrays_zip("__cells", "__even")).alias("__c"))
    back = {order: F.col("__c.__cells.o"), val: F.col("__c.__even")} | {c: F.col(f"__c.__cells.r{i}") for i, c in enumerate(rest)}
    return flat.select(*[(back[c] if c in back else F.col(c)).alias(c) for c in df.columns])


def agg_matrix_district(od: DataFrame, zones: DataFrame, zone: str, district: str, o: str = "o", d: str = "d", val: str = "trips") -> DataFrame:
    """Zone pairs summed to district pairs, aggregated by zone pair before the lookups.

    A zone without a district counts under the null (unknown) district, so the total is kept.
    """
    pairs = od.groupBy(o, d).agg(F.sum(val).alias(val))
    zo = zones.select(F.col(zone).alias(o), F.col(district).alias("o_district"))
    zd = zones.select(F.col(zone).alias(d), F.col(district).alias("d_district"))
    return pairs.join(zo, o, "left").join(zd, d, "left").groupBy("o_district", "d_district").agg(F.sum(val).alias(val))


def agg_matrix_build(trips: DataFrame, o: str, d: str, core: str | Column, weight: str | Column, domain: DataFrame | None = None) -> DataFrame:
    """Trip rows to matrix cells (o, d, core, trips); a domain frame adds its empty cells as 0."""
    core_c = F.col(core) if isinstance(core, str) else core
    w = F.col(weight) if isinstance(weight, str) else weight
    cells = trips.groupBy(F.col(o).alias("o"), F.col(d).alias("d"), core_c.alias("core")).agg(F.sum(w).alias("trips"))
    if domain is None:
        return cells
    return domain.join(cells, ["o", "d", "core"], "left").na.fill(0, ["trips"])


def agg_matrix_stats(od: DataFrame, val: str = "trips") -> DataFrame:
    """Per core: total, cells, largest cell, diagonal total and number of rows."""
    rows = od.groupBy("core", "o").agg(
        F.sum(val).alias("s"), F.count("*").alias("n"), F.max(val).alias("m"), F.sum(F.when(F.col("o") == F.col("d"), F.col(val)).otherwise(0)).alias("g")
    )
    return rows.groupBy("core").agg(
        F.sum("s").alias("total"), F.sum("n").alias("cells"), F.max("m").alias("largest"), F.sum("g").alias("diagonal"),
        F.count("*").alias("n_rows"), F.max("s").alias("largest_row"),
    )


def agg_percent_of_total(df: DataFrame, keys: Sequence[str], val: Column, exclude: Column | None = None, out: str = "pct") -> DataFrame:
    """Group totals and their share of the grand total, unknown labels left out of both."""
    kept = df if exclude is None else df.filter(~F.coalesce(exclude, F.lit(False)))
    sums = kept.groupBy(*keys).agg(val.alias("total"))
    whole = sums.agg(F.sum("total")).scalar()
    return sums.withColumn(out, F.try_divide(F.col("total").cast("double"), whole) * 100)


def agg_band_performance(df: DataFrame, obs: str, mod: str, bands: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Mean model and count by count band [lo, hi), and the per cent error of the means."""
    band = first_match([((F.col(obs) >= lo) & (F.col(obs) < hi), name) for name, lo, hi in bands])
    means = df.withColumn("band", band).filter(F.col("band").isNotNull()).groupBy("band").agg(
        F.avg(mod).alias("mean_flow"), F.avg(obs).alias("mean_count"), F.count("*").alias("n")
    )
    return means.withColumn("pct_error", (F.try_divide("mean_flow", "mean_count") - 1) * 100)


def agg_validation_stats(df: DataFrame, predicates: Sequence[tuple[str, str, Column]], cnt: str, vol: str, length: str) -> DataFrame:
    """Fit of modelled volumes to counts per stored predicate, all in one pass."""
    from ..functions.recode import filter_query_list

    c, v, miles = F.col(cnt).cast("double"), F.col(vol).cast("double"), F.coalesce(F.col(length).cast("double"), F.lit(0.0))
    seen = c > 0
    co, vo = F.when(seen, c), F.when(seen, v)
    moments = {
        "num_obs": F.count(co),
        "tot_cnt": F.sum(co),
        "tot_mod": F.sum(vo),
        "avg_cnt": F.avg(co),
        "avg_mod": F.avg(vo),
        "sd_cnt": F.stddev_samp(co),
        "sd_mod": F.stddev_samp(vo),
        "mse": F.avg(F.pow(vo - co, 2)),
        "mape": 100 * F.avg(F.abs(vo - co) / co),
        "cov": F.covar_samp(co, vo),
        "miles": F.sum(miles),
        "vmt": F.sum(F.coalesce(v, F.lit(0.0)) * miles),
    }
    m = filter_query_list(df, predicates, moments).na.fill(0)
    n = F.col("num_obs")
    err = F.col("avg_mod") - F.col("avg_cnt")
    spread = F.sqrt(F.try_divide(F.pow("sd_cnt", F.lit(2)) + F.pow("sd_mod", F.lit(2)), n))
    return m.withColumns(
        {
            "avg_err": err,
            "tstat": F.coalesce(F.try_divide(err, spread), F.lit(0.0)),
            "pct_err": F.coalesce(100 * F.try_divide(err, F.col("avg_cnt")), F.lit(0.0)),
            "pct_rmse": F.coalesce(100 * F.try_divide(F.sqrt("mse"), F.col("avg_cnt")), F.lit(0.0)),
            "corr": (n - 1) * F.col("cov") / F.greatest(F.lit(1.0), (n - 1) * F.col("sd_cnt") * F.col("sd_mod")),
            "avg_cnt_miles": F.col("avg_cnt") * F.col("miles"),
        }
    ).drop("cov", "mse")


def agg_matrix_rmse(a: DataFrame, b: DataFrame, val: str = "trips") -> DataFrame:
    """Difference of two matrices over the union of their cells; an absent cell is 0."""
    both = a.groupBy("o", "d").agg(F.sum(val).alias("x")).join(b.groupBy("o", "d").agg(F.sum(val).alias("y")), ["o", "d"], "full").na.fill(0, ["x", "y"])
    diff = F.col("x") - F.col("y")
    s = both.agg(F.sum(diff * diff).alias("sse"), F.count("*").alias("cells"), F.sum("x").alias("new_total"), F.sum("y").alias("old_total"))
    rmse = F.sqrt(F.try_divide("sse", "cells"))
    return s.select(
        "cells",
        rmse.alias("rmse"),
        (100 * F.try_divide(rmse, F.try_divide("old_total", "cells"))).alias("rel_rmse"),
        (100 * F.try_divide(F.col("new_total") - F.col("old_total"), F.col("old_total"))).alias("pct_diff"),
        F.try_divide(rmse, F.try_divide("new_total", "cells")).alias("prmsd"),
    )


def agg_vmt_vht(df: DataFrame, keys: Sequence[str], flow: str | Column, length: str | Column, time: str | Column) -> DataFrame:
    """Flow, vehicle miles and vehicle hours (time in minutes) by any dimensions."""
    f, ln, tm = (F.col(c) if isinstance(c, str) else c for c in (flow, length, time))
    return df.groupBy(*keys).agg(F.sum(f).alias("flow"), F.sum(f * ln).alias("vmt"), F.sum(f * tm / 60.0).alias("vht"))


def agg_weighted_vc(df: DataFrame, predicates: Sequence[tuple[str, str, Column]], flow: Column, length: Column, time: Column, vc: Column) -> DataFrame:
    """VMT-weighted volume/capacity ratio and system totals per predicate."""
    from ..functions.recode import filter_query_list

    vmt = flow * length
    sums = filter_query_list(
        df, predicates, {"miles": F.sum(length), "vmt": F.sum(vmt), "vht": F.sum(flow * time / 60.0), "vmt_vc": F.sum(vmt * vc)}
    ).na.fill(0)
    return sums.withColumns(
        {
            "wtd_vc": F.coalesce(F.try_divide("vmt_vc", "vmt"), F.lit(0.0)),
            "avg_speed": F.coalesce(F.try_divide("vmt", "vht"), F.lit(0.0)),
        }
    ).drop("vmt_vc")


def agg_diversity(df: DataFrame, key: Sequence[str], cat: str, val: Column) -> DataFrame:
    """1 - sum of squared category shares, and the total, per key."""
    per_cat = df.groupBy(*key, cat).agg(val.alias("a"))
    s = per_cat.groupBy(*key).agg(F.sum("a").alias("total"), F.sum(F.col("a") * F.col("a")).alias("sq"))
    share = F.try_divide(F.col("sq").cast("double"), (F.col("total") * F.col("total")).cast("double"))
    return s.select(*key, "total", F.coalesce(1 - share, F.lit(0.0)).alias("diversity"))


def agg_accessibility_logsum(
    od: DataFrame, size: DataFrame, beta: float, imp: str = "imp", size_col: str = "size", pair: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """max(0, ln of the sum over destinations of size x exp(beta x impedance)) per origin (and key)."""
    term = F.col(size_col) * F.exp(beta * F.col(imp))
    if pair is not None:
        term = term * F.col(pair)
    sums = od.join(size, "d").groupBy(*keys, "o").agg(F.sum(term).alias("s"))
    return sums.select(*keys, "o", F.greatest(F.lit(0.0), F.when(F.col("s") > 0, F.ln("s")).otherwise(0.0)).alias("logsum"))


@dataclass(frozen=True)
class Constraint:
    """A control: rows of one table whose field lies in [lo, hi); None leaves an end open.

    ``count`` controls count the records of a household, simple ones are 0 or 1.
    """

    name: str
    table: str
    field: str
    lo: float | None
    hi: float | None
    count: bool = False

    def test(self) -> Column:
        c = F.col(self.field)
        p = c.isNotNull()
        p = p if self.lo is None else p & (c >= self.lo)
        return p if self.hi is None else p & (c < self.hi)


def agg_control_incidence(hh: DataFrame, pers: DataFrame, key: str, constraints: Sequence[Constraint]) -> DataFrame:
    """Per seed household, how many of its records meet each constraint."""
    simple = {c.name: c.test().cast("int") for c in constraints if c.table == "household"}
    counted = [F.sum(c.test().cast("int")).alias(c.name) for c in constraints if c.table == "person"]
    out = hh.select(key, *[v.alias(k) for k, v in simple.items()])
    if counted:
        out = out.join(pers.groupBy(key).agg(*counted), key, "left").na.fill(0, [c.name for c in constraints if c.table == "person"])
        flags = {c.name: F.least(F.col(c.name), F.lit(1)) for c in constraints if c.table == "person" and not c.count}
        out = out.withColumns(flags) if flags else out
    return out


def agg_majority_assign(df: DataFrame, a: str, b: str, w: str, share: float = 0.5) -> DataFrame:
    """The ``b`` holding at least ``share`` of the weight of each ``a``; an ``a`` without weight is left out.

    Ties go to the larger weight, then the smaller ``b``.
    """
    pairs = df.groupBy(a, b).agg(F.sum(w).alias("w"))
    tops = pairs.groupBy(a).agg(F.sum("w").alias("total"), F.min_by(F.struct(b, "w"), F.struct(-F.col("w"), F.col(b))).alias("top"))
    part = F.try_divide(F.col("top.w").cast("double"), F.col("total"))
    return tops.filter(F.col("total") > 0).filter(part >= share).select(a, F.col(f"top.{b}").alias(b), part.alias("share"))
