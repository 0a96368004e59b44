"""Population synthesis tables: crosswalk, seeds, weights, expansion, formatting, targets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import first_match, project_case_map, project_clamp
from ..functions.scalar import fn_decimal_money, fn_geo_id_concat
from ..operators.aggregates import agg_majority_assign
from ..operators.joins import expanded, join_update_from
from ..operators.windows import running, win_group_seq, win_surrogate_id
from ..session import FitError, cut_lineage, stored

# Census codes.
INCOME_FACTORS = {
    1080470: (1.001264, 1.07910576),
    1073449: (1.007588, 1.06536503),
    1054606: (1.011189, 1.04293629),
    1031452: (1.013097, 1.01811790),
    1010145: (1.010145, 1.00000000),
}
EMPLOYED = (1, 2, 4, 5)
HOUSING_UNIT, GROUP_QUARTERS = 1, 3
STRUCTURE = {2: "1", 4: "2", 5: "2", 6: "2", 7: "2", 8: "2", 9: "2", 1: "3", 10: "3", 3: "4"}
CHILDREN = {4: "1", 1: "2", 2: "2", 3: "2"}
OCCUPATIONS = {
    "1": (11, 13, 15, 17, 19, 27, 39),
    "2": (21, 23, 25, 29, 31),
    "3": (33, 35, 37),
    "4": (41, 43),
    "5": (45, 47, 49),
    "6": (51, 53, 55),
}
NOT_CODED = "999"
FULL_TIME_HOURS = (32, 150)
RESIDENCE = {2: 1, 3: 2, 4: 3, 5: 3, 6: 3, 7: 3, 8: 3, 9: 3, 1: 4, 10: 6}
SAMPLE_TYPE = 11
PERSON_LATER = ("pwpcl", "pwtaz", "pwautime", "pwaudist", "pspcl", "pstaz", "psautime", "psaudist", "puwmode", "puwarrp", "puwdepp", "ptpass", "ppaidprk", "pdiary", "pproxy")
HOUSEHOLD_LATER = ("hhftw", "hhptw", "hhret", "hhoad", "hhuni", "hhhsc", "hh515", "hhcu5")


def pop_crosswalk(cwalk: DataFrame, maz: DataFrame, drop: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean crosswalk with unique PUMA, zone ids and majority PUMA, and controls that carry them.

    ``cwalk`` is (mz_id, tract, puma, state), ``maz`` (mz_id, pop, popngq). A tract takes
    the PUMA that holds at least half its population, if one does.
    """
    kept = cwalk.filter(F.col("tract").isNotNull() if drop is None else ~F.coalesce(drop, F.lit(False)))
    kept = kept.withColumn("puma", F.col("puma") * 100 + F.col("state"))
    people = kept.join(maz.select("mz_id", "pop"), "mz_id")
    major = agg_majority_assign(people, "tract", "puma", "pop").drop("share")
    kept = join_update_from(kept, major, ["tract"], ["puma"], ["puma"])
    taz = win_surrogate_id(kept.select("tract").distinct(), ["tract"], "taz")
    ids = win_surrogate_id(kept.select("mz_id").distinct(), ["mz_id"], "maz")
    full = kept.join(taz, "tract").join(ids, "mz_id")
    controls = maz.withColumn("popngq", project_clamp("popngq", lo=0)).join(full.select("mz_id", "maz", "taz", "puma"), "mz_id", "left")
    return full, controls


def pop_seed_households(hh: DataFrame, per: DataFrame, factors: dict | None = None) -> DataFrame:
    """Seed households and group-quarters records in one pass over the census files."""
    works = F.col("esr").isin(*EMPLOYED)
    roll = per.groupBy("serialno").agg(
        F.count(F.when(works, 1)).alias("nwrkrs_esr"), F.max("schg").alias("schg"), F.max("mil").alias("mil"), F.max("pwgtp").alias("pwgtp")
    )
    seeds = hh.filter((F.col("np") > 0) & F.col("type").isin(HOUSING_UNIT, GROUP_QUARTERS)).join(roll, "serialno", "left")
    gq = F.col("type") == GROUP_QUARTERS
    gqtype = F.when(F.col("schg").isin(6, 7), 1).when(F.col("mil") == 1, 2).otherwise(4)
    return seeds.select(
        "serialno",
        "puma",
        "np",
        F.when(gq, 0).otherwise(F.col("wgtp")).alias("wgtp"),
        F.when(gq, F.col("pwgtp")).otherwise(0).alias("gqwgtp"),
        F.when(~gq, fn_decimal_money("hincp", "adjinc", factors or INCOME_FACTORS)).alias("hhinc_adj"),
        F.coalesce("nwrkrs_esr", F.lit(0)).alias("nwrkrs_esr"),
        gq.cast("int").alias("gqflag"),
        F.when(gq, gqtype).otherwise(0).alias("gqtype"),
        F.when(gq, NOT_CODED).otherwise(project_case_map("bld", STRUCTURE, NOT_CODED)).alias("htype"),
        F.when(gq, NOT_CODED).otherwise(project_case_map("hupac", CHILDREN, NOT_CODED)).alias("hhchild"),
    )


def pop_seed_persons(per: DataFrame, seed_hh: DataFrame) -> DataFrame:
    """Seed persons with employment and occupation group, weights from their household.

    A group-quarters person is weighted by the person weight.
    """
    works = F.coalesce(F.col("esr").isin(*EMPLOYED), F.lit(False))
    old, new = (F.substring(F.trim(c), 1, 2) for c in ("socp00", "socp10"))
    soc = F.when(~works, NOT_CODED).when(old.isin("N", "N."), new).otherwise(old)
    code = F.col("soc").try_cast("int")
    group = first_match([(code.isin(*codes), g) for g, codes in OCCUPATIONS.items()], NOT_CODED)
    weights = seed_hh.select("serialno", "wgtp", "gqwgtp", "gqflag", "gqtype")
    joined = per.withColumns({"employed": works.cast("int"), "soc": soc}).join(weights, "serialno")
    gqwgtp = F.when(F.col("gqflag") == 1, F.col("pwgtp")).otherwise(F.col("gqwgtp"))
    return joined.withColumns({"gqwgtp": gqwgtp, "occp": F.coalesce(group, F.lit(NOT_CODED))})


def pop_raking(
    seed: DataFrame, weight: str, controls: Sequence[tuple[Sequence[str], DataFrame]], max_iter: int = 50, tol: float = 1e-4, checkpoint_every: int = 2
) -> DataFrame:
    """Seed weights scaled until they meet every control: (keys, frame of keys and target).

    The scale of a record depends only on its control categories, so records are folded
    to those categories first; each control then keeps one factor per category, and an
    iteration recomputes a control's factors from those of the others. Every record comes
    back; one with a null category or one without a target has weight 0. Raises
    :class:`FitError` if some control is missed by more than ``tol`` after ``max_iter`` rounds.
    """
    controls = [(ks, cut_lineage(targets)) for ks, targets in controls]
    keys = sorted({k for ks, _ in controls for k in ks})
    cells = cut_lineage(seed.groupBy(*keys).agg(F.sum(F.col(weight).cast("double")).alias("w")))
    factors = [targets.select(*ks, F.lit(1.0).alias(f"f{j}")) for j, (ks, targets) in enumerate(controls)]

    def scaled(skip: int | None = None) -> DataFrame:
        out = cells
        for j, (ks, _) in enumerate(controls):
            if j != skip:
                out = out.join(factors[j], list(ks)).withColumn("w", F.col("w") * F.col(f"f{j}")).drop(f"f{j}")
        return out

    gap = float("inf")
    for i in range(1, max_iter + 1):
        cut = i % checkpoint_every == 0 or i == max_iter or len(controls) > 2
        for j, (ks, targets) in enumerate(controls):
            sums = scaled(j).groupBy(*ks).agg(F.sum("w").alias("s")).join(targets, list(ks), "left")
            factor = F.coalesce(F.try_divide(F.col("target").cast("double"), F.col("s")), F.lit(0.0))
            factors[j] = sums.select(*ks, factor.alias(f"f{j}"))
            if cut:
                factors[j] = cut_lineage(factors[j])
        if cut:
            gap = _worst_gap(scaled(), controls)
            if gap <= tol:
                break
    else:
        raise FitError(f"after {max_iter} rounds a control is still missed by {gap:.3g} of its target")
    result = seed
    for j, (ks, _) in enumerate(controls):
        # A record whose category is null or has no target keeps its row, with weight 0.
        result = result.join(factors[j], list(ks), "left").withColumn(weight, F.col(weight) * F.coalesce(f"f{j}", F.lit(0.0))).drop(f"f{j}")
    return result


def pop_raking_bounded(
    seed: DataFrame, weight: str, controls: Sequence[tuple[Sequence[str], DataFrame]], cap: float, max_iter: int = 60, tol: float = 1e-4
) -> DataFrame:
    """Seed weights scaled to the controls, no weight above ``cap`` times its seed weight.

    A weight is its seed times the product of its categories' factors, cut off at ``cap``. Of all weights
    that meet the controls within the cap, these lie nearest the seed (by relative entropy), so the fit does not depend on the
    order of the controls. Each control in turn refits the factors of its categories: cells at the cap
    are held, the others share what is left of the target; where the held cells alone exceed it, all of
    them shrink. One pass over the folded cells a control; only factors, one a category, are kept.

    A target that no weights within the cap can reach leaves all its cells at the cap and is not an
    error: :func:`pop_control_gaps` lists what is missed. Null categories and categories without a
    target have weight 0. Raises :class:`FitError` if factors still move by more than ``tol`` after
    ``max_iter`` rounds, which other contradictions between controls cause.
    """
    controls = [(list(ks), stored(t.filter("target IS NOT NULL").select(*ks, F.col("target").cast("double").alias("target")), "targets")) for ks, t in controls]
    keys = sorted({k for ks, _ in controls for k in ks})
    cells = seed.groupBy(*keys).agg(F.sum(F.col(weight).cast("double")).alias("w"))
    for ks, targets in controls:
        cells = cells.join(targets.select(*ks), ks, "left_semi")
    cells = stored(cells, "cells")
    factors = [targets.select(*ks, F.lit(1.0).alias(f"f{j}"), F.lit(1.0).alias("step")) for j, (ks, targets) in enumerate(controls)]

    def scaled(rows: DataFrame, how: str) -> DataFrame:
        scale = F.lit(1.0)
        for j, (ks, _) in enumerate(controls):
            rows = rows.join(factors[j].drop("step"), ks, how)
            scale = scale * F.col(f"f{j}")
        return rows.withColumn("__scale", F.when(scale.isNull(), 0.0).otherwise(F.least(scale, F.lit(float(cap))))).drop(*[f"f{j}" for j in range(len(controls))])

    held, w = F.col("__scale") >= cap, F.col("w") * F.col("__scale")
    room = F.col("target") - F.col("held")
    step = F.when((F.col("free") > 0) & (room > 0), room / F.col("free")).when((F.col("held") + F.col("free") > 0) & (room <= 0), F.col("target") / (F.col("held") + F.col("free")))
    for _ in range(max_iter):
        for j, (ks, targets) in enumerate(controls):
            sums = scaled(cells, "inner").groupBy(*ks).agg(F.sum(F.when(held, w).otherwise(0.0)).alias("held"), F.sum(F.when(held, 0.0).otherwise(w)).alias("free"))
            moved = targets.join(sums, ks, "left").select(*ks, F.coalesce(step, F.lit(1.0)).alias("step"))
            factors[j] = stored(factors[j].drop("step").join(moved, ks).withColumn(f"f{j}", F.col(f"f{j}") * F.col("step")), "factors")
        moves = [f.agg(F.max(F.abs(F.col("step") - 1)).alias("m")) for f in factors]
        if (reduce(DataFrame.unionByName, moves).agg(F.max("m")).first()[0] or 0.0) <= tol:
            return scaled(seed, "left").withColumn(weight, F.col(weight) * F.col("__scale")).drop("__scale")
    raise FitError(f"after {max_iter} rounds factors still move by more than {tol:.3g}")


def pop_control_gaps(records: DataFrame, weight: str, controls: Sequence[tuple[Sequence[str], DataFrame]]) -> DataFrame:
    """Target, weight reached and gap of every category: (control, category, target, reached, gap).

    ``control`` names the keys, ``category`` their values, both comma-joined; a target without records reaches 0.
    """
    parts = []
    for ks, targets in controls:
        got = records.groupBy(*ks).agg(F.sum(F.col(weight).cast("double")).alias("reached"))
        goal = F.col("target").cast("double").alias("target")
        rows = targets.select(*ks, goal).join(got, list(ks), "left").withColumn("reached", F.coalesce("reached", F.lit(0.0)))
        name = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in ks])
        parts.append(rows.select(F.lit(",".join(ks)).alias("control"), name.alias("category"), "target", "reached", (F.col("target") - F.col("reached")).alias("gap")))
    return reduce(DataFrame.unionByName, parts)


def _worst_gap(cells: DataFrame, controls: Sequence[tuple[Sequence[str], DataFrame]]) -> float:
    gaps = None
    for ks, targets in controls:
        got = cells.groupBy(*ks).agg(F.sum("w").alias("s")).join(targets, list(ks))
        gap = got.agg(F.max(F.abs(F.try_divide(F.col("s"), F.col("target")) - 1)).alias("g"))
        gaps = gap if gaps is None else gaps.unionByName(gap)
    return gaps.agg(F.max("g")).first()[0] or 0.0


def pop_expand(hh: DataFrame, per: DataFrame, key: str, weight: str, pno: str) -> tuple[DataFrame, DataFrame]:
    """One household per unit of weight, its persons with it, both with dense ids.

    Ids come from running sums before the expansion: household n of a record is the
    records' weight so far plus n. ``pno`` numbers persons within a household from 1.
    """
    sizes = per.groupBy(key).agg(F.count("*").alias("__np"))
    w = F.greatest(F.floor(F.col(weight)), F.lit(0)).cast("bigint")
    base = hh.join(sizes, key, "left").withColumns({"__w": w, "__np": F.coalesce("__np", F.lit(0).cast("bigint"))})
    base = running(base, [], [key], {"__hh_end": F.col("__w"), "__per_end": F.col("__w") * F.col("__np")})
    base = base.withColumns({"__hh0": F.col("__hh_end") - F.col("__w"), "__p0": F.col("__per_end") - F.col("__w") * F.col("__np")})
    base = base.filter("__w >= 1")
    copies = expanded(base.select(*hh.columns, "__w", "__hh0"), F.col("__w"), "n")
    households = copies.withColumn("hhid", F.col("__hh0") + F.col("n")).select(*hh.columns, "n", "hhid")
    spans = base.select(key, "__w", "__np", "__hh0", "__p0")
    persons = expanded(per.join(spans, key), F.col("__w"), "n").select(*per.columns, "n", "__np", "__hh0", "__p0")
    persons = persons.withColumns(
        {"hhid": F.col("__hh0") + F.col("n"), "perid": F.col("__p0") + (F.col("n") - 1) * F.col("__np") + F.col(pno)}
    )
    return households, persons.drop("__np", "__hh0", "__p0")


def pop_format_persons(per: DataFrame) -> DataFrame:
    """Activity-model person file: worker, student and person type, number in household."""
    hours, age, school = F.col("wkhp"), F.col("agep"), F.col("schg")
    full = hours.between(*FULL_TIME_HOURS)
    works = (F.col("employed") != 0) & (hours > 0)
    pwtyp = F.when(~works, 0).when(full, 1).otherwise(2)
    student = (school > 0) | age.between(5, 17)
    pptyp = first_match(
        [
            (age < 5, 8),
            (age < 16, 7),
            (works & full, 1),
            (student & (age < 18), 6),
            (school.between(1, 5) & (age <= 25), 6),
            (student, 5),
            (works, 2),
            (age >= 65, 3),
        ],
        4,
    )
    numbered = win_group_seq(per, ["hhid"], ["perid"], "pno")
    out = numbered.withColumns({"pwtyp": pwtyp, "pstyp": student.cast("int"), "pptyp": pptyp})
    names = [F.col("hhid").alias("hhno"), "pno", "pptyp", F.col("agep").alias("pagey"), F.col("sex").alias("pgend"), "pwtyp", "pstyp"]
    return out.select(*names, *[F.lit(-1).alias(c) for c in PERSON_LATER], F.lit(1).alias("psexpfac"))


def pop_format_households(hh: DataFrame) -> DataFrame:
    """Activity-model household file: structure, tenure, income and vehicles cleaned."""
    ten = F.col("ten")
    tenure = F.when(ten < 0, 9).when(ten <= 2, 1).when(ten == 3, 2).otherwise(3)
    return hh.select(
        F.col("hhid").alias("hhno"),
        F.col("np").alias("hhsize"),
        project_clamp("veh", lo=0).alias("hhvehs"),
        F.col("nwrkrs_esr").alias("hhwkrs"),
        *[F.lit(-1).alias(c) for c in HOUSEHOLD_LATER],
        F.greatest(F.round("hhinc_adj").cast("bigint"), F.lit(0)).alias("hhincome"),
        tenure.alias("hownrent"),
        project_case_map("bld", RESIDENCE, 9).alias("hrestype"),
        F.col("maz").alias("hhparcel"),
        F.col("tz_id").alias("hhtaz"),
        F.lit(1).alias("hhexpfac"),
        F.lit(SAMPLE_TYPE).alias("samptype"),
    )


def pop_control_targets(tracts: DataFrame, acs: DataFrame, sizes: Sequence[str], workers: Sequence[str]) -> DataFrame:
    """Households with children per tract from the survey share, and the control consistency test.

    ``acs`` is long: (state, county, tract, variable, value) with ``hh_all`` and ``hh_child``.
    """
    geoid = fn_geo_id_concat(["state", "county", "tract"], [2, 3, 6]).alias("geoid10")
    pick = [F.sum(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in ("hh_all", "hh_child")]
    share = acs.groupBy(geoid).agg(*pick).select("geoid10", F.try_divide(F.col("hh_child").cast("double"), F.col("hh_all")).alias("share"))
    total = sum((F.col(c) for c in sizes), F.lit(0))
    by_work = sum((F.col(c) for c in workers), F.lit(0))
    out = tracts.join(share, "geoid10").withColumns({"hh": total, "consistent": total == by_work})
    out = out.withColumn("hh_child_new", F.bround(F.col("hh") * F.col("share")).cast("bigint"))
    return out.withColumn("hh_no_child_new", F.col("hh") - F.col("hh_child_new"))
