"""Ordered and per-group operators that stay balanced when one group is very large.

A plain ``Window.partitionBy(group)`` puts a whole group into one task. Running measures here
deal the rows out by ranges of (group, order key) instead, sum inside each range, and add what
the ranges before hold of the group; a group of any size is cut wherever the ranges cut it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def _ordering(order: Sequence[str]) -> list[Column]:
    """Sort columns, nulls first; ``-name`` means descending."""
    return [F.col(k[1:]).desc_nulls_first() if k.startswith("-") else F.col(k).asc_nulls_first() for k in order]


def ranged(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` dealt out by ranges of (group, order), with the number of the range as ``__range``.

    Spark samples the bounds, so ranges hold about as many rows each, however keys and groups
    are spread. The ranges are fixed by a checkpoint.
    """
    dealt = df.repartitionByRange(*[F.col(g) for g in group], *_ordering(order))
    return cut_lineage(dealt.withColumn("__range", F.spark_partition_id()))


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: dict[str, Column], totals: dict[str, Column] | None = None) -> DataFrame:
    """Cumulative sums along ``order`` within ``group`` (all rows when ``group`` is empty), and whole sums.

    ``order`` must identify rows within a group; ``totals`` are sums over a whole group. Ranges follow
    each other in key order, so a group that lies in several ranges is the first or last of each: only the
    sums of those two groups of each range are brought together, a table of two rows a range, which each
    range reads. The rows themselves are exchanged twice, for the ranges and for the groups in them.
    """
    group, columns = list(group), df.columns
    vals = {f"__v{i}": c for i, c in enumerate([*sums.values(), *(totals or {}).values()])}
    rows = ranged(df.withColumns(vals), group, order)
    marks = ["__range", *group]
    edge = rows.select(*marks, *vals)
    if group:
        key = F.struct(*group)
        ends = rows.groupBy("__range").agg(F.min(key).alias("__first"), F.max(key).alias("__last"))
        edge = edge.join(F.broadcast(ends), "__range").filter(key.eqNullSafe(F.col("__first")) | key.eqNullSafe(F.col("__last")))
    total = cut_lineage(edge.groupBy(*marks).agg(*[F.sum(v).alias(v) for v in vals]))
    before = W.partitionBy(*group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    borders = total.select(
        *[F.col(c).alias(f"__m{i}") for i, c in enumerate(marks)],
        *[F.sum(v).over(before if i < len(sums) else whole).alias(f"__o{i}") for i, v in enumerate(vals)],
    )
    inner = W.partitionBy(*marks)
    local = inner.orderBy(*_ordering(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    every = inner.orderBy(*_ordering(order)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    inside = rows.withColumns({f"__s{i}": F.sum(v).over(local if i < len(sums) else every) for i, v in enumerate(vals)})
    same = [F.col(c).eqNullSafe(F.col(f"__m{i}")) for i, c in enumerate(marks)]
    placed = inside.join(F.broadcast(borders), same, "left")
    out = [_plus(F.col(f"__s{i}"), F.col(f"__o{i}")).alias(n) for i, n in enumerate(sums)]
    out += [F.when(F.col("__m0").isNotNull(), F.col(f"__o{i}")).otherwise(F.col(f"__s{i}")).alias(n) for i, n in enumerate(totals or {}, len(sums))]
    return placed.select(*columns, *out)


def _plus(inside: Column, offset: Column) -> Column:
    """The sum of both; null only where both are."""
    return F.coalesce(inside + offset, inside, offset)


def group_totals(df: DataFrame, group: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Attach group aggregates: partial aggregation, then a join AQE can split on hot keys."""
    return df.join(df.groupBy(*group).agg(*aggs), list(group), "left")


def win_surrogate_id(df: DataFrame, order: Sequence[str], out: str = "id", start: int = 1) -> DataFrame:
    """Dense ids in key order without a single-task sort."""
    numbered = running(df, [], order, {out: F.lit(1).cast("bigint")})
    return numbered.withColumn(out, F.col(out) + F.lit(start - 1))


def win_group_seq(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "seq") -> DataFrame:
    """1, 2, 3 ... within each group along ``order``."""
    return running(df, group, order, {out: F.lit(1).cast("bigint")})


def win_running_load(df: DataFrame, group: Sequence[str], order: Sequence[str], on: str, off: str, out: str = "load") -> DataFrame:
    """Passengers on board after each stop."""
    net = F.coalesce(F.col(on), F.lit(0)) - F.coalesce(F.col(off), F.lit(0))
    return running(df, group, order, {out: net})


def win_group_max_flag(df: DataFrame, group: Sequence[str], seq: str) -> DataFrame:
    """Group maximum of ``seq`` on each row, with not-first and not-last flags."""
    full = group_totals(df, group, [F.max(seq).alias("last_seq"), F.min(seq).alias("first_seq")])
    return full.withColumns(
        {
            "not_last": (F.col(seq) < F.col("last_seq")).cast("int"),
            "not_first": (F.col(seq) > F.col("first_seq")).cast("int"),
        }
    ).drop("first_seq")


def win_argmin_row(df: DataFrame, group: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Columns of the row with the smallest ``order`` tuple per group."""
    best = F.min_by(F.struct(*carry), F.struct(*order)).alias("best")
    return df.groupBy(*group).agg(best).select(*group, "best.*")


def win_argmax_dedup(df: DataFrame, key: Sequence[str], col: str, tie: str) -> DataFrame:
    """One row per key: largest ``col``, then smallest ``tie``; nulls rank last."""
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(F.col(col).isNull().alias("n"), (-F.col(col)).alias("c"), F.col(tie).alias("t"))
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("best")).select(*key, "best.*")


def win_share_in_group(df: DataFrame, group: Sequence[str], col: str, out: str = "share") -> DataFrame:
    full = group_totals(df, group, [F.sum(col).alias("__total")])
    return full.withColumn(out, F.try_divide(F.col(col).cast("double"), F.col("__total"))).drop("__total")


def win_largest_remainder(df: DataFrame, group: Sequence[str], col: str, tie: Sequence[str], out: str = "rounded") -> DataFrame:
    """Integers with the rounded group total: floors, plus one for the largest remainders."""
    base = df.withColumns({"floor_units": F.floor(col), "remainder": F.col(col) - F.floor(col)})
    rank = {"remainder_rank": F.lit(1).cast("bigint")}
    ranked = running(base, group, ["-remainder", *tie], rank, {"whole_units": F.col(col), "whole_floor": F.col("floor_units")})
    extra = F.round(F.col("whole_units") - F.col("whole_floor")).cast("bigint")
    gain = (F.col("remainder_rank") <= extra).cast("bigint")
    return ranked.select(*df.columns, (F.col("floor_units") + gain).alias(out))


def win_harmonise_parts(df: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Scale the parts down to the total where their sum exceeds it."""
    added = sum((F.coalesce(F.col(p), F.lit(0)).cast("double") for p in parts), F.lit(0.0))
    factor = F.when(added > F.col(total), F.try_divide(F.col(total).cast("double"), added)).otherwise(F.lit(1.0))
    return df.withColumns({p: F.coalesce(F.col(p), F.lit(0)) * factor for p in parts})


def win_hourly_normalise(df: DataFrame, share: str, group: Sequence[str], out: str = "hour_share") -> DataFrame:
    """Hour shares that add to one within each period and class."""
    return win_share_in_group(df, group, share, out)
