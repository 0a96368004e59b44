"""Recodes and projections as Column expressions."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNS = {
    "==": operator.eq,
    "!=": operator.ne,
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
}


def filter_dynamic(df: DataFrame, var: str, sign: str, val) -> DataFrame:
    """Keep rows where ``var sign val`` holds; an unknown sign is an error."""
    return df.filter(SIGNS[sign](F.col(var), F.lit(val)))


def filter_query_list(df: DataFrame, predicates: Sequence[tuple[str, str, Column]], aggs: dict[str, Column]) -> DataFrame:
    """One result row per stored predicate from a single pass.

    Each row is tagged with the predicates it meets; the tags are exploded into the
    partial aggregate, so the data is read once however long the list is.
    """
    spec = df.sparkSession.createDataFrame(
        [(i, k, n) for i, (k, n, _) in enumerate(predicates)], "pos int, kind string, item string"
    )
    tags = F.array(*[F.when(p, F.lit(i)) for i, (_, _, p) in enumerate(predicates)])
    hit = df.withColumn("pos", F.explode(tags)).filter(F.col("pos").isNotNull())
    found = hit.groupBy("pos").agg(*[c.alias(n) for n, c in aggs.items()])
    return spec.join(found, "pos", "left")


def filter_rows_delete(df: DataFrame, pred: Column | None = None, keys: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """Delete rows that meet ``pred`` or whose key is not in ``keys``; null tests as false."""
    if pred is not None:
        df = df.filter(~F.coalesce(pred, F.lit(False)))
    if keys is not None:
        df = df.join(keys.select(*on), list(on), "left_semi")
    return df


def filter_isin_const(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def filter_weekday_month(df: DataFrame, ts: str, month: int, dows: Sequence[int] = (3, 4, 5)) -> DataFrame:
    """Rows of one month on the given days (1 = Sunday, so 3-5 are Tuesday to Thursday)."""
    return df.filter((F.month(ts) == month) & F.dayofweek(ts).isin(*dows))


def project_case_map(col: str | Column, mapping: dict, default=None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return first_match([(c == F.lit(k), v) for k, v in mapping.items()], default)


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    out = None
    for pred, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(pred, v) if out is None else out.when(pred, v)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def project_ordered_ladder(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """The first rule that holds gives the value."""
    return first_match(rules, default)


def project_overwrite_recodes(rules: Sequence[tuple[Column, object]], initial=None) -> Column:
    """Rules applied one after another, a later rule overwriting an earlier one."""
    return first_match(list(reversed(rules)), initial)


def project_purpose_merge(col: str, merges: dict[int, int], parent: str | None = None, work_based: int = 8) -> Column:
    """Merge purpose codes; a tour with a parent tour gets the work-based code."""
    merged = project_case_map(col, merges, F.col(col))
    return merged if parent is None else F.when(F.col(parent) > 0, F.lit(work_based)).otherwise(merged)


def project_default_columns(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def project_clamp(col: str | Column, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi]; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    out = c
    if lo is not None:
        out = F.when(c < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(c > hi, F.lit(hi)).otherwise(out)
    return out


def project_missing_sentinel(col: str, valid: Column | None = None) -> Column:
    """Null where the value is a sentinel (by default a negative)."""
    return F.when(F.col(col) >= 0 if valid is None else valid, F.col(col))


def project_reorder(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns in order; those the frame lacks become null."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in cols])


def project_header_clean(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Trim column names, replace inner blanks by ``_``, then rename."""
    df = df.toDF(*["_".join(c.strip().split()) for c in df.columns])
    return df.withColumnsRenamed(renames or {})


def project_unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], parts: Sequence[str], value: str = "value") -> DataFrame:
    """Wide measure columns to rows, their names split at ``_`` into tag columns."""
    long = df.unpivot(list(ids), list(cols), "tag", value)
    pieces = F.split("tag", "_")
    return long.select(*ids, *[pieces.getItem(i).alias(p) for i, p in enumerate(parts)], value)


def project_pick_by_tag(df: DataFrame, tags: Sequence[str], table: dict[tuple, str], out: str) -> DataFrame:
    """Value of the column that the tag values name."""
    rules = []
    for values, source in table.items():
        pred = F.lit(True)
        for tag, v in zip(tags, values, strict=True):
            pred = pred & (F.col(tag) == F.lit(v))
        rules.append((pred, F.col(source)))
    return df.withColumn(out, first_match(rules))
