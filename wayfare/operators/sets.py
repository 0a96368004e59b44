"""Set operations, sorts and limits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def set_union_all(*parts: tuple[str, DataFrame], tag: str = "source") -> DataFrame:
    """Stack frames by column name, each tagged with its source; missing columns are null."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def set_distinct(df: DataFrame, cols: Sequence[str], keep_order: str | None = None) -> DataFrame:
    """Distinct tuples, or the first row per tuple by ``keep_order``."""
    if keep_order is None:
        return df.select(*cols).distinct()
    rest = [c for c in df.columns if c not in cols]
    return df.groupBy(*cols).agg(F.min_by(F.struct(*rest), F.col(keep_order)).alias("r")).select(*cols, "r.*")


def set_except(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def set_complete_grid(spark: SparkSession, x: tuple[str, int, int], y: tuple[str, int, int]) -> DataFrame:
    """All pairs of two integer ranges, read off one counter instead of a cross join."""
    (xn, x0, x1), (yn, y0, y1) = x, y
    width = y1 - y0 + 1
    ids = spark.range((x1 - x0 + 1) * width)
    return ids.select(
        (F.floor(F.col("id") / width) + x0).cast("int").alias(xn), (F.col("id") % width + y0).cast("int").alias(yn)
    )


def sort_numeric_text(df: DataFrame, col: str) -> DataFrame:
    """Order by a text id read as a number; ids that are no number come last, by text."""
    return df.orderBy(F.asc_nulls_last(F.col(col).try_cast("double")), F.col(col))


def sort_export(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys)


def topk_by_measure(df: DataFrame, keys: Sequence[str], measure: Column, k: int, out: str) -> DataFrame:
    """The k groups with the largest measure; ties go to the smaller key."""
    return df.groupBy(*keys).agg(measure.alias(out)).orderBy(F.desc(out), *keys).limit(k)


def topk_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The k best rows per group; Spark limits each partition to k per group before the shuffle."""
    ranked = df.withColumn(out, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)


def limit_sample_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
