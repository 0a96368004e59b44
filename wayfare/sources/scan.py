"""Readers for the file shapes planning data come in."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Delimiter character codes of the run configuration.
DELIMITERS = {9: "\t", 32: " ", 44: ","}

GTFS_SCHEMAS = {
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int",
    "trips": "route_id string, service_id string, trip_id string, shape_id string, direction_id int",
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int,"
    " sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
}


def scan_delimited(spark: SparkSession, path, schema, sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited text with a declared schema; the first bad row fails the load."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, mode="FAILFAST", enforceSchema=True)


def scan_multi_append(spark: SparkSession, paths: Sequence[str], schema, sep: str = ",") -> DataFrame:
    return scan_delimited(spark, list(paths), schema, sep)


def scan_delim_variants(spark: SparkSession, registry: dict[str, dict], name: str) -> DataFrame:
    """A table by name from a registry of ``{path, schema, delimiter}`` with delimiter codes."""
    entry = registry[name]
    return scan_delimited(spark, entry["path"], entry["schema"], DELIMITERS[entry["delimiter"]])


def scan_prefix_filtered(spark: SparkSession, path, schema, key_cols: Sequence[str], drop_last: int, keys: DataFrame) -> DataFrame:
    """Rows whose key columns, less their last characters, are all in the key set."""
    df = scan_delimited(spark, path, schema)
    key = keys.columns[0]
    for col in key_cols:
        prefix = F.expr(f"left({col}, greatest(length({col}) - {int(drop_last)}, 0))")
        df = df.withColumn("__prefix", prefix)
        df = df.join(keys.select(F.col(key).alias("__prefix")), "__prefix", "left_semi").drop("__prefix")
    return df


def scan_skip_junk(
    spark: SparkSession, path, schema: T.StructType, numeric: str, keep: Callable[[DataFrame], Column] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Typed rows of a file with preamble lines.

    A preamble or repeated header line has no number in the ``numeric`` column, which
    tells it from data in any file split. Rows with a null left are dropped.
    """
    raw = spark.read.csv(path, schema=T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
    raw = raw.filter(F.col(numeric).try_cast("double").isNotNull())
    if keep is not None:
        raw = raw.filter(keep(raw))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name not in drop]).na.drop("any")


def scan_positional_types(spark: SparkSession, path, columns: dict[int, tuple[str, str]], width: int) -> DataFrame:
    """Chosen positions of a headerless file of ``width`` columns, with names and types."""
    fields = [T.StructField(columns[i][0] if i in columns else f"_c{i}", T.StringType()) for i in range(width)]
    raw = spark.read.csv(path, schema=T.StructType(fields), header=False)
    return raw.select(*[F.col(name).cast(kind).alias(name) for _, (name, kind) in sorted(columns.items())])


def scan_fixed_width(spark: SparkSession, path, fields: Sequence[tuple[str, int, int, str]]) -> DataFrame:
    """Report lines cut at fixed offsets: (name, 1-based start, length, type)."""
    lines = spark.read.text(path)
    return lines.select(*[F.trim(F.substring("value", s, n)).cast(kind).alias(name) for name, s, n, kind in fields])


def scan_gtfs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The text tables of a transit feed, read by column name."""
    feed = {}
    for name, ddl in GTFS_SCHEMAS.items():
        wanted = T.StructType.fromDDL(ddl)
        raw = spark.read.csv(os.path.join(folder, f"{name}.txt"), header=True)
        have = set(raw.columns)
        feed[name] = raw.select(
            *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        )
    return feed


def scan_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def scan_params(df: DataFrame, name: str, value: str, kind: str = "double") -> dict[str, Column]:
    """Named parameters of a (name, value) table as scalar columns of the declared kind."""
    names = F.col(name)

    def lookup(key: str) -> Column:
        return df.filter(names == F.lit(key)).agg(F.max(F.col(value).cast(kind))).scalar()

    return _Lookup(lookup)


class _Lookup(dict):
    def __init__(self, find):
        super().__init__()
        self._find = find

    def __missing__(self, key):
        self[key] = self._find(key)
        return self[key]
