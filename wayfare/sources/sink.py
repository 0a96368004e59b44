"""Writers for result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sink_delimited(df: DataFrame, path: str, cols: Sequence[str] | None = None, sep: str = ",", header: bool = True) -> None:
    """Delimited text with the given column order; one file per partition."""
    out = df.select(*cols) if cols else df
    out.write.mode("overwrite").csv(path, sep=sep, header=header, emptyValue="")


def sentinel_nulls(df: DataFrame, null_value: int = -9, replacements: dict | None = None) -> DataFrame:
    """Null to the sentinel in every column; listed texts to their codes."""
    cols = []
    for field in df.schema:
        c = F.col(field.name)
        if field.dataType.typeName() == "string":
            for text, code in (replacements or {"N.A.": -8}).items():
                c = F.when(c == text, F.lit(str(code))).otherwise(c)
            c = F.coalesce(c, F.lit(str(null_value)))
        else:
            c = F.coalesce(c, F.lit(null_value).cast(field.dataType))
        cols.append(c.alias(field.name))
    return df.select(*cols)


def sink_sentinel_nulls(df: DataFrame, path: str, order: Sequence[str], null_value: int = -9, replacements: dict | None = None) -> None:
    """Ordered export in which no field is empty."""
    sink_delimited(sentinel_nulls(df, null_value, replacements).orderBy(*order), path)


def sink_scenario_snapshot(df: DataFrame, path: str, scenario: str) -> None:
    """Store the table under its scenario; an earlier copy of that scenario is replaced."""
    tagged = df.withColumn("scenario", F.lit(scenario))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scenario").parquet(path)


def sink_empty_grid(domain: DataFrame, df: DataFrame, keys: Sequence[str], fill=0) -> DataFrame:
    """One row per domain key, measures filled with ``fill`` where there is no data."""
    measures = [c for c in df.columns if c not in keys]
    return domain.join(df, list(keys), "left").na.fill(fill, measures)
