"""Registry of driver queries.

A query is a function of :class:`Tables`; beside it stands the equivalent SQL. The
``out`` spec lists the result columns with their kind, and fixes name, type and
rounding on both sides: ``i`` bigint, ``s`` string, ``b`` boolean, ``t`` date and
``fN`` double rounded to N digits.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import views


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    out: tuple[tuple[str, str], ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


class Tables:
    """Source tables and driver views as attributes, e.g. ``t.lineitem`` or ``t.v_link``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in views.SPARK_VIEWS:
            return views.SPARK_VIEWS[name](self)
        if name in views.VIEWS:
            return self.sql(views.VIEWS[name])
        if name in views.SOURCES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        raise AttributeError(name)

    @property
    def od(self) -> DataFrame:
        """``v_od`` materialised, for queries that read the small matrix more than once."""
        return cut_lineage(self.v_od)

    def sql(self, text: str) -> DataFrame:
        text = views.spark_text(text)
        names = {n for n in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text) if n in views.KNOWN}
        marked = re.sub(
            r"\b(FROM|JOIN)\s+(\w+)",
            lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in names else m[0],
            text,
        )
        return self.spark.sql(marked, **{n: getattr(self, n) for n in names})


def parse_out(spec: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(item.split(":")) for item in spec.split())


def finish(df: DataFrame, out: tuple[tuple[str, str], ...]) -> DataFrame:
    cols = []
    for name, kind in out:
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "s":
            c = c.cast("string")
        elif kind == "b":
            c = c.cast("boolean")
        elif kind == "t":
            c = c.cast("date")
        else:
            c = F.round(c.cast("double"), int(kind[1:])) + F.lit(0.0)
        cols.append(c.alias(name))
    return df.select(*cols)


def finish_sql(sql: str, out: tuple[tuple[str, str], ...]) -> str:
    types = {"i": "BIGINT", "s": "VARCHAR", "b": "BOOLEAN", "t": "DATE"}
    cols = [
        f"CAST({n} AS {types[k]}) AS {n}"
        if k in types
        else f"ROUND(CAST({n} AS DOUBLE), {int(k[1:])}) + 0.0 AS {n}"
        for n, k in out
    ]
    return views.with_views(f"SELECT {', '.join(cols)} FROM (\n{sql.strip()}\n) AS answer")


def query(out: str, sql: str | None = None, name: str | None = None):
    """Register a driver query; ``sql=None`` leaves it to the brute-force tests."""

    def wrap(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = Query(key, fn, parse_out(out), sql)
        return fn

    return wrap


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(q.run(Tables(spark, sf_dir)), q.out)

    run.__name__ = q.name
    return run
