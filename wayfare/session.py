"""Session settings: scratch folders and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


class FitError(RuntimeError):
    """An iterative fit ended before it met its tolerance."""


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir`` or set on the context."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return named


def ready(spark: SparkSession) -> SparkSession:
    """Give a local trial session without ``spark.checkpoint.dir`` a folder; others stay as they are."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir() and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wayfare-"))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``checkpoint()`` into the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager)


def dealt_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` written once to the shared folder in buckets of ``keys``, one for each shuffle partition.

    Spark knows how the rows lie, so grouping by ``keys`` needs no exchange, however often it is read.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"wayfare_{uuid.uuid4().hex[:12]}"
    rows = df.repartition(parts, *keys).write.bucketBy(parts, *keys).option("path", scratch_path(spark, "buckets"))
    rows.saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name; the files stay for the readers
    return table


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Unlike a checkpoint it comes back with its real size: in a loop of joins the size Spark estimates
    is a product that doubles its digits each round, until planning takes all the time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
