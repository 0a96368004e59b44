"""Operator 5: exact duplicates by a tree merge of sorted digest runs.

Every input partition forms a run of (digest, row to keep, rows). In rounds, ``fan`` runs
become one: segments of the runs meet by parent run and digest, are merged in digest order, and
each level keeps the verified extreme identifier, so a group however large sends one row for each
run. The way back down the same tree hands each run the keeper of its digests; no key of any
shuffle holds more than the rows of one input partition or ``fan`` rows of one level.

Texts are equal when their SHA-256, length and xxhash64 agree (the latter two verify the first).
Null counts as empty. Null identifiers lose against any other; in a group with only null
identifiers ``keep_id`` is null. Exactly one row of a group is kept: of rows repeated with the
largest identifier, the last one read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_text

FAN = 16
KEY = ["digest", "length", "check"]


def digest_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One sorted run of digests for each input partition, written to the shared folder."""
    docs = id_text(df, id_col, text_col)
    runs = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.octet_length("text").alias("length"),
        F.xxhash64("text").alias("check"),
    )
    return cut(runs.sortWithinPartitions("digest"))


def merge_level(level: DataFrame, fan: int) -> DataFrame:
    """Merge ``fan`` runs into one, in digest order."""
    parents = level.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
    return parents.groupBy("run", *KEY).agg(F.max("keeper").alias("keeper"), F.sum("rows").alias("rows"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """One row for each document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    runs = digest_runs(df, id_col, text_col)
    n = runs.agg(F.max("run")).first()[0]
    levels = [runs.groupBy("run", *KEY).agg(F.max(F.struct("doc_id", "row")).alias("keeper"), F.count("*").alias("rows"))]
    levels[0] = cut(levels[0])
    left = (n or 0) + 1
    while left > 1:
        levels.append(cut(merge_level(levels[-1], fan)))
        left = -(-left // fan)
    answer = levels.pop()
    while levels:
        child = levels.pop().select(F.col("run"), *KEY, F.floor(F.col("run") / fan).cast("int").alias("parent"))
        known = answer.select(F.col("run").alias("parent"), *KEY, "keeper", "rows")
        answer = child.join(known, ["parent", *KEY]).select("run", *KEY, "keeper", "rows")
    found = runs.join(answer, ["run", *KEY])
    return found.select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        (F.col("row") == F.col("keeper.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
