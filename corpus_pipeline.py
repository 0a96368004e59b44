"""From raw documents to packed training sequences: five stages, each on all that the last one kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
Of rows repeated with the same id and text one stays. An empty
table passes through as an empty one.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import cut, stored, table
from wayfare.llm.dedup import exact_groups
from wayfare.llm.langid import train, with_language
from wayfare.llm.ngram_join import near_groups
from wayfare.llm.packing import pack_documents
from wayfare.llm.pii import redacted
from wayfare.operators.windows import win_surrogate_id

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WINDOW = 2048


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, or no letter) go; where ``lang`` is null the others get the predicted one."""
    langs, matrix = train(docs)
    if not langs:
        return docs.select(*COLUMNS).filter(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    found = with_language(docs.select(*COLUMNS), langs, matrix, "predicted").filter("predicted <> 'und'")
    return found.withColumn("lang", F.coalesce("lang", "predicted")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays, once."""
    kept = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256").distinct()
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (digest == F.col("text_sha256"))).dropDuplicates(["kept_id", "text_sha256"]).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id stays, null being the smallest.

    Rows are told apart by id and text, so an id may come with several texts; rows alike in both stay or go together.
    """
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    places = docs.select(F.col("doc_id").alias("place_id"), digest.alias("place_digest")).distinct()
    places = cut(win_surrogate_id(places, ["place_id", "place_digest"], "place"))
    placed = docs.join(places, F.col("doc_id").eqNullSafe(F.col("place_id")) & (digest == F.col("place_digest"))).select(*COLUMNS, "place")
    placed = stored(placed, "pipeline-placed")
    kept = near_groups(placed, id_col="place").filter("doc_id = component_id").select(F.col("doc_id").alias("kept_place")).distinct()
    return placed.join(kept, F.col("place") == F.col("kept_place")).select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows."""
    return redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), WINDOW)


STAGES = [
    ("language", known_language),
    ("exact_dedup", one_of_each),
    ("near_dedup", one_of_each_group),
    ("personal_data", without_personal_data),
    ("packing", packed),
]
# The language model, the confidence of lexical patterns and the packing plan are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(folder, f"pipeline-{uuid.uuid4().hex[:12]}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
