"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .chunks import repeated_spans
from .collocations import collocations
from .common import table
from .dedup import exact_groups
from .langid import language_of_documents
from .ngram_join import near_groups
from .packing import pack_documents
from .pii import personal_data
from .quality import quality_of_documents
from .secrets import secret_spans
from .sql import ORACLE_SQL
from .topk import top_k_of_embeddings
from .urls import url_verdicts
from .whitening import whitened_embeddings

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _documents(operator: Callable[..., DataFrame], *args) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"), *args)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": _documents(personal_data),
    "op2_chunk_dedup": _documents(repeated_spans),
    "op3_ngram_join": _documents(near_groups),
    "op4_secrets": _documents(secret_spans),
    "op5_exact_dedup": _documents(exact_groups),
    "op6_bpe": _documents(bpe_digests, VOCABULARY),
    "op7_top_k": lambda spark, sf_dir: top_k_of_embeddings(table(spark, sf_dir, "embeddings")),
    "op8_packing": _documents(pack_documents, VOCABULARY),
    "op9_quality": lambda spark, sf_dir: quality_of_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op10_language": _documents(language_of_documents),
    "op11_url_templates": lambda spark, sf_dir: url_verdicts(table(spark, sf_dir, "pages")).withColumn("purity", F.round("purity", 9)),
    "op12_whitening": lambda spark, sf_dir: whitened_embeddings(table(spark, sf_dir, "embeddings")),
    "op13_collocations": _documents(collocations),
    "pipeline": corpus_pipeline.run,
}
__all__ = ["ORACLE_SQL", "QUERIES"]
