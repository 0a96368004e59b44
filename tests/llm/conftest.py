from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A table like ``documents`` from (doc_id, text) rows, in a few partitions, with clashing columns."""

    def make(rows, parts=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, row long, run int, node long, kind int, value string"
        full = [(i, t, "en", "s", None if t is None else len(t), 1, 2, 3, 4, "x") for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
