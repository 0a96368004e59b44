"""The pipeline and the registered queries."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from wayfare.llm.queries import ORACLE_SQL, QUERIES


def test_every_operator_is_registered():
    assert {int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(QUERIES)
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["known_language", "one_of_each", "one_of_each_group", "without_personal_data", "packed"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert got == sorted(cur.fetchall(), key=repr) and (got or name == "op13_collocations")


def test_stages_keep_columns_and_clean_documents(spark, frame, tmp_path):
    words = "the and of to in that is was for with on as by this from or had not are but what all were when we there can an your which their said if do will each about how up out them".split()
    text = lambda k: " ".join(words[(i * k) % len(words)] + str(i * k % 7) for i in range(60))
    rows = [(1, text(1)), (2, text(1)), (3, text(3)), (4, text(3) + " more"), (5, None), (6, ""), (7, "123"), (8, "call +1 (017) 555-7713 x@y.zz now"), (9, text(5)), (9, text(5)), (None, "no id at all")]
    docs = frame(rows)
    kept = [[1, 2, 3, 4, 8, 9, 9, None], [2, 3, 4, 8, 9, None], [2, 3, 8, 9, None], [2, 3, 8, 9, None]]
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], kept, strict=True):
        out = stage(spark, docs, "")
        assert out.columns == corpus_pipeline.COLUMNS, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted((r["doc_id"] for r in docs.collect()), key=lambda x: (x is None, x)) == want, name
    found = {r["doc_id"]: r for r in docs.collect()}
    assert found[8]["text"] == "call [PHONE] [EMAIL] now" and found[8]["n_chars"] == len(found[8]["text"])
    assert {r["doc_id"] for r in corpus_pipeline.packed(spark, docs, "").collect()} == {2, 3, 8, 9, None}


def test_ids_with_two_texts_and_given_languages(spark):
    words = [f"w{i}" for i in range(60)]
    near, other = " ".join([*words[:-1], "end"]), " ".join(f"x{i}" for i in range(60))
    rows = [(3, " ".join(words)), (5, near), (5, other), (None, other + " more"), (7, None), (8, None)]
    docs = spark.createDataFrame([(i, t, "de" if k % 2 else None, "s", 1) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    assert kept == {(3, rows[0][1]), (None, rows[3][1]), (7, None), (8, None)}
    known = corpus_pipeline.known_language(spark, docs, "").collect()
    assert {r["lang"] for r in known} == {"de"} and all(r["text"] for r in known)
    labelled = spark.createDataFrame([(i, "the of and that with", "en") for i in range(9)] + [(20, "le la les des une", "fr"), (21, "the of and that with", "fr"), (22, "the of and", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.known_language(spark, labelled.selectExpr("*", "'s' AS source", "1L AS n_chars"), "").collect()}
    assert got[21] == "fr" and got[22] == "en"


def test_pipeline_runs_on_documents_and_on_nothing(spark, sf_dir, documents, tmp_path):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.count() and {"doc_id", "sequence_id", "offset"} <= set(got.columns)
    documents.filter("doc_id < 0").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
