"""Tokens, packing, quality and language: round trips, invariants and held-out accuracy."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wayfare.llm import bpe, langid, packing, quality

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGE = [
    None, "", " ", "a", "aaaaaa bbbb", "I'm it's 's''s !'s we'll'll DON'T", "<|endoftext|>'s x<|startoftext|> Σίσυφος ΣΑΣ 123 ½ ñ İ 日本語 <|end", "x́é \xa0 y\u001cz\u0085q", "😀😃'd",
    "A" * 30000, " '", "hello'", "a'b're'vex", "_a_b-c", "x" * 5 + "​﻿", "ß ẞ ǅ", "word " * 6000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(frame, documents, texts, tokenizer):
    rows = [*enumerate(EDGE), (3, EDGE[3]), (None, "null id")]
    for df, known in ((frame(rows), rows), (documents, list(texts.items()))):
        want = []
        for i, t in known:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            say = tokenizer.decode(ids, skip_special_tokens=False)
            want.append((-1 if i is None else i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(say.encode()).hexdigest()))
        got = [tuple(r) for r in bpe.bpe_digests(df, PATH).fillna({"doc_id": -1}).collect()]
        assert sorted(got) == sorted(want)


def test_tokens_and_text_are_returned(frame, tokenizer):
    got = bpe.bpe_tokens(frame([(1, "Hello there, it's 42")]), PATH).first()
    assert got["ids"] == tokenizer.encode("Hello there, it's 42", add_special_tokens=False).ids
    assert got["decoded"] == tokenizer.decode(got["ids"], skip_special_tokens=False)


def test_words_forgotten_are_learnt_again(tokenizer, monkeypatch):
    vocab = bpe.Vocabulary(PATH)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    for text in ("one two three four five", "six seven one two", "<|endoftext|> one"):
        assert next(vocab.encode([text])).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, known, tokenizer, window):
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in known}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc])
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[doc][at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[doc])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return sum(r["length"] for r in rows) / (window * len(by_sequence))


def test_pieces_tile_documents_and_sequences(frame, documents, texts, tokenizer):
    rows = [(i, t) for i, t in enumerate(EDGE)]
    check_packing(packing.pack_documents(frame(rows), PATH, 64).collect(), rows, tokenizer, 64)
    fill = check_packing(packing.pack_documents(documents, PATH).collect(), list(texts.items()), tokenizer, 2048)
    assert fill > 0.97
    assert packing.pack_documents(documents.filter("doc_id < 0"), PATH).count() == 0


def test_repeated_and_null_ids_keep_all_pieces(frame):
    rows = [(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)]
    got = packing.pack_documents(frame(rows), PATH).collect()
    assert len(got) == 4 and sorted(r["length"] for r in got) == [1, 2, 4, 4]
    assert sorted(r["offset"] for r in got)[0] == 0 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4


def test_plan_places_every_piece_and_fills_windows():
    rng = np.random.default_rng(1)
    for n in (1, 30, 20000):
        lengths = np.minimum(1 + rng.exponential(300, n).astype(int), 511)
        values, counts = np.unique(lengths, return_counts=True)
        used = packing.plan(dict(zip(values.tolist(), counts.tolist(), strict=True)), 512)
        placed = np.zeros(512, int)
        for pattern, times in used:
            assert sum(pattern) <= 512
            np.add.at(placed, list(pattern), times)
        assert (placed[values] == counts).all() and placed.sum() == n
        if n > 1000:
            assert lengths.sum() / 512 / sum(t for _, t in used) > 0.995
    assert packing.plan({}, 512) == []


def test_non_negative_least_squares():
    a = np.array([[1.0, 0, 1], [0, 1, 1]])
    row, column = np.nonzero(a)
    x = packing.nnls(row, column, np.array([3.0, 5.0]), 3)
    assert (x >= 0).all() and np.allclose(a @ x, [3, 5], atol=1e-3)


def test_language_accuracy_and_edges(spark, frame, documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    got = langid.language_of_documents(documents).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    langs, matrix = langid.train(documents)
    edge = {r["doc_id"]: r for r in langid.language(frame([(1, None), (2, ""), (3, "123 !?"), (4, "the and of " * 20000), (5, "é")]), langs, matrix).collect()}
    assert [edge[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and edge[4]["lang_pred"] == "en" and edge[5]["lang_pred"] in langs
    empty = documents.filter("doc_id < 0")
    assert langid.language_of_documents(empty).count() == 0
    assert {r["lang_pred"] for r in langid.language(frame([(1, "abc")]), *langid.train(empty)).collect()} == {"und"}


def test_language_ignores_labels_of_held_out_rows(documents):
    from pyspark.sql import functions as F

    from wayfare.llm.common import crc_mod

    wrong = documents.withColumn("lang", F.when(crc_mod("doc_id", 5) == 0, F.lit("xx")).otherwise(F.col("lang")))
    assert langid.language_of_documents(wrong).exceptAll(langid.language_of_documents(documents)).count() == 0


def test_quality_separates_held_out_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality.quality_of_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [(r["score"], r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9
    assert np.mean([p == y for _, p, y in held]) > 0.9


def test_quality_edges(spark, frame):
    rows = [(i, "plain words of text here " * (i % 7 + 1) if i % 2 else "### $$$ !!! " * (i % 5 + 1)) for i in range(200)] + [(300, None), (301, ""), (302, "x " * 60000), (None, "y"), (1, "again")]
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(200)] + [(None, 1, 0), (5, 1, 0), (6, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.quality_of_documents(frame(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    for none in (labels.filter("doc_id < 0"), labels.filter("quality = 1")):
        assert {r["score"] for r in quality.quality_of_documents(frame(rows[:5]), none).collect()} <= {0.5, 1.0}
    assert quality.quality_of_documents(frame(rows).filter("doc_id < 0"), labels).count() == 0


def test_isotonic_levels_ascend():
    rng = np.random.default_rng(4)
    x = rng.random(500)
    at, level = quality.isotonic(x, (rng.random(500) < x).astype(float))
    assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all()


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_meet_under_polynomial_hashes_stay_apart(frame, tokenizer):
    from wayfare.llm.common import span_hashes
    from wayfare.llm.ngram_join import near_groups

    words = [w for n in (1024, 4096, 65536 * 2) for w in (thue_morse(n), thue_morse(n).translate({97: 98, 98: 97}))]
    codes = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    hashes = span_hashes(codes, ends - [len(w) for w in words], ends)
    assert len(set(hashes.tolist())) == len(words)
    alone = [int(span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
    assert alone == hashes.tolist()  # wherever a word stands
    rows = list(enumerate(words))
    want = {i: len(tokenizer.encode(w, add_special_tokens=False).ids) for i, w in rows}
    ids = {i: hashlib.sha256(np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for i, w in rows}
    got = {r["doc_id"]: r for r in bpe.bpe_digests(frame(rows), PATH).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == want and {i: r["ids_sha256"] for i, r in got.items()} == ids
    assert all(r["component_id"] == r["doc_id"] for r in near_groups(frame(rows)).collect())
