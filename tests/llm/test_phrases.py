"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wayfare.llm import phrases as ph
from wayfare.llm.collocations import collocations

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, first):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = defaultdict(list)
    for p, a in candidates.items():
        inside = (q for q in candidates if len(q) > len(p) and q[0] == p[0] and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q))))
        if any(100 * candidates[q] >= 80 * a for q in inside):
            continue
        cuts = [(2000000 * a // (f[p[: k + 1]] + f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out[p[0]].append((-score, -a, " ".join(p[1:]).encode(), f[p[: k + 1]], f[(p[0], *p[k + 1 :])]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, some in out.items() for i, (s, a, p, x, y) in enumerate(sorted(some)[:first]))


def table(spark, rows):
    schema = "doc_id long, text string, lang string, f long, phrase string, prefix long, size int, n long"
    return spark.createDataFrame([(None, t, lang, 1, "x", 2, 3, 4) for lang, t in rows], schema).repartition(3)


def some_texts(seed, docs=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "ß", "\x85", "a\xa0b", "x-y", "\x00", "😀", *[f"w{i}" for i in range(30)]]
    gaps = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "!?", " ;"]
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(1, 60)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text + rng.choice(["", "fixed phrase of four"] * 2)))
    return [*rows, ("en", None), ("en", ""), (None, None), ("fr", "...  \t\n"), *rows[:9]]


@pytest.mark.parametrize("held", [200_000, 40])
def test_collocations(spark, monkeypatch, held):
    rows = some_texts(5)
    monkeypatch.setattr(ph, "HELD", held)
    got = collocations(table(spark, rows), least=4, first=50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 50)


def test_long_texts_are_cut_without_loss(monkeypatch):
    rng = random.Random(8)
    text = " ".join(rng.choice(["aa", "b", "cc", "d,", "longer" * 9]) for _ in range(4000))
    for block in (1 << 22, 64, 7, 1):
        monkeypatch.setattr(ph, "BLOCK", block)
        everything, all_buckets = np.full(64, 2**64 - 1, np.uint64), np.ones(ph.BUCKETS, bool)
        got = Counter()
        for known in ((), (everything, all_buckets), (everything, everything, all_buckets)):
            c = ph.Counter("en", known)
            c.read([text.encode(), b"", b"aa b"])
            phrases, _, counts = c.run(0)
            got.update(dict(zip(phrases, counts.tolist(), strict=True)))
        want = Counter()
        for piece in [*text.split(","), "aa b"]:
            w = piece.encode().split()
            want.update(b" ".join(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
            want[b""] += len(w)
        assert got == want


def test_containers_burst_and_spill_whole_subtrees(monkeypatch):
    monkeypatch.setattr(ph, "BURST", 8)
    rng, trie, want = random.Random(1), ph.Trie(), Counter()
    for _ in range(40):
        new = sorted({(rng.randrange(1, 5), rng.randrange(1, 9), rng.randrange(1, 30)) for _ in range(60)})
        counts = [rng.randrange(1, 9) for _ in new]
        want.update(dict(zip(new, counts, strict=True)))
        first, second, third = (np.array(c, np.int64) for c in zip(*new, strict=True))
        trie.add(first, second << ph.WIDTH | third, ph.WIDTH, np.array(counts))
    assert trie.burst and trie.held == len(want)
    some = trie.spill(trie.held // 2)
    rest = trie.spill(0)
    assert not set(some[0].tolist()) & set(rest[0].tolist()) and trie.held == 0
    got = {(f, r >> ph.WIDTH, r & ph.MASK): n for part in (some, rest) for f, r, n in zip(*(x.tolist() for x in part), strict=True)}
    assert got == want


def test_filter_holds_every_phrase():
    hashes = np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64)
    words = np.zeros(1 << 11, np.uint64)
    for at in ph.probes(hashes, 64 * len(words)):
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    assert ph.passes(words, hashes).all()
    assert ph.passes(words, hashes + np.uint64(1)).mean() < 0.02


def test_buckets_bound_counts_from_above(spark):
    rng = np.random.default_rng(6)
    hashes = rng.integers(0, 300, (40, 500)).astype(np.uint64) << np.uint64(64 - 10)
    rows, whole = [], Counter((hashes >> np.uint64(64 - ph.BUCKET_BITS)).ravel().tolist())
    for part in hashes:
        b = ph.Buckets()
        b.add(part)
        b.add(part[:3])
        whole.update((part[:3] >> np.uint64(64 - ph.BUCKET_BITS)).tolist())
        rows += [(None, i, None, None, bytearray(zlib.compress(c))) for i, c in enumerate(b.sums.reshape(-1, ph.CHUNK)) if c.any()]
    runs = spark.createDataFrame(rows, ph.RUN).repartition(5)
    for least in (30, 70, 255, 10_000):
        got = np.flatnonzero(np.unpackbits(ph.added_buckets(runs, least)))
        assert set(got.tolist()) == {k for k, n in whole.items() if n >= min(least, 255)}


def test_sums_tell_rare_phrases_apart_however_many_there_are(spark):
    rng = np.random.default_rng(7)
    keys = np.concatenate([rng.integers(0, 1 << ph.KEY_BITS, 3000), (5 << ph.KEY_BITS - 24) + np.arange(1 << ph.KEY_BITS - 24), [0, (1 << ph.KEY_BITS) - 1]]).astype(np.uint64)
    rows, whole = [], Counter()
    for part in range(30):  # each key once, so that a bucket of 24 bits holds thousands; some more often
        some = np.concatenate([keys[part::30], keys[:50], np.repeat(keys[-1:], 300 * (part == 3))])
        whole.update(some.tolist())
        sums = ph.Sums()
        sums.add(some << np.uint64(64 - ph.KEY_BITS) | np.uint64(part))
        rows += [(None, lead, None, None, bytearray(body)) for lead, body in sums.rows()]
        assert not list(sums.rows())
    runs = spark.createDataFrame(rows, ph.RUN).repartition(5)
    for least in (2, 30, 255, 10_000):
        want = np.array(sorted(k for k, n in whole.items() if n >= min(least, 255)), np.uint64)
        found = ph.frequent_sums(runs, least)
        assert sorted(r[0] for r in found.collect()) == sorted(ph.key_hashes(want).view(np.int64).tolist()) and len(want)
        known = ph.frequent_filter(found)
        shift = np.uint64(64 - ph.KEY_BITS)
        assert ph.may_be_frequent(known, want << shift).all() and ph.may_be_frequent(known, np.setdiff1d(keys, want) << shift).mean() < 0.02
    places, n = zip(*[ph.unpacked(bytes(r[4])) for r in rows if r[1] == 0], strict=True)
    assert set(np.concatenate(places).tolist()) == {k for k in whole if k < 1 << ph.PLACE_BITS} and np.concatenate(n).min() > 0


def test_runs_of_short_phrases_carry_no_hash(spark):
    texts = spark.createDataFrame([("en", bytearray(b"a bb \xc3\xa9 a bb")), ("de", bytearray(b"a bb"))], "lang string, body binary")
    everything = np.full(64, 2**64 - 1, np.uint64)
    for known in ((), (everything, everything)):
        runs = ph.phrase_runs(texts, known).filter("phrase > ''")
        rows = runs.collect()
        assert rows and all(r["prefix"] is None for r in rows)
        want = set()
        for lang in ("en", "de"):
            words = ph.Words(lang)
            mine = [[words[w] for w in r["phrase"].encode().split()] for r in rows if r["lang"] == lang]
            want.update(int(ph.phrase_hashes(list(words.hashed()[np.array(p)].reshape(-1, 1))).view(np.int64)[0]) for p in mine)
        assert {r[0] for r in ph.hashed(runs).collect()} == want and len(want) > 2
    assert all(r["prefix"] is not None for r in ph.phrase_runs(texts, (everything,) * 3).collect())


def test_empty_table_and_large_counts(spark):
    assert collocations(table(spark, [("en", "a b")]).filter("lang = 'x'")).count() == 0
    assert collocations(table(spark, [("en", "a b")])).count() == 0
    hot = [("en", "a b " * 3000)] * 20 + [("en", "c d e f")] * 40
    assert sorted(map(tuple, collocations(table(spark, hot)).collect())) == brute(hot, 30, 2000)
