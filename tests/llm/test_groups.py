"""Exact and near duplicates, repeated passages and top-k against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import sys
from collections import defaultdict

import numpy as np

from wayfare.llm import chunks, dedup, ngram_join, topk
from wayfare.llm.components import smallest_labels


def test_exact_groups(frame):
    rng = random.Random(3)
    rows = [(i, rng.choice(["", None, "a", "b" * 50000, "é", f"own {i}"])) for i in range(300)] + [(7, "a"), (None, "null id"), (None, "a"), (299, "tie"), (299, "tie")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for fan in (2, 16):
        got = dedup.exact_groups(frame(rows, 9), fan=fan).collect()
        assert len(got) == len(rows)
        kept = defaultdict(int)
        for r in got:
            kept[r["text_sha256"]] += r["kept"]
        assert set(kept.values()) == {1}
        want = sorted((i or 0, max((x for x in groups[t or ""] if x is not None), default=0), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
        assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["text_sha256"]) for r in got) == want
        assert all(r["kept"] <= (r["doc_id"] == r["keep_id"]) for r in got)
    assert dedup.exact_groups(frame(rows).filter("doc_id < 0")).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_groups(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b in range(a):
            t = sets[b][1]
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for a, (i, _) in enumerate(sets):
        low[find(a)] = min(i, low.get(find(a), i))
    return sorted((i, len(s), low[find(a)]) for a, (i, s) in enumerate(sets))


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def near_rows(seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for size in (3, 4, 5, 6, 8, 10, 12, 15, 20, 40, 120, 600):
        base = [f"v{rng.randrange(10**6)}" for _ in range(size)]
        for k in range(8):
            w = edited(rng, base, rng.choice([0, 0, 1, 1, 2, size // 50]))
            w = w + [f"z{rng.randrange(99)}"] * rng.choice([0, 0, 1, size // 6])
            rows.append((len(rows), " ".join(w).upper() if k % 3 else "\t".join(w) + "\n"))
    for _ in range(40):  # a passage in common, the rest their own
        rows.append((len(rows), " ".join([f"q{rng.randrange(10**6)}" for _ in range(30)] + passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 30))])))
    chain = [f"c{i}" for i in range(60)]
    for i in range(30):  # each links with the next ones only
        rows.append((len(rows), " ".join(chain[i:] + [f"d{j}" for j in range(i)])))
    return [*rows, (9000, ""), (9001, None), (9002, " \n"), (9003, "É é İ x y z"), (9004, "é é İ x y z"), (5, rows[5][1])]


def test_near_groups_equal_brute_force(frame):
    for seed in (1, 2):
        rows = near_rows(seed)
        got = sorted(tuple(r) for r in ngram_join.near_groups(frame(rows, 5)).select("doc_id", "n_shingles", "component_id").collect())
        assert got == brute_groups(rows)


def test_near_groups_of_mixed_passages(frame, monkeypatch):
    """Long lists of texts made of the same passages: many near each other, some of them linked."""
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(3)
    passages = [[f"p{i}x{j}" for j in range(15)] for i in range(9)]
    rows = [(i, " ".join(sum(rng.sample(passages, rng.choice([5, 6, 7])), []) + [f"u{i}"] * rng.choice([0, 7]))) for i in range(120)]
    got = sorted(tuple(r) for r in ngram_join.near_groups(frame(rows, 5)).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_groups(rows)


def test_blocks_connect_all_that_links(frame, spark):
    rng = random.Random(4)
    passages = [[f"p{i}x{j}" for j in range(20)] for i in range(8)]
    texts = [" ".join(sum(rng.sample(passages, 6), []) + [f"u{i}"] * rng.choice([0, 9])) for i in range(90)]
    docs = ngram_join.id_text(frame(list(enumerate(texts))))
    sets = [ngram_join.shingles(t) for t in texts]
    node = [ngram_join.class_of(x) for x in sets]
    assert len(set(node)) == 90
    classes = spark.createDataFrame([(node[i], i, len(x), ngram_join.sketch(x)) for i, x in enumerate(sets)], "node long, first long, n long, cells binary")
    rows = [(sig, node[i], len(x), node[i - i % 2]) for sig in (1, 2) for i, x in enumerate(sets) if sig == 1 or i % 3]
    rest = spark.createDataFrame(rows, "sig long, node long, n long, label long")
    same = [(node[i], node[i - i % 2]) for i in range(90)]
    real = [(node[i], node[j]) for i in range(90) for j in range(i) if ngram_join.links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))]
    parts = lambda edges: sorted(tuple(r) for r in smallest_labels(spark.createDataFrame(edges, "a long, b long")).collect())
    want = parts(real + same)
    for block in (7, 512):
        got = [tuple(r) for r in ngram_join.linked_in_lists(rest, docs, classes, block).collect()]
        assert set(got) <= {*real, *[(b, a) for a, b in real]}
        assert parts(got + same) == want


def test_near_groups_of_documents(documents, texts):
    got = sorted(tuple(r) for r in ngram_join.near_groups(documents).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_groups(sorted(texts.items()))


def test_near_groups_of_nothing(frame):
    assert ngram_join.near_groups(frame([(1, "a")]).filter("doc_id > 5")).count() == 0
    got = ngram_join.near_groups(frame([(None, "a b c d e f"), (1, ""), (2, "a b c d e f")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in got) == [(0, 2, 0), (1, 0, 1), (2, 2, 2)]


def test_boundary_follows_cost():
    sizes = {n: 10 for n in range(1, 60)}
    assert ngram_join.choose_boundary(sizes, 50.0) > ngram_join.choose_boundary(sizes, 0.1)


def test_signatures_meet_whenever_sets_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(2, 80))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        drop = rng.integers(0, n // 5 + 1)
        b = np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if ngram_join.links(common, len(a), len(b)) and len(a) > 1 and not np.array_equal(a, b):
            for boundary in (0, 7, 20, 64):
                level = lambda s: (s % np.uint64(3)).astype(np.uint8)
                assert np.intersect1d(ngram_join.signatures(a, level(a), boundary), ngram_join.signatures(b, level(b), boundary)).size


def test_sets_are_made_for_many_texts_at_once():
    rng = random.Random(8)
    parts = ["a", "b", "AB", "é", "\0", "\0" * 8, "\0" * 16, "x" * 7, "x" * 8, "x" * 9, "y" * 63, "y" * 64, "y" * 65, "z" * 900]
    texts = ["", " \n", *parts, *[a + b for a in parts for b in parts], *[p + "\0" * k for p in ("", "a") for k in range(80)]]
    texts += [rng.choice([" ", "\t", " \r\n"]).join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(1500)]
    for most in (1, 200, ngram_join.TEXT_RUN):
        found = [(hashes[lo:hi], c) for hashes, bounds, classes in ngram_join.shingle_sets(texts, most=most) for lo, hi, c in zip(bounds[:-1], bounds[1:], classes.tolist(), strict=True)]
        assert len(found) == len(texts)
        by_class = {}
        for text, (s, c) in zip(texts, found, strict=True):
            want = shingle_set(text)
            assert len(s) == len(want) and (s[1:] > s[:-1]).all() and c == ngram_join.class_of(s)
            assert by_class.setdefault(c, want) == want
        assert len(by_class) == len(set(by_class.values()))
        for i in range(0, 600, 40):
            for j in range(i, 600, 7):
                assert ngram_join.common_of(found[i][0], found[j][0]) == len(shingle_set(texts[i]) & shingle_set(texts[j]))
    calls = [0]

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        runs = sum(1 for _ in ngram_join.shingle_sets(["some words of a short text here"] * 2000))
    finally:
        sys.setprofile(None)
    assert runs == 1 and calls[0] < 10 * 2000  # cut by itself, such a text took 85 calls


def test_levels_by_key():
    rng = np.random.default_rng(9)
    for bits in (3, 6, 20):
        values = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
        keys = np.unique(ngram_join.shingle_keys(values[::3], bits))
        levels = rng.integers(1, 30, len(keys)).astype(np.uint8)
        known = dict(zip(keys.tolist(), levels.tolist(), strict=True))
        want = [known.get(k, 0) for k in ngram_join.shingle_keys(values, bits).tolist()]
        assert ngram_join.levels_by_key(keys, levels, bits)(values).tolist() == want
        assert not ngram_join.levels_by_key(keys[:0], levels[:0], bits)(values).any()


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(rng.integers(0, n // 3 + 1)) :], rng.integers(0, 2**64, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)]))
        if len(b) and ngram_join.links(len(np.intersect1d(a, b)), len(a), len(b)):
            assert ngram_join.may_link(ngram_join.sketch(a), ngram_join.sketch(b), len(a), len(b))
    a, b = (np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64)) for _ in range(2))
    assert not ngram_join.may_link(ngram_join.sketch(a), ngram_join.sketch(b), len(a), len(b))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 600), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in smallest_labels(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 600: 500}


def test_passages_are_found_after_insertions(frame):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(100))) for i in range(20)]
    rows += [(100 + i, " ".join(word() for _ in range(10 + 7 * i)) + " " + passage + " " + " ".join(word() for _ in range(9))) for i in range(10)]
    rows += [(300, None), (301, ""), (302, "x" * 60000), (303, "own " * 300)]
    spans = chunks.repeated_spans(frame(rows)).collect()
    assert {r["doc_id"] for r in spans} == set(range(100, 110))
    for r in spans:
        text = dict(rows)[r["doc_id"]].encode()
        assert text[r["start"] : r["end"]].decode() in passage + " " or len(text[r["start"] : r["end"]]) < len(passage) + 40
        assert r["copies"] == 10 and r["first_doc_id"] == 100 and r["duplicate"] == (r["doc_id"] != 100)
    assert chunks.repeated_spans(frame(rows).filter("doc_id < 0")).count() == 0


def test_all_short_passages_are_found(frame):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    rows, at = [], {}
    for i in range(300):
        passage = words(51 + i % 10)
        for k in range(2):
            before = words(rng.randrange(0, 40)) + " "
            at[2 * i + k] = (len(before), len(before) + len(passage))
            rows.append((2 * i + k, before + passage + " " + words(rng.randrange(0, 40))))
    spans = chunks.repeated_spans(frame(rows)).collect()
    assert sorted(r["doc_id"] for r in spans) == sorted(at)
    for r in spans:
        a, b = at[r["doc_id"]]
        assert a - 1 <= r["start"] < r["end"] <= b + 1 and r["end"] - r["start"] >= chunks.MIN_BYTES


def test_rows_of_equal_or_null_ids_are_documents_of_their_own(frame):
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n))
    long, shared = words(200), words(80)
    rows = [(1, long), (1, long), *((None, words(30) + " " + shared + " " + words(30)) for _ in range(5)), (None, words(100)), (2, words(100))]
    got = sorted((r["doc_id"] or 0, r["start"], r["end"], r["copies"], r["first_doc_id"], r["duplicate"]) for r in chunks.repeated_spans(frame(rows)).collect())
    assert [g for g in got if g[0]] == [(1, 0, len(long), 2, 1, False), (1, 0, len(long), 2, 1, True)]
    nulls = [g for g in got if not g[0]]
    assert len(nulls) == 5 and all(g[3:5] == (5, -1) for g in nulls) and [g[5] for g in nulls].count(False) == 1
    assert all(len(shared) - 80 < g[2] - g[1] <= len(shared) + 2 for g in nulls)


def test_cuts_are_close_and_local():
    rng = np.random.default_rng(10)
    data = rng.integers(97, 123, 20000).astype(np.uint8)
    ends = chunks.cut_points(data)
    assert np.diff(ends[:-1]).max() <= chunks.WINNOW and 25 < len(data) / len(ends) < 40
    again = chunks.cut_points(np.append(rng.integers(97, 123, 77).astype(np.uint8), data))
    assert set(ends[ends >= 80].tolist()) == set((again[again >= 157] - 77).tolist())
    assert len(chunks.cut_points(np.full(60000, 120, np.uint8))) < 100


def test_chunks_tile_each_text(frame):
    rows = [(1, "abc " * 5000), (2, "é" * 4000), (3, "z")]
    got = defaultdict(list)
    for r in chunks.text_chunks(frame(rows).select("doc_id", "text")).collect():
        got[r["doc_id"]].append((r["start"], r["length"]))
    for i, t in rows:
        at = 0
        for s, n in sorted(got[i]):
            assert s == at and 0 < n <= chunks.MAX
            at += n
        assert at == len(t.encode())


def brute_spans(rows, low=chunks.MIN_BYTES):
    """Repeats by comparing whole chunks byte by byte, cuts taken one by one."""
    found = defaultdict(list)
    for i, text in rows:
        raw = text.encode()
        ends = chunks.cut_points(np.frombuffer(raw, np.uint8)).tolist() if raw else []
        places = [0, *ends[:-1]][: len(ends)]
        if places:
            places[-1] = max(0, len(raw) - low)
        for a in places:
            far = [e for e in ends if e >= a + low]
            if far:
                found[raw[a : min(far[0], a + low + chunks.WINNOW)]].append((i, a))
    spans = set()
    for i, _ in rows:
        own = sorted((a, a + len(c), len(p), min(p)) for c, p in found.items() if len({d for d, _ in p}) > 1 for d, a in p if d == i)
        while own:
            run = [own.pop(0)]
            while own and own[0][0] <= max(r[1] for r in run):
                run.append(own.pop(0))
            dup = any(first != (i, a) for a, _, _, first in run)
            spans.add((i, run[0][0], max(r[1] for r in run), len(run), max(r[2] for r in run), min(r[3][0] for r in run), dup))
    return spans


def test_spans_equal_brute_force(frame):
    rng = random.Random(12)
    words = lambda n, of="abcdefghij": " ".join("".join(rng.choice(of) for _ in range(rng.randrange(2, 9))) for _ in range(n))
    shared = [words(n) for n in (20, 30, 45, 51, 70, 120)] + ["ha " * 90, "é" * 150, "over and over " * 40]
    rows = [(i, " ".join(rng.choice([words(rng.randrange(1, 40)), rng.choice(shared)]) for _ in range(rng.randrange(0, 6)))) for i in range(120)]
    rows += [(200, shared[3]), (201, shared[3]), (202, shared[5][:100]), (203, shared[5][:100]), (204, ""), (205, "short"), (206, "short")]
    got = {(r["doc_id"], r["start"], r["end"], r["chunks"], r["copies"], r["first_doc_id"], r["duplicate"]) for r in chunks.repeated_spans(frame(rows)).collect()}
    assert got == brute_spans(rows) and len(got) > 100
    lengths = {r["end"] - r["at"] for r in chunks.text_chunks(frame(rows).select("doc_id", "text")).filter("digest IS NOT NULL").collect()}
    assert len(lengths) > 40 and min(lengths) >= chunks.MIN_BYTES and max(lengths) <= chunks.MIN_BYTES + chunks.WINNOW


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog, twice and more", np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) % 2**32
        want.append(h)
    assert chunks.gear_hash(data).tolist() == want


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(900)]
    rows += [(i, rows[i - 900][1]) for i in range(900, 950)]  # ties
    rows += [(950, None), (951, []), (952, [float("nan")] * 8), (953, [None] + [0.0] * 7), (1000, [float("inf")] * 8), (1050, [0.0] * 8), (None, [0.1] * 8), (1100, [0.5] * 3), (100, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, row int, block string").repartition(4)
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in ok:
        if q % 50 == 0:
            want += [(q, -s, i) for s, i in sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b))[:5]] if q != 100 else []
    got = [(r["query_id"], r["score"], r["vec_id"]) for r in topk.top_k_of_embeddings(df).collect() if r["query_id"] != 100]
    assert sorted(got) == sorted(want)
    assert topk.top_k_of_embeddings(df.filter("vec_id < 0")).count() == 0


def test_top_k_evaluates_few_when_bounds_are_tight():
    rng = np.random.default_rng(2)
    rows = np.repeat(rng.integers(-100, 100, (40, 4)), 100, axis=0) + rng.integers(-2, 3, (4000, 4))
    basis = topk.pivot_basis(topk.choose_pivots(rows.astype(float), 3))
    block = lambda at: topk.Block(at.astype(np.int64).tobytes(), rows[at].astype(np.int64).tobytes(), 4, basis)
    got, seen = topk.block_top(block(np.arange(3)), block(np.arange(4000)), 5, np.full(3, -np.inf))
    for q in range(3):
        score = rows @ rows[q]
        want = sorted((-int(s), i) for i, s in enumerate(score) if i != q)[:5]
        assert [(-s, i) for a, i, s in got if a == q] == want
    assert seen < 0.3 * 3 * 4000


def test_top_k_of_very_large_integers():
    rng = np.random.default_rng(4)
    rows = rng.integers(-(2**60), 2**60, (60, 4))
    block = lambda at: topk.Block(at.astype(np.int64).tobytes(), rows[at].tobytes(), 4, topk.pivot_basis(rows[:3].astype(float)))
    got, _ = topk.block_top(block(np.arange(5)), block(np.arange(60)), 5, np.full(5, -np.inf))
    for q in range(5):
        want = sorted((-sum(int(x) * int(y) for x, y in zip(rows[q], r, strict=True)), i) for i, r in enumerate(rows) if i != q)[:5]
        assert [(-s, i) for a, i, s in got if a == q] == want
