"""Operator 3: Jaccard join on word shingles, size-aware with light and heavy sets.

Every document becomes the set of its distinct 5-word shingles (64-bit hashes). Equal sets form one
class. All sets order their shingles by one global order, rare before frequent. Two sets that link
share at least ``o = ceil(0.8 n)`` shingles of either size ``n``, hence at least ``c`` of the first
``n - o + c`` of both. Light sets (up to a boundary) enumerate all ``c = 2`` subsets of that prefix
and meet where a subset is equal. Heavy sets put the single shingles (``c = 1``) of their prefix on
inverted lists and scan those; light sets that a heavy one may reach are on the lists too. The
boundary is the size at which the summed cost of subsets and of list scans is least.

Lists are resolved without pairing all members: a few leaders of each list are verified against the
rest, linked members share a label, and only members of a list that still differ in label are
compared further: block against block of the list. Nothing is lost: any two sets that link meet in
a list. Members are first held against each other by small sketches, which bound the intersection
from above; what they leave is verified on the whole sets.

A document without words is linked with nothing; its set is empty. Null texts count as empty, null
ids get a row with null ``component_id``. The order of frequent shingles is held for at most
``FREQUENT`` shingles (this steers cost, not results). Hashes of 64 bits stand for the shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, cut_narrow, give_back, id_text, map_texts, mix, pieces, ship, span_hashes
from .components import smallest_labels

WORDS = 5
FREQUENT = 1 << 18
MIN_DF = 8
LEADERS = 8
BLOCK = 512
ELEMENTS = 1 << 20
TEXT_RUN = 1 << 18
LONG_WORD = 64
SPACES = bytes(c == 32 or 9 <= c <= 13 for c in range(256))
BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
SPACE_AFTER = np.array([*[32 << 8 * k for k in range(8)], 0], np.uint64)
STEP = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``, eight bytes at a time; at least eight more follow the last word.

    A word is read with one space at its end, which no word holds; so words below eight bytes never meet. Those of
    ``LONG_WORD`` bytes on are left to ``span_hashes``, whose time does not depend on the longest of them.
    """
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)

    def read(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        left = np.minimum(left, 8)
        return (eight[at].view("<u8").ravel() & BYTES[left]) | SPACE_AFTER[left]

    size = ends - starts
    h, some = mix(read(starts, size)), np.flatnonzero(size >= 8)
    for k in range(8, LONG_WORD, 8):
        if not len(some):
            return h
        h[some] = mix((h[some] + np.uint64(k)) * STEP + read(starts[some] + k, size[some] - k))
        some = some[size[some] >= k + 8]
    h[some] = span_hashes(data, starts[some], ends[some])
    return h


def combined(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of sequences of words: ``parts[k]`` has the hash of word ``k`` of each."""
    total = np.full(len(parts[0]), len(parts), np.uint64)
    for h in parts:
        total += h
        total *= STEP
        total ^= total >> np.uint64(29)
    return mix(total)


def shingle_sets(texts: list[str], words: int = WORDS, most: int = TEXT_RUN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sets of the texts, in order, in runs of about ``most`` characters: hashes, bounds and the classes of the sets.

    Set ``i`` of a run is ``hashes[bounds[i] : bounds[i + 1]]``, sorted and distinct.
    """
    for a, b in pieces(map(len, texts), most):
        coded = [t.encode("utf-8", "replace").lower() for t in texts[a:b]]
        joined = b" ".join([b"", *coded, b" " * 8])
        space = np.frombuffer(joined.translate(SPACES), np.uint8)
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        h = word_hashes(np.frombuffer(joined, np.uint8), starts, ends)
        first = np.searchsorted(starts, np.cumsum([0, *[len(c) + 1 for c in coded]]))
        n = np.diff(first)  # words of each text
        count = np.where(n > words, n - words + 1, np.minimum(n, 1))
        bounds = np.append(0, np.cumsum(count))
        out = np.zeros(bounds[-1], np.uint64)
        if len(h) >= words:
            last = len(h) - words + 1
            place = np.repeat(first[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
            out = combined([h[k : k + last] for k in range(words)]).take(place, mode="clip")
        for size in range(1, words):  # the whole text is one
            short = np.flatnonzero(n == size)
            if len(short):
                out[bounds[short]] = combined([h[first[short] + k] for k in range(size)])
        ends_at = bounds.tolist()
        for i in range(b - a):
            out[ends_at[i] : ends_at[i + 1]].sort()
        keep = np.append(True, out[1:] != out[:-1])[: len(out)]
        keep[bounds[:-1][count > 0]] = True
        out, bounds = out[keep], np.append(0, np.cumsum(keep))[bounds]
        yield out, bounds, classes_of(out, bounds)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    return next(shingle_sets([text], words))[0]


def classes_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Identifiers of the sets ``values[bounds[i] : bounds[i + 1]]`` as signed 64-bit numbers; 0 for an empty one."""
    size = np.diff(bounds)
    out = np.zeros(len(size), np.uint64)
    if len(values):
        out[size > 0] = np.bitwise_xor.reduceat(mix(values + np.repeat(size, size).astype(np.uint64)), bounds[:-1][size > 0])
    return out.view(np.int64)


def class_of(s: np.ndarray) -> int:
    """Identifier of one set."""
    return int(classes_of(s, np.array([0, len(s)]))[0])


def common_of(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sets."""
    both = np.sort(np.concatenate([x, y]))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def needed(n: np.ndarray | int):
    """Least overlap of a set of size ``n`` with a set it links to."""
    return (4 * n + 4) // 5


def links(common: int, a: int, b: int) -> bool:
    return 100 * common >= 80 * (a + b - common)


def sketch(s: np.ndarray) -> bytes:
    """How many hashes of the set fall in each of 2**k cells (one or two on average), at most 255."""
    if not len(s):
        return b""
    k = len(s).bit_length() - 1
    cell = (s >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(s), np.int64)
    return np.minimum(np.bincount(cell, minlength=1 << k), 255).astype(np.uint8).tobytes()


def may_link(x: bytes, y: bytes, a: int, b: int) -> bool:
    """False only if the sketches prove that sets of sizes ``a`` and ``b`` do not link.

    The sum of the smaller counts of each cell bounds the intersection from above.
    """
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if (p == 255).any() or (q == 255).any():
        return True
    n = min(len(p), len(q))
    most = np.minimum(p.reshape(n, -1).sum(1), q.reshape(n, -1).sum(1)).sum()
    return links(int(most), a, b)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as byte planes of their differences, which Spark's codec shrinks well."""
    gaps = np.diff(values, prepend=values[:1] * 0).astype("<u4")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint64).astype(np.uint32)


def by_bucket(values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Buckets (top ``bits`` bits) of sorted 64-bit values with their ranges."""
    top = (values >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.searchsorted(top, np.arange((1 << bits) + 1))
    for b in range(1 << bits):
        if edges[b] < edges[b + 1]:
            yield b, int(edges[b]), int(edges[b + 1])


def low(values: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits below the bucket's."""
    return ((values << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def shingle_keys(values: np.ndarray, bits: int) -> np.ndarray:
    """Bucket and the 32 bits below it as one number."""
    return values >> np.uint64(32 - bits)


def frequent_shingles(docs: DataFrame, bits: int, min_df: int = MIN_DF, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, float]:
    """Keys and levels of the most frequent shingles, and postings for each distinct shingle.

    Every set is counted (equal sets of a batch once). A bucket gets from each batch its distinct
    shingles and, apart, the counts above one; so a common shingle is one entry for each batch.
    """

    def make(texts: list[str]) -> tuple[dict, np.ndarray]:
        seen: dict[int, np.ndarray] = {}
        for found, bounds, classes in shingle_sets(texts):
            for c, lo, hi in zip(classes.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if c not in seen:
                    seen[c] = found[lo:hi]
        values, n = np.unique(np.concatenate(list(seen.values())), return_counts=True)
        out: dict[str, list] = {"bucket": [], "keys": [], "more": []}
        for b, lo, hi in by_bucket(values, bits):
            keys = low(values[lo:hi], bits)
            many = np.flatnonzero(n[lo:hi] > 1)
            out["bucket"].append(b)
            out["keys"].append(pack_sorted(keys))
            out["more"].append(np.stack([keys[many], (n[lo:hi][many] - 1).astype(np.uint32)]).tobytes())
        return out, np.zeros(len(out["bucket"]), np.int64)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_sorted(x) for x in pdf["keys"]])
        more = np.concatenate([np.frombuffer(x, np.uint32).reshape(2, -1) for x in pdf["more"]], axis=1)
        value, n = np.unique(keys, return_counts=True)
        extra, where = np.unique(more[0], return_inverse=True)
        n[np.searchsorted(value, extra)] += np.bincount(where, more[1], minlength=len(extra)).astype(n.dtype)
        keep = n >= min_df
        key = (int(pdf["bucket"].iloc[0]) << 32) + value[keep].astype(np.int64)
        return pd.DataFrame({"key": np.append(key, -1), "df": np.append(n[keep], n.sum()), "distinct": np.append(np.zeros(len(key), np.int64), len(value))})

    sent = map_texts(docs, make, "bucket int, keys binary, more binary").drop("doc_id")
    counted = cut(sent.groupBy("bucket").applyInPandas(count, "key long, df long, distinct long"))
    totals = counted.filter("key < 0").agg(F.sum("df"), F.sum("distinct")).first()
    level = F.floor(F.log2("df")).cast("int")
    sizes = counted.filter("key >= 0").groupBy(level.alias("level")).count().collect()  # at most 64 rows
    room, least = most, 64
    for r in sorted(sizes, key=lambda r: -r["level"]):
        if r["count"] > room:
            break
        room, least = room - r["count"], r["level"]
    found = counted.filter((F.col("key") >= 0) & (level >= least)).select("key", level.alias("level")).toPandas()  # at most ``most`` rows
    found = found.sort_values("key")
    return found["key"].to_numpy(np.uint64), found["level"].to_numpy(np.uint8), (totals[0] or 0) / max(1, totals[1] or 0)


def choose_boundary(sizes: dict[int, int], scan: float, most: int = 64) -> int:
    """The size up to which sets are light: least total of subsets enumerated and postings scanned."""
    best, choice = None, 0
    for x in range(1, most + 1):
        cost = 0.0
        for n, sets in sizes.items():
            single = n - needed(n) + 1
            if n <= x:
                cost += sets * (single + 1) * single / 2
                if 5 * n >= 4 * (x + 1):
                    cost += sets * single * (1 + scan)
            else:
                cost += sets * single * (1 + scan)
        if best is None or cost < best:
            best, choice = cost, x
    return choice


def levels_by_key(keys: np.ndarray, levels: np.ndarray, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    """The level of each shingle, 0 where it is not among ``keys``.

    A table of the first bits of all keys settles most shingles, so few are searched for.
    """
    shift = np.uint64(max(0, 32 + bits - 21))
    marked = np.zeros(1 << 21, bool)
    marked[keys >> shift] = True

    def level_of(values: np.ndarray) -> np.ndarray:
        key = shingle_keys(values, bits)
        out = np.zeros(len(key), np.uint8)
        some = np.flatnonzero(marked[key >> shift])
        if len(some):
            key = key[some]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            out[some] = np.where(keys[at] == key, levels[at], 0)
        return out

    return level_of


def signatures(s: np.ndarray, level: np.ndarray, boundary: int) -> np.ndarray:
    """Hashes of the subsets (light) or single shingles (heavy, or in their reach) of the prefix."""
    n = len(s)
    if n < 2:
        return np.zeros(0, np.uint64)
    first = s[np.lexsort((s, level))[: n - needed(n) + 2]]
    out = []
    if n <= boundary:
        i, j = np.triu_indices(len(first), 1)
        out.append(mix(first[i] * STEP + first[j]))
    if n > boundary or 5 * n >= 4 * (boundary + 1):
        out.append(first[:-1])
    return np.concatenate(out)


def candidate_lists(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], boundary: int, bits: int) -> DataFrame:
    """``sig, node, n``: members of the lists that hold two classes at least.

    A batch sends one posting for each of its signatures; the members of a signature that it holds
    several of are listed by the batch itself. So no list is gathered in one place.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def make(texts: list[str]) -> tuple[dict, np.ndarray]:
        level_of = levels_by_key(*shared.value, bits)
        seen: dict[int, int] = {}
        sizes, sigs = [], []
        for found, bounds, classes in shingle_sets(texts):
            level = level_of(found)
            for c, lo, hi in zip(classes.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if c in seen or hi - lo < 2:
                    continue
                seen[c] = len(sizes)
                sizes.append(hi - lo)
                sigs.append(signatures(found[lo:hi], level[lo:hi], boundary))
        nodes = np.array(list(seen), np.int64)
        sizes = np.array(sizes, np.int32)
        out: dict[str, list] = {"bucket": [], "keys": [], "owners": [], "nodes": []}
        if len(nodes):
            sig = np.concatenate(sigs)
            owner = np.repeat(np.arange(len(sigs), dtype=np.uint32), [len(x) for x in sigs])
            order = np.argsort(sig, kind="stable")
            sig, owner = sig[order], owner[order]
            fresh = np.append(True, sig[1:] != sig[:-1])
            again = ~fresh | np.append(~fresh[1:], False)
            out["bucket"].append(-1)
            out["keys"].append(shingle_keys(sig[again], bits).tobytes())
            out["owners"].append(owner[again].tobytes())
            out["nodes"].append(np.rec.fromarrays([nodes, sizes], names="node,n").tobytes())
            sig, owner = sig[fresh], owner[fresh]
            for b, lo, hi in by_bucket(sig, bits):
                out["bucket"].append(b)
                out["keys"].append(pack_sorted(low(sig[lo:hi], bits)))
                out["owners"].append(owner[lo:hi].tobytes())
                out["nodes"].append(None)
        out["batch"] = [(TaskContext.get().partitionId() << 40) + made[0]] * len(out["bucket"])
        made[0] += 1
        return out, np.zeros(len(out["bucket"]), np.int64)

    made = [0]
    sent = cut(map_texts(docs, make, "bucket int, keys binary, owners binary, nodes binary, batch long").drop("doc_id"))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack_sorted(x) for x in pdf["keys"]])
        owners = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["owners"]])
        batch = np.repeat(pdf["batch"].to_numpy(), [len(x) // 4 for x in pdf["owners"]])
        order = np.argsort(keys, kind="stable")
        keys, owners, batch = keys[order], owners[order], batch[order]
        same = keys[1:] == keys[:-1]
        again = np.append(False, same) | np.append(same, False)
        sig = (int(pdf["bucket"].iloc[0]) << 32) + keys[again].astype(np.int64)
        return pd.DataFrame({"sig": sig, "batch": batch[again], "owner": owners[again].astype(np.int64)})

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                owner = np.frombuffer(r.owners, np.uint32).astype(np.int64)
                yield pd.DataFrame({"sig": np.frombuffer(r.keys, np.uint64).astype(np.int64), "batch": r.batch, "owner": owner})

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                table = np.frombuffer(r.nodes, np.dtype([("node", np.int64), ("n", np.int32)]))
                yield pd.DataFrame({"b": r.batch, "o": np.arange(len(table)), "node": table["node"], "n": table["n"]})

    listed = "sig long, batch long, owner long"
    own = sent.filter("bucket < 0")
    across = sent.filter("bucket >= 0").select("bucket", "keys", "owners", "batch").groupBy("bucket").applyInPandas(meet, listed)
    rows = across.union(own.select("keys", "owners", "batch").mapInPandas(members, listed))
    names = own.select("nodes", "batch").mapInPandas(expand, "b long, o long, node long, n int")
    found = rows.join(names, (F.col("batch") == F.col("b")) & (F.col("owner") == F.col("o"))).select("sig", "node", "n").distinct()
    found = cut_narrow(found)
    # Only members with another one of a fitting size stay. Sizes that may link lie in the same
    # or in neighbouring classes of a little more than a quarter; two members are compared exactly.
    kind = F.floor(F.log("n") / F.log(F.lit(1.26))).cast("int")
    marks = {f"x{i}": F.bit_xor(F.xxhash64("node", F.lit(i))) for i in range(2)}
    sizes = found.groupBy("sig", kind.alias("kind")).agg(F.count("*").alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi"), *[c.alias(x) for x, c in marks.items()])
    held = sizes.groupBy("sig").agg(
        F.sum("k").alias("k"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.map_from_entries(F.collect_list(F.struct("kind", "k"))).alias("kinds"),
        *[F.bit_xor(x).alias(x) for x in marks],
    ).filter("k > 2 OR (k = 2 AND 5 * lo >= 4 * hi)")
    # Of lists with the same members (number and two hashes) one is enough.
    held = held.groupBy("k", *marks).agg(F.min("sig").alias("sig"), F.min_by("kinds", "sig").alias("kinds"))
    near = [F.try_element_at("kinds", kind + d) for d in (-1, 0, 1)]
    fits = near[0].isNotNull() | (near[1] > 1) | near[2].isNotNull()
    return cut_narrow(found.join(held.select("sig", "kinds"), "sig").filter(fits).select("sig", "node", "n"))


def possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that their sketches do not rule out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [may_link(x, y, m, n) for x, y, m, n in zip(pdf["x"], pdf["y"], pdf["m"], pdf["n"], strict=True)]
            yield pdf.loc[keep, ["a", "b"]]

    left = classes.select(F.col("node").alias("a"), F.col("cells").alias("x"), F.col("n").alias("m"))
    right = classes.select(F.col("node").alias("b"), F.col("cells").alias("y"), "n")
    return cut_narrow(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "m", "n").mapInPandas(run, "a long, b long"))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole sets link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["x"], pdf["y"], strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(links(common_of(p, q), len(p), len(q)))
            yield pdf.loc[keep, ["a", "b"]]

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = sets_of(docs, classes.join(wanted, "node").select("node", F.col("first").alias("id")))
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return cut_narrow(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long").distinct())


def near_rows(cells: list[bytes], sizes: np.ndarray, labels: np.ndarray, sides: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of side 0 with the rows of side 1 that have another label and may link with it.

    Sketches of equal length form a matrix. A size that may link is at most 1.25 times as large,
    so a sketch meets only those of its own length and, added up in twos, of the next ones.
    """
    length = np.array([len(c) for c in cells])
    full = {}
    for n in np.unique(length[sides == 1]):
        at = np.flatnonzero((sides == 1) & (length == n))
        full[int(n)] = at, np.stack([np.frombuffer(cells[i], np.uint8) for i in at])
    for i in np.flatnonzero(sides == 0):
        x = np.frombuffer(cells[i], np.uint8)
        hits = []
        for n in (len(x) // 2, len(x), len(x) * 2):
            if n not in full:
                continue
            at, others = full[n]
            fit = np.flatnonzero((5 * np.minimum(sizes[at], sizes[i]) >= 4 * np.maximum(sizes[at], sizes[i])) & (labels[at] != labels[i]))
            if not len(fit):
                continue
            some, k = others[fit], min(n, len(x))
            unsure = (some == 255).any(axis=1) | (x == 255).any()
            p, q = x, some
            if len(x) != n:
                p, q = x.reshape(k, -1).sum(1, dtype=np.uint16), some.reshape(len(some), k, -1).sum(2, dtype=np.uint16)
            most = np.minimum(q, p).sum(1, dtype=np.int64)
            keep = unsure | (100 * most >= 80 * (sizes[at][fit] + sizes[i] - most))
            hits.append(at[fit[keep]])
        if hits:
            yield i, np.concatenate(hits)


def blocks_of_lists(rest: DataFrame, block: int) -> DataFrame:
    """``sig, node, n, label, i, j, own``: every member in each pair of blocks of its list that holds it.

    A block has about ``block`` members and at most about ``ELEMENTS`` shingles.
    """
    size = rest.groupBy("sig").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / ELEMENTS)).cast("int").alias("blocks"))
    placed = rest.join(size, "sig").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("sig", "node", "n", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")


def dealt(met: DataFrame, most: int) -> DataFrame:
    """The rows with a ``task``: block pairs are dealt to tasks of about ``most`` shingles."""
    total = met.agg(F.sum("n")).first()[0] or 0
    return met.withColumn("task", F.pmod(F.xxhash64("sig", "i", "j"), F.lit(1 + total // most)))


def block_pairs(pdf: pd.DataFrame, cells: list[bytes]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """For each member of a pair of blocks: rows of the pair, its number, numbers of its possible partners."""
    for (_, i, j), at in pdf.groupby(["sig", "i", "j"], sort=False).indices.items():
        n, label = (pdf[c].to_numpy(np.int64)[at] for c in ("n", "label"))
        here, side = [cells[k] for k in at], (pdf["own"].to_numpy()[at] != i).astype(np.int8)
        k = len(at)
        if i == j:  # every member on both sides; each pair comes once
            n, label, here, side = np.tile(n, 2), np.tile(label, 2), here * 2, np.repeat([0, 1], k)
        for row, others in near_rows(here, n, label, side):
            others = others[others - k > row] - k if i == j else others
            if len(others):
                yield at, int(row), others


def linked_in_lists(rest: DataFrame, docs: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """``a, b``: links between members of one list and different labels, enough to connect all that link.

    A list is cut into blocks; a task compares two blocks (or one with itself) by matrix operations.
    First the sketches name the members with a possible partner. Only their sets are sent, once for
    each pair of blocks, and compared exactly; links within what a task has connected already add
    nothing. So both steps return no more rows than they read, and what a task holds is bounded.
    """

    def candidates(pdf: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(pdf), bool)
        for at, row, others in block_pairs(pdf, pdf["cells"].tolist()):
            hit[at[row]] = True
            hit[at[others]] = True
        return pdf.loc[hit, ["sig", "node", "n", "label", "i", "j", "own"]]

    def connect(pdf: pd.DataFrame) -> pd.DataFrame:
        items = [np.frombuffer(x, np.uint64) for x in pdf["items"]]
        node, label = pdf["node"].to_numpy(np.int64), pdf["label"].tolist()
        parent = {x: x for x in label}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for at, row, others in block_pairs(pdf, [sketch(x) for x in items]):
            x = items[at[row]]
            for k in at[others].tolist():
                p, q = root(label[at[row]]), root(label[k])
                if p == q:
                    continue
                if links(common_of(x, items[k]), len(x), len(items[k])):
                    parent[q] = p
                    found.append((node[at[row]], node[k]))
        return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    met = dealt(blocks_of_lists(rest, block), 4 * ELEMENTS).join(classes.select("node", "cells"), "node")
    kept = cut_narrow(met.groupBy("task").applyInPandas(candidates, "sig long, node long, n long, label long, i int, j int, own int"))
    wanted = kept.select("node").distinct()
    sets = sets_of(docs, classes.join(wanted, "node").select("node", F.col("first").alias("id"))).dropDuplicates(["node"])
    whole = dealt(kept, ELEMENTS).join(sets, "node")
    return cut_narrow(whole.groupBy("task").applyInPandas(connect, "a long, b long"))


def resolve(lists: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, label`` of the classes that link with another one."""
    spark = lists.sparkSession
    rows = lists.count()
    found = spark.createDataFrame([], "a long, b long")
    fits = (5 * F.least("n", "m") >= 4 * F.greatest("n", "m")) & (F.col("a") != F.col("b"))
    labels = spark.createDataFrame([], "node long, label long")
    before = None
    while rows:
        # The leaders of a list come first in LEADERS random orders of all sets, the same in every list.
        orders = [F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(k))) for k in range(LEADERS)]
        first = cut_narrow(lists.groupBy("sig").agg(F.array_distinct(F.array(*orders)).alias("leaders")))
        star = lists.join(first, "sig").select(F.explode("leaders").alias("first"), F.col("node").alias("b"), "n")
        star = star.select(F.least("first.node", "b").alias("a"), F.greatest("first.node", "b").alias("b"), F.col("first.n").alias("m"), "n")
        star = possible(star.filter(fits).select("a", "b").distinct(), classes)
        found = cut_narrow(found.union(verified(star, docs, classes)))
        labels = smallest_labels(found)
        marked = lists.join(labels, "node", "left").select("sig", "node", "n", F.coalesce("label", "node").alias("label"))
        open_lists = marked.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("sig")
        # The leaders have been compared with all others, so they leave the list.
        led = F.exists("leaders", lambda x: x["node"] == F.col("node"))
        rest = cut_narrow(marked.join(open_lists, "sig").join(first, "sig").filter(~led).drop("leaders"))
        by_label = rest.groupBy("sig", "label").agg(F.count("*").alias("k")).groupBy("sig").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
        pairs = by_label.agg(F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2)).first()[0] or 0
        if not pairs:
            return labels
        # Leaders go on while each round at least halves what is open and much is left of it.
        if pairs <= 4 * BLOCK * rows or (before is not None and 2 * pairs > before):
            return smallest_labels(cut_narrow(found.union(linked_in_lists(rest, docs, classes, BLOCK))))
        before = pairs
        lists = rest.select("sig", "node", "n")
        rows = lists.count()
    return labels


def document_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n, node, cells``: size, class and sketch of each document's set."""

    def make(texts: list[str]) -> tuple[dict, None]:
        out: dict[str, list] = {"n": [], "node": [], "cells": []}
        for found, bounds, classes in shingle_sets(texts):
            out["n"] += np.diff(bounds).tolist()
            out["node"] += classes.tolist()
            out["cells"] += [sketch(found[lo:hi]) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        return out, None

    return cut(map_texts(docs, make, "n long, node long, cells binary"))


BLOOM_WORDS = 1 << 18  # 64 bits each: two megabytes, however many ids


def bloom(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the column ``id``, its words made by a bitwise sum."""
    marks = [F.xxhash64("id", F.lit(k)) for k in range(3)]
    bit = F.explode(F.array(*[F.struct(F.pmod(h, F.lit(BLOOM_WORDS)).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")).alias("bits")) for h in marks]))
    words = ids.select(bit.alias("m")).groupBy("m.word").agg(F.bit_or("m.bits").alias("bits")).toPandas()
    table = np.zeros(BLOOM_WORDS, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, items``: the sets of the classes in ``wanted`` (``node, id``), made again from one document of each.

    A Bloom filter leaves out nearly all other documents where the texts are read, so no text is
    moved; the join after it is exact. Rows repeated with one id and text give a set twice.
    """
    wanted = cut_narrow(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(bloom(wanted))
    marks = [F.xxhash64("doc_id", F.lit(k)) for k in range(3)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            hit = np.ones(batch.num_rows, bool)
            for k in range(3):
                h = batch.column(f"h{k}").to_numpy()
                hit &= (table[h % BLOOM_WORDS] >> ((h >> 32) % 64)) & 1 == 1
            some = batch.filter(pa.array(hit))
            if some.num_rows:
                nodes, items = [], []
                for found, bounds, classes in shingle_sets(some.column("text").to_pylist()):
                    nodes += classes.tolist()
                    items += [found[lo:hi].tobytes() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                columns = [some.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(items, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "items"])
        give_back()

    ship(docs.sparkSession)
    hashed = docs.select("doc_id", "text", *[h.alias(f"h{k}") for k, h in enumerate(marks)])
    made = hashed.mapInArrow(run, "id long, node long, items binary")
    return cut_narrow(made.join(wanted, ["node", "id"]).select("node", "items"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    docs = id_text(df, id_col, text_col)
    bits = max(3, min(20, (2 * docs.rdd.getNumPartitions() - 1).bit_length()))
    every = document_sets(docs)
    worded = every.filter("n > 0 AND doc_id IS NOT NULL")
    classes = cut(worded.groupBy("node").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("cells").alias("cells")))
    known = docs.filter("doc_id IS NOT NULL")
    keys, levels, scan = frequent_shingles(known, bits)
    sizes = {r["size"]: r["count"] for r in classes.groupBy(F.least("n", F.lit(65)).alias("size")).count().collect()}
    lists = candidate_lists(known, (keys, levels), choose_boundary(sizes, scan), bits)
    labels = resolve(lists, known, classes)
    named = classes.drop("cells").join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))
    lowest = named.groupBy("label").agg(F.min("first").alias("component"))
    component = named.join(lowest, "label").select("node", "component")
    out = every.drop("cells").join(component, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
