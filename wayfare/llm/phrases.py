"""Operator 13: collocations by HAT-trie counting.

Words get numbers in the task. A task counts the phrases of its texts in a trie that is shallow in word
numbers and ends in hash containers: a container that grows beyond ``BURST`` entries bursts into one
for each second word. When the trie holds more than ``HELD`` entries, whole subtrees of a first word are
spilled, the largest first, as sorted runs. Runs are dealt out by language and prefix (the first three
words of a phrase) and merged, each prefix partition by itself.

Counting goes by length, as a phrase cannot be more frequent than its parts: two words are counted where
both are frequent, three and four where all pairs in them are. What is frequent is known from a
Bloom filter of at most ``FILTER_BITS`` bits, made from all frequent phrases of the length before. Besides,
while a pass counts one length it adds up the next one over the whole corpus by ``KEY_BITS`` of its hash, and
a phrase whose sum stays rare is rare. Only sums above zero are kept (:class:`Sums`, some three bytes each), so they
grow with the input and never fill up. Neither ever rules a frequent phrase out, and what they let
through besides costs counting only, so no candidate is lost at any size.

Everything is per language. Null texts are empty, a null language is ``und`` (that language's own rows
join it). Texts of any length are cut in blocks at words, with the last three words carried over; repeated
rows count each time; ids are not read, so null ones count as well. An empty table gives no rows. Ties go
as in the order of the result (score and count descending, phrase ascending).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, removed, ship, stored_at

LONGEST = 4
BURST = 4096
HELD = 200_000
BLOCK = 1 << 21
SLICE = 256
FILTER_BITS = 1 << 28
BITS_A_PHRASE, PROBES = 16, 5
BUCKET_BITS = 24
BUCKETS, CHUNK, SALTS = 1 << BUCKET_BITS, 1 << 16, 4
KEY_BITS, PLACE_BITS = 36, 26  # of a hash; those that tell apart what lies in one row of sums
SUMMED = 1 << 20
WIDTH = 21  # bits of a word number: a block of BLOCK bytes and HELD words before it stay below
MASK = (1 << WIDTH) - 1
BREAK = 0

# Signs that end a piece, and how bytes are read. No UTF-8 text holds the byte of a break.
BREAKS = b".,;:!?\n\x0b\x0c\r"
PAUSE = b"\xff"
TABLE = bytes(255 if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The words of all texts in blocks of bounded size; ``PAUSE`` stands between pieces."""
    whole = b"\n".join(texts).translate(TABLE)
    at = 0
    while at < len(whole):
        end = at + BLOCK
        if end < len(whole):  # cut after a space or a break
            ends = [p for p in (whole.rfind(b" ", at, end), whole.rfind(PAUSE, at, end)) if p >= 0]
            nexts = [p for p in (whole.find(b" ", end), whole.find(PAUSE, end)) if p >= 0]
            end = 1 + max(ends) if ends else 1 + min(nexts) if nexts else len(whole)
        yield whole[at:end].replace(PAUSE, b" " + PAUSE + b" ").split()
        at = end


class Words(dict):
    """Numbers of words, given out as they are met; a break is 0."""

    def __init__(self, lang: str):
        super().__init__({PAUSE: BREAK})
        self.names = [b""]
        self.seed = zlib.crc32(lang.encode())
        self.hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n

    def hashed(self) -> np.ndarray:
        """Hashes of all words by number, which depend on the language."""
        new = self.names[len(self.hashes) :]
        if new:
            found = np.fromiter((xxhash.xxh3_64_intdigest(w, self.seed) for w in new), np.uint64, len(new))
            self.hashes = np.concatenate([self.hashes, found])
        return self.hashes


class Trie:
    """Counts of phrases under their first words: containers, or once burst a container for each second word.

    A container maps the rest of a phrase, ``WIDTH`` bits a word, to its count; word numbers are at
    least 1, so rests of different lengths differ.
    """

    def __init__(self) -> None:
        self.roots: dict[int, dict] = {}
        self.burst: dict[int, dict[int, dict]] = {}
        self.held = 0

    def add(self, firsts: np.ndarray, rests: np.ndarray, shift: int, counts: np.ndarray) -> None:
        """Add different phrases, ordered by their first word; ``shift`` is the place of the second one in ``rests``."""
        edges = np.flatnonzero(np.diff(firsts)) + 1
        starts = [0, *edges.tolist()]
        for first, a, b in zip(firsts[starts].tolist(), starts, [*starts[1:], len(firsts)], strict=True):
            some, n = rests[a:b].tolist(), counts[a:b].tolist()
            if first in self.burst:
                below = self.burst[first]
                for rest, x in zip(some, n, strict=True):
                    held = below.setdefault(rest >> shift, {})
                    self.held += rest not in held
                    held[rest] = held.get(rest, 0) + x
                continue
            held = self.roots.get(first)
            if held is None:
                self.roots[first] = held = dict(zip(some, n, strict=True))
                self.held += len(held)
            else:
                before, get = len(held), held.get
                for rest, x in zip(some, n, strict=True):
                    held[rest] = get(rest, 0) + x
                self.held += len(held) - before
            if len(held) > BURST:
                self.burst[first] = below = {}
                for rest, x in self.roots.pop(first).items():
                    second = rest >> (WIDTH * ((rest.bit_length() - 1) // WIDTH))
                    below.setdefault(second, {})[rest] = x

    def spill(self, down_to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take whole subtrees out, the largest first, until at most ``down_to`` entries are left."""
        trees = {first: [held] for first, held in self.roots.items()} | {first: list(below.values()) for first, below in self.burst.items()}
        sizes = {first: sum(map(len, some)) for first, some in trees.items()}
        taken = []
        for first in sorted(sizes, key=sizes.__getitem__, reverse=True):
            if self.held <= down_to:
                break
            taken.append(first)
            self.held -= sizes[first]
            self.roots.pop(first, None)
            self.burst.pop(first, None)
        n = sum(sizes[f] for f in taken)
        rests = np.fromiter((r for f in taken for held in trees[f] for r in held), np.int64, n)
        counts = np.fromiter((x for f in taken for held in trees[f] for x in held.values()), np.int64, n)
        return np.repeat(np.array(taken, np.int64), [sizes[f] for f in taken]), rests, counts


def phrase_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from the hashes of their words, one array for each place."""
    h = parts[0]
    for part in parts[1:]:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + part)
    return h


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places of each hash in a filter of ``bits`` bits (a power of two), one row a probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.array([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a Bloom filter, given as 64-bit words, lets through."""
    at = probes(hashes, 64 * len(words))
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool).all(0)


class Buckets:
    """Sums of phrases by hash, each held at 255 once there."""

    def __init__(self) -> None:
        self.sums = np.zeros(BUCKETS, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        at, n = np.unique(hashes >> np.uint64(64 - BUCKET_BITS), return_counts=True)
        self.sums[at] = np.minimum(self.sums[at] + n, 255)


class Sums:
    """Sums of phrases by the first ``KEY_BITS`` of their hashes, each held at 255 once there, without those that are 0."""

    def __init__(self) -> None:
        self.new: list[np.ndarray] = []
        self.size = 0

    def add(self, hashes: np.ndarray) -> None:
        if len(hashes):
            self.new.append(hashes >> np.uint64(64 - KEY_BITS))
            self.size += len(hashes)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """What was added since the last call, packed: leading bits of the keys, distances of the others byte by byte, sums."""
        if not self.size:
            return
        keys, n = np.unique(np.concatenate(self.new), return_counts=True)
        self.__init__()
        n = np.minimum(n, 255).astype(np.uint8)
        lead, places = (keys >> np.uint64(PLACE_BITS)).astype(np.int64), (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        starts = [0, *(np.flatnonzero(np.diff(lead)) + 1).tolist()]
        steps = np.diff(places, prepend=0)
        steps[starts] = places[starts]
        steps = steps.astype("<u4")
        for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
            yield int(lead[a]), zlib.compress(steps[a:b].view(np.uint8).reshape(-1, 4).T.tobytes() + n[a:b].tobytes(), 1)


def unpacked(sums: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and sums of a row of :class:`Sums`."""
    parts = np.frombuffer(zlib.decompress(sums), np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(parts[:4].T).view("<u4").ravel(), dtype=np.int64), parts[4].astype(np.int64)


def key_hashes(keys: np.ndarray) -> np.ndarray:
    """What stands for keys of :class:`Sums` in a Bloom filter, which reads all 64 bits."""
    return mix(keys.astype(np.uint64))


def may_be_frequent(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have sums that are not rare, by a Bloom filter of the keys of :class:`Sums` or by one truth value a bucket."""
    if known.dtype == bool:
        return known[hashes >> np.uint64(64 - BUCKET_BITS)]
    return passes(known, key_hashes(hashes >> np.uint64(64 - KEY_BITS)))


class Counter:
    """Counts the phrases of one language in a task.

    ``known`` is empty while words are counted; for pairs it holds the filter of the frequent words and that of
    the pairs whose sums are not rare, for longer phrases those words, the filter of the frequent pairs and that of the
    sums of three words. ``buckets`` takes the next length in.
    """

    def __init__(self, lang: str, known: tuple[np.ndarray, ...], buckets: Sums | Buckets | None = None):
        self.lang, self.known, self.buckets = lang, known, buckets
        self.trie = Trie()
        self.words = Words(lang)
        self.good = np.zeros(1, bool)
        self.single = np.zeros(1, np.int64)

    def read(self, texts: list[bytes]) -> None:
        carried = np.zeros(0, np.int64)
        for block in blocks(texts):
            ids = np.fromiter(map(self.words.__getitem__, block), np.int64, len(block))
            hashes = self.words.hashed()
            if self.known:
                if len(self.good) < len(hashes):
                    self.good = np.concatenate([self.good, passes(self.known[0], hashes[len(self.good) :])])
                ids = np.where(self.good[ids], ids, BREAK)  # what holds a rare word is rare
            else:
                found = np.bincount(ids, minlength=len(hashes))
                found[: len(self.single)] += self.single
                self.single = found
            whole = np.concatenate([carried, ids])
            (self.begin, self.begin, self.pairs, self.longer)[len(self.known)](whole, len(carried), hashes)
            carried = whole[-(LONGEST - 1) :]

    def begin(self, a: np.ndarray, old: int, hashes: np.ndarray) -> None:
        """Add up the pairs that end after the first ``old`` words of ``a`` by hash."""
        at = np.flatnonzero((a[:-1] > BREAK) & (a[1:] > BREAK))
        at = at[at + 1 >= old]
        if self.buckets is not None:
            self.buckets.add(phrase_hashes([hashes[a[at]], hashes[a[at + 1]]]))

    def pairs(self, a: np.ndarray, old: int, hashes: np.ndarray) -> None:
        """Count the pairs that end after the first ``old`` words of ``a``, and add up three words by hash."""
        at = np.flatnonzero((a[:-1] > BREAK) & (a[1:] > BREAK))
        at = at[may_be_frequent(self.known[1], phrase_hashes([hashes[a[at]], hashes[a[at + 1]]]))]
        three = at[:-1][np.diff(at) == 1]
        three = three[three + 2 >= old]
        if self.buckets is not None:
            self.buckets.add(phrase_hashes([hashes[a[three + i]] for i in range(3)]))
        at = at[at + 1 >= old]
        keys, counts = np.unique(a[at] << WIDTH | a[at + 1], return_counts=True)
        if len(keys):
            self.trie.add(keys >> WIDTH, keys & MASK, 0, counts)

    def longer(self, a: np.ndarray, old: int, hashes: np.ndarray) -> None:
        """Count the phrases of three and four words that end after the first ``old`` words of ``a``."""
        at = np.flatnonzero((a[:-1] > BREAK) & (a[1:] > BREAK))
        at = at[passes(self.known[1], phrase_hashes([hashes[a[at]], hashes[a[at + 1]]]))]
        three = at[:-1][np.diff(at) == 1]
        three = three[may_be_frequent(self.known[2], phrase_hashes([hashes[a[three + i]] for i in range(3)]))]
        four = three[:-1][np.diff(three) == 1]
        three, four = three[three + 2 >= old], four[four + 3 >= old]
        keys, counts = np.unique(a[three] << 2 * WIDTH | a[three + 1] << WIDTH | a[three + 2], return_counts=True)
        if len(keys):
            self.trie.add(keys >> 2 * WIDTH, keys & ((1 << 2 * WIDTH) - 1), WIDTH, counts)
        pair = a[:-1] << WIDTH | a[1:]
        names, number = np.unique(np.concatenate([pair[four], pair[four + 2]]), return_inverse=True)
        keys, counts = np.unique(number[: len(four)] << 32 | number[len(four) :], return_counts=True)
        if len(keys):
            begin, end = names[keys >> 32], names[keys & 0xFFFFFFFF]
            self.trie.add(begin >> WIDTH, (begin & MASK) << 2 * WIDTH | end, 2 * WIDTH, counts)

    def size(self) -> int:
        return self.trie.held + len(self.words)

    def run(self, down_to: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Spilled subtrees as one sorted run: phrases, hashes of their prefixes, counts."""
        names, hashes = self.words.names, self.words.hashed()
        if not self.known:
            at = np.flatnonzero(self.single)
            at = at[at > BREAK]
            phrases, prefix, counts = [names[w] for w in at.tolist()], hashes[at], self.single[at]
            phrases.append(b"")  # stands for the words of all kinds
            prefix, counts = np.append(prefix, np.uint64(0)), np.append(counts, counts.sum())
        else:
            first, rest, counts = self.trie.spill(down_to)
            size = 2 + (rest > MASK) + (rest > MASK << WIDTH | MASK)
            phrases, prefix = [], []
            for k in np.unique(size).tolist():
                mine = size == k
                words = [first[mine], *[rest[mine] >> WIDTH * i & MASK for i in range(k - 2, -1, -1)]]
                phrases += [b" ".join([names[w] for w in p]) for p in zip(*[w.tolist() for w in words], strict=True)]
                prefix.append(phrase_hashes([hashes[w] for w in words[: LONGEST - 1]]))
            counts = np.concatenate([counts[size == k] for k in np.unique(size).tolist()]) if len(size) else counts
            prefix = np.concatenate(prefix) if len(size) else np.zeros(0, np.uint64)
        order = sorted(range(len(phrases)), key=phrases.__getitem__)
        return [phrases[i] for i in order], prefix[order], counts[order]


RUN = "lang string, prefix long, phrase string, f long, sums binary"


def phrase_runs(texts: DataFrame, known: tuple[np.ndarray, ...]) -> DataFrame:
    """Sorted runs of counted phrases (see :class:`Counter` for their lengths); ``texts`` is (lang, body binary).

    ``prefix`` is a hash of the first three words, null for one and two words, which are their own prefix. The empty
    phrase, among single words, counts all of them.
    Rows without a phrase hold the sums of the next length, those of one ``prefix`` (leading bits of the keys) packed in ``sums``.
    """
    spark = texts.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(known)  # bounded by FILTER_BITS each
    schema = pa.schema([("lang", pa.string()), ("prefix", pa.int64()), ("phrase", pa.string()), ("f", pa.int64()), ("sums", pa.binary())])

    def out(counter: Counter, down_to: int) -> Iterator[pa.RecordBatch]:
        phrases, prefix, f = counter.run(down_to)
        prefix = pa.array(prefix.view(np.int64)) if len(counter.known) == 3 else pa.nulls(len(f), pa.int64())
        for a in range(0, len(phrases), 50_000):
            some = pa.array(phrases[a : a + 50_000], pa.binary()).cast(pa.string())
            columns = [pa.array([counter.lang] * len(some)), prefix[a : a + 50_000], some, pa.array(f[a : a + 50_000]), pa.nulls(len(some), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def packed(sums: Sums) -> Iterator[pa.RecordBatch]:
        rows = list(sums.rows())  # SUMMED keys and those of a slice at most
        if rows:
            none = [pa.nulls(len(rows), pa.string()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.string())]
            leads, bodies = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([none[0], pa.array(leads, pa.int64()), none[2], none[1], pa.array(bodies, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = held.value
        buckets = Sums() if len(filters) < 3 else None
        counters: dict[str, Counter] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                some = batch.slice(a, SLICE)
                by_lang: dict[str, list[bytes]] = {}
                for lang, body in zip(some.column("lang").to_pylist(), some.column("body").to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(body)
                for lang, texts in by_lang.items():
                    counter = counters.setdefault(lang, Counter(lang, filters, buckets))
                    counter.read(texts)
                    if buckets is not None and buckets.size >= SUMMED:
                        yield from packed(buckets)
                    if counter.trie.held > HELD:
                        yield from out(counter, HELD // 2)
                    while sum(c.size() for c in counters.values()) > 2 * HELD:
                        yield from out(counters.pop(max(counters, key=lambda x: counters[x].size())), 0)
        for lang in list(counters):
            yield from out(counters.pop(lang), 0)
        if buckets is not None:
            yield from packed(buckets)

    return texts.mapInArrow(run, RUN)


def merged_runs(runs: DataFrame, length: int) -> DataFrame:
    """Runs merged by prefix partitions: each phrase once with its whole count."""
    prefix = "prefix" if length >= LONGEST - 1 else "phrase"
    return runs.filter("phrase IS NOT NULL").repartition("lang", prefix).groupBy("lang", "prefix", "phrase").agg(F.sum("f").alias("f"))


def hashed(phrases: DataFrame) -> DataFrame:
    """Hashes, as ``prefix``, of phrases of at most three words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[list[int]]] = {}
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                seed = zlib.crc32(lang.encode())
                words = [xxhash.xxh3_64_intdigest(w, seed) for w in phrase.encode().split(b" ")]
                by_size.setdefault(len(words), []).append(words)
            for some in by_size.values():
                yield pa.RecordBatch.from_arrays([pa.array(phrase_hashes(list(np.array(some, np.uint64).T)).view(np.int64))], names=["prefix"])

    return phrases.select("lang", "phrase").mapInArrow(run, "prefix long")


def added_buckets(runs: DataFrame, least: int) -> np.ndarray:
    """Bits, by bucket, of the sums over all tasks that reach ``least`` (or the 255 they are held at)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # BUCKETS bytes at most
        for batch in batches:
            for chunk, sums in zip(batch.column("prefix").to_pylist(), batch.column("sums"), strict=True):
                new = np.frombuffer(zlib.decompress(sums.as_buffer()), np.uint8)
                old = total.get(chunk)
                total[chunk] = new.copy() if old is None else np.where(old > 255 - new, 255, old + new).astype(np.uint8)
        for chunk, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([zlib.compress(sums, 1)], pa.binary())], names=["prefix", "sums"])

    some = runs.filter("phrase IS NULL").select("prefix", "sums", (F.spark_partition_id() % SALTS).alias("salt"))
    partly = some.repartition("prefix", "salt").select("prefix", "sums").mapInArrow(add, "prefix long, sums binary")
    whole = partly.repartition("prefix").mapInArrow(add, "prefix long, sums binary")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(zlib.decompress(s.as_buffer()), np.uint8) >= min(least, 255)).tobytes() for s in batch.column("sums")]
            yield pa.RecordBatch.from_arrays([batch.column("prefix"), pa.array(bits, pa.binary())], names=["prefix", "sums"])

    out = np.zeros((BUCKETS // CHUNK, CHUNK // 8), np.uint8)
    for r in whole.mapInArrow(mark, "prefix long, sums binary").collect():  # a bit a bucket
        out[r["prefix"]] = np.frombuffer(r["sums"], np.uint8)
    return out.ravel()


def frequent_sums(runs: DataFrame, least: int) -> DataFrame:
    """Hashes, as ``prefix``, of the keys whose sums over all tasks reach ``least`` (or the 255 they are held at)."""

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        places, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        return places, np.bincount(at, np.concatenate([n for _, n in parts]), len(places)).astype(np.int64)

    def frequent(lead: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        places, n = added(parts)
        keys = places[n >= min(least, 255)] | lead << PLACE_BITS
        return pa.RecordBatch.from_arrays([pa.array(key_hashes(keys).view(np.int64))], names=["prefix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, parts, held, most = None, [], 0, SUMMED
        for batch in batches:
            for new, sums in zip(batch.column("prefix").to_pylist(), batch.column("sums"), strict=True):
                if new != lead:
                    if parts:
                        yield frequent(lead, parts)
                    lead, parts, held, most = new, [], 0, SUMMED
                parts.append(unpacked(sums.as_buffer()))
                held += len(parts[-1][0])
                if held > most:  # the distinct keys of one prefix, and as many again at most
                    parts = [added(parts)]
                    held = len(parts[0][0])
                    most = max(SUMMED, 2 * held)
        if parts:
            yield frequent(lead, parts)

    some = runs.filter("phrase IS NULL").select("prefix", "sums")
    return some.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(run, "prefix long")


def frequent_filter(frequent: DataFrame) -> np.ndarray:
    """Bloom filter, as 64-bit words, of the hashes ``prefix`` of a table; its size follows the table up to ``FILTER_BITS``."""
    bits = 1 << 12
    rows = frequent.count()
    while bits < FILTER_BITS and bits < BITS_A_PHRASE * rows:
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(probes(batch.column("prefix").to_numpy().view(np.uint64), bits).ravel()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])

    places = frequent.select("prefix").mapInArrow(run, "place long")
    words = places.groupBy(F.shiftright("place", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("v"))
    out = np.zeros(bits // 64, np.uint64)
    found = words.toPandas()  # at most FILTER_BITS / 64 numbers
    out[found["w"].to_numpy()] = found["v"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def phrase_counts(df: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of one to four words (``lang, phrase, size, f``), and ``lang, n``."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), body.alias("body"))
    parts, known, totals = [], (), None
    for length in (1, 2, 3):
        runs = phrase_runs(texts, known)
        if length < 3:
            runs, path = stored_at(runs, "phrases", "zstd")
        frequent = cut(merged_runs(runs, length).filter((F.col("f") >= least) | (F.col("phrase") == "")))
        if length == 1:
            totals = frequent.filter("phrase = ''").select("lang", F.col("f").alias("n"))
            frequent = frequent.filter((F.col("f") >= least) & (F.col("phrase") != ""))
        if length < 3:
            known = (*known[:1], frequent_filter(hashed(frequent)), frequent_filter(cut(frequent_sums(runs, least))))
            removed(texts.sparkSession, path)
        parts.append(frequent)
    counts = parts[0].union(parts[1]).union(parts[2])
    return counts.select("lang", "phrase", (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1).alias("size"), "f"), totals
