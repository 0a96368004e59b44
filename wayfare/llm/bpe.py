"""Operator 6: byte-pair encoding and decoding with a public vocabulary.

Texts are cut into words with numpy; only words not met before are encoded. All new words of a
batch are encoded together by a pair occurrence index: each adjacent pair is mapped to all its
positions in the batch, active ranks are taken in ascending order, every position of a rank is
merged at once and the lists of the pairs around it are updated.

Null and empty texts have no tokens; their digests are those of empty input. The vocabulary file
is shipped to the executors by Spark's ``addFile``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from .common import id_text, map_texts, pieces, span_hashes

SPECIAL = 0x110000  # code points from here on stand for the special tokens of a text
CHARS = 400_000  # code points cut into words at once, about (a longer text is cut by itself)
POSITIONS = 1 << 18  # positions of new words whose pairs are looked up at once
CACHED_WORDS = 400_000  # a worker forgets its words beyond this number
OTHER, LETTER, NUMBER, SPACE, MARK = range(5)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in set(plain))}
    return [chr(rest.get(b, b)) for b in range(256)]


class Vocabulary:
    """Lower-casing word-end BPE read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if spec["normalizer"]["normalizers"][-1]["type"] != "Lowercase" or not suffix:
            raise ValueError("only lower-casing vocabularies with word ends are known")
        ids = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (1 + max([*ids.values(), *self.specials.values()]))
        for name, i in [*ids.items(), *self.specials.items()]:
            self.names[i] = name
        self.names = np.array(self.names, object)
        symbols = byte_symbols()
        self.inside = np.array([ids[c] for c in symbols], np.int32)
        self.last = np.array([ids[c + suffix] for c in symbols], np.int32)
        rules = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        key = np.array([ids[a] << 20 | ids[b] for a, b in rules], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        self.made = np.array([ids[a + b] for a, b in rules], np.int64)
        self.parts = np.array([(ids[a], ids[b]) for a, b in rules], np.int64).reshape(-1, 2)
        self.split = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))))
        self.marks = list(self.specials)
        kinds = np.zeros(SPECIAL + len(self.marks), np.uint8)
        for c in range(SPECIAL):
            kind = unicodedata.category(chr(c))[0]
            kinds[c] = LETTER if kind == "L" else NUMBER if kind == "N" else SPACE if chr(c).isspace() and not 0x1C <= c <= 0x1F else OTHER
        kinds[SPECIAL:] = MARK
        self.kinds = kinds
        self.forget()

    def forget(self) -> None:
        """Empty the table of known words, but for the special tokens."""
        marks = np.arange(SPECIAL, SPECIAL + len(self.marks), dtype=np.uint32)
        at = np.arange(len(marks))
        self.known = {h: i for i, h in enumerate(span_hashes(marks, at, at + 1).tolist())}
        self.flat = np.array([self.specials[m] for m in self.marks], np.uint16)
        self.size = np.ones(len(marks), np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where no rule joins it."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def codes(self, text: str) -> np.ndarray:
        """Code points after normalisation; special tokens become one code each."""
        out, at = [], 0
        found = self.split.finditer(text) if "<|" in text else ()
        for m in found:
            out += [self.plain(text[at : m.start()]), np.array([SPECIAL + self.marks.index(m[0])], np.uint32)]
            at = m.end()
        out.append(self.plain(text[at:] if at else text))
        return out[0] if len(out) == 1 else np.concatenate(out)

    @staticmethod
    def plain(text: str) -> np.ndarray:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def cut(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words; ``ends`` are the ends of the texts in ``codes``."""
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = self.kinds[codes]
        new = np.ones(len(codes) + 1, bool)
        new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER) | (kind[1:] == MARK)
        new[ends[:-1]] = True
        quote = np.flatnonzero((codes == 0x27) & new[:-1])
        if len(quote):
            padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
            owner = np.searchsorted(ends, quote, side="right")
            room = ends[owner] - quote
            a, b = padded[quote + 1], padded[quote + 2]
            one = (room > 1) & np.isin(a, [ord(c) for c in "stmd"])
            two = (room > 2) & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
            for hit, n in ((quote[one], 2), (quote[two], 3)):
                new[hit + 1] = False
                new[hit + n] = True
        starts = np.flatnonzero(new[:-1])
        stops = np.append(starts[1:], len(codes))
        keep = kind[starts] != SPACE
        return starts[keep], stops[keep]

    def learn(self, codes: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Encode the new words (code points and lengths) and append their ids to the table."""
        if not codes:
            return
        flat, size = np.concatenate(codes), np.concatenate(sizes)
        width = 1 + (flat >= 0x80).astype(np.uint8) + (flat >= 0x800) + (flat >= 0x10000)
        stop = np.cumsum(np.add.reduceat(width, np.cumsum(size) - size, dtype=np.int64))
        data = np.frombuffer(flat.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        symbol = self.inside[data]
        symbol[stop - 1] = self.last[data[stop - 1]]
        ids, counts = self.merge(symbol, stop)
        self.flat = np.concatenate([self.flat, ids.astype(np.uint16)])
        self.size = np.concatenate([self.size, counts])

    def merge(self, symbol: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of all words by the pair occurrence index; ids and their number by word."""
        n = len(symbol)
        after = np.arange(1, n + 2, dtype=np.int32)  # position n stands for a word's border
        after[stop - 1] = after[n] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[np.concatenate([[0], stop[:-1]])] = before[n] = n
        symbol = np.append(symbol, np.int32(-1))
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions on the lists of their ranks."""
            at = at[after[at] < n]
            rank = self.rank_of(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            edges = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            lo = 0
            for hi in [*edges.tolist(), len(at)]:
                r = int(rank[lo])
                if r not in places:
                    places[r] = []
                    heapq.heappush(active, r)
                places[r].append(at[lo:hi])
                lo = hi

        for lo in range(0, n, POSITIONS):
            note(np.arange(lo, min(n, lo + POSITIONS), dtype=np.int32))
        while active:
            r = heapq.heappop(active)
            lists = places.pop(r)
            left, right = self.parts[r]
            at = np.sort(np.concatenate(lists))
            at = at[(symbol[at] == left) & (symbol[after[at]] == right) & np.append(True, at[1:] != at[:-1])]
            if left == right and len(at) > 1:
                taken, free = [], -1
                for p, q in zip(at.tolist(), after[at].tolist(), strict=True):
                    if p != free:
                        taken.append(p)
                        free = q
                at = np.array(taken, np.int32)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.made[r]
            symbol[gone] = -1
            after[at] = after[gone]
            before[after[at]] = at
            before[n] = n
            note(np.concatenate([at, before[at][before[at] < n]]))
        alive = symbol[:n] >= 0
        counts = np.add.reduceat(alive, np.concatenate([[0], stop[:-1]])).astype(np.int64)
        return symbol[:n][alive], counts

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > CACHED_WORDS:
            self.forget()
        parts, new_codes, new_sizes = [], [], []
        for a, b in pieces(map(len, texts), CHARS):
            codes = [self.codes(text) for text in texts[a:b]]
            flat = np.concatenate(codes)
            ends = np.cumsum([len(c) for c in codes])
            starts, stops = self.cut(flat, ends)
            hashes, first, which = np.unique(span_hashes(flat, starts, stops), return_index=True, return_inverse=True)
            row = np.array([self.known.get(h, -1) for h in hashes.tolist()], np.int64)
            if len(fresh := np.flatnonzero(row < 0)):
                row[fresh] = np.arange(len(self.known), len(self.known) + len(fresh))
                self.known.update(zip(hashes[fresh].tolist(), row[fresh].tolist(), strict=True))
                begin = starts[first[fresh]]
                size = stops[first[fresh]] - begin
                new_codes.append(flat[spread(begin, size)])
                new_sizes.append(size)
            parts.append((row[which].astype(np.int32), np.searchsorted(starts, ends)))
        self.learn(new_codes, new_sizes)
        begin = np.cumsum(self.size) - self.size
        for words, ends in parts:
            size = self.size[words]
            ids = self.flat[spread(begin[words], size)]
            stop = np.concatenate([[0], np.cumsum(size)])[ends]
            yield from np.split(ids, stop[:-1]) if len(stop) else ()

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.names[ids].tolist())


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions ``begin, begin + 1, ...`` of runs of the given sizes, one run after another."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


_LOADED: dict[str, Vocabulary] = {}


def share(spark: SparkSession, path: str) -> str:
    """Ship the file to all executors; the name under which they find it."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def vocabulary(name: str) -> Vocabulary:
    """The shipped vocabulary, read once by each worker."""
    if name not in _LOADED:
        _LOADED[name] = Vocabulary(SparkFiles.get(name))
    return _LOADED[name]


def bpe_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every text."""
    name = share(df.sparkSession, path)

    def make(texts: list[str]) -> tuple[dict, None]:
        vocab = vocabulary(name)
        ids = [x.astype(np.int32) for x in vocab.encode(texts)]
        return {"ids": ids, "decoded": [vocab.decode(x) for x in ids]}, None

    return map_texts(id_text(df, id_col, text_col), make, "ids array<int>, decoded string")


def bpe_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`bpe_tokens`, with ids and decoded text reduced to their digests where they are made."""
    name = share(df.sparkSession, path)

    def make(texts: list[str]) -> tuple[dict, None]:
        vocab = vocabulary(name)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in vocab.encode(texts):
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(vocab.decode(ids).encode()).hexdigest())
        return out, None

    return map_texts(id_text(df, id_col, text_col), make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def piece_crcs(ids: np.ndarray, length: int, end: int) -> list[tuple[int, int, int]]:
    """``(start, length, crc32)`` of the windows of a document's ids with ``end`` after them."""
    data = np.append(ids.astype("<u4"), np.uint32(end)).astype("<u4")
    return [(i, min(length, len(data) - i), zlib.crc32(data[i : i + length].tobytes())) for i in range(0, len(data), length)]
