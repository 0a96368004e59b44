"""Operator 8: packing token sequences by non-negative least squares.

A document's ids (its tokens and an end id) are cut into whole windows and one remainder, so a
piece is known where its text is encoded. The remainders are packed by their histogram of lengths
(at most ``length - 1`` entries, however many documents): shallow combinations of lengths that fill
a window are enumerated, non-negative least squares gives how often each is used, the counts are
rounded down, and what is left is packed greedily, again by length. The plan names ranges of ranks
within each length; pieces get dense ranks within their length and are joined to the plan by range,
so neither a task nor the driver sees more than the plan.

A null or empty text has the end id alone. An empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import piece_crcs, share, vocabulary
from .common import cut, id_text, map_texts

END = 1


def nnls(row: np.ndarray, column: np.ndarray, b: np.ndarray, columns: int, rounds: int = 300) -> np.ndarray:
    """``x >= 0`` with a small ``|a x - b|`` by multiplicative updates.

    ``a`` counts the pairs ``(row, column)``, so a pattern of three pieces is three pairs and the
    matrix is never written out.
    """
    x = np.full(columns, b.sum() / max(len(row), 1))
    ab = np.bincount(column, b[row], columns)
    for _ in range(rounds):
        ax = np.bincount(row, x[column], len(b))
        x *= ab / np.maximum(np.bincount(column, ax[row], columns), 1e-12)
    return x


def combinations(lengths: np.ndarray, window: int, slack: int) -> list[tuple[int, ...]]:
    """Shallow combinations that fill the window to within ``slack``, longest length first.

    For each length the partners of two and three pieces; the third is the longest that fits.
    """
    have = np.zeros(window + 1, np.int64)
    have[lengths] = lengths
    best = np.maximum.accumulate(have)  # the longest present length of at most i
    found = set()
    for a in lengths[::-1].tolist():
        if window - a <= slack:
            found.add((a,))
        b = int(best[window - a])
        if b and window - a - b <= slack:
            found.add(tuple(sorted((a, b), reverse=True)))
        room = window - a
        some = lengths[lengths < room]
        for b in some[:: max(1, len(some) // 12)].tolist():
            c = int(best[room - b])
            if c and room - b - c <= slack:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, reverse=True)


def plan(counts: dict[int, int], window: int, slack: int = 0) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and how often each is used; all pieces are placed."""
    left = np.zeros(window + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    used: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...], times: int) -> None:
        lengths, need = np.unique(pattern, return_counts=True)
        times = int(min(times, (left[lengths] // need).min()))
        if times > 0:
            left[lengths] -= times * need
            used.append((pattern, times))

    present = np.flatnonzero(left)
    patterns = combinations(present, window, slack) if len(present) else []
    if patterns:
        place = np.zeros(window + 1, np.int64)
        place[present] = np.arange(len(present))
        column = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
        row = place[np.fromiter((n for p in patterns for n in p), np.int64, len(column))]
        x = nnls(row, column, left[present].astype(np.float64), len(patterns))
        for j in np.argsort(-x, kind="stable").tolist():
            use(patterns[j], int(np.floor(x[j] + 1e-3)))
    while left.any():  # greedy: longest piece first, then always the longest that still fits
        room, pattern, rest = window, [], left.copy()
        while room and (fits := np.flatnonzero(rest[1 : room + 1])).size:
            n = int(fits[-1]) + 1
            pattern.append(n)
            rest[n] -= 1
            room -= n
        use(tuple(pattern), 1 << 60)
    return used


def slots(used: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Rank ranges of each length: (length, first rank, end, pieces a sequence, first sequence, offset, ...)."""
    at: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in used:
        offset = 0
        for n in sorted(set(pattern), reverse=True):
            m = pattern.count(n)
            out.append((n, at.get(n, 0), at.get(n, 0) + m * times, m, sequence, offset, n))
            at[n] = at.get(n, 0) + m * times
            offset += m * n
        sequence += times
    return out


def token_pieces(df: DataFrame, path: str, window: int, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """The pieces of every document: whole windows, then the remainder."""
    name = share(df.sparkSession, path)

    def make(texts: list[str]) -> tuple[dict, np.ndarray]:
        rows, owner = [], []
        for i, ids in enumerate(vocabulary(name).encode(texts)):
            found = piece_crcs(ids, window, end)
            rows += [(*x, len(ids) + 1) for x in found]
            owner += [i] * len(found)
        columns = zip(*rows, strict=True)
        return dict(zip(("start", "length", "ids_crc32", "doc_tokens"), columns, strict=True)), np.array(owner)

    made = map_texts(id_text(df, id_col, text_col), make, "start long, length long, ids_crc32 long, doc_tokens long")
    return made.withColumn("part", F.spark_partition_id())


def pack(made: DataFrame, window: int) -> DataFrame:
    """Place pieces of at most ``window`` tokens: adds ``sequence_id`` and ``offset``."""
    made = cut(made)
    by_part = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = made.groupBy("length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in totals.collect()}  # at most ``window`` rows
    used = plan(counts, window)
    spark = made.sparkSession
    ranges = spark.createDataFrame(slots(used), "s_length long, lo long, hi long, per long, first long, at long, size long")
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = by_part.select(F.col("length").alias("b_length"), F.col("part").alias("b_part"), F.coalesce(before, F.lit(0)).alias("base"))
    local = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "start")) - 1
    ranked = made.withColumn("local", local).join(offsets, (F.col("length") == F.col("b_length")) & (F.col("part") == F.col("b_part")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("local"))
    # One row for each length with its sorted ranges: bounded by the window, whatever the input.
    by_length = ranges.groupBy("s_length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "per", "first", "at"))).alias("slots"))
    placed = ranked.join(F.broadcast(by_length), F.col("length") == F.col("s_length"))
    slot = F.filter("slots", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"]))[0]
    placed = placed.withColumn("slot", slot).withColumn("step", F.col("rank") - F.col("slot.lo"))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("slot.first") + F.floor(F.col("step") / F.col("slot.per"))).cast("long").alias("sequence_id"),
        (F.col("slot.at") + F.col("step") % F.col("slot.per") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(df: DataFrame, path: str, window: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts and pack them; one row for each piece."""
    return pack(token_pieces(df, path, window, id_col, text_col), window)
