"""Operator 2: repeated passages by content-defined chunking.

A gear rolling hash over the bytes of each text marks cuts: the least hash of every ``WINNOW``
neighbouring places is one, so a cut depends only on the bytes near it and an insertion shifts no
cut but those next to it. From each cut a chunk runs to the first cut at least ``min_bytes`` further on, whole
and of its own length, and is known by its digest; a chunk overlaps the next ones, so one at the edge of a
passage hides none inside. Two texts that share ``min_bytes + 2 * WINNOW + ORDER - 2`` bytes (270; 51 words take
about 315) share a whole chunk whatever stands around them: a cut among the first ``WINNOW`` places whose hash lies in the
passage, and the first cut ``min_bytes`` on, which no byte outside decides. What occurs in two documents or more is a
repeat, the first occurrence (smallest document id, then place) is the original. Repeats that overlap or touch are
joined into spans, and all of a span is repeated in pieces of ``min_bytes`` at least.

Null and empty texts have no chunks. In a stretch of one period cuts stop; a chunk longer than
``MAX`` is cut every ``MAX`` bytes, so a text of any length stays bounded. Every row is a document of
its own, also where rows repeat or ids are equal or null; a null id counts as -1 in ``first_doc_id``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text, map_texts, stored

WINNOW = 64  # a cut in any 64 neighbouring places, every 32 bytes on average
ORDER = 16  # bits of the hash that order the places, which hang on so many bytes
MAX = 1024
MIN_BYTES = 128
GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte ``sum(GEAR[byte j back] << j)`` over the last 32 bytes, by doubling."""
    h = GEAR[data]
    width = 1
    while width < 32:
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint32(width)
        h = h + shifted
        width *= 2
    return h


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks: the first least hash of each ``WINNOW`` places, once in a stretch of one period."""
    n = len(data)
    keys = ((gear_hash(data).astype(np.uint64) & np.uint64((1 << ORDER) - 1)) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    keys = keys[ORDER - 1 :]
    width = 1
    while width < WINNOW and len(keys) > width:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    # The places of the least hashes go up, and equal ones are neighbours.
    least = keys[np.append(True, keys[1:] != keys[:-1])] if width == WINNOW else keys[:0]
    marks = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if len(marks):
        order = least >> np.uint64(32)
        marks = marks[np.append(True, (np.diff(order) != 0) | (np.diff(marks) >= WINNOW // 2))] + 1
    ends = np.append(marks[marks < n], n)
    starts = np.append(0, ends[:-1])
    if (ends - starts).max() > MAX:
        more = [np.arange(a + MAX, b, MAX) for a, b in zip(starts, ends, strict=True) if b - a > MAX]
        ends = np.union1d(ends, np.concatenate(more))
    return ends


def text_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``row, doc_id, start, length, at, end, digest, tag`` (bytes of UTF-8) of the chunks of every whole text.

    From each cut ``start``, with the next one after ``length``, a chunk goes from ``at`` to ``end``: from the cut
    to the first cut (or the end of the text) at least ``min_bytes`` on, or ``min_bytes + WINNOW`` on
    where cuts stop. The last one ends with the text and begins ``min_bytes`` before. ``digest`` and ``tag`` are 64
    and 32 bits of a hash of the chunk; they and ``end`` are null where the text ends before. ``row`` numbers the
    rows of ``df``, and is the same in two uses only of a stored result.
    """

    def make(texts: list[str]) -> tuple[dict, np.ndarray]:
        starts, lengths, places, until, known, digests, owner = [], [], [], [], [], [], []
        for i, text in enumerate(texts):
            raw = text.encode("utf-8", "replace")
            if not raw:
                continue
            ends = cut_points(np.frombuffer(raw, np.uint8))
            begin = np.append(0, ends[:-1])
            starts.append(begin)
            lengths.append(ends - begin)
            owner.append(np.full(len(ends), i))
            at = begin.copy()
            at[-1] = max(0, len(raw) - min_bytes)
            places.append(at)
            ok = at + min_bytes <= len(raw)
            stop = ends[np.minimum(np.searchsorted(ends, at + min_bytes), len(ends) - 1)]
            stop = np.minimum(stop, at + min_bytes + WINNOW)  # less only where cuts stop
            until.append(stop)
            digests += [hashlib.blake2b(raw[a:b], digest_size=12).digest() if whole else bytes(12) for a, b, whole in zip(at.tolist(), stop.tolist(), ok.tolist(), strict=True)]
            known.append(ok)
        join = lambda x: np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)
        both = np.frombuffer(b"".join(digests), np.dtype([("digest", "<i8"), ("tag", "<i4")]))
        none = ~join(known).astype(bool)
        parts = {k: pa.array(np.ascontiguousarray(both[k]), mask=none) for k in ("digest", "tag")}
        return {"start": join(starts), "length": join(lengths), "at": join(places), "end": pa.array(join(until), mask=none), **parts}, join(owner)

    docs = id_text(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return map_texts(docs, make, "start int, length int, at int, end int, digest long, tag int", ("row", "doc_id"))


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """The chunks whose hash occurs in more than one document, with their number and the first.

    All chunks meet by the narrow ``digest`` alone; those that it leaves, by all bits. Counts are
    combined before the shuffle, and the joins that spread them to the chunks can be split where
    one hash is very common.
    """
    rows = [F.min("row").alias("low"), F.max("row").alias("high")]
    met = chunks.join(chunks.groupBy("digest").agg(*rows).filter("low <> high").select("digest"), "digest")
    met = stored(met, "met")
    place = F.struct(F.coalesce("doc_id", F.lit(-1)).alias("doc"), "row", "at")
    counted = met.groupBy("digest", "tag").agg(F.count("*").alias("copies"), F.min(place).alias("first"), *rows)
    return met.join(counted.filter("low <> high").drop("low", "high"), ["digest", "tag"])


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Stretches made of repeats of ``min_bytes`` that overlap or touch, one row each.

    ``doc_id, start, end`` (bytes of UTF-8, end exclusive), ``chunks``, ``copies`` (most occurrences
    of one of them), ``first_doc_id`` (smallest document that has one) and ``duplicate`` (some chunk
    has its original elsewhere, so the span can go).
    """
    chunks = text_chunks(df, id_col, text_col, min_bytes).filter("digest IS NOT NULL").select("row", "doc_id", "at", "end", "digest", "tag")
    rows = repeated_chunks(stored(chunks, "chunks"))
    own = W.partitionBy("row").orderBy("at")
    # A later chunk never ends before an earlier one: the first cut far enough on goes up with the start.
    rows = rows.withColumn("new", F.coalesce(F.lag("end").over(own) < F.col("at"), F.lit(True)).cast("int"))
    rows = rows.withColumn("run", F.sum("new").over(own))
    elsewhere = (F.col("first.row") != F.col("row")) | (F.col("first.at") != F.col("at"))
    spans = rows.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("at").cast("long").alias("start"),
        F.max("end").cast("long").alias("end"),
        F.count("*").alias("chunks"),
        F.max("copies").alias("copies"),
        F.min("first.doc").alias("first_doc_id"),
        F.max(elsewhere).alias("duplicate"),
    )
    return spans.drop("row", "run")
