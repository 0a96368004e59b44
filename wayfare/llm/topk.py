"""Operator 7: exact top-k by inner product with a pivot table.

The pivots' distances to a vector, with its norm, give its inner products with the pivots, and so its part
in the space that the pivots span (one triangular solve makes the table orthonormal). For a query and a
candidate the inner product is the product of those parts, known from the table, plus that of the
rests, which the product of their lengths bounds: the tightest bound that the table allows. Each query
first meets that sample, whose k-th score is its threshold in all blocks; then a candidate is evaluated, in the order of the bounds and with matrix products, only while its
bound reaches the best threshold known. The best k of each block are merged by query.

Vectors that are null, empty, or hold null or non-finite components take no part; vectors of
different lengths are never compared. Repeated rows are candidates each on their own; a query's own
row is every row with its ``vec_id``. Pivots come from a bounded sample (``SAMPLE`` rows by a hash of
the id), at most three quarters as many as the dimensions; any pivots give exact results. Ties go to the smaller
``vec_id``. An empty table gives no rows; other columns are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, ship

PIVOTS = 48
SAMPLE = 2048
QUERY_BLOCK = 256
ROW_BLOCK = 4096
STEP = 256


def quantised(df: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v array<long>, dim`` of the vectors that take part."""
    whole = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall("w", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("w"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.coalesce(F.size("w"), F.lit(0)) > 0) & sound)
    return rows.select("vec_id", F.transform("w", lambda x: F.floor(x * scale)).alias("v"), F.size("w").alias("dim"))


def choose_pivots(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Pivots far from each other: each next one is the vector farthest from those chosen."""
    chosen = [int(np.argmax((vectors**2).sum(1)))] if len(vectors) else []
    near = np.full(len(vectors), np.inf)
    while chosen and len(chosen) < min(pivots, len(vectors)):
        near = np.minimum(near, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
        if near.max() <= 0:
            break
        chosen.append(int(near.argmax()))
    return vectors[chosen]


def pivot_basis(pivots: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span the pivots; at most three quarters as many as dimensions."""
    q, r = np.linalg.qr(pivots[: max(1, 3 * pivots.shape[1] // 4)].T)
    sizes = np.abs(np.diag(r))
    return q[:, sizes > 1e-9 * max(1.0, sizes.max(initial=0.0))]


def table_rows(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of vectors in the span of the pivots, and the lengths of their rests."""
    part = v @ basis
    return part, np.sqrt(np.maximum((v**2).sum(1) - (part**2).sum(1), 0))


def packed_blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows gathered into blocks of about ``size`` (ids and vectors as bytes), and their number.

    ``rows`` has a unique ``row`` number, so that repeated rows spread like any others.
    """
    blocks = max(1, -(-rows.count() // size))

    def run(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        whole = np.stack(some["v"]).astype(np.int64)
        narrow = whole.astype(np.int32) if np.abs(whole.astype(np.float64)).max() < 2**31 else whole
        return pd.DataFrame([(key[0], key[1], some["vec_id"].to_numpy(np.int64).tobytes(), narrow.tobytes())])

    numbered = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return numbered.groupBy("block", "dim").applyInPandas(run, f"{name}_block int, dim int, {name}_ids binary, {name}_v binary"), blocks


class Block:
    """Vectors of a block with their rows of the pivot table."""

    def __init__(self, ids: bytes, vectors: bytes, dim: int, basis: np.ndarray):
        self.ids = np.frombuffer(ids, np.int64)
        kind = np.int32 if len(vectors) == 4 * dim * len(self.ids) else np.int64
        self.whole = np.frombuffer(vectors, kind).reshape(-1, dim)
        self.v = self.whole.astype(np.float64)
        self.part, self.rest = table_rows(self.v, basis)
        self.top = float((self.v**2).sum(1).max())


def scores(query: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of one vector with others, as integers."""
    return (rows @ query).astype(np.int64) if exact else np.array([sum(int(x) * int(y) for x, y in zip(r, query, strict=True)) for r in rows], object)


def block_top(query: Block, rows: Block, k: int, floors: np.ndarray) -> tuple[list[tuple[int, int, int]], int]:
    """For each query of a block the best ``k`` of a block of candidates that reach its floor, and how many were evaluated."""
    exact = query.top * rows.top < 2.0**104  # then products and sums fit a double
    bound = query.part @ rows.part.T + query.rest[:, None] * rows.rest
    bound += 1e-9 * np.sqrt(query.top * rows.top) + 1e-6  # covers the rounding of the table
    bound[query.ids[:, None] == rows.ids] = -np.inf
    out, seen = [], 0
    for i, who in enumerate(query.ids.tolist()):
        least = floors[i]
        at = np.flatnonzero(bound[i] >= least)
        at = at[np.isfinite(bound[i, at])]
        at = at[np.argsort(-bound[i, at], kind="stable")]
        found_s, found_i = np.zeros(0, np.int64 if exact else object), np.zeros(0, np.int64)
        for a in range(0, len(at), STEP):
            some = at[a : a + STEP]
            some = some[bound[i, some] >= least]
            if not len(some):
                break
            seen += len(some)
            new = scores((query.v if exact else query.whole)[i], (rows.v if exact else rows.whole)[some], exact)
            found_s, found_i = np.concatenate([found_s, new]), np.concatenate([found_i, rows.ids[some]])
            if len(found_s) > k:
                best = np.lexsort((found_i, -found_s))[:k] if exact else sorted(range(len(found_s)), key=lambda j: (-found_s[j], found_i[j]))[:k]  # noqa: B023
                found_s, found_i = found_s[best], found_i[best]
            if len(found_s) == k:
                least = max(least, float(found_s.min()) * (1 if exact else 1 - 1e-12 * np.sign(float(found_s.min()))))
        out += [(who, x, s) for s, x in zip(found_s.tolist(), found_i.tolist(), strict=True)]
    return out, seen


def first_thresholds(asked: DataFrame, few: list[tuple[int, bytes, bytes]], bases: dict[int, np.ndarray], k: int) -> DataFrame:
    """``q_block, dim, q_ids, q_v, floors``: for each query the ``k``-th score among a bounded sample of rows, which no result is below."""
    held = asked.sparkSession.sparkContext.broadcast((few, bases))  # at most SAMPLE rows and their bases

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, basis = held.value
        for pdf in batches:
            floors = []
            for r in pdf.itertuples():
                query = Block(r.q_ids, r.q_v, r.dim, basis[r.dim])
                low = np.full(len(query.ids), -np.inf)
                for dim, ids, vectors in some:
                    if dim == r.dim:
                        sample = Block(ids, vectors, dim, basis[dim])
                        score = query.v @ sample.v.T
                        score[query.ids[:, None] == sample.ids] = -np.inf
                        if score.shape[1] >= k:
                            low = np.partition(score, -k, axis=1)[:, -k]
                            low = low - 1e-9 * np.abs(low)  # covers what doubles lose of very large products
                floors.append(low.tobytes())
            yield pdf.assign(floors=floors)

    return asked.mapInPandas(run, "q_block int, dim int, q_ids binary, q_v binary, floors binary")


def exact_top_k(df: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``; both frames as made by :func:`quantised`."""
    ship(df.sparkSession)
    df = cut(df.withColumn("row", F.monotonically_increasing_id()))
    queries = cut(queries.select("vec_id", "v", "dim").withColumn("row", F.monotonically_increasing_id()))
    few = df.orderBy(F.xxhash64("row")).limit(SAMPLE).select("dim", "vec_id", "v").toPandas()
    bases = {int(dim): pivot_basis(choose_pivots(np.stack(part["v"]).astype(np.float64), pivots)) for dim, part in few.groupby("dim")}
    for row in df.select("dim").distinct().collect():  # lengths of vectors, one in practice
        bases.setdefault(row["dim"], np.zeros((row["dim"], 0)))
    sample = [(int(dim), part["vec_id"].to_numpy(np.int64).tobytes(), np.stack(part["v"]).astype(np.int64).tobytes()) for dim, part in few.groupby("dim")]
    rows, n = packed_blocks(df, ROW_BLOCK, "r")
    asked, _ = packed_blocks(queries.join(df.select("dim").distinct(), "dim", "left_semi"), QUERY_BLOCK, "q")
    asked = first_thresholds(asked, sample, bases, k).withColumn("r_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    held = df.sparkSession.sparkContext.broadcast(bases)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                query, other = (Block(i, v, r.dim, held.value[r.dim]) for i, v in ((r.q_ids, r.q_v), (r.r_ids, r.r_v)))
                yield pd.DataFrame(block_top(query, other, k, np.frombuffer(r.floors))[0], columns=["query_id", "vec_id", "score"])

    pairs = rows.join(asked, ["r_block", "dim"]).mapInPandas(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_of_embeddings(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The rows whose id is divisible by ``every`` against all other rows."""
    rows = quantised(embeddings)
    return exact_top_k(rows, rows.filter(F.col("vec_id") % every == 0), k)
