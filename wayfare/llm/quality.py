"""Operator 9: a quality score from random Fourier features of document statistics.

Each whole text is reduced to a row of statistics. Random Fourier features of the standardised
statistics approximate a Gaussian kernel; partitions sum their part of the normal equations, the
ridge system (of fixed size) is solved, and an isotonic fit on rows kept apart calibrates the score.

Null and empty texts have all-zero statistics and are scored like any other. If there is nothing
to learn from, or one class only, the score is the share of label 1 (0.5 without labels). Training
reads at most about ``max_train`` labelled rows, chosen by a hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, id_text, map_texts

FEATURES = 256
RIDGE = 1.0
MAX_TRAIN = 40_000
SEED = 7
PARTS = 8


def _byte_kinds() -> np.ndarray:
    """A 256 x kinds matrix that sums byte counts into kinds of characters."""
    kinds = [
        range(65, 91), range(97, 123), range(48, 58), b" \t", b"\n", b".", b",", b"!", b"?", b"#$%&*", b"|", b"\"'", b"()[]{}<>",
        b"-_/\\=+@:;~^`", range(128, 256), range(192, 256),
    ]
    m = np.zeros((256, len(kinds)))
    for k, kind in enumerate(kinds):
        m[list(kind), k] = 1
    return m


KINDS = _byte_kinds()
SIZE = KINDS.shape[1] + 11


def statistics(text: str) -> np.ndarray:
    """Shares of kinds of characters, lengths, and repetition of words and lines."""
    out = np.zeros(SIZE)
    data = text.encode("utf-8", "replace")
    if not data:
        return out
    k = KINDS.shape[1]
    out[:k] = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ KINDS / len(data)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct = len(set(words))
    out[k:] = [
        np.log1p(len(data)),
        np.log1p(len(words)),
        lengths.mean() / 10 if len(words) else 0,
        np.log1p(lengths.max()) if len(words) else 0,
        (lengths <= 3).mean() if len(words) else 0,
        (lengths >= 12).mean() if len(words) else 0,
        distinct / n,
        np.log1p(n / max(1, distinct)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(data) / max(1, len(lines))),
        1.0,
    ]
    return out


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats array<float>`` of every whole text."""
    return map_texts(id_text(docs, id_col, text_col), lambda texts: ({"stats": [statistics(t).astype(np.float32) for t in texts]}, None), "stats array<float>")


def basis(size: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed random frequencies and phases for a kernel of width ``sqrt(size)``."""
    rng = np.random.default_rng(SEED)
    return rng.normal(0, 1 / np.sqrt(size), (size, features)), rng.uniform(0, 2 * np.pi, features)


def fourier(stats: np.ndarray, model: dict) -> np.ndarray:
    x = np.clip((stats - model["mean"]) / model["spread"], -6, 6)
    z = np.sqrt(2 / len(model["phase"])) * np.cos(x @ model["waves"] + model["phase"])
    return np.hstack([np.ones((len(z), 1)), z])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the mean score and level of each pool, ascending."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        pools.append([b, 1.0, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            level, n, at = pools.pop()
            pools[-1] = [pools[-1][0] + level, pools[-1][1] + n, pools[-1][2] + at]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, max_train: int = MAX_TRAIN) -> dict:
    """Learn from ``doc_id, stats, label``; a model of fixed size."""
    share = min(1.0, max_train / max(1, labelled.count()))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20))
    # A fifth of the chosen rows calibrates; the rest fits.
    chosen = labelled.select("stats", F.col("label").cast("double").alias("label"), F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(5)).alias("fold"), turn.alias("turn"))
    chosen = cut(chosen.filter(F.col("turn") < int(share * (1 << 20))).drop("turn").repartition(PARTS))
    mean_of = [x for i in range(SIZE) for x in (F.avg(F.col("stats")[i]).alias(f"m{i}"), F.stddev_pop(F.col("stats")[i]).alias(f"s{i}"))]
    first = chosen.agg(F.count("*").alias("n"), F.avg("label").alias("rate"), *mean_of).first()
    if not first["n"] or first["rate"] in (0.0, 1.0):
        return {"constant": 0.5 if not first["n"] else first["rate"]}
    waves, phase = basis(SIZE, features)
    model = {
        "mean": np.array([first[f"m{i}"] for i in range(SIZE)]),
        "spread": np.array([max(first[f"s{i}"], 1e-3) for i in range(SIZE)]),
        "waves": waves,
        "phase": phase,
    }

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((features + 1, features + 2))
        for pdf in batches:
            if len(pdf):
                z = fourier(np.stack(pdf["stats"]), model)
                total += z.T @ np.hstack([z, pdf["label"].to_numpy()[:, None]])
        yield pd.DataFrame({"sums": [total.tobytes()]})

    parts = chosen.filter("fold <> 0").mapInPandas(sums, "sums binary").collect()  # PARTS rows of fixed size
    total = sum(np.frombuffer(r["sums"]).reshape(features + 1, features + 2) for r in parts)
    model["weights"] = np.linalg.solve(total[:, :-1] + ridge * np.eye(features + 1), total[:, -1])
    apart = chosen.filter("fold = 0").select("stats", "label").toPandas()  # at most about max_train / 5 rows
    if len(apart):
        raw = fourier(np.stack(apart["stats"]), model) @ model["weights"]
        model["at"], model["level"] = isotonic(raw, apart["label"].to_numpy())
    else:
        model["at"], model["level"] = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(stats: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score`` for each row of statistics."""
    if "constant" in model:
        return stats.select("doc_id", F.lit(float(model["constant"])).alias("score"))
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
                raw = fourier(flat.reshape(batch.num_rows, -1), m) @ m["weights"]
                level = np.clip(np.interp(raw, m["at"], m["level"]), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(level)], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def quality_of_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.7, max_train: int = MAX_TRAIN) -> DataFrame:
    """Learn from labelled documents outside fold ``held`` and score all."""
    stats = cut(document_statistics(docs))
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", folds) != held))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    model = fit(stats.join(known, "doc_id"), max_train=max_train)
    out = score(stats, model)
    return out.select("doc_id", (crc_mod("doc_id", folds) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
