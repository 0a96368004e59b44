"""Operator 10: language by multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams are summed by language in Spark; the matrix of log probabilities
(languages x buckets, bounded by the parameters) is broadcast and whole texts are scored in numpy,
a block of texts at a time.

Texts that are null or have no letter are ``und`` with score 0, as is every text if there is
nothing to learn from. Ties go to the language that sorts first. Training reads at most about
``max_train`` labelled rows (chosen by a hash of the id; all if there are fewer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, give_back, id_text, map_texts, pieces, ship

BUCKETS = 1 << 15
CHARS = 1_000_000
MAX_TRAIN = 20_000
_LETTERS: list[np.ndarray] = []


def letter_codes(text: str) -> tuple[np.ndarray, bool]:
    """Lower-cased code points with one space for anything else, padded; whether there is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    codes = np.frombuffer(f" {text.lower()}  ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTERS[0][codes]
    return np.where(letter, codes, np.uint32(32)), bool(letter.any())


def grams(codes: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """Bucket of the 1-, 2- and 3-gram that begins at each code (the last two codes are padding)."""
    n = len(codes) - 2
    h = np.zeros(n, np.uint32)
    for k in range(3):
        h = (h + codes[k : k + n] + np.uint32(k + 1)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        yield (h & np.uint32(buckets - 1)).astype(np.int32)


def blocks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: first, end, codes, start of each text, whether it has a letter."""
    for a, b in pieces((len(t) for t in texts), CHARS):
        made = [letter_codes(t) for t in texts[a:b]]
        sizes = np.array([len(c) for c, _ in made])
        yield a, b, np.concatenate([c for c, _ in made]), np.cumsum(sizes) - sizes, np.array([x for _, x in made])


def train(docs: DataFrame, buckets: int = BUCKETS, max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """Languages and their ``log P(bucket | language)`` with the log prior in the last column."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    share = min(1.0, max_train / max(1, rows.count()))
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                counts = np.zeros(buckets + 1)
                for a, b, codes, *_ in blocks(part["text"].tolist()):
                    counts[-1] += b - a
                    for g in grams(codes, buckets):
                        counts[:-1] += np.bincount(g, minlength=buckets)
                at = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})

    summed = chosen.mapInPandas(run, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toPandas()  # languages x buckets
    langs = sorted(found["lang"].unique().tolist())
    matrix = np.zeros((len(langs), buckets + 1))
    matrix[[langs.index(x) for x in found["lang"]], found["bucket"].to_numpy(int)] = found["n"]
    if langs:
        prior = np.log(matrix[:, -1:] / matrix[:, -1].sum())
        smooth = matrix[:, :-1] + 0.5
        matrix = np.hstack([np.log(smooth / smooth.sum(1, keepdims=True)), prior])
    return langs, matrix.astype(np.float32)


def predict(texts: list[str], langs: list[str], m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language (``und`` without a letter) and posterior of each text."""
    rows = [np.ascontiguousarray(r[:-1]) for r in m]
    names = np.array([*langs, "und"], object)
    best, score = np.full(len(texts), len(langs)), np.zeros(len(texts))
    for a, b, codes, starts, letter in blocks(texts) if langs else ():
        total = np.tile(m[:, -1].astype(np.float64), (b - a, 1))
        for g in grams(codes, m.shape[1] - 1):
            for k, row in enumerate(rows):
                total[:, k] += np.add.reduceat(row[g], starts, dtype=np.float64)
        top = total.argmax(1)
        prob = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        best[a:b] = np.where(letter, top, len(langs))
        score[a:b] = np.where(letter, prob, 0.0)
    return names[best], score


def language(docs: DataFrame, langs: list[str], matrix: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every text; ``score`` is the posterior of the prediction."""
    model = docs.sparkSession.sparkContext.broadcast(matrix)

    def make(texts: list[str]) -> tuple[dict, None]:
        found, score = predict(texts, langs, model.value)
        return {"lang_pred": found, "score": score}, None

    return map_texts(id_text(docs, id_col, text_col), make, "lang_pred string, score double")


def with_language(docs: DataFrame, langs: list[str], matrix: np.ndarray, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the predicted language as column ``out``; the rows stay where they are."""
    model = docs.sparkSession.sparkContext.broadcast(matrix)
    rest = docs.drop(out)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                found, _ = predict(texts, langs, model.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, out])
        give_back()

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(out, T.StringType())]))


def language_of_documents(docs: DataFrame, folds: int = 5, held: int = 0, max_train: int = MAX_TRAIN) -> DataFrame:
    """Learn from the documents outside fold ``held`` and predict for all."""
    langs, matrix = train(docs.filter(crc_mod("doc_id", folds) != held), max_train=max_train)
    out = language(docs, langs, matrix)
    return out.select("doc_id", (crc_mod("doc_id", folds) == held).alias("held_out"), "lang_pred", "score")
