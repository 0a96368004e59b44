"""Operator 13: scores and ranks of the phrases counted in :mod:`.phrases`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import win_group_seq
from .phrases import phrase_counts


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def sub_phrases(phrases: DataFrame, least_size: int) -> DataFrame:
    """Every phrase with each shorter run of its words of ``least_size`` words at least, as ``part``."""
    words = F.split("phrase", " ")
    starts = F.sequence(F.lit(1), F.col("size"))
    runs = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(i, F.col("size")), lambda j: F.struct((j - i + 1).alias("k"), F.array_join(F.slice(words, i, j - i + 1), " ").alias("part")))))
    inner = F.filter(runs, lambda r: (r["k"] >= least_size) & (r["k"] < F.col("size")))
    return phrases.select("lang", "f", F.explode(inner).alias("r")).select("lang", "f", "r.part")


def collocations(df: DataFrame, least: int = 30, first: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``first`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Score: of the cuts of a phrase, the least floor(2000000 * a / (l + r)), the first of equal ones. Phrases
    that have a longer frequent phrase around them with at least 80 % of their count are left out.
    """
    counts, totals = phrase_counts(df, least, text_col, lang_col)
    phrases = counts.filter("size > 1")
    around = sub_phrases(phrases, 2).groupBy("lang", F.col("part").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = phrases.join(around, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * _wide("longer") < 80 * _wide("f")))
    words = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("left"), F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("right")),
    )
    cut_up = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = cut_up.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    scored = both.withColumns({"num": 2_000_000 * _wide("a"), "den": _wide("l") + _wide("r")}).withColumn("score", F.expr("num div den"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")
    ranked = win_group_seq(best, ["lang"], ["-score", "-a", "phrase"], "rank").filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
