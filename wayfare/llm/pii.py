"""Operator 1: personal data by pattern, and by bootstrapped contextual extraction.

Base patterns find emails, addresses, cards and phone numbers; these are the seeds. The whole word
before a seed, parted from it by white space, is a lexical pattern for its kind. Patterns and instances (the tokens that stand after a
pattern) form a graph that is scored in rounds: a pattern is worth the share of all its occurrences
in the corpus that are followed by an instance of its kind, an instance what its patterns are worth.
Instances of high confidence bring new patterns: the words before their other occurrences, if enough
distinct instances stand after them and make up enough of their occurrences. Rounds go on until none
is added and no score moves by more than ``STILL``. Patterns of high confidence discover tokens with a digit or an at sign that no base pattern
found; up to seven groups of digits with one space between them are one token.

Everything is built from DataFrame functions. Positions come from splitting a text by a pattern and
summing the lengths of the parts in a window, so a text with many matches stays linear. Spans are
code points, the end exclusive. Null texts count as empty and have no spans; rows with equal or null
ids are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, id_text

KINDS = ("email", "ip", "card", "phone")
# Two digits or more, perhaps in brackets or with hyphens: a piece of an identifier written with spaces.
GROUP = r"\(?[0-9](?=[()-]*+[0-9])[0-9()-]*+"
# The base patterns, written so that the engine never goes back: possessive repeats, and starts
# only where a run begins (or where the last match ended).
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Only runs of 12 to 19 digits: other runs fail the test on digits anyway.
    r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    # Tokens that could be identifiers.
    rf"(?<!\S)(?:\+?{GROUP}(?:\x20{GROUP}(?=[\s,;:!?]|\z)){{1,6}}+[,;:!?]*+(?!\S)|(?=[^\s0-9@]*+[0-9@])\S++)",
)
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_VALID = rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"
TOKEN = len(KINDS)
ROUNDS = 3
CONFIDENT = 0.6
MIN_SEEDS = 5
STILL = 0.02
CONTEXT = 64  # characters looked at for the word on the left


def word_before(gap: Column, i: Column) -> Column:
    """The lower-cased word that ends a gap before white space; empty if it is cut off or glued to the match."""
    tail = F.substring(F.rtrim(F.translate(gap, "\n\t\r\f\x0b", "     ")), -CONTEXT - 1, CONTEXT + 1)
    parted = F.substring(gap, -1, 1).isin(" ", "\n", "\t", "\r", "\f", "\x0b")
    whole = tail.contains(" ") | ((i == 0) & (F.length(tail) <= CONTEXT))
    return F.when(parted & whole, F.lower(F.substring_index(tail, " ", -1))).otherwise("")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string fits."""
    n = F.length(digits)
    places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))

    def term(total: Column, i: Column) -> Column:
        d = F.coalesce(F.substring(digits, n - i + 1, F.lit(1)).cast("int"), F.lit(0))
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(places, F.lit(0), term) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == 1, value.rlike(IP_VALID))
        .when(kind == 2, n.between(12, 19) & F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(9, 15))
        .otherwise(True)
    )


def tagged(kind: int):
    """The fields of a match with its kind before them."""
    return lambda x: F.struct(F.lit(kind).alias("kind"), *[x[f].alias(f) for f in ("i", "gap", "left", "value")])


def matches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, check, kind, start, end, value, left`` of all matches, and one row with a null value for each document and kind."""
    docs = id_text(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    parts = []
    for k, pattern in enumerate(PATTERNS):
        gaps, found = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if k == 0:
            has = F.col("text").contains("@")
        elif k == 3:
            has = F.col("text").contains("+")
        else:
            has = F.col("text").rlike("[0-9]" if k < TOKEN else "[0-9@]")
        pairs = F.transform(
            F.arrays_zip(gaps.alias("gap"), found.alias("value")),
            lambda x, i: F.struct(
                i.alias("i"),
                F.length(x["gap"]).alias("gap"),
                word_before(x["gap"], i).alias("left"),
                x["value"].alias("value"),
            ),
        )
        whole = F.array(F.struct(F.lit(0).alias("i"), F.length("text").alias("gap"), F.lit("").alias("left"), F.lit(None).cast("string").alias("value")))
        items = F.when(has, pairs).otherwise(whole)
        parts.append(F.transform(items, tagged(k)))
    rows = docs.select("row", "doc_id", F.xxhash64("text").alias("check"), F.length("text").alias("size"), F.explode(F.concat(*parts)).alias("m"))
    rows = rows.select("row", "doc_id", "check", "size", "m.*")
    # Gaps and matches of one kind add to the length of the text, so one sum serves all kinds.
    before = F.sum(F.col("gap") + F.coalesce(F.length("value"), F.lit(0))).over(W.partitionBy("row").orderBy("kind", "i").rowsBetween(W.unboundedPreceding, W.currentRow))
    end = before - F.col("kind").cast("long") * F.col("size")
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.coalesce(F.length("value"), F.lit(0)))
    kept = F.col("value").isNull() | valid(F.col("kind"), F.col("value"))
    return rows.filter(kept).select("row", "doc_id", "check", "kind", "start", "end", "value", "left")


def outside(found: DataFrame) -> DataFrame:
    """Candidate tokens that meet no base span."""
    order = W.partitionBy("row").orderBy("start", "kind")
    base = F.col("kind") < TOKEN
    seen = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing))
    # Rows of equal start come in kind order, so the candidate follows the base span it meets.
    rows = found.filter(F.col("value").isNotNull()).withColumns({"seen": seen, "after": after})
    free = (F.coalesce("seen", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    return rows.filter((F.col("kind") == TOKEN) & free).drop("seen", "after")


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """How often each lower-cased word occurs in the corpus."""
    words = F.split(F.lower(F.translate(F.coalesce(F.col(text_col), F.lit("")), "\n\t\r\f\x0b", "     ")), " ")
    return df.select(F.explode(words).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("occurrences"))


def score_patterns(edges: DataFrame, counts: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``left, kind, score`` of the confident patterns, after ``rounds`` rounds and as many more as add or move patterns.

    ``edges`` has ``left, value, kind, n``: seeds with their kind, candidates with kind ``TOKEN``.
    """
    seen = cut(edges.select("left").distinct().join(counts, F.col("left") == F.col("word")).select("left", "occurrences"))
    seeds = edges.filter(F.col("kind") < TOKEN).groupBy("left", "kind").agg(F.sum("n").alias("n"), F.count("*").alias("seeds"))
    seeds = cut(seeds.join(seen, "left"))
    patterns = cut(seeds.filter(F.col("seeds") >= min_seeds).select("left", "kind", (F.col("n") / F.col("occurrences")).alias("score")))
    loose = edges.filter(F.col("kind") == TOKEN).select("left", "value", F.col("n").alias("m"))
    done, some = 0, patterns.limit(1).count()
    while some:
        # An instance is worth the mean of its patterns, weighed by how often they meet.
        meets = loose.join(patterns, "left")
        worth = meets.groupBy("value", "kind").agg((F.sum(F.col("score") * F.col("m")) / F.sum("m")).alias("worth")).filter(F.col("worth") >= confident / 2)
        sure = F.col("worth") >= confident
        gained = loose.join(worth, "value").groupBy("left", "kind").agg(
            F.sum(F.col("worth") * F.col("m")).alias("more"), F.sum(F.when(sure, F.col("worth") * F.col("m"))).alias("firm"), F.count(F.when(sure, 1)).alias("found")
        )
        both = seeds.drop("occurrences").join(gained, ["left", "kind"], "full").join(patterns.select("left", "kind", F.col("score").alias("old")), ["left", "kind"], "left").join(seen, "left")
        n = F.coalesce("n", F.lit(0))
        share, firm = (n + F.coalesce("more", F.lit(0.0))) / F.col("occurrences"), (n + F.coalesce("firm", F.lit(0.0))) / F.col("occurrences")
        backed = F.coalesce("seeds", F.lit(0)) + F.coalesce("found", F.lit(0)) >= min_seeds
        known = F.col("old").isNotNull()
        scored = both.filter(known | (backed & (firm >= confident))).select("left", "kind", F.when(known, share).otherwise(firm).alias("score"), "old")
        scored, done = cut(scored), done + 1
        moved = scored.filter(F.col("old").isNull() | (F.abs(F.col("score") - F.col("old")) > STILL)).limit(1).count()
        patterns = scored.drop("old")
        if done >= rounds and not moved:
            break
    return patterns.filter(F.col("score") >= confident).select("left", "kind", "score")


def found_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, confident: float = CONFIDENT, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``row, doc_id, check, kind, start, end, added`` of all spans, and rows with null ``start`` so that every document appears."""
    found = cut(matches(df, id_col, text_col))
    loose = outside(found)
    seeds = found.filter((F.col("kind") < TOKEN) & F.col("value").isNotNull())
    edges = cut(seeds.select("left", "value", "kind").union(loose.select("left", "value", "kind")).filter("left <> ''").groupBy("left", "value", "kind").agg(F.count("*").alias("n")))
    patterns = score_patterns(edges, word_counts(df, text_col), rounds, confident, min_seeds)
    best = patterns.groupBy("left").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("found_kind"))
    added = loose.join(best, "left").select("row", "doc_id", "check", F.col("found_kind").alias("kind"), "start", "end", F.lit(True).alias("added"))
    base = found.filter((F.col("kind") < TOKEN) & (F.col("value").isNotNull() | (F.col("kind") == 0)))
    has = F.col("value").isNotNull()
    base = base.select("row", "doc_id", "check", "kind", F.when(has, F.col("start")).alias("start"), F.when(has, F.col("end")).alias("end"), F.lit(False).alias("added"))
    return base.union(added)


def joined(spans: Column) -> Column:
    """Sorted spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: counts by kind, digest of the base spans, all spans."""
    rows = found_spans(df, id_col, text_col)
    real, base = F.col("start").isNotNull(), F.col("start").isNotNull() & ~F.col("added")
    span = F.struct("start", "kind", "end")
    counts = [F.count(F.when(base & (F.col("kind") == k), 1)).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    out = rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), *counts,
        F.array_sort(F.collect_list(F.when(base, span))).alias("base"),
        F.array_sort(F.collect_list(F.when(real, span))).alias("all"),
    )
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with each span of personal data replaced by its kind in brackets; other columns stay.

    Overlapping spans are replaced as one, by the kind of the one that begins first (then listed first).
    """
    rows = found_spans(df, id_col, text_col).filter(F.col("start").isNotNull())
    order = W.partitionBy("row").orderBy("start", "kind", "end").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("new", (F.col("start") >= F.coalesce(F.max("end").over(order), F.lit(0))).cast("int"))
    rows = rows.withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    rows = rows.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.first("check").alias("check"), F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind")).alias("kind")
    )
    spans = rows.groupBy("row").agg(F.first("doc_id").alias("span_id"), F.first("check").alias("span_check"), F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("span_list"))
    # Rows with the same id and text have the same spans; one of them is enough.
    spans = spans.groupBy("span_id", "span_check").agg(F.first("span_list").alias("span_list"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.withColumn("span_key", F.xxhash64(text))
    met = docs.join(spans, F.col(id_col).eqNullSafe(F.col("span_id")) & (F.col("span_key") == F.col("span_check")), "left")
    n = F.size("span_list")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    last = F.col("span_list")[n - 1]["end"]
    pieces = F.transform(
        F.col("span_list"),
        lambda s, i: F.concat(
            F.substring(text, (F.when(i > 0, F.col("span_list")[i - 1]["end"]).otherwise(0) + 1).cast("int"), (s["start"] - F.when(i > 0, F.col("span_list")[i - 1]["end"]).otherwise(0)).cast("int")),
            F.get(names, s["kind"]),
        ),
    )
    new = F.concat(F.array_join(pieces, ""), F.substring(text, (last + 1).cast("int"), F.length(text)))
    return met.withColumn(text_col, F.when(F.coalesce(n, F.lit(0)) > 0, new).otherwise(F.col(text_col))).select(*df.columns)
