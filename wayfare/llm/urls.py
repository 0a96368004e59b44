"""Operator 11: URL verdicts by rules, and elsewhere by the templates of labelled paths.

Rules are (host, path, verdict): a rule fits its host and all subdomains where the path starts with
the rule's, and the longest one wins. Urls without a rule are judged by a path-template tree, made of
DataFrame functions only. The urls that a rule has judged are the labels. Level by level, for each host
and template so far,

1. segments that hold digits or long hexadecimal runs are variable where their shape (those replaced
   by ``#``) has at least ``SPREAD`` different values; plain segments are variable where the place has
   at least ``FANOUT`` of them and the segment less than a ``FANOUT``-th of the urls: each becomes a
   wildcard;
2. plain segments whose next segments are distributed as those of all plain segments of the place
   (total variation distance), and whose smoothed share of blocked urls is alike, become one wildcard.

A template is rejected where its smoothed share of blocked urls, ``(blocked + WEIGHT / 2) / (labelled
+ WEIGHT)``, is at least ``REJECT``. Without labels that share is a half; as ``APART`` is less than the
way from there to ``REJECT``, a branch without labels does not join branches that are rejected.
Templates look at the first ``DEPTH`` segments and whether more follow. What is grouped are different paths with
counts, so copies of a url meet as one row, and a host of any size is dealt out by its segments.

A null url, or one without ``://``, has an empty host and path. Null ids and repeated rows are kept, each
with its verdict; an empty table gives no rows; other columns are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VARIABLE = "[0-9A-Fa-f]{8,}|[0-9]+"
DEPTH, SPREAD, FANOUT = 6, 3, 20
FAR, WEIGHT, APART, REJECT = 0.2, 5.0, 0.15, 0.7

# The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_parts(df: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path`` of each url."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = df.select(F.col(id_col).alias("page_id"), after.alias("rest"))
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr("rest", F.length(host) + 1), "^[^?#]*", 0)
    return rest.select("page_id", F.translate(host, UPPER, LOWER).alias("host"), path.alias("path"))


def by_rule(rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``host`` and ``path``, else null."""
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _smoothed(blocked: str | Column, labelled: str | Column) -> Column:
    b, n = (F.col(c) if isinstance(c, str) else c for c in (blocked, labelled))
    return (b + WEIGHT * 0.5) / (n + WEIGHT)


COUNTS = ["n", "labelled", "blocked"]


def _added(to: str = "") -> list[Column]:
    return [F.sum(c).alias(to + c) for c in COUNTS]


def _key(seg: Column) -> Column:
    """``=`` and the segment, or ``~`` and its shape where it has variable parts; null stays."""
    shape = F.regexp_replace(seg, VARIABLE, "#")
    return F.when(F.contains(shape, F.lit("#")), F.concat(F.lit("~"), shape)).otherwise(F.concat(F.lit("="), seg))


def level_steps(rows: DataFrame, level: int) -> DataFrame:
    """``host, prefix, key, step``: what the segments of a level become in the template, where not themselves.

    ``rows`` is (host, prefix, segs, n, labelled, blocked).
    """
    place = ["host", "prefix"]
    seg = F.get("segs", F.lit(level - 1))
    following = F.coalesce(_key(F.get("segs", F.lit(level))), F.lit("end"))
    at = rows.select(*place, seg.alias("seg"), _key(seg).alias("key"), following.alias("next"), *COUNTS).filter("seg IS NOT NULL")
    shaped = at.filter("key LIKE '~%'").groupBy(*place, "key").agg(F.count_distinct("seg").alias("values")).filter(F.col("values") >= SPREAD)

    children = cut(at.filter("key LIKE '=%'").groupBy(*place, "key", "next").agg(*_added()))
    branches = children.groupBy(*place, "key").agg(*_added())
    pool = branches.groupBy(*place).agg(F.count("*").alias("members"), *_added("pool_")).filter("members > 1")
    whole = children.groupBy(*place, "next").agg(F.sum("n").alias("pool_next"))
    members = branches.join(pool, place)
    own = children.select(*place, "key", "next", F.col("n").alias("next_n")).join(whole, [*place, "next"])
    least = F.least(F.col("next_n") / F.col("n"), F.col("pool_next") / F.col("pool_n"))
    stated = [c for c in members.columns if c not in (*place, "key")]
    near = own.join(members, [*place, "key"]).groupBy(*place, "key", *stated).agg(F.sum(least).alias("overlap"), F.count("*").alias("classes"))
    rare = (F.col("members") >= FANOUT) & (F.col("n") * FANOUT < F.col("pool_n"))
    alike = (1 - F.col("overlap") <= FAR + 0.5 * F.sqrt(F.col("classes") / F.col("n"))) & (
        F.abs(_smoothed("blocked", "labelled") - _smoothed("pool_blocked", "pool_labelled")) <= APART
    )
    wild = near.filter(rare | alike).select(*place, "key", F.lit("*").alias("step"))
    return shaped.select(*place, "key", F.col("key").alias("step")).union(wild)


def path_templates(paths: DataFrame) -> DataFrame:
    """``host, path, template, purity`` for different (host, path) with ``n, labelled, blocked``.

    ``purity`` is the smoothed share of blocked urls of the template.
    """
    whole = F.split(F.substr("path", F.lit(2)), "/")
    segs = F.when(F.col("path") == "", F.array().cast("array<string>")).when(F.size(whole) <= DEPTH, whole).otherwise(F.concat(F.slice(whole, 1, DEPTH), F.array(F.lit("**"))))
    rows = cut(paths.select("host", "path", segs.alias("segs"), F.lit("").alias("prefix"), *COUNTS))
    for level in range(1, (rows.agg(F.max(F.size("segs"))).first()[0] or 0) + 1):
        seg = F.get("segs", F.lit(level - 1))
        placed = rows.withColumn("key", _key(seg)).join(level_steps(rows, level), ["host", "prefix", "key"], "left")
        step = F.coalesce("step", F.concat(F.lit("="), seg))
        prefix = F.concat("prefix", F.coalesce(F.concat(F.lit("/"), step), F.lit("")))
        rows = cut(placed.select("host", "path", "segs", prefix.alias("prefix"), *COUNTS))
    judged = rows.groupBy("host", "prefix").agg(_smoothed(F.sum("blocked"), F.sum("labelled")).alias("purity"))
    return rows.join(judged, ["host", "prefix"]).select("host", "path", F.concat("host", "prefix").alias("template"), "purity")


def url_verdicts(df: DataFrame, rules: Sequence[tuple[str, str, str]] = tuple(RULES), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each url: ``page_id, host, path, rule, verdict, template, purity``."""
    parts = cut(url_parts(df, id_col, url_col).withColumn("found", by_rule(rules)).select("page_id", "host", "path", "found.rule", F.col("found.verdict").alias("given")))
    paths = parts.groupBy("host", "path").agg(F.count("*").alias("n"), F.count("given").alias("labelled"), F.count_if(F.col("given") == "block").alias("blocked"))
    placed = parts.join(path_templates(paths), ["host", "path"], "left")
    verdict = F.coalesce("given", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return placed.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
