"""Joins of the planning tables.

Sides are left to Spark's size statistics: a dimension below the broadcast threshold
is broadcast, anything larger is shuffled and split by skew handling at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_left_multi(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b, list(keys), "left")


def join_inner(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b, list(keys), "inner")


def join_outer(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b, list(keys), "full")


def join_left_outer_sub(a: DataFrame, b: DataFrame, key: Sequence[str], aggs: dict[str, Column], fill=0) -> DataFrame:
    """Left join to ``b`` grouped by the key; missing groups get ``fill``."""
    sub = b.groupBy(*key).agg(*[c.alias(n) for n, c in aggs.items()])
    return a.join(sub, list(key), "left").na.fill(fill, list(aggs))


def join_semi_anti(a: DataFrame, b: DataFrame, keys: Sequence[str], keep: bool = True) -> DataFrame:
    return a.join(b.select(*keys), list(keys), "left_semi" if keep else "left_anti")


def join_lookup_broadcast(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str, miss=None) -> DataFrame:
    """Dictionary lookup; a repeated dimension key gives its smallest value, a miss ``miss``."""
    table = dim.groupBy(F.col(dim_key).alias(key)).agg(F.min(value).alias(out))
    found = df.join(table, key, "left")
    return found if miss is None else found.withColumn(out, F.coalesce(out, F.lit(miss)))


def join_lookup_composite(df: DataFrame, dim: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Lookup on several keys at once, such as (period, origin, destination)."""
    table = dim.groupBy(*keys).agg(*[F.min(v).alias(v) for v in values])
    return df.join(table, list(keys), "left")


def join_update_from(df: DataFrame, src: DataFrame, keys: Sequence[str], set_cols: Sequence[str], src_order: Sequence[str]) -> DataFrame:
    """Overwrite columns from a matching source row, the first by ``src_order`` if several match."""
    first = F.min_by(F.struct(*set_cols), F.struct(*src_order)).alias("__new")
    new = src.groupBy(*keys).agg(first)
    joined = df.join(new, list(keys), "left")
    cols = [
        F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
        for c in df.columns
    ]
    return joined.select(*cols)


def join_self_parent(df: DataFrame, keys: Sequence[str], child: str, parent: str, carry: str, default, out: str) -> DataFrame:
    """A child row gets its parent's ``carry`` value, a row without parent the default.

    Only rows that have a parent take part in the join.
    """
    has = F.coalesce(F.col(parent) > 0, F.lit(False))
    source = df.select(*keys, F.col(child).alias(parent), F.col(carry).alias(out))
    below = df.filter(has).join(source, [*keys, parent], "left").select(*df.columns, out)
    top = df.filter(~has).withColumn(out, F.lit(default))
    return top.unionByName(below)


def join_chain3(a: DataFrame, b: DataFrame, c: DataFrame, ab: Sequence[str], bc: Sequence[str]) -> DataFrame:
    return a.join(b, list(ab)).join(c, list(bc))


def join_key_fallback(a: DataFrame, b: DataFrame, exact: str, normalise, value: str) -> DataFrame:
    """Match on the exact key, then on the normalised key; ``status`` tells which one held."""
    by_exact = b.groupBy(F.col(exact)).agg(F.min(value).alias("__exact"))
    by_norm = b.groupBy(normalise(F.col(exact)).alias("__norm")).agg(F.min(value).alias("__loose"))
    joined = a.join(by_exact, exact, "left").withColumn("__norm", normalise(F.col(exact))).join(by_norm, "__norm", "left")
    status = F.when(F.col("__exact").isNotNull(), "exact").when(F.col("__loose").isNotNull(), "normalised").otherwise("unmatched")
    return joined.withColumns({"status": status, value: F.coalesce("__exact", "__loose")}).drop("__norm", "__exact", "__loose")


def join_null_key_repair(df: DataFrame, key: str, source: str, sep: str = "-") -> DataFrame:
    """Fill a missing key from the part of ``source`` before the separator."""
    prefix = F.split(F.col(source), sep).getItem(0).try_cast(df.schema[key].dataType)
    return df.withColumn(key, F.coalesce(key, prefix))


def join_override_precedence(df: DataFrame, auto: str, edit: str, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(edit, auto))


EXPAND_BLOCK = 10_000


def expanded(df: DataFrame, n: Column, out: str) -> DataFrame:
    """One row for each of 1 ... ``n``; none where ``n`` is below one or null.

    Numbers are made in blocks, so no row ever holds an array longer than a block (or than the
    number of blocks).
    """
    last = n.cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / EXPAND_BLOCK))
    start = F.col("__block") * EXPAND_BLOCK
    numbers = F.sequence(start + 1, F.least(F.col("__n"), start + EXPAND_BLOCK))
    some = df.withColumn("__n", last).filter("__n >= 1").withColumn("__block", F.explode(blocks))
    return some.withColumn(out, F.explode(numbers)).drop("__n", "__block")


def join_theta_expand(df: DataFrame, weight: str, out: str = "n") -> DataFrame:
    """One row per unit of the weight, numbered from 1; none for a weight below one."""
    return expanded(df, F.col(weight), out)


def join_in_out_links(edges: DataFrame, attrs: Sequence[str], src: str = "from_id", dst: str = "to_id") -> DataFrame:
    """In-link and out-link profiles that meet at each node, with the number of link pairs.

    Links with equal attributes at a node are folded first, so that a node costs the
    square of its profiles, not of its links. A U-turn (back to the node the in-link
    came from) is no pair; U-turns are counted per far end and taken off.
    """
    ins = [F.col(a).alias(f"in_{a}") for a in attrs]
    outs = [F.col(a).alias(f"out_{a}") for a in attrs]
    in_names, out_names = [f"in_{a}" for a in attrs], [f"out_{a}" for a in attrs]
    in_far = edges.groupBy(F.col(dst).alias("node"), F.col(src).alias("far"), *ins).agg(F.count("*").alias("n_in"))
    out_far = edges.groupBy(F.col(src).alias("node"), F.col(dst).alias("far"), *outs).agg(F.count("*").alias("n_out"))
    turns = in_far.join(out_far, ["node", "far"])
    turns = turns.groupBy("node", *in_names, *out_names).agg(F.sum(-F.col("n_in") * F.col("n_out")).alias("n_pairs"))
    at_in = in_far.groupBy("node", *in_names).agg(F.sum("n_in").alias("n_in"))
    at_out = out_far.groupBy("node", *out_names).agg(F.sum("n_out").alias("n_out"))
    met = at_in.join(at_out, "node").withColumn("n_pairs", F.col("n_in") * F.col("n_out")).drop("n_in", "n_out")
    net = met.unionByName(turns).groupBy("node", *in_names, *out_names).agg(F.sum("n_pairs").alias("n_pairs"))
    return net.filter("n_pairs > 0")


def join_endpoint_match(links: DataFrame, tail: str = "from_id", head: str = "to_id") -> DataFrame:
    """Up- and downstream tags: how many links end where a link starts, and start where it ends."""
    ends = links.groupBy(F.col(head).alias("__n")).agg(F.count("*").alias("n_upstream"), F.min("id").alias("first_upstream"))
    starts = links.groupBy(F.col(tail).alias("__n")).agg(F.count("*").alias("n_downstream"), F.min("id").alias("first_downstream"))
    up = links.join(ends.withColumnRenamed("__n", tail), tail, "left")
    both = up.join(starts.withColumnRenamed("__n", head), head, "left")
    return both.na.fill(0, ["n_upstream", "n_downstream"])
