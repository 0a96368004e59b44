"""DuckDB SQL of the collocations."""

from __future__ import annotations

from .urls import LOWER, UPPER

_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS size, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM p, range(1, len(w) - {k - 2}) AS t(i)" for k in (1, 2, 3, 4))
_CUTS = " UNION ALL ".join(f"SELECT lang, phrase, a, {k} AS k, array_to_string(w[1:{k}], ' ') AS lft, array_to_string(w[{k + 1}:], ' ') AS rgt FROM c WHERE size > {k}" for k in (1, 2, 3))
_INNER = " UNION ALL ".join(
    f"SELECT lang, array_to_string(w[{i}:{i + k - 1}], ' ') AS phrase, a AS longer FROM x WHERE size >= {max(i + k - 1, k + 1)}" for k in (2, 3) for i in range(1, 6 - k)
)

PHRASE_SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS MATERIALIZED (SELECT lang, w FROM (SELECT lang, [y FOR y IN regexp_split_to_array(piece, '[ \\x09]+') IF y <> ''] AS w FROM d) z WHERE len(w) > 0),
g AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM ({_GRAMS}) q GROUP BY lang, size, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE size = 1 GROUP BY lang),
x AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE size > 1 AND f >= 30),
i AS (SELECT lang, phrase, max(longer) AS longer FROM ({_INNER}) q GROUP BY lang, phrase),
c AS MATERIALIZED (SELECT x.* FROM x LEFT JOIN i ON i.lang = x.lang AND i.phrase = x.phrase WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
s AS (SELECT q.lang, q.phrase, a, k, l.f AS l, r.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM ({_CUTS}) q JOIN g l ON l.lang = q.lang AND l.phrase = q.lft JOIN g r ON r.lang = q.lang AND r.phrase = q.rgt),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) z JOIN n USING (lang) WHERE rank <= 2000
"""
