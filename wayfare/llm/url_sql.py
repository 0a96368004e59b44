"""DuckDB SQL of the URL verdicts: the levels of the template tree as common table expressions."""

from __future__ import annotations

from .urls import APART, DEPTH, FANOUT, FAR, LOWER, REJECT, RULES, SPREAD, UPPER, VARIABLE, WEIGHT


def _rules() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0])))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in ordered]
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    given = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return f"CASE {rule} END AS rule, CASE {given} END AS given"


def _smooth(b: str, n: str) -> str:
    return f"(({b}) + {WEIGHT / 2}) / (({n}) + {WEIGHT})"


def _key(seg: str) -> str:
    shape = f"regexp_replace({seg}, '{VARIABLE}', '#', 'g')"
    return f"CASE WHEN contains({shape}, '#') THEN '~' || {shape} ELSE '=' || {seg} END"


def _level(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (SELECT host, prefix, segs[{i}] AS seg, {_key(f'segs[{i}]')} AS key, coalesce({_key(f'segs[{i + 1}]')}, 'end') AS next, n, labelled, blocked FROM r{i - 1} WHERE len(segs) >= {i}),
c{i} AS MATERIALIZED (SELECT host, prefix, key, next, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked FROM a{i} WHERE key LIKE '=%' GROUP BY ALL),
b{i} AS (SELECT host, prefix, key, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked FROM c{i} GROUP BY ALL),
f{i} AS (SELECT *, count(*) OVER w AS members, sum(n) OVER w AS pn, sum(labelled) OVER w AS pl, sum(blocked) OVER w AS pb FROM b{i} WINDOW w AS (PARTITION BY host, prefix)),
w{i} AS (SELECT *, sum(n) OVER (PARTITION BY host, prefix, next) AS pool_next FROM c{i}),
g{i} AS (SELECT f.host, f.prefix, f.key, f.n, f.labelled, f.blocked, members, pn, pl, pb, sum(least(CAST(w.n AS DOUBLE) / f.n, CAST(pool_next AS DOUBLE) / pn)) AS overlap, count(*) AS classes
  FROM f{i} f JOIN w{i} w USING (host, prefix, key) WHERE members > 1 GROUP BY ALL),
s{i} AS (SELECT host, prefix, key, '*' AS step FROM g{i} WHERE (members >= {FANOUT} AND n * {FANOUT} < pn)
   OR (1 - overlap <= {FAR} + 0.5 * sqrt(CAST(classes AS DOUBLE) / n) AND abs({_smooth('blocked', 'labelled')} - {_smooth('pb', 'pl')}) <= {APART})
  UNION ALL SELECT host, prefix, key, key FROM a{i} WHERE key LIKE '~%' GROUP BY host, prefix, key HAVING count(DISTINCT seg) >= {SPREAD}),
r{i} AS MATERIALIZED (SELECT r.host, r.path, r.segs, r.prefix || coalesce('/' || coalesce(s.step, '=' || r.segs[{i}]), '') AS prefix, r.n, r.labelled, r.blocked
  FROM r{i - 1} r LEFT JOIN s{i} s ON s.host = r.host AND s.prefix = r.prefix AND s.key = {_key(f'r.segs[{i}]')})"""


def url_sql() -> str:
    last = DEPTH + 1
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
u AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
v AS MATERIALIZED (SELECT *, {_rules()} FROM u),
a AS (SELECT host, path, count(*) AS n, count(given) AS labelled, count(*) FILTER (given = 'block') AS blocked, string_split(substr(path, 2), '/') AS w FROM v GROUP BY host, path),
r0 AS (SELECT host, path, CASE WHEN path = '' THEN [] WHEN len(w) <= {DEPTH} THEN w ELSE list_append(w[1:{DEPTH}], '**') END AS segs, '' AS prefix, n, labelled, blocked FROM a),
{','.join(_level(i) for i in range(1, last + 1))},
t AS (SELECT host, prefix, {_smooth('sum(blocked)', 'sum(labelled)')} AS purity FROM r{last} GROUP BY host, prefix)
SELECT page_id, v.host, v.path, rule, coalesce(given, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, t.host || t.prefix AS template, round(purity, 9) + 0.0 AS purity
FROM v LEFT JOIN r{last} r ON r.host = v.host AND r.path = v.path LEFT JOIN t ON t.host = r.host AND t.prefix = r.prefix
"""
