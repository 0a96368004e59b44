"""Driver forms: crash models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import safety as saf
from .registry import query


def case(col, table, i=None):
    arms = " ".join(f"WHEN '{k}' THEN CAST({float(v if i is None else v[i])!r} AS DOUBLE)" for k, v in table.items())
    return f"CASE {col} {arms} END"


def _steps(col, table):
    def line(f):
        return f"CASE WHEN adt < 400 THEN {f[0]} WHEN adt > 2000 THEN {f[1]} ELSE {f[0]} + {f[2]:.9f} * (adt - 400) END"

    arms = " ".join(f"WHEN {col} >= {w} THEN {line(f)}" for w, f in table if w is not None)
    return f"CASE {arms} ELSE {line(table[-1][1])} END"


def _fwy(name):
    slope, table = saf.FREEWAY[name]
    return f"COALESCE(mi * EXP({case('fk', table)} + {slope} * LN(NULLIF(0.001 * adt, 0))), 0)"


def _art(name):
    return f"EXP({case('uk', saf.ARTERIAL[name], 0)} + {case('uk', saf.ARTERIAL[name], 1)} * LN(NULLIF(adt, 0))) * length"


_DRV = "(" + case("uk", {k: saf.DRIVEWAY_DENSITY * sum(v[0]) for k, v in saf.DRIVEWAYS.items()}) + f") * POW(adt / 15000, {case('uk', saf.DRIVEWAYS, 1)})"
_LIT = f"(1 - {case('uk', saf.NIGHT, 0)} * (1 - 0.72 * {case('uk', saf.NIGHT, 1)} - 0.83 * {case('uk', saf.NIGHT, 2)}))"
_WALK = f"CASE WHEN speed_limit <= 30 THEN {case('uk', saf.PEDESTRIAN, 0)} + {case('uk', saf.BICYCLE, 0)} ELSE {case('uk', saf.PEDESTRIAN, 1)} + {case('uk', saf.BICYCLE, 1)} END"
SEGMENT_SQL = f"""
SELECT id, 0.0188 * fi + 0.013 * two AS fatal, (1 - 0.0188) * fi + (1 - 0.679 - 0.013) * two AS injury, pdo + 0.679 * two AS pdo FROM (
 SELECT id, hf * (CASE WHEN onf THEN ffi ELSE 0 END + CASE WHEN onm THEN mfi ELSE 0 END + CASE WHEN onu THEN COALESCE(ufi, 0) ELSE 0 END) AS fi,
  hf * (CASE WHEN onf THEN fpd ELSE 0 END + CASE WHEN onm THEN mto - mfi ELSE 0 END + CASE WHEN onu THEN COALESCE(uto, 0) - COALESCE(ufi, 0) ELSE 0 END) AS pdo, hf * CASE WHEN on2 THEN t2 ELSE 0 END AS two FROM (
  SELECT *, (amv + asv + drv) * lit * (1 + wk) AS uto, ((amv * amf / NULLIF(amf + amp, 0)) + (asv * asf / NULLIF(asf + asp, 0)) + drv * {case('uk', saf.DRIVEWAYS, 2)}) * lit + (amv + asv + drv) * lit * wk AS ufi FROM (
   SELECT *, ({_fwy('sv_fi')} + {_fwy('mv_fi')}) * CASE WHEN lane_width < 13 THEN EXP(-0.0376 * (lane_width - 12)) ELSE 0.963 END * CASE WHEN median = 1 THEN 0.131 ELSE 1 END AS ffi,
    ({_fwy('sv_pdo')} + {_fwy('mv_pdo')}) * CASE WHEN median = 1 THEN 0.169 ELSE 1 END AS fpd,
    CASE WHEN divided = 1 THEN EXP(-9.025 + 1.049 * LN(NULLIF(adt, 0))) ELSE EXP(-9.653 + 1.176 * LN(NULLIF(adt, 0))) END * length * rmf AS mto0,
    COALESCE(CASE WHEN divided = 1 THEN EXP(-9.025 + 1.049 * LN(NULLIF(adt, 0))) ELSE EXP(-9.653 + 1.176 * LN(NULLIF(adt, 0))) END * length * rmf, 0) AS mto,
    COALESCE(CASE WHEN divided = 1 THEN EXP(-8.837 + 0.958 * LN(NULLIF(adt, 0))) ELSE EXP(-9.410 + 1.094 * LN(NULLIF(adt, 0))) END * length * rmf, 0) AS mfi,
    adt * length * 365e-6 * EXP(-0.312) * (({_steps('lane_width', saf.LANE_FACTORS['two_lane'])} - 1) * 0.574 + 1) * (({_steps('shoulder', saf.SHOULDER_FACTORS)} - 1) * 0.574 + 1) * CASE WHEN turn_lane = 1 THEN 0.882 ELSE 1 END AS t2,
    {_art('mv')} AS amv, {_art('mv_fi')} AS amf, {_art('mv_pdo')} AS amp, {_art('sv')} AS asv, {_art('sv_fi')} AS asf, {_art('sv_pdo')} AS asp, {_DRV} AS drv, {_LIT} AS lit, {_WALK} AS wk FROM (
    SELECT *, (fc IN (1, 11, 12) OR access = 3) AS onf, (access <> 3 AND fc < 10 AND ((dir = 0 AND lanes > 3) OR (dir <> 0 AND lanes > 1))) AS onm,
     (access <> 3 AND fc < 10 AND ((dir = 0 AND lanes < 4) OR (dir <> 0 AND lanes = 1))) AS on2, (access <> 3 AND fc > 10 AND fc < 20) AS onu,
     CASE WHEN length - 0.5 * (COALESCE(entry_ramp, 0) + COALESCE(exit_ramp, 0)) > 0 THEN length - 0.5 * (COALESCE(entry_ramp, 0) + COALESCE(exit_ramp, 0)) ELSE length END AS mi,
     CASE WHEN fc < 10 THEN CASE WHEN (dir = 0 AND lanes = 4) OR (dir <> 0 AND lanes = 2) THEN 'r2' WHEN (dir = 0 AND lanes = 6) OR (dir <> 0 AND lanes = 3) THEN 'r3' WHEN (dir = 0 AND lanes >= 8) OR (dir <> 0 AND lanes >= 4) THEN 'r4' END
      ELSE CASE WHEN (dir = 0 AND lanes = 4) OR (dir <> 0 AND lanes = 2) THEN 'u2' WHEN (dir = 0 AND lanes = 6) OR (dir <> 0 AND lanes = 3) THEN 'u3' WHEN (dir = 0 AND lanes = 8) OR (dir <> 0 AND lanes >= 4) THEN 'u4'
       WHEN dir = 0 AND lanes >= 10 THEN 'u5' END END AS fk,
     CASE WHEN dir = 0 AND lanes = 2 AND divided <> 1 THEN '2U' WHEN (dir = 0 AND lanes < 4) OR (dir <> 0 AND lanes = 1) THEN '3T' WHEN (dir = 0 AND lanes IN (5, 7)) OR (dir <> 0 AND lanes > 1) THEN '5T' WHEN divided <> 1 THEN '4U' ELSE '4D' END AS uk,
     CASE WHEN divided = 1 THEN (({_steps('lane_width', saf.LANE_FACTORS['divided'])} - 1) * 0.5 + 1) * CASE WHEN shoulder >= 8 THEN 1 WHEN shoulder >= 6 THEN 1.04 WHEN shoulder >= 4 THEN 1.09 WHEN shoulder >= 2 THEN 1.13 ELSE 1.18 END
      ELSE (({_steps('lane_width', saf.LANE_FACTORS['undivided'])} - 1) * 0.27 + 1) * (({_steps('shoulder', saf.SHOULDER_FACTORS)} - 1) * 0.27 + 1) END AS rmf
    FROM (SELECT *, CAST(CASE WHEN dir = 0 THEN flow ELSE 2 * flow END AS DOUBLE) AS adt, CASE WHEN dir = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS hf FROM v_saf) a) b) c) d) e"""


@query("id:i fatal:f8 injury:f8 pdo:f8", SEGMENT_SQL)
def saf_segment_crashes(t):
    return saf.saf_segment_crashes(t.v_saf)


def _node(kind, table):
    return f"EXP({case(kind, table, 0)} + {case(kind, table, 1)} * hi + {case(kind, table, 2)} * lo)"


_N, _U = saf.RURAL_NODES, saf.URBAN_NODES
NODE_SQL = f"""
SELECT node, CASE WHEN urban = 1 THEN ufi * 0.0188 WHEN multilane = 1 THEN nm * fs ELSE n2 * fs END AS fatal,
 CASE WHEN urban = 1 THEN ufi * (1 - 0.0188) WHEN multilane = 1 THEN nmf - nm * fs ELSE n2 * (1 - fs - ps) END AS injury,
 CASE WHEN urban = 1 THEN mv + sv + wk - ufi WHEN multilane = 1 THEN nm - nmf ELSE n2 * ps END AS pdo FROM (
 SELECT *, mv * mf / (mf + mp) + sv * sf / (sf + sp) + wk AS ufi FROM (
  SELECT *, CASE uk WHEN '3ST' THEN 0.021 * (mv + sv) WHEN '4ST' THEN 0.022 * (mv + sv) WHEN '3SG' THEN EXP(-6.60 + 0.05 * LN(int_adt + 1) + 0.24 * (lo - hi) + 0.41 * LN(400) + 0.09 * nl)
    ELSE EXP(-9.53 + 0.40 * LN(int_adt + 1) + 0.26 * (lo - hi) + 0.45 * LN(700) + 0.04 * nl) END + (mv + sv) * {case('uk', saf.NODE_BICYCLE)} AS wk FROM (
   SELECT *, {_node('rk', _N['two_lane'])} AS n2, {_node('rk', _N['multi'])} AS nm, {_node('rk', _N['multi_fi'])} AS nmf, {case('rk', saf.RURAL_FATAL)} AS fs, {case('rk', saf.RURAL_PDO)} AS ps,
    {_node('uk', _U['mv'])} AS mv, {_node('uk', _U['mv_fi'])} AS mf, {_node('uk', _U['mv_pdo'])} AS mp, {_node('uk', _U['sv'])} AS sv,
    COALESCE({_node('uk', _U['sv_fi'])}, {case('uk', saf.SINGLE_FI_SHARE)} * {_node('uk', _U['sv'])}) AS sf, {_node('uk', _U['sv_pdo'])} AS sp, CASE WHEN multilane = 1 THEN 4 ELSE 2 END AS nl FROM (
    SELECT *, LN(max_adt + 1) AS hi, LN(min_adt + 1) AS lo, CASE WHEN control = 1 THEN 'SG' WHEN legs = 3 THEN '3ST' ELSE '4ST' END AS rk,
     CONCAT(CASE WHEN legs = 3 THEN '3' ELSE '4' END, CASE WHEN control = 1 THEN 'SG' ELSE 'ST' END) AS uk FROM v_saf_node WHERE zone IS NULL AND legs > 2 AND access = 1 AND control > 0) a) b) c) d"""


def _nodes(t):
    n = F.col("node")
    return saf.node_volumes(t.v_saf).withColumns(
        {
            "control": (n % 3).cast("int"),
            "access": F.when(n % 5 == 0, 2).otherwise(1),
            "urban": (n % 2 == 0).cast("int"),
            "multilane": (n % 4 < 2).cast("int"),
            "zone": F.when(n % 19 == 0, n),
        }
    )


@query("node:i fatal:f8 injury:f8 pdo:f8", NODE_SQL)
def saf_node_crashes(t):
    return saf.saf_node_crashes(_nodes(t))


@query(
    "id:i fatal:f8 injury:f8 pdo:f8 crashes:f8",
    f"""
WITH s AS ({SEGMENT_SQL}), n AS ({NODE_SQL}), e AS (SELECT id, flow, from_id AS node FROM v_saf UNION ALL SELECT id, flow, to_id FROM v_saf),
 w AS (SELECT node, SUM(flow) AS nf FROM e GROUP BY node HAVING SUM(flow) <> 0),
 a AS (SELECT e.id, SUM(flow * n.fatal / nf) AS fatal, SUM(flow * n.injury / nf) AS injury, SUM(flow * n.pdo / nf) AS pdo FROM e JOIN n ON n.node = e.node JOIN w ON w.node = e.node GROUP BY e.id)
SELECT id, f AS fatal, i AS injury, p AS pdo, f + i + p AS crashes FROM (SELECT s.id, 1.20 * (s.fatal + COALESCE(a.fatal, 0)) AS f, 1.79 * (s.injury + COALESCE(a.injury, 0)) AS i, 2.59 * (s.pdo + COALESCE(a.pdo, 0)) AS p FROM s LEFT JOIN a ON a.id = s.id) z""",
)
def saf_distribute_nodes(t):
    return saf.saf_distribute_nodes(saf.saf_segment_crashes(t.v_saf), saf.saf_node_crashes(_nodes(t)))
