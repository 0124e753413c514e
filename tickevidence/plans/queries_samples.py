"""Registered queries: samples, labels, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators import rules as R
from tickevidence.operators import sampling as S
from tickevidence.plans.registry import query
from tickevidence.plans.tape import POLICY, TAPE_SQL, option_tape
from tickevidence.session import stage_table

US = 1_000_000
_AGE = int(POLICY.quote_max_age_seconds) * US
_LOOK = int(POLICY.lookback_seconds) * US
_HOR = int(POLICY.horizon_seconds) * US
_GAP = int(POLICY.max_gap_seconds) * US
_STEP = int(POLICY.anchor_seconds) * US
_AV = int(POLICY.analytics_max_age_seconds) * US
_SRC = int(POLICY.analytics_source_max_age_seconds) * US
_DAY = 86_400 * US


def live_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_tape(spark, sf_dir).filter("source_version = '2'")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.build_samples(live_tape(spark, sf_dir), POLICY, "driver-events")


def staged_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples as a stage table, for work that passes over them several times."""
    return stage_table(samples(spark, sf_dir), "samples")


def _side_sql(side: str) -> str:
    s = side.lower()
    return f"""
q_{s} AS (
  SELECT *, sum(brk) OVER (PARTITION BY underlying, trading_date ORDER BY t_us) AS seg,
         CASE WHEN (bid + ask) / 2 > 0 AND bid >= 0 AND ask >= bid THEN (bid + ask) / 2 END AS mid
  FROM (SELECT *, CASE WHEN lag(t_us) OVER w IS NULL OR t_us - lag(t_us) OVER w > {_GAP}
                  OR lag(contract_key) OVER w IS DISTINCT FROM contract_key THEN 1 ELSE 0 END AS brk
        FROM live WHERE optiontype = '{side}' WINDOW w AS (PARTITION BY underlying, trading_date ORDER BY t_us))),
c_{s} AS (
  SELECT o.underlying, o.trading_date, o.anchor_us, o.start_us, q.t_us, q.seg, q.mid, q.bid, q.ask, q.oi, q.volume,
         o.start_us - {_LOOK} AS past_clock
  FROM started o ASOF JOIN q_{s} q ON o.underlying = q.underlying AND o.trading_date = q.trading_date
       AND o.start_us > q.t_us
  WHERE o.start_us - q.t_us <= {_AGE}),
p_{s} AS (
  SELECT c.*, CASE WHEN c.past_clock - q.t_us <= {_AGE} AND q.seg = c.seg THEN q.mid END AS pmid,
         CASE WHEN c.past_clock - q.t_us <= {_AGE} AND q.seg = c.seg THEN q.oi END AS poi,
         CASE WHEN c.past_clock - q.t_us <= {_AGE} AND q.seg = c.seg THEN q.volume END AS pvol
  FROM c_{s} c ASOF LEFT JOIN q_{s} q ON c.underlying = q.underlying AND c.trading_date = q.trading_date
       AND c.past_clock > q.t_us),
iv_{s} AS (
  SELECT underlying, trading_date, anchor_us, iv FROM (
    SELECT c.*, q.iv, q.iv_us, q.t_us AS src,
           row_number() OVER (PARTITION BY c.underlying, c.trading_date, c.anchor_us
                              ORDER BY q.iv_us DESC, q.t_us DESC) AS rn
    FROM c_{s} c JOIN q_{s} q ON c.underlying = q.underlying AND c.trading_date = q.trading_date
         AND c.seg = q.seg AND q.iv_us < c.start_us)
  WHERE rn = 1 AND start_us - iv_us <= {_AV} AND start_us - src <= {_SRC}),
gr_{s} AS (
  SELECT underlying, trading_date, anchor_us, delta, gamma, theta, vega FROM (
    SELECT c.*, q.delta, q.gamma, q.theta, q.vega, q.greeks_us, q.t_us AS src,
           row_number() OVER (PARTITION BY c.underlying, c.trading_date, c.anchor_us
                              ORDER BY q.greeks_us DESC, q.t_us DESC) AS rn
    FROM c_{s} c JOIN q_{s} q ON c.underlying = q.underlying AND c.trading_date = q.trading_date
         AND c.seg = q.seg AND q.greeks_us < c.start_us)
  WHERE rn = 1 AND start_us - greeks_us <= {_AV} AND start_us - src <= {_SRC}),
f_{s} AS (
  SELECT p.underlying, p.trading_date, p.anchor_us,
         CASE WHEN pmid > 0 THEN 100 * (mid / pmid - 1) END AS {side}_past_midpoint_return_pct,
         CASE WHEN poi > 0 THEN 100 * (oi::DOUBLE / poi::DOUBLE - 1) END AS {side}_past_oi_change_pct,
         CASE WHEN volume >= pvol THEN (volume - pvol)::DOUBLE END AS {side}_past_volume_increment,
         iv AS {side}_iv_decimal,
         CASE WHEN mid > 0 THEN 100 * (ask - bid) / mid END AS {side}_spread_pct,
         delta AS {side}_delta, gamma AS {side}_gamma, theta AS {side}_theta, vega AS {side}_vega
  FROM p_{s} p LEFT JOIN iv_{s} USING (underlying, trading_date, anchor_us)
       LEFT JOIN gr_{s} USING (underlying, trading_date, anchor_us))"""


OUTCOME_SQL = f"""WITH {TAPE_SQL},
live AS (SELECT * FROM tape WHERE source_version = '2'),
spots AS (
  SELECT *, sum(brk) OVER (PARTITION BY underlying, trading_date ORDER BY t_us) AS seg
  FROM (SELECT underlying, trading_date, t_us, spot,
               CASE WHEN t_us - lag(t_us) OVER (PARTITION BY underlying, trading_date ORDER BY t_us) > {_GAP}
                    THEN 1 ELSE 0 END AS brk
        FROM (SELECT underlying, trading_date, t_us, min(spot) AS spot FROM live GROUP BY ALL))),
grid AS (
  SELECT underlying, trading_date, epoch_us(trading_date::TIMESTAMP) + i * {_STEP} AS anchor_us,
         epoch_us(trading_date::TIMESTAMP) + {_DAY} AS close_us,
         epoch_us(trading_date::TIMESTAMP) + i * {_STEP} + {_HOR} AS end_clock
  FROM (SELECT DISTINCT underlying, trading_date FROM live), range(0, {_DAY // _STEP}) r(i)),
st AS (
  SELECT g.*, s.t_us AS start_us, s.spot AS start_spot, s.seg AS start_seg, s.t_us - {_LOOK} AS past_clock
  FROM grid g ASOF JOIN spots s ON g.underlying = s.underlying AND g.trading_date = s.trading_date
       AND g.anchor_us >= s.t_us
  WHERE g.anchor_us - s.t_us <= {_AGE}),
en AS (
  SELECT st.*, CASE WHEN ok THEN e.t_us END AS end_us, CASE WHEN ok THEN e.spot END AS end_spot,
         CASE WHEN ok THEN e.seg END AS end_seg
  FROM (SELECT * FROM st) st ASOF LEFT JOIN (SELECT *, TRUE AS hit FROM spots) e
       ON st.underlying = e.underlying AND st.trading_date = e.trading_date AND st.end_clock >= e.t_us,
       LATERAL (SELECT coalesce(st.end_clock < st.close_us AND st.end_clock - e.t_us <= {_AGE}, FALSE) AS ok)),
nw AS (
  SELECT en.*, CASE WHEN en.start_us - n.t_us <= {_AGE} THEN n.spot END AS now_spot,
         CASE WHEN en.start_us - n.t_us <= {_AGE} THEN n.seg END AS now_seg
  FROM en ASOF LEFT JOIN spots n ON en.underlying = n.underlying AND en.trading_date = n.trading_date
       AND en.start_us > n.t_us),
pa AS (
  SELECT nw.*, CASE WHEN nw.past_clock - p.t_us <= {_AGE} THEN p.spot END AS past_spot,
         CASE WHEN nw.past_clock - p.t_us <= {_AGE} THEN p.seg END AS past_seg
  FROM nw ASOF LEFT JOIN spots p ON nw.underlying = p.underlying AND nw.trading_date = p.trading_date
       AND nw.past_clock > p.t_us),
started AS (
  SELECT *, CASE WHEN now_seg = past_seg THEN now_spot - past_spot END AS past_spot_change,
         CASE WHEN end_clock >= close_us THEN 'horizon_outside_session'
              WHEN end_us IS NULL THEN 'missing_or_old_endpoint'
              WHEN abs(end_us - start_us - {_HOR}) > {_AGE} THEN 'receipt_interval_outside_tolerance'
              WHEN end_seg <> start_seg THEN 'gap_in_outcome_window'
              ELSE 'complete' END AS outcome_reason
  FROM pa),
outcomes AS (
  SELECT *, CASE WHEN outcome_reason = 'complete' THEN end_spot - start_spot END AS point_change,
         CASE WHEN outcome_reason <> 'complete' THEN 'UNKNOWN'
              WHEN abs(end_spot - start_spot) < {POLICY.min_move} THEN 'OTHER'
              WHEN end_spot > start_spot THEN 'UP_MOMENTUM' ELSE 'DOWN_MOMENTUM' END AS label
  FROM started)"""

SAMPLES_SQL = (
    OUTCOME_SQL
    + ","
    + _side_sql("CE")
    + ","
    + _side_sql("PE")
    + """,
samples AS (
  SELECT o.underlying, o.trading_date, o.anchor_us, o.start_us, o.end_us, o.start_spot, o.end_spot,
         o.point_change, o.label, o.outcome_reason, o.past_spot_change,
         ce.* EXCLUDE (underlying, trading_date, anchor_us), pe.* EXCLUDE (underlying, trading_date, anchor_us)
  FROM outcomes o
  LEFT JOIN f_ce ce ON o.underlying = ce.underlying AND o.trading_date = ce.trading_date AND o.anchor_us = ce.anchor_us
  LEFT JOIN f_pe pe ON o.underlying = pe.underlying AND o.trading_date = pe.trading_date AND o.anchor_us = pe.anchor_us)"""
)


@query(
    "sample_outcomes",
    OUTCOME_SQL
    + """
SELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, anchor_us, start_us, end_us,
       round(start_spot, 6) AS start_spot, round(end_spot, 6) AS end_spot,
       round(point_change, 6) AS point_change, label, outcome_reason,
       round(past_spot_change, 6) AS past_spot_change
FROM outcomes""",
)
def sample_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors with forward spot outcomes."""
    live = live_tape(spark, sf_dir)
    days = live.select("underlying", "trading_date").distinct()
    hits = S.spot_outcomes(S.receipts(live), S.anchor_grid(days, POLICY), POLICY)
    out = S.label_outcomes(hits, POLICY)
    return out.select(
        "underlying",
        F.col("trading_date").cast("string").alias("trading_date"),
        "anchor_us",
        F.col("start.at_us").alias("start_us"),
        F.col("end.at_us").alias("end_us"),
        F.round("start.spot", 6).alias("start_spot"),
        F.round("end.spot", 6).alias("end_spot"),
        F.round("point_change", 6).alias("point_change"),
        "label",
        "outcome_reason",
        F.round("past_spot_change", 6).alias("past_spot_change"),
    )


@query(
    "build_samples",
    SAMPLES_SQL
    + "\nSELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, anchor_us, start_us, end_us, label, outcome_reason, "
    + ", ".join(f"round({f}, 6) AS {f}" for f in S.FEATURES)
    + " FROM samples",
)
def build_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 with W1, W2, W8, W15, W16, J11-J13."""
    return samples(spark, sf_dir).select(
        "underlying",
        F.col("trading_date").cast("string").alias("trading_date"),
        "anchor_us",
        "start_us",
        "end_us",
        "label",
        "outcome_reason",
        *[F.round(f, 6).alias(f) for f in S.FEATURES],
    )


# Rule search -----------------------------------------------------------------

SINGLE = R.SearchPolicy(discovery_version=R.SINGLE)
JOINT = R.SearchPolicy(discovery_version=R.JOINT)
DATASET = "driver-events"

_PART_SQL = """,
days AS (SELECT trading_date, row_number() OVER (ORDER BY trading_date) AS place, count(*) OVER () AS total
         FROM (SELECT DISTINCT trading_date FROM samples)),
parts AS (SELECT trading_date, CASE WHEN total < 2 OR place <= least(total - 1, greatest(1, floor(total * 0.6::DOUBLE)))
                 THEN 'discovery' ELSE 'evaluation' END AS part FROM days),
tagged AS (SELECT s.*, p.part AS "partition" FROM samples s JOIN parts p USING (trading_date)),
train AS (SELECT * FROM tagged WHERE "partition" = 'discovery' AND label <> 'UNKNOWN')"""

_LONG_SQL = ",\nlong AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, {f}::DOUBLE AS v, label FROM train WHERE {f} IS NOT NULL" for f in S.FEATURES
) + ")"

_SINGLE_SQL = (
    SAMPLES_SQL
    + _PART_SQL
    + _LONG_SQL
    + """,
quart AS (SELECT feature, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS c
          FROM long GROUP BY feature HAVING count(DISTINCT v) >= 2),
limits AS (SELECT DISTINCT feature, threshold FROM (SELECT feature, unnest([a, b, c]) AS threshold FROM quart)),
cands AS (SELECT feature, threshold, operator, target FROM limits,
          (VALUES ('>='), ('<=')) o(operator), (VALUES ('UP_MOMENTUM'), ('DOWN_MOMENTUM')) t(target)),
log AS (
  SELECT c.feature, c.operator, c.threshold, c.target,
    count(*) FILTER (WHERE CASE WHEN operator = '>=' THEN v >= threshold ELSE v <= threshold END) AS support,
    count(*) FILTER (WHERE CASE WHEN operator = '>=' THEN v >= threshold ELSE v <= threshold END AND label = target) AS successes,
    count(*) FILTER (WHERE label = target) / count(*)::DOUBLE AS base_rate
  FROM cands c JOIN long l USING (feature) GROUP BY ALL),
scored AS (
  SELECT *, CASE WHEN support > 0 THEN successes / support::DOUBLE END AS rate,
         CASE WHEN support > 0 AND base_rate > 0 THEN (successes / support::DOUBLE) / base_rate END AS lift FROM log),
final AS (SELECT *, coalesce(support >= 5 AND successes > 0 AND lift > 1, FALSE) AS eligible FROM scored)"""
)

_FAMILY_SQL = ",\nfam AS (\n" + "\nUNION ALL\n".join(
    f"""SELECT '{f}' AS family, CE_{f}::DOUBLE AS v0, PE_{f}::DOUBLE AS v1, CE_iv_decimal::DOUBLE AS v2,
 PE_iv_decimal::DOUBLE AS v3, label FROM train
 WHERE CE_{f} IS NOT NULL AND PE_{f} IS NOT NULL AND CE_iv_decimal IS NOT NULL AND PE_iv_decimal IS NOT NULL"""
    for f in R.JOINT_FAMILIES
) + ")"

_CMP = " AND ".join(f"CASE WHEN o{i} = '>=' THEN v{i} >= t{i} ELSE v{i} <= t{i} END" for i in range(4))
_JOINT_SQL = (
    SAMPLES_SQL
    + _PART_SQL
    + _FAMILY_SQL
    + f""",
q AS (SELECT family, quantile_cont(v0, [0.25, 0.5, 0.75]) AS q0, quantile_cont(v1, [0.25, 0.5, 0.75]) AS q1,
             quantile_cont(v2, 0.5) AS t2, quantile_cont(v3, 0.5) AS t3
      FROM fam GROUP BY family
      HAVING least(count(DISTINCT v0), count(DISTINCT v1), count(DISTINCT v2), count(DISTINCT v3)) >= 2),
limits AS (SELECT DISTINCT family, q0[i] AS t0, q1[i] AS t1, t2, t3 FROM q, range(1, 4) r(i)),
ops AS (SELECT * FROM (VALUES ('>='), ('<=')) a(o0), (VALUES ('>='), ('<=')) b(o1),
                      (VALUES ('>='), ('<=')) c(o2), (VALUES ('>='), ('<=')) d(o3)),
log AS (
  SELECT family, o0, o1, o2, o3, t0, t1, t2, t3, target, count(*) FILTER (WHERE {_CMP}) AS support,
         count(*) FILTER (WHERE {_CMP} AND label = target) AS successes,
         count(*) FILTER (WHERE label = target) / count(*)::DOUBLE AS base_rate
  FROM limits JOIN fam USING (family), ops, (VALUES ('UP_MOMENTUM'), ('DOWN_MOMENTUM')) t(target) GROUP BY ALL),
scored AS (
  SELECT *, CASE WHEN support > 0 THEN successes / support::DOUBLE END AS rate,
         CASE WHEN support > 0 AND base_rate > 0 THEN (successes / support::DOUBLE) / base_rate END AS lift FROM log),
final AS (SELECT *, coalesce(support >= 5 AND successes > 0 AND lift > 1, FALSE) AS eligible FROM scored)"""
)


def _terms(n: int) -> list:
    """Flat text columns of a rule's predicates."""
    p = F.col("predicates")
    return [
        F.concat_ws(",", *[p[i]["feature"] for i in range(n)]).alias("features"),
        F.concat_ws(",", *[p[i]["operator"] for i in range(n)]).alias("operators"),
        *[F.round(p[i]["threshold"], 6).alias(f"t{i}") for i in range(n)],
    ]


_SCORES = ["support", "successes", *(f"round({c}, 9) AS {c}" for c in ("base_rate", "rate", "lift")), "eligible"]
_SINGLE_OUT = (
    "SELECT feature AS features, operator AS operators, round(threshold, 6) AS t0, target, " + ", ".join(_SCORES)
)
_JOINT_FEATURES = "'CE_' || family || ',PE_' || family || ',CE_iv_decimal,PE_iv_decimal' AS features"
_JOINT_OUT = (
    f"SELECT {_JOINT_FEATURES}, o0 || ',' || o1 || ',' || o2 || ',' || o3 AS operators, "
    + ", ".join(f"round(t{i}, 6) AS t{i}" for i in range(4))
    + ", target, "
    + ", ".join(_SCORES)
)


def _log(spark: SparkSession, sf_dir: str, search: R.SearchPolicy) -> DataFrame:
    return R.search_log(staged_samples(spark, sf_dir), POLICY, search, DATASET)


def _log_out(log: DataFrame, n: int) -> DataFrame:
    return log.select(
        *_terms(n),
        "target",
        "support",
        "successes",
        *[F.round(c, 9).alias(c) for c in ("base_rate", "rate", "lift")],
        "eligible",
    )


@query("rule_search_single", _SINGLE_SQL + "\n" + _SINGLE_OUT + " FROM final")
def rule_search_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full single-feature search log."""
    return _log_out(_log(spark, sf_dir, SINGLE), 1)


@query("rule_search_joint", _JOINT_SQL + "\n" + _JOINT_OUT + " FROM final")
def rule_search_joint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full joint search log."""
    return _log_out(_log(spark, sf_dir, JOINT), 4)


_TIES = ["features", "operators", "t0", "target"]


@query(
    "rule_top_k",
    _SINGLE_SQL
    + "\nSELECT * FROM ("
    + _SINGLE_OUT
    + " FROM final) WHERE eligible ORDER BY lift DESC, successes DESC, support DESC, features, operators, t0, target LIMIT 6",
)
def rule_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the best eligible rules."""
    return R.top_rules(_log_out(_log(spark, sf_dir, SINGLE), 1), SINGLE.max_conditions, _TIES)


# Frozen rules for the scan queries: stated as literals, as a stored rule file would be.
FROZEN = (
    ("ce-iv-high", [("CE_iv_decimal", ">=", 0.2)], "UP_MOMENTUM"),
    ("past-drop", [("past_spot_change", "<=", -10.0)], "UP_MOMENTUM"),
    ("past-rise", [("past_spot_change", ">=", 10.0)], "DOWN_MOMENTUM"),
    (
        "joint-oi",
        [
            ("CE_past_oi_change_pct", ">=", 0.0),
            ("PE_past_oi_change_pct", "<=", 0.0),
            ("CE_iv_decimal", ">=", 0.15),
            ("PE_iv_decimal", ">=", 0.15),
        ],
        "DOWN_MOMENTUM",
    ),
)


def frozen_rules(spark: SparkSession) -> DataFrame:
    rows = [
        (name, [{"feature": f, "operator": o, "threshold": t} for f, o, t in terms], target)
        for name, terms, target in FROZEN
    ]
    return spark.createDataFrame(rows, f"condition_id string, predicates {R.PREDICATES}, target string")


def _rule_sql(name: str, terms: list, target: str) -> str:
    known = " AND ".join(f"{f} IS NOT NULL" for f, _, _ in terms)
    test = " AND ".join(f"{f} {o} {t}::DOUBLE" for f, o, t in terms)
    return f"""SELECT '{name}' AS condition_id, '{target}' AS target, {known} AS available,
  coalesce({known} AND {test}, FALSE) AS matched, underlying, trading_date, "partition", anchor_us, label, point_change
  FROM tagged"""


_SCAN_SQL = (
    SAMPLES_SQL.replace("WITH ev", "WITH RECURSIVE ev", 1)
    + _PART_SQL
    + ",\ntested AS (\n"
    + "\nUNION ALL\n".join(_rule_sql(*r) for r in FROZEN)
    + f"""),
ordered AS (SELECT *, row_number() OVER (PARTITION BY condition_id, underlying, trading_date ORDER BY anchor_us) AS rn
            FROM tested WHERE matched),
walk AS (
  SELECT condition_id, underlying, trading_date, rn, anchor_us + {_HOR + _AGE} AS until, TRUE AS keep
  FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.condition_id, o.underlying, o.trading_date, o.rn,
         CASE WHEN o.anchor_us >= w.until THEN o.anchor_us + {_HOR + _AGE} ELSE w.until END, o.anchor_us >= w.until
  FROM walk w JOIN ordered o ON o.condition_id = w.condition_id AND o.underlying = w.underlying
       AND o.trading_date = w.trading_date AND o.rn = w.rn + 1),
hits AS (SELECT o.*, w.keep AS nonoverlapping FROM ordered o JOIN walk w USING (condition_id, underlying, trading_date, rn))"""
)


@query(
    "rule_scan",
    _SCAN_SQL
    + """
SELECT condition_id, target, underlying, CAST(trading_date AS VARCHAR) AS trading_date, "partition", anchor_us, label,
       round(point_change, 6) AS point_change, CASE WHEN label <> 'UNKNOWN' THEN label = target END AS success,
       nonoverlapping FROM hits""",
)
def rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of the frozen rules."""
    hits = R.occurrences(staged_samples(spark, sf_dir), frozen_rules(spark), POLICY, JOINT)
    return hits.select(
        "condition_id",
        "target",
        "underlying",
        F.col("trading_date").cast("string").alias("trading_date"),
        "partition",
        "anchor_us",
        "label",
        F.round("point_change", 6).alias("point_change"),
        "success",
        "nonoverlapping",
    )


def _stats_sql(prefix: str, when: str) -> str:
    return f"""count(*) FILTER (WHERE {when}) AS {prefix}matches,
  count(*) FILTER (WHERE {when} AND label <> 'UNKNOWN' AND label = target) AS {prefix}successes,
  count(*) FILTER (WHERE {when} AND label <> 'UNKNOWN' AND label <> target) AS {prefix}failures,
  count(*) FILTER (WHERE {when} AND label = 'UNKNOWN') AS {prefix}unknown_outcomes,
  count(*) FILTER (WHERE {when} AND label <> 'UNKNOWN') AS {prefix}known_outcomes"""


_SUMMARY_COUNTS = [
    f"{p}{n}"
    for p in ("", "baseline_", "nonoverlapping_")
    for n in ("matches", "successes", "failures", "unknown_outcomes", "known_outcomes")
]


@query(
    "rule_summaries",
    _SCAN_SQL
    + f""",
main AS (SELECT condition_id, "partition", count(*) AS all_anchors,
  count(*) FILTER (WHERE available) AS feature_available, count(*) FILTER (WHERE NOT available) AS feature_unknown,
  count(*) FILTER (WHERE available AND NOT matched) AS nonmatches,
  {_stats_sql("", "matched")}, {_stats_sql("baseline_", "available")} FROM tested GROUP BY 1, 2),
spaced AS (SELECT condition_id, "partition", {_stats_sql("nonoverlapping_", "nonoverlapping")} FROM hits GROUP BY 1, 2)
SELECT condition_id, "partition", all_anchors, feature_available, feature_unknown, nonmatches,
  """
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _SUMMARY_COUNTS)
    + """,
  CASE WHEN known_outcomes > 0 THEN round(successes / known_outcomes::DOUBLE, 9) END AS event_rate,
  CASE WHEN baseline_known_outcomes > 0 THEN round(baseline_successes / baseline_known_outcomes::DOUBLE, 9) END AS baseline_event_rate,
  CASE WHEN nonoverlapping_known_outcomes > 0
       THEN round(nonoverlapping_successes / nonoverlapping_known_outcomes::DOUBLE, 9) END AS nonoverlapping_event_rate
FROM main LEFT JOIN spaced USING (condition_id, "partition")""",
)
def rule_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Denominators and statistics per (rule, partition)."""
    table, rules = staged_samples(spark, sf_dir), frozen_rules(spark)
    hits = R.occurrences(table, rules, POLICY, JOINT)
    out = R.rule_summaries(table, rules, hits, JOINT)
    rates = ["event_rate", "baseline_event_rate", "nonoverlapping_event_rate"]
    return out.select(
        *[c for c in out.columns if c not in rates], *[F.round(c, 9).alias(c) for c in rates]
    )


@query(
    "chronological_partition",
    SAMPLES_SQL
    + _PART_SQL
    + """
SELECT CAST(trading_date AS VARCHAR) AS trading_date, part AS "partition" FROM parts""",
)
def chronological_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole early sessions for discovery."""
    days = R.partition_days(staged_samples(spark, sf_dir), JOINT)
    return days.select(F.col("trading_date").cast("string").alias("trading_date"), "partition")


@query(
    "alignment_counts",
    OUTCOME_SQL
    + f"""
SELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, 0::BIGINT AS out_of_session_rows,
       any_value(n) AS clock_candidates, any_value(n) - count(o.anchor_us) AS invalid_start, count(o.anchor_us) AS selected
FROM (SELECT underlying, trading_date, {_DAY // _STEP}::BIGINT AS n FROM (SELECT DISTINCT underlying, trading_date FROM live))
LEFT JOIN outcomes o USING (underlying, trading_date) GROUP BY underlying, trading_date""",
)
def alignment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid accounting per (underlying, day)."""
    out = S.alignment_counts(live_tape(spark, sf_dir), samples(spark, sf_dir), POLICY)
    return out.withColumn("trading_date", F.col("trading_date").cast("string"))


@query(
    "label_counts",
    OUTCOME_SQL + "\nSELECT label, outcome_reason, count(*) AS n FROM outcomes GROUP BY ALL",
)
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and outcome reasons."""
    return (
        sample_outcomes(spark, sf_dir)
        .groupBy("label", "outcome_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
