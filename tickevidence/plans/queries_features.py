"""Registered queries: statistics, declared features, relationship studies, Greeks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.functions import greeks as B
from tickevidence.operators import coverage as V
from tickevidence.operators import features as X
from tickevidence.operators import relations as Y
from tickevidence.operators import segments as G
from tickevidence.operators import stats as T
from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, TAPE_SQL, events, option_tape, table
from tickevidence.session import stage_table

_DAY = 86_400_000_000
H = 3_600_000_000


@query(
    "average_ranks",
    """SELECT p_type, p_size, count(*) AS n, avg(r) AS average_rank FROM (
  SELECT p_type, p_size, rank() OVER (PARTITION BY p_type ORDER BY p_size)
    + (count(*) OVER (PARTITION BY p_type, p_size) - 1) / 2.0::DOUBLE AS r FROM part) GROUP BY 1, 2""",
)
def average_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks with ties at the mean of their places."""
    out = T.average_ranks(table(spark, sf_dir, "part"), ["p_type"], "p_size")
    return out.select("p_type", "p_size", "n", "average_rank")


@query(
    "exact_quantiles",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_extendedprice) AS distinct_values,
  round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q75 FROM lineitem GROUP BY 1, 2""",
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact interpolated quartiles of whole groups."""
    out = T.exact_quantiles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.25, 0.5, 0.75]
    )
    return out.select("l_returnflag", "l_linestatus", "n", "distinct_values", *[F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")])


def corr_sql(source: str, by: str, x: str, y: str) -> str:
    """Pearson and Spearman of complete pairs per group, NULL unless both sides vary."""
    return f"""SELECT {by}, count(*) AS n,
  CASE WHEN count(*) >= 3 AND min({x}) < max({x}) AND min({y}) < max({y}) THEN round(corr({x}, {y}), 8) END AS pearson,
  CASE WHEN count(*) >= 3 AND min({x}) < max({x}) AND min({y}) < max({y}) THEN round(corr(rx, ry), 8) END AS spearman
FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0::DOUBLE AS rx,
        rank() OVER (PARTITION BY {by} ORDER BY {y}) + (count(*) OVER (PARTITION BY {by}, {y}) - 1) / 2.0::DOUBLE AS ry
      FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) GROUP BY {by}"""


def _corr_out(out: DataFrame) -> DataFrame:
    return out.withColumns({c: F.round(c, 8) for c in ("pearson", "spearman")})


@query(
    "rank_correlations",
    f"""WITH {EVENTS_SQL},
p AS (SELECT event_type AS g, value AS x, k::DOUBLE AS y FROM ev UNION ALL SELECT 'POOLED', value, k::DOUBLE FROM ev)
"""
    + corr_sql("p", "g", "x", "y"),
)
def rank_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations per group and pooled."""
    pairs = events(spark, sf_dir).select(
        F.col("event_type").alias("g"), F.col("value").alias("x"), F.col("k").cast("double").alias("y")
    )
    return _corr_out(T.correlations(T.with_pooled(pairs, "g"), ["g"], "x", "y"))


@query(
    "greedy_spacing",
    f"""WITH RECURSIVE {EVENTS_SQL},
a AS (SELECT DISTINCT event_type, d, (t_us // {H // 2}) * {H // 2} AS s FROM ev),
o AS (SELECT *, row_number() OVER (PARTITION BY event_type, d ORDER BY s) AS rn FROM a),
w AS (SELECT event_type, d, rn, s, s + {2 * H} AS until, TRUE AS keep FROM o WHERE rn = 1
  UNION ALL SELECT o.event_type, o.d, o.rn, o.s, CASE WHEN o.s >= w.until THEN o.s + {2 * H} ELSE w.until END, o.s >= w.until
  FROM w JOIN o ON o.event_type = w.event_type AND o.d = w.d AND o.rn = w.rn + 1)
SELECT event_type, CAST(d AS VARCHAR) AS day, s AS start_us, keep AS independent FROM w""",
)
def greedy_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-overlapping half-hour slots of each day."""
    ev = events(spark, sf_dir)
    slots = ev.select(
        "event_type", F.to_date("ts").alias("day"), F.expr(f"unix_micros(ts) div {H // 2} * {H // 2}").alias("start_us")
    ).distinct()
    out = G.greedy_spacing(
        slots.withColumn("end_us", F.col("start_us") + F.lit(2 * H)),
        by=["event_type", "day"],
        start="start_us",
        end="end_us",
        carry=[],
    )
    return out.select("event_type", F.col("day").cast("string").alias("day"), "start_us", "independent")


# Declared features ----------------------------------------------------------------


@query(
    "log_returns",
    f"""WITH {EVENTS_SQL}
SELECT a.event_id, CASE WHEN a.c1 - b.t_us <= {H // 2} THEN round(ln(a.value / b.value), 9) END AS ret_1h,
  CASE WHEN a.c6 - c.t_us <= {H // 2} THEN round(ln(a.value / c.value), 9) END AS ret_6h
FROM (SELECT *, t_us - {H} AS c1, t_us - {6 * H} AS c6 FROM ev) a
ASOF LEFT JOIN ev b ON a.event_type = b.event_type AND a.c1 >= b.t_us
ASOF LEFT JOIN ev c ON a.event_type = c.event_type AND a.c6 >= c.t_us""",
)
def log_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log returns at two lags."""
    ev = events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    out = X.log_returns(
        ev, by=["event_type"], time="ts", price="value", lags={"ret_1h": 3600, "ret_6h": 21_600}, tolerance=1800, block_seconds=86_400
    )
    return out.select("event_id", F.round("ret_1h", 9).alias("ret_1h"), F.round("ret_6h", 9).alias("ret_6h"))


def _minute_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First value of each minute: at most 1,440 rows per (event_type, day)."""
    return (
        events(spark, sf_dir)
        .groupBy("event_type", F.to_date("ts").alias("day"), F.date_trunc("minute", "ts").alias("at"))
        .agg(F.min_by("value", "ts").alias("price"))
    )


def _ema_next(n: int) -> str:
    a = 2.0 / (n + 1)
    return f"{a!r}::DOUBLE * o.price + {1 - a!r}::DOUBLE * w.e{n}"


@query(
    "exponential_averages",
    f"""WITH RECURSIVE {EVENTS_SQL},
s AS (SELECT event_type, d, t_us // 60000000 AS m, arg_min(value, t_us) AS price FROM ev GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY event_type, d ORDER BY m) AS rn FROM s),
w AS (SELECT event_type, d, rn, m, price, price AS e5, price AS e20, NULL::DOUBLE AS s5, NULL::DOUBLE AS s20 FROM o WHERE rn = 1
  UNION ALL SELECT o.event_type, o.d, o.rn, o.m, o.price, {_ema_next(5)}, {_ema_next(20)},
    ({_ema_next(5)}) - w.e5, ({_ema_next(20)}) - w.e20
  FROM w JOIN o ON o.event_type = w.event_type AND o.d = w.d AND o.rn = w.rn + 1)
SELECT event_type, m * 60000000 AS at_us, CASE WHEN rn >= 20 THEN round(e5, 6) END AS ema_5, CASE WHEN rn >= 20 THEN round(s5, 6) END AS ema_5_slope,
  CASE WHEN rn >= 20 THEN round(price - e5, 6) END AS dist_ema_5, CASE WHEN rn >= 20 THEN round(e20, 6) END AS ema_20,
  CASE WHEN rn >= 20 THEN round(s20, 6) END AS ema_20_slope, CASE WHEN rn >= 20 THEN round(price - e20, 6) END AS dist_ema_20 FROM w""",
)
def exponential_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages, slopes and distances."""
    out = X.exponential_averages(
        _minute_slots(spark, sf_dir), by=["event_type", "day"], time="at", price="price", keep=[], spans=(5, 20), min_points=20
    )
    names = [f.format(n) for n in (5, 20) for f in ("ema_{}", "ema_{}_slope", "dist_ema_{}")]
    return out.select("event_type", F.unix_micros("at").alias("at_us"), *[F.round(c, 6).alias(c) for c in names])


_LEGS = ", ".join(
    f"max({c}) FILTER (WHERE optiontype = '{s}') AS {s.lower()}_{c}" for s in ("CE", "PE") for c in ("oi", "volume", "iv", "bid", "ask")
)


@query(
    "option_pressure",
    f"""WITH {TAPE_SQL},
w AS (SELECT underlying, trading_date, t_us, {_LEGS} FROM tape GROUP BY ALL),
p AS (SELECT *, lag(ce_oi) OVER o AS pc, lag(pe_oi) OVER o AS pp, lag(ce_iv) OVER o AS ic, lag(pe_iv) OVER o AS ip
      FROM w WINDOW o AS (PARTITION BY underlying, trading_date ORDER BY t_us))
SELECT underlying, t_us, ce_oi - pc AS atm_ce_oi_change, pe_oi - pp AS atm_pe_oi_change,
  round(100 * (ce_oi / pc::DOUBLE - 1), 6) AS atm_ce_oi_change_rate, round(100 * (pe_oi / pp::DOUBLE - 1), 6) AS atm_pe_oi_change_rate,
  ce_oi - pc + pe_oi - pp AS total_oi_change, round(ce_iv - ic, 6) AS atm_ce_iv_change, round(pe_iv - ip, 6) AS atm_pe_iv_change,
  round((ce_iv - ic + pe_iv - ip) / 2, 6) AS atm_iv_avg_change, round(pe_oi / ce_oi::DOUBLE, 12) AS pcr_oi,
  CASE WHEN ce_volume <> 0 THEN round(pe_volume / ce_volume::DOUBLE, 12) END AS pcr_volume,
  round(pe_oi / ce_oi::DOUBLE - pp / pc::DOUBLE, 12) AS pcr_oi_change,
  round((ce_ask - ce_bid + pe_ask - pe_bid) / 2, 6) AS atm_spread_pts,
  round((100 * (ce_ask - ce_bid) / ((ce_ask + ce_bid) / 2) + 100 * (pe_ask - pe_bid) / ((pe_ask + pe_bid) / 2)) / 2, 6) AS atm_spread_pct
FROM p""",
)
def option_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open interest, IV, put/call and spread features."""
    out = X.option_pressure(option_tape(spark, sf_dir), block_seconds=21_600)
    whole = ("atm_ce_oi_change", "atm_pe_oi_change", "total_oi_change")
    rounded = [c for c in out.columns if c not in ("underlying", "trading_date", "timestamps", *whole)]
    return out.select("underlying", F.unix_micros("timestamps").alias("t_us"), *whole, *[F.round(c, 12 if c.startswith("pcr") else 6).alias(c) for c in rounded])


_HORIZONS = {"1h": 3600, "6h": 21_600}


def _outcome_sql(label: str, seconds: int) -> str:
    return f"""SELECT a.event_id, a.event_type, a.d, '{label}' AS horizon_label, {seconds} AS horizon_seconds, a.value, f.value AS future, f.t_us AS future_us,
  CASE WHEN a.e >= a.close THEN 'MARKET_CLOSED' WHEN f.t_us IS NULL OR a.e - f.t_us > {H // 2} OR f.t_us <= a.t_us THEN 'MISSING'
       WHEN a.e > a.close - {H} THEN 'PARTIAL' ELSE 'VALID' END AS outcome_status
FROM (SELECT *, t_us + {seconds * 1_000_000} AS e, epoch_us(d::TIMESTAMP) + {_DAY} AS close FROM ev) a
ASOF LEFT JOIN ev f ON a.event_type = f.event_type AND a.e >= f.t_us"""


_OUTCOMES_SQL = f"WITH {EVENTS_SQL},\no AS (" + " UNION ALL ".join(_outcome_sql(*h) for h in _HORIZONS.items()) + ")"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "event_type", "ts", "value", F.to_date("ts").alias("day"))
    close = F.unix_micros(F.to_timestamp(F.date_add("day", 1)))
    return X.forward_outcomes(
        ev.withColumn("price", F.col("value")),
        by=["event_type"],
        time="ts",
        price="value",
        close_us=close,
        horizons=_HORIZONS,
        tolerance=1800,
        close_buffer=3600,
        block_seconds=86_400,
    )


@query(
    "forward_outcomes",
    _OUTCOMES_SQL
    + """
SELECT event_type, (SELECT t_us FROM ev WHERE ev.event_id = o.event_id) AS t_us, horizon_label, horizon_seconds, outcome_status,
  CASE WHEN ok THEN future END AS future_spot, CASE WHEN ok THEN future_us END AS future_us,
  CASE WHEN ok THEN round(future - value, 6) END AS future_return_pts, CASE WHEN ok THEN round(100 * (future - value) / value, 6) END AS future_return_pct,
  CASE WHEN ok AND future > value THEN 'UP' WHEN ok AND future < value THEN 'DOWN' WHEN ok THEN 'FLAT' END AS future_direction
FROM (SELECT *, outcome_status IN ('VALID', 'PARTIAL') AS ok FROM o) o""",
)
def forward_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per (row, horizon)."""
    out = _outcomes(spark, sf_dir)
    return out.select(
        "event_type",
        F.unix_micros("ts").alias("t_us"),
        "horizon_label",
        "horizon_seconds",
        "outcome_status",
        "future_spot",
        "future_us",
        F.round("future_return_pts", 6).alias("future_return_pts"),
        F.round("future_return_pct", 6).alias("future_return_pct"),
        "future_direction",
    )


@query(
    "outcome_status",
    _OUTCOMES_SQL
    + """
SELECT CAST(d AS VARCHAR) AS trading_date, event_type, horizon_label, count(*) AS total,
  count(*) FILTER (WHERE outcome_status = 'VALID') AS valid_rows, count(*) FILTER (WHERE outcome_status = 'MISSING') AS missing_rows,
  count(*) FILTER (WHERE outcome_status = 'MARKET_CLOSED') AS market_closed_rows,
  round(100.0::DOUBLE * count(*) FILTER (WHERE outcome_status = 'VALID') / count(*), 2) AS valid_pct
FROM o GROUP BY 1, 2, 3""",
)
def outcome_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: outcomes per day, symbol and horizon."""
    rows = _outcomes(spark, sf_dir).withColumn("trading_date", F.date_format("ts", "yyyy-MM-dd"))
    return V.outcome_status(
        rows, by=["trading_date", "event_type", "horizon_label"], status="outcome_status", statuses=["VALID", "MISSING", "MARKET_CLOSED"]
    )


@query(
    "excursions",
    f"""WITH {EVENTS_SQL}
SELECT event_id, round(greatest(0.0, hi - value), 6) AS mfe_pts, round(least(0.0, lo - value), 6) AS mae_pts FROM (
  SELECT *, max(value) OVER w AS hi, min(value) OVER w AS lo FROM ev
  WINDOW w AS (PARTITION BY event_type ORDER BY t_us RANGE BETWEEN 1 FOLLOWING AND {2 * H} FOLLOWING))
WHERE hi IS NOT NULL UNION ALL SELECT event_id, NULL, NULL FROM (
  SELECT event_id, max(value) OVER (PARTITION BY event_type ORDER BY t_us RANGE BETWEEN 1 FOLLOWING AND {2 * H} FOLLOWING) AS hi FROM ev) WHERE hi IS NULL""",
)
def excursions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and worst move within the horizon."""
    out = X.excursions(
        events(spark, sf_dir), by=["event_type"], time="ts", price="value", keep=["event_id"], horizon=7200, block_seconds=43_200
    )
    return out.select("event_id", F.round("mfe_pts", 6).alias("mfe_pts"), F.round("mae_pts", 6).alias("mae_pts"))


# Greeks -----------------------------------------------------------------------------


def _poly(x: str, top: tuple, bottom: tuple) -> str:
    num, den = f"({x} * {top[-1]!r}::DOUBLE)", f"({x})"
    for t, b in zip(top[:-2], bottom[:-1]):
        num, den = f"(({num} + {t!r}::DOUBLE) * {x})", f"(({den} + {b!r}::DOUBLE) * {x})"
    return f"(({num} + {top[-2]!r}::DOUBLE) / ({den} + {bottom[-1]!r}::DOUBLE))"


def _cdf_ctes(source: str, arg: str, out: str, tag: str) -> str:
    x = f"x_{tag}"
    return f"""{tag}_0 AS (SELECT *, -({arg}) / sqrt(2.0::DOUBLE) AS {x} FROM {source}),
{tag}_1 AS (SELECT *, abs({x}) AS y_{tag}, {x} * {x} AS z_{tag}, CASE WHEN {x} = 0 THEN 0 ELSE 1.0::DOUBLE / ({x} * {x}) END AS i_{tag} FROM {tag}_0),
{tag}_2 AS (SELECT *, 1.0::DOUBLE - {x} * {_poly(f"z_{tag}", B._A, B._B)} AS small_{tag},
   exp(-y_{tag} * y_{tag}) * {_poly(f"y_{tag}", B._C, B._D)} AS mid_{tag},
   CASE WHEN y_{tag} > 27 OR y_{tag} = 0 THEN 0 ELSE exp(-y_{tag} * y_{tag}) * (({1.0 / 3.141592653589793 ** 0.5!r}::DOUBLE - i_{tag} * {_poly(f"i_{tag}", B._P, B._Q)}) / y_{tag}) END AS tail_{tag} FROM {tag}_1),
{out} AS (SELECT *, 0.5::DOUBLE * CASE WHEN y_{tag} <= 0.46875 THEN small_{tag} WHEN {x} < 0
   THEN 2.0::DOUBLE - CASE WHEN y_{tag} <= 4 THEN mid_{tag} ELSE tail_{tag} END
   ELSE CASE WHEN y_{tag} <= 4 THEN mid_{tag} ELSE tail_{tag} END END AS n_{tag} FROM {tag}_2)"""


_BS_SQL = f"""base AS (SELECT p_partkey, p_retailprice AS s, 900 + (p_size * 40)::DOUBLE AS k, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 0.1::DOUBLE + p_size / 100.0::DOUBLE END AS v,
   CASE WHEN p_size = 7 THEN 0.0::DOUBLE ELSE p_size * 1.5::DOUBLE END AS days, CASE WHEN p_partkey % 2 = 0 THEN 'CE' ELSE 'PE' END AS side FROM part),
d AS (SELECT *, (ln(s / k) + (0.065::DOUBLE - 0.01::DOUBLE + v * v / 2) * t) / (v * sqrt(t)) AS d1,
   (ln(s / k) + (0.065::DOUBLE - 0.01::DOUBLE + v * v / 2) * t) / (v * sqrt(t)) - v * sqrt(t) AS d2
   FROM (SELECT *, days / 365.0::DOUBLE AS t FROM base WHERE v IS NOT NULL AND days > 0)),
{_cdf_ctes("d", "d1", "da", "a")},
{_cdf_ctes("da", "d2", "db", "b")},
{_cdf_ctes("db", "-d2", "dc", "c")},
{_cdf_ctes("dc", "-d1", "dd", "e")},
g AS (SELECT *, exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS pdf, exp(-0.01::DOUBLE * t) AS dq, exp(-0.065::DOUBLE * t) AS dr FROM dd),
h AS (SELECT p_partkey, dq * CASE WHEN side = 'CE' THEN n_a ELSE n_a - 1 END AS delta,
   (-(s * dq * pdf * v) / (2 * sqrt(t)) + CASE WHEN side = 'CE' THEN -0.065::DOUBLE * k * dr * n_b + 0.01::DOUBLE * s * dq * n_a
     ELSE 0.065::DOUBLE * k * dr * n_c - 0.01::DOUBLE * s * dq * n_e END) / 365.0::DOUBLE AS theta,
   dq * pdf / (s * v * sqrt(t)) AS gamma, s * dq * pdf * sqrt(t) / 100.0::DOUBLE AS vega FROM g)"""


@query(
    "black_scholes",
    f"""WITH {_BS_SQL}
SELECT p_partkey, CASE WHEN v IS NULL THEN 'missing_iv' WHEN days = 0 THEN 'nonpositive_time' ELSE 'derived' END AS status,
  round(delta, 8) AS delta, round(theta, 8) AS theta, round(gamma, 8) AS gamma, round(vega, 8) AS vega
FROM base LEFT JOIN h USING (p_partkey)""",
)
def black_scholes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greeks of contracts made from parts."""
    out = _contracts(spark, sf_dir)
    return out.select("p_partkey", "status", *[F.round(g, 8).alias(g) for g in ("delta", "theta", "gamma", "vega")])


def _contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_retailprice").alias("s"),
        (900 + (size * 40).cast("double")).alias("k"),
        F.when(F.col("p_partkey") % 11 != 0, 0.1 + size / 100.0).alias("v"),
        F.when(size == 7, 0.0).otherwise(size * 1.5).alias("days"),
        F.when(F.col("p_partkey") % 2 == 0, "CE").otherwise("PE").alias("side"),
    )
    return B.with_greeks(
        rows, spot="s", strike="k", iv="v", days="days", side="side", derive=True, rate=0.065, dividend=0.01, status="status"
    )


@query(
    "price_attribution",
    f"""WITH {_BS_SQL}
SELECT p_partkey, round(delta * 5, 6) AS delta_part, round(0.5::DOUBLE * gamma * 25, 6) AS gamma_part, round(vega * -0.5::DOUBLE, 6) AS vega_part,
  round(theta * 0.25::DOUBLE, 6) AS theta_part, round(delta * 5 + 0.5::DOUBLE * gamma * 25 + vega * -0.5::DOUBLE + theta * 0.25::DOUBLE, 6) AS explained
FROM h""",
)
def price_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-order explanation of a price move."""
    g = _contracts(spark, sf_dir).filter("status = 'derived'")
    parts = B.attribution(
        F.col("delta"), F.col("gamma"), F.col("vega"), F.col("theta"), F.lit(5.0), F.lit(-0.5), F.lit(0.25)
    )
    return g.select("p_partkey", *[F.round(v, 6).alias(k) for k, v in parts.items()])


# Relationship studies ---------------------------------------------------------------

STUDY = Y.StudyPolicy(
    step_seconds=3600, quote_age=1800, max_gap=5400, calculation_age=1800, source_age=2700, start_age=5400, block_seconds=21_600
)


def _study_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_tape(spark, sf_dir).withColumns(
        {
            "strike": F.when(F.col("optiontype") == "CE", 100.0).otherwise(120.0),
            "expirydate": F.to_timestamp(F.date_add("trading_date", 3)),
            "ltp": (1 + F.col("spot") * 0.5),
        }
    )


_KEY = "underlying, trading_date, optiontype"
_ON = " AND ".join(f"g.{c} = q.{c}" for c in ("underlying", "trading_date", "optiontype"))


def _hit(role: str, source: str, clock: str, out: str) -> str:
    cols = ("observation_id", "t_us", "seg", "spot", "mid", "bid", "ask", "oi", "volume", "contract_key")
    picked = ", ".join(f"CASE WHEN g.{clock} - q.t_us <= {H // 2} THEN q.{c} END AS {role}_{c}" for c in cols)
    return f"{out} AS (SELECT g.*, {picked} FROM {source} g ASOF LEFT JOIN quotes q ON {_ON} AND g.{clock} >= q.t_us)"


_QUOTES_SQL = f"""{TAPE_SQL},
quotes AS (SELECT *, sum(brk) OVER (PARTITION BY {_KEY} ORDER BY t_us) AS seg, 1 + spot * 0.5::DOUBLE AS ltp,
    CASE WHEN (bid + ask) / 2 > 0 AND bid >= 0 AND ask >= bid THEN (bid + ask) / 2 END AS mid,
    CASE WHEN iv_us IS NOT NULL AND greeks_us IS NOT NULL THEN greatest(iv_us, greeks_us) END AS av_us
  FROM (SELECT *, CASE WHEN lag(t_us) OVER w IS NULL OR t_us - lag(t_us) OVER w > 5400000000
          OR lag(contract_key) OVER w IS DISTINCT FROM contract_key THEN 1 ELSE 0 END AS brk
        FROM tape WINDOW w AS (PARTITION BY {_KEY} ORDER BY t_us))),
ends AS (SELECT {_KEY}, (min(t_us) + {H - 1}) // {H} AS a, max(t_us) // {H} AS b, (max(t_us) + {H - 1}) // {H} AS c FROM quotes GROUP BY ALL)"""


def _calc(role: str) -> str:
    return f"""{role}_calc AS (SELECT * FROM (
  SELECT g.underlying, g.trading_date, g.optiontype, g.clock_us, q.iv, q.delta, q.gamma, q.theta, q.vega, q.av_us, q.t_us AS src, g.{role}_t_us AS at_us,
    row_number() OVER (PARTITION BY g.underlying, g.trading_date, g.optiontype, g.clock_us ORDER BY q.av_us DESC, q.t_us DESC) AS rn
  FROM sel g JOIN quotes q ON {_ON} AND q.seg = g.{role}_seg AND q.av_us <= g.{role}_t_us)
  WHERE rn = 1 AND at_us - av_us <= 1800000000 AND at_us - src <= 2700000000)"""


_LAGGED_SQL = f"""WITH {_QUOTES_SQL},
grid AS (SELECT {_KEY}, i * {H} AS clock_us, i * {H} - {H} AS c_past, i * {H} AS c_now, i * {H} + {H} AS c_future
         FROM (SELECT *, unnest(range(a, b + 1)) AS i FROM ends)),
{_hit("past", "grid", "c_past", "h1")},
{_hit("now", "h1", "c_now", "h2")},
{_hit("future", "h2", "c_future", "h3")},
win AS (SELECT *, CASE WHEN past_t_us IS NULL OR now_t_us IS NULL OR future_t_us IS NULL THEN 'missing_or_old_quote'
    WHEN past_seg <> now_seg OR now_seg <> future_seg THEN 'segment_change' END AS reason FROM h3),
sel AS (SELECT * FROM win WHERE reason IS NULL),
{_calc("now")}, {_calc("past")},
feat AS (SELECT g.underlying, g.trading_date, g.optiontype, g.clock_us,
  100 * (now_spot / past_spot - 1) AS past_spot_return_pct, CASE WHEN past_mid > 0 THEN 100 * (now_mid / past_mid - 1) END AS past_midpoint_return_pct,
  100 * (now_oi / past_oi::DOUBLE - 1) AS past_oi_change_pct, CASE WHEN now_volume >= past_volume THEN (now_volume - past_volume)::DOUBLE END AS past_volume_increment,
  n.iv AS iv_decimal, 100 * (n.iv - p.iv) AS past_iv_change_pp, n.delta, n.gamma,
  CASE WHEN now_mid > 0 THEN 100 * n.theta / now_mid END AS theta_daily_pct_midpoint,
  CASE WHEN now_mid > 0 THEN 100 * n.vega / now_mid END AS vega_pct_midpoint_per_iv_pp,
  CASE WHEN now_mid > 0 THEN 100 * (now_ask - now_bid) / now_mid END AS spread_pct,
  100 * (now_spot / CASE WHEN g.optiontype = 'CE' THEN 100.0::DOUBLE ELSE 120.0::DOUBLE END - 1) AS spot_moneyness_pct,
  (epoch_us((g.trading_date + 3)::TIMESTAMP) - now_t_us) / 86400000000.0::DOUBLE AS days_to_expiry,
  CASE WHEN now_mid > 0 THEN 100 * (future_mid / now_mid - 1) END AS future_midpoint_return_pct
  FROM sel g LEFT JOIN now_calc n USING (underlying, trading_date, optiontype, clock_us)
  LEFT JOIN past_calc p USING (underlying, trading_date, optiontype, clock_us))"""

_ALL = [*Y.LAGGED_FEATURES, Y.TARGET]


@query(
    "lagged_features",
    _LAGGED_SQL
    + "\nSELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, optiontype, clock_us, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _ALL)
    + " FROM feat",
)
def lagged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and next-step target of every selected window."""
    out = Y.lagged_features(Y.lagged_windows(_study_tape(spark, sf_dir), STUDY))
    return out.select(
        "underlying",
        F.col("trading_date").cast("string").alias("trading_date"),
        "optiontype",
        "clock_us",
        *[F.round(c, 6).alias(c) for c in _ALL],
    )


@query(
    "lagged_selection_counts",
    _LAGGED_SQL
    + f"""
SELECT underlying, CAST(win.trading_date AS VARCHAR) AS trading_date, optiontype, count(*) AS clock_candidates,
  count(*) FILTER (WHERE reason = 'missing_or_old_quote') AS missing_or_old_quote,
  count(*) FILTER (WHERE reason = 'segment_change') AS segment_change, count(*) FILTER (WHERE reason IS NULL) AS selected
FROM win GROUP BY underlying, win.trading_date, optiontype""",
)
def lagged_selection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, rejections, selected."""
    rows = Y.lagged_windows(_study_tape(spark, sf_dir), STUDY)
    out = Y.selection_counts(rows, ("missing_or_old_quote", "segment_change"))
    return out.withColumn("trading_date", F.col("trading_date").cast("string"))


_LAG_LONG = " UNION ALL ".join(
    f"SELECT trading_date, optiontype, '{f}' AS feature, {f}::DOUBLE AS v, {Y.TARGET} AS y FROM feat" for f in Y.LAGGED_FEATURES
)


@query(
    "lagged_correlations",
    _LAGGED_SQL
    + f""",
l AS ({_LAG_LONG}),
p AS (SELECT CAST(trading_date AS VARCHAR) AS trading_date, optiontype, feature, v, y FROM l
      UNION ALL SELECT 'POOLED', optiontype, feature, v, y FROM l)
"""
    + corr_sql("p", "trading_date, optiontype, feature", "v", "y"),
)
def lagged_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations per day and pooled, by side and feature."""
    rows = Y.lagged_features(Y.lagged_windows(_study_tape(spark, sf_dir), STUDY))
    return _corr_out(Y.lagged_correlations(stage_table(rows, "lagged")))


_CONTEMP_SQL = f"""WITH RECURSIVE {_QUOTES_SQL},
grid AS (SELECT {_KEY}, i * {H} AS clock_us FROM (SELECT *, unnest(range(a, c + 1)) AS i FROM ends)),
{_hit("e", "grid", "clock_us", "h1")},
h2 AS (SELECT *, e_t_us - {H} AS s_clock FROM h1),
{_hit("s", "h2", "s_clock", "h3")},
win AS (SELECT *, CASE WHEN e_t_us IS NULL THEN 'end_too_old' WHEN s_t_us IS NULL THEN 'no_start_in_time'
    WHEN s_seg <> e_seg THEN 'segment_changed' END AS reason FROM h3),
o AS (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY s_t_us, e_t_us) AS rn FROM win WHERE reason IS NULL),
w AS (SELECT {_KEY}, rn, clock_us, e_t_us AS until, TRUE AS keep FROM o WHERE rn = 1
  UNION ALL SELECT o.underlying, o.trading_date, o.optiontype, o.rn, o.clock_us,
     CASE WHEN o.s_t_us >= w.until THEN o.e_t_us ELSE w.until END, o.s_t_us >= w.until
  FROM w JOIN o ON o.underlying = w.underlying AND o.trading_date = w.trading_date AND o.optiontype = w.optiontype AND o.rn = w.rn + 1),
fin AS (SELECT win.*, coalesce(reason, CASE WHEN NOT w.keep THEN 'overlap_excluded' END) AS verdict, e_spot - s_spot AS spot_change,
    e_mid - s_mid AS midpoint_change, (e_t_us - s_t_us) / 1e6::DOUBLE AS seconds
  FROM win LEFT JOIN w USING (underlying, trading_date, optiontype, clock_us))"""


def _contemporaneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.contemporaneous_windows(_study_tape(spark, sf_dir), STUDY)


@query(
    "contemporaneous_windows",
    _CONTEMP_SQL
    + """
SELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, optiontype, clock_us, verdict AS reason,
  s_t_us AS start_at_us, e_t_us AS end_at_us, round(spot_change, 6) AS spot_change, round(midpoint_change, 6) AS midpoint_change FROM fin""",
)
def contemporaneous_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same-contract windows with reject reasons."""
    return _contemporaneous(spark, sf_dir).select(
        "underlying",
        F.col("trading_date").cast("string").alias("trading_date"),
        "optiontype",
        "clock_us",
        "reason",
        "start_at_us",
        "end_at_us",
        F.round("spot_change", 6).alias("spot_change"),
        F.round("midpoint_change", 6).alias("midpoint_change"),
    )


@query(
    "interval_summary",
    _CONTEMP_SQL
    + """,
p AS (SELECT CAST(trading_date AS VARCHAR) AS trading_date, * EXCLUDE (trading_date) FROM fin WHERE verdict IS NULL
      UNION ALL SELECT 'POOLED', * EXCLUDE (trading_date) FROM fin WHERE verdict IS NULL)
SELECT trading_date, optiontype, count(*) AS n, round(quantile_cont(seconds, 0.5), 7) AS seconds_median, min(seconds) AS seconds_min,
  max(seconds) AS seconds_max, count(*) FILTER (WHERE spot_change = 0) AS zero_spot_change,
  count(*) FILTER (WHERE midpoint_change = 0) AS zero_midpoint_change, count(DISTINCT e_contract_key) AS distinct_contracts
FROM p GROUP BY trading_date, optiontype""",
)
def interval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths, zero changes and contracts of the selected windows."""
    good = stage_table(_contemporaneous(spark, sf_dir).filter("reason is null"), "windows")
    out = T.interval_summary(
        T.with_pooled(good, "trading_date"),
        ["trading_date", "optiontype"],
        "seconds",
        {"zero_spot_change": "spot_change", "zero_midpoint_change": "midpoint_change"},
        "contract_key",
    )
    return out.withColumn("seconds_median", F.round("seconds_median", 7))
