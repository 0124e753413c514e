"""Registered queries: clocks, sessions, segments, gaps, slot coverage."""

from __future__ import annotations

from datetime import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.functions import clock as C
from tickevidence.operators import asof as A
from tickevidence.operators import coverage as V
from tickevidence.operators import segments as G
from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, TAPE_SQL, events, option_tape, table

_DAY = 86_400_000_000
_LOCAL = "(ts + INTERVAL 330 MINUTE)"
_SOD = f"(date_part('hour', {_LOCAL}) * 3600 + date_part('minute', {_LOCAL}) * 60)"
_IN = f"({_SOD} >= 33300 AND {_SOD} < 55800 AND date_part('isodow', {_LOCAL}) < 6)"


@query(
    "session_clock",
    f"""SELECT event_id, {_IN} AS in_session,
  (date_part('hour', {_LOCAL}) BETWEEN 9 AND 14
   OR (date_part('hour', {_LOCAL}) = 15 AND date_part('minute', {_LOCAL}) <= 30)) AS market_hours,
  (epoch_us(ts) // 5000000) * 5000000 AS slot_us,
  (epoch_us(ts) // 5000000) * 5000000 + 5000000 AS next_us,
  CAST(CAST({_LOCAL} AS DATE) AS VARCHAR) AS local_date,
  CAST(CASE WHEN {_SOD} < 33300 THEN CAST({_LOCAL} AS DATE)
       - CAST(CASE date_part('isodow', {_LOCAL}) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS INTEGER)
       ELSE CAST({_LOCAL} AS DATE) END AS VARCHAR) AS assigned_date
FROM events""",
)
def session_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session tests, slots and trading dates of every event."""
    return events(spark, sf_dir).select(
        "event_id",
        C.in_session("ts").alias("in_session"),
        C.in_market_hours("ts").alias("market_hours"),
        C.us(C.align("ts")).alias("slot_us"),
        C.us(C.next_boundary("ts")).alias("next_us"),
        C.local_date("ts").cast("string").alias("local_date"),
        C.assigned_trading_date("ts").cast("string").alias("assigned_date"),
    )


@query(
    "session_counts",
    f"""SELECT event_type, count(*) FILTER (WHERE {_IN}) AS inside, count(*) FILTER (WHERE NOT {_IN}) AS outside
FROM events GROUP BY event_type""",
)
def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in and out of session."""
    live = C.in_session("ts")
    return events(spark, sf_dir).groupBy("event_type").agg(
        F.count_if(live).alias("inside"), F.count_if(~live).alias("outside")
    )


@query(
    "available_dates",
    f"SELECT DISTINCT CAST(CAST({_LOCAL} AS DATE) AS VARCHAR) AS trading_date FROM events WHERE {_IN}",
)
def available_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local weekdays with at least one row in session."""
    dates = V.trading_dates(events(spark, sf_dir), date=C.local_date("ts"), live=C.in_session("ts"))
    return dates.select(F.col("trading_date").cast("string").alias("trading_date"))


@query(
    "contract_names",
    """SELECT p_partkey, round_even(p_retailprice / 50.0, 0) * 50.0 AS atm,
  'IDX' || upper(strftime(e, '%d%b%y')) || CAST(CAST(round_even(p_retailprice / 50.0, 0) * 50 AS BIGINT) AS VARCHAR) || 'CE' AS symbol,
  'IDX|' || strftime(e, '%Y-%m-%d') || '|' || CAST(CAST(round_even(p_retailprice / 50.0, 0) * 50 AS BIGINT) AS VARCHAR)
    || '.5|CE' AS key,
  greatest(0, date_diff('day', DATE '2024-01-20', e)) AS whole_days,
  round((epoch_us(e::TIMESTAMP) - epoch_us(TIMESTAMP '2024-01-01 09:15:00')) / 86400000000.0::DOUBLE, 9) AS days
FROM (SELECT *, DATE '2024-01-02' + p_size AS e FROM part)""",
)
def contract_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-the-money strike, symbol, key and days to expiry."""
    part = table(spark, sf_dir, "part").withColumn("e", F.date_add(F.lit("2024-01-02").cast("date"), F.col("p_size")))
    atm = C.atm_strike(F.col("p_retailprice"), 50)
    return part.select(
        "p_partkey",
        atm.alias("atm"),
        C.contract_symbol(F.lit("IDX"), F.col("e"), atm, F.lit("CE")).alias("symbol"),
        C.contract_key(F.lit("IDX"), F.col("e"), atm + 0.5, F.lit("CE")).alias("key"),
        C.whole_days_to_expiry(F.col("e"), F.lit("2024-01-20").cast("date")).cast("bigint").alias("whole_days"),
        F.round(C.days_to_expiry(F.to_timestamp("e"), F.lit("2024-01-01 09:15:00").cast("timestamp")), 9).alias("days"),
    )


@query(
    "nearest_expiry",
    """SELECT o_custkey, CAST(min(e) AS VARCHAR) AS nearest_expiry
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS e FROM orders) WHERE e >= DATE '2000-01-15' GROUP BY 1""",
)
def nearest_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest unexpired date parsed from three text forms."""
    raw = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    forms = [F.date_format(day, f) for f in ("dd-MMM-yy", "ddMMMyy", "d-MMM-yyyy")]
    pick = F.col("o_orderkey") % 3
    text = F.when(pick == 0, F.upper(forms[0])).when(pick == 1, F.upper(forms[1])).otherwise(forms[2])
    # Two-digit years mean 2000-2099, so earlier years are written with four digits.
    text = F.when(day < F.lit("2000-01-01"), forms[2]).otherwise(text)
    frame = raw.select("o_custkey", text.alias("t"), F.lit("2000-01-15").cast("date").alias("today"))
    out = C.nearest_expiry(frame, "t", "today", ["o_custkey"])
    return out.withColumn("nearest_expiry", F.col("nearest_expiry").cast("string"))


@query(
    "staleness",
    """SELECT user_id, CASE WHEN max(ts) FILTER (WHERE event_type = 'error') IS NULL THEN NULL
  ELSE round(greatest(0, (epoch_us(TIMESTAMP '2024-01-29') - epoch_us(max(ts) FILTER (WHERE event_type = 'error'))) / 1e6), 6) END AS age_seconds,
  max(ts) FILTER (WHERE event_type = 'error') IS NULL AS never_seen
FROM events GROUP BY user_id""",
)
def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the newest row of one kind, per user."""
    newest = events(spark, sf_dir).groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("ts")
    )
    age = C.staleness_seconds(F.col("ts"), F.lit("2024-01-29").cast("timestamp"))
    never = age == F.lit(float("inf"))
    return newest.select(
        "user_id", F.when(~never, F.round(age, 6)).alias("age_seconds"), never.alias("never_seen")
    )


_SEG = """SELECT event_id, event_type, sum(CASE WHEN gap > 5400000000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY event_type ORDER BY t_us, event_id) AS segment
FROM (SELECT *, t_us - lag(t_us) OVER (PARTITION BY event_type ORDER BY t_us, event_id) AS gap FROM ev)"""


@query("gap_segments", f"WITH {EVENTS_SQL} SELECT event_id, CAST(segment AS BIGINT) AS segment FROM ({_SEG})")
def gap_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new segment after every gap."""
    out = G.with_segments(
        events(spark, sf_dir), by=["event_type"], time="ts", tie="event_id", max_gap=5400, block_seconds=86_400
    )
    return out.select("event_id", "segment")


@query(
    "contract_segments",
    f"""WITH {TAPE_SQL}
SELECT observation_id, CAST(sum(brk) OVER (PARTITION BY underlying, optiontype ORDER BY t_us, observation_id) AS BIGINT) AS segment
FROM (SELECT *, CASE WHEN lag(t_us) OVER w IS NULL OR t_us - lag(t_us) OVER w > 5400000000
             OR lag(contract_key) OVER w IS DISTINCT FROM contract_key THEN 1 ELSE 0 END AS brk
      FROM tape WINDOW w AS (PARTITION BY underlying, optiontype ORDER BY t_us, observation_id))""",
)
def contract_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new segment after a gap or a contract change."""
    out = G.with_segments(
        option_tape(spark, sf_dir),
        by=["underlying", "optiontype"],
        time="timestamps",
        tie="observation_id",
        max_gap=5400,
        contract="contract_key",
        block_seconds=86_400,
    )
    return out.select("observation_id", "segment")


@query(
    "gap_report",
    f"""WITH {EVENTS_SQL}
SELECT event_type, prev AS previous_us, t_us AS next_us, round((t_us - prev) / 1e6, 6) AS gap_seconds
FROM (SELECT event_type, t_us, lag(t_us) OVER (PARTITION BY event_type ORDER BY t_us) AS prev
      FROM (SELECT DISTINCT event_type, t_us FROM ev)) WHERE t_us - prev > 3600000000""",
)
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive receipts too far apart."""
    out = G.gap_report(events(spark, sf_dir), by=["event_type"], time="ts", min_gap=3600, block_seconds=86_400)
    return out.select(
        "event_type",
        C.us("previous_at").alias("previous_us"),
        C.us("next_at").alias("next_us"),
        F.round("gap_seconds", 6).alias("gap_seconds"),
    )


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as cycles of a 30-minute grid per (event_type, day)."""
    slot = (F.pmod(F.unix_micros("ts"), F.lit(_DAY)) / F.lit(1_800_000_000)).cast("bigint")
    return events(spark, sf_dir).select(
        "event_type", F.to_date("ts").alias("day"), slot.alias("slot"), "ts", "k", "value", "event_id"
    )


_SLOTS_SQL = f"""{EVENTS_SQL},
slots AS (SELECT event_type, d AS day, (t_us % {_DAY}) // 1800000000 AS slot, t_us, k, value, event_id FROM ev)"""


@query(
    "missing_intervals",
    f"""WITH {_SLOTS_SQL},
keys AS (SELECT DISTINCT event_type, day FROM slots),
holes AS (SELECT event_type, day, i AS slot FROM keys, range(0, 48) r(i)
          WHERE NOT EXISTS (SELECT 1 FROM slots s WHERE s.event_type = keys.event_type AND s.day = keys.day AND s.slot = i)),
runs AS (SELECT *, slot - row_number() OVER (PARTITION BY event_type, day ORDER BY slot) AS island FROM holes)
SELECT event_type, CAST(day AS VARCHAR) AS day, min(slot) AS start_slot, max(slot) + 1 AS end_slot, count(*) AS slots
FROM runs GROUP BY event_type, runs.day, island""",
)
def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of missing slots."""
    out = G.missing_intervals(_slots(spark, sf_dir), by=["event_type", "day"], slot="slot", expected=F.lit(48))
    return out.withColumn("day", F.col("day").cast("string"))


@query(
    "slot_grid_join",
    f"""WITH {_SLOTS_SQL},
n AS (SELECT event_type, day, slot, count(*) AS rows FROM slots GROUP BY ALL)
SELECT event_type, CAST(k.day AS VARCHAR) AS day, epoch_us(k.day::TIMESTAMP) + i * 1800000000 AS slot_us, coalesce(n.rows, 0) AS rows
FROM (SELECT DISTINCT event_type, day FROM slots) k CROSS JOIN range(0, 48) r(i)
LEFT JOIN n ON n.event_type = k.event_type AND n.day = k.day AND n.slot = i""".replace(
        "SELECT event_type, CAST(k.day", "SELECT k.event_type, CAST(k.day"
    ),
)
def slot_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated slots with their row counts."""
    rows = _slots(spark, sf_dir).withColumn("slot_us", C.floor_to(F.unix_micros("ts"), 1_800_000_000))
    days = rows.select("event_type", "day").distinct()
    opens, closes = C.session_bounds_us(F.col("day"), "UTC", time(0, 0), None)
    grid = V.expected_slots(days, open_us=opens, close_us=closes, slot_seconds=1800)
    return V.grid_join(grid, rows, by=["event_type", "day"], slot="slot_us").select(
        "event_type", F.col("day").cast("string").alias("day"), "slot_us", "rows"
    )


@query(
    "slot_coverage",
    f"""WITH {TAPE_SQL},
per AS (SELECT underlying, trading_date, (t_us % {_DAY}) // 1800000000 AS slot, count(*) AS rows,
               count(DISTINCT optiontype) AS sides, count(bid) AS vals FROM tape GROUP BY ALL)
SELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, 48::BIGINT AS expected_cycles, count(*) AS observed_cycles,
       count(*) FILTER (WHERE rows = 2 AND sides = 2 AND vals = 2) AS complete_cycles, 48 - count(*) AS missing_cycles,
       round(100.0::DOUBLE * count(*) / 48, 2) AS coverage_pct
FROM per GROUP BY underlying, per.trading_date""",
)
def slot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed, complete and missing cycles per day."""
    slot = (F.pmod(F.unix_micros("timestamps"), F.lit(_DAY)) / F.lit(1_800_000_000)).cast("bigint")
    rows = option_tape(spark, sf_dir).withColumn("slot", slot)
    out = V.cycle_coverage(
        rows, by=["underlying", "trading_date"], slot="slot", side="optiontype", value="bid", expected=F.lit(48)
    )
    return out.withColumn("trading_date", F.col("trading_date").cast("string"))


@query(
    "receipt_coverage",
    f"""WITH {EVENTS_SQL},
r AS (SELECT event_type, d, t_us, CASE WHEN k % 11 = 0 THEN t_us ELSE (t_us // 1800000000) * 1800000000 END
             - epoch_us(d::TIMESTAMP) - 21600000000 AS off,
             t_us - epoch_us(d::TIMESTAMP) - 21600000000 AS rec FROM ev)
SELECT event_type, CAST(d AS VARCHAR) AS day, count(*) AS raw_receipt_count, min(t_us) AS earliest_us, max(t_us) AS latest_us,
  count(*) FILTER (WHERE rec < 0 OR rec >= 43200000000) AS out_of_window_receipts,
  count(*) FILTER (WHERE off < 0 OR off >= 43200000000 OR off % 1800000000 <> 0) AS unaligned_scheduled_receipts,
  count(DISTINCT off) FILTER (WHERE off >= 0 AND off < 43200000000 AND off % 1800000000 = 0) AS captured_distinct_slots,
  24::BIGINT AS expected_slots,
  24 - count(DISTINCT off) FILTER (WHERE off >= 0 AND off < 43200000000 AND off % 1800000000 = 0) AS missing_slots
FROM r GROUP BY event_type, r.d""",
)
def receipt_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: receipts, alignment and captured slots of a 06:00-18:00 session."""
    ev = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    scheduled = F.when(F.col("k") % 11 == 0, F.col("ts")).otherwise(C.align("ts", 1800))
    opens, closes = C.session_bounds_us(F.col("day"), "UTC", time(6, 0), time(18, 0))
    out = V.receipt_coverage(
        ev.withColumn("scheduled", scheduled),
        by=["event_type", "day"],
        scheduled="scheduled",
        received="ts",
        open_us=opens,
        close_us=closes,
        slot_seconds=1800,
    )
    return out.withColumn("day", F.col("day").cast("string"))


@query(
    "day_counts",
    f"""SELECT CAST(CAST({_LOCAL} AS DATE) AS VARCHAR) AS day, count(*) AS all_day_rows,
  count(*) FILTER (WHERE NOT {_IN}) AS out_of_window_rows, count(*) FILTER (WHERE {_IN} AND event_id % 50 <> 7) AS exported_rows,
  count(*) FILTER (WHERE {_IN}) = count(*) FILTER (WHERE {_IN} AND event_id % 50 <> 7) AS reconciled
FROM events GROUP BY 1""",
)
def day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day totals reconciled with an export that lost some rows."""
    ev = events(spark, sf_dir).withColumn("day", C.local_date("ts"))
    live = C.in_session("ts")
    sent = ev.filter(live & (F.col("event_id") % 50 != 7))
    out = V.day_counts(ev, by=["day"], in_window=live, exported=sent)
    return out.withColumn("day", F.col("day").cast("string"))


@query(
    "daily_quality",
    """SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trading_date, l_returnflag AS symbol, count(*) AS total,
  count(*) FILTER (WHERE l_linestatus = 'F') AS f_rows, count(*) FILTER (WHERE l_linestatus = 'O') AS o_rows,
  round(100.0::DOUBLE * count(*) FILTER (WHERE l_linestatus = 'F') / count(*), 2) AS valid_pct,
  min(epoch_us(l_shipdate)) AS first_us, max(epoch_us(l_shipdate)) AS last_us,
  round(avg(l_quantity), 6) AS avg_latency, max(l_quantity) AS max_latency
FROM lineitem GROUP BY 1, 2""",
)
def daily_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: rows per status, valid share, first / last, latency per (day, symbol)."""
    li = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").cast("string").alias("trading_date"),
        F.col("l_returnflag").alias("symbol"),
        "l_linestatus",
        F.col("l_shipdate").cast("timestamp").alias("at"),
        "l_quantity",
    )
    out = V.daily_quality(
        li, by=["trading_date", "symbol"], status="l_linestatus", statuses=["F", "O"], time="at", latency="l_quantity"
    )
    return out.withColumn("avg_latency", F.round("avg_latency", 6))


@query(
    "daily_completeness",
    f"""WITH {TAPE_SQL}
SELECT underlying, CAST(trading_date AS VARCHAR) AS trading_date, count(*) AS total, count(iv) AS has_iv, count(bid) AS has_bid,
  round(100.0::DOUBLE * count(iv) / count(*), 2) AS iv_pct, round(100.0::DOUBLE * count(bid) / count(*), 2) AS bid_pct
FROM tape GROUP BY underlying, tape.trading_date""",
)
def daily_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: non-null counts and shares per (day, symbol)."""
    out = V.completeness(option_tape(spark, sf_dir), by=["underlying", "trading_date"], columns=["iv", "bid"])
    return out.withColumn("trading_date", F.col("trading_date").cast("string"))


@query(
    "cadence",
    f"""WITH {EVENTS_SQL},
s AS (SELECT event_type, (t_us // 60000000) * 60000000 AS s, (t_us % 60000000) / 1000.0::DOUBLE AS drift,
             row_number() OVER (PARTITION BY event_type ORDER BY (t_us // 60000000) DESC) AS rn
      FROM (SELECT event_type, min(t_us) AS t_us FROM ev GROUP BY event_type, t_us // 60000000)),
g AS (SELECT *, s - lag(s) OVER (PARTITION BY event_type ORDER BY s) AS step FROM s WHERE rn <= 1000)
SELECT event_type, count(*) AS cycles, round(avg(drift), 6) AS avg_drift_ms, min(drift) AS min_drift_ms, max(drift) AS max_drift_ms,
  CAST(coalesce(sum(greatest(0, step // 60000000 - 1)), 0) AS BIGINT) AS missed_intervals,
  coalesce(sum(greatest(0, step // 60000000 - 1)), 0) = 0 AS healthy
FROM g GROUP BY event_type""",
)
def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift and missed slots over the newest 1000 cycles."""
    ev = events(spark, sf_dir).withColumn("slot", C.align("ts", 60))
    cycles = ev.groupBy("event_type", "slot").agg(F.min("ts").alias("ts"))
    out = V.cadence(cycles, by=["event_type"], scheduled="slot", actual="ts", slot_seconds=60, last=1000)
    return out.withColumn("avg_drift_ms", F.round("avg_drift_ms", 6))


# As-of joins ------------------------------------------------------------------

_PROBE_SQL = """pr AS (SELECT l_orderkey, l_linenumber, l_suppkey % 5 AS pick,
   epoch_us(TIMESTAMP '2024-01-01') + (l_orderkey * 37 + l_linenumber * 7919 + CAST(l_quantity AS BIGINT)) % 2592000 * 1000000 AS at_us,
   ['click', 'error', 'purchase', 'signup', 'view'][CAST(l_suppkey % 5 AS INTEGER) + 1] AS event_type FROM lineitem)"""


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as probes: one clock in January 2024 and one event type each."""
    li = table(spark, sf_dir, "lineitem")
    kinds = F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")])
    second = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 7919 + F.col("l_quantity").cast("bigint")) % 2_592_000
    start = 1_704_067_200_000_000
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.timestamp_micros(F.lit(start) + second * 1_000_000).alias("at"),
        F.element_at(kinds, (F.col("l_suppkey") % 5 + 1).cast("int")).alias("event_type"),
    )


@query(
    "asof_backward",
    f"""WITH {EVENTS_SQL}, {_PROBE_SQL}
SELECT p.l_orderkey, p.l_linenumber, p.at_us, CASE WHEN p.at_us - e.t_us <= 1800000000 THEN e.event_id END AS event_id,
       CASE WHEN p.at_us - e.t_us <= 1800000000 THEN e.t_us END AS hit_us
FROM pr p ASOF LEFT JOIN ev e ON p.event_type = e.event_type AND p.at_us >= e.t_us""",
)
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event at or before each probe, at most 30 minutes old."""
    out = A.asof_backward(
        _probes(spark, sf_dir),
        events(spark, sf_dir),
        by=["event_type"],
        probe_time="at",
        series_time="ts",
        tolerance=1800,
        payload=["event_id"],
        prefix="hit_",
        block_seconds=21_600,
    )
    return out.select(
        "l_orderkey",
        "l_linenumber",
        C.us("at").alias("at_us"),
        F.col("hit_event_id").alias("event_id"),
        F.col("hit_at_us").alias("hit_us"),
    )


_ROLES = {"past": -3600.0, "now": 0.0, "future": 3600.0}


@query(
    "asof_three_clocks",
    f"""WITH {EVENTS_SQL}, {_PROBE_SQL},
c AS (SELECT *, at_us - 3600000000 AS past_clock, at_us + 3600000000 AS future_clock FROM pr)
SELECT c.l_orderkey, c.l_linenumber, c.at_us,
  CASE WHEN c.past_clock - a.t_us <= 1800000000 THEN a.event_id END AS past_id,
  CASE WHEN c.at_us - b.t_us <= 1800000000 THEN b.event_id END AS now_id,
  CASE WHEN c.future_clock - f.t_us <= 1800000000 THEN f.event_id END AS future_id
FROM c ASOF LEFT JOIN ev a ON c.event_type = a.event_type AND c.past_clock >= a.t_us
  ASOF LEFT JOIN ev b ON c.event_type = b.event_type AND c.at_us >= b.t_us
  ASOF LEFT JOIN ev f ON c.event_type = f.event_type AND c.future_clock >= f.t_us""",
)
def asof_three_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past, current and future events of each probe in one pass."""
    out = A.asof_roles(
        _probes(spark, sf_dir),
        events(spark, sf_dir),
        by=["event_type"],
        probe_time="at",
        series_time="ts",
        roles=_ROLES,
        tolerance=1800,
        payload=["event_id"],
        block_seconds=43_200,
    )
    return out.select(
        "l_orderkey",
        "l_linenumber",
        C.us("at").alias("at_us"),
        *[F.col(f"{r}.event_id").alias(f"{r}_id") for r in _ROLES],
    )


@query(
    "asof_available",
    f"""WITH {TAPE_SQL}, {_PROBE_SQL},
cand AS (SELECT * FROM tape WHERE optiontype = 'CE' AND iv_us IS NOT NULL),
j AS (SELECT p.*, c.observation_id, c.iv, c.iv_us, c.t_us,
        row_number() OVER (PARTITION BY p.l_orderkey, p.l_linenumber, p.at_us, p.event_type ORDER BY c.iv_us DESC, c.t_us DESC) AS rn
      FROM (SELECT DISTINCT * FROM pr) p JOIN cand c ON p.event_type = c.underlying AND c.iv_us < p.at_us AND c.iv_us >= p.at_us - 1800000000)
SELECT pr.l_orderkey, pr.l_linenumber, pr.at_us,
       CASE WHEN j.at_us - j.t_us <= 2700000000 THEN j.observation_id END AS observation_id,
       CASE WHEN j.at_us - j.t_us <= 2700000000 THEN round(j.iv, 6) END AS iv
FROM pr LEFT JOIN j ON pr.l_orderkey = j.l_orderkey AND pr.l_linenumber = j.l_linenumber AND pr.at_us = j.at_us
  AND pr.event_type = j.event_type AND j.rn = 1""",
)
def asof_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest available calculation, age-checked afterwards."""
    tape = option_tape(spark, sf_dir).filter("optiontype = 'CE'").withColumnRenamed("underlying", "event_type")
    out = A.asof_available(
        _probes(spark, sf_dir),
        tape,
        by=["event_type"],
        probe_time="at",
        available="iv_available_at",
        observed="timestamps",
        available_age=1800,
        source_age=2700,
        payload=["observation_id", "iv"],
        block_seconds=21_600,
    )
    return out.select(
        "l_orderkey",
        "l_linenumber",
        C.us("at").alias("at_us"),
        F.col("calc.observation_id").alias("observation_id"),
        F.round("calc.iv", 6).alias("iv"),
    )
