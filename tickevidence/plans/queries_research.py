"""Registered queries: whole research and daily runs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.plans import daily as D
from tickevidence.plans import research as H
from tickevidence.plans.queries_joins import _HOL_SQL, _holidays
from tickevidence.plans.queries_quality import POLICY as CLEANING
from tickevidence.plans.queries_quality import _TEXT_SQL, quote_texts
from tickevidence.plans.queries_samples import DATASET, JOINT, SINGLE, live_tape
from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, POLICY, events, table
from tickevidence.operators.cleaning import header_mapping, rename
from tickevidence.session import scratch_path


def _run(spark: SparkSession, sf_dir: str, search):
    root = scratch_path(spark, "research")
    tape = H.accepted_rows(live_tape(spark, sf_dir), root, "UTC")
    return H.run_research(tape, root, DATASET, POLICY, search, gate_zone="UTC")


@query("research_audit")
def research_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirteen checks of a full joint run."""
    return _run(spark, sf_dir, JOINT)[1]


@query("research_metrics")
def research_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of a full single-feature run."""
    run, _, verdict = _run(spark, sf_dir, SINGLE)
    return H.run_metrics(run, verdict)


_PLAN_SQL = f"""{_HOL_SQL},
d AS (SELECT CAST(o_orderdate AS DATE) AS trading_date, count(*) FILTER (WHERE o_orderstatus = 'F') AS n,
             bool_or(o_orderkey % 50 = 1) AS done FROM orders GROUP BY 1)"""


@query(
    "daily_plan",
    f"""WITH {_PLAN_SQL}
SELECT CAST(d.trading_date AS VARCHAR) AS trading_date, CASE WHEN date_part('isodow', d.trading_date) >= 6 THEN 'SKIPPED_WEEKEND'
  WHEN h.date IS NOT NULL THEN 'SKIPPED_MARKET_HOLIDAY' WHEN date_part('year', d.trading_date) <> 1999 THEN 'CALENDAR_UNAVAILABLE'
  WHEN d.trading_date >= DATE '1999-06-02' THEN 'WAITING_FOR_CLEANING' WHEN done THEN 'PUBLISHED' WHEN n = 0 THEN 'NO_DATA' ELSE 'READY' END AS status
FROM d LEFT JOIN hol h ON h.date = d.trading_date""",
)
def daily_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the daily job does with each date."""
    orders = table(spark, sf_dir, "orders").withColumn("trading_date", F.col("o_orderdate").cast("date"))
    commits = orders.filter("o_orderkey % 50 = 1").select("trading_date", F.lit("r1").alias("revision"))
    out = D.day_plan(
        orders.select("trading_date").distinct(),
        _holidays(spark, sf_dir),
        F.lit("1999-06-02 12:00:00").cast("timestamp"),
        orders.filter("o_orderstatus = 'F'"),
        commits,
        "r1",
    )
    return out.withColumn("trading_date", F.col("trading_date").cast("string"))


@query(
    "daily_clean",
    f"""WITH {EVENTS_SQL} SELECT CAST(d AS VARCHAR) AS trading_date, 'PUBLISHED' AS status FROM ev GROUP BY ev.d""",
)
def daily_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days cleaned, gated and committed in one job."""
    named, plan = _dated_texts(spark, sf_dir)
    out = D.clean_days(named, plan, CLEANING, scratch_path(spark, "daily"), "r1", "2024-02-01 00:00:00")
    return out.withColumn("trading_date", F.col("trading_date").cast("string"))


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", F.to_date("ts").alias("trading_date"))


def _dated_texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The text quotes with their day, and a plan that has every day READY."""
    raw = quote_texts(spark, sf_dir)
    days = _event_days(spark, sf_dir)
    keyed = raw.withColumn("_event", F.expr("source_row div 10")).join(days, F.col("_event") == F.col("event_id")).drop("_event", "event_id")
    keep = [c for c in keyed.columns if c not in ("source_row", "trading_date")]
    plan = keyed.select("trading_date").distinct().withColumn("status", F.lit("READY"))
    return rename(keyed, header_mapping(keep)), plan


#: Days fail here for three reasons: too many rejected rows, a broken rule, a source without integrity.
MIXED = replace(CLEANING, max_quarantine_fraction=0.45)


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    named, plan = _dated_texts(spark, sf_dir)
    dom = F.dayofmonth("trading_date")
    root = scratch_path(spark, "daily-mixed")
    integrity = plan.filter(dom != 5).select("trading_date", (dom % 10 != 4).alias("passed"))

    def enrich(rows: DataFrame) -> DataFrame:
        return rows.withColumn("daystoexpiry", F.when(dom % 10 == 7, -1.0).otherwise(F.col("daystoexpiry")))

    status = D.clean_days(named, plan, MIXED, root, "r2", "2024-02-01 00:00:00", integrity=integrity, enrich=enrich)
    return status, root


_MIXED_SQL = f"""{_TEXT_SQL},
dated AS (SELECT f.*, e.d, date_part('day', e.d) AS dom FROM final f JOIN ev e USING (event_id)),
days AS (SELECT d, dom, count(*) FILTER (WHERE reason IS NULL) AS accepted,
    count(*) FILTER (WHERE reason IS NULL) > 0 AND count(*) FILTER (WHERE reason IS NOT NULL) / sum(copies)::DOUBLE <= 0.45::DOUBLE
    AND dom % 10 NOT IN (4, 7) AND dom <> 5 AS good FROM dated GROUP BY d, dom)"""


@query(
    "daily_mixed_status",
    f"""WITH {_MIXED_SQL} SELECT CAST(d AS VARCHAR) AS trading_date, CASE WHEN good THEN 'PUBLISHED' ELSE 'QUARANTINED' END AS status FROM days""",
)
def daily_mixed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day is judged by itself."""
    return _mixed(spark, sf_dir)[0].withColumn("trading_date", F.col("trading_date").cast("string"))


@query(
    "daily_mixed_violations",
    f"""WITH {_MIXED_SQL}
SELECT CAST(d AS VARCHAR) AS trading_date, rule, accepted AS violations FROM days, (VALUES ('options.daystoexpiry: invalid nonnegative numeric value'),
  ('options.daystoexpiry: inconsistent with timestamps and expirydate')) r(rule) WHERE dom % 10 = 7 AND accepted > 0""",
)
def daily_mixed_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules of the table pair per day."""
    found = D.violations(spark, _mixed(spark, sf_dir)[1], "r2")
    return found.withColumn("trading_date", F.col("trading_date").cast("string"))


@query(
    "daily_mixed_tables",
    f"""WITH {_MIXED_SQL}
SELECT 'observations' AS "table", CAST(d AS VARCHAR) AS trading_date, source_row, (event_id * 2 + 5)::DOUBLE AS spot, event_id * 3 AS volume, NULL::DOUBLE AS strike, NULL AS optiontype, good AS published
FROM dated JOIN days USING (d) WHERE reason IS NULL
UNION ALL SELECT 'options', CAST(d AS VARCHAR), NULL, NULL, NULL, (k + 100) + 0.5::DOUBLE, CASE WHEN event_id % 5 IN (0, 1) THEN 'CE' ELSE 'PE' END, good FROM dated JOIN days USING (d) WHERE reason IS NULL""",
)
def daily_mixed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both tables, published or kept as candidates."""
    observations, options = D.day_tables(spark, _mixed(spark, sf_dir)[1], "r2")
    day = F.col("trading_date").cast("string").alias("trading_date")
    left = observations.select(F.lit("observations").alias("table"), day, "source_row", "spot", "volume", "published")
    right = options.select(F.lit("options").alias("table"), day, "strike", "optiontype", "published")
    return left.unionByName(right, allowMissingColumns=True)
