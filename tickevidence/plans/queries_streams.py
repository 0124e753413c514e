"""Registered queries: streams in several batches, with late rows and evicted state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, events
from tickevidence.session import scratch_path
from tickevidence.streaming import ingest as I
from tickevidence.streaming import timers as T

#: Days of the month that land together; rows with k % 25 = 3 land one batch later.
BATCH_DAYS, BATCHES = 6, 7
#: A clock row this long after the newest event lets the watermark decide everything else.
END_DAYS, DELAY_DAYS = 20, 13


def land(df: DataFrame, batch: Column, batches: int, name: str) -> str:
    """Write ``df`` as one file per batch, in order, so that a stream reads one batch per trigger."""
    path = scratch_path(df.sparkSession, name)
    for number in range(batches):
        df.filter(batch == number).coalesce(1).write.mode("append").parquet(path)
    return path


def arriving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of batches, some rows late, and the clock row at the end."""
    ev = events(spark, sf_dir).select("event_id", "event_type", "ts", "k")
    ev = ev.withColumn("batch", F.floor((F.dayofmonth("ts") - 1) / BATCH_DAYS) + F.when(F.col("k") % 25 == 3, 1).otherwise(0))
    end = ev.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit("clock").alias("event_type"),
        (F.col("ts") + F.expr(f"INTERVAL {END_DAYS} DAYS")).alias("ts"), F.lit(5).cast("bigint").alias("k"), F.lit(BATCHES - 1).alias("batch"),
    )
    all_rows = ev.unionByName(end)
    path = land(all_rows, F.col("batch"), BATCHES, "arriving")
    return I.read_landed(spark, path, all_rows.schema, max_files=1)


_CLOCK_SQL = f"""{EVENTS_SQL},
w AS (SELECT max(t_us) + {END_DAYS - DELAY_DAYS} * 86400000000 AS mark FROM ev)"""


@query(
    "stream_gaps",
    f"""WITH {_CLOCK_SQL},
s AS (SELECT event_type AS symbol, (t_us // 600000000) * 600000000 AS slot_us,
        min(CASE k % 10 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END) AS best FROM ev GROUP BY ALL),
g AS (SELECT symbol, unnest(range(min(slot_us), ((SELECT mark FROM w) // 600000000) * 600000000, 600000000)) AS slot_us FROM s GROUP BY symbol)
SELECT symbol, slot_us, CASE best WHEN 2 THEN 'REJECTED_CAPTURE' WHEN 3 THEN 'SKIPPED_BACKOFF_OR_LATE_TICK' ELSE 'MISSED_SCHEDULED_INTERVALS' END AS reason
FROM g LEFT JOIN s USING (symbol, slot_us) WHERE best IS NULL OR best > 1""",
)
def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5, Q18: slots without a capture, decided behind the watermark, with their reason; late rows open none."""
    name = F.when(F.col("k") % 10 == 0, T.REJECTED).when(F.col("k") % 10 == 1, T.SKIPPED).otherwise(T.CAPTURED)
    rows = arriving_events(spark, sf_dir).withColumn("result", name)
    gaps = T.slot_gaps(
        rows, by="event_type", time="ts", seconds=600, watermark=f"{DELAY_DAYS} days", silence_seconds=86_400, outcome="result"
    )
    found = I.drain(gaps, "gaps")
    step = F.lit(600_000_000).cast("bigint")
    return found.select("symbol", F.explode(F.sequence("start_us", F.col("end_us") - step, step)).alias("slot_us"), "reason")


@query(
    "stream_staleness",
    f"""WITH {_CLOCK_SQL},
p AS (SELECT DISTINCT event_type AS symbol, t_us FROM ev),
n AS (SELECT *, lead(t_us) OVER (PARTITION BY symbol ORDER BY t_us) AS next_us FROM p)
SELECT symbol, 'STALE' AS status, t_us + 3600000000 AS at_us, t_us AS newest_us FROM n WHERE coalesce(next_us, (SELECT mark FROM w)) - t_us > 3600000000
UNION ALL SELECT symbol, 'RECEIVING', next_us, next_us FROM n WHERE next_us - t_us > 3600000000""",
)
def stream_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per silence of more than an hour, and one row when it ends."""
    alerts = T.staleness_alerts(
        arriving_events(spark, sf_dir), by="event_type", time="ts", limit_seconds=3600, watermark=f"{DELAY_DAYS} days"
    )
    return I.drain(alerts, "staleness")


@query(
    "stream_link_reasons",
    f"""WITH {EVENTS_SQL}
SELECT event_id AS derived_id, CASE WHEN k % 11 = 0 OR k % 19 = 2 THEN NULL ELSE event_id END AS raw_id,
  CASE WHEN k % 11 = 0 OR k % 19 = 2 THEN 'MISSING_RAW_PARENT' WHEN k % 13 = 0 THEN 'CONFLICTING_RAW_PARENT' WHEN k % 17 = 0 THEN 'RAW_PARENT_TIMESTAMP_MISMATCH' END AS reason FROM ev""",
)
def stream_link_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every derived row linked to its RAW parent or listed with a reason; unmatched rows leave the state."""
    ev = arriving_events(spark, sf_dir)
    raw = ev.select(F.col("event_id").alias("raw_id"), F.sha2(F.col("k").cast("string"), 256).alias("raw_digest"), F.col("ts").alias("raw_at"))
    k = F.col("k")
    # The parent is absent (11), or was received too long before (19: an hour).
    delay = F.when(k % 19 == 2, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 2 SECONDS"))
    claimed = F.when(k % 17 == 0, F.col("ts") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("ts"))
    derived = arriving_events(spark, sf_dir).select(
        F.col("event_id").alias("derived_id"),
        F.when(k % 11 == 0, -2 - F.col("event_id")).otherwise(F.col("event_id")).alias("parent_id"),
        F.when(k % 13 == 0, "other").otherwise(F.sha2(k.cast("string"), 256)).alias("parent_digest"),
        claimed.alias("parent_at"),
        (F.col("ts") + delay).alias("derived_at"),
    )
    linked = T.link_to_parent(
        derived, raw, parent="parent_id", key="raw_id", derived_time="derived_at", raw_time="raw_at",
        within="3 SECONDS", watermark=f"{DELAY_DAYS} days", digest=("parent_digest", "raw_digest"), parent_time="parent_at",
    )
    return I.drain(linked.select("derived_id", "raw_id", "reason"), "link-reasons").filter("derived_id >= 0")
