"""Registered queries: append-only tables with a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, events
from tickevidence.session import scratch_path
from tickevidence.sources import ledger as L

SCHEMA = "event_id bigint, key string, digest string"


def append_three(spark: SparkSession, sf_dir: str) -> str:
    """Three batches with copies, replays, changed rows and a batch that is delivered twice."""
    root = scratch_path(spark, "ledger")
    ev = events(spark, sf_dir)
    key = F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"))
    rows = ev.select("event_id", key.alias("key"), F.sha2(F.col("k").cast("string"), 256).alias("digest"), "k")

    def of(condition: str) -> DataFrame:
        return rows.filter(condition).drop("k")

    changed = of("k % 9 = 0 OR k % 15 = 2").withColumn("digest", F.lit("~"))
    batches = [
        ("b0", of("k % 3 = 0").unionByName(of("k % 6 = 0"))),
        ("b1", of("k % 3 = 1").unionByName(of("k % 6 = 0"))),
        ("b1", of("k % 3 = 1").unionByName(of("k % 6 = 0"))),
        ("b2", of("k % 3 = 2").unionByName(changed)),
    ]
    for number, batch in batches:
        L.append_batch(batch, root, number, key="key", digest="digest", place=F.substring("key", 1, 10))
    return root


@query(
    "ledger_rows",
    f"""WITH {EVENTS_SQL} SELECT event_id, 'stored' AS found FROM ev UNION ALL SELECT event_id, 'conflict' FROM ev WHERE k % 9 = 0 OR k % 15 = 2""",
)
def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three batches leave behind: every row once, and the changed rows as conflicts."""
    root = append_three(spark, sf_dir)
    rows = L.stored(spark, root, SCHEMA).select("event_id", F.lit("stored").alias("found"))
    return rows.unionByName(L.stored(spark, root, SCHEMA, "conflicts").select("event_id", F.lit("conflict").alias("found")))


@query(
    "ledger_commits",
    f"""WITH {EVENTS_SQL}
SELECT 'b0' AS batch, count_if(k % 3 = 0) AS new_rows, count_if(k % 6 = 0) AS replays, 0::BIGINT AS conflicts FROM ev
UNION ALL SELECT 'b1', count_if(k % 3 = 1), count_if(k % 6 = 0), 0 FROM ev
UNION ALL SELECT 'b2', count_if(k % 3 = 2), 0, count_if(k % 9 = 0) + count_if(k % 15 = 2) FROM ev""",
)
def ledger_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4: one commit per batch with its counts; the repeated delivery has none."""
    return L.commits(spark, append_three(spark, sf_dir)).drop("attempt")
