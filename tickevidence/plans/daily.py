"""The daily cleaning job, as one Spark job over all requested days."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators import cleaning as L
from tickevidence.operators.quality import pair_violations
from tickevidence.session import stage_table
from tickevidence.sources.calendar import decide_sessions
from tickevidence.sources.tables import COMMIT_SCHEMA, ONLY_THESE_DAYS, committed, file_digests, write_quarantine, write_table_pair


def day_plan(dates: DataFrame, holidays: DataFrame, now: Column, rows: DataFrame, commits: DataFrame, revision: str) -> DataFrame:
    """What to do with each requested date: (trading_date, status).

    SKIPPED_WEEKEND, SKIPPED_MARKET_HOLIDAY and CALENDAR_UNAVAILABLE come from the
    calendar, WAITING_FOR_CLEANING from the clock, NO_DATA from the source; a
    revision that is already committed is reused, the rest is READY.
    """
    judged = decide_sessions(dates.withColumnRenamed("trading_date", "date"), holidays, now).withColumnRenamed(
        "date", "trading_date"
    )
    present = rows.select("trading_date").distinct().withColumn("_rows", F.lit(True))
    done = commits.filter(F.col("revision") == revision).select("trading_date").distinct().withColumn("_done", F.lit(True))
    joined = judged.join(present, "trading_date", "left").join(done, "trading_date", "left")
    status = (
        F.when(F.col("reason") == "weekend", "SKIPPED_WEEKEND")
        .when(F.col("decision") == "CLOSED", "SKIPPED_MARKET_HOLIDAY")
        .when(F.col("decision") == "UNKNOWN", "CALENDAR_UNAVAILABLE")
        .when(F.col("trading_date") >= F.to_date(now), "WAITING_FOR_CLEANING")
        .when(F.col("_done"), "PUBLISHED")
        .when(F.col("_rows").isNull(), "NO_DATA")
        .otherwise("READY")
    )
    return joined.select("trading_date", status.alias("status"))


def clean_days(
    raw: DataFrame,
    plan: DataFrame,
    policy: L.CleaningPolicy,
    root: str,
    revision: str,
    committed_at: str,
    *,
    integrity: DataFrame | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Clean every READY day at once, publish the days that pass, report all days.

    ``raw`` holds text rows with a ``trading_date`` and a ``source_row``. Each day is judged
    by its own counts, its own broken rules of the table pair, and its own source
    ``integrity`` (trading_date, passed), where given; a day absent there has not passed. ``enrich``
    maps accepted rows to accepted rows, say with stored calculations. Both tables of a
    passing day are written under the revision, then one commit row per day is appended;
    tables of a failing day are kept as candidates in quarantine. Broken rules are a table
    of their own, see :func:`violations`.
    """
    spark = raw.sparkSession
    ready = plan.filter("status = 'READY'").select("trading_date")
    wanted = raw.join(F.broadcast(ready), "trading_date", "left_semi")  # one row per calendar day
    done = L.clean(wanted, policy, by=("trading_date",))
    accepted = stage_table(done.accepted if enrich is None else enrich(done.accepted), "accepted")
    observations = accepted.select("trading_date", *L.names_of(L.OBSERVATION_SCHEMA))
    options = accepted.select("trading_date", *L.names_of(L.OPTION_SCHEMA))
    broken = stage_table(pair_violations(observations, options, "trading_date").withColumn("revision", F.lit(revision)), "violations")
    per_day = broken.groupBy("trading_date").agg(F.sum("violations").alias("violations"))
    gate = done.counts.join(per_day, "trading_date", "left").fillna(0, ["violations"])
    passed = F.col("passed") & (F.col("violations") == 0)
    if integrity is not None:
        gate = gate.join(integrity.select("trading_date", F.col("passed").alias("_source")), "trading_date", "left")
        passed = passed & F.coalesce("_source", F.lit(False))
    gate = stage_table(gate.withColumn("passed", passed), "gate")
    good = F.broadcast(gate.filter("passed").select("trading_date"))  # one row per calendar day
    folder = os.path.join(root, "data", f"revision={revision}")
    aside = os.path.join(root, "quarantine", f"revision={revision}")
    for how, where in (("left_semi", folder), ("left_anti", aside)):
        write_table_pair(observations.join(good, "trading_date", how), options.join(good, "trading_date", how), where, replace_days=True)
    write_quarantine(done.quarantine, aside)
    ledger = broken.write.mode("overwrite").options(**ONLY_THESE_DAYS).partitionBy("revision", "trading_date")
    ledger.parquet(os.path.join(root, "violations"))
    day = F.to_date(F.regexp_extract("path", r"trading_date=(\d{4}-\d{2}-\d{2})", 1))
    files = file_digests(spark, folder, "*.parquet").withColumn("trading_date", day)
    files = files.groupBy("trading_date").agg(F.collect_list(F.struct("path", "sha256", "size_bytes")).alias("artifacts"))
    commits = gate.filter("passed").join(files, "trading_date").select(
        "trading_date",
        F.lit(revision).alias("revision"),
        F.lit(committed_at).cast("timestamp").alias("committed_at"),
        F.lit("PUBLISHED").alias("status"),
        "artifacts",
        F.create_map(F.lit("observations"), F.col("accepted"), F.lit("options"), F.col("accepted")).alias("row_counts"),
    )
    commits.write.mode("append").parquet(os.path.join(root, "commits"))
    verdict = gate.select("trading_date", F.when(F.col("passed"), "PUBLISHED").otherwise("QUARANTINED").alias("_verdict"))
    return plan.join(verdict, "trading_date", "left").select(
        "trading_date", F.coalesce("_verdict", "status").alias("status")
    )


def violations(spark: SparkSession, root: str, revision: str) -> DataFrame:
    """(trading_date, rule, violations) of a revision."""
    rows = spark.read.schema("trading_date date, rule string, violations bigint, revision string").parquet(os.path.join(root, "violations"))
    return rows.filter(F.col("revision") == revision).drop("revision")


def day_tables(spark: SparkSession, root: str, revision: str) -> tuple[DataFrame, DataFrame]:
    """(observations, options) of a revision with ``published``: committed days, and the candidates of the others."""
    done = committed(spark, root).filter(F.col("revision") == revision).select("trading_date")

    def both(name: str, schema: str) -> DataFrame:
        reader = spark.read.schema(schema + ", trading_date date")
        data = reader.parquet(os.path.join(root, "data", f"revision={revision}", f"{name}.parquet"))
        data = data.join(F.broadcast(done), "trading_date", "left_semi")  # one row per calendar day
        aside = reader.parquet(os.path.join(root, "quarantine", f"revision={revision}", f"{name}.parquet"))
        return data.withColumn("published", F.lit(True)).unionByName(aside.withColumn("published", F.lit(False)))

    return both("observations", L.OBSERVATION_SCHEMA), both("options", L.OPTION_SCHEMA)


def run_status(days: DataFrame) -> DataFrame:
    """COMPLETE, ATTENTION_REQUIRED or NO_DATA for the whole run."""
    bad = F.count_if(F.col("status").isin("QUARANTINED", "RETRY_PENDING", "CALENDAR_UNAVAILABLE"))
    out = days.agg(bad.alias("_bad"), F.count_if(F.col("status") == "PUBLISHED").alias("_good"))
    return out.select(
        F.when(F.col("_bad") > 0, "ATTENTION_REQUIRED").when(F.col("_good") > 0, "COMPLETE").otherwise("NO_DATA").alias("status")
    )


__all__ = ["COMMIT_SCHEMA", "clean_days", "committed", "day_plan", "day_tables", "run_status", "violations"]
