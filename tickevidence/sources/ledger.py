"""Append-only tables with a ledger of (key, digest): exact replays add nothing, changed rows are conflicts.

Everything lies in partitions by ``place``, a value computed from the key alone (say the
day inside an observation id), so a key can only ever be in one place and a batch
reads the ledger of its own places, not the history. A batch is judged once, its verdict is
staged, and rows, ledger entries and conflicts are written under a fresh attempt
number; one commit row makes them visible. An attempt that stops half-way is never seen,
and a batch whose number is committed is not run again. Nothing is overwritten.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.session import stage_table

COMMITS = "batch string, attempt string, new_rows bigint, replays bigint, conflicts bigint"
NEW, REPLAY, CONFLICT = "new", "replay", "conflict"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, empty when no batch has written it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, os.path.join(root, "commits"), COMMITS)


def _visible(rows: DataFrame, root: str) -> DataFrame:
    """Rows of committed attempts."""
    return rows.join(commits(rows.sparkSession, root).select("attempt"), "attempt", "left_semi")


def ledger(spark: SparkSession, root: str, places: list[str] | None = None) -> DataFrame:
    """Committed (key, digest, place), of the given places only."""
    rows = _read(spark, os.path.join(root, "ledger"), "key string, digest string, place string, attempt string")
    if places is not None:
        rows = rows.filter(F.col("place").isin(places))
    return _visible(rows, root).drop("attempt")


def stored(spark: SparkSession, root: str, schema: str, name: str = "rows") -> DataFrame:
    """Committed rows (or ``conflicts``) with the columns of ``schema``."""
    rows = _read(spark, os.path.join(root, name), f"{schema}, place string, attempt string")
    return _visible(rows, root).drop("place", "attempt")


def judge(batch: DataFrame, known: DataFrame, key: str, digest: str) -> DataFrame:
    """The batch with ``verdict``: new, replay or conflict.

    What is stored decides; inside the batch the smallest digest of a key is the row
    that counts, its copies are replays and others conflict. One row per key and digest
    meets the ledger, so a row sent a million times is counted before the shuffle.
    """
    own = [c for c in batch.columns if c != "place"]
    each = batch.groupBy(key, digest, "place").agg(F.count(F.lit(1)).alias("_sent"), F.min(F.struct(*own)).alias("_row"))
    first = each.groupBy(key, "place").agg(F.min(digest).alias("_first"))
    old = known.groupBy(F.col("key").alias(key), "place").agg(F.min("digest").alias("_old"))
    joined = each.join(first, [key, "place"]).join(old, [key, "place"], "left")
    wanted = F.coalesce("_old", "_first")
    verdict = F.when(F.col(digest) != wanted, CONFLICT).when(F.col("_old").isNotNull(), REPLAY).otherwise(NEW)
    return joined.select(*[F.col(f"_row.{c}").alias(c) for c in own], "place", "_sent", verdict.alias("verdict"))


def append_batch(
    batch: DataFrame, root: str, number: str, *, key: str, digest: str, place: Column, bulk: bool = False
) -> dict[str, int] | None:
    """Append a batch once; returns its counts, or None when ``number`` is already committed.

    ``place`` must depend on the key only. Rows without a key or digest fail the batch.
    With ``bulk`` any repeated or known key fails it, and nothing becomes visible.
    """
    spark = batch.sparkSession
    if not commits(spark, root).filter(F.col("batch") == number).isEmpty():
        return None
    placed = batch.withColumn("place", place.cast("string"))
    # The batch's own places: a few days per micro-batch. They become the partition filter.
    places = [r["place"] for r in placed.select("place").distinct().collect()]
    if None in places or not placed.filter(F.col(key).isNull() | F.col(digest).isNull()).isEmpty():
        raise ValueError("rows without a key, digest or place")
    judged = stage_table(judge(placed, ledger(spark, root, places), key, digest), "verdict")
    sent = F.col("_sent")
    n = judged.agg(
        F.coalesce(F.sum(F.when(F.col("verdict") == NEW, 1)), F.lit(0)).alias("new_rows"),
        F.coalesce(F.sum(F.when(F.col("verdict") == NEW, sent - 1).when(F.col("verdict") == REPLAY, sent)), F.lit(0)).alias("replays"),
        F.coalesce(F.sum(F.when(F.col("verdict") == CONFLICT, sent)), F.lit(0)).alias("conflicts"),
    ).first()
    if bulk and (n["replays"] or n["conflicts"]):
        raise ValueError(f"bulk append of known or repeated keys: {n['replays']} replays, {n['conflicts']} conflicts")
    attempt = os.urandom(8).hex()
    marked = judged.withColumn("attempt", F.lit(attempt))

    def write(rows: DataFrame, name: str) -> None:
        rows.write.mode("append").partitionBy("place", "attempt").parquet(os.path.join(root, name))

    fresh = marked.filter(F.col("verdict") == NEW).drop("verdict", "_sent")
    write(fresh, "rows")
    write(fresh.select(F.col(key).cast("string").alias("key"), F.col(digest).cast("string").alias("digest"), "place", "attempt"), "ledger")
    if n["conflicts"]:
        write(marked.filter(F.col("verdict") == CONFLICT).drop("verdict", "_sent"), "conflicts")
    counts = {c: int(n[c]) for c in ("new_rows", "replays", "conflicts")}
    spark.createDataFrame([(number, attempt, *counts.values())], COMMITS).write.mode("append").parquet(os.path.join(root, "commits"))
    return counts


def ledger_batches(root: str, name: str, *, key: str, digest: str, place: Column) -> Callable:
    """A ``foreachBatch`` function; ``name`` tells streams apart that feed one table."""

    def run(batch: DataFrame, number: int) -> None:
        append_batch(batch, root, f"{name}-{number}", key=key, digest=digest, place=place)

    return run
