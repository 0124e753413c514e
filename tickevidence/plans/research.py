"""The research run: samples, search, scan, audit, verdict, manifest.

Each stage is a table in the run folder. A stage that already exists with the
same inputs is read, not recomputed, so a stopped run continues where it ended.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators import audit as A
from tickevidence.operators import rules as R
from tickevidence.operators import sampling as S
from tickevidence.operators.cleaning import CONFLICT
from tickevidence.operators.quality import first_failure, require_clean, research_gate, research_gate_rules
from tickevidence.sources.tables import file_digests
from tickevidence.sources.verified import bucket_digests, dataset_digest, part_digests


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed (its success marker exists)."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def stage(spark: SparkSession, root: str, name: str, inputs: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Write a stage once per input fingerprint; read it when it is complete."""
    path = os.path.join(root, f"{name}-{hashlib.sha256(inputs.encode()).hexdigest()[:16]}")
    if finished(spark, path):
        return spark.read.parquet(path)
    frame = make()
    # Overwrite replaces only what a stopped attempt left behind.
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: What names a quote of a tape; the cleaner's natural key has more columns because a contract has no key there.
QUOTE_KEY = ["underlying", "timestamps", "contract_key", "optiontype"]


def repeated_quotes(tape: DataFrame) -> DataFrame:
    """The natural keys of more than one row: receipts with different ids that agree on time, side and contract.

    No key at all when an ``observation_id`` repeats: such a tape has no identity, and the gate must see it as it is.
    """
    counted = tape.groupBy("observation_id").agg(F.count(F.lit(1)).alias("n"))
    repeated_ids = counted.agg(F.count_if(F.col("n") > 1).alias("n")).scalar()
    keys = tape.groupBy(*QUOTE_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*QUOTE_KEY)
    return keys.filter(repeated_ids == 0)


def accepted_rows(tape: DataFrame, root: str, zone: str) -> DataFrame:
    """The rows of a raw tape that a run may use; the others go to ``quarantine_rows`` with the first rule they break.

    As the cleaner decides it before any research: row rules first, then all rows of a natural key that
    repeats. Repeated ids, prices that contradict each other and several contracts of a side at one
    receipt stay in and make the gate refuse the tape.
    """
    spark = tape.sparkSession
    reason = first_failure(research_gate_rules(zone=zone))
    judged = tape.withColumn("reason", reason)
    usable = judged.filter("reason IS NULL").drop("reason")
    # Few keys as a rule; stored once, since every stage reads the tape again.
    path = os.path.join(root, "repeated_quotes")
    found = repeated_quotes(usable)
    found.write.parquet(path)
    keys = spark.read.schema(found.schema).parquet(path)
    conflicts = usable.join(keys, QUOTE_KEY, "left_semi").select(*tape.columns, F.lit(CONFLICT).alias("reason"))
    judged.filter("reason IS NOT NULL").unionByName(conflicts).write.parquet(os.path.join(root, "quarantine_rows"))
    return usable.join(keys, QUOTE_KEY, "left_anti").select(*tape.columns)


def run_research(
    tape: DataFrame,
    root: str,
    dataset_id: str,
    sampling: S.SamplePolicy,
    search: R.SearchPolicy,
    *,
    gate_zone: str | None = None,
) -> tuple[A.Run, DataFrame, DataFrame]:
    """Run every stage; returns the run, its checks and its one-row verdict.

    Stages are keyed by the policies and by the content of the tape, so another tape
    under the same ``dataset_id`` reuses nothing.
    """
    spark = tape.sparkSession
    if gate_zone:
        require_clean(research_gate(tape, gate_zone))
    content = dataset_digest(part_digests(bucket_digests(tape, "trading_date"))).first()["dataset_id"]
    frozen = R.rule_context(dataset_id, sampling, search)
    context = frozen + content
    samples = stage(spark, root, "samples", context, lambda: S.build_samples(tape, sampling, dataset_id))
    log = stage(spark, root, "search_log", context, lambda: R.search_log(samples, sampling, search, dataset_id))
    rules = stage(spark, root, "rules", context, lambda: R.top_rules(log, search.max_conditions))
    hits = stage(spark, root, "hits", context, lambda: R.occurrences(samples, rules, sampling, search, frozen))
    sums = stage(spark, root, "summaries", context, lambda: R.rule_summaries(samples, rules, hits, search))
    run = A.Run(tape, samples, log, rules, hits, sums, sampling, search, dataset_id)
    checks = stage(spark, root, "checks", context, lambda: A.audit(run))
    verdict = stage(spark, root, "verdict", context, lambda: A.audit_status(checks, run))
    register(verdict, rules, root, context)
    return run, checks, verdict


def register(verdict: DataFrame, rules: DataFrame, root: str, context: str) -> None:
    """Rules of a passed run go to ``registry``, any other run's to ``quarantine``.

    The choice is data, not control flow: one verdict row is joined to the rules.
    """
    status = verdict.select("status").first()["status"]
    target = "registry" if status == "PASS" else "quarantine"
    path = os.path.join(root, f"{target}-{hashlib.sha256(context.encode()).hexdigest()[:16]}")
    rules.withColumn("status", F.lit(status)).write.mode("ignore").parquet(path)


def seal_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Digest of every file of the run folder."""
    return file_digests(spark, root, "*.parquet")


def run_metrics(run: A.Run, verdict: DataFrame) -> DataFrame:
    """Counts shown for a run: source rows, samples, events, unknowns, rules, verdict."""
    labels = run.samples.agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.count_if(F.col("label").isin(*run.sampling.targets())).alias("event_count"),
        F.count_if(F.col("label") == "UNKNOWN").alias("unknown_count"),
    )
    return (
        labels.withColumn("source_rows", run.tape.agg(F.count(F.lit(1)).alias("n")).scalar())
        .withColumn("tested_hypotheses", run.search_log.agg(F.count(F.lit(1)).alias("n")).scalar())
        .withColumn("condition_count", run.rules.agg(F.count(F.lit(1)).alias("n")).scalar())
        .withColumn("status", verdict.select("status").scalar())
    )


def rule_details(rules: DataFrame, summaries: DataFrame) -> DataFrame:
    """Each rule next to its discovery and evaluation summaries."""
    values = ["matches", "successes", "failures", "unknown_outcomes", "event_rate"]
    wide = summaries.groupBy("condition_id").agg(
        *[
            F.max(F.when(F.col("partition") == p, F.col(v))).alias(f"{p}_{v}")
            for p in ("discovery", "evaluation")
            for v in values
        ]
    )
    return rules.join(wide, "condition_id", "left")
