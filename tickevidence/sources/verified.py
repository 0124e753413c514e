"""Verified datasets: registered files, one pass that proves the table pair, and a content identity.

The identity is hierarchical. Every row is hashed; row hashes are folded per
(part, bucket), bucket digests per part, part digests to one dataset id. Folding
adds, so neither row order nor file layout matters and the work combines map-side;
two datasets that differ can be compared part by part and bucket by bucket.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.sources.tables import artifact_problems, file_digests

#: Buckets of row hashes in a part.
BUCKETS = 64
#: A row hash is added up in lanes of so many hex digits, each an exact whole number.
LANES, DIGITS = 4, 15

REGISTRY_SCHEMA = (
    "trading_date date, table string, path string, sha256 string, size_bytes bigint, rows bigint, verified boolean"
)


def row_hash(columns: list[str]) -> Column:
    """sha256 of a row: each value as text behind its length in bytes, ``-`` for NULL."""

    def field(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def bucket_digests(df: DataFrame, part: str, columns: list[str] | None = None) -> DataFrame:
    """(part, bucket, rows, digest): the lowest level of the identity. A NULL part is a part of its own."""
    hashed = df.select(F.col(part).cast("string").alias("part"), row_hash(columns or df.columns).alias("_h"))
    lanes = [
        F.conv(F.substring("_h", 1 + i * DIGITS, DIGITS), 16, 10).cast("decimal(20,0)").alias(f"_l{i}") for i in range(LANES)
    ]
    bucket = F.pmod(F.conv(F.substring("_h", 61, 4), 16, 10).cast("int"), F.lit(BUCKETS))
    sums = hashed.select("part", bucket.alias("bucket"), *lanes).groupBy("part", "bucket").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(f"_l{i}").cast("string").alias(f"_l{i}") for i in range(LANES)]
    )
    digest = F.sha2(F.concat_ws(",", F.col("rows").cast("string"), *[f"_l{i}" for i in range(LANES)]), 256)
    return sums.select("part", "bucket", "rows", digest.alias("digest"))


def _fold(items: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(F.collect_list(items)), ";"), 256)


def part_digests(buckets: DataFrame) -> DataFrame:
    """(part, rows, digest) from at most ``BUCKETS`` digests per part."""
    item = F.concat_ws(":", F.lpad(F.col("bucket").cast("string"), 4, "0"), "digest")
    return buckets.groupBy("part").agg(F.sum("rows").alias("rows"), _fold(item).alias("digest"))


def dataset_digest(parts: DataFrame, version: str = "2") -> DataFrame:
    """One row (rows, dataset_id) from one digest per part; parts are days, so they are few."""
    item = F.concat_ws(":", F.coalesce("part", F.lit("")), "digest")
    out = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"), _fold(item).alias("_all"))
    return out.select("rows", F.sha2(F.concat_ws("|", F.lit(version), "_all"), 256).alias("dataset_id"))


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """(part, bucket, rows_before, rows_after) where two datasets differ."""
    a = before.select(F.col("part").alias("_p"), F.col("bucket").alias("_b"), F.col("rows").alias("rows_before"), F.col("digest").alias("_d"))
    joined = a.join(after, F.col("_p").eqNullSafe(F.col("part")) & (F.col("_b") == F.col("bucket")), "full_outer")
    changed = joined.filter(~F.col("_d").eqNullSafe(F.col("digest")))
    return changed.select(
        F.coalesce("part", "_p").alias("part"), F.coalesce("bucket", "_b").alias("bucket"), "rows_before", F.col("rows").alias("rows_after")
    )


@dataclass(frozen=True)
class Verified:
    """Rows of the wanted version, what was left out and why, and the identity of the rows."""

    rows: DataFrame
    excluded: DataFrame  # (version, n)
    problems: DataFrame  # (subject, problem)
    parts: DataFrame  # (part, rows, digest)
    dataset_id: DataFrame  # one row: (rows, dataset_id)

    def require(self) -> Verified:
        """Itself, or an error that names the first problems."""
        found = self.problems.limit(5).collect()
        if found:
            raise ValueError("dataset is not verified: " + "; ".join(f"{r['subject']}: {r['problem']}" for r in found))
        return self


def prove_pair(observations: DataFrame, options: DataFrame, key: str = "observation_id") -> tuple[DataFrame, DataFrame]:
    """(joined rows, problems) of two tables that must hold the same ids once each and agree on shared columns.

    One exchange: both tables are stacked and meet by id with counts, so an id
    that repeats a million times is combined before the shuffle and multiplies
    nothing. Rows without an id are counted, never joined.
    """
    shared = [c for c in observations.columns if c in options.columns and c != key]
    own = [c for c in options.columns if c not in observations.columns]
    left = observations.select(key, F.struct(*[c for c in observations.columns if c != key]).alias("_l"), F.lit(None).alias("_r"))
    right = options.select(key, F.lit(None).alias("_l"), F.struct(*shared, *own).alias("_r"))
    stacked = left.withColumn("_r", F.lit(None).cast(right.schema["_r"].dataType)).unionByName(
        right.withColumn("_l", F.lit(None).cast(left.schema["_l"].dataType))
    )
    met = stacked.groupBy(key).agg(
        F.count("_l").alias("_nl"), F.count("_r").alias("_nr"), F.max("_l").alias("_l"), F.max("_r").alias("_r")
    )
    clash = [F.when(~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")), F.lit(f"conflicting column: {c}")) for c in shared]
    both = (F.col("_nl") == 1) & (F.col("_nr") == 1)
    problem = (
        F.when(F.col(key).isNull(), "missing id")
        .when((F.col("_nl") > 1) | (F.col("_nr") > 1), "repeated id")
        .when(F.col("_nr") == 0, "id only in observations")
        .when(F.col("_nl") == 0, "id only in options")
        .when(both, F.coalesce(*clash, F.lit(None).cast("string")))
    )
    judged = met.withColumn("_problem", problem)
    good = judged.filter(F.col("_problem").isNull())
    columns = [F.col(f"_l.{c}").alias(c) for c in observations.columns if c != key]
    joined = good.select(key, *columns, *[F.col(f"_r.{c}").alias(c) for c in own])
    bad = judged.filter(F.col("_problem").isNotNull())
    return joined, bad.select(F.coalesce(F.col(key).cast("string"), F.lit("(none)")).alias("subject"), F.col("_problem").alias("problem"))


def verify_tables(
    observations: DataFrame,
    options: DataFrame,
    *,
    expected: DataFrame | None = None,
    more_problems: DataFrame | None = None,
    part: str = "trading_date",
    version: str = "2",
    identity: list[str] | None = None,
) -> Verified:
    """A verified dataset from the two tables.

    ``expected`` (part, rows) holds the registered rows of each part; ``identity``
    names the columns of the content hash (all, unless given). Only rows of ``version`` are
    returned; other versions, NULL as MISSING, are counted.
    """
    joined, problems = prove_pair(observations, options)
    if expected is not None:
        have = observations.groupBy(F.col(part).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("_have"))
        want = expected.select(F.col("part").cast("string").alias("_p"), F.col("rows").alias("_want"))
        counted = have.join(want, F.col("part").eqNullSafe(F.col("_p")), "full_outer").filter(~F.col("_have").eqNullSafe(F.col("_want")))
        text = F.concat_ws(" ", F.lit("row count differs from registry:"), F.coalesce("_have", F.lit(0)).cast("string"), F.lit("of"), F.coalesce("_want", F.lit(0)).cast("string"))
        problems = problems.unionByName(counted.select(F.coalesce("part", "_p", F.lit("(none)")).alias("subject"), text.alias("problem")))
    if more_problems is not None:
        problems = problems.unionByName(more_problems)
    eligible = F.col("source_version").cast("string").eqNullSafe(F.lit(version))
    label = F.coalesce(F.col("source_version").cast("string"), F.lit("MISSING"))
    excluded = joined.filter(~eligible).groupBy(label.alias("version")).agg(F.count(F.lit(1)).alias("n"))
    rows = joined.filter(eligible)
    parts = part_digests(bucket_digests(rows, part, identity))
    return Verified(rows, excluded, problems, parts, dataset_digest(parts, version))


def _plain(path: str) -> Column:
    """One spelling of local paths, which readers write with one or three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def registered_table(spark: SparkSession, root: str, registry: DataFrame, name: str) -> DataFrame:
    """Rows of the registered files of one table; files that nobody registered are not read into the result."""
    rows = spark.read.parquet(os.path.join(root, name))
    files = registry.filter((F.col("table") == name) & F.col("verified")).select(_plain("path").alias("_file")).distinct()
    return rows.withColumn("_file", _plain("_metadata.file_path")).join(files, "_file", "left_semi").drop("_file")


def load_verified(spark: SparkSession, root: str, registry: DataFrame, *, version: str = "2", identity: list[str] | None = None) -> Verified:
    """The dataset that ``registry`` (REGISTRY_SCHEMA) names under ``root``: files re-hashed, tables proved, rows selected.

    ``root`` holds the folders ``observations`` and ``options``; paths are full ones. A
    file that is missing, altered, never verified or not registered is a problem, and so is
    everything :func:`verify_tables` finds. Nothing is raised here; call ``require()``.
    """
    actual = file_digests(spark, root, "*.parquet").withColumn("path", _plain("path"))
    registry = registry.withColumn("path", _plain("path"))
    named = registry.select("path", "sha256", "size_bytes")
    altered = artifact_problems(named, actual).select(F.col("path").alias("subject"), "problem")
    unproved = registry.filter(~F.coalesce("verified", F.lit(False))).select(F.col("path").alias("subject"), F.lit("artifact was not verified").alias("problem"))
    strange = actual.join(named.select("path"), "path", "left_anti").select(F.col("path").alias("subject"), F.lit("artifact is not registered").alias("problem"))
    days = registry.filter(F.col("table") == "observations").groupBy(F.col("trading_date").alias("part")).agg(F.sum("rows").alias("rows"))
    return verify_tables(
        registered_table(spark, root, registry, "observations"),
        registered_table(spark, root, registry, "options"),
        expected=days,
        more_problems=altered.unionByName(unproved).unionByName(strange),
        version=version,
        identity=identity,
    )


def register_files(spark: SparkSession, root: str) -> DataFrame:
    """A registry of the files under ``root`` as they are now; one row per file, partitioned tables by ``trading_date``."""
    files = file_digests(spark, root, "*.parquet").withColumn("path", _plain("path"))
    out = None
    for name in ("observations", "options"):
        rows = spark.read.parquet(os.path.join(root, name)).select("trading_date", _plain("_metadata.file_path").alias("path"))
        counted = rows.groupBy("path", "trading_date").agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    joined = out.join(files, "path").withColumn("verified", F.lit(True))
    return joined.select(F.col("trading_date").cast("date").alias("trading_date"), "table", "path", "sha256", "size_bytes", "rows", "verified")
