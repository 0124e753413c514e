"""Registered queries: verified loading and content identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.plans.registry import query
from tickevidence.plans.tape import TAPE_SQL, option_tape
from tickevidence.sources import verified as V

IDENTITY = ["observation_id", "underlying", "trading_date", "optiontype", "oi", "volume"]


def faulty_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The tape as two tables with planted faults: altered names, ids on one side only, repeated ids."""
    tape = option_tape(spark, sf_dir).withColumn("_e", F.split("observation_id", "-")[0].cast("bigint"))
    observations = tape.filter("_e % 103 <> 7").select(
        "observation_id", "timestamps", "underlying", "trading_date", "spot", "source_version", "volume", "iv"
    )
    name = F.when(F.col("_e") % 97 == 3, "other").otherwise(F.col("underlying"))
    options = tape.filter("_e % 101 <> 5").withColumn("underlying", name)
    options = options.unionByName(options.filter("_e % 107 = 9"))
    return observations, options.select("observation_id", "timestamps", "underlying", "optiontype", "bid", "ask", "oi")


_PAIR_SQL = f"""{TAPE_SQL},
src AS (SELECT *, CAST(split_part(observation_id, '-', 1) AS BIGINT) AS e FROM tape),
met AS (SELECT *, CASE WHEN e % 103 <> 7 THEN 1 ELSE 0 END AS nl, CASE WHEN e % 101 = 5 THEN 0 WHEN e % 107 = 9 THEN 2 ELSE 1 END AS nr FROM src),
judged AS (SELECT *, CASE WHEN nl > 1 OR nr > 1 THEN 'repeated id' WHEN nl + nr = 0 THEN 'absent' WHEN nr = 0 THEN 'id only in observations'
  WHEN nl = 0 THEN 'id only in options' WHEN e % 97 = 3 THEN 'conflicting column: underlying' END AS problem FROM met)"""


def _verified(spark: SparkSession, sf_dir: str) -> V.Verified:
    observations, options = faulty_pair(spark, sf_dir)
    expected = option_tape(spark, sf_dir).groupBy(F.col("trading_date").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    return V.verify_tables(observations, options, expected=expected, identity=IDENTITY)


@query(
    "verified_rows",
    f"""WITH {_PAIR_SQL}
SELECT observation_id, underlying, CAST(trading_date AS VARCHAR) AS trading_date, optiontype, oi, volume FROM judged
WHERE problem IS NULL AND source_version = '2'""",
)
def verified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose two halves agree, of the eligible version."""
    rows = _verified(spark, sf_dir).rows
    return rows.select("observation_id", "underlying", F.col("trading_date").cast("string").alias("trading_date"), "optiontype", "oi", "volume")


@query(
    "verified_problems",
    f"""WITH {_PAIR_SQL},
days AS (SELECT trading_date, count(*) AS want, sum(nl) AS have FROM judged GROUP BY trading_date)
SELECT observation_id AS subject, problem FROM judged WHERE problem IS NOT NULL AND problem <> 'absent'
UNION ALL SELECT CAST(trading_date AS VARCHAR), 'row count differs from registry: ' || have || ' of ' || want FROM days WHERE have <> want""",
)
def verified_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id that fails the pair, and every day whose row count differs from the registry."""
    return _verified(spark, sf_dir).problems


@query(
    "verified_exclusions",
    f"WITH {_PAIR_SQL} SELECT source_version AS version, count(*) AS n FROM judged WHERE problem IS NULL AND source_version <> '2' GROUP BY 1",
)
def verified_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left out by version."""
    return _verified(spark, sf_dir).excluded


_HASH_SQL = f"""{_PAIR_SQL},
h AS (SELECT CAST(trading_date AS VARCHAR) AS part, sha256(concat(strlen(observation_id), ':', observation_id, strlen(underlying), ':', underlying, '10:', trading_date,
        strlen(optiontype), ':', optiontype, strlen(CAST(oi AS VARCHAR)), ':', oi, strlen(CAST(volume AS VARCHAR)), ':', volume)) AS h
      FROM judged WHERE problem IS NULL AND source_version = '2'),
b AS (SELECT part, CAST('0x' || substr(h, 61, 4) AS BIGINT) % 64 AS bucket, count(*) AS rows,
        sha256(concat_ws(',', count(*), sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)), sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)),
                         sum(CAST('0x' || substr(h, 31, 15) AS BIGINT)), sum(CAST('0x' || substr(h, 46, 15) AS BIGINT)))) AS digest FROM h GROUP BY ALL),
p AS (SELECT part, CAST(sum(rows) AS BIGINT) AS rows, sha256(string_agg(lpad(CAST(bucket AS VARCHAR), 4, '0') || ':' || digest, ';' ORDER BY bucket)) AS digest FROM b GROUP BY part)"""


@query("dataset_parts", f"WITH {_HASH_SQL} SELECT part, rows, digest FROM p")
def dataset_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content digest of each day of the verified rows."""
    return _verified(spark, sf_dir).parts


@query(
    "dataset_identity",
    f"WITH {_HASH_SQL} SELECT CAST(sum(rows) AS BIGINT) AS rows, sha256('2|' || sha256(string_agg(part || ':' || digest, ';' ORDER BY part))) AS dataset_id FROM p",
)
def dataset_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset id folded from the days."""
    return _verified(spark, sf_dir).dataset_id


@query(
    "dataset_differences",
    """WITH h AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey, o_orderstatus FROM orders)
SELECT CAST(d AS VARCHAR) AS part, count(*) AS changed FROM h WHERE o_orderkey % 500 = 1 GROUP BY d""",
)
def dataset_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts whose content changed between two copies, by their bucket digests."""
    from tickevidence.plans.tape import table

    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"), "o_orderkey", "o_orderstatus")
    changed = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 500 == 1, "?").otherwise(F.col("o_orderstatus")))
    found = V.differing_buckets(V.bucket_digests(orders, "d"), V.bucket_digests(changed, "d"))
    # A changed row leaves one bucket and enters one; what the parts lost and gained tells how many changed.
    moved = found.groupBy("part").agg(F.count(F.lit(1)).alias("buckets"))
    rows = changed.filter("o_orderstatus = '?'").groupBy(F.col("d").cast("string").alias("part")).agg(F.count(F.lit(1)).alias("changed"))
    return moved.join(rows, "part").select("part", "changed")
