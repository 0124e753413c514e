"""Registered queries: reading files whose records are partly faulty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, events
from tickevidence.session import scratch_path
from tickevidence.sources import tables as S

FIELDS = ["event_id", "event_type", "big"]
#: Records in one array file.
RECORDS = 500


def _arrays(spark: SparkSession, sf_dir: str) -> S.JsonRecords:
    """Events as files of one JSON array each: some records with further fields, nested values, or no object at all."""
    k = F.col("k")
    record = F.struct(
        "event_id",
        "event_type",
        F.lit(9007199254740993).alias("big"),
        F.when(k % 7 == 0, k).alias("extra"),
        F.when(k % 9 == 0, "x").alias("note"),
        F.when(k % 11 == 0, F.struct(k)).alias("deep"),
    )
    # NULL fields are left out; a number in place of a record is no object.
    value = F.when(k % 13 == 0, k.cast("string")).otherwise(F.to_json(record))
    chunk = F.floor(F.col("event_id") / RECORDS).alias("chunk")
    docs = events(spark, sf_dir).select(chunk, value.alias("record")).groupBy("chunk")
    docs = docs.agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]")).alias("value"))
    spoilt = spark.range(1).select(F.lit(-1).cast("bigint").alias("chunk"), F.lit('[{"event_id": NaN}]').alias("value"))
    path = scratch_path(spark, "json-arrays")
    docs.unionByName(spoilt).write.partitionBy("chunk").text(path)
    return S.read_json_records(spark, path, FIELDS, array=True)


@query(
    "json_array_rows",
    f"""WITH {EVENTS_SQL} SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, '9007199254740993' AS big FROM ev WHERE k % 13 <> 0 AND k % 11 <> 0""",
)
def json_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of JSON arrays as text, whole numbers exact."""
    return _arrays(spark, sf_dir).rows


@query(
    "json_array_unknown",
    f"""WITH {EVENTS_SQL}, g AS (SELECT * FROM ev WHERE k % 13 <> 0 AND k % 11 <> 0)
SELECT 'extra' AS field, count(*) AS records FROM g WHERE k % 7 = 0 UNION ALL SELECT 'note', count(*) FROM g WHERE k % 9 = 0""",
)
def json_array_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields nobody asked for, with the number of records that have them."""
    return _arrays(spark, sf_dir).unknown


@query(
    "json_array_rejected",
    f"""WITH {EVENTS_SQL} SELECT reason, count(*) AS n FROM (
SELECT CASE WHEN k % 13 = 0 THEN 'malformed_record' ELSE 'nested_value' END AS reason FROM ev WHERE k % 13 = 0 OR k % 11 = 0
UNION ALL SELECT 'malformed_array') GROUP BY reason""",
)
def json_array_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was rejected and why; one bad array does not hide the others."""
    return _arrays(spark, sf_dir).rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
