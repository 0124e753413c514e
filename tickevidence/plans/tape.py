"""Market tapes derived from the driver's tables, for the registered queries.

The tables hold no option quotes, so each event becomes one receipt with a call
and a put leg. Every value is a plain function of the event row, written once
here and once in SQL for the check.
"""

from __future__ import annotations

from datetime import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators.sampling import SamplePolicy
from tickevidence.session import configure

# Event tapes are minutes apart, not seconds: clocks are coarser, rules the same.
POLICY = SamplePolicy(
    horizon_seconds=7200,
    anchor_seconds=3600,
    lookback_seconds=3600,
    quote_max_age_seconds=1800,
    max_gap_seconds=5400,
    min_move=25,
    max_move=80,
    analytics_max_age_seconds=1800,
    analytics_source_max_age_seconds=2700,
    zone="UTC",
    opens=time(0, 0),
    closes=None,
    weekdays_only=False,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant (UTC) and the number held in ``props``."""
    raw = table(spark, sf_dir, "events")
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    )


def option_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two legs per event; columns as :func:`build_samples` expects them."""
    ev = events(spark, sf_dir).withColumn("t_us", F.unix_micros("ts"))
    k, v = F.col("k"), F.col("value")

    def leg(side: str, bid, spread, shift: int, sign: float):
        live_bid = bid if side == "CE" else F.when(k % 13 != 5, bid)
        return F.struct(
            F.concat(F.col("event_id").cast("string"), F.lit(f"-{side}")).alias("observation_id"),
            F.lit(side).alias("optiontype"),
            live_bid.alias("bid"),
            (bid + spread).alias("ask"),
            (1000 + (F.col("event_id") * 7 + k * shift) % 500).alias("oi"),
            (F.col("event_id") * 10 + k * 20 * shift).alias("volume"),
            F.when(k % 10 != 3, 0.1 + (k + shift) / 500.0).alias("iv"),
            (F.lit(sign) * (0.3 + k / 400.0)).alias("delta"),
            ((k + shift) / 1000.0).alias("gamma"),
            (-(k + 1) / 50.0).alias("theta"),
            ((k + 2 * shift) / 25.0).alias("vega"),
        )

    legs = F.array(
        leg("CE", 1 + v * 0.9, 0.05 + (k % 5) * 0.05, 1, 1.0),
        leg("PE", 2 + (500 - v) * 0.5, 0.1 + (k % 7) * 0.05, 3, -1.0),
    )
    wide = ev.select(
        F.col("event_type").alias("underlying"),
        F.to_date("ts").alias("trading_date"),
        F.col("ts").alias("timestamps"),
        "t_us",
        v.alias("spot"),
        "k",
        F.when(k % 20 == 19, "1").otherwise("2").alias("source_version"),
        F.inline(legs),
    )
    period = ((F.col("t_us") - F.pmod("t_us", F.lit(28_800_000_000))) / F.lit(28_800_000_000)).cast("bigint")
    return wide.select(
        "observation_id",
        "timestamps",
        "underlying",
        "trading_date",
        "source_version",
        "spot",
        "optiontype",
        F.concat_ws("|", "underlying", period.cast("string"), "optiontype").alias("contract_key"),
        "bid",
        "ask",
        "oi",
        "volume",
        "iv",
        F.when(
            F.col("iv").isNotNull(), F.timestamp_micros(F.col("t_us") + F.col("k") * 20_000_000)
        ).alias("iv_available_at"),
        "delta",
        "gamma",
        "theta",
        "vega",
        F.when(k % 10 != 7, F.timestamp_micros(F.col("t_us") + (F.col("k") % 30) * 60_000_000)).alias(
            "greeks_available_at"
        ),
    )


# The same tape in SQL (DuckDB), as common table expressions.
EVENTS_SQL = """ev AS (
  SELECT event_id, epoch_us(ts) AS t_us, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         CAST(ts AS DATE) AS d
  FROM events)"""


def _leg_sql(side: str, bid: str, spread: str, shift: int, sign: str) -> str:
    live = bid if side == "CE" else f"CASE WHEN k % 13 <> 5 THEN {bid} END"
    return f"""SELECT CAST(event_id AS VARCHAR) || '-{side}' AS observation_id, t_us,
    event_type AS underlying, d AS trading_date, value AS spot, k,
    CASE WHEN k % 20 = 19 THEN '1' ELSE '2' END AS source_version,
    '{side}' AS optiontype,
    event_type || '|' || CAST(t_us // 28800000000 AS VARCHAR) || '|{side}' AS contract_key,
    {live} AS bid, {bid} + ({spread}) AS ask,
    1000 + (event_id * 7 + k * {shift}) % 500 AS oi,
    event_id * 10 + k * 20 * {shift} AS volume,
    CASE WHEN k % 10 <> 3 THEN 0.1::DOUBLE + (k + {shift}) / 500.0::DOUBLE END AS iv,
    CASE WHEN k % 10 <> 3 THEN t_us + k * 20000000 END AS iv_us,
    {sign}::DOUBLE * (0.3::DOUBLE + k / 400.0::DOUBLE) AS delta,
    (k + {shift}) / 1000.0::DOUBLE AS gamma,
    -(k + 1) / 50.0::DOUBLE AS theta,
    (k + 2 * {shift}) / 25.0::DOUBLE AS vega,
    CASE WHEN k % 10 <> 7 THEN t_us + (k % 30) * 60000000 END AS greeks_us
  FROM ev"""


TAPE_SQL = (
    EVENTS_SQL
    + ",\ntape AS (\n  "
    + _leg_sql("CE", "(1 + value * 0.9::DOUBLE)", "0.05::DOUBLE + (k % 5) * 0.05::DOUBLE", 1, "1.0")
    + "\n  UNION ALL\n  "
    + _leg_sql("PE", "(2 + (500 - value) * 0.5::DOUBLE)", "0.1::DOUBLE + (k % 7) * 0.05::DOUBLE", 3, "-1.0")
    + ")"
)
