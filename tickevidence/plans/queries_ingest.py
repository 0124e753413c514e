"""Registered queries: payloads, enrichment, explorer, files, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators import enrich as N
from tickevidence.operators import explorer as E
from tickevidence.operators import quality as Q
from tickevidence.operators import segments as G
from tickevidence.plans.queries_samples import OUTCOME_SQL, sample_outcomes
from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, TAPE_SQL, events, option_tape, table
from tickevidence.session import configure, scratch_path
from tickevidence.sources import payloads as P
from tickevidence.sources import tables as S
from tickevidence.sources.ledger import ledger_batches, stored
from tickevidence.streaming import ingest as I
from tickevidence.streaming.timers import link_to_parent

# Payloads -------------------------------------------------------------------------


@query(
    "quote_payloads",
    f"""WITH {EVENTS_SQL}
SELECT event_id, CASE WHEN k % 5 <> 0 THEN value END AS ltp, CASE WHEN k % 7 = 1 THEN NULL ELSE event_id END AS oi, k AS bid_qty,
  value * 2 AS prev_close FROM ev""",
)
def quote_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed quotes with alternative field names; booleans and words become NULL."""
    k = F.col("k")
    v = F.col("value").cast("string")
    ltp = F.when(k % 5 == 0, F.lit('"ltp":true')).when(k % 5 == 1, F.concat(F.lit('"last_price":'), v)).otherwise(
        F.concat(F.lit('"ltp":'), v)
    )
    oi = F.when(k % 7 == 1, F.lit('"oi":"NaN"')).when(k % 7 == 2, F.concat(F.lit('"open_interest":'), F.col("event_id").cast("string"))).otherwise(
        F.concat(F.lit('"oi":'), F.col("event_id").cast("string"))
    )
    doc = F.concat(
        F.lit('{"data":{'), F.concat_ws(",", ltp, oi, F.concat(F.lit('"bid_quantity":'), k.cast("string")), F.concat(F.lit('"previous_close":'), (F.col("value") * 2).cast("string"))), F.lit("}}")
    )
    out = P.parse_quotes(events(spark, sf_dir).select("event_id", doc.alias("payload")), "payload")
    return out.select("event_id", "ltp", "oi", "bid_qty", "prev_close")


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items as an option chain; the line number is the strike."""
    leg = F.struct(
        F.concat(F.lit("C"), F.col("l_partkey").cast("string")).alias("symbol"), F.col("l_extendedprice").alias("ltp"), F.col("l_quantity").alias("oi")
    )
    put = F.when(F.col("l_quantity") > 5, F.struct(
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("symbol"), F.col("l_tax").alias("ltp"), F.col("l_quantity").alias("oi")
    ))
    entry = F.struct(F.col("l_linenumber").cast("double").alias("strike"), leg.alias("ce"), put.alias("pe"))
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(entry).alias("chain"))).alias("payload"))
    return per.withColumn("atm", F.lit(2.0))


_CHAIN_SQL = """ch AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber = 2) AS n, any_value(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS part,
  max(CASE WHEN l_linenumber = 2 THEN l_suppkey END) AS supp, max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS price,
  max(CASE WHEN l_linenumber = 2 THEN l_tax END) AS tax, max(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS qty FROM lineitem GROUP BY 1)"""


@query(
    "option_chain_legs",
    f"""WITH {_CHAIN_SQL}
SELECT l_orderkey, 'CE' AS side, 'C' || part AS symbol, price AS ltp, qty AS oi FROM ch WHERE n = 1 AND qty > 5
UNION ALL SELECT l_orderkey, 'PE', 'P' || supp, tax, qty FROM ch WHERE n = 1 AND qty > 5""",
)
def option_chain_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both legs of the at-the-money strike."""
    good, _ = P.flatten_chain(_chains(spark, sf_dir), "payload", "atm")
    return good.select("l_orderkey", "side", "symbol", "ltp", "oi")


@query(
    "option_chain_rejects",
    f"""WITH {_CHAIN_SQL}
SELECT l_orderkey, CASE WHEN n = 0 THEN 'strike_missing' WHEN n > 1 THEN 'strike_ambiguous' ELSE 'leg_missing' END AS reason
FROM ch WHERE n <> 1 OR qty <= 5""",
)
def option_chain_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads without exactly one complete strike."""
    _, bad = P.flatten_chain(_chains(spark, sf_dir), "payload", "atm")
    return bad.select("l_orderkey", "reason")


@query(
    "analytics_payloads",
    f"""WITH {EVENTS_SQL}
SELECT event_id, CASE WHEN k % 6 <> 0 THEN k / 100.0::DOUBLE END AS iv, CASE WHEN k % 6 <> 0 AND k % 4 <> 1 THEN 0.5::DOUBLE END AS delta,
  CASE WHEN k % 6 = 0 THEN 'MISSING' WHEN k % 4 = 1 OR k = 0 THEN 'PARTIAL' ELSE 'VALID' END AS analytics_status FROM ev""",
)
def analytics_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested or flat analytics with their status."""
    k = F.col("k")
    greeks = F.concat_ws(",", *[F.concat(F.lit(f'"{g}":0.5')) for g in ("gamma", "theta", "vega", "rho")], F.when(k % 4 != 1, '"delta":0.5'))
    iv = F.concat(F.lit('"implied_volatility":'), (k / 100.0).cast("string"))
    nested = F.concat(F.lit('{"data":{'), iv, F.lit(',"greeks":{'), greeks, F.lit("}}}"))
    flat = F.concat(F.lit('{"data":{'), iv, F.lit(","), greeks, F.lit("}}"))
    doc = F.when(k % 6 == 0, F.lit(None)).when(k % 2 == 0, nested).otherwise(flat)
    out = P.parse_analytics(events(spark, sf_dir).select("event_id", doc.alias("payload")), "payload")
    return out.select("event_id", "iv", "delta", "analytics_status")


def _candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of each (event_type, day) as one JSON array."""
    k = F.col("k")
    at = F.expr("timestamp_micros(unix_micros(ts) div 3600000000 * 3600000000)")
    shifted = F.when(k % 17 == 0, at + F.expr("INTERVAL 3 SECONDS")).otherwise(at)
    candle = F.struct(
        F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("value").alias("open"), (F.col("value") + 1).alias("high"),
        F.when(k % 13 == 0, F.col("value") + 2).otherwise(F.col("value") - 0.005).alias("low"),
        F.col("value").alias("close"), k.alias("volume"), (k % 10).alias("oi"),
    )
    return events(spark, sf_dir).groupBy("event_type", F.to_date("ts").alias("day"), F.expr("event_id % 16").alias("part")).agg(
        F.to_json(F.collect_list(candle)).alias("payload")
    )


@query(
    "history_candles",
    f"""WITH {EVENTS_SQL},
c AS (SELECT *, event_id % 16 AS part, (t_us // 3600000000) * 3600000000 + CASE WHEN k % 17 = 0 THEN 3000000 ELSE 0 END AS at_us FROM ev)
SELECT event_type, CAST(d AS VARCHAR) AS day, part, at_us, k AS volume, CASE WHEN k % 10 <> 0 THEN k % 10 END AS oi,
  CASE WHEN k % 17 = 0 THEN 'HistoryTimestamp'
       WHEN count(*) OVER (PARTITION BY event_type, d, part, at_us) > 1 THEN 'HistoryTimestamp'
       WHEN k % 13 <> 0 AND value - 0.005::DOUBLE <= 0 THEN 'InvalidNumber'
       WHEN k % 13 = 0 THEN 'InvalidOHLC' END AS reason FROM c""",
)
def history_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles with time, uniqueness and price checks."""
    out = P.explode_candles(_candles(spark, sf_dir), "payload")
    return out.select(
        "event_type", F.col("day").cast("string").alias("day"), "part", F.unix_micros("timestamp").alias("at_us"),
        F.col("volume").cast("bigint").alias("volume"), F.col("oi").cast("bigint").alias("oi"), "reason",
    )


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW observation lines from events: one weekday at 05:00 UTC shifted by the minute, with planted faults."""
    k, e = F.col("k"), F.col("event_id")
    base = F.timestamp_micros(F.lit(1_705_294_800_000_000) + (e % 240) * 60_000_000)  # Monday 2024-01-15 05:00 UTC

    def iso(ts) -> Column:
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")

    late = F.when(k % 11 == 0, 6_000_000).otherwise(1_000_000)
    received = F.timestamp_micros(F.unix_micros(base) + late)
    started = F.when(k % 13 == 0, received + F.expr("INTERVAL 1 SECOND")).otherwise(base)

    def leg(side: str) -> Column:
        return F.struct(
            F.concat(F.lit("IDX25JAN24"), (k + 100).cast("string"), F.lit(side if side == "CE" else "PE")).alias("symbol"),
            F.lit(side).alias("side"), F.when(k % 17 == 0, -1.0).otherwise(F.col("value") + 1).alias("ltp"),
            F.when(k % 7 == 3, 0).otherwise(e + 1).alias("oi"), (e + 5).alias("volume"),
            F.lit(9.0).alias("bid"), F.when(k % 19 == 4, 8.0).otherwise(10.0).alias("ask"),
        )

    legs = F.when(k % 23 == 5, F.array(leg("PE"), leg("CE"))).otherwise(F.array(leg("CE"), leg("PE")))
    doc = F.struct(
        F.lit(2).alias("version"), F.lit("RAW").alias("kind"), iso(base).alias("scheduled_at"), iso(started).alias("started_at"),
        iso(received).alias("received_at"),
        F.struct(
            F.lit("IDX").alias("symbol"), (F.col("value") + 100).alias("spot_ltp"),
            F.when(k % 29 == 6, "11JAN24").otherwise("25JAN24").alias("expiry"), (k + 100).alias("strike"), legs.alias("options"),
            F.lit("UNVERIFIED_PROVIDER_TIME").alias("freshness"), F.array(F.lit("ZERO_OI")).alias("issues"),
        ).alias("body"),
    )
    return events(spark, sf_dir).select("event_id", F.to_json(doc).alias("payload"))


@query(
    "raw_contract",
    f"""WITH {EVENTS_SQL}
SELECT event_id, CASE WHEN k % 13 = 0 THEN 'InvertedTimestamps' WHEN k % 11 = 0 THEN 'LateOrOffSessionResponse'
  WHEN k % 29 = 6 THEN 'ExpiredContract' WHEN k % 23 = 5 THEN 'InvalidPair' WHEN k % 17 = 0 THEN 'InvalidNumber'
  WHEN k % 7 = 3 THEN 'AmbiguousZero' WHEN k % 19 = 4 THEN 'CrossedQuote' END AS reason FROM ev""",
)
def raw_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7, Q8 form: RAW envelopes against their contract, first reason each."""
    docs = P.read_envelopes(_envelopes(spark, sf_dir), "payload")
    return docs.select("event_id", Q.first_failure(P.raw_contract("IDX")).alias("reason"))


# Enrichment -----------------------------------------------------------------------


def _linked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tape rows with zero, one or two stored calculations as JSON evidence."""
    tape = option_tape(spark, sf_dir)
    k = F.round((F.abs("delta") - 0.3) * 400).cast("bigint")
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    rows = tape.select(
        "observation_id", "timestamps", "underlying", "trading_date", "source_version", "spot", "optiontype", "delta", "gamma",
        "theta", "vega", k.alias("k"), F.lit(None).cast("double").alias("iv"), F.lit(None).cast("string").alias("symbol"),
        (100 + k % 4).cast("double").alias("strike"), F.date_add("trading_date", 7).alias("expiry_day"), F.col("bid").alias("ltp"),
        F.sha2(F.concat(F.lit("raw"), "observation_id"), 256).alias("source_receipt_id"), F.col("timestamps").alias("scheduled_at"),
    )
    available = F.when(k % 23 == 4, F.col("timestamps") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("timestamps") + F.expr("INTERVAL 2 SECONDS"))
    symbol = F.concat_ws("-", "underlying", F.col("strike").cast("int").cast("string"), "optiontype")
    receipt = F.struct(
        F.lit("DERIVED").alias("kind"),
        F.when(k % 19 == 6, "wrong").otherwise(F.col("source_receipt_id")).alias("parent_observation_id"),
        F.sha2(F.concat(F.lit("calc"), "observation_id"), 256).alias("observation_id"), symbol.alias("symbol"),
        F.date_format(available, stamp).alias("received_at"), F.date_format("timestamps", stamp).alias("request_started_at"),
        F.date_format("scheduled_at", stamp).alias("scheduled_at"), F.lit("CALCULATION_RECEIPT").alias("timestamp_basis"),
        F.lit("DERIVED_UNVERIFIED_INPUT_TIME").alias("freshness"),
    )
    calc = F.struct(
        F.date_format("timestamps", stamp).alias("timestamp"), "underlying", symbol.alias("option_symbol"),
        F.when(k % 29 == 3, F.lit(1.0)).otherwise(F.col("strike")).alias("strike"), F.col("optiontype").alias("option_type"),
        F.col("expiry_day").cast("string").alias("expiry_day"), F.col("trading_date").cast("string").alias("trading_date"),
        F.col("source_version").alias("version"), F.lit("PARTIAL").alias("data_status"),
        F.when(k % 31 == 8, "OTHER").otherwise("BLACK76").alias("calculation_method"), F.date_format(available, stamp).alias("ingestion_time"),
        F.when(k % 13 == 2, F.lit(0.5)).otherwise(F.col("ltp")).alias("option_ltp"),
        F.when(k % 5 != 1, (k + 10) * 1.0).alias("implied_volatility"), "delta", F.when(k % 17 == 3, -1.0).otherwise(F.col("gamma")).alias("gamma"),
        "theta", "vega", F.lit(0.0).alias("interest_rate"), F.array_repeat(receipt, F.when(k % 37 == 9, 2).otherwise(1)).alias("derived_receipts"),
    )
    copies = F.when(k % 7 == 5, 0).when(k % 41 == 10, 2).otherwise(1)
    evidence = F.to_json(F.array_repeat(calc, copies))
    return rows.withColumn("evidence", evidence)


@query(
    "enrich_linked",
    f"""WITH {TAPE_SQL},
r AS (SELECT *, CASE WHEN k % 7 = 5 THEN 'none' WHEN k % 41 = 10 THEN 'many' ELSE 'one' END AS n,
  CASE WHEN k % 29 = 3 THEN 'derived_contract_mismatch' WHEN k % 31 = 8 THEN 'unsupported_stored_model'
       WHEN k % 23 = 4 THEN 'invalid_derived_availability' WHEN source_version = '2' AND k % 37 = 9 THEN 'missing_or_ambiguous_derived_receipt'
       WHEN source_version = '2' AND k % 19 = 6 THEN 'derived_receipt_provenance_mismatch'
       WHEN bid IS NOT NULL AND k % 13 = 2 THEN 'derived_raw_option_price_mismatch'
       WHEN bid IS NULL AND k % 13 = 2 THEN 'derived_raw_option_price_mismatch' END AS why FROM tape)
SELECT observation_id, CASE n WHEN 'none' THEN 'missing_stored_derived' WHEN 'many' THEN 'ambiguous_stored_derived' ELSE
    CASE WHEN why IS NOT NULL THEN 'invalid_stored_derived' WHEN k % 5 <> 1 AND k % 17 <> 3 THEN 'stored_derived' ELSE 'stored_partial' END END AS status,
  CASE n WHEN 'none' THEN 'missing_stored_derived' WHEN 'many' THEN 'ambiguous_stored_derived' ELSE coalesce(why,
    CASE WHEN k % 5 <> 1 AND k % 17 <> 3 THEN 'stored_derived' ELSE 'stored_partial' END) END AS reason,
  CASE WHEN n = 'one' AND why IS NULL AND k % 5 <> 1 THEN round((k + 10) / 100.0::DOUBLE, 9) END AS iv,
  CASE WHEN n = 'one' AND why IS NULL AND k % 17 = 3 THEN 'invalid_gamma' END AS issues,
  CASE WHEN n = 'one' AND why IS NULL THEN 2000.0::DOUBLE END AS lag_ms,
  CASE WHEN n = 'one' AND why IS NULL THEN 'UNVERIFIED_INPUT_TIME;ZERO_INTEREST_RATE_ASSUMPTION;UNDERLYING_BASIS_UNVERIFIED'
    || CASE WHEN source_version = '1' THEN ';LEGACY_RECEIPT_UNAVAILABLE' ELSE '' END END AS flags
FROM r""",
)
def enrich_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, reason, values and flags of linked calculations."""
    out = N.enrich(N.candidates_from_json(_linked_rows(spark, sf_dir), "evidence"))
    return out.select(
        "observation_id", F.col("derivation_status").alias("status"), F.col("derivation_reason").alias("reason"),
        F.round("iv", 9).alias("iv"), F.col("enrichment_issues").alias("issues"), F.col("calculation_lag_ms").alias("lag_ms"),
        F.col("model_risk_flags").alias("flags"),
    )


@query(
    "feature_completeness",
    f"""WITH {TAPE_SQL}
SELECT count(*) AS rows, count(iv) AS has_iv, count(bid) AS has_bid, count(oi) AS has_oi, count(iv) AS complete_rows,
  count(*) - count(iv) AS incomplete_rows, 'PARTIAL' AS coverage FROM tape""",
)
def feature_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-null counts, complete rows and coverage."""
    return N.completeness_report(option_tape(spark, sf_dir), ["iv", "bid", "oi"])


# Explorer -------------------------------------------------------------------------


@query(
    "explorer_filter",
    """SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND (contains(lower(text), 'license') OR contains(lower(source), 'license')
  OR contains(CAST(doc_id AS VARCHAR), 'license'))""",
)
def explorer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality plus a substring over every column's whole text."""
    docs = table(spark, sf_dir, "documents")
    return E.filter_rows(docs, {"lang": "en"}, "LICENSE").select("doc_id", "lang", "source")


@query(
    "explorer_page",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 50",
)
def explorer_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page in a stable order."""
    rows = E.filter_rows(table(spark, sf_dir, "orders"), {"o_orderstatus": "F"})
    return E.page(rows, ["o_orderdate", "o_orderkey"], 50, 25).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "explorer_preview",
    "SELECT p_partkey, p_name, (SELECT count(*) FROM part) AS total FROM part ORDER BY p_partkey LIMIT 10",
)
def explorer_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: first rows of chosen columns and the total."""
    rows, total = E.preview(table(spark, sf_dir, "part"), ["p_partkey", "p_name"], ["p_partkey"], 10)
    return rows.withColumn("total", total)


@query(
    "chart_decimation",
    f"""WITH {EVENTS_SQL},
s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY t_us) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n,
  sum(CASE WHEN gap > 5400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY t_us) AS segment
  FROM (SELECT *, t_us - lag(t_us) OVER (PARTITION BY event_type ORDER BY t_us) AS gap FROM ev))
SELECT event_id, segment::BIGINT AS segment FROM s WHERE n <= 800 OR i IN (SELECT round_even(j * (s.n - 1) / 799.0::DOUBLE, 0) FROM range(0, 800) r(j))""",
)
def chart_decimation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """800 evenly spaced points per series, segments numbered before."""
    ev = events(spark, sf_dir)
    seg = G.with_segments(ev, by=["event_type"], time="ts", tie="event_id", max_gap=5400, block_seconds=86_400)
    out = E.decimate(seg.select("event_id", "event_type", "ts", "segment"), by=["event_type"], time="ts", block_seconds=86_400)
    return out.select("event_id", "segment")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
FROM orders WHERE o_orderstatus = 'O') WHERE rn = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest valid row of each key."""
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    return E.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "status_counts",
    """SELECT 'lang' AS "column", coalesce(lang, 'MISSING') AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL SELECT 'source', coalesce(source, 'MISSING'), count(*) FROM documents GROUP BY 2""",
)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts with MISSING."""
    return E.value_counts(table(spark, sf_dir, "documents"), ["lang", "source"])


@query(
    "issue_counts",
    f"""WITH {EVENTS_SQL}
SELECT issue, count(*) AS n FROM (SELECT unnest(string_split(concat_ws(';', CASE WHEN k % 2 = 0 THEN 'even' END, CASE WHEN k % 3 = 0 THEN 'third' END), ';')) AS issue FROM ev
  UNION ALL SELECT unnest(string_split(concat_ws(',', event_type, CASE WHEN k > 50 THEN 'high' END), ',')) FROM ev) WHERE issue <> '' GROUP BY issue""",
)
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of separated issue lists."""
    k = F.col("k")
    rows = events(spark, sf_dir).select(
        F.concat_ws(";", F.when(k % 2 == 0, "even"), F.when(k % 3 == 0, "third")).alias("a"),
        F.concat_ws(",", "event_type", F.when(k > 50, "high")).alias("b"),
    )
    return E.issue_counts(rows, {"a": ";", "b": ","})


@query(
    "version_eligibility",
    f"WITH {TAPE_SQL} SELECT coalesce(source_version, 'MISSING') AS version, count(*) AS n FROM tape WHERE source_version <> '2' GROUP BY 1",
)
def version_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of excluded source versions."""
    return E.eligible_version(option_tape(spark, sf_dir), "source_version", "2")[1]


@query(
    "target_exclusion",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1",
)
def target_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the instruments left out."""
    return E.target_only(table(spark, sf_dir, "events"), "event_type", "click")[1]


@query(
    "target_events",
    OUTCOME_SQL + "\nSELECT underlying, anchor_us, label FROM outcomes WHERE label IN ('UP_MOMENTUM', 'DOWN_MOMENTUM')",
)
def target_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples whose label is a target event."""
    out = E.target_events(sample_outcomes(spark, sf_dir), ("UP_MOMENTUM", "DOWN_MOMENTUM"))
    return out.select("underlying", "anchor_us", "label")


@query(
    "total_order",
    f"WITH {TAPE_SQL} SELECT observation_id, t_us, underlying, optiontype FROM tape ORDER BY t_us, underlying, optiontype",
)
def total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: one total order by time, symbol and side."""
    tape = option_tape(spark, sf_dir).orderBy("timestamps", "underlying", "optiontype")
    return tape.select("observation_id", F.unix_micros("timestamps").alias("t_us"), "underlying", "optiontype")


@query(
    "day_summary",
    f"""WITH {TAPE_SQL}
SELECT CAST(trading_date AS VARCHAR) AS day, count(*) AS rows, min(t_us) AS first_us, max(t_us) AS last_us,
  count(*) FILTER (WHERE bid IS NULL) AS null_bid, count(*) FILTER (WHERE iv IS NULL) AS null_iv FROM tape GROUP BY tape.trading_date""",
)
def day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, times and missing values per day."""
    return option_tape(spark, sf_dir).groupBy(F.col("trading_date").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.unix_micros("timestamps")).alias("first_us"),
        F.max(F.unix_micros("timestamps")).alias("last_us"),
        F.count_if(F.col("bid").isNull()).alias("null_bid"),
        F.count_if(F.col("iv").isNull()).alias("null_iv"),
    )


@query(
    "receipt_prices",
    f"""WITH {TAPE_SQL}
SELECT underlying, t_us, min(spot) AS spot, string_agg(observation_id, ',' ORDER BY observation_id) AS ids FROM tape GROUP BY underlying, t_us""",
)
def receipt_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price and the sorted ids per receipt."""
    from tickevidence.operators.sampling import receipts

    out = receipts(option_tape(spark, sf_dir)).filter(~F.col("conflict"))
    return out.select("underlying", F.unix_micros("timestamps").alias("t_us"), "spot", F.array_join("observation_ids", ",").alias("ids"))


# Files ----------------------------------------------------------------------------


@query("artifact_digests")
def artifact_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes and sizes of the table files, hashed in tasks."""
    configure(spark)
    return S.file_digests(spark, sf_dir, "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("file"), "sha256", "size_bytes")


@query(
    "replay_split",
    """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 10 = 3 THEN 'conflict' ELSE 'new' END AS outcome FROM orders
WHERE o_orderkey % 10 = 3 OR o_orderkey % 10 >= 5""",
)
def replay_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replays are dropped, new rows appended, changed rows conflict."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.sha2(F.col("o_totalprice").cast("string"), 256).alias("digest"))
    stored = rows.filter("key % 10 < 5")
    batch = rows.withColumn("digest", F.when(F.col("key") % 10 == 3, F.sha2("digest", 256)).otherwise(F.col("digest")))
    fresh, bad = S.split_replays(batch, stored, "key", "digest")
    return fresh.select("key", F.lit("new").alias("outcome")).unionByName(bad.select("key", F.lit("conflict").alias("outcome")))


@query(
    "bulk_append_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def bulk_append_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: keys that would make a bulk append fail."""
    return S.require_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "current_revisions",
    """WITH p AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey AS rev, CASE WHEN o_orderstatus = 'P' THEN 'NO_DATA'
  WHEN o_orderkey % 3 = 0 THEN 'PUBLISHED' WHEN o_orderkey % 3 = 1 THEN 'RETRY_PENDING' ELSE 'LOCAL_PASS' END AS status FROM orders),
n AS (SELECT d, max(rev) AS rev, arg_max(status, rev) AS status FROM p GROUP BY d)
SELECT CAST(d AS VARCHAR) AS trading_date, rev AS revision FROM n WHERE status <> 'NO_DATA' AND date_part('day', d) <> 1""",
)
def current_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest revision of each open day."""
    day = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").select(
        day.alias("trading_date"), F.col("o_orderkey").alias("revision"), F.col("o_orderkey").alias("finished_at"),
        F.when(F.col("o_orderstatus") == "P", "NO_DATA").otherwise(
            F.element_at(F.array(*map(F.lit, S.CURRENT)), (F.col("o_orderkey") % 3 + 1).cast("int"))
        ).alias("status"),
    )
    closed = rows.filter(F.dayofmonth("trading_date") == 1)
    good, _ = S.current_revisions(rows, closed)
    return good.select(F.col("trading_date").cast("string").alias("trading_date"), "revision")


@query(
    "ids_across_sessions",
    """SELECT l_orderkey, min(d) AS first_session, max(d) AS last_session FROM (SELECT l_orderkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS d FROM lineitem)
GROUP BY 1 HAVING min(d) <> max(d)""",
)
def ids_across_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids repeated in several sessions."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"))
    return S.repeated_ids(rows, "l_orderkey", "d")


# Streams --------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    schema = table(spark, sf_dir, "events").schema
    raw = I.read_landed(spark, sf_dir, schema, "events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    )


@query(
    "stream_slot_counts",
    f"WITH {EVENTS_SQL} SELECT event_type, (t_us // 3600000000) * 3600000000 AS slot_us, count(*) AS rows FROM ev GROUP BY ALL",
)
def stream_slot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (key, slot) under a stream."""
    counts = I.slot_counts(_stream(spark, sf_dir), by=["event_type"], time="ts", seconds=3600, watermark="1 hour")
    done = I.drain(counts, "slot-counts", mode="update")
    newest = E.latest_per_key(done, ["event_type", "slot"], ["_batch"])
    return newest.select("event_type", F.unix_micros("slot").alias("slot_us"), "rows")


@query(
    "stream_lateness",
    f"""WITH {EVENTS_SQL} SELECT event_id, CASE WHEN k % 8 >= 5 THEN 'late_response'
  WHEN NOT (date_part('hour', l) * 60 + date_part('minute', l) >= 555 AND date_part('hour', l) * 60 + date_part('minute', l) < 930
            AND date_part('isodow', l) < 6) THEN 'off_session' END AS reason
FROM (SELECT *, make_timestamp(t_us) + INTERVAL 330 MINUTE AS l FROM ev)""",
)
def stream_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late and off-session rows get a reason in the stream."""
    rows = _stream(spark, sf_dir).withColumn("scheduled", F.timestamp_micros(F.unix_micros("ts") - (F.col("k") % 8) * 1_000_000))
    judged = I.with_lateness(rows, scheduled="scheduled", received="ts", limit_seconds=5)
    return I.drain(judged.select("event_id", "reason"), "lateness")


@query(
    "stream_deduplicated",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key and digest, however often it is replayed."""
    rows = I.without_replays(_stream(spark, sf_dir), key="user_id", digest="event_type", time="ts", horizon="60 days")
    return I.drain(rows.select("user_id", "event_type"), "deduplicated")


@query(
    "stream_conflicts",
    f"""WITH {EVENTS_SQL},
f AS (SELECT user_id, event_type AS digest, min(t_us // 1000) AS seen FROM ev GROUP BY ALL),
g AS (SELECT *, first_value(digest) OVER (PARTITION BY user_id ORDER BY seen, digest) AS first_digest FROM f)
SELECT CAST(user_id AS VARCHAR) AS key, first_digest, digest FROM g WHERE digest <> first_digest""",
)
def stream_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: a key seen again with another digest."""
    out = I.conflicts(_stream(spark, sf_dir), key="user_id", digest="event_type", time="ts", watermark="60 days", keep_seconds=86_400)
    return I.drain(out, "conflicts")


@query(
    "stream_linked",
    f"""WITH {EVENTS_SQL}
SELECT r.event_id AS raw_id, d.event_id AS derived_id FROM ev r JOIN ev d ON r.user_id = d.user_id
WHERE r.event_type = 'view' AND d.event_type = 'click' AND d.t_us >= r.t_us AND d.t_us <= r.t_us + 3600000000""",
)
def stream_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived rows linked to a RAW parent received shortly before."""
    raw = _stream(spark, sf_dir).filter("event_type = 'view'").select(
        F.col("event_id").alias("raw_id"), F.col("user_id").alias("raw_key"), F.col("ts").alias("raw_at")
    )
    derived = _stream(spark, sf_dir).filter("event_type = 'click'").select(
        F.col("event_id").alias("derived_id"), F.col("user_id").alias("parent"), F.col("ts").alias("derived_at")
    )
    out = link_to_parent(
        derived, raw, parent="parent", key="raw_key", derived_time="derived_at", raw_time="raw_at", within="1 HOUR", watermark="60 days"
    )
    return I.drain(out.select("raw_id", "derived_id", "reason"), "linked").filter("reason IS NULL").drop("reason")


@query(
    "stream_append_once",
    f"WITH {EVENTS_SQL} SELECT event_id, CAST(d AS VARCHAR) AS day FROM ev",
)
def stream_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the same files processed twice are stored once."""
    root = scratch_path(spark, "append")
    key = F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"))
    for name in ("first", "again"):
        rows = _stream(spark, sf_dir).select("event_id", key.alias("key"), F.sha2("props", 256).alias("digest"))
        place = F.substring("key", 1, 10)
        I.drain(rows, "append-once", each_batch=ledger_batches(root, name, key="key", digest="digest", place=place))
    rows = stored(spark, root, "event_id bigint, key string, digest string")
    return rows.select("event_id", F.substring("key", 1, 10).alias("day"))
