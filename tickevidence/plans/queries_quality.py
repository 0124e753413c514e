"""Registered queries: cleaning, quarantine, rules, contracts, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators import cleaning as L
from tickevidence.operators import quality as Q
from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, TAPE_SQL, events, option_tape, table

POLICY = L.CleaningPolicy(input_zone="UTC", iv_unit="percent", expiry_zone="UTC", max_quarantine_fraction=0.9)


def quote_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text quote rows with planted faults, exact copies and key conflicts."""
    ev = events(spark, sf_dir)
    k, e = F.col("k"), F.col("event_id")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    base = ev.select(
        (e * 10).alias("source_row"),
        F.when(k % 17 == 3, "not-a-time").when(k % 17 == 4, "1700000000").otherwise(F.concat(text, F.lit("Z"))).alias("timestamps"),
        F.when(k % 19 == 5, "0.00").when(k % 19 == 6, "abc").otherwise(F.concat((k + 100).cast("string"), F.lit(".50"))).alias("strike"),
        F.element_at(F.array(*[F.lit(x) for x in ("CE", "call", "p", "PUT", "X")]), (e % 5 + 1).cast("int")).alias("optiontype"),
        F.when(k % 7 == 0, "2024-06-27").when(k % 7 == 1, "27JUN24").when(k % 7 == 2, "27-Jun-2024").when(k % 7 == 3, "2023-01-01").otherwise("27jun24").alias("expirydate"),
        F.when(k % 23 == 1, "").when(k % 23 == 2, "-4").when(k % 23 == 3, "NaN").otherwise((e * 2 + 5).cast("string")).alias("spot"),
        F.when(k % 3 == 0, "").otherwise(F.concat((k + 5).cast("string"), F.lit(".25"))).alias("iv"),
        F.when(k % 29 == 2, "12.5").when(k % 29 == 4, "99999999999999999999").otherwise((e * 3).cast("string")).alias("volume"),
        F.lit("9007199254740993").alias("oi"),
        F.lit("1.5e1").alias("ltp"),
        F.col("event_type").alias("underlying"),
    )
    copies = base.filter(F.col("source_row") % 370 == 0).withColumn("source_row", F.col("source_row") + 1)
    rival = base.filter(F.col("source_row") % 410 == 0).select(
        (F.col("source_row") + 2).alias("source_row"), *[c for c in base.columns if c not in ("source_row", "ltp")], F.lit("16").alias("ltp")
    )
    return base.unionByName(copies).unionByName(rival)


_TEXT_SQL = f"""{EVENTS_SQL},
base AS (SELECT event_id * 10 AS source_row, k, event_id, event_type, '1.5e1' AS ltp FROM ev),
rows AS (SELECT * FROM base
  UNION ALL SELECT source_row + 1, k, event_id, event_type, ltp FROM base WHERE source_row % 370 = 0
  UNION ALL SELECT source_row + 2, k, event_id, event_type, '16' FROM base WHERE source_row % 410 = 0),
firsts AS (SELECT min(source_row) AS source_row, k, event_id, event_type, ltp, count(*) AS copies FROM rows GROUP BY k, event_id, event_type, ltp),
judged AS (SELECT *,
  CASE WHEN k % 17 = 3 THEN 'timestamps: expected an unambiguous ISO-8601 timestamp'
       WHEN k % 17 = 4 THEN 'timestamps: numeric timestamps require timestamp_unit'
       WHEN k % 7 = 3 THEN 'expirydate: expiry precedes observation timestamp'
       WHEN event_id % 5 = 4 THEN 'optiontype: expected CE/CALL/C or PE/PUT/P'
       WHEN k % 19 = 5 THEN 'strike: must be positive' WHEN k % 19 = 6 THEN 'strike: invalid numeric value' END AS identity_reason,
  CASE WHEN k % 23 = 1 THEN 'spot: required value is missing' WHEN k % 23 = 2 THEN 'spot: must be positive'
       WHEN k % 23 = 3 THEN 'spot: nonfinite value'
       WHEN k % 29 IN (2, 4) THEN 'volume: must be an integer within signed 64-bit range' END AS value_reason
  FROM firsts),
final AS (SELECT *, coalesce(identity_reason, value_reason,
    CASE WHEN identity_reason IS NULL AND count(*) OVER (PARTITION BY event_id, identity_reason IS NULL) > 1
         THEN 'conflicting_or_repeated_natural_key: all matching rows quarantined' END) AS reason FROM judged)"""


def _cleaned(spark: SparkSession, sf_dir: str) -> L.Cleaned:
    raw = quote_texts(spark, sf_dir)
    keep = [c for c in raw.columns if c != "source_row"]
    mapping = L.header_mapping(keep)
    return L.clean(L.rename(raw, mapping), POLICY)


@query("clean_quarantine", f"WITH {_TEXT_SQL} SELECT source_row, reason FROM final WHERE reason IS NOT NULL")
def clean_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarantined row with its first reason."""
    return _cleaned(spark, sf_dir).quarantine.select("source_row", "reason")


@query(
    "clean_accepted",
    f"""WITH {_TEXT_SQL}
SELECT source_row, (k + 100) + 0.5::DOUBLE AS strike, CASE WHEN event_id % 5 IN (0, 1) THEN 'CE' ELSE 'PE' END AS optiontype,
  (event_id * 2 + 5)::DOUBLE AS spot, CASE WHEN k % 3 <> 0 THEN round((k + 5.25::DOUBLE) / 100.0::DOUBLE, 9) END AS iv,
  event_id * 3 AS volume, 9007199254740993 AS oi, CASE WHEN ltp = '16' THEN 16.0::DOUBLE ELSE 15.0::DOUBLE END AS ltp,
  epoch_us(TIMESTAMP '2024-06-27 15:30:00') AS expiry_us, 'unspecified' AS data_status
FROM final WHERE reason IS NULL""",
)
def clean_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows that passed."""
    out = _cleaned(spark, sf_dir).accepted
    return out.select(
        "source_row", "strike", "optiontype", "spot", F.round("iv", 9).alias("iv"), "volume", "oi", "ltp",
        F.unix_micros("expirydate").alias("expiry_us"), "data_status",
    )


@query(
    "clean_counts",
    f"""WITH {_TEXT_SQL}
SELECT sum(copies)::BIGINT AS input_rows, count(*) FILTER (WHERE reason IS NULL) AS accepted,
  count(*) FILTER (WHERE reason IS NOT NULL) AS quarantined, sum(copies - 1)::BIGINT AS duplicates_removed,
  TRUE AS reconciled, round(count(*) FILTER (WHERE reason IS NOT NULL) / sum(copies)::DOUBLE, 9) AS quarantine_fraction, TRUE AS passed
FROM final""",
)
def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts reconcile and the run gate decides."""
    out = _cleaned(spark, sf_dir).counts
    return out.withColumn("quarantine_fraction", F.round("quarantine_fraction", 9))


@query(
    "exact_duplicates",
    """SELECT role, text, min(conv_id * 1000 + turn) AS source_row, count(*) AS copies FROM conversations GROUP BY role, text""",
)
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies keep their first row; whole texts are compared."""
    conv = table(spark, sf_dir, "conversations").select(
        "role", "text", (F.col("conv_id") * 1000 + F.col("turn")).alias("source_row")
    )
    return L.deduplicate(conv, content=["role", "text"], order="source_row")


@query(
    "key_conflicts",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_count
FROM lineitem""",
)
def key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: how many rows share each natural key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return L.with_key_count(li, ["l_orderkey", "l_linenumber"], "l_partkey")


@query(
    "stable_ids",
    """SELECT o_orderkey, sha256('{"custkey":' || '"' || o_custkey || '"' || ',"day":"' || strftime(o_orderdate, '%Y-%m-%d')
  || '","note":null,"status":"' || o_orderstatus || '"}') AS id FROM orders""",
)
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from canonical content, NULLs kept."""
    fields = {
        "status": F.col("o_orderstatus"),
        "custkey": F.col("o_custkey"),
        "day": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "note": F.lit(None),
    }
    return table(spark, sf_dir, "orders").select("o_orderkey", L.stable_id(fields).alias("id"))


@query(
    "profile",
    """SELECT a.rows, a.rows - b.d AS duplicate_rows, c.* FROM (SELECT count(*) AS rows FROM labels) a,
 (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM labels)) b,
 (SELECT 'doc_id' AS "column", 'bigint' AS type, count(*) - count(doc_id) AS nulls FROM labels
  UNION ALL SELECT 'quality', 'int', count(*) - count(quality) FROM labels
  UNION ALL SELECT 'toxic', 'int', count(*) - count(toxic) FROM labels) c""",
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: rows, exact copies, types and nulls."""
    return L.profile(table(spark, sf_dir, "labels"))


@query(
    "rule_violations",
    """SELECT unnest(['quantity_over_40', 'discount_above_7pct', 'price_missing', 'returned_open']) AS rule,
  unnest([count(*) FILTER (WHERE l_quantity > 40), count(*) FILTER (WHERE l_discount > 0.07),
          count(*) FILTER (WHERE l_extendedprice IS NULL), count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O')]) AS violations
FROM lineitem""",
)
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: a rule table evaluated in one aggregation."""
    c = F.col
    return Q.rule_violations(
        table(spark, sf_dir, "lineitem"),
        [
            Q.Rule("quantity_over_40", c("l_quantity") > 40),
            Q.Rule("discount_above_7pct", c("l_discount") > 0.07),
            Q.Rule("price_missing", c("l_extendedprice").isNull()),
            Q.Rule("returned_open", (c("l_returnflag") == "R") & (c("l_linestatus") == "O")),
        ],
    )


@query("validate_cleaned_pair")
def validate_cleaned_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: every rule of the cleaned pair on the tables the cleaner wrote (all zero)."""
    done = _cleaned(spark, sf_dir)
    return Q.validate_pair(done.observations, done.options)


@query(
    "pair_faults",
    f"""WITH {_TEXT_SQL},
n AS (SELECT event_id % 8 AS fault, count(*) AS n FROM final WHERE reason IS NULL GROUP BY 1)
SELECT rule, CAST(sum(n) AS BIGINT) AS violations FROM n JOIN (VALUES (1, 'tables: mismatched underlying for observation_id'),
  (2, 'tables: observation_id foreign keys must match one-to-one'), (3, 'tables: observation_id foreign keys must match one-to-one'),
  (3, 'options: duplicate observation_id'), (3, 'options: repeated natural key'), (4, 'options.optiontype: expected CE or PE')) r(fault, rule) USING (fault) GROUP BY rule""",
)
def pair_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: the broken rules of a pair with planted faults, all others hold."""
    done = _cleaned(spark, sf_dir)
    names = L.names_of(L.OPTION_SCHEMA)
    fault = F.expr("(source_row div 10) % 8")
    options = done.accepted.withColumn("_fault", fault).filter("_fault <> 2")
    options = options.withColumn("underlying", F.when(F.col("_fault") == 1, "other").otherwise(F.col("underlying")))
    options = options.withColumn("optiontype", F.when(F.col("_fault") == 4, "XX").otherwise(F.col("optiontype")))
    options = options.unionByName(options.filter("_fault = 3")).select(*names)
    return Q.validate_pair(done.observations, options).filter("violations > 0")


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    k, v, e = F.col("k"), F.col("value"), F.col("event_id")
    return ev.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.to_date("ts").alias("trading_date"),
        F.when(k % 31 != 0, F.col("event_type")).alias("symbol"),
        (20000 + v * 25).alias("spot_ltp"),
        F.when(k % 4 != 1, 4 + k / 2.5).alias("vix"),
        F.when(k % 5 != 4, 25000 + (k % 6) * 25.0).alias("atm_strike"),
        F.to_date("ts").alias("expiry_date"),
        F.lit(3).alias("days_to_expiry"),
        F.lit(None).cast("double").alias("spot_bid"),
        F.lit(None).cast("double").alias("spot_ask"),
        *[
            col.alias(f"atm_{s}_{n}")
            for s, m in (("ce", 7), ("pe", 11))
            for n, col in (
                ("ltp", F.when(k % m != 1, v - 1)),
                ("bid", v * 0.9 - 0.5),
                ("ask", v * 0.9 + (k % m) * 0.4 - 1.0),
                ("oi", F.when(k % m != 2, (e % 50 - 1).cast("double"))),
                ("iv", F.when(k % m != 3, k * 1.02)),
                ("delta", k * 10.2),
                ("gamma", F.lit(0.1)),
                ("theta", F.lit(None).cast("double")),
                ("vega", F.lit(1.0)),
            )
        ],
    )


def _snap_side(s: str, m: int) -> str:
    return f"""CASE WHEN k % {m} <> 1 THEN value - 1 END AS {s}_ltp, value * 0.9::DOUBLE - 0.5::DOUBLE AS {s}_bid,
  value * 0.9::DOUBLE + (k % {m}) * 0.4::DOUBLE - 1.0::DOUBLE AS {s}_ask, CASE WHEN k % {m} <> 2 THEN event_id % 50 - 1 END AS {s}_oi,
  CASE WHEN k % {m} <> 3 THEN k * 1.02::DOUBLE END AS {s}_iv, k * 10.2::DOUBLE AS {s}_delta"""


def _count_true(*tests: str) -> str:
    return " + ".join(f"CASE WHEN {t} THEN 1 ELSE 0 END" for t in tests)


_SIDE_ERR = [f"{s}_{f} < 0" for s in ("ce", "pe") for f in ("ltp", "bid", "ask")]
_SPREAD = " OR ".join(
    f"coalesce({s}_bid <> 0 AND {s}_ask <> 0 AND {s}_ltp > 0 AND ({s}_ask - {s}_bid) / {s}_ltp * 100 > 10, FALSE)" for s in ("ce", "pe")
)
_WARN = (
    ["NOT vix BETWEEN 5 AND 40", "atm % 50 <> 0"]
    + [f"{s}_bid > {s}_ask" for s in ("ce", "pe")]
    + [f"{s}_oi < 0" for s in ("ce", "pe")]
    + [f"NOT {s}_iv BETWEEN 0 AND 100" for s in ("ce", "pe")]
    + [f"abs({s}_delta) >= 1000" for s in ("ce", "pe")]
    + [_SPREAD]
)
_CORE = ["vix", "atm"] + [f"{s}_{f}" for s in ("ce", "pe") for f in ("ltp", "oi", "iv")]


@query(
    "snapshot_status",
    f"""WITH {EVENTS_SQL},
s AS (SELECT event_id, CASE WHEN k % 31 <> 0 THEN event_type END AS symbol, 20000 + value * 25 AS spot,
  CASE WHEN k % 4 <> 1 THEN 4 + k / 2.5::DOUBLE END AS vix, CASE WHEN k % 5 <> 4 THEN 25000 + (k % 6) * 25.0::DOUBLE END AS atm,
  {_snap_side("ce", 7)}, {_snap_side("pe", 11)} FROM ev),
c AS (SELECT event_id, {_count_true("symbol IS NULL", "atm IS NULL", "NOT spot BETWEEN 20000 AND 30000", *_SIDE_ERR)} AS errors,
  {_count_true(*_WARN)} AS warns, {_count_true(*[f"{x} IS NULL" for x in _CORE])} AS missing FROM s)
SELECT event_id, errors + warns AS failed_fields, CASE WHEN errors > 0 THEN 'REJECTED'
  WHEN warns > 0 AND missing > 4.5 THEN 'PARTIAL' ELSE 'VALID' END AS data_status FROM c""",
)
def snapshot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: REJECTED, PARTIAL or VALID per snapshot."""
    out = Q.snapshot_status(_snapshots(spark, sf_dir), Q.snapshot_rules())
    return out.select("event_id", "data_status", F.col("failed_fields").cast("bigint").alias("failed_fields"))


@query(
    "receipt_constraints",
    f"""WITH {EVENTS_SQL}
SELECT event_id, CASE WHEN k % 13 = 0 THEN 'inverted_timestamps'
  WHEN k % 4 = 3 OR (k % 4 = 0 AND k % 5 = 0) OR (k % 4 = 1 AND k % 3 = 0) OR (k % 4 = 2 AND k % 7 = 1) THEN 'unknown_provenance_combination'
  WHEN k % 4 = 0 AND k % 9 >= 5 THEN 'late_raw_receipt' END AS reason FROM ev""",
)
def receipt_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock order, provenance combinations and lateness of receipts."""
    k = F.col("k")
    ts = F.unix_micros("ts")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("RAW", "DERIVED", "HISTORY", "OTHER")]), (k % 4 + 1).cast("int"))
    basis = F.element_at(
        F.array(*[F.lit(x) for x in ("APPLICATION_RECEIPT", "CALCULATION_RECEIPT", "CANDLE_START", "NONE")]), (k % 4 + 1).cast("int")
    )
    fresh = F.element_at(
        F.array(*[F.lit(x) for x in ("UNVERIFIED_PROVIDER_TIME", "DERIVED_UNVERIFIED_INPUT_TIME", "HISTORICAL_BACKFILL", "NONE")]),
        (k % 4 + 1).cast("int"),
    )
    parent = F.when(k % 4 == 0, F.when(k % 5 == 0, "x")).when(k % 4 == 1, F.when(k % 3 != 0, "x")).when(
        k % 4 == 2, F.when(k % 7 == 1, "x")
    )
    rows = events(spark, sf_dir).select(
        "event_id",
        kind.alias("kind"),
        basis.alias("timestamp_basis"),
        fresh.alias("freshness"),
        parent.alias("parent_observation_id"),
        F.timestamp_micros(ts + F.when(k % 13 == 0, 100_000_000).otherwise(0)).alias("scheduled_at"),
        F.col("ts").alias("request_started_at"),
        F.timestamp_micros(ts + (k % 9) * 1_000_000).alias("received_at"),
    )
    return rows.select("event_id", Q.first_failure(Q.receipt_rules()).alias("reason"))


@query(
    "append_constraints",
    f"""WITH {TAPE_SQL}
SELECT observation_id, CASE WHEN NOT (v = 2 AND st = 'PARTIAL') THEN 'version_gate' WHEN v >= 2 AND oi % 3 = 0 THEN 'price_not_finite_positive'
  WHEN oi % 7 = 0 THEN 'open_interest_not_exact' WHEN bid <= 0 THEN 'bid_not_positive' WHEN ask <= 0 THEN 'ask_not_positive'
  WHEN bid > ask - 0.2::DOUBLE THEN 'crossed_quote' END AS reason
FROM (SELECT *, CASE WHEN k % 20 = 19 THEN 1 ELSE 2 END AS v, CASE WHEN k % 8 = 0 THEN 'VALID' ELSE 'PARTIAL' END AS st FROM tape)""",
)
def append_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: integrity of newly appended rows."""
    tape = option_tape(spark, sf_dir)
    k = F.round((F.abs("delta") - 0.3) * 400).cast("bigint")
    rows = tape.select(
        "observation_id",
        F.col("source_version").cast("int").alias("version"),
        F.when(k % 8 == 0, "VALID").otherwise("PARTIAL").alias("data_status"),
        F.when(F.col("oi") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("spot")).alias("ltp"),
        F.when(F.col("oi") % 7 == 0, F.col("oi") + 0.5).otherwise(F.col("oi").cast("double")).alias("oi"),
        "bid",
        (F.col("ask") - 0.2).alias("ask0"),
        "ask",
    )
    rows = rows.withColumn("ask", F.when(F.col("ask") <= 0, F.col("ask")).otherwise(F.greatest("ask0", F.lit(1e-9))))
    return rows.select("observation_id", Q.first_failure(Q.append_rules()).alias("reason"))


@query(
    "research_gate",
    f"""WITH {TAPE_SQL},
t AS (SELECT * FROM tape)
SELECT unnest(['missing_identity', 'missing_timestamp', 'spot_not_finite_positive', 'trading_date_mismatch', 'iv_available_before_receipt',
  'greeks_available_before_receipt', 'unknown_side', 'missing_contract', 'repeated_observation_id', 'conflicting_spot', 'ambiguous_quote']) AS rule,
  unnest([0, 0, 0, (SELECT count(*) FROM t WHERE CAST(make_timestamp(t_us) + INTERVAL 330 MINUTE AS DATE) <> trading_date),
  0, 0, 0, 0, 0, 0, 0]) AS violations""",
)
def research_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13, Q14: the gate before sampling; UTC dates differ from local dates at night."""
    return Q.research_gate(option_tape(spark, sf_dir))


@query(
    "cycle_pairs",
    f"""WITH {TAPE_SQL}
SELECT underlying, t_us // 3600000000 AS hour, count(*) FILTER (WHERE optiontype = 'CE') AS ce_rows,
  count(*) FILTER (WHERE optiontype = 'PE') AS pe_rows, count(*) = 2 AS complete
FROM (SELECT * FROM tape WHERE oi % 5 <> 0) GROUP BY ALL HAVING TRUE""".replace(
        "count(*) = 2 AS complete",
        "count(*) = 2 AND count(*) FILTER (WHERE optiontype = 'CE') = 1 AND min(t_us) = max(t_us) AS complete",
    ),
)
def cycle_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture cycles with exactly one leg of each side."""
    rows = option_tape(spark, sf_dir).filter("oi % 5 <> 0").select(
        "underlying",
        "optiontype",
        "timestamps",
        F.element_at(F.split("contract_key", r"\|"), 2).alias("contract"),
        F.expr("unix_micros(timestamps) div 3600000000").alias("hour"),
    )
    out = Q.cycle_pairs(
        rows, by=["underlying", "hour"], side="optiontype", contract="contract", time="timestamps", ingested="timestamps"
    )
    return out.select("underlying", "hour", "ce_rows", "pe_rows", "complete")
