"""Registered queries: provenance joins, calendar, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.operators import joins as J
from tickevidence.plans.registry import query
from tickevidence.plans.tape import EVENTS_SQL, TAPE_SQL, events, option_tape, table
from tickevidence.sources import calendar as K


@query(
    "join_market_evidence",
    """SELECT o_orderkey, coalesce(n, 0) AS market_match_count, price, flag, CASE WHEN n = 1 THEN part END AS evidence_part
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_extendedprice) AS price, max(l_returnflag) AS flag,
                              max(l_partkey) AS part FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def join_market_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregated matches with single-match evidence."""
    right = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    out = J.match_evidence(
        table(spark, sf_dir, "orders"),
        right,
        ["o_orderkey"],
        name="market",
        maxima={"price": "l_extendedprice", "flag": "l_returnflag"},
        evidence=["l_partkey", "l_linenumber"],
    )
    return out.select(
        "o_orderkey", "market_match_count", "price", "flag", F.col("market_evidence.l_partkey").alias("evidence_part")
    )


@query(
    "join_ambiguous_evidence",
    """SELECT l_orderkey AS o_orderkey, l_partkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
  AND l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)""",
)
def join_ambiguous_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All evidence rows of ambiguous matches, as a table."""
    right = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    out = J.ambiguous_evidence(table(spark, sf_dir, "orders"), right, ["o_orderkey"])
    return out.select("o_orderkey", "l_partkey", "l_linenumber")


@query(
    "join_raw_receipt",
    """SELECT o_orderkey, coalesce(n, 0) AS receipt_match_count, CASE WHEN n = 1 THEN id END AS receipt_id
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_partkey) AS id FROM lineitem
                       WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def join_raw_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The receipt id only when exactly one RAW receipt matches."""
    raw = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    out = J.match_evidence(
        table(spark, sf_dir, "orders"), raw, ["o_orderkey"], name="receipt", evidence=["l_partkey"]
    )
    return out.select(
        "o_orderkey", "receipt_match_count", F.col("receipt_evidence.l_partkey").alias("receipt_id")
    )


@query(
    "join_nested_candidates",
    f"""WITH {EVENTS_SQL},
rec AS (SELECT user_id, k % 7 + 1 AS line, count(*) AS n, max(event_id) AS id FROM ev WHERE k % 3 = 0 GROUP BY 1, 2),
cand AS (SELECT o_orderkey, count(*) AS c, max(l_linenumber) AS line, max(l_partkey) AS part
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o.o_orderkey, coalesce(c.c, 0) AS candidate_count, CASE WHEN c.c = 1 THEN c.part END AS part,
       CASE WHEN c.c = 1 THEN coalesce(r.n, 0) END AS receipt_count, CASE WHEN c.c = 1 AND r.n = 1 THEN r.id END AS receipt_id
FROM orders o LEFT JOIN cand c ON c.o_orderkey = o.o_orderkey
LEFT JOIN rec r ON r.user_id = o.o_custkey % 150 AND r.line = c.line""",
)
def join_nested_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their own derived receipts."""
    out = J.nested_candidates(*_nested(spark, sf_dir), **_NESTED)
    return out.select(
        "o_orderkey",
        "candidate_count",
        F.col("candidate.l_partkey").alias("part"),
        F.col("candidate.receipt_count").alias("receipt_count"),
        F.col("candidate.receipt.event_id").alias("receipt_id"),
    )


_NESTED = {
    "on": ["o_orderkey"],
    "parent": "parent",
    "inner_on": {"l_linenumber": "line"},
    "evidence": ["l_partkey", "l_linenumber"],
    "inner_evidence": ["event_id"],
}


def _nested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, their line items as candidates, and events as receipts of a customer and line."""
    left = table(spark, sf_dir, "orders").withColumn("parent", F.col("o_custkey") % 150)
    cands = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    inner = events(spark, sf_dir).filter("k % 3 = 0")
    return left, cands, inner.select(F.col("user_id").alias("parent_id"), (F.col("k") % 7 + 1).alias("line"), "event_id")


@query(
    "join_nested_ambiguities",
    f"""WITH {EVENTS_SQL},
c AS (SELECT o_orderkey, o_custkey % 150 AS parent, l_partkey, l_linenumber, count(*) OVER (PARTITION BY o_orderkey) AS n
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
r AS (SELECT user_id, k % 7 + 1 AS line, event_id, count(*) OVER (PARTITION BY user_id, k % 7) AS n FROM ev WHERE k % 3 = 0)
SELECT o_orderkey, parent, 'candidate' AS kind, l_partkey, l_linenumber, NULL::BIGINT AS event_id FROM c WHERE n > 1
UNION ALL SELECT o_orderkey, parent, 'receipt', l_partkey, l_linenumber, event_id FROM c JOIN r ON user_id = parent AND line = l_linenumber WHERE c.n = 1 AND r.n > 1""",
)
def join_nested_ambiguities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ambiguous candidates and receipts themselves."""
    return J.nested_ambiguities(*_nested(spark, sf_dir), **_NESTED)


@query(
    "integrity_issues",
    """SELECT o_orderkey, concat_ws(',',
  CASE WHEN m = 0 THEN 'missing_market_snapshot' WHEN m > 1 THEN 'ambiguous_market_snapshot' END,
  CASE WHEN m = 1 AND flag = 'A' THEN 'market_trading_date_mismatch' END,
  CASE WHEN o_orderstatus = 'P' THEN 'option_trading_date_mismatch' END,
  CASE WHEN v = 2 AND r = 0 THEN 'missing_raw_receipt' WHEN v = 2 AND r > 1 THEN 'ambiguous_raw_receipt' END,
  CASE WHEN v = 2 AND r = 1 AND o_orderkey % 5 = 0 THEN 'raw_receipt_provenance_mismatch' END,
  CASE WHEN v = 2 AND m = 1 AND flag = 'N' THEN 'market_provenance_mismatch' END,
  CASE WHEN v = 2 AND o_orderpriority = '1-URGENT' THEN 'option_provenance_mismatch' END,
  CASE WHEN v = 3 THEN 'unsupported_source_version' END) AS issues,
  CASE WHEN v <> 2 THEN 'UNVERIFIED_LEGACY_TIME' WHEN concat_ws('', CASE WHEN m <> 1 THEN 'x' END,
    CASE WHEN m = 1 AND flag IN ('A', 'N') THEN 'x' END, CASE WHEN o_orderstatus = 'P' THEN 'x' END,
    CASE WHEN r <> 1 OR o_orderkey % 5 = 0 THEN 'x' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'x' END) = ''
    THEN 'APPLICATION_RECEIPT' ELSE 'UNVERIFIED_SOURCE_INTEGRITY' END AS timestamp_source,
  CASE WHEN concat_ws('', CASE WHEN m <> 1 THEN 'x' END, CASE WHEN m = 1 AND flag = 'A' THEN 'x' END,
    CASE WHEN o_orderstatus = 'P' THEN 'x' END, CASE WHEN v = 2 AND (r <> 1 OR o_orderkey % 5 = 0) THEN 'x' END,
    CASE WHEN v = 2 AND m = 1 AND flag = 'N' THEN 'x' END,
    CASE WHEN v = 2 AND o_orderpriority = '1-URGENT' THEN 'x' END, CASE WHEN v = 3 THEN 'x' END) = ''
    THEN o_totalprice END AS canonical_spot
FROM (SELECT o.*, coalesce(m, 0) AS m, flag, coalesce(r, 0) AS r, o_custkey % 3 + 1 AS v
      FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS m, max(l_returnflag) AS flag FROM lineitem
                               WHERE l_linestatus = 'O' GROUP BY 1) a ON a.l_orderkey = o_orderkey
      LEFT JOIN (SELECT l_orderkey, count(*) AS r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b
        ON b.l_orderkey = o_orderkey)""",
)
def integrity_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues and canonical spot of exported rows from match counts."""
    orders = table(spark, sf_dir, "orders").withColumn("trading_date", F.col("o_orderdate").cast("date"))
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    rows = J.match_evidence(
        orders, li.filter("l_linestatus = 'O'"), ["o_orderkey"], name="market", maxima={"flag": "l_returnflag"}
    )
    rows = J.match_evidence(rows, li.filter("l_returnflag = 'R'"), ["o_orderkey"], name="receipt")
    day = F.col("trading_date")
    rows = rows.withColumns(
        {
            "market_trading_date": F.when(F.col("flag") == "A", F.date_add(day, 1)).otherwise(day),
            "market_version": F.when(F.col("flag") == "N", 1).otherwise(2),
            "market_status": F.lit("PARTIAL"),
            "receipt_basis": F.when(F.col("o_orderkey") % 5 == 0, "OTHER").otherwise("APPLICATION_RECEIPT"),
            "receipt_freshness": F.lit("UNVERIFIED_PROVIDER_TIME"),
            "version": F.col("o_custkey") % 3 + 1,
            "data_status": F.when(F.col("o_orderpriority") == "1-URGENT", "VALID").otherwise("PARTIAL"),
            "day": day,
            "trading_date": F.when(F.col("o_orderstatus") == "P", F.date_sub(day, 1)).otherwise(day),
        }
    )
    out = J.canonical_rows(rows, F.col("day"), "o_totalprice")
    return out.select(
        "o_orderkey", F.array_join("issues", ",").alias("issues"), "timestamp_source", "canonical_spot"
    )


@query(
    "provenance_view",
    """SELECT o_orderkey, l_linenumber, l_partkey, o_orderstatus FROM orders JOIN lineitem
ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
)
def provenance_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their RAW receipt, inner."""
    raw = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    out = table(spark, sf_dir, "orders").join(raw, F.col("o_orderkey") == F.col("l_orderkey"))
    return out.select("o_orderkey", "l_linenumber", "l_partkey", "o_orderstatus")


@query(
    "derived_provenance_view",
    """SELECT o_orderkey, l_linenumber, c_name, s_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_linestatus = 'O' AND o_orderstatus = 'O'""",
)
def derived_provenance_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived rows with their parent and derived receipts, one version only."""
    li = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'")
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    out = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return out.select("o_orderkey", "l_linenumber", "c_name", "s_name")


@query(
    "verified_only_view",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'",
)
def verified_only_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both the freshness and the status must be the verified ones."""
    return (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))
        .select("o_orderkey", "o_custkey")
    )


_PAIR_SQL = """WITH r AS (SELECT o_orderkey AS k, o_orderkey % 101 = 7 AS bad FROM orders WHERE o_orderkey % 97 <> 5
  UNION ALL SELECT o_orderkey, o_orderkey % 101 = 7 FROM orders WHERE o_orderkey % 97 <> 5 AND o_orderkey % 89 = 3),
n AS (SELECT k, sum(l) AS l, sum(r) AS r FROM (SELECT o_orderkey AS k, 1 AS l, 0 AS r FROM orders
      UNION ALL SELECT k, 0, 1 FROM r) GROUP BY k)
SELECT count(*) FILTER (WHERE k IS NULL) AS null_keys, count(*) FILTER (WHERE l > 1 OR r > 1) AS repeated_keys,
  count(*) FILTER (WHERE l = 0 OR r = 0) AS unmatched_keys, (SELECT count(*) FROM r WHERE bad) AS shared_column_conflicts
FROM n"""


@query("one_to_one_check", _PAIR_SQL)
def one_to_one_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of a one-to-one pair with planted faults."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    right = orders.filter("o_orderkey % 97 <> 5").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 101 == 7, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.lit(1).alias("extra"),
    )
    right = right.unionByName(right.filter("o_orderkey % 89 = 3"))
    return J.one_to_one(orders, right, "o_orderkey")[1]


@query(
    "one_to_one_join",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey * 2 AS extra FROM orders",
)
def one_to_one_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined pair itself."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    right = orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") * 2).alias("extra"))
    return J.one_to_one(orders, right, "o_orderkey")[0]


@query(
    "analytics_left_join",
    f"""WITH {TAPE_SQL},
g AS (SELECT underlying, trading_date, t_us, contract_key, optiontype, iv, delta FROM tape WHERE k % 4 <> 0)
SELECT t.observation_id, t.oi, g.iv, round(g.delta, 6) AS delta FROM tape t LEFT JOIN g ON g.underlying = t.underlying
 AND g.trading_date = t.trading_date AND g.t_us = t.t_us AND g.contract_key = t.contract_key AND g.optiontype = t.optiontype""",
)
def analytics_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open interest with separately derived values on five keys."""
    tape = option_tape(spark, sf_dir)
    k = F.round((F.abs("delta") - 0.3) * 400).cast("bigint")
    keys = ["underlying", "trading_date", "timestamps", "contract_key", "optiontype"]
    calc = tape.filter(k % 4 != 0).select(*keys, "iv", "delta")
    out = tape.select(*keys, "observation_id", "oi").join(calc, keys, "left")
    return out.select("observation_id", "oi", "iv", F.round("delta", 6).alias("delta"))


@query(
    "orphan_rows",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
)
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent rows without any child."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.orphans(table(spark, sf_dir, "customer"), orders, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "contract_symbol_mapping",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 25 THEN l_shipdate::DATE::VARCHAR END AS sym,
                  l_partkey * 8 + l_linenumber AS ck FROM lineitem),
m AS (SELECT ck, min(sym) AS s FROM r WHERE sym IS NOT NULL GROUP BY ck HAVING count(DISTINCT sym) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(sym, s) AS symbol,
       CASE WHEN sym IS NULL AND s IS NOT NULL THEN 'stored_contract_mapping' END AS origin
FROM r LEFT JOIN m USING (ck)""",
)
def contract_symbol_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill a missing symbol from a contract that has exactly one."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("ck"),
        F.when(F.col("l_quantity") > 25, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("symbol"),
    )
    out = J.fill_from_mapping(rows, J.static_mapping(rows, "ck", "symbol"), "ck", "symbol", "origin")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "symbol", "origin")


@query(
    "derived_parents",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderkey IS NULL THEN 'parent_missing'
  WHEN l_suppkey % 50 <> o_custkey % 50 THEN 'parent_digest_mismatch' END AS parent_reason
FROM (SELECT *, l_orderkey + CASE WHEN l_linenumber = 7 THEN 100000000 ELSE 0 END AS pid FROM lineitem)
LEFT JOIN orders ON o_orderkey = pid""",
)
def derived_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived rows need a RAW parent with the same digest."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_orderkey") + F.when(F.col("l_linenumber") == 7, 100_000_000).otherwise(0)).alias("pid"),
        (F.col("l_suppkey") % 50).alias("child_digest"),
    )
    parents = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("digest"))
    out = J.accepted_children(li, parents, {"pid": "o_orderkey", "child_digest": "digest"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "parent_reason")


@query(
    "id_set_difference",
    """SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer) b ON a.k = b.k
WHERE a.k IS NULL OR b.k IS NULL""",
)
def id_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids on one side only."""
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return J.set_difference(a, b, "k")


@query(
    "subset_check",
    "SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)",
)
def subset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required values that are not available."""
    need = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"))
    have = table(spark, sf_dir, "part").filter("p_size > 25").select(F.col("p_partkey").alias("k"))
    return K.missing_from(need, have, "k")


@query(
    "session_union",
    """SELECT d, count(*) AS n, count(DISTINCT id) AS ids FROM (
  SELECT CAST(l_shipdate AS DATE)::VARCHAR AS d, 'L' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id FROM lineitem
  UNION ALL SELECT CAST(o_orderdate AS DATE)::VARCHAR, 'O' || o_orderkey FROM orders) GROUP BY d""",
)
def session_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily tables concatenated, ids counted per day."""
    li = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"),
        F.concat(F.lit("L"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])).alias("id"),
    )
    od = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id")
    )
    rows = li.unionByName(od)
    return rows.groupBy("d", "id").agg(F.count(F.lit(1)).alias("c")).groupBy("d").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("ids")
    )


@query(
    "table_comparison",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 3 THEN 'only_stored' WHEN o_orderkey % 103 = 4 THEN 'repeated_key'
  ELSE 'values_differ' END AS problem
FROM orders WHERE o_orderkey % 101 = 3 OR o_orderkey % 103 = 4 OR o_orderkey % 107 = 5""",
)
def table_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: stored and recomputed tables with planted differences."""
    stored = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    again = stored.filter("o_orderkey % 101 <> 3").select(
        "o_orderkey",
        (F.col("o_totalprice") * F.when(F.col("o_orderkey") % 107 == 5, 1.0 + 1e-9).otherwise(1.0 + 1e-15)).alias("o_totalprice"),
        "o_orderstatus",
    )
    again = again.unionByName(again.filter("o_orderkey % 103 = 4"))
    return J.compare_tables(stored, again, ["o_orderkey"])


# Calendar ----------------------------------------------------------------------

_HOL_SQL = """hol AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, 'H' || date_part('doy', o_orderdate)::BIGINT AS name
  FROM orders WHERE date_part('doy', o_orderdate) % 23 = 0 AND date_part('year', o_orderdate) <= 2000)"""


def _holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 23rd day of the years up to 2000, as a calendar fetched at the start of 1999."""
    day = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").filter((F.dayofyear(day) % 23 == 0) & (F.year(day) <= 2000))
    fetched = F.when(F.year("date") == 1999, F.lit("1999-06-01")).otherwise(F.lit("1999-01-01")).cast("timestamp")
    return rows.select(day.alias("date"), F.concat(F.lit("H"), F.dayofyear(day).cast("string")).alias("name")).distinct().select(
        F.year("date").alias("calendar_year"),
        "date",
        "name",
        fetched.alias("fetched_at"),
        (fetched + F.expr("INTERVAL 48 HOURS")).alias("expires_at"),
    )


_NOW = "1999-06-02 12:00:00"


@query(
    "calendar_decisions",
    f"""WITH {_HOL_SQL}
SELECT CAST(d AS VARCHAR) AS date, n, CASE WHEN date_part('isodow', d) >= 6 THEN 'CLOSED' WHEN h.date IS NOT NULL THEN 'CLOSED'
  WHEN date_part('year', d) <> 1999 THEN 'UNKNOWN' ELSE 'OPEN' END AS decision,
  CASE WHEN date_part('isodow', d) >= 6 THEN 'weekend' WHEN h.date IS NOT NULL THEN 'holiday:' || h.name
  WHEN date_part('year', d) > 2000 THEN 'no_calendar' WHEN date_part('year', d) <> 1999 THEN 'stale_calendar' ELSE 'open' END AS reason
FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) LEFT JOIN hol h ON h.date = d""",
)
def calendar_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLOSED, OPEN or UNKNOWN per order date."""
    dates = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    out = K.decide_sessions(dates, _holidays(spark, sf_dir), F.lit(_NOW).cast("timestamp"))
    return out.withColumn("date", F.col("date").cast("string"))


@query(
    "next_open_date",
    f"""WITH {_HOL_SQL},
o AS (SELECT CAST(TIMESTAMP '1994-12-01' + to_days(CAST(i AS INTEGER)) AS DATE) AS d FROM range(0, 4000) r(i)),
open_days AS (SELECT d FROM o WHERE date_part('isodow', d) < 6 AND date_part('year', d) = 1999 AND d NOT IN (SELECT date FROM hol))
SELECT CAST(x.d AS VARCHAR) AS date, CAST((SELECT min(d) FROM open_days p WHERE p.d > x.d AND p.d <= x.d + 370) AS VARCHAR) AS next_open
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""",
)
def next_open_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next open date within 370 days."""
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    out = K.next_open_date(dates, _holidays(spark, sf_dir), F.lit(_NOW).cast("timestamp"))
    return out.select(F.col("date").cast("string").alias("date"), F.col("next_open").cast("string").alias("next_open"))


@query(
    "latest_completed_day",
    """SELECT event_id, CAST(d - CAST(greatest(0, date_part('isodow', d) - 5) AS INTEGER) AS VARCHAR) AS day
FROM (SELECT event_id, CAST(l AS DATE) - CASE WHEN date_part('hour', l) >= 16 THEN 0 ELSE 1 END AS d
      FROM (SELECT event_id, ts + INTERVAL 330 MINUTE AS l FROM events))""",
)
def latest_completed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest weekday whose data is complete at each clock."""
    day = K.latest_completed_weekday(F.col("ts"), "Asia/Kolkata", 16 * 3600)
    return events(spark, sf_dir).select("event_id", day.cast("string").alias("day"))


@query(
    "upcoming_holidays",
    f"WITH {_HOL_SQL} SELECT CAST(date AS VARCHAR) AS date, name FROM hol WHERE date >= DATE '1998-03-01' ORDER BY hol.date, name LIMIT 12",
)
def upcoming_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next twelve holidays."""
    out = K.upcoming(_holidays(spark, sf_dir), F.lit("1998-03-01").cast("date"))
    return out.select(F.col("date").cast("string").alias("date"), "name")


@query(
    "calendar_problems",
    f"""WITH {_HOL_SQL},
y AS (SELECT date_part('year', date)::INTEGER AS calendar_year, count(*) AS n, count(DISTINCT date_part('quarter', date)) AS q
      FROM hol WHERE date_part('year', date) <> 1997 OR date_part('quarter', date) <> 2 GROUP BY 1)
SELECT calendar_year, unnest(['too_few_holidays']) AS problem FROM y WHERE n < 10
UNION ALL SELECT calendar_year, 'too_many_holidays' FROM y WHERE n > 80
UNION ALL SELECT calendar_year, 'quarter_without_holiday' FROM y WHERE q < 4""",
)
def calendar_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years whose calendar cannot be used (one quarter is removed from 1997)."""
    hol = _holidays(spark, sf_dir).filter((F.year("date") != 1997) | (F.quarter("date") != 2))
    return K.calendar_problems(hol)


@query(
    "holiday_feed_problems",
    f"""WITH {_HOL_SQL},
f AS (SELECT date, date_part('year', date)::INTEGER AS year,
        CASE WHEN date_part('doy', date) = 46 THEN 'Noday' ELSE dayname(date) END AS weekday,
        CASE WHEN date_part('doy', date) = 69 AND date_part('year', date) = 1998 THEN 'Evening' END AS session FROM hol)
SELECT year, unnest(['weekday_mismatch']) AS problem FROM f GROUP BY year HAVING count(*) FILTER (WHERE weekday = 'Noday') > 0
UNION ALL SELECT year, 'partial_session' FROM f GROUP BY year HAVING count(session) > 0
UNION ALL SELECT year, 'quarter_without_holiday' FROM f GROUP BY year HAVING count(DISTINCT date_part('quarter', date)) < 4
UNION ALL SELECT year, 'implausible_count' FROM f GROUP BY year HAVING count(*) NOT BETWEEN 10 AND 80""",
)
def holiday_feed_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q17: faults of a raw holiday feed."""
    hol = _holidays(spark, sf_dir)
    doy, year = F.dayofyear("date"), F.year("date")
    feed = hol.select(
        "date",
        F.when(doy == 46, "Noday").otherwise(F.date_format("date", "EEEE")).alias("weekday"),
        F.when((doy == 69) & (year == 1998), "Evening").alias("session"),
    )
    return K.feed_problems(feed)
