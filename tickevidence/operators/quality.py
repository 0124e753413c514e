"""Row rules, table rules and receipt contracts, each evaluated in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.functions.clock import in_session, us
from tickevidence.operators.stats import finite


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a violating row; NULL counts as no violation."""

    name: str
    fails: Column
    severity: str = "ERROR"


def rule_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, violations) for every rule, from a single aggregation."""
    sums = [F.count_if(F.coalesce(r.fails, F.lit(False))).alias(f"v{i}") for i, r in enumerate(rules)]
    items = [F.struct(F.lit(r.name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(rules)]
    return df.agg(*sums).select(F.inline(F.array(*items)))


def violations_by(df: DataFrame, rules: list[Rule], by: str) -> DataFrame:
    """(by, rule, violations) of the rules that are broken, from a single grouped aggregation."""
    sums = [F.count_if(F.coalesce(r.fails, F.lit(False))).alias(f"v{i}") for i, r in enumerate(rules)]
    items = [F.struct(F.lit(r.name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(rules)]
    return df.groupBy(by).agg(*sums).select(by, F.inline(F.array(*items))).filter("violations > 0")


def with_failures(df: DataFrame, rules: list[Rule], name: str = "failures") -> DataFrame:
    """Add the array of (rule, severity) that each row violates."""
    found = [
        F.when(
            F.coalesce(r.fails, F.lit(False)),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity")),
        )
        for r in rules
    ]
    return df.withColumn(name, F.array_compact(F.array(*found)))


def first_failure(rules: list[Rule]) -> Column:
    """Name of the first violated rule, else NULL."""
    return F.coalesce(*[F.when(F.coalesce(r.fails, F.lit(False)), F.lit(r.name)) for r in rules])


# Snapshot rules ---------------------------------------------------------------

# Field lists and limits of the snapshot rule set.
SNAPSHOT_REQUIRED = ("timestamp", "trading_date", "symbol", "spot_ltp", "atm_strike", "expiry_date", "days_to_expiry")
SNAPSHOT_CORE = (
    "spot_ltp", "vix", "atm_strike", "atm_ce_ltp", "atm_ce_oi", "atm_ce_iv", "atm_pe_ltp", "atm_pe_oi", "atm_pe_iv",
)
SNAPSHOT_GREEKS = ("delta", "gamma", "theta", "vega")


def snapshot_rules(
    spot_range: tuple[float, float] = (20000, 30000),
    vix_range: tuple[float, float] = (5, 40),
    strike_step: float = 50,
    max_spread_pct: float = 5.0,
) -> list[Rule]:
    """Required fields, ranges, order of quotes, spreads. Missing optional values pass."""
    c = F.col
    rules = [Rule(f"required_{f}", c(f).isNull()) for f in SNAPSHOT_REQUIRED]
    rules.append(Rule("spot_price_range", ~c("spot_ltp").between(*spot_range)))
    rules.append(Rule("vix_range", ~c("vix").between(*vix_range), "WARN"))
    rules.append(Rule("atm_strike_interval", c("atm_strike") % strike_step != 0, "WARN"))
    rules += [
        Rule(f"positive_atm_{s}_{f}", c(f"atm_{s}_{f}") < 0) for s in ("ce", "pe") for f in ("ltp", "bid", "ask")
    ]
    rules += [
        Rule(f"{s}_bid_ask_order", c(f"atm_{s}_bid") > c(f"atm_{s}_ask"), "WARN") for s in ("ce", "pe")
    ]
    rules += [Rule(f"nonneg_atm_{s}_oi", c(f"atm_{s}_oi") < 0, "WARN") for s in ("ce", "pe")]
    rules += [Rule(f"iv_range_atm_{s}_iv", ~c(f"atm_{s}_iv").between(0, 100), "WARN") for s in ("ce", "pe")]
    rules += [
        Rule(f"greek_range_atm_{s}_{g}", F.abs(c(f"atm_{s}_{g}")) >= 1000, "WARN")
        for s in ("ce", "pe")
        for g in SNAPSHOT_GREEKS
    ]

    def wide(bid: str, ask: str, price: str, limit: float) -> Column:
        # A zero quote counts as absent, so it skips the check.
        usable = (c(bid) != 0) & (c(ask) != 0) & (c(price) != 0)
        if price != "spot_ltp":
            usable = usable & (c(price) > 0)
        return F.coalesce(
            F.when(usable, F.try_divide(c(ask) - c(bid), c(price)) * 100 > limit), F.lit(False)
        )

    spread = wide("spot_bid", "spot_ask", "spot_ltp", max_spread_pct)
    for s in ("ce", "pe"):
        spread = spread | wide(f"atm_{s}_bid", f"atm_{s}_ask", f"atm_{s}_ltp", max_spread_pct * 2)
    rules.append(Rule("spread_reasonable", spread, "WARN"))
    return rules


def snapshot_status(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """REJECTED on any error; with failures and over half the core missing, PARTIAL; else VALID.

    A row that violates nothing is VALID however much optional data it lacks.
    """
    tagged = with_failures(df, rules)
    missing = sum((F.col(f).isNull().cast("int") for f in SNAPSHOT_CORE), F.lit(0))
    errors = F.exists("failures", lambda f: f["severity"] == "ERROR")
    status = (
        F.when(errors, "REJECTED")
        .when((F.size("failures") > 0) & (missing > len(SNAPSHOT_CORE) / 2), "PARTIAL")
        .otherwise("VALID")
    )
    return tagged.withColumn("data_status", status).withColumn("failed_fields", F.size("failures"))


# Receipts and landed observations ---------------------------------------------

# Allowed provenance of each observation kind.
RECEIPT_KINDS = {
    "RAW": ("APPLICATION_RECEIPT", "UNVERIFIED_PROVIDER_TIME"),
    "DERIVED": ("CALCULATION_RECEIPT", "DERIVED_UNVERIFIED_INPUT_TIME"),
    "HISTORY": ("CANDLE_START", "HISTORICAL_BACKFILL"),
}
MAX_EXACT_INTEGER = 2**53 - 1


def receipt_rules(max_late_seconds: float = 5) -> list[Rule]:
    """Clock order and the kind / basis / freshness / parent combination."""
    c = F.col
    order = (c("scheduled_at") <= c("request_started_at")) & (c("request_started_at") <= c("received_at"))
    combination = F.lit(False)
    for kind, (basis, fresh) in RECEIPT_KINDS.items():
        parent = c("parent_observation_id")
        fits = (
            c("kind").eqNullSafe(F.lit(kind))
            & c("timestamp_basis").eqNullSafe(F.lit(basis))
            & c("freshness").eqNullSafe(F.lit(fresh))
            & (parent.isNotNull() if kind == "DERIVED" else parent.isNull())
        )
        combination = combination | fits
    late = (c("kind") == "RAW") & (
        us("received_at") - us("scheduled_at") >= int(max_late_seconds * 1_000_000)
    )
    return [
        Rule("inverted_timestamps", ~F.coalesce(order, F.lit(False))),
        Rule("unknown_provenance_combination", ~combination),
        Rule("late_raw_receipt", late),
    ]


def append_rules() -> list[Rule]:
    """Price and open-interest integrity of new (version 2) rows; old rows pass."""
    c = F.col
    new = c("version") >= 2

    def positive(col: Column) -> Column:
        return F.coalesce((finite(col) > 0), F.lit(False))

    oi_ok = c("oi").isNull() | F.coalesce(
        (c("oi") > 0) & (c("oi") <= MAX_EXACT_INTEGER) & (c("oi") == F.floor("oi")), F.lit(False)
    )
    return [
        Rule("version_gate", ~((c("version") == 2) & c("data_status").eqNullSafe(F.lit("PARTIAL")))),
        Rule("price_not_finite_positive", new & ~positive(c("ltp"))),
        Rule("open_interest_not_exact", new & ~oi_ok),
        Rule("bid_not_positive", new & c("bid").isNotNull() & ~positive(c("bid"))),
        Rule("ask_not_positive", new & c("ask").isNotNull() & ~positive(c("ask"))),
        Rule("crossed_quote", new & (c("bid") > c("ask"))),
    ]


def research_gate_rules(side_values: tuple[str, ...] = ("CE", "PE"), zone: str = "Asia/Kolkata") -> list[Rule]:
    """Row part of the gate before sampling."""
    c = F.col
    return [
        Rule("missing_identity", c("observation_id").isNull() | c("underlying").isNull() | c("trading_date").isNull()),
        Rule("missing_timestamp", c("timestamps").isNull()),
        Rule("spot_not_finite_positive", ~F.coalesce(finite(c("spot")) > 0, F.lit(False))),
        Rule("trading_date_mismatch", c("trading_date").cast("date") != F.to_date(F.from_utc_timestamp("timestamps", zone))),
        Rule("iv_available_before_receipt", c("iv_available_at") < c("timestamps")),
        Rule("greeks_available_before_receipt", c("greeks_available_at") < c("timestamps")),
        Rule("unknown_side", ~F.coalesce(c("optiontype").isin(*side_values), F.lit(False))),
        Rule("missing_contract", c("contract_key").isNull()),
    ]


def research_gate(tape: DataFrame, zone: str = "Asia/Kolkata") -> DataFrame:
    """(rule, violations) of the whole gate: row rules, unique ids, one price and at
    most one quote per side at a receipt. Any count above zero forbids sampling.
    """
    rows = rule_violations(tape, research_gate_rules(zone=zone))
    ids = tape.groupBy("observation_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = ids.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        F.lit("repeated_observation_id").alias("rule"), "violations"
    )
    at = tape.groupBy("underlying", "timestamps").agg(
        (F.min("spot") != F.max("spot")).alias("conflict"),
        *[F.count_if(F.col("optiontype") == s).alias(s) for s in ("CE", "PE")],
    )
    shared = at.agg(
        F.count_if("conflict").alias("a"),
        F.count_if((F.col("CE") > 1) | (F.col("PE") > 1)).alias("b"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("conflicting_spot").alias("rule"), F.col("a").alias("violations")),
                F.struct(F.lit("ambiguous_quote").alias("rule"), F.col("b").alias("violations")),
            )
        )
    )
    return rows.unionByName(repeated).unionByName(shared)


def require_clean(violations: DataFrame) -> None:
    """Raise when any rule of a (small) violation table is broken."""
    broken = [f"{r['rule']}={r['violations']}" for r in violations.filter("violations > 0").collect()]
    if broken:
        raise ValueError("input rejected: " + ", ".join(sorted(broken)))


# Cleaned pair -----------------------------------------------------------------


def _numeric(label: str, name: str, kind: str) -> Rule:
    value = F.col(name).cast("double")
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    if kind == "positive":
        bad = bad | (value <= 0)
    elif kind in ("nonnegative", "integer"):
        bad = bad | (value < 0)
    if kind == "integer":
        bad = bad | (value != F.floor(value))
    return Rule(f"{label}.{name}: invalid {kind} numeric value", bad)


# Numeric domains, statuses and sources of the cleaned pair.
OBSERVATION_NUMBERS = {"source_row": "integer", "spot": "positive", "iv": "positive", "volume": "integer"}
OPTION_NUMBERS = {
    "oi": "integer", "ltp": "nonnegative", "strike": "positive", "daystoexpiry": "nonnegative", "delta": "finite",
    "theta": "finite", "gamma": "nonnegative", "vega": "nonnegative", "rho": "finite", "bid": "nonnegative",
    "ask": "nonnegative", "calculation_lag_ms": "nonnegative", "calculation_interest_rate": "finite",
}
STATUSES = (
    "disabled", "missing_parameters", "missing_iv", "nonpositive_time", "derived", "stored_derived",
    "stored_partial", "missing_stored_derived", "ambiguous_stored_derived", "invalid_stored_derived",
)
GREEKS = ("delta", "theta", "gamma", "vega")


def _required(label: str, names: tuple[str, ...]) -> list[Rule]:
    return [
        Rule(f"{label}.{n}: required value missing", F.col(n).isNull() | (F.trim(F.col(n).cast("string")) == ""))
        for n in names
    ]


def _has(columns: list[str], *names: str) -> bool:
    return all(n in columns for n in names)


def observation_rules(columns: list[str]) -> list[Rule]:
    names = ("observation_id", "source_row", "timestamps", "spot", "timestamp_source", "data_status")
    rules = _required("observations", names)
    rules.append(Rule("observations: malformed observation_id", ~F.col("observation_id").rlike("^[0-9a-f]{64}$")))
    return rules + [_numeric("observations", n, k) for n, k in OBSERVATION_NUMBERS.items() if n in columns]


def option_rules(columns: list[str], model: str) -> list[Rule]:
    c = F.col
    names = (
        "observation_id", "timestamps", "strike", "optiontype", "expirydate", "daystoexpiry", "greeks_source",
        "derivation_status",
    )
    rules = _required("options", names)
    rules.append(Rule("options: malformed observation_id", ~c("observation_id").rlike("^[0-9a-f]{64}$")))
    rules += [_numeric("options", n, k) for n, k in OPTION_NUMBERS.items() if n in columns]
    days = (us("expirydate") - us("timestamps")) / F.lit(86_400e6)
    status = c("derivation_status")
    derived = status == "derived"
    stored = status.isin("stored_derived", "stored_partial")
    some, every = F.lit(False), F.lit(True)
    for g in GREEKS:
        some, every = some | c(g).isNotNull(), every & c(g).isNotNull()
    source = c("greeks_source")
    rules += [
        Rule("options.optiontype: expected CE or PE", ~c("optiontype").isin("CE", "PE")),
        Rule("options: expiry precedes observation timestamp", days < 0),
        Rule("options.daystoexpiry: inconsistent with timestamps and expirydate", F.abs(days - c("daystoexpiry")) > 1e-9),
        Rule("options: derived Greeks must all be present", (derived | (status == "stored_derived")) & ~every),
        Rule("options: unavailable Greeks must remain null", ~(derived | stored) & some),
        Rule("options: derived Greeks must identify black_scholes_european", derived & ~source.eqNullSafe(F.lit("black_scholes_european"))),
        Rule("options: unknown derivation_status", ~F.coalesce(status.isin(*STATUSES), F.lit(False))),
        Rule("options: unavailable Greeks must identify unavailable source", ~(derived | stored) & ~source.eqNullSafe(F.lit("unavailable"))),
        Rule("options: stored Greeks must identify their model", stored & ~source.eqNullSafe(F.lit(model))),
    ]
    provenance = ("greeks_available_at", "derived_received_at", "calculation_model", "derived_source_version")
    if _has(columns, *provenance, "calculation_lag_ms", "derived_receipt_id", "derived_parent_receipt_id"):
        available, received = c("greeks_available_at"), c("derived_received_at")
        lag = (us(received) - us("timestamps")) / F.lit(1000.0)
        v2 = stored & F.coalesce(c("derived_source_version") == 2, F.lit(False))
        rules += [
            *[Rule(f"options.{n}: stored calculation provenance is required", stored & c(n).isNull()) for n in provenance],
            Rule("options: stored Greeks cannot be available before the raw observation", stored & (available < c("timestamps"))),
            Rule("options: stored Greek availability must match calculation receipt time", stored & ~available.eqNullSafe(received)),
            Rule("options: calculation model must match Greek source", stored & ~c("calculation_model").eqNullSafe(source)),
            Rule(
                "options: calculation lag must match receipt availability",
                stored & F.coalesce(F.abs(lag - c("calculation_lag_ms")) > 1e-6, F.lit(True)),
            ),
            *[
                Rule(
                    f"options.{n}: version 2 calculations require receipt identity",
                    v2 & ~F.coalesce(c(n).rlike("^[0-9a-f]{64}$"), F.lit(False)),
                )
                for n in ("derived_receipt_id", "derived_parent_receipt_id")
            ],
        ]
    return rules


def pair_rules(columns: list[str], model: str) -> list[Rule]:
    """Rules on observation_id-joined rows; options columns carry an ``opt_`` prefix."""
    c = F.col
    rules = [
        Rule(f"tables: mismatched {n} for observation_id", ~c(n).eqNullSafe(c(f"opt_{n}")))
        for n in ("timestamps", "underlying", "symbol", "exchange")
    ]
    status = c("opt_derivation_status")
    derived = status == "derived"
    stored = status.isin("stored_derived", "stored_partial")
    rules += [
        Rule("tables: derived Greeks require supplied IV", derived & c("iv").isNull()),
        Rule("tables: derived Greeks require positive time to expiry", derived & (c("opt_daystoexpiry") <= 0)),
        Rule("tables: complete stored Greeks require IV", (status == "stored_derived") & c("iv").isNull()),
    ]
    if _has(columns, "opt_derived_source_version", "iv_source", "iv_available_at", "opt_greeks_available_at", "opt_derived_parent_receipt_id"):
        with_iv = stored & c("iv").isNotNull()
        v2 = stored & F.coalesce(c("source_version") == "2", F.lit(False))
        rules += [
            Rule(
                "tables: stored calculation version must match RAW source version",
                stored & ~c("opt_derived_source_version").cast("string").eqNullSafe(c("source_version")),
            ),
            Rule("tables: stored IV must identify its model", with_iv & ~c("iv_source").eqNullSafe(F.lit(model))),
            Rule(
                "tables: stored IV and Greeks must share calculation availability",
                with_iv & ~c("iv_available_at").eqNullSafe(c("opt_greeks_available_at")),
            ),
            Rule(
                "tables: derived receipt must identify the RAW parent",
                v2 & ~c("opt_derived_parent_receipt_id").eqNullSafe(c("source_receipt_id")),
            ),
        ]
    return rules


def _repeats(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        F.lit(name).alias("rule"), "violations"
    )


PAIR_KEY = ["timestamps", "underlying", "symbol", "exchange", "strike", "optiontype", "expirydate"]


def pair_violations(observations: DataFrame, options: DataFrame, by: str, model: str = "BLACK76") -> DataFrame:
    """Broken rules of the cleaned pair per ``by`` (a day): (by, rule, violations). Both tables carry ``by``.

    The same rules as :func:`validate_pair`; an id whose halves lie in different days breaks the pairing on both.
    """
    plain = [c for c in options.columns if c != by]

    def repeats(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        counts = df.groupBy(by, *keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        return counts.groupBy(by).agg(F.count(F.lit(1)).alias("violations")).select(by, F.lit(name).alias("rule"), "violations")

    sides = observations.select(by, "observation_id", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        options.select(by, "observation_id", F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    unmatched = sides.groupBy(by, "observation_id").agg(F.sum("l").alias("l"), F.sum("r").alias("r")).filter("l <> 1 OR r <> 1")
    unmatched = unmatched.groupBy(by).agg(F.count(F.lit(1)).alias("violations"))
    pair = observations.join(options.select(by, *[F.col(n).alias(n if n == "observation_id" else f"opt_{n}") for n in plain]), [by, "observation_id"])
    parts = [
        violations_by(observations, observation_rules(observations.columns), by),
        violations_by(options, option_rules(options.columns, model), by),
        repeats(observations, ["observation_id"], "observations: duplicate observation_id"),
        repeats(options, ["observation_id"], "options: duplicate observation_id"),
        repeats(options, PAIR_KEY, "options: repeated natural key"),
        unmatched.select(by, F.lit("tables: observation_id foreign keys must match one-to-one").alias("rule"), "violations"),
        violations_by(pair, pair_rules(pair.columns, model), by),
    ]
    return reduce(DataFrame.unionByName, parts)


def validate_pair(observations: DataFrame, options: DataFrame, model: str = "BLACK76") -> DataFrame:
    """All rules of the cleaned pair as (rule, violations)."""
    out = rule_violations(observations, observation_rules(observations.columns))
    out = out.unionByName(rule_violations(options, option_rules(options.columns, model)))
    out = out.unionByName(_repeats(observations, ["observation_id"], "observations: duplicate observation_id"))
    out = out.unionByName(_repeats(options, ["observation_id"], "options: duplicate observation_id"))
    out = out.unionByName(_repeats(options, PAIR_KEY, "options: repeated natural key"))
    ids = (
        observations.select("observation_id", F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(options.select("observation_id", F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy("observation_id")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .agg(F.count_if((F.col("l") != 1) | (F.col("r") != 1)).alias("violations"))
        .select(F.lit("tables: observation_id foreign keys must match one-to-one").alias("rule"), "violations")
    )
    pair = observations.join(
        options.select(*[F.col(n).alias(n if n == "observation_id" else f"opt_{n}") for n in options.columns]),
        "observation_id",
    )
    return out.unionByName(ids).unionByName(rule_violations(pair, pair_rules(pair.columns, model)))


def cycle_pairs(rows: DataFrame, *, by: list[str], side: str, contract: str, time: str, ingested: str) -> DataFrame:
    """Judge each capture cycle: exactly one CE and one PE, one contract and receipt
    time for both, nothing ingested before it was observed.
    """
    out = rows.groupBy(*by).agg(
        F.count_if(F.col(side) == "CE").alias("ce_rows"),
        F.count_if(F.col(side) == "PE").alias("pe_rows"),
        (F.min(contract) != F.max(contract)).alias("mixed_contract"),
        (F.min(time) != F.max(time)).alias("mixed_time"),
        F.count_if(F.col(ingested) < F.col(time)).alias("early_rows"),
    )
    ok = (
        (F.col("ce_rows") == 1)
        & (F.col("pe_rows") == 1)
        & ~F.coalesce("mixed_contract", F.lit(True))
        & ~F.coalesce("mixed_time", F.lit(True))
        & (F.col("early_rows") == 0)
    )
    return out.withColumn("complete", ok)


def session_live(ts: str) -> Column:
    return in_session(ts)
