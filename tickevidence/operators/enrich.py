"""Linking stored calculations to raw observations, and completeness of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.functions.clock import contract_key, us
from tickevidence.operators.joins import fill_from_mapping, static_mapping
from tickevidence.operators.stats import finite

# Provenance a version 2 calculation receipt must carry.
RECEIPT = {
    "kind": "DERIVED",
    "timestamp_basis": "CALCULATION_RECEIPT",
    "freshness": "DERIVED_UNVERIFIED_INPUT_TIME",
}
GREEKS = ("delta", "gamma", "theta", "vega")
RECEIPT_SCHEMA = (
    "struct<kind:string,parent_observation_id:string,observation_id:string,symbol:string,received_at:timestamp,"
    "request_started_at:timestamp,scheduled_at:timestamp,timestamp_basis:string,freshness:string>"
)
CANDIDATE_SCHEMA = (
    "struct<timestamp:timestamp,underlying:string,option_symbol:string,strike:double,option_type:string,expiry_day:date,"
    "trading_date:date,version:string,data_status:string,error_class:string,calculation_method:string,"
    "ingestion_time:timestamp,option_ltp:double,underlying_ltp:double,implied_volatility:double,delta:double,gamma:double,"
    f"theta:double,vega:double,rho:double,interest_rate:double,forward_price:double,derived_receipts:array<{RECEIPT_SCHEMA}>>"
)


def candidates_from_json(df: DataFrame, column: str) -> DataFrame:
    """Parse a JSON array of stored calculations into ``candidate_count`` and, when
    there is exactly one, ``candidate`` with ``receipt_count`` and ``receipt``."""
    parsed = df.withColumn("_list", F.from_json(column, f"array<{CANDIDATE_SCHEMA}>"))
    one = F.when(F.size("_list") == 1, F.element_at("_list", 1))
    return (
        parsed.withColumn("candidate_count", F.coalesce(F.greatest(F.size("_list"), F.lit(0)), F.lit(0)).cast("bigint"))
        .withColumn("candidate", one)
        .withColumn("receipt_count", F.greatest(F.size("candidate.derived_receipts"), F.lit(0)).cast("bigint"))
        .withColumn("receipt", F.when(F.col("receipt_count") == 1, F.element_at("candidate.derived_receipts", 1)))
        .drop("_list")
    )


def link_reason(model: str) -> Column:
    """First reason a candidate is not the calculation of its row, else NULL.

    Expects the row's timestamps, underlying, strike, optiontype, expiry_day,
    trading_date, source_version, source_receipt_id, scheduled_at, ltp, spot, and
    candidate, receipt_count, receipt. A missing field never counts as a match.
    """
    c = F.col
    cand, rec = c("candidate"), c("receipt")

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a == b, F.lit(False))

    contract = (
        same(cand["timestamp"], c("timestamps"))
        & same(cand["underlying"], c("underlying"))
        & same(cand["strike"], c("strike"))
        & same(cand["option_type"], c("optiontype"))
        & same(cand["expiry_day"], c("expiry_day"))
        & same(cand["trading_date"], c("trading_date"))
        & same(cand["version"], c("source_version"))
        & (F.coalesce(cand["option_symbol"], F.lit("")) != "")
    )
    available = cand["ingestion_time"]
    version2, version1 = same(c("source_version"), F.lit("2")), same(c("source_version"), F.lit("1"))
    receipt_ok = (
        same(rec["parent_observation_id"], c("source_receipt_id"))
        & same(rec["symbol"], cand["option_symbol"])
        & same(rec["received_at"], available)
        & same(cand["data_status"], F.lit("PARTIAL"))
        & F.coalesce(rec["observation_id"].rlike("^[0-9a-f]{64}$"), F.lit(False))
    )
    for name, value in RECEIPT.items():
        receipt_ok = receipt_ok & same(rec[name], F.lit(value))
    started = rec["request_started_at"]
    in_order = F.coalesce((c("timestamps") <= started) & (started <= available), F.lit(False))
    legacy_ok = F.coalesce(cand["data_status"].isin("VALID", "PARTIAL"), F.lit(False)) & (
        F.coalesce(cand["error_class"], F.lit("")) == ""
    )
    return (
        F.when(~contract, "derived_contract_mismatch")
        .when(~same(cand["calculation_method"], F.lit(model)), "unsupported_stored_model")
        .when(~F.coalesce(available >= c("timestamps"), F.lit(False)), "invalid_derived_availability")
        .when(version2 & (c("receipt_count") != 1), "missing_or_ambiguous_derived_receipt")
        .when(version2 & ~receipt_ok, "derived_receipt_provenance_mismatch")
        .when(version2 & ~in_order, "derived_request_time_mismatch")
        .when(version2 & ~rec["scheduled_at"].eqNullSafe(c("scheduled_at")), "derived_schedule_mismatch")
        .when(
            version1 & ~legacy_ok,
            F.concat(F.lit("legacy_calculation_unavailable:"), F.coalesce(cand["data_status"], F.lit("None"))),
        )
        .when(~(version1 | version2), "unsupported_derived_version")
        .when(cand["option_ltp"].isNotNull() & ~same(cand["option_ltp"], c("ltp")), "derived_raw_option_price_mismatch")
        .when(cand["underlying_ltp"].isNotNull() & ~same(cand["underlying_ltp"], c("spot")), "derived_raw_spot_mismatch")
    )


def _field(value: Column, name: str, *, signed: bool = False, positive: bool = False) -> tuple[Column, Column]:
    """(usable value, issue) of one stored number; an unusable one is NULL and named."""
    good = finite(value)
    ok = good.isNotNull()
    if positive:
        ok = ok & (good > 0)
    elif not signed:
        ok = ok & (good >= 0)
    ok = F.coalesce(ok, F.lit(False))
    return F.when(ok, good), F.when(value.isNotNull() & ~ok, f"invalid_{name}")


def enrich(rows: DataFrame, model: str = "BLACK76") -> DataFrame:
    """Attach stored analytics to accepted rows, with status, reason, issues and flags.

    Availability is the calculation's own receipt time. Volatility and rate are
    percents in storage. Without a valid link nothing is attached.
    """
    c = F.col
    judged = rows.withColumn("link_reason", F.when(c("candidate_count") == 1, link_reason(model)))
    linked = judged.withColumn("_ok", (c("candidate_count") == 1) & c("link_reason").isNull())
    cand = c("candidate")

    def from_candidate(name: str) -> Column:
        return F.when(c("_ok"), cand[name])

    iv, iv_issue = _field(from_candidate("implied_volatility"), "derived_iv", positive=True)
    rate, rate_issue = _field(from_candidate("interest_rate"), "interest_rate", signed=True)
    forward, forward_issue = _field(from_candidate("forward_price"), "calculation_forward_price", positive=True)
    parsed = {
        g: _field(from_candidate(g), g, signed=g in ("delta", "theta", "rho")) for g in (*GREEKS, "rho")
    }
    issues = F.array_compact(F.array(iv_issue, *[i for _, i in parsed.values()], rate_issue, forward_issue))
    staged = linked.withColumns(
        {
            "iv": F.coalesce(iv / 100.0, c("iv")),
            "iv_source": F.when(iv.isNotNull(), model).when(c("iv").isNotNull(), "supplied").otherwise("unavailable"),
            "iv_available_at": F.when(iv.isNotNull(), from_candidate("ingestion_time")).when(c("iv").isNotNull(), c("timestamps")),
            "greeks_available_at": from_candidate("ingestion_time"),
            "derived_received_at": from_candidate("ingestion_time"),
            "derived_receipt_id": F.when(c("_ok"), c("receipt.observation_id")),
            "derived_parent_receipt_id": F.when(c("_ok"), c("receipt.parent_observation_id")),
            "derived_source_version": from_candidate("version").cast("int"),
            "calculation_model": from_candidate("calculation_method"),
            "calculation_lag_ms": (us(from_candidate("ingestion_time")) - us("timestamps")) / F.lit(1000.0),
            "calculation_interest_rate": rate / 100.0,
            "calculation_forward_price": forward,
            "symbol": F.coalesce(from_candidate("option_symbol"), c("symbol")),
            "_rate": rate,
            "_iv": iv,
            "enrichment_issues": F.when(F.size(issues) > 0, F.array_join(issues, ";")),
            **{g: v for g, (v, _) in parsed.items()},
        }
    )
    complete = c("_iv").isNotNull()
    for g in GREEKS:
        complete = complete & c(g).isNotNull()
    status = (
        F.when(c("candidate_count") == 0, "missing_stored_derived")
        .when(c("candidate_count") > 1, "ambiguous_stored_derived")
        .when(~c("_ok"), "invalid_stored_derived")
        .when(complete, "stored_derived")
        .otherwise("stored_partial")
    )
    flags = F.array_compact(
        F.array(
            F.lit("UNVERIFIED_INPUT_TIME"),
            F.when(c("_rate") == 0, "ZERO_INTEREST_RATE_ASSUMPTION"),
            F.when(c("calculation_forward_price").isNull(), "UNDERLYING_BASIS_UNVERIFIED"),
            F.when(c("source_version") == "1", "LEGACY_RECEIPT_UNAVAILABLE"),
        )
    )
    return staged.withColumns(
        {
            "derivation_status": status,
            "derivation_reason": F.coalesce(c("link_reason"), status),
            "greeks_source": F.when(c("_ok"), model).otherwise("unavailable"),
            "model_risk_flags": F.when(c("_ok"), F.array_join(flags, ";")),
            "contract_key": contract_key(c("underlying"), c("expiry_day"), c("strike"), c("optiontype")),
            "contract_identity_source": F.when(c("_ok"), "stored_calculation"),
        }
    ).drop("_ok", "_rate", "_iv", "link_reason")


def label_contracts(enriched: DataFrame) -> DataFrame:
    """Give rows without a symbol the one symbol linked calculations of the same
    contract agree on. Analytics are never copied."""
    known = enriched.filter(F.col("contract_identity_source") == "stored_calculation")
    mapping = static_mapping(known, "contract_key", "symbol")
    out = fill_from_mapping(enriched, mapping, "contract_key", "symbol", "_from")
    return out.withColumn("contract_identity_source", F.coalesce("contract_identity_source", "_from")).drop("_from")


def completeness_report(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Non-null counts, complete rows and COMPLETE / PARTIAL coverage, in one row."""
    whole = F.col("iv").isNotNull()
    for g in GREEKS:
        whole = whole & F.col(g).isNotNull()
    out = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(f).alias(f"has_{f}") for f in fields],
        F.count_if(whole).alias("complete_rows"),
        F.count_if(~whole).alias("incomplete_rows"),
    )
    full = (F.col("rows") > 0) & (F.col("incomplete_rows") == 0)
    return out.withColumn("coverage", F.when(full, "COMPLETE").otherwise("PARTIAL"))


def analytics_status(iv: Column, greeks: list[Column], raw_present: Column, error: Column) -> tuple[Column, Column]:
    """(status, error class): VALID with a positive IV and every Greek, MISSING without
    any payload, else PARTIAL."""
    every = F.coalesce(finite(iv) > 0, F.lit(False))
    for g in greeks:
        every = every & finite(g).isNotNull()
    status = F.when(~raw_present, "MISSING").when(every, "VALID").otherwise("PARTIAL")
    return status, F.when(status != "VALID", F.coalesce(error, F.when(status == "MISSING", "NoResponse").otherwise("IncompleteAnalytics")))
