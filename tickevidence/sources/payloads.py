"""Landed provider payloads: quotes, option chains, analytics, candles, envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.functions.clock import in_session, is_contract_symbol, local_date, parse_expiry, us
from tickevidence.operators.enrich import analytics_status
from tickevidence.operators.quality import MAX_EXACT_INTEGER, Rule
from tickevidence.operators.stats import finite

# Provider field spellings of one quote field, in order of preference.
QUOTE_ALIASES = {
    "ltp": ("ltp", "last_price"),
    "bid": ("bid",),
    "ask": ("ask",),
    "bid_qty": ("bid_qty", "bid_quantity"),
    "ask_qty": ("ask_qty", "ask_quantity"),
    "open": ("open",),
    "high": ("high",),
    "low": ("low",),
    "prev_close": ("prev_close", "previous_close"),
    "volume": ("volume",),
    "oi": ("oi", "open_interest"),
}
WHOLE_FIELDS = ("bid_qty", "ask_qty", "volume", "oi")
ANALYTIC_GREEKS = ("delta", "gamma", "theta", "vega", "rho")


def json_number(doc: Column, path: str) -> Column:
    """A finite number at a JSON path; booleans, text words and non-finite values are NULL."""
    return finite(F.get_json_object(doc, path).try_cast("double"))


def _aliased(doc: Column, root: str, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[json_number(doc, f"{root}.{n}") for n in names])


def parse_quotes(df: DataFrame, payload: str, root: str = "$.data") -> DataFrame:
    """Typed quote columns from a JSON payload."""
    doc = F.col(payload)
    cols = {}
    for name, names in QUOTE_ALIASES.items():
        value = _aliased(doc, root, names)
        cols[name] = value.cast("bigint") if name in WHOLE_FIELDS else value
    return df.withColumns(cols)


_LEG = "struct<symbol:string,ltp:double,bid:double,ask:double,oi:double,volume:double,iv:double>"
CHAIN_SCHEMA = f"struct<chain:array<struct<strike:double,ce:{_LEG},pe:{_LEG}>>>"


def flatten_chain(df: DataFrame, payload: str, atm: str) -> tuple[DataFrame, DataFrame]:
    """CE and PE rows of the at-the-money strike, and the payloads rejected.

    Exactly one chain entry must have that strike, with both legs and symbols. The
    entries of one payload are judged inside its row, so nothing is shuffled.
    """
    parsed = df.withColumn("_doc", F.from_json(payload, CHAIN_SCHEMA))
    hits = F.filter(F.coalesce("_doc.chain", F.array()), lambda e: e["strike"] == F.col(atm))
    tagged = parsed.withColumn("_hits", hits).withColumn("_n", F.size("_hits")).withColumn(
        "_one", F.when(F.col("_n") == 1, F.element_at("_hits", 1))
    )
    whole = F.coalesce((F.col("_one.ce.symbol") != "") & (F.col("_one.pe.symbol") != ""), F.lit(False))
    reason = (
        F.when(F.col("_doc.chain").isNull(), "malformed_chain")
        .when(F.col("_n") == 0, "strike_missing")
        .when(F.col("_n") > 1, "strike_ambiguous")
        .when(~whole, "leg_missing")
    )
    judged = tagged.withColumn("reason", reason)
    legs = F.array(
        *[
            F.struct(
                F.lit(s.upper()).alias("side"),
                *[F.col(f"_one.{s}.{n}").alias(n) for n in ("symbol", "ltp", "bid", "ask", "oi", "volume", "iv")],
            )
            for s in ("ce", "pe")
        ]
    )
    good = judged.filter(F.col("reason").isNull()).select(*df.columns, F.inline(legs))
    return good, judged.filter(F.col("reason").isNotNull()).select(*df.columns, "reason")


def zero_is_unknown(df: DataFrame, columns: tuple[str, ...] = ("oi", "volume"), strict: bool = True) -> DataFrame:
    """In the strict feed a zero count may stand for nothing received: it becomes NULL
    with an issue. Otherwise zeros are values and nothing changes."""
    if not strict:
        return df.withColumn("issues", F.expr("cast(array() as array<string>)"))
    found = F.array_compact(F.array(*[F.when(F.col(c) == 0, f"ZERO_{c.upper()}_AMBIGUOUS") for c in columns]))
    out = df.withColumn("issues", found)
    return out.withColumns({c: F.when(F.col(c) != 0, F.col(c)) for c in columns})


def parse_analytics(df: DataFrame, payload: str) -> DataFrame:
    """IV and Greeks from a nested (``greeks``) or flat payload, with status and error."""
    doc = F.col(payload)
    cols = {"iv": _aliased(doc, "$.data", ("implied_volatility", "iv"))}
    for g in ANALYTIC_GREEKS:
        cols[g] = F.coalesce(json_number(doc, f"$.data.greeks.{g}"), json_number(doc, f"$.greeks.{g}"), json_number(doc, f"$.data.{g}"))
    out = df.withColumns(cols)
    status, error = analytics_status(
        F.col("iv"), [F.col(g) for g in ANALYTIC_GREEKS], doc.isNotNull(), F.get_json_object(doc, "$.error")
    )
    return out.withColumns({"analytics_status": status, "error_class": error})


CANDLE = "struct<timestamp:timestamp,open:double,high:double,low:double,close:double,volume:double,oi:double>"


def explode_candles(df: DataFrame, payload: str, slot_seconds: int = 5) -> DataFrame:
    """One row per candle with ``reason`` (NULL = good); a zero OI becomes NULL.

    Times must be slot-aligned and unique inside their payload; prices positive
    with low <= open, close <= high.
    """
    parsed = df.withColumn("_c", F.from_json(payload, f"array<{CANDLE}>"))
    times = F.transform("_c", lambda c: us(c["timestamp"]))
    rows = parsed.withColumn("_times", times).select(*df.columns, "_times", F.inline("_c"))
    c = F.col
    copies = F.size(F.filter("_times", lambda t: t == us("timestamp")))
    aligned = F.pmod(us("timestamp"), F.lit(slot_seconds * 1_000_000).cast("bigint")) == 0
    positive = F.lit(True)
    for n in ("open", "high", "low", "close"):
        positive = positive & F.coalesce(finite(c(n)) > 0, F.lit(False))
    shape = (c("low") <= F.least("open", "close")) & (F.greatest("open", "close") <= c("high"))
    count_ok = c("volume").isNull() | F.coalesce((c("volume") >= 0) & (c("volume") == F.floor("volume")), F.lit(False))
    reason = (
        F.when(c("timestamp").isNull() | ~F.coalesce(aligned, F.lit(False)), "HistoryTimestamp")
        .when(copies > 1, "HistoryTimestamp")
        .when(~positive, "InvalidNumber")
        .when(~F.coalesce(shape, F.lit(False)), "InvalidOHLC")
        .when(~count_ok, "InvalidCount")
    )
    return rows.withColumn("reason", reason).withColumn("oi", F.when(c("oi") != 0, c("oi"))).drop("_times")


# Landed envelopes -----------------------------------------------------------------

_OPTION = "struct<symbol:string,side:string,ltp:double,oi:double,volume:double,bid:double,ask:double>"
_VALUES = (
    "struct<iv:double,delta:double,gamma:double,theta:double,vega:double,rho:double,option_price:double,"
    "forward_price:double,spot_price:double,interest_rate:double>"
)
ENVELOPE_SCHEMA = (
    "struct<version:int,kind:string,scheduled_at:timestamp,started_at:timestamp,received_at:timestamp,body:struct<"
    "symbol:string,spot_ltp:double,expiry:string,strike:double,"
    f"options:array<{_OPTION}>,freshness:string,issues:array<string>,"
    f"raw_key:string,raw_digest:string,raw_received_at:timestamp,side:string,`values`:{_VALUES}>>"
)
RAW_FIELDS = ("expiry", "freshness", "issues", "options", "spot_ltp", "strike", "symbol")
OPTION_FIELDS = ("ask", "bid", "ltp", "oi", "side", "symbol", "volume")


def read_envelopes(df: DataFrame, payload: str) -> DataFrame:
    """Parse landed observation lines: typed fields plus ``key`` and ``digest``.

    The key is the hash of (kind, schedule, symbol): one slot and contract can
    never hold two different values. The digest is that of the stored text.
    """
    doc = F.from_json(payload, ENVELOPE_SCHEMA)
    key = F.sha2(
        F.to_json(
            F.array(
                F.get_json_object(payload, "$.kind"),
                F.get_json_object(payload, "$.scheduled_at"),
                F.get_json_object(payload, "$.body.symbol"),
            )
        ),
        256,
    )
    body_fields = F.array_sort(F.json_object_keys(F.get_json_object(payload, "$.body")))
    return df.withColumn("_doc", doc).select(
        *df.columns, "_doc.*", key.alias("key"), F.sha2(F.col(payload), 256).alias("digest"), body_fields.alias("body_fields")
    )


def _whole_count(value: Column) -> Column:
    return F.coalesce((value >= 0) & (value <= MAX_EXACT_INTEGER) & (value == F.floor(value)), F.lit(False))


def raw_contract(underlying: str, max_late_seconds: float = 5, zone: str = "Asia/Kolkata") -> list[Rule]:
    """Reasons a RAW observation breaks its contract, in order."""
    c = F.col
    body = c("body")
    clocks = (c("scheduled_at") <= c("started_at")) & (c("started_at") <= c("received_at"))
    late = (
        ~in_session("scheduled_at", zone)
        | ~in_session("received_at", zone)
        | (us("received_at") - us("scheduled_at") >= int(max_late_seconds * 1_000_000))
    )
    expiry = parse_expiry(body["expiry"])
    options = body["options"]
    sides = F.transform(options, lambda o: o["side"])

    def any_leg(test) -> Column:
        return F.exists(options, lambda o: F.coalesce(test(o), F.lit(True)))

    def bad_optional(value: Column) -> Column:
        return value.isNotNull() & ~F.coalesce(finite(value) > 0, F.lit(False))

    return [
        Rule("UnknownContract", ~((c("version") == 2) & c("scheduled_at").isNotNull() & body.isNotNull())),
        Rule("InvertedTimestamps", ~F.coalesce(clocks, F.lit(False))),
        Rule("UnexpectedRawField", ~F.coalesce(c("body_fields") == F.array(*[F.lit(f) for f in RAW_FIELDS]), F.lit(False))),
        Rule(
            "UnsubstantiatedProvenance",
            ~(body["symbol"].eqNullSafe(F.lit(underlying)) & body["freshness"].eqNullSafe(F.lit("UNVERIFIED_PROVIDER_TIME"))),
        ),
        Rule("LateOrOffSessionResponse", F.coalesce(late, F.lit(True))),
        Rule("InvalidNumber", ~F.coalesce(finite(body["spot_ltp"]) > 0, F.lit(False))),
        Rule("InvalidCount", ~((body["strike"] > 0) & _whole_count(body["strike"]))),
        Rule("ExpiredContract", ~F.coalesce(expiry >= local_date("received_at", zone), F.lit(False))),
        Rule("InvalidPair", ~F.coalesce(sides == F.array(F.lit("CE"), F.lit("PE")), F.lit(False))),
        Rule("ContractMismatch", any_leg(lambda o: ~is_contract_symbol(o["symbol"], body["symbol"], expiry, body["strike"], o["side"]))),
        Rule("InvalidNumber", any_leg(lambda o: ~F.coalesce(finite(o["ltp"]) > 0, F.lit(False)))),
        Rule("AmbiguousZero", any_leg(lambda o: F.coalesce(o["oi"] == 0, F.lit(False)) | F.coalesce(o["volume"] == 0, F.lit(False)))),
        Rule(
            "InvalidCount",
            any_leg(lambda o: (o["oi"].isNotNull() & ~_whole_count(o["oi"])) | (o["volume"].isNotNull() & ~_whole_count(o["volume"]))),
        ),
        Rule("InvalidNumber", any_leg(lambda o: bad_optional(o["bid"]) | bad_optional(o["ask"]))),
        Rule("CrossedQuote", any_leg(lambda o: F.coalesce(o["bid"] > o["ask"], F.lit(False)))),
        Rule("UnsafeIssue", F.exists(body["issues"], lambda i: ~F.coalesce(i.rlike("^[A-Z_]+$"), F.lit(False)))),
    ]


def derived_contract(underlying: str, max_seconds: float = 3, zone: str = "Asia/Kolkata") -> list[Rule]:
    """Reasons a DERIVED observation breaks its contract, in order."""
    c = F.col
    body = c("body")
    v = body["values"]
    expiry = parse_expiry(body["expiry"])
    hexes = F.lit(True)
    for n in ("raw_key", "raw_digest"):
        hexes = hexes & F.coalesce(body[n].rlike("^[0-9a-f]{64}$"), F.lit(False))
    on_time = (
        in_session("received_at", zone)
        & (body["raw_received_at"] <= c("started_at"))
        & (us("received_at") - us("started_at") <= int(max_seconds * 1_000_000))
    )
    needed = F.lit(True)
    for n in ("iv", "delta", "gamma", "theta", "vega", "rho", "option_price", "interest_rate"):
        needed = needed & finite(v[n]).isNotNull()
    prices = F.lit(True)
    for n in ("forward_price", "spot_price"):
        prices = prices & (v[n].isNull() | F.coalesce(finite(v[n]) > 0, F.lit(False)))
    wrong_sign = ((body["side"] == "CE") & (v["delta"] < 0)) | ((body["side"] == "PE") & (v["delta"] > 0))
    clocks = (c("scheduled_at") <= c("started_at")) & (c("started_at") <= c("received_at"))
    return [
        Rule("UnknownContract", ~((c("version") == 2) & body.isNotNull())),
        Rule("InvertedTimestamps", ~F.coalesce(clocks, F.lit(False))),
        Rule("ContractMismatch", ~is_contract_symbol(body["symbol"], F.lit(underlying), expiry, body["strike"], body["side"])),
        Rule("InvalidParentIdentity", ~hexes),
        Rule("LateCalculation", ~F.coalesce(on_time, F.lit(False))),
        Rule("MissingCalculationInputs", v.isNull()),
        Rule("InvalidNumber", ~(needed & prices)),
        Rule("MissingCalculationPrice", v["forward_price"].isNull() & v["spot_price"].isNull()),
        Rule("InvalidCalculation", (v["iv"] <= 0) | (v["option_price"] <= 0) | (v["gamma"] < 0) | (v["vega"] < 0)),
        Rule("InvalidDelta", ~v["delta"].between(-1, 1) | F.coalesce(wrong_sign, F.lit(False))),
    ]
