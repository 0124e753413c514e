"""Quote cleaning: typed observations and options, quarantine, exact reconciliation.

Text rows in, three tables out. Exact copies are counted by grouping on the raw
text (copies of one row combine before the shuffle); natural-key conflicts are
counted per (key, salt) so that one repeated key cannot fill a task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions import parsing as P
from tickevidence.functions.clock import days_to_expiry
from tickevidence.functions.greeks import with_greeks
from tickevidence.session import stage_table

# Required and ignored headers, and the accepted header spellings.
REQUIRED = ("timestamps", "spot", "strike", "optiontype", "expirydate")
DERIVED_INPUTS = ("delta", "theta", "gamma", "vega", "daystoexpiry", "days_to_expiry")
ALIASES = {
    "timestamps": ("timestamps", "timestamp", "timestaps", "ts", "event_timestamp"),
    "spot": ("spot", "spot_price", "underlying_price"),
    "iv": ("iv", "implied_volatility"),
    "volume": ("volume", "option_volume"),
    "oi": ("oi", "open_interest"),
    "ltp": ("ltp", "last_price", "last_traded_price"),
    "strike": ("strike", "strike_price"),
    "optiontype": ("optiontype", "option_type", "right"),
    "expirydate": ("expirydate", "expiry_date", "expiry"),
    "underlying": ("underlying", "underlying_symbol"),
    "symbol": ("symbol", "option_symbol", "tradingsymbol", "trading_symbol"),
    "exchange": ("exchange",),
    "timestamp_source": ("timestamp_source",),
    "provider_timestamp": ("provider_timestamp",),
    "data_status": ("data_status",),
    "source_receipt_id": ("source_receipt_id",),
    "source_freshness": ("source_freshness",),
    "source_version": ("source_version",),
}
CANONICAL = tuple(ALIASES)
CONFLICT = "conflicting_or_repeated_natural_key: all matching rows quarantined"
NATURAL_KEY = ("timestamps", "underlying", "symbol", "exchange", "strike", "optiontype", "expirydate")
SALTS = 32


@dataclass(frozen=True)
class CleaningPolicy:
    input_zone: str = "Asia/Kolkata"
    timestamp_unit: str | None = None
    iv_unit: str = "decimal"
    expiry_clock: str = P.EXPIRY_CLOCK
    expiry_zone: str = P.EXPIRY_ZONE
    drop_exact_duplicates: bool = True
    derive_greeks: bool = False
    risk_free_rate: float | None = None
    dividend_yield: float | None = None
    max_quarantine_fraction: float = 0.05

    def __post_init__(self) -> None:
        if self.iv_unit not in ("decimal", "percent"):
            raise ValueError("iv_unit must be decimal or percent")


# Columns of the two cleaned tables.
OBSERVATION_SCHEMA = (
    "observation_id string, source_row bigint, timestamps timestamp, underlying string, symbol string, exchange string, "
    "spot double, iv double, volume bigint, timestamp_source string, source_receipt_id string, source_freshness string, "
    "source_version string, provider_timestamp timestamp, data_status string"
)
OPTION_SCHEMA = (
    "observation_id string, timestamps timestamp, underlying string, symbol string, exchange string, oi bigint, ltp double, "
    "strike double, optiontype string, expirydate timestamp, daystoexpiry double, delta double, theta double, gamma double, "
    "vega double, greeks_source string, derivation_status string"
)


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


@dataclass
class Cleaned:
    """``accepted`` holds every typed column; the two tables are projections of it."""

    accepted: DataFrame
    quarantine: DataFrame
    counts: DataFrame

    @property
    def observations(self) -> DataFrame:
        return self.accepted.select(*names_of(OBSERVATION_SCHEMA))

    @property
    def options(self) -> DataFrame:
        return self.accepted.select(*names_of(OPTION_SCHEMA))


def plain_header(name: str) -> str:
    return re.sub(r"[\s_-]+", "", name.strip().lower())


def header_mapping(columns: list[str]) -> dict[str, str]:
    """Source header to canonical name. Two headers for one target are an error."""
    known = {plain_header(alias): target for target, names in ALIASES.items() for alias in names}
    mapping = {c: known[plain_header(c)] for c in columns if plain_header(c) in known}
    check_mapping(mapping, columns)
    return mapping


def check_mapping(mapping: dict[str, str], columns: list[str]) -> None:
    """Targets unique and canonical, sources present, no collision after renaming."""
    if len(set(columns)) != len(columns):
        raise ValueError("duplicate column names")
    if len(set(mapping.values())) != len(mapping):
        raise ValueError("two columns map to one canonical target")
    if not set(mapping.values()) <= set(CANONICAL):
        raise ValueError("unsupported canonical target")
    if not set(mapping) <= set(columns):
        raise ValueError("mapping names an absent column")
    renamed = [mapping.get(c, c) for c in columns]
    if len(set(renamed)) != len(renamed):
        raise ValueError("mapping collides with another column")


def header_report(columns: list[str]) -> dict[str, list[str]]:
    """Mapped, unknown, derived-and-ignored and missing required headers."""
    mapping = header_mapping(columns)
    derived = {plain_header(name) for name in DERIVED_INPUTS}
    rest = [c for c in columns if c not in mapping]
    return {
        "mapped": sorted(mapping),
        "unknown": [c for c in rest if plain_header(c) not in derived],
        "ignored_derived": [c for c in rest if plain_header(c) in derived],
        "missing_required": sorted(set(REQUIRED) - set(mapping.values())),
    }


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """One projection: aliases applied, absent canonical inputs added as NULL."""
    check_mapping(mapping, df.columns)
    present = set(mapping.values())
    return df.select(
        *[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns],
        *[F.lit(None).cast("string").alias(c) for c in CANONICAL if c not in present and c not in df.columns],
    )


def deduplicate(df: DataFrame, *, content: list[str], order: str) -> DataFrame:
    """Exact copies collapse to the one with the smallest ``order``; adds ``copies``."""
    return df.groupBy(*content).agg(F.min(order).alias(order), F.count(F.lit(1)).alias("copies"))


def with_key_count(df: DataFrame, keys: list[str], salt_from: str, name: str = "key_count") -> DataFrame:
    """Add the number of rows sharing ``keys`` (NULLs are equal), safely for hot keys.

    Rows are counted per (key, salt); at most ``SALTS`` such counts exist per key
    and only those meet in one task. The total goes back by (key, salt), so a hot
    key is spread over all salts on both sides of the join.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(SALTS)).cast("int"))
    part = salted.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    totals = part.withColumn(name, F.sum("_n").over(W.partitionBy(*keys))).drop("_n")
    side = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_salt").alias("_k_salt"), name
    )
    cond = F.col("_salt") == F.col("_k_salt")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return salted.join(side, cond, "left").drop("_salt", "_k_salt", *[f"_k_{k}" for k in keys])


def stable_id(fields: dict[str, Column]) -> Column:
    """Hash of content only: alphabetical JSON with NULLs kept, values as text."""
    items = [c.cast("string").alias(n) for n, c in sorted(fields.items())]
    return F.sha2(F.to_json(F.struct(*items), {"ignoreNullFields": "false"}), 256)


def normalize(df: DataFrame, policy: CleaningPolicy) -> DataFrame:
    """Typed columns plus ``identity_reason`` and ``value_reason`` (first failure each)."""
    c = F.col
    clocks = {"zone": policy.input_zone, "unit": policy.timestamp_unit}
    parsed = P.apply_stages(
        df,
        [
            P.timestamp("timestamps", **clocks),
            P.expiry("expirydate", clock=policy.expiry_clock, zone=policy.expiry_zone),
            P.side("optiontype"),
            P.number("strike", required=True, positive=True),
            P.number("spot", required=True, positive=True),
            P.number("iv", positive=True),
            P.number("volume", integer=True),
            P.number("oi", integer=True),
            P.number("ltp"),
            P.timestamp("provider_timestamp", required=False, **clocks),
        ],
    )
    percent = policy.iv_unit == "percent"
    late = F.when(c("expirydate") < c("timestamps"), "expirydate: expiry precedes observation timestamp")
    iv_zero = F.when(c("iv") <= 0, "iv: outside supported numeric range after unit conversion")
    names = ("timestamps", "expirydate", "optiontype", "strike", "spot", "iv", "volume", "oi", "ltp", "provider_timestamp")
    texts = {n: P.text_or(c(n)) for n in ("underlying", "symbol", "exchange", "source_receipt_id", "source_freshness", "source_version")}
    texts |= {n: P.text_or(c(n), "unspecified") for n in ("timestamp_source", "data_status")}
    scaled = parsed.withColumns({"iv": c("iv") / 100.0 if percent else c("iv"), **texts})
    kept = [x for x in df.columns if x not in names]
    return scaled.select(
        *kept,
        *names,
        F.coalesce(c("_r_timestamps"), c("_r_expirydate"), late, c("_r_optiontype"), c("_r_strike")).alias("identity_reason"),
        F.coalesce(
            c("_r_spot"), c("_r_iv"), iv_zero, *[c(f"_r_{n}") for n in ("volume", "oi", "ltp", "provider_timestamp")]
        ).alias("value_reason"),
        days_to_expiry(c("expirydate"), c("timestamps")).alias("daystoexpiry"),
    )


def clean(
    df: DataFrame, policy: CleaningPolicy, *, source_row: str = "source_row", by: tuple[str, ...] = ()
) -> Cleaned:
    """Clean a renamed text table.

    ``source_row`` is a supplied ordinal; it decides which exact copy is first and
    names quarantined rows; ``by`` names pass-through columns to report counts by
    (a supplied trading date, say). A row whose identity is valid takes part in conflict
    detection even when its values are bad.
    """
    content = [c for c in df.columns if c != source_row]
    raw_json = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(content)]), {"ignoreNullFields": "false"})
    if policy.drop_exact_duplicates:
        rows = deduplicate(df, content=content, order=source_row)
    else:
        rows = df.withColumn("copies", F.lit(1).cast("bigint"))
    typed = normalize(rows.withColumn("raw_record_json", raw_json), policy)
    # Rows without an identity have no natural key; the flag keeps them apart.
    typed = typed.withColumn("_keyless", F.col("identity_reason").isNotNull())
    counted = with_key_count(typed, [*NATURAL_KEY, "_keyless"], source_row)
    conflict = F.when((F.col("key_count") > 1) & ~F.col("_keyless"), F.lit(CONFLICT))
    judged = counted.withColumn("reason", F.coalesce("identity_reason", "value_reason", conflict))
    # Three results come from this table: store it once rather than parse three times.
    judged = stage_table(judged.drop("identity_reason", "value_reason", "key_count", "_keyless"), "judged")
    ok = judged.filter(F.col("reason").isNull())
    identity_fields = [
        "timestamps", "expirydate", "strike", "optiontype", "daystoexpiry", "underlying", "symbol", "exchange",
        "spot", "iv", "volume", "oi", "ltp", "timestamp_source", "data_status", "provider_timestamp",
        "source_receipt_id", "source_freshness", "source_version",
    ]
    named = ok.withColumn("observation_id", stable_id({n: F.col(n) for n in identity_fields}))
    accepted = with_greeks(
        named, spot="spot", strike="strike", iv="iv", days="daystoexpiry", side="optiontype",
        derive=policy.derive_greeks, rate=policy.risk_free_rate, dividend=policy.dividend_yield,
    ).withColumn(
        "greeks_source",
        F.when(F.col("derivation_status") == "derived", "black_scholes_european").otherwise("unavailable"),
    )
    counts = judged.groupBy(*by).agg(
        F.sum("copies").alias("input_rows"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
        F.sum(F.col("copies") - 1).alias("duplicates_removed"),
    )
    return Cleaned(
        accepted.drop("copies", "reason"),
        judged.filter(F.col("reason").isNotNull()).select(*by, source_row, "reason", "raw_record_json"),
        run_gate(counts, policy),
    )


def run_gate(counts: DataFrame, policy: CleaningPolicy, source_ok: bool = True) -> DataFrame:
    """Counts with the reconciliation flag, quarantine share and the publish decision."""
    total = F.col("accepted") + F.col("quarantined") + F.col("duplicates_removed")
    share = F.try_divide("quarantined", "input_rows")
    out = counts.withColumn("reconciled", total == F.col("input_rows")).withColumn(
        "quarantine_fraction", share
    )
    return out.withColumn(
        "passed",
        F.col("reconciled")
        & (F.col("accepted") > 0)
        & F.coalesce(F.col("quarantine_fraction") <= policy.max_quarantine_fraction, F.lit(False))
        & F.lit(source_ok),
    )


def profile(df: DataFrame) -> DataFrame:
    """Per column: type and null count; plus the row and exact-duplicate counts.

    No values leave the cluster. Copies are counted by row hash, combined map-side.
    """
    total = F.count(F.lit(1))
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    single = df.agg(total.alias("rows"), *nulls)
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    copies = df.groupBy(digest.alias("_h")).agg(total.alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("d")
    ).scalar()
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(t).alias("type"),
                F.col(f"n{i}").alias("nulls"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return single.withColumn("duplicate_rows", copies).select("rows", "duplicate_rows", F.inline(items))
