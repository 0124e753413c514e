"""Lagged and contemporaneous relationship studies over quote midpoints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.functions.clock import days_to_expiry, floor_to, to_us, us
from tickevidence.operators.asof import asof_available, asof_backward, asof_roles
from tickevidence.operators.sampling import midpoint, pct_change
from tickevidence.operators.segments import greedy_spacing, with_segments
from tickevidence.operators.stats import correlations, unpivot, with_pooled

# Features of the lagged study.
LAGGED_FEATURES = (
    "past_spot_return_pct", "past_midpoint_return_pct", "past_oi_change_pct", "past_volume_increment",
    "iv_decimal", "past_iv_change_pp", "delta", "gamma", "theta_daily_pct_midpoint",
    "vega_pct_midpoint_per_iv_pp", "spread_pct", "spot_moneyness_pct", "days_to_expiry",
)
TARGET = "future_midpoint_return_pct"


@dataclass(frozen=True)
class StudyPolicy:
    step_seconds: float = 60
    quote_age: float = 5
    max_gap: float = 10
    calculation_age: float = 10
    source_age: float = 15
    start_age: float = 65
    block_seconds: float | None = None


def _quotes(tape: DataFrame, policy: StudyPolicy, by: list[str]) -> DataFrame:
    return with_segments(
        tape.withColumn("midpoint", midpoint(F.col("bid"), F.col("ask"))),
        by=by,
        time="timestamps",
        tie="observation_id",
        max_gap=policy.max_gap,
        contract="contract_key",
        block_seconds=policy.block_seconds,
    )


def clock_grid(quotes: DataFrame, by: list[str], step: float, last: str = "floor") -> DataFrame:
    """Steps from the first quote rounded up to the last one rounded down (or up)."""
    size = F.lit(to_us(step)).cast("bigint")
    ends = quotes.groupBy(*by).agg(F.min(us("timestamps")).alias("_a"), F.max(us("timestamps")).alias("_b"))
    first = -floor_to(-F.col("_a"), to_us(step))
    final = floor_to(F.col("_b"), to_us(step)) if last == "floor" else -floor_to(-F.col("_b"), to_us(step))
    ticks = F.when(first <= final, F.sequence(first, F.greatest(first, final), size))
    return ends.select(*by, F.explode(ticks).alias("clock_us")).withColumn(
        "clock", F.timestamp_micros("clock_us")
    )


def lagged_windows(tape: DataFrame, policy: StudyPolicy) -> DataFrame:
    """Every clock step with its past, current and future quote, and a reject reason.

    ``reason`` is NULL for a selected window. All three quotes must be fresh and in
    one segment. A calculation counts from its own availability (the later of IV
    and Greeks, both required), inside the quote's segment.
    """
    by = ["underlying", "trading_date", "optiontype"]
    quotes = _quotes(tape, policy, by)
    payload = [
        "observation_id", "contract_key", "segment", "spot", "midpoint", "bid", "ask", "oi", "volume",
        "strike", "expirydate",
    ]
    step = float(policy.step_seconds)
    grid = clock_grid(quotes, by, step)
    found = asof_roles(
        grid,
        quotes,
        by=by,
        probe_time="clock",
        series_time="timestamps",
        roles={"past": -step, "now": 0.0, "future": step},
        tolerance=policy.quote_age,
        payload=payload,
        block_seconds=policy.block_seconds,
    )
    roles = ("past", "now", "future")
    absent = F.lit(False)
    for r in roles:
        absent = absent | F.col(f"{r}.at_us").isNull()
    moved = (F.col("past.segment") != F.col("now.segment")) | (F.col("now.segment") != F.col("future.segment"))
    reason = F.when(absent, "missing_or_old_quote").when(moved, "segment_change")
    rows = found.withColumn("reason", reason)
    calcs = quotes.filter(F.col("iv_available_at").isNotNull() & F.col("greeks_available_at").isNotNull()).withColumn(
        "available_at", F.greatest("iv_available_at", "greeks_available_at")
    )
    cols = ["observation_id", "iv", "delta", "gamma", "theta", "vega"]
    for role in ("now", "past"):
        rows = rows.withColumn("segment", F.col(f"{role}.segment")).withColumn(
            "_at", F.timestamp_micros(F.coalesce(f"{role}.at_us", "clock_us"))
        )
        rows = asof_available(
            rows,
            calcs.select(*by, "segment", "timestamps", "available_at", *cols),
            by=[*by, "segment"],
            probe_time="_at",
            available="available_at",
            observed="timestamps",
            available_age=policy.calculation_age,
            source_age=policy.source_age,
            payload=cols,
            strict=False,
            block_seconds=policy.block_seconds,
        ).withColumnRenamed("calc", f"_{role}_calc").drop("segment", "_at")
    return rows


def lagged_features(windows: DataFrame) -> DataFrame:
    """Features and target of the selected windows; missing inputs stay NULL."""
    now, past, future = F.col("now"), F.col("past"), F.col("future")
    calc, old = F.col("_now_calc"), F.col("_past_calc")
    mid = now["midpoint"]

    def per_mid(value: Column) -> Column:
        return F.when(mid > 0, 100 * value / mid)

    values = {
        "past_spot_return_pct": pct_change(now["spot"], past["spot"]),
        "past_midpoint_return_pct": pct_change(mid, past["midpoint"]),
        "past_oi_change_pct": pct_change(now["oi"], past["oi"]),
        "past_volume_increment": F.when(
            now["volume"] >= past["volume"], (now["volume"] - past["volume"]).cast("double")
        ),
        "iv_decimal": calc["iv"],
        "past_iv_change_pp": 100 * (calc["iv"] - old["iv"]),
        "delta": calc["delta"],
        "gamma": calc["gamma"],
        "theta_daily_pct_midpoint": per_mid(calc["theta"]),
        "vega_pct_midpoint_per_iv_pp": per_mid(calc["vega"]),
        "spread_pct": per_mid(now["ask"] - now["bid"]),
        "spot_moneyness_pct": F.when(now["strike"] != 0, 100 * (now["spot"] / now["strike"] - 1)),
        "days_to_expiry": days_to_expiry(now["expirydate"], F.timestamp_micros(now["at_us"])),
        TARGET: pct_change(future["midpoint"], mid),
    }
    chosen = windows.filter(F.col("reason").isNull())
    return chosen.select(
        "underlying",
        "trading_date",
        "optiontype",
        "clock_us",
        now["contract_key"].alias("contract_key"),
        ((future["at_us"] - now["at_us"]) / F.lit(1e6)).alias("future_seconds"),
        *[v.alias(k) for k, v in values.items()],
    )


def selection_counts(windows: DataFrame, reasons: tuple[str, ...]) -> DataFrame:
    """Clock candidates, each rejection and the selected windows per (day, side)."""
    return windows.groupBy("underlying", "trading_date", "optiontype").agg(
        F.count(F.lit(1)).alias("clock_candidates"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in reasons],
        F.count_if(F.col("reason").isNull()).alias("selected"),
    )


def lagged_correlations(samples: DataFrame) -> DataFrame:
    """Pearson and Spearman of each feature with the target, per day and pooled, by side."""
    long = unpivot(samples, ["trading_date", "optiontype", TARGET], list(LAGGED_FEATURES), "feature", "value")
    pooled = with_pooled(long, "trading_date")
    return correlations(pooled, ["trading_date", "optiontype", "feature"], "value", TARGET)


def contemporaneous_windows(tape: DataFrame, policy: StudyPolicy) -> DataFrame:
    """Non-overlapping windows that end at clock steps, with reject reasons.

    The end is the last quote at or before the step; the start is the last quote a
    full step before the end's receipt. Overlap is judged greedily per (day, side)
    on otherwise good windows, at most one per clock step of a session.
    """
    by = ["underlying", "trading_date", "optiontype"]
    quotes = _quotes(tape, policy, by)
    payload = ["observation_id", "contract_key", "segment", "spot", "midpoint", "ltp", "bid", "ask"]
    step = float(policy.step_seconds)
    ends = asof_backward(
        clock_grid(quotes, by, step, last="ceil"),
        quotes,
        by=by,
        probe_time="clock",
        series_time="timestamps",
        tolerance=policy.quote_age,
        payload=payload,
        prefix="end_",
        block_seconds=policy.block_seconds,
    )
    probes = ends.withColumn("_end_at", F.timestamp_micros(F.coalesce("end_at_us", "clock_us")))
    both = asof_roles(
        probes,
        quotes,
        by=by,
        probe_time="_end_at",
        series_time="timestamps",
        roles={"start": -step},
        tolerance=policy.start_age - step,
        payload=payload,
        block_seconds=policy.block_seconds,
    )
    reason = (
        F.when(F.col("end_at_us").isNull(), "end_too_old")
        .when(F.col("start.at_us").isNull(), "no_start_in_time")
        .when(F.col("start.segment") != F.col("end_segment"), "segment_changed")
    )
    flat = both.withColumn("reason", reason).withColumn(
        "start_at_us", F.when(F.col("end_at_us").isNotNull(), F.col("start.at_us"))
    )
    good = greedy_spacing(
        flat.filter(F.col("reason").isNull()).select(*by, "clock_us", "start_at_us", "end_at_us"),
        by=by,
        start="start_at_us",
        end="end_at_us",
        flag="_kept",
        carry=["clock_us"],
    ).select(*by, "clock_us", "_kept")
    joined = flat.join(good, [*by, "clock_us"], "left")
    overlap = F.when(~F.coalesce("_kept", F.lit(True)), "overlap_excluded")
    return joined.select(
        *by,
        "clock_us",
        "start_at_us",
        "end_at_us",
        ((F.col("end_at_us") - F.col("start_at_us")) / F.lit(1e6)).alias("seconds"),
        F.col("end_contract_key").alias("contract_key"),
        (F.col("end_spot") - F.col("start.spot")).alias("spot_change"),
        (F.col("end_midpoint") - F.col("start.midpoint")).alias("midpoint_change"),
        (F.col("end_ltp") - F.col("start.ltp")).alias("ltp_change"),
        F.coalesce("reason", overlap).alias("reason"),
    )
