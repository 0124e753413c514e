"""Returns, averages, open-interest features and forward outcomes of a price series.

Their formulas are this library's own reading of a declared table layout; the
definitions are stated with each function.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import block_of, to_us, us
from tickevidence.operators.asof import asof_roles
from tickevidence.operators.segments import with_previous

# Return lags, average spans, warm-up and outcome horizons (seconds).
RETURN_LAGS = {"ret_5s": 5, "ret_30s": 30, "ret_1m": 60, "ret_3m": 180, "ret_5m": 300}
EMA_SPANS = (5, 20, 50)
MIN_EMA_POINTS = 50
HORIZONS = {"30s": 30, "1m": 60, "3m": 180, "5m": 300, "10m": 600}
CLOSE_BUFFER = 300


def log_returns(
    series: DataFrame,
    *,
    by: list[str],
    time: str,
    price: str,
    lags: dict[str, float] = RETURN_LAGS,
    tolerance: float = 5,
    block_seconds: float | None = None,
) -> DataFrame:
    """``ln(price / price at t - lag)``; NULL without a fresh positive earlier price."""
    past = asof_roles(
        series,
        series,
        by=by,
        probe_time=time,
        series_time=time,
        roles={name: -float(lag) for name, lag in lags.items()},
        tolerance=tolerance,
        payload=[price],
        block_seconds=block_seconds,
    )
    ratios = {
        name: F.when(
            (F.col(f"{name}.{price}") > 0) & (F.col(price) > 0), F.ln(F.col(price) / F.col(f"{name}.{price}"))
        )
        for name in lags
    }
    return past.withColumns(ratios)


def exponential_averages(
    series: DataFrame,
    *,
    by: list[str],
    time: str,
    price: str,
    keep: list[str],
    spans: tuple[int, ...] = EMA_SPANS,
    min_points: int = MIN_EMA_POINTS,
) -> DataFrame:
    """EMA with weight 2 / (n + 1) from the first value; slope and distance.

    NULL until ``min_points`` values are seen. The recursion runs in Arrow batches
    per key; ``by`` must hold a session date and rows must be one per slot, so a
    group is at most one session of slots.
    """
    kept = [c for c in [*by, time, price, *keep] if c in series.columns]
    fields = [series.schema[c] for c in dict.fromkeys(kept)]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    out += "".join(f", ema_{n} double, ema_{n}_slope double, dist_ema_{n} double" for n in spans)
    names = [f.name for f in fields]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(time, kind="stable").reset_index(drop=True)
        warm = pd.Series(range(1, len(ordered) + 1)) >= min_points
        for n in spans:
            level = ordered[price].ewm(span=n, adjust=False).mean()
            ordered[f"ema_{n}"] = level.where(warm)
            ordered[f"ema_{n}_slope"] = level.diff().where(warm)
            ordered[f"dist_ema_{n}"] = (ordered[price] - level).where(warm)
        return ordered

    return series.select(*names).groupBy(*by).applyInPandas(run, out)


def option_pressure(tape: DataFrame, *, block_seconds: float) -> DataFrame:
    """Open-interest, IV, put/call and spread features per receipt.

    Legs are pivoted per receipt, changes are against the previous receipt of the
    same (underlying, day). ``*_rate`` is a percent change, put/call ratios are PE
    over CE, spreads are the mean of both legs.
    """
    by = ["underlying", "trading_date"]

    def leg(side: str, col: str) -> Column:
        return F.max(F.when(F.col("optiontype") == side, F.col(col)))

    wide = tape.groupBy(*by, "timestamps").agg(
        *[
            leg(s, c).alias(f"{s.lower()}_{c}")
            for s in ("CE", "PE")
            for c in ("oi", "volume", "iv", "bid", "ask")
        ]
    )
    cols = ["ce_oi", "pe_oi", "ce_iv", "pe_iv"]
    rows = with_previous(wide, by=by, time="timestamps", tie="timestamps", payload=cols, block_seconds=block_seconds)

    def change(c: str) -> Column:
        return F.col(c) - F.col(f"previous.{c}")

    def rate(c: str) -> Column:
        old = F.col(f"previous.{c}")
        return F.when(old > 0, 100 * (F.col(c).cast("double") / old.cast("double") - 1))

    pcr = F.try_divide(F.col("pe_oi").cast("double"), F.col("ce_oi").cast("double"))
    old_pcr = F.try_divide(F.col("previous.pe_oi").cast("double"), F.col("previous.ce_oi").cast("double"))
    spread = {s: F.col(f"{s}_ask") - F.col(f"{s}_bid") for s in ("ce", "pe")}
    mid = {s: (F.col(f"{s}_ask") + F.col(f"{s}_bid")) / 2 for s in ("ce", "pe")}
    share = {s: F.when(mid[s] > 0, 100 * spread[s] / mid[s]) for s in ("ce", "pe")}
    return rows.select(
        *by,
        "timestamps",
        change("ce_oi").alias("atm_ce_oi_change"),
        change("pe_oi").alias("atm_pe_oi_change"),
        rate("ce_oi").alias("atm_ce_oi_change_rate"),
        rate("pe_oi").alias("atm_pe_oi_change_rate"),
        (change("ce_oi") + change("pe_oi")).alias("total_oi_change"),
        change("ce_iv").alias("atm_ce_iv_change"),
        change("pe_iv").alias("atm_pe_iv_change"),
        ((change("ce_iv") + change("pe_iv")) / 2).alias("atm_iv_avg_change"),
        pcr.alias("pcr_oi"),
        F.try_divide(F.col("pe_volume").cast("double"), F.col("ce_volume").cast("double")).alias("pcr_volume"),
        (pcr - old_pcr).alias("pcr_oi_change"),
        ((spread["ce"] + spread["pe"]) / 2).alias("atm_spread_pts"),
        ((share["ce"] + share["pe"]) / 2).alias("atm_spread_pct"),
    )


def forward_outcomes(
    series: DataFrame,
    *,
    by: list[str],
    time: str,
    price: str,
    close_us: Column,
    horizons: dict[str, float] = HORIZONS,
    tolerance: float = 5,
    close_buffer: float = CLOSE_BUFFER,
    block_seconds: float | None = None,
) -> DataFrame:
    """One row per (row, horizon) with the future price, its move and a status.

    MARKET_CLOSED when the horizon ends at or after the close; MISSING without a
    fresh later price; PARTIAL when the horizon ends within ``close_buffer`` of
    the close; else VALID. A zero move is FLAT.
    """
    found = asof_roles(
        series,
        series,
        by=by,
        probe_time=time,
        series_time=time,
        roles={f"_h{i}": float(h) for i, h in enumerate(horizons.values())},
        tolerance=tolerance,
        payload=[price],
        block_seconds=block_seconds,
    )
    items = F.array(
        *[
            F.struct(
                F.lit(label).alias("horizon_label"),
                F.lit(int(h)).alias("horizon_seconds"),
                F.lit(to_us(h)).cast("bigint").alias("_h_us"),
                F.col(f"_h{i}.{price}").alias("_future"),
                F.col(f"_h{i}.at_us").alias("_future_us"),
            )
            for i, (label, h) in enumerate(horizons.items())
        ]
    )
    rows = found.select(*by, time, price, close_us.alias("_close"), F.inline(items))
    end = us(time) + F.col("_h_us")
    later = F.col("_future_us") > us(time)
    status = (
        F.when(end >= F.col("_close"), "MARKET_CLOSED")
        .when(~F.coalesce(later, F.lit(False)), "MISSING")
        .when(end > F.col("_close") - to_us(close_buffer), "PARTIAL")
        .otherwise("VALID")
    )
    known = F.col("outcome_status").isin("VALID", "PARTIAL")
    move = F.when(known, F.col("_future") - F.col(price))
    return (
        rows.withColumn("outcome_status", status)
        .withColumn("future_return_pts", move)
        .select(
            *by,
            time,
            "horizon_label",
            "horizon_seconds",
            "outcome_status",
            F.when(known, F.col("_future")).alias("future_spot"),
            F.when(known, F.col("_future_us")).alias("future_us"),
            "future_return_pts",
            F.when(F.col(price) > 0, 100 * F.col("future_return_pts") / F.col(price)).alias("future_return_pct"),
            F.when(F.col("future_return_pts") > 0, "UP")
            .when(F.col("future_return_pts") < 0, "DOWN")
            .when(F.col("future_return_pts") == 0, "FLAT")
            .alias("future_direction"),
        )
    )


def excursions(
    series: DataFrame,
    *,
    by: list[str],
    time: str,
    price: str,
    keep: list[str],
    horizon: float,
    block_seconds: float | None = None,
) -> DataFrame:
    """Largest favourable and adverse move strictly after a row, within the horizon.

    Never below (above) zero; NULL when nothing follows in time. The series is cut at every
    multiple of the horizon, so what follows a row is the rest of its own piece and the
    beginning of the next one: two frames that only grow, however many rows a horizon holds.
    ``block_seconds`` does not matter any more: pieces are one horizon long.
    """
    hor = to_us(horizon)
    own = block_of(us(time), hor)
    here = F.struct(own.alias("blk"), F.lit(True).alias("mine"), us(time).alias("at"))
    # A row also ends frames of the piece before, which reach it a horizon after their own row.
    before = F.struct((own - 1).alias("blk"), F.lit(False).alias("mine"), (us(time) - F.lit(hor).cast("bigint")).alias("at"))
    spread = series.filter(F.col(time).isNotNull()).withColumn("_to", F.explode(F.array(here, before)))
    spread = spread.withColumns({"_blk": F.col("_to.blk"), "_mine": F.col("_to.mine"), "_at": F.col("_to.at")})
    piece = W.partitionBy(*by, "_blk")
    rest = piece.orderBy(F.desc("_at")).rangeBetween(W.unboundedPreceding, -1)
    start = piece.orderBy("_at").rangeBetween(W.unboundedPreceding, 0)
    later, next_piece = F.when(F.col("_mine"), F.col(price)), F.when(~F.col("_mine"), F.col(price))
    seen = spread.withColumns(
        {"_hi": F.max(later).over(rest), "_lo": F.min(later).over(rest), "_hi_next": F.max(next_piece).over(start), "_lo_next": F.min(next_piece).over(start)}
    )
    mine = seen.filter("_mine").withColumns({"_hi": F.greatest("_hi", "_hi_next"), "_lo": F.least("_lo", "_lo_next")})
    return mine.select(
        *by,
        time,
        *keep,
        F.when(F.col("_hi").isNotNull(), F.greatest(F.lit(0.0), F.col("_hi") - F.col(price))).alias("mfe_pts"),
        F.when(F.col("_lo").isNotNull(), F.least(F.lit(0.0), F.col("_lo") - F.col(price))).alias("mae_pts"),
    )

