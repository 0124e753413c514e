"""Point-in-time samples: clock anchors, forward outcomes, strictly earlier features."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import (
    SESSION_CLOSE,
    SESSION_OPEN,
    SESSION_ZONE,
    block_of,
    in_session,
    local_date,
    session_bounds_us,
    to_us,
    us,
)
from tickevidence.operators.asof import asof_available, default_block_us, reach_blocks
from tickevidence.operators.segments import with_segments

SIDES = ("CE", "PE")
BAND = "spot-endpoint-band-v1"
MOMENTUM = "spot-endpoint-momentum-v2"

# The feature names of a sample.
OPTION_FEATURES = (
    "past_midpoint_return_pct",
    "past_oi_change_pct",
    "past_volume_increment",
    "iv_decimal",
    "spread_pct",
    "delta",
    "gamma",
    "theta",
    "vega",
)
FEATURES = ("past_spot_change", *(f"{side}_{name}" for side in SIDES for name in OPTION_FEATURES))


@dataclass(frozen=True)
class SamplePolicy:
    """Clock policy of a sample table; seconds and price points."""

    horizon_seconds: float = 300
    anchor_seconds: float = 60
    lookback_seconds: float = 60
    quote_max_age_seconds: float = 5
    max_gap_seconds: float = 10
    min_move: float = 50
    max_move: float = 80
    analytics_max_age_seconds: float = 10
    analytics_source_max_age_seconds: float = 15
    detector_version: str = MOMENTUM
    zone: str = SESSION_ZONE
    opens: time = SESSION_OPEN
    closes: time | None = SESSION_CLOSE
    weekdays_only: bool = True
    block_seconds: float | None = None

    def __post_init__(self) -> None:
        for name, value in asdict(self).items():
            if name.endswith("_seconds") and name != "block_seconds" or name.endswith("_move"):
                if isinstance(value, bool) or not value > 0 or value == float("inf"):
                    raise ValueError(f"{name} must be a positive finite number")
        if self.detector_version not in (BAND, MOMENTUM):
            raise ValueError("unsupported event detector")
        if self.detector_version == BAND and (self.min_move, self.max_move) != (50, 80):
            raise ValueError("the band labels require min_move=50 and max_move=80")
        if self.quote_max_age_seconds >= self.horizon_seconds:
            raise ValueError("quote age must be shorter than the horizon")

    def targets(self) -> tuple[str, str]:
        """Labels that count as events."""
        if self.detector_version == BAND:
            return ("UP_50_80", "DOWN_50_80")
        return ("UP_MOMENTUM", "DOWN_MOMENTUM")


def classify_move(change: Column, policy: SamplePolicy) -> Column:
    """Label of a point change; a missing or non-finite change is UNKNOWN."""
    known = F.coalesce(F.abs(change) < F.lit(float("inf")), F.lit(False))
    size = F.abs(change)
    up = change > 0
    if policy.detector_version == MOMENTUM:
        label = F.when(
            size >= policy.min_move, F.when(up, "UP_MOMENTUM").otherwise("DOWN_MOMENTUM")
        ).otherwise("OTHER")
    else:
        label = (
            F.when(
                size.between(policy.min_move, policy.max_move),
                F.when(up, "UP_50_80").otherwise("DOWN_50_80"),
            )
            .when(size > policy.max_move, F.when(up, "UP_OVER_80").otherwise("DOWN_OVER_80"))
            .otherwise("OTHER")
        )
    return F.when(known, label).otherwise("UNKNOWN")


def pct_change(new: Column, old: Column) -> Column:
    """Percent change, defined only from a positive old value."""
    return F.when(old > 0, 100 * (new.cast("double") / old.cast("double") - 1))


def midpoint(bid: Column, ask: Column) -> Column:
    mid = (bid + ask) / 2
    return F.when((mid > 0) & (bid >= 0) & (ask >= bid), mid)


def session_filter(tape: DataFrame, policy: SamplePolicy, time_col: str = "timestamps") -> Column:
    if policy.closes is None and policy.opens == time(0, 0) and not policy.weekdays_only:
        return F.lit(True)
    closes = policy.closes or time(23, 59, 59, 999999)
    return in_session(time_col, policy.zone, policy.opens, closes, policy.weekdays_only)


def anchor_grid(days: DataFrame, policy: SamplePolicy) -> DataFrame:
    """Session clock grid of each (underlying, trading_date): open inclusive, close exclusive."""
    step = to_us(policy.anchor_seconds)
    start, end = session_bounds_us(F.col("trading_date"), policy.zone, policy.opens, policy.closes)
    ticks = F.sequence(start, end - 1, F.lit(step).cast("bigint"))
    return days.select(*days.columns, F.explode(ticks).alias("anchor_us"), end.alias("close_us"))


def receipts(tape: DataFrame) -> DataFrame:
    """One underlying value per receipt; ``conflict`` marks disagreeing prices.

    Two legs share a receipt; ids are kept per leg, so nothing is collected.
    """
    return (
        tape.groupBy("underlying", "trading_date", "timestamps")
        .agg(
            F.min("spot").alias("spot"),
            (F.min("spot") != F.max("spot")).alias("conflict"),
            *[
                F.min(F.when(F.col("optiontype") == s, F.col("observation_id"))).alias(f"_{s}")
                for s in SIDES
            ],
        )
        .withColumn("observation_ids", F.array_sort(F.array_compact(F.array(*[f"_{s}" for s in SIDES]))))
        .drop(*[f"_{s}" for s in SIDES])
    )


def spot_outcomes(
    series: DataFrame, anchors: DataFrame, policy: SamplePolicy, ids: str = "observation_ids"
) -> DataFrame:
    """Start, end, now and past spot of every anchor: one exchange, one sort.

    A series row is sent to the blocks of the anchors that can use it; the whole
    stretch between an anchor's oldest and newest row is then in one task, which
    makes locally counted segments comparable. ``now`` is the last row strictly
    before the start receipt, ``past`` the last strictly before start - lookback.
    """
    age, look = to_us(policy.quote_max_age_seconds), to_us(policy.lookback_seconds)
    hor, gap = to_us(policy.horizon_seconds), to_us(policy.max_gap_seconds)
    back, ahead = look + 2 * age, hor
    block = default_block_us(back, ahead, policy.block_seconds)
    by = ["underlying", "trading_date"]
    t_us = us("timestamps")
    rows = series.select(
        *by,
        F.explode(reach_blocks(t_us, block, back, ahead)).alias("_blk"),
        (t_us * 2).alias("_ord"),
        F.struct(t_us.alias("at_us"), F.col("spot"), F.col(ids).alias("ids")).alias("_row"),
    )
    probes = anchors.select(
        *by,
        block_of(F.col("anchor_us"), block).alias("_blk"),
        (F.col("anchor_us") * 2 + 1).alias("_ord"),
        "anchor_us",
        "close_us",
    )
    w = W.partitionBy(*by, "_blk").orderBy("_ord")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    tape = rows.unionByName(probes, allowMissingColumns=True)
    tape = tape.withColumn("_before", F.last("_row.at_us", ignorenulls=True).over(before))
    cut = F.col("_row").isNotNull() & F.coalesce(F.col("_row.at_us") - F.col("_before") > gap, F.lit(False))
    tape = tape.withColumn("_seg", F.sum(cut.cast("bigint")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    tape = tape.withColumn("_seen", F.when(F.col("_row").isNotNull(), F.struct("_row.*", "_seg")))
    tape = (
        tape.withColumn("_now", F.last("_seen", ignorenulls=True).over(before))
        .withColumn(
            "_past",
            F.last("_seen", ignorenulls=True).over(
                w.rangeBetween(W.unboundedPreceding, -(2 * look + 1))
            ),
        )
        .withColumn(
            "_end", F.last("_seen", ignorenulls=True).over(w.rangeBetween(W.unboundedPreceding, 2 * hor))
        )
    )
    full = F.when(F.col("_row").isNotNull(), F.struct("_seen", "_now", "_past"))
    tape = tape.withColumn("_start", F.last(full, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    hit = tape.filter(F.col("anchor_us").isNotNull())
    start, now, past = F.col("_start._seen"), F.col("_start._now"), F.col("_start._past")
    started = F.col("anchor_us") - start["at_us"] <= age
    end_us = F.col("anchor_us") + hor
    ended = F.when((end_us < F.col("close_us")) & (end_us - F.col("_end.at_us") <= age), F.col("_end"))
    return hit.select(
        *by,
        "anchor_us",
        "close_us",
        F.when(started, start).alias("start"),
        F.when(started & (start["at_us"] - now["at_us"] <= age), now).alias("now"),
        F.when(started & (start["at_us"] - look - past["at_us"] <= age), past).alias("past"),
        F.when(started, ended).alias("end"),
    )


def label_outcomes(hits: DataFrame, policy: SamplePolicy) -> DataFrame:
    """Reason (fixed precedence), change, label; anchors without a start are dropped."""
    hor, age = to_us(policy.horizon_seconds), to_us(policy.quote_max_age_seconds)
    start, end = F.col("start"), F.col("end")
    reason = (
        F.when(F.col("anchor_us") + hor >= F.col("close_us"), "horizon_outside_session")
        .when(end["at_us"].isNull(), "missing_or_old_endpoint")
        .when(F.abs(end["at_us"] - start["at_us"] - hor) > age, "receipt_interval_outside_tolerance")
        .when(end["_seg"] != start["_seg"], "gap_in_outcome_window")
        .otherwise("complete")
    )
    complete = F.col("outcome_reason") == "complete"
    now, past = F.col("now"), F.col("past")
    return (
        hits.filter(start["at_us"].isNotNull())
        .withColumn("outcome_reason", reason)
        .withColumn("outcome_status", F.when(complete, "COMPLETE").otherwise("UNKNOWN"))
        .withColumn("point_change", F.when(complete, end["spot"] - start["spot"]))
        .withColumn("label", classify_move(F.col("point_change"), policy))
        .withColumn("past_spot_change", F.when(now["_seg"] == past["_seg"], now["spot"] - past["spot"]))
    )


def side_features(tape: DataFrame, samples: DataFrame, policy: SamplePolicy) -> DataFrame:
    """Option features of each (sample, side) known strictly before the start receipt.

    ``samples`` needs underlying, trading_date, anchor_us and start_us. Quotes are
    segmented per side first, because a calculation counts only inside the current
    quote's segment, however long ago that segment began.
    """
    by = ["underlying", "trading_date", "optiontype"]
    quotes = with_segments(
        tape.withColumn("midpoint", midpoint(F.col("bid"), F.col("ask"))),
        by=by,
        time="timestamps",
        tie="observation_id",
        max_gap=policy.max_gap_seconds,
        contract="contract_key",
        block_seconds=policy.block_seconds,
    )
    age, look = to_us(policy.quote_max_age_seconds), to_us(policy.lookback_seconds)
    back = look + age
    block = default_block_us(back, 0, policy.block_seconds)
    t_us = us("timestamps")
    quote_cols = ["observation_id", "contract_key", "segment", "midpoint", "bid", "ask", "oi", "volume"]
    rows = quotes.select(
        *by,
        F.explode(reach_blocks(t_us, block, back, 0)).alias("_blk"),
        (t_us * 2 + 1).alias("_ord"),
        F.struct(t_us.alias("at_us"), *quote_cols).alias("_row"),
    )
    probes = samples.select(
        "underlying",
        "trading_date",
        F.explode(F.array(*[F.lit(s) for s in SIDES])).alias("optiontype"),
        block_of(F.col("start_us"), block).alias("_blk"),
        (F.col("start_us") * 2).alias("_ord"),
        "anchor_us",
        "start_us",
    )
    w = W.partitionBy(*by, "_blk").orderBy("_ord")
    both = rows.unionByName(probes, allowMissingColumns=True).select(
        *by,
        "anchor_us",
        "start_us",
        F.last("_row", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("_cur"),
        F.last("_row", ignorenulls=True)
        .over(w.rangeBetween(W.unboundedPreceding, -2 * look))
        .alias("_prev"),
    )
    cur, prev = F.col("_cur"), F.col("_prev")
    hit = both.filter(F.col("anchor_us").isNotNull()).select(
        *by,
        "anchor_us",
        "start_us",
        F.when(F.col("start_us") - cur["at_us"] <= age, cur).alias("cur"),
        F.when(F.col("start_us") - look - prev["at_us"] <= age, prev).alias("prev"),
    )
    hit = (
        hit.filter(F.col("cur.at_us").isNotNull())
        .withColumn("segment", F.col("cur.segment"))
        .withColumn("start_at", F.timestamp_micros("start_us"))
    )
    greeks = ["delta", "gamma", "theta", "vega"]
    cols = ["observation_id", "contract_key", "iv", *greeks]
    hit = asof_available(
        hit,
        quotes.select(*by, "segment", "timestamps", "iv_available_at", "greeks_available_at", *cols),
        by=[*by, "segment"],
        probe_time="start_at",
        available={"iv_calc": "iv_available_at", "greeks_calc": "greeks_available_at"},
        observed="timestamps",
        available_age=policy.analytics_max_age_seconds,
        source_age=policy.analytics_source_max_age_seconds,
        payload=cols,
    )
    cur, prev = F.col("cur"), F.col("prev")
    paired = prev["segment"] == cur["segment"]
    grown = paired & (cur["volume"] >= prev["volume"])
    values = {
        "past_midpoint_return_pct": F.when(paired, pct_change(cur["midpoint"], prev["midpoint"])),
        "past_oi_change_pct": F.when(paired, pct_change(cur["oi"], prev["oi"])),
        # Subtract the counters as integers before any conversion to double.
        "past_volume_increment": F.when(grown, (cur["volume"] - prev["volume"]).cast("double")),
        "iv_decimal": F.col("iv_calc.iv"),
        "spread_pct": F.when(cur["midpoint"] > 0, 100 * (cur["ask"] - cur["bid"]) / cur["midpoint"]),
        **{g: F.col(f"greeks_calc.{g}") for g in greeks},
    }
    flat = hit.select(
        *by, "anchor_us", "cur", "prev", "iv_calc", "greeks_calc", *[_finite(v).alias(k) for k, v in values.items()]
    )
    lineage = []
    for name in values:
        if name == "iv_decimal":
            lineage.append(_lineage_entry(name, ["iv_calc"], "iv_calc.available_us"))
        elif name in greeks:
            lineage.append(_lineage_entry(name, ["greeks_calc"], "greeks_calc.available_us"))
        else:
            lineage.append(_lineage_entry(name, ["prev", "cur"] if name.startswith("past_") else ["cur"]))
    return flat.select(
        *by, "anchor_us", *values, F.expr(f"array_compact(array({', '.join(lineage)}))").alias("lineage")
    )


def _finite(col: Column) -> Column:
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def _lineage_entry(name: str, rows: list[str], available: str | None = None) -> str:
    """SQL for where a feature came from and when it could first be known; NULL when
    the feature has no value."""

    def sorted_set(field: str) -> str:
        return f"array_sort(array_distinct(array({', '.join(f'{r}.{field}' for r in rows)})))"

    known = available or f"array_max(array({', '.join(f'{r}.at_us' for r in rows)}))"
    return (
        f"if({name} is not null, named_struct('feature', '{name}', 'observation_ids', {sorted_set('observation_id')}, "
        f"'max_available_us', {known}, 'source_us', {sorted_set('at_us')}, 'contract_keys', {sorted_set('contract_key')}), null)"
    )


def _prefixed(entries: Column, side: str) -> Column:
    """Lineage entries with the side in front of the feature name."""
    return F.transform(entries, lambda e: e.withField("feature", F.concat(F.lit(f"{side}_"), e["feature"])))


def build_samples(
    tape: DataFrame, policy: SamplePolicy, dataset_id: str = "unspecified_dataset"
) -> DataFrame:
    """One row per clock anchor with a fresh start quote.

    ``tape`` columns: observation_id, timestamps, underlying, trading_date, spot,
    optiontype, contract_key, bid, ask, oi, volume, iv, iv_available_at, delta,
    gamma, theta, vega, greeks_available_at. Outcomes that cannot be known stay
    UNKNOWN; features that cannot be known stay NULL. Run
    :func:`tickevidence.operators.quality.research_gate` first.
    """
    live = tape.filter(session_filter(tape, policy))
    spots = receipts(live)
    days = live.select("underlying", "trading_date").distinct()
    outcome = label_outcomes(spot_outcomes(spots, anchor_grid(days, policy), policy), policy)
    outcome = outcome.withColumn("start_us", F.col("start.at_us"))
    feats = side_features(live, outcome.select("underlying", "trading_date", "anchor_us", "start_us"), policy)
    keys = ["underlying", "trading_date", "anchor_us"]
    wide = feats.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("optiontype") == s, F.col(f))).alias(f"{s}_{f}")
            for s in SIDES
            for f in OPTION_FEATURES
        ],
        *[
            F.max(F.when(F.col("optiontype") == s, F.col("lineage"))).alias(f"_{s}_lineage")
            for s in SIDES
        ],
    )
    now, past = F.col("now"), F.col("past")
    spot_lineage = F.when(
        F.col("past_spot_change").isNotNull(),
        F.struct(
            F.lit("past_spot_change").alias("feature"),
            F.array_sort(F.array_distinct(F.concat(past["ids"], now["ids"]))).alias("observation_ids"),
            now["at_us"].alias("max_available_us"),
            F.array_sort(F.array_distinct(F.array(past["at_us"], now["at_us"]))).alias("source_us"),
            F.expr("cast(array() as array<string>)").alias("contract_keys"),
        ),
    )
    empty = F.array().cast(feats.schema["lineage"].dataType)
    renamed = [_prefixed(F.coalesce(F.col(f"_{s}_lineage"), empty), s) for s in SIDES]
    entries = F.concat(F.array_compact(F.array(spot_lineage)), *renamed)
    lineage = F.map_from_entries(
        F.transform(
            entries,
            lambda e: F.struct(
                e["feature"].alias("key"),
                F.struct(
                    e["observation_ids"].alias("observation_ids"),
                    e["max_available_us"].alias("max_available_us"),
                    e["source_us"].alias("source_us"),
                    e["contract_keys"].alias("contract_keys"),
                ).alias("value"),
            ),
        )
    )
    identity = F.concat_ws(
        "|",
        F.lit(dataset_id),
        F.col("underlying"),
        F.col("anchor_us").cast("string"),
        F.lit(policy_text(policy)),
    )
    return outcome.join(wide, keys, "left").select(
        F.sha2(identity, 256).alias("sample_id"),
        "underlying",
        "trading_date",
        "anchor_us",
        # The condition cutoff, one nanosecond before the start receipt.
        (F.col("start_us") * 1000 - 1).alias("condition_ns"),
        "start_us",
        F.col("end.at_us").alias("end_us"),
        F.col("start.spot").alias("start_spot"),
        F.col("end.spot").alias("end_spot"),
        "point_change",
        "label",
        "outcome_status",
        "outcome_reason",
        F.col("start.ids").alias("start_observation_ids"),
        F.coalesce(F.col("end.ids"), F.expr("cast(array() as array<string>)")).alias("end_observation_ids"),
        lineage.alias("feature_lineage"),
        "past_spot_change",
        *FEATURES[1:],
    )


def policy_text(policy: SamplePolicy) -> str:
    """Canonical text of a policy, part of every sample id."""
    return ";".join(f"{k}={v}" for k, v in sorted(asdict(policy).items()) if k != "block_seconds")


def alignment_counts(tape: DataFrame, samples: DataFrame, policy: SamplePolicy) -> DataFrame:
    """Per (underlying, day): out-of-session rows, clock candidates, invalid starts, selected."""
    inside = session_filter(tape, policy)
    by = ["underlying", "trading_date"]
    rows = tape.groupBy(*by).agg(
        F.count_if(~inside).alias("out_of_session_rows"), F.count_if(inside).alias("_live")
    )
    start, end = session_bounds_us(F.col("trading_date"), policy.zone, policy.opens, policy.closes)
    step = to_us(policy.anchor_seconds)
    grid = F.ceil((end - start) / F.lit(float(step))).cast("bigint")
    chosen = samples.groupBy(*by).agg(F.count(F.lit(1)).alias("selected"))
    merged = rows.join(chosen, by, "left")
    candidates = F.when(F.col("_live") > 0, grid).otherwise(F.lit(0))
    selected = F.coalesce("selected", F.lit(0))
    return merged.select(
        *by,
        "out_of_session_rows",
        candidates.alias("clock_candidates"),
        (candidates - selected).alias("invalid_start"),
        selected.alias("selected"),
    )


def trading_date_of(ts: str, policy: SamplePolicy) -> Column:
    return local_date(ts, policy.zone)
