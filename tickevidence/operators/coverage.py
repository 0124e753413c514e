"""Slot coverage, receipt coverage, day counts and daily quality views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import to_us, us


def slot_index(scheduled_us: Column, open_us: Column, slot_seconds: float) -> Column:
    """Slot number from the open; NULL when the clock is not on a slot boundary."""
    step = to_us(slot_seconds)
    offset = scheduled_us - open_us
    aligned = F.pmod(offset, F.lit(step).cast("bigint")) == 0
    return F.when(aligned, (offset / F.lit(step)).cast("bigint"))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def cycle_coverage(
    rows: DataFrame, *, by: list[str], slot: str, side: str, value: str, expected: Column
) -> DataFrame:
    """Observed, complete and missing slots of each key against an expected count.

    A cycle is complete with exactly two rows, both sides, and both values. Rows
    are counted per slot first, so a hot key is reduced before its day total.
    """
    per_slot = rows.groupBy(*by, slot).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col(side) == "CE").alias("_ce"),
        F.count_if(F.col(side) == "PE").alias("_pe"),
        F.count(value).alias("_values"),
    )
    inside = F.coalesce((F.col(slot) >= 0) & (F.col(slot) < expected), F.lit(False))
    complete = (F.col("_rows") == 2) & (F.col("_ce") > 0) & (F.col("_pe") > 0) & (F.col("_values") == 2)
    observed = F.count_if(inside)
    return per_slot.groupBy(*by).agg(
        F.max(expected).cast("bigint").alias("expected_cycles"),
        observed.alias("observed_cycles"),
        F.count_if(inside & complete).alias("complete_cycles"),
        (F.max(expected).cast("bigint") - observed).alias("missing_cycles"),
        pct(observed, F.max(expected)).alias("coverage_pct"),
    )


def expected_slots(days: DataFrame, *, open_us: Column, close_us: Column, slot_seconds: float) -> DataFrame:
    """The generated slot grid of each key-day."""
    step = F.lit(to_us(slot_seconds)).cast("bigint")
    return days.withColumn("slot_us", F.explode(F.sequence(open_us, close_us - 1, step)))


def grid_join(grid: DataFrame, rows: DataFrame, *, by: list[str], slot: str) -> DataFrame:
    """Every expected slot with its number of rows (0 when missing)."""
    counts = rows.groupBy(*by, slot).agg(F.count(F.lit(1)).alias("_n"))
    return (
        grid.join(counts, [*by, slot], "left")
        .withColumn("rows", F.coalesce("_n", F.lit(0)))
        .drop("_n")
    )


def receipt_coverage(
    receipts: DataFrame,
    *,
    by: list[str],
    scheduled: str,
    received: str,
    open_us: Column,
    close_us: Column,
    slot_seconds: float,
    required: DataFrame | None = None,
) -> DataFrame:
    """Receipt counts and distinct captured slots per key-day.

    ``required`` lists keys that must appear even without any receipt.
    """
    slot = slot_index(us(scheduled), open_us, slot_seconds)
    length = close_us - open_us
    count = (length / F.lit(to_us(slot_seconds))).cast("bigint")
    inside = (slot >= 0) & (slot < count)
    marked = receipts.select(
        *by,
        us(received).alias("_at"),
        F.when(inside, slot).alias("_slot"),
        count.alias("_expected"),
        ((us(received) < open_us) | (us(received) >= close_us)).alias("_out"),
    )
    # Distinct slots by a pre-aggregated two-step count, not by one set per key.
    per_slot = marked.groupBy(*by, "_slot").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_out").alias("_out"),
        F.min("_at").alias("_first"),
        F.max("_at").alias("_last"),
        F.max("_expected").alias("_expected"),
    )
    out = per_slot.groupBy(*by).agg(
        F.sum("_n").alias("raw_receipt_count"),
        F.min("_first").alias("earliest_us"),
        F.max("_last").alias("latest_us"),
        F.sum("_out").alias("out_of_window_receipts"),
        F.sum(F.when(F.col("_slot").isNull(), F.col("_n")).otherwise(0)).alias("unaligned_scheduled_receipts"),
        F.count("_slot").alias("captured_distinct_slots"),
        F.max("_expected").alias("expected_slots"),
    )
    if required is not None:
        out = required.join(out, by, "left").fillna(
            0,
            subset=[
                "raw_receipt_count",
                "out_of_window_receipts",
                "unaligned_scheduled_receipts",
                "captured_distinct_slots",
            ],
        )
    return out.withColumn("missing_slots", F.col("expected_slots") - F.col("captured_distinct_slots"))


def day_counts(rows: DataFrame, *, by: list[str], in_window: Column, exported: DataFrame) -> DataFrame:
    """All-day and out-of-window rows per day, reconciled with an exported table."""
    counts = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("all_day_rows"), F.count_if(~in_window).alias("out_of_window_rows")
    )
    sent = exported.groupBy(*by).agg(F.count(F.lit(1)).alias("exported_rows"))
    out = counts.join(sent, by, "left").fillna(0, subset=["exported_rows"])
    return out.withColumn(
        "reconciled",
        F.col("all_day_rows") - F.col("out_of_window_rows") == F.col("exported_rows"),
    )


def trading_dates(rows: DataFrame, *, date: Column, live: Column) -> DataFrame:
    """Distinct dates with at least one live row, ascending."""
    return rows.filter(live).select(date.alias("trading_date")).distinct().orderBy("trading_date")


def daily_quality(
    rows: DataFrame, *, by: list[str], status: str, statuses: list[str], time: str, latency: str
) -> DataFrame:
    """Rows per status, valid share, first / last time and latency per key-day."""
    total = F.count(F.lit(1))
    return rows.groupBy(*by).agg(
        total.alias("total"),
        *[F.count_if(F.col(status) == s).alias(f"{s.lower()}_rows") for s in statuses],
        pct(F.count_if(F.col(status) == statuses[0]), total).alias("valid_pct"),
        F.min(us(time)).alias("first_us"),
        F.max(us(time)).alias("last_us"),
        F.avg(latency).alias("avg_latency"),
        F.max(latency).alias("max_latency"),
    )


def completeness(rows: DataFrame, *, by: list[str], columns: list[str]) -> DataFrame:
    """Non-null counts and shares per group."""
    total = F.count(F.lit(1))
    return rows.groupBy(*by).agg(
        total.alias("total"),
        *[F.count(c).alias(f"has_{c}") for c in columns],
        *[pct(F.count(c), total).alias(f"{c}_pct") for c in columns],
    )


def outcome_status(rows: DataFrame, *, by: list[str], status: str, statuses: list[str]) -> DataFrame:
    """Rows per outcome status and the valid share."""
    total = F.count(F.lit(1))
    return rows.groupBy(*by).agg(
        total.alias("total"),
        *[F.count_if(F.col(status) == s).alias(f"{s.lower()}_rows") for s in statuses],
        pct(F.count_if(F.col(status) == statuses[0]), total).alias("valid_pct"),
    )


def cadence(rows: DataFrame, *, by: list[str], scheduled: str, actual: str, slot_seconds: float, last: int) -> DataFrame:
    """Clock drift over the newest ``last`` cycles of each key: average, range, missed slots.

    The newest cycles are cut out by a per-key rank after each (key, slot) is
    reduced to one row.
    """
    slot_us = to_us(slot_seconds)
    cycles = rows.select(
        *by, us(scheduled).alias("_s"), ((us(actual) - us(scheduled)) / F.lit(1000.0)).alias("_drift")
    )
    newest = W.partitionBy(*by).orderBy(F.desc("_s"))
    kept = cycles.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= last)
    order = W.partitionBy(*by).orderBy("_s")
    step = F.col("_s") - F.lag("_s").over(order)
    missed = F.greatest(F.lit(0), F.floor(step / F.lit(float(slot_us))) - 1)
    return (
        kept.withColumn("_missed", F.coalesce(missed, F.lit(0)))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("cycles"),
            F.avg("_drift").alias("avg_drift_ms"),
            F.min("_drift").alias("min_drift_ms"),
            F.max("_drift").alias("max_drift_ms"),
            F.sum("_missed").cast("bigint").alias("missed_intervals"),
        )
        .withColumn("healthy", F.col("missed_intervals") == 0)
    )
