"""Gap and contract segments, gap reports, missing intervals, greedy spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import block_of, to_us, us


def _earlier_blocks(df: DataFrame, by: list[str], aggs: dict[str, tuple[Column, object]]) -> DataFrame:
    """Fold per-block aggregates over all earlier blocks of the same key.

    The input has one row per (key, block), so its windows see few rows however
    many ticks a key holds.
    """
    order = W.partitionBy(*by).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    return df.select(
        *by, "_blk", *[fold(F.col(name)).over(order).alias(f"_before_{name}") for name, (_, fold) in aggs.items()]
    )


def with_previous(
    df: DataFrame, *, by: list[str], time: str, tie: str, payload: list[str], block_seconds: float
) -> DataFrame:
    """Add ``previous``: time and payload of the preceding row of the key, however old.

    Rows are sorted inside (key, block); the first row of a block takes its
    predecessor from the last row of the nearest earlier non-empty block.
    """
    tagged = df.withColumn("_blk", block_of(us(time), to_us(block_seconds)))
    row = F.struct(us(time).alias("at_us"), F.col(tie).alias("_tie"), *payload)
    lasts = tagged.groupBy(*by, "_blk").agg(F.max(row).alias("last"))
    carry = _earlier_blocks(lasts, by, {"last": (None, F.max)})
    order = W.partitionBy(*by, "_blk").orderBy(time, tie)
    local = tagged.withColumn("_row", row).withColumn("_prev", F.lag("_row").over(order))
    joined = _join_carry(local, carry, by)
    return joined.withColumn("previous", F.coalesce("_prev", "_before_last")).drop(
        "_blk", "_row", "_prev", "_before_last"
    )


def _join_carry(df: DataFrame, carry: DataFrame, by: list[str]) -> DataFrame:
    """Attach block carries; both sides are already hashed by (key, block)."""
    keys = [*by, "_blk"]
    right = carry.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], *[c for c in carry.columns if c not in keys]
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return df.join(right, cond, "left").drop(*[f"_c_{k}" for k in keys])


def with_segments(
    df: DataFrame,
    *,
    by: list[str],
    time: str,
    tie: str,
    max_gap: float,
    contract: str | None = None,
    block_seconds: float | None = None,
    name: str = "segment",
) -> DataFrame:
    """Number the continuous stretches of each key.

    A new segment starts when the gap exceeds ``max_gap`` seconds or, when
    ``contract`` is named, when the contract changes. Without a contract the
    numbers start at 0, with one at 1 (the first row has no contract to match).

    Breaks need only the rows of the last ``max_gap`` seconds, so blocks are
    detected independently with that much overlap; the counts of earlier blocks
    are then added. Rows without a time stay, with a NULL segment, and break nothing.
    """
    gap = to_us(max_gap)
    block = to_us(block_seconds) if block_seconds else max(16 * gap, 3600 * 1_000_000)
    own = block_of(us(time), block)
    overlap = block_of(us(time) + F.lit(gap).cast("bigint"), block)
    spread = df.withColumn("_own", own).withColumn("_blk", F.explode_outer(F.sequence(own, overlap)))
    order = W.partitionBy(*by, "_blk").orderBy(time, tie)
    is_break = F.lag(time).over(order).isNull() | (
        us(time) - us(F.lag(time).over(order)) > gap
    )
    if contract:
        is_break = is_break | ~F.lag(contract).over(order).eqNullSafe(F.col(contract))
    dated = F.col(time).isNotNull()
    breaks = F.when(dated, is_break.cast("bigint")).otherwise(0)
    marked = spread.withColumn("_break", breaks).filter(F.col("_own").eqNullSafe(F.col("_blk")))
    run = F.sum("_break").over(order.rowsBetween(W.unboundedPreceding, 0))
    local = marked.withColumn("_run", run)
    sums = local.groupBy(*by, "_blk").agg(F.sum("_break").alias("n"))
    carry = _earlier_blocks(sums, by, {"n": (None, F.sum)})
    shift = 0 if contract else 1
    return (
        _join_carry(local, carry, by)
        .withColumn(name, F.when(dated, F.col("_run") + F.coalesce("_before_n", F.lit(0)) - F.lit(shift)))
        .drop("_own", "_blk", "_break", "_run", "_before_n")
    )


def gap_report(
    df: DataFrame, *, by: list[str], time: str, min_gap: float, block_seconds: float
) -> DataFrame:
    """Distinct consecutive receipts more than ``min_gap`` seconds apart."""
    cycles = df.select(*by, time).distinct()
    rows = with_previous(
        cycles, by=by, time=time, tie=time, payload=[], block_seconds=block_seconds
    )
    gap = us(time) - F.col("previous.at_us")
    return rows.filter(gap > to_us(min_gap)).select(
        *by,
        F.timestamp_micros("previous.at_us").alias("previous_at"),
        F.col(time).alias("next_at"),
        (gap / F.lit(1e6)).alias("gap_seconds"),
    )


def missing_intervals(slots: DataFrame, *, by: list[str], slot: str, expected: Column) -> DataFrame:
    """Runs of absent slots in ``[0, expected)`` per key, as half-open intervals.

    Works on the observed slots only (distinct first), by looking between
    neighbours and at both ends; no grid is generated. A key's group holds at
    most one session of slots.
    """
    seen = slots.filter((F.col(slot) >= 0) & (F.col(slot) < expected)).select(*by, F.col(slot).alias("_s"))
    seen = seen.distinct()
    ends = slots.select(*by).distinct()
    marks = seen.unionByName(ends.withColumn("_s", F.lit(-1).cast("bigint"))).unionByName(
        ends.withColumn("_s", expected.cast("bigint"))
    )
    order = W.partitionBy(*by).orderBy("_s")
    runs = marks.withColumn("_before", F.lag("_s").over(order))
    return runs.filter(F.col("_s") - F.col("_before") > 1).select(
        *by,
        (F.col("_before") + 1).alias("start_slot"),
        F.col("_s").alias("end_slot"),
        (F.col("_s") - F.col("_before") - 1).alias("slots"),
    )


def greedy_spacing(
    df: DataFrame,
    *,
    by: list[str],
    start: str,
    end: str,
    flag: str = "independent",
    carry: list[str],
) -> DataFrame:
    """Scan each key in order of ``start``; keep a window when it begins at or
    after the end of the last kept one. Outcomes play no part.

    ``start``/``end`` are integer clocks. The choice is sequential, so a key must
    be a clock grid of one session (a few hundred anchors): the fold then runs
    over an array whose length the grid bounds.
    """
    item = F.struct(F.col(start).alias("s"), F.col(end).alias("e"), (F.struct(*carry) if carry else F.struct(F.lit(0))).alias("c"))
    grouped = df.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    folded = F.aggregate(
        "_items",
        F.struct(
            F.lit(None).cast("bigint").alias("until"),
            F.expr("cast(array() as array<boolean>)").alias("keep"),
        ),
        lambda acc, x: F.when(
            acc["until"].isNull() | (x["s"] >= acc["until"]),
            F.struct(
                x["e"].cast("bigint").alias("until"),
                F.concat(acc["keep"], F.array(F.lit(True))).alias("keep"),
            ),
        ).otherwise(
            F.struct(
                acc["until"].alias("until"),
                F.concat(acc["keep"], F.array(F.lit(False))).alias("keep"),
            )
        ),
        lambda acc: acc["keep"],
    )
    flat = grouped.select(*by, F.explode(F.arrays_zip(F.col("_items"), folded.alias("_keep"))).alias("_z"))
    return flat.select(
        *by,
        F.col("_z._items.s").alias(start),
        F.col("_z._items.e").alias(end),
        *[F.col("_z._items.c")[c].alias(c) for c in carry],
        F.col("_z._keep").alias(flag),
    )
