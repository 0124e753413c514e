"""Backward as-of joins with a tolerance, over time blocks.

A series is cut into ``(key, block)`` pieces, so one hot key is spread over many
tasks. Every series row goes to the blocks whose probes could need it: its own
block, plus a neighbour when it lies within reach of the boundary. One exchange
and one sort then answer all roles (for instance past / now / future).

Series and probes share one integer order, ``2*t`` plus one for whichever of the
two must come second at an equal time, so ties never depend on input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import block_of, to_us, us

_PRIVATE = ("_blk", "_ord", "_probe", "_row")


def reach_blocks(t_us: Column, block_us: int, back_us: int, ahead_us: int) -> Column:
    """Blocks of the probes at ``c`` that can use a row at ``t``.

    A probe uses rows in ``[c - back, c + ahead]``; so ``c`` is in
    ``[t - ahead, t + back]``. With blocks much longer than the reach this is
    one block for nearly every row.
    """
    first = block_of(t_us - F.lit(ahead_us).cast("bigint"), block_us)
    last = block_of(t_us + F.lit(back_us).cast("bigint"), block_us)
    return F.sequence(first, last)


def default_block_us(back_us: int, ahead_us: int, block_seconds: float | None) -> int:
    """Eight times the reach, unless given: at most about 1/8 of rows are copied."""
    if block_seconds is not None:
        return max(to_us(block_seconds), 1)
    return max(8 * (back_us + ahead_us), 60 * 1_000_000)


def asof_roles(
    probes: DataFrame,
    series: DataFrame,
    *,
    by: list[str],
    probe_time: str,
    series_time: str,
    roles: dict[str, float],
    tolerance: float,
    payload: list[str],
    strict: bool = False,
    block_seconds: float | None = None,
) -> DataFrame:
    """For each probe and role, the last series row at or before ``clock + offset``.

    ``roles`` maps a role to its offset in seconds. A row older than
    ``tolerance`` seconds (inclusive limit) gives NULL; ``strict`` demands a row
    strictly before the clock. Each role becomes a struct column holding the
    payload and ``at_us``. The series must be unique on ``by`` + time.
    """
    offsets = {name: to_us(seconds) for name, seconds in roles.items()}
    tol = to_us(tolerance)
    back = tol - min(0, *offsets.values()) if len(offsets) > 1 else tol - min(0, *offsets.values(), 0)
    ahead = max(0, *offsets.values()) if len(offsets) > 1 else max(0, *offsets.values(), 0)
    block = default_block_us(back, ahead, block_seconds)
    probe_cols = [c for c in probes.columns if c not in by]

    left = probes.select(
        *by,
        block_of(us(probe_time), block).alias("_blk"),
        (us(probe_time) * 2 + (0 if strict else 1)).alias("_ord"),
        F.struct(*probe_cols).alias("_probe"),
    )
    row = F.struct(us(series_time).alias("at_us"), *payload)
    right = series.filter(F.col(series_time).isNotNull()).select(
        *by,
        F.explode(reach_blocks(us(series_time), block, back, ahead)).alias("_blk"),
        (us(series_time) * 2 + (1 if strict else 0)).alias("_ord"),
        row.alias("_row"),
    )
    both = left.unionByName(right, allowMissingColumns=True)
    base = W.partitionBy(*by, "_blk").orderBy("_ord")
    found = []
    for name, offset in offsets.items():
        frame = base.rangeBetween(W.unboundedPreceding, 2 * offset)
        found.append(F.last("_row", ignorenulls=True).over(frame).alias(f"_r_{name}"))
    joined = both.select(*by, "_probe", *found).filter(F.col("_probe").isNotNull())
    clock = us(F.col("_probe")[probe_time])
    kept = [
        F.when(
            clock + F.lit(offset).cast("bigint") - F.col(f"_r_{name}.at_us") <= tol,
            F.col(f"_r_{name}"),
        ).alias(name)
        for name, offset in offsets.items()
    ]
    return joined.select(*by, *[F.col("_probe")[c].alias(c) for c in probe_cols], *kept)


def asof_backward(
    probes: DataFrame,
    series: DataFrame,
    *,
    by: list[str],
    probe_time: str,
    series_time: str,
    tolerance: float,
    payload: list[str],
    strict: bool = False,
    prefix: str = "",
    block_seconds: float | None = None,
) -> DataFrame:
    """The last series row at or before each probe, as flat columns plus ``at_us``."""
    out = asof_roles(
        probes,
        series,
        by=by,
        probe_time=probe_time,
        series_time=series_time,
        roles={"_hit": 0.0},
        tolerance=tolerance,
        payload=payload,
        strict=strict,
        block_seconds=block_seconds,
    )
    return out.select(
        *probes.columns,
        *[F.col("_hit")[c].alias(prefix + c) for c in ["at_us", *payload]],
    )


def asof_available(
    probes: DataFrame,
    candidates: DataFrame,
    *,
    by: list[str],
    probe_time: str,
    available: str | dict[str, str],
    observed: str,
    available_age: float,
    source_age: float,
    payload: list[str],
    strict: bool = True,
    block_seconds: float | None = None,
) -> DataFrame:
    """The newest calculation *available* before a clock, then age-checked.

    Candidates are ordered by (availability, observation time). The newest one is
    chosen first and only then rejected when its availability or its source is
    too old; an older candidate is never used instead. Adds a struct column
    ``calc`` with the payload, ``available_us`` and ``at_us``. ``available`` may
    map several output names to availability columns of the same rows; they are
    answered by one exchange. A candidate older than ``available_age`` can never
    be usable, so it need not reach the probe.
    """
    clocks = {"calc": available} if isinstance(available, str) else available
    tol = to_us(available_age)
    block = default_block_us(tol, 0, block_seconds)
    probe_cols = [c for c in probes.columns if c not in by]
    left = probes.select(
        *by,
        block_of(us(probe_time), block).alias("_blk"),
        (us(probe_time) * 2 + (0 if strict else 1)).alias("_ord"),
        F.struct(*probe_cols).alias("_probe"),
    )
    kinds = F.array(
        *[F.struct(F.lit(name).alias("_kind"), us(col).alias("_at")) for name, col in clocks.items()]
    )
    each = candidates.select(*by, observed, *payload, F.inline(kinds)).filter(F.col("_at").isNotNull())
    right = each.select(
        *by,
        "_kind",
        F.explode(reach_blocks(F.col("_at"), block, tol, 0)).alias("_blk"),
        (F.col("_at") * 2 + (1 if strict else 0)).alias("_ord"),
        F.struct(F.col("_at").alias("available_us"), us(observed).alias("at_us"), *payload).alias("_row"),
    )
    both = left.unionByName(right, allowMissingColumns=True)
    # Equal availability: the later observation is the newer calculation.
    order = W.partitionBy(*by, "_blk").orderBy("_ord", F.col("_row.at_us").asc_nulls_last())
    frame = order.rowsBetween(W.unboundedPreceding, 0)
    found = [
        F.last(F.when(F.col("_kind") == name, F.col("_row")), ignorenulls=True).over(frame).alias(f"_f_{name}")
        for name in clocks
    ]
    joined = both.select(*by, "_probe", *found).filter(F.col("_probe").isNotNull())
    clock = us(F.col("_probe")[probe_time])
    kept = [
        F.when(
            (clock - F.col(f"_f_{name}.available_us") <= tol) & (clock - F.col(f"_f_{name}.at_us") <= to_us(source_age)),
            F.col(f"_f_{name}"),
        ).alias(name)
        for name in clocks
    ]
    return joined.select(*by, *[F.col("_probe")[c].alias(c) for c in probe_cols], *kept)
