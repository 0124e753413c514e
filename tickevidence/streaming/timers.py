"""Keyed state that decides behind the watermark: gaps with reasons, silence, staleness, linking.

A row may arrive in any order as long as the watermark has not passed it. So nothing is
decided from rows ahead of the watermark: they wait in the state, in order, and event-time
timers decide them, also for a symbol that has gone silent. Which slots, alerts and
reasons come out therefore does not depend on how rows are dealt to batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickevidence.functions.clock import align, to_us, us

# Why a scheduled slot has no observation.
MISSED, SKIPPED, REJECTED = "MISSED_SCHEDULED_INTERVALS", "SKIPPED_BACKOFF_OR_LATE_TICK", "REJECTED_CAPTURE"
#: What a row says about its slot, best first: of several rows in a slot the best one counts.
CAPTURED = "CAPTURED"
OUTCOMES = (CAPTURED, REJECTED, SKIPPED)

GAPS = "symbol string, start_us bigint, end_us bigint, missed bigint, reason string"
ALERTS = "symbol string, status string, at_us bigint, newest_us bigint"
STALE, RECEIVING = "STALE", "RECEIVING"


def _runs(slots: list[tuple[int, str]], step: int) -> list[tuple[int, int, int, str]]:
    """(start, end, slots, reason) of neighbouring slots with one reason."""
    out: list[list] = []
    for slot, reason in slots:
        if out and out[-1][1] == slot and out[-1][3] == reason:
            out[-1][1], out[-1][2] = slot + step, out[-1][2] + 1
        else:
            out.append([slot, slot + step, 1, reason])
    return [tuple(r) for r in out]


def _absent(after: int, before: int, step: int) -> list[tuple[int, int, int, str]]:
    """The missed slots from ``after`` (exclusive) up to ``before`` (exclusive) as one run, if there are any."""
    n = (before - after) // step - 1
    return [(after + step, before, n, MISSED)] if n > 0 else []


def decided_gaps(
    last: int | None, silent: bool, pending: dict[int, str], watermark_us: int, step: int, silence_us: int
) -> tuple[list[tuple[int, int, int, str]], int | None, bool, dict[int, str]]:
    """Gaps that the watermark settles: (gaps, last decided slot, silent, what still waits).

    A slot is settled once it has ended behind the watermark. When nothing at all is
    settled for ``silence_us`` after the last slot, the symbol is silent, and slots go on
    being missed as the watermark moves, until a row comes.
    """
    gaps: list[tuple[int, int, int, str]] = []
    ready = sorted(s for s in pending if s + step <= watermark_us)
    faulty: list[tuple[int, str]] = []
    for slot in ready:
        if last is not None:
            gaps += _absent(last, slot, step)
        if pending[slot] != CAPTURED:
            faulty.append((slot, pending[slot]))
        last, silent = slot, False
    gaps += _runs(faulty, step)
    rest = {s: o for s, o in pending.items() if s + step > watermark_us}
    if last is not None and (silent or watermark_us - (last + step) >= silence_us):
        # Slots up to the watermark, or up to the first row that waits, are missed for good.
        stop = min([watermark_us - watermark_us % step, *rest])
        gaps += _absent(last, stop, step)
        last, silent = max(last, stop - step), True
    return gaps, last, silent, rest


def slot_gaps(
    df: DataFrame, *, by: str, time: str, seconds: float, watermark: str, silence_seconds: float, outcome: str | None = None
) -> DataFrame:
    """Slots without an observation per symbol: half-open runs [start, end) with their number and reason.

    ``outcome`` names a column of OUTCOMES (all rows are CAPTURED without it): a slot
    whose attempts were all rejected or skipped is a gap with that reason, a slot without a
    row between others is MISSED. Rows are reduced to one per (symbol, slot, outcome) first.
    Slots before a symbol's first one are not gaps. A late row inside the watermark opens none.
    """
    step, silence_us = to_us(seconds), to_us(silence_seconds)

    def watch(ids: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, silent, pending = None, False, {}
        if state.exists:
            last, silent, waiting = state.get
            last = None if last < 0 else last
            pending = {int(s): o for s, o in json.loads(waiting).items()}
        for frame in frames:
            for slot, name in zip(frame["slot_us"], frame["outcome"], strict=True):
                slot = int(slot)
                if last is not None and slot <= last:
                    continue  # already decided
                if slot not in pending or OUTCOMES.index(name) < OUTCOMES.index(pending[slot]):
                    pending[slot] = name
        mark = state.getCurrentWatermarkMs() * 1000
        gaps, last, silent, pending = decided_gaps(last, silent, pending, mark, step, silence_us)
        if gaps:
            yield pd.DataFrame(gaps, columns=["start_us", "end_us", "missed", "reason"]).assign(symbol=ids[0])[
                ["symbol", "start_us", "end_us", "missed", "reason"]
            ]
        state.update((-1 if last is None else last, silent, json.dumps(pending)))
        # The next moment at which something can be decided.
        if pending:
            due = min(pending) + step
        else:
            due = last + 2 * step if silent else last + step + silence_us
        state.setTimeoutTimestamp(max(due // 1000, state.getCurrentWatermarkMs() + 1))

    name = F.lit(CAPTURED) if outcome is None else F.col(outcome)
    slots = (
        df.withColumn("slot", align(time, seconds))
        .withColumn("outcome", name)
        .withWatermark("slot", watermark)
        .dropDuplicatesWithinWatermark([by, "slot", "outcome"])
        .select(F.col(by).cast("string").alias("symbol"), us("slot").alias("slot_us"), "outcome", "slot")
    )
    return slots.groupBy("symbol").applyInPandasWithState(
        watch, GAPS, "last bigint, silent boolean, pending string", "append", GroupStateTimeout.EventTimeTimeout
    )


def joined_runs(runs: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Runs (first, last) in order; those at most ``limit`` apart are one."""
    out: list[list[int]] = []
    for first, newest in sorted(runs):
        if out and first - out[-1][1] <= limit:
            out[-1][1] = max(out[-1][1], newest)
        else:
            out.append([first, newest])
    return [(a, b) for a, b in out]


def receipt_runs(times: pd.Series, limit: int) -> list[tuple[int, int]]:
    """Receipts as runs without a silence longer than ``limit``: (first, last) of each."""
    at = times.dropna().astype("int64").sort_values().to_numpy()
    if not len(at):
        return []
    cut = (at[1:] - at[:-1] > limit).nonzero()[0]
    first, newest = at[[0, *(cut + 1)]], at[[*cut, len(at) - 1]]
    return list(zip(first.tolist(), newest.tolist(), strict=True))


def decided_alerts(
    last: int | None, stale: bool, runs: list[tuple[int, int]], watermark_us: int, limit: int
) -> tuple[list[tuple[str, int, int]], int | None, bool, list[tuple[int, int]]]:
    """Alerts that the watermark settles: (alerts, end of the last settled run, stale, what still waits).

    A run is settled once the watermark has passed its first receipt: inside it nothing is
    reported, so its end may still lie ahead. A run that waits begins ahead of the watermark.
    """
    out: list[tuple[str, int, int]] = []
    rest: list[tuple[int, int]] = []
    for first, newest in runs:
        if last is not None and first - last <= limit:
            if newest > last:
                last, stale = newest, False
        elif first < watermark_us:
            if last is not None:
                if not stale:
                    out.append((STALE, last + limit, last))
                out.append((RECEIVING, first, first))
            last, stale = newest, False
        else:
            rest.append((first, newest))
    if last is not None and not stale and watermark_us - last > limit:
        out.append((STALE, last + limit, last))
        stale = True
    return out, last, stale, rest


def staleness_alerts(df: DataFrame, *, by: str, time: str, limit_seconds: float, watermark: str) -> DataFrame:
    """One STALE row per silence longer than the limit, one RECEIVING row when a symbol comes back.

    STALE carries the moment the limit was reached, RECEIVING the first receipt after it. The
    clock is the watermark, which all symbols move together, so the silence of
    one symbol is noticed while others go on. The state holds runs of receipts without such a
    silence, so its size follows the silences inside the watermark delay, not the receipts.
    """
    limit = to_us(limit_seconds)

    def watch(ids: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, stale, pending = None, False, []
        if state.exists:
            last, stale, waiting = state.get
            last = None if last < 0 else last
            pending = [(a, b) for a, b in json.loads(waiting)]
        mark = state.getCurrentWatermarkMs() * 1000
        for frame in frames:
            pending = joined_runs([*pending, *receipt_runs(frame["at_us"], limit)], limit)
        out, last, stale, pending = decided_alerts(last, stale, pending, mark, limit)
        if out:
            yield pd.DataFrame(out, columns=["status", "at_us", "newest_us"]).assign(symbol=ids[0])[
                ["symbol", "status", "at_us", "newest_us"]
            ]
        state.update((-1 if last is None else last, stale, json.dumps(pending)))
        if pending or (last is not None and not stale):
            due = pending[0][0] + 1000 if pending else last + limit + 1000
            state.setTimeoutTimestamp(max(due // 1000, state.getCurrentWatermarkMs() + 1))

    rows = df.withWatermark(time, watermark).select(F.col(by).cast("string").alias("symbol"), us(time).alias("at_us"), time)
    return rows.groupBy("symbol").applyInPandasWithState(
        watch, ALERTS, "last bigint, stale boolean, pending string", "append", GroupStateTimeout.EventTimeTimeout
    )


# Why a derived row has no usable parent.
MISSING_PARENT, CONFLICTING_PARENT, PARENT_TIME = "MISSING_RAW_PARENT", "CONFLICTING_RAW_PARENT", "RAW_PARENT_TIMESTAMP_MISMATCH"


def link_to_parent(
    derived: DataFrame,
    raw: DataFrame,
    *,
    parent: str,
    key: str,
    derived_time: str,
    raw_time: str,
    within: str,
    watermark: str,
    digest: tuple[str, str] | None = None,
    parent_time: str | None = None,
) -> DataFrame:
    """Every derived row with its RAW parent, or with the reason why it has none.

    Left outer: a derived row waits until the watermark shows that no parent received at
    most ``within`` before it can come any more; then it leaves the state as MISSING_RAW_PARENT.
    ``digest`` (derived column, raw column) and ``parent_time`` (the receipt that the derived row
    claims) must agree with the parent. ``reason`` is NULL for linked rows.
    """
    left = derived.withWatermark(derived_time, watermark)
    right = raw.withWatermark(raw_time, watermark)
    near = F.col(derived_time).between(F.col(raw_time), F.col(raw_time) + F.expr(f"INTERVAL {within}"))
    joined = left.join(right, (F.col(parent) == F.col(key)) & near, "left_outer")
    reason = F.when(F.col(key).isNull(), MISSING_PARENT)
    if digest is not None:
        reason = reason.when(~F.col(digest[0]).eqNullSafe(F.col(digest[1])), CONFLICTING_PARENT)
    if parent_time is not None:
        reason = reason.when(~F.col(parent_time).eqNullSafe(F.col(raw_time)), PARENT_TIME)
    return joined.withColumn("reason", reason)
