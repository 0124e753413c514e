"""Streams in several batches: order of arrival, silence, evicted state."""

import datetime as dt
import itertools

import pytest

from tickevidence.streaming import timers as T
from tickevidence.streaming.ingest import drain

START = dt.datetime(2024, 1, 1, 10, 0, 0)
S = 1_000_000


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def stream_of(spark, path, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def slots_of(frame, step):
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp()) * S
    return sorted(
        (r["symbol"], (s - base) // S, r["reason"]) for r in frame.collect() for s in range(r["start_us"], r["end_us"], step)
    )


def test_slots_are_decided_only_behind_the_watermark():
    pending = {0: T.CAPTURED, 10 * S: T.CAPTURED, 30 * S: T.REJECTED}
    gaps, last, silent, rest = T.decided_gaps(None, False, pending, 14 * S, 5 * S, 60 * S)
    assert gaps == [] and last == 0 and rest == {10 * S: T.CAPTURED, 30 * S: T.REJECTED}
    gaps, last, silent, rest = T.decided_gaps(last, silent, rest, 15 * S, 5 * S, 60 * S)
    assert gaps == [(5 * S, 10 * S, 1, T.MISSED)] and last == 10 * S and not silent
    gaps, last, _, rest = T.decided_gaps(last, silent, rest, 40 * S, 5 * S, 60 * S)
    assert gaps == [(15 * S, 30 * S, 3, T.MISSED), (30 * S, 35 * S, 1, T.REJECTED)] and rest == {}
    gaps, last, silent, _ = T.decided_gaps(last, False, {}, 95 * S, 5 * S, 60 * S)
    assert gaps == [(35 * S, 95 * S, 12, T.MISSED)] and silent and last == 90 * S


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_order_of_arrival_does_not_matter(order):
    slots = [{0: T.CAPTURED, 5 * S: T.CAPTURED}, {10 * S: T.SKIPPED}, {25 * S: T.CAPTURED}]
    pending = {}
    for k in order:
        pending |= slots[k]
    gaps = T.decided_gaps(None, False, pending, 100 * S, 5 * S, 600 * S)[0]
    assert sorted(gaps) == [(10 * S, 15 * S, 1, T.SKIPPED), (15 * S, 25 * S, 2, T.MISSED)]


def test_gaps_with_late_rows_silence_and_reasons(spark, tmp_path):
    schema = "ts timestamp, symbol string, result string"
    batches = [
        [(at(0), "x", T.CAPTURED), (at(10), "x", T.CAPTURED), (at(0), "y", T.CAPTURED)],
        [(at(5), "x", T.CAPTURED), (at(20), "x", T.REJECTED), (at(20), "x", T.SKIPPED)],  # :05 comes late, inside the watermark
        [(at(60), "x", T.CAPTURED)],
        [(at(200), "x", T.CAPTURED)],
        [(at(400), "x", T.CAPTURED)],
    ]
    stream = stream_of(spark, str(tmp_path / "in"), batches, schema)
    out = drain(
        T.slot_gaps(stream, by="symbol", time="ts", seconds=5, watermark="30 seconds", silence_seconds=100, outcome="result"), "gaps"
    )
    got = slots_of(out, 5 * S)
    x = [(s, r) for k, s, r in got if k == "x"]
    # The watermark ends at 370: slots up to 365 are decided, 400 is not.
    want = {s: T.MISSED for s in range(0, 370, 5) if s not in (0, 5, 10, 60, 200)} | {20: T.REJECTED}
    assert dict(x) == want and len(x) == len(want)
    # y fell silent; nobody else's rows hide that.
    assert [s for k, s, _ in got if k == "y"] == list(range(5, 370, 5))


def test_staleness_alerts_once_and_clears(spark, tmp_path):
    schema = "ts timestamp, symbol string"
    batches = [[(at(0), "x"), (at(0), "y")], [(at(10), "x"), (at(30), "y")], [(at(100), "y")], [(at(110), "x"), (at(115), "y")], [(at(300), "z")]]
    stream = stream_of(spark, str(tmp_path / "in"), batches, schema)
    out = drain(T.staleness_alerts(stream, by="symbol", time="ts", limit_seconds=20, watermark="5 seconds"), "stale")
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp()) * S
    got = sorted((r["symbol"], (r["at_us"] - base) // S, r["status"]) for r in out.collect())
    assert got == [
        ("x", 30, T.STALE), ("x", 110, T.RECEIVING), ("x", 130, T.STALE),
        ("y", 20, T.STALE), ("y", 30, T.RECEIVING), ("y", 50, T.STALE), ("y", 100, T.RECEIVING), ("y", 135, T.STALE),
    ]


def test_parentless_rows_are_listed_and_leave_the_state(spark, tmp_path):
    raw = stream_of(spark, str(tmp_path / "raw"), [[("r1", "d1", at(0))], [("r2", "d2", at(100))], [("end", "e", at(1000))]], "raw_id string, raw_digest string, raw_at timestamp")
    rows = [
        [("a", "r1", "d1", at(0), at(2)), ("b", "r9", "d1", at(0), at(2)), ("c", "r1", "zz", at(0), at(1))],
        [("d", "r2", "d2", at(99), at(101)), ("e", "r1", "d1", at(0), at(90)), ("f", None, None, None, at(90))],
        [("end", "end", "e", at(1000), at(1000))],
    ]
    derived = stream_of(spark, str(tmp_path / "derived"), rows, "derived_id string, parent_id string, parent_digest string, parent_at timestamp, derived_at timestamp")
    linked = T.link_to_parent(
        derived, raw, parent="parent_id", key="raw_id", derived_time="derived_at", raw_time="raw_at", within="3 SECONDS",
        watermark="10 seconds", digest=("parent_digest", "raw_digest"), parent_time="parent_at",
    )
    got = {r["derived_id"]: (r["raw_id"], r["reason"]) for r in drain(linked, "linked").collect()}
    assert got == {
        "a": ("r1", None), "b": (None, T.MISSING_PARENT), "c": ("r1", T.CONFLICTING_PARENT), "d": ("r2", T.PARENT_TIME),
        "e": (None, T.MISSING_PARENT), "f": (None, T.MISSING_PARENT), "end": ("end", None),
    }
