"""The state of the staleness stream: runs of receipts give the alerts of single receipts."""

import datetime as dt
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickevidence.streaming import timers as T
from tickevidence.streaming.ingest import drain

LIMIT = 20


def by_receipt(times, mark):
    """Alerts by definition, from all receipts at once."""
    out, seen = set(), sorted(set(times))
    done = [t for t in seen if t < mark]
    for a, b in zip(done, done[1:]):
        if b - a > LIMIT:
            out |= {(T.STALE, a + LIMIT, a), (T.RECEIVING, b, b)}
    after = [t for t in seen if t >= mark]
    if done and mark - done[-1] > LIMIT and not (after and after[0] - done[-1] <= LIMIT):
        out.add((T.STALE, done[-1] + LIMIT, done[-1]))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_runs_give_the_alerts_of_single_receipts(seed):
    pick = random.Random(seed)
    delay, newest, mark, late = pick.choice((0, 30, 90)), 0, 0, 0
    state, got, kept = (None, False, []), [], []
    for _ in range(12):
        batch = [max(late, newest + pick.randrange(-80, 60)) for _ in range(pick.choice((0, 1, 6)))]
        kept += batch
        last, stale, runs = state
        for part in (batch[::2], batch[1::2]):  # a batch comes in several frames
            runs = T.joined_runs([*runs, *T.receipt_runs(pd.Series(part, dtype="int64"), LIMIT)], LIMIT)
        alerts, *state = T.decided_alerts(last, stale, runs, mark, LIMIT)
        got += alerts
        newest = max([newest, *batch])
        late, mark = mark, max(mark, newest - delay)  # rows behind the mark of the batch before are dropped
    alerts, *state = T.decided_alerts(*state, mark, LIMIT)
    got += alerts
    assert len(got) == len(set(got)) and set(got) == by_receipt(kept, mark)


def test_the_state_does_not_grow_with_the_receipts():
    runs = T.receipt_runs(pd.Series([*range(0, 50_000, 3), *range(60_000, 90_000, 7), 200_000]).sample(frac=1, random_state=1), LIMIT)
    assert runs == [(0, 49_998), (60_000, 89_995), (200_000, 200_000)]
    assert T.joined_runs([*runs, (49_000, 60_010)], LIMIT) == [(0, 89_995), (200_000, 200_000)]
    assert len(json.dumps(T.decided_alerts(None, False, runs, 100, LIMIT)[3])) < 100
    assert T.receipt_runs(pd.Series([None, None], dtype="float64"), LIMIT) == []


def test_a_dense_symbol_in_one_batch(spark, tmp_path):
    start = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    ids = spark.range(50_000)
    second = start + F.col("id") * 2 + F.when(F.col("id") >= 30_000, 500).otherwise(0)
    rows = ids.select(F.timestamp_seconds(second).alias("ts"), F.lit("x").alias("symbol"))
    end = spark.range(1).select(F.timestamp_seconds(F.lit(start + 200_000)).alias("ts"), F.lit("end").alias("symbol"))
    for part in (rows, end):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = drain(T.staleness_alerts(stream, by="symbol", time="ts", limit_seconds=60, watermark="1 day"), "dense")
    got = sorted((r["status"], r["at_us"] // 1_000_000 - start) for r in out.collect() if r["symbol"] == "x")
    assert got == [(T.RECEIVING, 60_500), (T.STALE, 59_998 + 60), (T.STALE, 100_498 + 60)]
