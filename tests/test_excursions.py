"""Excursions against their definition, on odd rows, and without a frame that slides."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tickevidence.operators import features

START = dt.datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = "k string, t timestamp, p double, s int"


def moves(frame, horizon):
    return features.excursions(frame, by=["k"], time="t", price="p", keep=["s"], horizon=horizon)


def test_equal_the_definition_on_odd_rows(spark):
    pick = random.Random(3)
    rows = []
    for s in range(400):
        # Many equal times, times at multiples of the horizon, a day before 1970, missing prices, times and keys.
        at = START + dt.timedelta(seconds=pick.choice((0, 10, 20, 30)) + pick.randrange(0, 60), microseconds=pick.choice((0, 1, 999_999)))
        at = None if s % 37 == 5 else dt.datetime(1969, 12, 31, 23, 59, s % 60) if s % 9 == 4 else at
        price = None if s % 11 == 3 else float("nan") if s % 53 == 7 else float(pick.randrange(-20, 20))
        rows.append((pick.choice(("a", "b", None)), at, price, s))
    got = {r["s"]: (r["mfe_pts"], r["mae_pts"]) for r in moves(spark.createDataFrame(rows, SCHEMA), 10).collect()}
    reach, want = dt.timedelta(seconds=10), {}
    order = lambda p: (p != p, p)  # noqa: E731  Spark: NaN is the largest number
    for k, t, p, s in rows:
        if t is None:
            continue
        ahead = [q for j, u, q, _ in rows if j == k and u is not None and t < u <= t + reach and q is not None]
        if not ahead:
            want[s] = (None, None)
        elif p is None:
            want[s] = (0.0, 0.0)
        else:
            high, low = max(ahead, key=order) - p, min(ahead, key=order) - p
            want[s] = (max(0.0, high, key=order), min(0.0, low, key=order))
    assert {s: tuple(map(str, v)) for s, v in got.items()} == {s: tuple(map(str, v)) for s, v in want.items()}


def test_no_frame_slides(spark):
    plan = moves(spark.createDataFrame([], SCHEMA), 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RangeFrame, unboundedpreceding$()") + plan.lower().count("specifiedwindowframe(rangeframe, unboundedpreceding") >= 4
    assert "specifiedwindowframe(rangeframe, 1," not in plan.lower()


def test_many_rows_within_one_horizon(spark):
    n = 60_000
    frame = spark.range(n).select(
        F.lit("a").alias("k"), F.timestamp_micros(F.col("id") * 100).alias("t"), F.col("id").cast("double").alias("p"), F.col("id").cast("int").alias("s")
    )
    out = moves(frame, 3600).agg(F.sum("mfe_pts").alias("up"), F.min("mae_pts").alias("down"), F.count_if(F.col("mfe_pts").isNull()).alias("last")).first()
    assert (out["up"], out["down"], out["last"]) == (float((n - 1) * n // 2), 0.0, 1)
