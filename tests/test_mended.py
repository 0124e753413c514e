"""Cases that gave wrong answers once."""

import datetime as dt

import pytest

from tickevidence.operators import rules as R
from tickevidence.operators.segments import with_segments
from tickevidence.sources import tables
from tickevidence.streaming.ingest import drain
from tickevidence.streaming.timers import slot_gaps

START = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_csv_with_another_header_fails(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, str(tmp_path)).collect()


def test_csv_with_blanks_around_names(spark, tmp_path):
    (tmp_path / "1.csv").write_text(" a , b\n1,2\n")
    assert tables.read_csv(spark, str(tmp_path)).columns == ["a", "b"]
    assert tables.read_csv(spark, str(tmp_path)).count() == 1


def test_current_revisions_of_three_statuses(spark):
    rows = [("d1", 1, 1, "PUBLISHED"), ("d2", 1, 1, "RETRY_PENDING"), ("d3", 1, 1, "LOCAL_PASS"), ("d4", 1, 1, "FAILED")]
    progress = spark.createDataFrame(rows, "trading_date string, revision int, finished_at int, status string")
    good, skipped = tables.current_revisions(progress, progress.limit(0))
    assert {r["trading_date"] for r in good.collect()} == {"d1", "d2", "d3"}
    assert [(r["trading_date"], r["reason"]) for r in skipped.collect()] == [("d4", "failed")]


def test_rows_without_time_keep_a_null_segment(spark):
    rows = [("k", None, 0), ("k", START, 1), ("k", START + dt.timedelta(seconds=5), 2), ("k", START + dt.timedelta(hours=9), 3)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, id int")
    got = {r["id"]: r["segment"] for r in with_segments(df, by=["key"], time="ts", tie="id", max_gap=10).collect()}
    assert got == {0: None, 1: 0, 2: 0, 3: 1}


def test_no_rule_without_an_evaluation_session(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    samples = spark.createDataFrame([(d, "UP") for d in days], "trading_date date, label string")
    assert R.training_rows(samples, R.SearchPolicy(discovery_end="2024-01-31")).count() == 0
    assert R.training_rows(samples.filter("trading_date = '2024-01-01'"), R.SearchPolicy()).count() == 0
    assert R.training_rows(samples, R.SearchPolicy(discovery_end="2024-01-02")).count() == 2


def test_late_slot_opens_no_gap(spark, tmp_path):
    schema = "ts timestamp, symbol string"
    for seconds in ((0, 10), (5,), (15,)):  # one file and one batch each, oldest first
        batch = [(START + dt.timedelta(seconds=s), "x") for s in seconds]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = drain(slot_gaps(stream, by="symbol", time="ts", seconds=5, watermark="1 day", silence_seconds=60), "gaps")
    assert out.count() == 0
