"""Raw tapes with unusable rows: quarantined with a reason before the gate, which stays strict."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tapes import rows, tape

from __spark_entry__ import queries
from tickevidence.operators.quality import require_clean, research_gate
from tickevidence.plans.research import accepted_rows

ZONE = "Asia/Kolkata"


def test_unusable_rows_are_quarantined_with_their_reason(spark, tmp_path):
    data = rows(range(0, 50, 5))
    data[0]["spot"] = data[1]["spot"] = 0.0
    data[2]["spot"] = float("nan")
    data[5]["spot"] = None
    data[7]["contract_key"] = None
    raw = tape(spark, data)
    with pytest.raises(ValueError, match="spot_not_finite_positive=4"):
        require_clean(research_gate(raw, ZONE))
    good = accepted_rows(raw, str(tmp_path), ZONE)
    require_clean(research_gate(good, ZONE))
    bad = spark.read.parquet(str(tmp_path / "quarantine_rows"))
    wrong = {data[i]["observation_id"]: "spot_not_finite_positive" for i in (0, 1, 2, 5)} | {data[7]["observation_id"]: "missing_contract"}
    assert {r["observation_id"]: r["reason"] for r in bad.collect()} == wrong
    assert good.columns == raw.columns and good.count() + len(wrong) == len(data)


def test_all_rows_of_a_repeated_natural_key_are_quarantined(spark, tmp_path):
    data = rows(range(0, 50, 5))
    twins = [{**r, "observation_id": r["observation_id"] + "-b", "spot": r["spot"] + 3, "oi": 7} for r in (data[4], data[5], data[10])]
    raw = tape(spark, data + twins)
    with pytest.raises(ValueError, match="ambiguous_quote=2, conflicting_spot=2"):
        require_clean(research_gate(raw, ZONE))
    good = accepted_rows(raw, str(tmp_path), ZONE)
    require_clean(research_gate(good, ZONE))
    bad = {r["observation_id"]: r["reason"] for r in spark.read.parquet(str(tmp_path / "quarantine_rows")).collect()}
    both = {r["observation_id"] for r in (data[4], data[5], data[10], *twins)}
    assert bad == dict.fromkeys(both, "conflicting_or_repeated_natural_key: all matching rows quarantined")
    assert good.columns == raw.columns and {r[0] for r in good.select("observation_id").collect()} == {r["observation_id"] for r in data} - both


def test_repeated_ids_refuse_the_tape_with_everything_in_it(spark, tmp_path):
    data = rows(range(0, 50, 5))
    other = {**data[0], "observation_id": "other"}
    for name, more in (("same", [data[0]]), ("three", [data[0], other]), ("elsewhere", [other, {**data[9], "observation_id": "other"}])):
        good = accepted_rows(tape(spark, data + more), str(tmp_path / name), ZONE)
        assert good.count() == len(data) + len(more)
        with pytest.raises(ValueError, match="ambiguous_quote=[12], repeated_observation_id=1"):
            require_clean(research_gate(good, ZONE))


def test_two_contracts_of_a_side_at_one_receipt_still_refuse_the_tape(spark, tmp_path):
    data = rows(range(0, 50, 5))
    data.append({**data[0], "observation_id": "other", "contract_key": "another"})
    good = accepted_rows(tape(spark, data), str(tmp_path), ZONE)
    with pytest.raises(ValueError, match="ambiguous_quote=1"):
        require_clean(research_gate(good, ZONE))


def test_contradicting_rows_still_refuse_the_tape(spark, tmp_path):
    data = rows(range(0, 50, 5))
    data[3]["spot"] += 1
    data[9]["observation_id"] = data[8]["observation_id"]
    good = accepted_rows(tape(spark, data), str(tmp_path), ZONE)
    with pytest.raises(ValueError, match="conflicting_spot=1, repeated_observation_id=1"):
        require_clean(research_gate(good, ZONE))


def test_metrics_of_events_with_a_zero_and_a_missing_value(spark, tmp_path):
    first = dt.datetime(2024, 1, 1)
    events = [(i, first + dt.timedelta(minutes=20 * i), "view", 100.0 + i % 40, '{"k": %d}' % (i % 19)) for i in range(288)]
    events[7] = (*events[7][:3], 0.0, events[7][4])
    events[9] = (*events[9][:3], None, events[9][4])
    schema = "event_id bigint, ts timestamp, event_type string, value double, props string"
    spark.createDataFrame(events, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    row = queries()["research_metrics"](spark, str(tmp_path)).first()
    assert row["source_rows"] == 2 * (288 - 2) and row["sample_count"] > 0


def _events(spark, folder, rows):
    schema = "event_id bigint, ts timestamp, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{folder}/events.parquet")


def test_runs_over_events_that_meet_at_one_time(spark, tmp_path):
    first = dt.datetime(2024, 1, 1)
    events = [(i, first + dt.timedelta(minutes=20 * i), "view", 100.0 + i % 40, '{"k": %d}' % (i % 19)) for i in range(288)]
    twin = (1000, *events[7][1:3], 55.0, events[7][4])
    _events(spark, tmp_path / "one", [*events, twin])
    row = queries()["research_metrics"](spark, str(tmp_path / "one")).first()
    assert row["source_rows"] == 2 * (288 - 1) and row["sample_count"] > 0
    checks = queries()["research_audit"](spark, str(tmp_path / "one"))
    assert checks.count() == 13 and checks.filter("not passed").isEmpty()


def test_a_run_in_which_every_quote_is_ambiguous_says_so(spark, tmp_path):
    first = dt.datetime(2024, 1, 1)
    events = [(i, first + dt.timedelta(minutes=20 * (i // 2)), "view", 100.0, '{"k": 1}') for i in range(96)]
    _events(spark, tmp_path, events)
    row = queries()["research_metrics"](spark, str(tmp_path)).first()
    assert (row["source_rows"], row["sample_count"], row["status"]) == (0, 0, "INSUFFICIENT_DATA")
