import copy
import json

from tickevidence.operators.quality import first_failure
from tickevidence.sources import payloads, tables

GOOD = {
    "version": 2, "kind": "DERIVED", "scheduled_at": "2024-01-15T05:00:00Z", "started_at": "2024-01-15T05:00:01Z",
    "received_at": "2024-01-15T05:00:03Z",
    "body": {
        "symbol": "IDX25JAN24100CE", "raw_key": "a" * 64, "raw_digest": "b" * 64, "raw_received_at": "2024-01-15T05:00:01Z",
        "expiry": "25JAN24", "strike": 100, "side": "CE",
        "values": {"iv": 20, "delta": 0.5, "gamma": 0.1, "theta": -1, "vega": 2, "rho": 0.1, "option_price": 3, "forward_price": None, "spot_price": 101, "interest_rate": 0},
    },
}
FAULTS = [
    (("started_at",), "2024-01-15T04:00:00Z", "InvertedTimestamps"),
    (("body", "strike"), 150, "ContractMismatch"),
    (("body", "raw_key"), "xyz", "InvalidParentIdentity"),
    (("received_at",), "2024-01-15T05:00:09Z", "LateCalculation"),
    (("body", "values", "iv"), None, "InvalidNumber"),
    (("body", "values", "spot_price"), None, "MissingCalculationPrice"),
    (("body", "values", "gamma"), -0.1, "InvalidCalculation"),
    (("body", "values", "delta"), -0.5, "InvalidDelta"),
]


def test_derived_contract(spark):
    docs = [(0, json.dumps(GOOD))]
    for i, (path, value, _) in enumerate(FAULTS, 1):
        doc = copy.deepcopy(GOOD)
        spot = doc
        for part in path[:-1]:
            spot = spot[part]
        spot[path[-1]] = value
        docs.append((i, json.dumps(doc)))
    read = payloads.read_envelopes(spark.createDataFrame(docs, "i int, payload string"), "payload")
    got = {r["i"]: r["reason"] for r in read.select("i", first_failure(payloads.derived_contract("IDX")).alias("reason")).collect()}
    assert got == {0: None, **{i: reason for i, (_, _, reason) in enumerate(FAULTS, 1)}}


def test_table_pair_files(spark, tmp_path):
    rows = spark.sql("SELECT 'a' AS id, timestamp'2024-01-15 05:00:00' AS at, cast(NULL AS double) AS v, date'2024-01-15' AS trading_date")
    tables.write_table_pair(rows, rows, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out" / "options.csv").glob("part-*.csv"))
    assert text.splitlines() == ["id,at,v,trading_date", "a,2024-01-15T05:00:00.000000Z,,2024-01-15"]
    assert spark.read.parquet(str(tmp_path / "out" / "observations.parquet")).count() == 1
