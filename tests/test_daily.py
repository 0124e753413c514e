"""The daily job judges every day by itself."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from tickevidence.operators import cleaning
from tickevidence.operators.quality import pair_violations, validate_pair
from tickevidence.plans import daily
from tickevidence.sources import tables

DAYS = [dt.date(2026, 9, d) for d in (14, 15, 16, 17)]
SCHEMA = "source_row bigint, timestamps string, underlying string, spot string, iv string, volume string, oi string, ltp string, strike string, optiontype string, expirydate string, trading_date date"


def quotes():
    """Two good rows a day; the second day has two bad ones besides."""
    rows = []
    for n, day in enumerate(DAYS):
        for i in range(4 if n == 1 else 2):
            spot = "25000" if i < 2 else "none"
            at = f"{day}T10:00:0{i}+05:30"
            rows.append((n * 10 + i, at, "NIFTY", spot, "15", "7", "9", "100.5", "25000", "CE", "2026-09-29", day))
    return rows


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily") / "root")
    raw = spark.createDataFrame(quotes(), SCHEMA)
    raw = cleaning.rename(raw, {c: c for c in raw.columns if c not in ("source_row", "trading_date")})
    plan = raw.select("trading_date").distinct().withColumn("status", F.lit("READY"))
    plan = plan.unionByName(spark.sql("SELECT date'2026-09-19' AS trading_date, 'SKIPPED_WEEKEND' AS status"))
    policy = cleaning.CleaningPolicy(iv_unit="percent", max_quarantine_fraction=0.25)
    integrity = spark.createDataFrame([(d, d != DAYS[3]) for d in DAYS], "trading_date date, passed boolean")

    def enrich(rows):
        bad = (F.col("trading_date") == F.lit(DAYS[2])) & (F.col("source_row") == 20)
        return rows.withColumn("optiontype", F.when(bad, "XX").otherwise(F.col("optiontype")))

    out = daily.clean_days(raw, plan, policy, root, "r1", "2026-09-18 00:00:00", integrity=integrity, enrich=enrich)
    return root, {r["trading_date"]: r["status"] for r in out.collect()}


def test_each_day_has_its_own_verdict(spark, result):
    root, status = result
    assert status == {
        DAYS[0]: "PUBLISHED", DAYS[1]: "QUARANTINED", DAYS[2]: "QUARANTINED", DAYS[3]: "QUARANTINED", dt.date(2026, 9, 19): "SKIPPED_WEEKEND",
    }
    broken = [tuple(r) for r in daily.violations(spark, root, "r1").select("trading_date", "rule", "violations").collect()]
    assert broken == [(DAYS[2], "options.optiontype: expected CE or PE", 1)]


def test_tables_commits_and_candidates(spark, result):
    root, _ = result
    observations, options = daily.day_tables(spark, root, "r1")
    for table in (observations, options):
        found = {(r["trading_date"], r["published"]): r["n"] for r in table.groupBy("trading_date", "published").agg(F.count("*").alias("n")).collect()}
        assert found == {(d, d == DAYS[0]): 2 for d in DAYS}
    commits = tables.committed(spark, root).collect()
    assert [(r["trading_date"], r["status"], r["row_counts"]) for r in commits] == [(DAYS[0], "PUBLISHED", {"observations": 2, "options": 2})]
    listed = tables.committed(spark, root).select(F.inline("artifacts"))
    assert tables.artifact_problems(listed, tables.file_digests(spark, root + "/data", "*.parquet")).isEmpty()
    lines = [json.loads(x) for p in glob.glob(f"{root}/quarantine/revision=r1/quarantine.jsonl/trading_date=2026-09-15/*.json") for x in open(p)]
    assert sorted(x["source_row"] for x in lines) == [12, 13] and all(x["reason"].startswith("spot") for x in lines)
    assert glob.glob(f"{root}/data/revision=r1/options.csv/day=2026-09-14/*.csv") and not glob.glob(f"{root}/data/revision=r1/options.csv/day=2026-09-15")


def test_rules_per_day_add_up_to_the_rules_of_the_pair(spark, result):
    observations, options = daily.day_tables(spark, result[0], "r1")
    options = options.withColumn("gamma", F.when(F.dayofmonth("trading_date") > 15, -1.0)).unionByName(options.filter("trading_date = '2026-09-14'").limit(1))
    observations = observations.filter("NOT (trading_date = '2026-09-16' AND source_row = 20)").drop("published")
    options = options.drop("published")
    whole = {r["rule"]: r["violations"] for r in validate_pair(observations.drop("trading_date"), options.drop("trading_date")).collect() if r["violations"]}
    days = pair_violations(observations, options, "trading_date").groupBy("rule").agg(F.sum("violations").alias("n"))
    assert {r["rule"]: r["n"] for r in days.collect()} == whole and len(whole) >= 5
