"""Verified loading: file registry, pair proof, content identity."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tickevidence.sources import verified as V

OBS = "observation_id string, trading_date date, underlying string, spot double, source_version string"
OPT = "observation_id string, trading_date date, underlying string, bid double"
DAYS = [dt.date(2026, 9, 14), dt.date(2026, 9, 15)]


def pair(spark, change=None):
    obs = [(f"{d.day}-{i}", d, "NIFTY", 100.0 + i, "1" if i == 5 else "2") for d in DAYS for i in range(6)]
    opt = [(o, d, u, s / 2) for o, d, u, s, _ in obs]
    if change:
        obs, opt = change(obs, opt)
    return spark.createDataFrame(obs, OBS), spark.createDataFrame(opt, OPT)


def store(tables, root):
    for name, df in zip(("observations", "options"), tables, strict=True):
        df.coalesce(1).write.parquet(f"{root}/{name}")


def problems(v):
    return {(r["subject"], r["problem"]) for r in v.problems.collect()}


def test_registered_files_load_and_give_one_identity(spark, tmp_path):
    store(pair(spark), f"{tmp_path}/a")
    registry = V.register_files(spark, f"{tmp_path}/a")
    got = V.load_verified(spark, f"{tmp_path}/a", registry)
    assert got.require().rows.count() == 10
    assert [tuple(r) for r in got.excluded.collect()] == [("1", 2)]
    first = got.dataset_id.first()
    obs, opt = pair(spark)
    again = V.verify_tables(obs.repartition(7, "spot"), opt.orderBy(F.desc("bid"))).dataset_id.first()
    assert first == again and first["rows"] == 10
    other = pair(spark, lambda a, b: (a[:1] + [(*a[1][:3], 7.0, "2")] + a[2:], b))
    assert V.verify_tables(*other).dataset_id.first()["dataset_id"] != first["dataset_id"]


def test_altered_unverified_and_strange_files_are_problems(spark, tmp_path):
    root = f"{tmp_path}/a"
    store(pair(spark), root)
    rows = V.register_files(spark, root).collect()
    path = glob.glob(f"{root}/options/*.parquet")[0]
    registry = spark.createDataFrame([tuple(r) for r in rows], V.REGISTRY_SCHEMA)
    forged = registry.withColumn("sha256", F.when(F.col("table") == "options", F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    assert {p for _, p in problems(V.load_verified(spark, root, forged))} == {"hash_mismatch"}
    unproved = registry.withColumn("verified", F.col("table") == "observations")
    found = {p for _, p in problems(V.load_verified(spark, root, unproved))}
    assert found == {"artifact was not verified", "id only in observations"}
    unknown = registry.filter("table = 'observations'")
    found = problems(V.load_verified(spark, root, unknown))
    assert ("file:" + path, "artifact is not registered") in found
    fewer = registry.withColumn("rows", F.col("rows") + 1)
    found = {p for _, p in problems(V.load_verified(spark, root, fewer))}
    assert found == {"row count differs from registry: 6 of 7"}
    with pytest.raises(ValueError, match="row count differs"):
        V.load_verified(spark, root, fewer).require()


@pytest.mark.parametrize(
    ("change", "want"),
    [
        (lambda a, b: (a, [*b[:2], ("other", *b[2][1:]), *b[3:]]), {("14-2", "id only in observations"), ("other", "id only in options")}),
        (lambda a, b: (a, [*b, b[0]]), {("14-0", "repeated id")}),
        (lambda a, b: (a, [(b[0][0], b[0][1], "BANKNIFTY", 1.0), *b[1:]]), {("14-0", "conflicting column: underlying")}),
        (lambda a, b: (a, [(b[0][0], None, "NIFTY", 1.0), *b[1:]]), {("14-0", "conflicting column: trading_date")}),
        (lambda a, b: ([(None, *a[0][1:]), *a[1:]], b), {("(none)", "missing id"), ("14-0", "id only in options")}),
        (lambda a, b: ([(*a[0][:2], None, *a[0][3:]), *a[1:]], [(b[0][0], b[0][1], None, 1.0), *b[1:]]), set()),
    ],
)
def test_pair_problems(spark, change, want):
    got = V.verify_tables(*pair(spark, change))
    assert problems(got) == want


def test_no_rows(spark):
    obs, opt = pair(spark)
    got = V.verify_tables(obs.limit(0), opt.limit(0)).require()
    assert got.rows.count() == 0 and got.dataset_id.first()["rows"] == 0


def test_pair_proof_shuffles_each_table_once(spark):
    plan = V.prove_pair(*pair(spark))[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_differing_buckets_name_the_part(spark):
    obs, _ = pair(spark)
    before = V.bucket_digests(obs, "trading_date")
    after = V.bucket_digests(obs.withColumn("spot", F.when(F.col("observation_id") == "15-3", 1.0).otherwise(F.col("spot"))), "trading_date")
    assert {r["part"] for r in V.differing_buckets(before, after).collect()} == {"2026-09-15"}
    assert V.differing_buckets(before, before).isEmpty()
