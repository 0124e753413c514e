from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tapes import OPEN, rows, tape

from tickevidence.operators import audit as A
from tickevidence.operators import rules as R
from tickevidence.operators.sampling import SamplePolicy
from tickevidence.plans.research import run_research

SAMPLING = SamplePolicy(min_move=50)
SEARCH = R.SearchPolicy(discovery_fraction=0.5, min_support=2, discovery_version=R.SINGLE)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    data = []
    for day in (0, 1):
        at = lambda s, side, d=day: OPEN + timedelta(days=d, seconds=s + 2)
        data += rows(range(0, 1505, 5), spot=lambda s: 25000 + min(s, 600) * 0.2, day=day, iv_available_at=at, greeks_available_at=at)
    root = str(tmp_path_factory.mktemp("run"))
    source = str(tmp_path_factory.mktemp("tape") / "t")
    tape(spark, data).write.parquet(source)
    out, checks, verdict = run_research(spark.read.parquet(source), root, "d", SAMPLING, SEARCH, gate_zone="Asia/Kolkata")
    assert checks.filter("not passed").isEmpty()
    assert verdict.first()["status"] == "PASS"
    # A second run of the same inputs reads the finished stages.
    again, _, _ = run_research(spark.read.parquet(source), root, "d", SAMPLING, SEARCH)
    assert again.samples.inputFiles() == out.samples.inputFiles()
    return out


def failed(run):
    return {r["check"] for r in A.audit(run).filter("not passed").collect()}


def test_tampered_feature(run):
    bad = run.samples.withColumn("CE_delta", F.col("CE_delta") + 0.1)
    assert "independent_source_feature_arithmetic" in failed(replace(run, samples=bad))


def test_tampered_end_price_and_label(run):
    bad = run.samples.withColumn("end_spot", F.col("end_spot") + 1)
    assert "independent_source_event_checks" in failed(replace(run, samples=bad))


def test_dropped_occurrence_and_changed_summary(run):
    first = run.hits.orderBy("condition_id", "sample_id").first()["sample_id"]
    fewer = run.hits.filter(F.col("sample_id") != first)
    more = run.summaries.withColumn("matches", F.col("matches") + 1)
    got = failed(replace(run, hits=fewer, summaries=more))
    assert {"exact_occurrence_set_and_values", "exact_summary_set_and_denominators"} <= got


def test_modified_rule(run):
    bent = run.rules.withColumn(
        "predicates", F.transform("predicates", lambda p: p.withField("threshold", p["threshold"] + 1))
    )
    assert "conditions_frozen_and_bound_to_config" in failed(replace(run, rules=bent))


def test_a_modified_rule_is_not_scanned(run):
    frozen = R.rule_context("d", SAMPLING, SEARCH)
    hits = R.occurrences(run.samples, run.rules, SAMPLING, SEARCH, frozen)
    assert hits.count() == run.hits.count() > 0
    for change in (
        F.transform("predicates", lambda p: p.withField("threshold", p["threshold"] + 1)),
        F.transform("predicates", lambda p: p.withField("operator", F.when(p["operator"] == ">=", "<=").otherwise(">="))),
    ):
        bent = run.rules.withColumn("predicates", change)
        with pytest.raises(Exception, match="frozen rule was modified"):
            R.occurrences(run.samples, bent, SAMPLING, SEARCH, frozen).count()
    with pytest.raises(Exception, match="frozen rule was modified"):
        R.occurrences(run.samples, run.rules, SAMPLING, SEARCH, R.rule_context("other", SAMPLING, SEARCH)).count()


def test_another_tape_under_the_same_id_reuses_nothing(spark, run, tmp_path):
    other = run.tape.withColumn("spot", F.col("spot") + 1)
    root = run.samples.inputFiles()[0].removeprefix("file://").split("/samples-")[0]
    again, _, _ = run_research(other, root, "d", SAMPLING, SEARCH)
    assert again.samples.inputFiles() != run.samples.inputFiles()


def test_foreign_dataset(run):
    assert "artifacts_bound_to_run" in failed(replace(run, dataset_id="other"))


def test_changed_spacing_flag(run):
    flipped = run.hits.withColumn("nonoverlapping", ~F.col("nonoverlapping"))
    assert "exact_occurrence_set_and_values" in failed(replace(run, hits=flipped))
