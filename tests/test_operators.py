import math
import random
from bisect import bisect_right
from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickevidence.functions.greeks import with_erfc
from tickevidence.operators import asof, cleaning, explorer, features, joins, quality, rules, segments, stats
from tickevidence.sources import tables

T0 = datetime(2024, 3, 4, tzinfo=UTC)


def series(spark, seconds, key="a"):
    return spark.createDataFrame([(key, T0 + timedelta(seconds=s), i) for i, s in enumerate(seconds)], "k string, t timestamp, i int")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 400), min_size=1, max_size=40, unique=True),
    st.lists(st.integers(0, 400), min_size=1, max_size=40, unique=True),
    st.booleans(),
    st.sampled_from([1, 7, 50]),
)
def test_asof_matches_bisect(spark, right, left, strict, block):
    right = sorted(right)
    probes = spark.createDataFrame([("a", T0 + timedelta(seconds=s), s) for s in left], "k string, at timestamp, s int")
    out = asof.asof_backward(
        probes, series(spark, right), by=["k"], probe_time="at", series_time="t", tolerance=20, payload=["i"], strict=strict, block_seconds=block
    )
    for r in out.collect():
        j = bisect_right(right, r["s"] - (1 if strict else 0)) - 1
        want = j if j >= 0 and r["s"] - right[j] <= 20 else None
        assert r["i"] == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 500), min_size=1, max_size=60, unique=True), st.sampled_from([3, 20, 1000]))
def test_segments_match_a_loop(spark, seconds, block):
    seconds = sorted(seconds)
    out = segments.with_segments(series(spark, seconds), by=["k"], time="t", tie="i", max_gap=10, block_seconds=block)
    got = [r["segment"] for r in out.orderBy("t").collect()]
    want, n = [], 0
    for a, b in zip([seconds[0], *seconds], seconds):
        n += b - a > 10
        want.append(n)
    assert got == want


def test_previous_row_crosses_empty_blocks(spark):
    out = segments.with_previous(series(spark, [0, 1, 500, 501]), by=["k"], time="t", tie="i", payload=["i"], block_seconds=10)
    assert [r["previous"]["i"] if r["previous"] else None for r in out.orderBy("t").collect()] == [None, 0, 1, 2]


def test_greedy_spacing_reference_case(spark):
    df = spark.createDataFrame([("a", s, s + 305) for s in (0, 60, 300, 305, 360, 610, 615)], "k string, s bigint, e bigint")
    out = segments.greedy_spacing(df, by=["k"], start="s", end="e", carry=[])
    assert sorted(r["s"] for r in out.collect() if r["independent"]) == [0, 305, 610]


def test_quantiles_ranks_and_correlations(spark):
    rng = random.Random(7)
    data = [(g, float(rng.choice([1, 2, 2, 3, rng.random()])), rng.random()) for g in "ab" for _ in range(300)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    pdf = df.toPandas()
    for r in stats.exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.9]).collect():
        want = pdf[pdf.g == r["g"]].x.quantile([0.25, 0.5, 0.9]).tolist()
        assert [r["q25"], r["q50"], r["q90"]] == pytest.approx(want)
    for r in stats.correlations(stats.with_pooled(df, "g"), ["g"], "x", "y").collect():
        mine = pdf if r["g"] == "POOLED" else pdf[pdf.g == r["g"]]
        assert r["pearson"] == pytest.approx(mine.x.corr(mine.y))
        assert r["spearman"] == pytest.approx(mine.x.rank().corr(mine.y.rank()))
    flat = spark.createDataFrame([("c", 1.0, 2.0)] * 5, "g string, x double, y double")
    assert stats.correlations(flat, ["g"], "x", "y").first()["pearson"] is None
    assert stats.exact_quantiles(spark.createDataFrame([(0, float(v)) for v in (1, 2, 4, 8)], "g int, x double"), ["g"], "x", [0.25, 0.5, 0.75]).first()[
        "q25"
    ] == pytest.approx(1.75)


def test_erfc(spark):
    xs = [-30.0, -2.0, -0.3, 0.0, 0.2, 0.47, 1.0, 3.9, 4.1, 10.0, 28.0]
    out = with_erfc(spark.createDataFrame([(x,) for x in xs], "x double"), {"e": F.col("x")})
    for r in out.collect():
        assert r["e"] == pytest.approx(math.erfc(r["x"]), rel=1e-13, abs=0)


BASE = {
    "timestamps": "2026-09-14T09:20:00", "underlying": "IDX", "symbol": "S", "exchange": "X", "spot": "25000", "iv": "20", "volume": "5",
    "oi": "9007199254740993", "ltp": "1.5", "strike": "25000", "optiontype": "call", "expirydate": "15SEP26",
}


def cleaned(spark, changes, **policy):
    data = [(i, {**BASE, **c}) for i, c in enumerate(changes)]
    names = list(BASE)
    df = spark.createDataFrame([(i, *[d.get(n) for n in names]) for i, d in data], "source_row bigint, " + ", ".join(f"{n} string" for n in names))
    full = cleaning.rename(df, {n: n for n in names})
    return cleaning.clean(full, cleaning.CleaningPolicy(iv_unit="percent", max_quarantine_fraction=1.0, **policy))


FAULTS = [
    ({"spot": "0"}, "spot: must be positive"),
    ({"spot": ""}, "spot: required value is missing"),
    ({"spot": "inf"}, "spot: nonfinite value"),
    ({"spot": "true"}, "spot: invalid numeric value"),
    ({"ltp": "-1"}, "ltp: must be nonnegative"),
    ({"volume": "1.5"}, "volume: must be an integer within signed 64-bit range"),
    ({"volume": "9223372036854775808"}, "volume: must be an integer within signed 64-bit range"),
    ({"timestamps": "1700000000"}, "timestamps: numeric timestamps require timestamp_unit"),
    ({"timestamps": "2026-09-14 09:20:00.0000001"}, "timestamps: sub_microsecond_timestamp"),
    ({"timestamps": "14/09/2026"}, "timestamps: expected an unambiguous ISO-8601 timestamp"),
    ({"expirydate": "01SEP26"}, "expirydate: expiry precedes observation timestamp"),
    ({"expirydate": "1700000000"}, "expirydate: numeric expiry dates are ambiguous"),
    ({"expirydate": "15XXX26"}, "expirydate: invalid date"),
    ({"optiontype": "straddle"}, "optiontype: expected CE/CALL/C or PE/PUT/P"),
]


def test_malformed_values_quarantine_the_row(spark):
    got = cleaned(spark, [{"strike": str(100 + i), **change} for i, (change, _) in enumerate(FAULTS)])
    assert {r["source_row"]: r["reason"] for r in got.quarantine.collect()} == dict(enumerate(r for _, r in FAULTS))
    assert got.counts.first()["reconciled"]


def test_clean_values_duplicates_and_conflicts(spark):
    got = cleaned(spark, [{}, {}, {"strike": "25050"}, {"strike": "25050", "ltp": "9"}, {"strike": "25100"}, {"strike": "25100", "spot": "x"}])
    rows = got.accepted.collect()
    assert [r["source_row"] for r in rows] == [0]
    assert rows[0]["oi"] == 9007199254740993 and rows[0]["iv"] == 0.2 and rows[0]["optiontype"] == "CE"
    assert rows[0]["timestamps"].astimezone(UTC) == datetime(2026, 9, 14, 3, 50, tzinfo=UTC) or rows[0]["timestamps"].hour == 3
    reasons = {r["source_row"]: r["reason"] for r in got.quarantine.collect()}
    # A twin with a bad price still makes its counterpart ambiguous.
    assert set(reasons) == {2, 3, 4, 5} and reasons[4] == cleaning.CONFLICT and reasons[5].startswith("spot")
    counts = got.counts.first()
    assert (counts["accepted"], counts["quarantined"], counts["duplicates_removed"], counts["input_rows"]) == (1, 4, 1, 6)
    assert quality.validate_pair(got.observations, got.options).filter("violations > 0").isEmpty()


def test_ids_ignore_row_position(spark):
    a = cleaned(spark, [{}]).accepted.first()["observation_id"]
    b = cleaned(spark, [{"spot": "bad"}, {}]).accepted
    assert b.count() == 0  # the bad twin has the same key
    c = cleaned(spark, [{"strike": "1"}, {}]).accepted.filter("source_row = 1").first()["observation_id"]
    assert a == c


def test_daylight_saving(spark):
    zone = {"input_zone": "America/New_York"}
    twice = cleaned(spark, [{"timestamps": "2026-11-01T01:30:00", "expirydate": "2026-12-01"}], **zone)
    assert twice.quarantine.first()["reason"] == "timestamps: ambiguous_local_time"
    never = cleaned(spark, [{"timestamps": "2026-03-08T02:30:00", "expirydate": "2026-12-01"}], **zone)
    assert never.quarantine.first()["reason"] == "timestamps: nonexistent_local_time"
    fine = cleaned(spark, [{"timestamps": "2026-07-01T02:30:00", "expirydate": "2026-12-01"}], **zone)
    assert fine.accepted.count() == 1


def test_expiry_forms_and_greeks(spark):
    forms = ["15SEP26", "15-Sep-2026", "2026-09-15", "15sep26"]
    got = cleaned(spark, [{"expirydate": f, "strike": str(100 + i)} for i, f in enumerate(forms)]).accepted
    assert got.select("expirydate").distinct().count() == 1
    one = cleaned(
        spark, [{"spot": "100", "strike": "100", "iv": "20", "expirydate": "2027-09-14T09:20:00"}], derive_greeks=True, risk_free_rate=0.05, dividend_yield=0.0
    ).accepted.first()
    assert one["delta"] == pytest.approx(0.6368306512, abs=1e-9) and one["vega"] == pytest.approx(0.3752403469, abs=1e-9)
    assert one["derivation_status"] == "derived"


def test_headers():
    assert cleaning.header_mapping(["Timestamp", "spot price", "Last-Price", "x"]) == {"Timestamp": "timestamps", "spot price": "spot", "Last-Price": "ltp"}
    with pytest.raises(ValueError):
        cleaning.header_mapping(["ltp", "last_price"])
    report = cleaning.header_report(["timestamp", "delta", "other"])
    assert report["ignored_derived"] == ["delta"] and report["unknown"] == ["other"] and "spot" in report["missing_required"]


def test_predicate_language():
    good = [{"feature": "CE_delta", "operator": ">=", "threshold": 0.5}]
    assert rules.check_predicates(good, rules.SINGLE) == good
    for bad in (
        [{"feature": "nope", "operator": ">=", "threshold": 0.5}],
        [{"feature": "CE_delta", "operator": ">", "threshold": 0.5}],
        [{"feature": "CE_delta", "operator": ">=", "threshold": float("nan")}],
        [{"feature": "CE_delta", "operator": ">=", "threshold": True}],
        good * 2,
    ):
        with pytest.raises(ValueError):
            rules.check_predicates(bad, rules.SINGLE)
    with pytest.raises(ValueError):
        rules.check_predicates(good * 4, rules.JOINT)


def test_joint_search_finds_what_single_cannot(spark):
    data = []
    for day in (1, 2):
        for i in range(64):
            bits = [(i >> b) & 1 for b in range(4)]
            up = sum(bits) % 2 == 0
            values = {f: None for f in rules.FEATURES}
            for name, bit in zip(("CE_past_oi_change_pct", "PE_past_oi_change_pct"), bits):
                values[name] = float(bit)
            values["CE_iv_decimal"], values["PE_iv_decimal"] = 0.1 + 0.2 * bits[2], 0.1 + 0.2 * bits[3]
            data.append((f"{day}-{i}", f"2026-09-{10 + day}", "UP_MOMENTUM" if up else "DOWN_MOMENTUM", *[values[f] for f in rules.FEATURES]))
    df = spark.createDataFrame(data, "sample_id string, trading_date string, label string, " + ", ".join(f"{f} double" for f in rules.FEATURES))
    from tickevidence.operators.sampling import SamplePolicy

    single = rules.search_log(df, SamplePolicy(), rules.SearchPolicy(discovery_version=rules.SINGLE, min_support=4))
    joint = rules.search_log(df, SamplePolicy(), rules.SearchPolicy(min_support=4))
    assert single.filter("eligible").isEmpty()
    assert joint.filter("eligible and lift > 1.9").count() > 0


def test_joins_and_comparison(spark):
    a = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "x")], "k int, v double, s string")
    assert joins.compare_tables(a, a, ["k"]).isEmpty()
    b = a.withColumn("v", F.col("v") * (1 + 1e-14))
    assert joins.compare_tables(a, b, ["k"]).isEmpty()
    assert joins.compare_tables(a, a.withColumn("s", F.lit("x")), ["k"]).first()["problem"] == "values_differ"
    right = spark.createDataFrame([(1, 10), (1, 11)], "k int, w int")
    got = {r["k"]: r for r in joins.match_evidence(a, right, ["k"], name="m", evidence=["w"]).collect()}
    assert got[1]["m_match_count"] == 2 and got[1]["m_evidence"] is None and got[2]["m_match_count"] == 0


def test_excursions_and_average(spark):
    df = spark.createDataFrame([("a", T0 + timedelta(seconds=s), float(v), s) for s, v in ((0, 10), (5, 12), (9, 7), (30, 50))], "k string, t timestamp, p double, s int")
    for block in (1, 1000):
        out = {r["s"]: r for r in features.excursions(df, by=["k"], time="t", price="p", keep=["s"], horizon=10, block_seconds=block).collect()}
        assert (out[0]["mfe_pts"], out[0]["mae_pts"]) == (2.0, -3.0) and out[30]["mfe_pts"] is None
    ema = features.exponential_averages(df, by=["k"], time="t", price="p", keep=[], spans=(3,), min_points=2)
    assert [r["ema_3"] for r in ema.orderBy("t").collect()] == [None, 11.0, 9.0, 29.5]


def test_decimation_keeps_ends(spark):
    df = series(spark, range(2000))
    out = [r["i"] for r in explorer.decimate(df, by=["k"], time="t", block_seconds=77).orderBy("t").collect()]
    assert out == sorted({round(i * 1999 / 799) for i in range(800)})


def test_pages_are_validated(spark):
    df = spark.range(5)
    for bad in ((-1, 5), (0, 0), (0, 251), (True, 5)):
        with pytest.raises(ValueError):
            explorer.page(df, ["id"], *bad)


def test_csv_json_and_revisions(spark, tmp_path):
    good = tmp_path / "a.csv"
    good.write_bytes("﻿a,b\n1,x\n\n2,y\n".encode())
    assert [tuple(r) for r in tables.read_csv(spark, str(good)).collect()] == [("1", "x"), ("2", "y")]
    bad = tmp_path / "b.csv"
    bad.write_text("a,a\n1,2\n")
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(bad))
    lines = tmp_path / "c.jsonl"
    lines.write_text('{"a":9007199254740993,"b":"x"}\n{"a":1,"a":2}\n{"a":NaN}\n{"a":{"z":1}}\n')
    rows, rejected = tables.read_json_lines(spark, str(lines), ["a", "b"])
    assert [tuple(r) for r in rows.collect()] == [("9007199254740993", "x")]
    assert sorted(r["reason"] for r in rejected.collect()) == ["malformed_record", "malformed_record", "nested_value"]
    root = str(tmp_path / "store")
    frame = spark.range(10).withColumn("v", F.col("id") * 2)
    args = {"root": root, "trading_date": "2026-09-14", "revision": tables.revision_id("s", "m", "p"), "committed_at": "2026-09-15 00:00:00"}
    assert tables.read_revision(spark, root, "2026-09-14") is None
    assert tables.publish_revision({"t": frame}, **args)
    assert not tables.publish_revision({"t": frame}, **args)
    assert tables.read_revision(spark, root, "2026-09-14")["t"].count() == 10
    actual = tables.file_digests(spark, root + "/data", "*.parquet")
    kept = actual.collect()
    schema = tables.ARTIFACT_SCHEMA
    rows = [tuple(r) for r in kept]
    assert tables.artifact_problems(spark.createDataFrame(rows, schema), actual).isEmpty()
    path, digest, size = rows[0]
    for changed, problem in (
        ((path, "0" * 64, size), "hash_mismatch"),
        ((path, digest, size + 1), "size_mismatch"),
        ((path, "xyz", size), "malformed_digest"),
        (("file:/nowhere", digest, size), "missing"),
    ):
        found = tables.artifact_problems(spark.createDataFrame([changed], schema), actual).collect()
        assert [r["problem"] for r in found] == [problem]


def test_replays(spark):
    stored = spark.createDataFrame([("a", "1")], "k string, d string")
    batch = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), ("b", "3"), ("b", "4")], "k string, d string")
    fresh, bad = tables.split_replays(batch, stored, "k", "d")
    assert [tuple(r) for r in fresh.collect()] == [("b", "3")]
    assert sorted(tuple(r) for r in bad.collect()) == [("a", "2"), ("b", "4")]


def test_daily_job_keeps_published_days(spark, tmp_path):
    from tickevidence.plans import daily

    names = [*BASE, "trading_date"]
    data = [(i, *BASE.values(), d) for i, d in enumerate(("2026-09-14", "2026-09-15"))]
    raw = spark.createDataFrame(data, "source_row bigint, " + ", ".join(f"{n} string" for n in names))
    raw = cleaning.rename(raw.withColumn("trading_date", F.col("trading_date").cast("date")), {n: n for n in BASE})
    root, policy = str(tmp_path / "daily"), cleaning.CleaningPolicy(iv_unit="percent")
    for day in ("2026-09-14", "2026-09-15"):
        plan = spark.createDataFrame([(day, "READY")], "d string, status string").select(F.col("d").cast("date").alias("trading_date"), "status")
        out = daily.clean_days(raw, plan, policy, root, "r1", "2026-09-16 00:00:00")
        assert [r["status"] for r in out.collect()] == ["PUBLISHED"]
        assert daily.run_status(out).first()["status"] == "COMPLETE"
    commits = tables.committed(spark, root)
    assert commits.count() == 2
    listed = commits.select(F.inline("artifacts"))
    actual = tables.file_digests(spark, root + "/data", "*.parquet")
    assert tables.artifact_problems(listed, actual).isEmpty()
