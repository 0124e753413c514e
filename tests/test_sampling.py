from datetime import timedelta

import pytest
from tapes import OPEN, by_anchor, rows, tape

from tickevidence.operators.quality import require_clean, research_gate
from tickevidence.operators.sampling import BAND, FEATURES, SamplePolicy, build_samples, classify_move

POLICY = SamplePolicy(min_move=50)


def sample(spark, data, policy=POLICY):
    return by_anchor(build_samples(tape(spark, data), policy))


def test_labels_at_boundaries(spark):
    values = [(float(x),) for x in (49.999, 50, 80, 80.001, -50, -80, -81, 0)] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(values, "c double")
    band = SamplePolicy(min_move=50, max_move=80, detector_version=BAND)
    got = [r[0] for r in df.select(classify_move(df.c, band)).collect()]
    assert got == ["OTHER", "UP_50_80", "UP_50_80", "UP_OVER_80", "DOWN_50_80", "DOWN_50_80", "DOWN_OVER_80", "OTHER", "UNKNOWN", "UNKNOWN"]
    got = [r[0] for r in df.select(classify_move(df.c, POLICY)).collect()]
    assert got[:4] == ["OTHER", "UP_MOMENTUM", "UP_MOMENTUM", "UP_MOMENTUM"] and got[4] == "DOWN_MOMENTUM"


def test_policy_rejects_bad_values():
    for bad in ({"horizon_seconds": 0}, {"min_move": float("inf")}, {"detector_version": "x"}, {"quote_max_age_seconds": 300}):
        with pytest.raises(ValueError):
            SamplePolicy(**bad)
    with pytest.raises(ValueError):
        SamplePolicy(detector_version=BAND, min_move=10)


def test_basic_sample_values(spark):
    got = sample(spark, rows())
    first = got[120]
    assert first["label"] == "UP_MOMENTUM" and first["point_change"] == pytest.approx(60)
    assert first["condition_ns"] == first["start_us"] * 1000 - 1
    # Strictly before the start: second 115 against the last quote before 60 s earlier (55).
    assert first["past_spot_change"] == pytest.approx((115 - 55) / 5)
    assert first["CE_past_oi_change_pct"] == pytest.approx(100 * (1115 / 1055 - 1))
    assert first["PE_past_volume_increment"] == 60
    assert first["CE_iv_decimal"] == 0.2 and first["PE_delta"] == -0.5
    assert set(first["feature_lineage"]) == set(FEATURES)
    assert first["start_observation_ids"] == ["CE-0-120", "PE-0-120"]


def test_missing_horizon_stays_unknown(spark):
    got = sample(spark, rows(range(0, 300, 5)))
    assert got[60]["label"] == "UNKNOWN" and got[60]["outcome_reason"] == "missing_or_old_endpoint"
    assert got[60]["point_change"] is None


def test_gap_inside_the_window(spark):
    seconds = [s for s in range(0, 485, 5) if not 200 <= s <= 240]
    got = sample(spark, rows(seconds))
    assert got[60]["outcome_reason"] == "gap_in_outcome_window" and got[60]["label"] == "UNKNOWN"


def test_late_analytics_cannot_leak(spark):
    late = lambda s, side: OPEN + timedelta(seconds=s + (60 if s >= 100 else 1))
    got = sample(spark, rows(iv_available_at=late))
    # The newest calculation available before 120 s was observed at 95 s: too old a source.
    assert got[120]["CE_iv_decimal"] is None
    assert got[120]["CE_delta"] == 0.5


def test_no_fallback_to_an_older_calculation(spark):
    # The newest available calculation has a source older than 15 s; an older
    # availability with a fresh source must not be used instead.
    def at(s, side):
        return OPEN + timedelta(seconds=118 if s == 90 else s + 1)

    got = sample(spark, rows(iv_available_at=at, iv=lambda s, side: 0.9 if s == 90 else 0.2))
    assert got[120]["CE_iv_decimal"] is None


def test_future_changes_nothing_known(spark):
    base = sample(spark, rows())[120]
    changed = sample(
        spark,
        rows(spot=lambda s: 25000 + (s / 5 if s < 120 else 999), oi=lambda s, side: 1000 + s if s < 120 else 1, bid=lambda s, side: 99 + s / 100 if s < 120 else 1.0),
    )[120]
    assert [base[f] for f in FEATURES] == [changed[f] for f in FEATURES]


def test_contract_switch_breaks_history(spark):
    got = sample(spark, rows(contract_key=lambda s, side: f"{side}-{'a' if s < 90 else 'b'}"))
    assert got[120]["CE_past_midpoint_return_pct"] is None and got[120]["CE_spread_pct"] is not None
    assert got[120]["past_spot_change"] is not None


def test_volume_decrease_is_null(spark):
    got = sample(spark, rows(volume=lambda s, side: 10000 - s))
    assert got[120]["CE_past_volume_increment"] is None


def test_large_integers_stay_exact(spark):
    base = 2**53
    got = sample(spark, rows(volume=lambda s, side: base + s + (1 if s >= 100 else 0)))
    assert got[120]["CE_past_volume_increment"] == 61


def test_close_is_exclusive(spark):
    late = 6 * 3600 + 15 * 60
    data = rows(range(late - 700, late + 30, 5))
    got = sample(spark, data)
    assert max(got) == late - 60
    assert got[late - 300]["outcome_reason"] == "horizon_outside_session"
    assert got[late - 360]["outcome_reason"] == "complete"


def test_blocks_do_not_change_results(spark):
    data = rows(range(0, 1500, 5), iv_available_at=lambda s, side: OPEN + timedelta(seconds=s + s % 9))
    whole = build_samples(tape(spark, data), POLICY).drop("feature_lineage")
    small = build_samples(tape(spark, data), SamplePolicy(min_move=50, block_seconds=30)).drop("feature_lineage")
    assert whole.exceptAll(small).isEmpty() and small.exceptAll(whole).isEmpty()


def test_gate(spark):
    data = rows(range(0, 60, 5))
    require_clean(research_gate(tape(spark, data)))
    data[0]["spot"] = 1.0
    data[2]["iv_available_at"] = OPEN - timedelta(seconds=1)
    data[4]["observation_id"] = data[5]["observation_id"]
    broken = {r["rule"] for r in research_gate(tape(spark, data)).filter("violations > 0").collect()}
    assert broken == {"conflicting_spot", "iv_available_before_receipt", "repeated_observation_id"}
    with pytest.raises(ValueError):
        require_clean(research_gate(tape(spark, data)))
