"""Small quote tapes: one CE and one PE row every five seconds."""

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

OPEN = datetime(2026, 9, 14, 3, 45, tzinfo=UTC)  # 09:15 in Kolkata, a Monday
SCHEMA = (
    "observation_id string, timestamps timestamp, underlying string, trading_date date, source_version string, spot double, "
    "optiontype string, contract_key string, bid double, ask double, oi bigint, volume bigint, iv double, "
    "iv_available_at timestamp, delta double, gamma double, theta double, vega double, greeks_available_at timestamp"
)


def rows(seconds=range(0, 485, 5), spot=lambda s: 25000 + s / 5, day=0, lag=1, **change):
    """Rows as dicts; ``change`` maps a column to a function of (second, side)."""
    out = []
    for s in seconds:
        for side in ("CE", "PE"):
            at = OPEN + timedelta(days=day, seconds=s)
            row = {
                "observation_id": f"{side}-{day}-{s}",
                "timestamps": at,
                "underlying": "IDX",
                "trading_date": (OPEN + timedelta(days=day)).date(),
                "source_version": "2",
                "spot": float(spot(s)),
                "optiontype": side,
                "contract_key": f"IDX|2026-09-15|25000|{side}",
                "bid": 99 + s / 100,
                "ask": 101 + s / 100,
                "oi": 1000 + s,
                "volume": 10000 + s,
                "iv": 0.2,
                "iv_available_at": at + timedelta(seconds=lag),
                "delta": 0.5 if side == "CE" else -0.5,
                "gamma": 0.01,
                "theta": -2.0,
                "vega": 3.0,
                "greeks_available_at": at + timedelta(seconds=lag),
            }
            row.update({k: f(s, side) for k, f in change.items()})
            out.append(row)
    return out


def tape(spark, data):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in data], SCHEMA)


def by_anchor(samples):
    """Sample rows keyed by seconds after the open."""
    first = int(OPEN.timestamp() * 1e6)
    return {(r["anchor_us"] - first) // 1_000_000: r for r in samples.orderBy(F.col("anchor_us")).collect()}
