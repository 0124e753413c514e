"""Clocks, sessions, slots and contract dates as Column expressions.

Times are ``TimestampType`` under a UTC session; arithmetic is done on epoch
microseconds so that half-open and strict comparisons are exact.
"""

from __future__ import annotations

from datetime import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

US = 1_000_000
DAY_US = 86_400 * US

# The exchange session and the capture cadence.
SESSION_ZONE = "Asia/Kolkata"
SESSION_OPEN = time(9, 15)
SESSION_CLOSE = time(15, 30)
SLOT_SECONDS = 5


def to_us(seconds: float) -> int:
    """Whole microseconds in a number of seconds."""
    return int(round(seconds * US))


def us(col: Column | str) -> Column:
    return F.unix_micros(F.col(col) if isinstance(col, str) else col)


def from_us(col: Column | str) -> Column:
    return F.timestamp_micros(F.col(col) if isinstance(col, str) else col)


def floor_to(us_col: Column, step_us: int) -> Column:
    """Largest multiple of ``step_us`` at or below a microsecond clock."""
    return us_col - F.pmod(us_col, F.lit(step_us).cast("bigint"))


def block_of(us_col: Column, step_us: int) -> Column:
    """Index of the half-open block ``[i*step, (i+1)*step)`` holding a clock."""
    step = F.lit(step_us).cast("bigint")
    return ((us_col - F.pmod(us_col, step)) / step).cast("bigint")


def align(ts: Column | str, seconds: float = SLOT_SECONDS) -> Column:
    """Slot start of a timestamp (floor)."""
    return from_us(floor_to(us(ts), to_us(seconds)))


def next_boundary(ts: Column | str, seconds: float = SLOT_SECONDS) -> Column:
    """The next slot boundary strictly after a timestamp."""
    step = to_us(seconds)
    return from_us(floor_to(us(ts), step) + F.lit(step).cast("bigint"))


def local(ts: Column | str, zone: str = SESSION_ZONE) -> Column:
    return F.from_utc_timestamp(F.col(ts) if isinstance(ts, str) else ts, zone)


def local_date(ts: Column | str, zone: str = SESSION_ZONE) -> Column:
    return F.to_date(local(ts, zone))


def seconds_of_day(ts: Column | str, zone: str = SESSION_ZONE) -> Column:
    """Seconds since local midnight, with the fraction."""
    return F.pmod(us(local(ts, zone)), F.lit(DAY_US).cast("bigint")) / F.lit(float(US))


def is_weekday(ts: Column | str, zone: str = SESSION_ZONE) -> Column:
    return F.weekday(local_date(ts, zone)) < 5


def in_session(
    ts: Column | str,
    zone: str = SESSION_ZONE,
    opens: time = SESSION_OPEN,
    closes: time = SESSION_CLOSE,
    weekdays_only: bool = True,
) -> Column:
    """Open inclusive, close exclusive, on local weekdays."""
    at = seconds_of_day(ts, zone)
    inside = (at >= _seconds(opens)) & (at < _seconds(closes))
    return inside & is_weekday(ts, zone) if weekdays_only else inside


def in_market_hours(ts: Column | str, zone: str = SESSION_ZONE) -> Column:
    """The SQL helper's looser window: hours 9-14, then 15:00 to 15:30:59, any day.

    It admits 09:00-09:14 and the whole minute 15:30, unlike :func:`in_session`;
    both are kept because both exist.
    """
    at = local(ts, zone)
    hour, minute = F.hour(at), F.minute(at)
    return ((hour >= 9) & (hour < 15)) | ((hour == 15) & (minute <= 30))


def assigned_trading_date(
    ts: Column | str, zone: str = SESSION_ZONE, opens: time = SESSION_OPEN
) -> Column:
    """Local date of a clock; before the open, the previous weekday."""
    day = local_date(ts, zone)
    # Steps back from Monday..Sunday to the weekday before (Sat/Sun land on Fri).
    back = F.element_at(
        F.array(*[F.lit(n) for n in (3, 1, 1, 1, 1, 1, 2)]), F.weekday(day) + 1
    )
    early = seconds_of_day(ts, zone) < _seconds(opens)
    return F.when(early, F.date_sub(day, back)).otherwise(day)


def session_bounds_us(
    day: Column,
    zone: str = SESSION_ZONE,
    opens: time = SESSION_OPEN,
    closes: time | None = SESSION_CLOSE,
) -> tuple[Column, Column]:
    """UTC microseconds of a local date's open and close (``None`` = midnight)."""
    midnight = F.to_timestamp(day)
    start = us(F.to_utc_timestamp(midnight, zone)) + F.lit(to_us(_seconds(opens))).cast("bigint")
    length = 86_400.0 if closes is None else _seconds(closes)
    end = us(F.to_utc_timestamp(midnight, zone)) + F.lit(to_us(length)).cast("bigint")
    return start, end


def staleness_seconds(ts: Column, now: Column) -> Column:
    """Age of a value, never negative; infinite when there is no value."""
    age = (us(now) - us(ts)) / F.lit(float(US))
    return F.coalesce(F.greatest(F.lit(0.0), age), F.lit(float("inf")))


def atm_strike(spot: Column, interval: float = 50.0) -> Column:
    """Nearest strike, ties to the even multiple."""
    return F.bround(spot / F.lit(float(interval))) * F.lit(float(interval))


def contract_symbol(underlying: Column, expiry: Column, strike: Column, side: Column) -> Column:
    """``UNDERLYING`` + ``DDMMMYY`` + whole strike + side."""
    return F.concat(
        underlying,
        F.upper(F.date_format(expiry, "ddMMMyy")),
        strike.cast("bigint").cast("string"),
        side,
    )


def is_contract_symbol(
    symbol: Column, underlying: Column, expiry: Column, strike: Column, side: Column
) -> Column:
    return F.coalesce(symbol == contract_symbol(underlying, expiry, strike, side), F.lit(False))


def plain_number(value: Column) -> Column:
    """A double in its shortest positional form: ``25000``, ``0.5``, ``100.25``."""
    text = value.cast("decimal(38,9)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def contract_key(underlying: Column, expiry_day: Column, strike: Column, side: Column) -> Column:
    return F.concat_ws(
        "|", underlying, F.date_format(expiry_day, "yyyy-MM-dd"), plain_number(strike), side
    )


def parse_expiry(text: Column) -> Column:
    """``dd-MMM-yy``, ``dd-MMM-yyyy``, ``ddMMMyy`` or ISO; NULL when none fits.

    Two-digit years always mean 2000-2099.
    """
    raw = F.trim(text)
    compact = F.regexp_extract(raw, r"^(\d{2})-?([A-Za-z]{3})-?(\d{2})$", 0) != ""
    day = F.regexp_extract(raw, r"^(\d{2})-?([A-Za-z]{3})-?(\d{2})$", 1)
    month = F.regexp_extract(raw, r"^(\d{2})-?([A-Za-z]{3})-?(\d{2})$", 2)
    year = F.regexp_extract(raw, r"^(\d{2})-?([A-Za-z]{3})-?(\d{2})$", 3)
    return F.coalesce(
        F.when(
            compact,
            F.try_to_date(F.concat_ws("-", F.concat(F.lit("20"), year), month, day), "yyyy-MMM-dd"),
        ),
        F.when(raw.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_date(raw, "d-MMM-yyyy")),
        F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(raw, "yyyy-MM-dd")),
    )


def nearest_expiry(df: DataFrame, text: str, as_of: str, by: list[str]) -> DataFrame:
    """Per group, the earliest listed expiry not before ``as_of``."""
    expiry = parse_expiry(F.col(text))
    return (
        df.withColumn("_expiry", expiry)
        .filter(F.col("_expiry") >= F.col(as_of))
        .groupBy(*by)
        .agg(F.min("_expiry").alias("nearest_expiry"))
    )


def whole_days_to_expiry(expiry_day: Column, today: Column) -> Column:
    """Whole days, floored at zero."""
    return F.greatest(F.lit(0), F.datediff(expiry_day, today))


def days_to_expiry(expiry_at: Column, observed_at: Column) -> Column:
    """Fractional days."""
    return (us(expiry_at) - us(observed_at)) / F.lit(float(DAY_US))


def _seconds(value: time) -> float:
    return value.hour * 3600 + value.minute * 60 + value.second + value.microsecond / 1e6
