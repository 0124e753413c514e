"""Strict text-to-value parsing with the first failing reason.

A parser is a list of stages; each stage is a set of new columns over the earlier
ones. Stages are separate projections, so a trimmed text or a cast is computed
once however many tests read it, and generated methods stay small. A field ``f``
ends as the value ``f`` and the reason ``_r_f`` (NULL when the value is good).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.functions.clock import parse_expiry

# Accepted spellings and the default expiry clock.
SIDE_ALIASES = {"CE": ("CE", "CALL", "C"), "PE": ("PE", "PUT", "P")}
EXPIRY_CLOCK = "15:30:00"
EXPIRY_ZONE = "Asia/Kolkata"
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
NONFINITE = r"(?i)^[+-]?(s?nan\d*|inf|infinity)$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"
UNIT_MICROS = {"s": "1000000", "ms": "1000", "us": "1", "ns": "0.001"}


Stages = list[dict[str, Column]]


def blank_to_null(col: Column) -> Column:
    text = F.trim(col.cast("string"))
    return F.when(text != "", text)


def apply_stages(df: DataFrame, fields: list[Stages]) -> DataFrame:
    """Run stage 1 of every field, then stage 2, and so on."""
    for level in range(max(len(f) for f in fields)):
        named = {name: col for f in fields if level < len(f) for name, col in f[level].items()}
        df = df.withColumns(named)
    return df


def _missing(field: str, text: Column, required: bool) -> Column:
    return F.when(text.isNull(), F.lit(f"{field}: required value is missing") if required else F.lit(None))


def number(field: str, *, required: bool = False, integer: bool = False, positive: bool = False) -> Stages:
    """Nonnegative (or positive) finite number; integers are exact to 64 bits."""
    text, cast = F.col(f"_t_{field}"), F.col(f"_n_{field}")
    sign = "positive" if positive else "nonnegative"
    bad_sign = text.rlike(r"^-[0-9.]*[1-9]")
    if positive:
        bad_sign = bad_sign | ~text.rlike(r"^[+-]?[0-9.]*[1-9]")
    reason = (
        _missing(field, text, required)
        .when(text.rlike(NONFINITE), f"{field}: nonfinite value")
        .when(~text.rlike(NUMBER), f"{field}: invalid numeric value")
        .when(bad_sign, f"{field}: must be {sign}")
    )
    if integer:
        plain = text.rlike(r"^[+-]?\d+(\.0*)?$")
        whole = plain | ((F.length(text) <= 20) & (cast == F.floor(cast)))
        top = F.lit("9223372036854775807").cast("decimal(38,18)")
        fits = F.coalesce(whole & (cast <= top), F.lit(False))
        reason = reason.when(~fits, f"{field}: must be an integer within signed 64-bit range")
        kind, value = "decimal(38,18)", cast.try_cast("bigint")
    else:
        limited = F.abs(cast) < F.lit(float("inf"))
        if positive:
            limited = limited & (cast > 0)
        limited = F.coalesce(limited, F.lit(False))
        reason = reason.when(~limited, f"{field}: outside supported finite numeric range")
        kind, value = "double", cast
    return [
        {f"_t_{field}": blank_to_null(F.col(field))},
        {f"_n_{field}": text.try_cast(kind)},
        {f"_r_{field}": reason},
        {field: F.when(F.col(f"_r_{field}").isNull(), value)},
    ]


def side(field: str) -> Stages:
    text = F.col(f"_t_{field}")
    value = F.lit(None).cast("string")
    for name, aliases in SIDE_ALIASES.items():
        value = F.when(text.isin(*aliases), name).otherwise(value)
    return [
        {f"_t_{field}": F.upper(blank_to_null(F.col(field)))},
        {field: value},
        {f"_r_{field}": F.when(F.col(field).isNull(), f"{field}: expected CE/CALL/C or PE/PUT/P")},
    ]


def local_time_reason(naive: Column, utc: Column, field: str, zone: str) -> Column:
    """Why a wall time has no single instant: skipped or repeated by a clock change."""
    if zone in ("UTC", "Asia/Kolkata"):  # no clock changes
        return F.lit(None).cast("string")

    def same_wall(hours: int) -> Column:
        return F.from_utc_timestamp(utc + F.expr(f"INTERVAL {hours} HOURS"), zone) == naive

    return F.when(F.from_utc_timestamp(utc, zone) != naive, f"{field}: nonexistent_local_time").when(
        same_wall(-1) | same_wall(1), f"{field}: ambiguous_local_time"
    )


def timestamp(field: str, *, zone: str, unit: str | None = None, required: bool = True) -> Stages:
    """ISO-8601, or a number with an explicit unit. Sub-microsecond digits are rejected."""
    text, form = F.col(f"_t_{field}"), F.col(f"_f_{field}")
    read, local = F.col(f"_v_{field}"), F.col(f"_l_{field}")
    shape = (
        F.when(text.rlike(NUMBER), "number")
        .when(text.rlike(ISO_DATE), "naive")
        .when(text.rlike(ISO_DATETIME), F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), "zoned").otherwise("naive"))
        .otherwise("other")
    )
    too_fine = text.rlike(r"\.\d{6}\d*[1-9]\d*(Z|[+-]\d{2}:?\d{2})?$") & text.rlike(r"\.\d{7,9}")
    stages: Stages = [
        {f"_t_{field}": blank_to_null(F.col(field))},
        {f"_f_{field}": shape},
        {f"_v_{field}": F.when(form.isin("naive", "zoned"), text).try_cast("timestamp")},
        {f"_l_{field}": F.to_utc_timestamp(read, zone)},
    ]
    if unit is None:
        instant = F.lit(None).cast("timestamp")
        number_reason = F.lit(f"{field}: numeric timestamps require timestamp_unit")
    else:
        scale = F.lit(UNIT_MICROS[unit]).cast("decimal(10,3)")
        stages[1][f"_u_{field}"] = text.try_cast("decimal(30,9)") * scale
        count = F.col(f"_u_{field}")
        instant = F.timestamp_micros(F.floor(count).try_cast("bigint"))
        number_reason = F.when(count.isNull(), f"{field}: outside supported range").when(
            count != F.floor(count), f"{field}: sub_microsecond_timestamp"
        )
    value = F.when(form == "number", instant).when(form == "zoned", read).when(form == "naive", local)
    reason = (
        _missing(field, text, required)
        .when(form == "number", number_reason)
        .when(form == "other", f"{field}: expected an unambiguous ISO-8601 timestamp")
        .when(too_fine, f"{field}: sub_microsecond_timestamp")
        .when(read.isNull(), f"{field}: invalid timestamp")
        .when(form == "naive", local_time_reason(read, local, field, zone))
    )
    return [*stages, {f"_r_{field}": reason}, {field: F.when(F.col(f"_r_{field}").isNull(), value)}]


def expiry(field: str, *, clock: str = EXPIRY_CLOCK, zone: str = EXPIRY_ZONE) -> Stages:
    """A date in any accepted form at the expiry clock, or a full ISO timestamp."""
    text, day = F.col(f"_t_{field}"), F.col(f"_d_{field}")
    read, local = F.col(f"_v_{field}"), F.col(f"_l_{field}")
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    at_clock = F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.lit(clock))
    full = F.when(text.rlike(ISO_DATETIME), text)
    named = text.rlike(r"^(\d{2}[A-Za-z]{3}\d{2}|\d{1,2}-[A-Za-z]{3}-\d{2,4})$")
    reason = (
        _missing(field, text, True)
        .when(text.rlike(NUMBER), f"{field}: numeric expiry dates are ambiguous")
        .when(named & day.isNull(), f"{field}: invalid date")
        .when(day.isNull() & ~text.rlike(ISO_DATETIME), f"{field}: expected an unambiguous ISO-8601 timestamp")
        .when(read.isNull(), f"{field}: invalid timestamp")
        .when(day.isNotNull() | ~zoned, local_time_reason(read, local, field, zone))
    )
    value = F.when(day.isNull() & zoned, read).otherwise(local)
    return [
        {f"_t_{field}": blank_to_null(F.col(field))},
        {f"_d_{field}": parse_expiry(text)},
        {f"_v_{field}": F.coalesce(F.when(day.isNotNull(), at_clock), full).try_cast("timestamp")},
        {f"_l_{field}": F.to_utc_timestamp(read, zone)},
        {f"_r_{field}": reason},
        {field: F.when(F.col(f"_r_{field}").isNull(), value)},
    ]


def text_or(col: Column, default: str | None = None) -> Column:
    value = blank_to_null(col)
    return F.coalesce(value, F.lit(default)) if default is not None else value
