"""Trading calendar tables: checks, decisions and date searches.

A calendar is a DataFrame with one row per holiday: ``calendar_year``, ``date``,
``name``, ``fetched_at``, ``expires_at``. It has at most a few dozen rows a year.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Freshness window, clock tolerance and plausible calendar sizes.
MAX_FRESH = timedelta(hours=48)
MAX_FUTURE = timedelta(minutes=5)
MIN_HOLIDAYS = 10
MAX_HOLIDAYS = 80
SEARCH_DAYS = 370


def calendar_problems(holidays: DataFrame) -> DataFrame:
    """(calendar_year, problem) rows; empty when every year is usable."""
    year = holidays.groupBy("calendar_year").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("date").alias("distinct_dates"),
        F.countDistinct(F.quarter("date")).alias("quarters"),
        F.count_if(F.year("date") != F.col("calendar_year")).alias("wrong_year"),
        F.count_if(F.col("date").isNull() | (F.coalesce(F.trim("name"), F.lit("")) == "")).alias("blank"),
        F.count_if(
            F.unix_micros("expires_at") - F.unix_micros("fetched_at") > int(MAX_FRESH.total_seconds() * 1e6)
        ).alias("too_long"),
        F.count_if(F.col("expires_at") <= F.col("fetched_at")).alias("inverted"),
    )
    c = F.col
    problems = F.array_compact(
        F.array(
            F.when(c("n") < MIN_HOLIDAYS, "too_few_holidays"),
            F.when(c("n") > MAX_HOLIDAYS, "too_many_holidays"),
            F.when(c("distinct_dates") < c("n"), "repeated_date"),
            F.when(c("quarters") < 4, "quarter_without_holiday"),
            F.when(c("wrong_year") > 0, "date_outside_year"),
            F.when(c("blank") > 0, "missing_date_or_name"),
            F.when(c("too_long") > 0, "freshness_over_48h"),
            F.when(c("inverted") > 0, "expires_before_fetched"),
        )
    )
    return year.select("calendar_year", F.explode(problems).alias("problem"))


def feed_problems(feed: DataFrame) -> DataFrame:
    """Problems of a raw holiday feed with ``date``, ``weekday`` (name) and ``session`` text."""
    c = F.col
    rows = feed.withColumn("year", F.year("date")).withColumn(
        "bad_weekday", ~F.coalesce(F.lower(F.date_format("date", "EEEE")) == F.lower("weekday"), F.lit(False))
    )
    per_year = rows.groupBy("year").agg(
        F.count_if("bad_weekday").alias("bad_weekday"),
        F.count_if(F.coalesce(F.trim("session"), F.lit("")) != "").alias("partial_session"),
        (F.count(F.lit(1)) - F.countDistinct("date")).alias("repeated"),
        F.countDistinct(F.quarter("date")).alias("quarters"),
        F.count(F.lit(1)).alias("n"),
    )
    problems = F.array_compact(
        F.array(
            F.when(c("bad_weekday") > 0, "weekday_mismatch"),
            F.when(c("partial_session") > 0, "partial_session"),
            F.when(c("repeated") > 0, "repeated_date"),
            F.when(c("quarters") < 4, "quarter_without_holiday"),
            F.when(~c("n").between(MIN_HOLIDAYS, MAX_HOLIDAYS), "implausible_count"),
        )
    )
    return per_year.select("year", F.explode(problems).alias("problem"))


def calendar_digest(holidays: DataFrame) -> DataFrame:
    """Per year, a hash of the sorted (date, name) list."""
    item = F.concat_ws("=", F.date_format("date", "yyyy-MM-dd"), "name")
    return holidays.groupBy("calendar_year").agg(
        F.sha2(F.concat_ws(";", F.array_sort(F.collect_list(item))), 256).alias("digest")
    )


def decide_sessions(dates: DataFrame, holidays: DataFrame, now: Column) -> DataFrame:
    """Add ``decision`` and ``reason`` to a table with ``date``.

    Weekends and known holidays are CLOSED even when the calendar is stale; a
    weekday of a year without a fresh calendar is UNKNOWN; only OPEN authorises
    work. The calendar side is one row per holiday and one per year.
    """
    years = holidays.groupBy(F.col("calendar_year").alias("_y")).agg(
        F.max("fetched_at").alias("_fetched"), F.max("expires_at").alias("_expires")
    )
    days = holidays.groupBy(F.col("date").alias("_d")).agg(F.min("name").alias("_name"))
    joined = dates.join(F.broadcast(days), F.col("date") == F.col("_d"), "left").join(
        F.broadcast(years), F.year("date") == F.col("_y"), "left"
    )
    weekend = F.weekday("date") >= 5
    future = F.unix_micros("_fetched") - F.unix_micros(now) > int(MAX_FUTURE.total_seconds() * 1e6)
    stale = (now >= F.col("_expires")) | future
    decision = (
        F.when(weekend, "CLOSED")
        .when(F.col("_d").isNotNull(), "CLOSED")
        .when(F.col("_y").isNull() | stale, "UNKNOWN")
        .otherwise("OPEN")
    )
    reason = (
        F.when(weekend, "weekend")
        .when(F.col("_d").isNotNull(), F.concat(F.lit("holiday:"), "_name"))
        .when(F.col("_y").isNull(), "no_calendar")
        .when(stale, "stale_calendar")
        .otherwise("open")
    )
    return joined.withColumn("decision", decision).withColumn("reason", reason).drop(
        "_d", "_name", "_y", "_fetched", "_expires"
    )


def next_open_date(dates: DataFrame, holidays: DataFrame, now: Column) -> DataFrame:
    """First OPEN date after each distinct ``date``, within 370 days, else NULL.

    Days are decided once for the whole span, then looked up through the next
    open day of each; nothing is searched day by day. The span table has one row
    per calendar day.
    """
    from pyspark.sql import Window as W

    span = dates.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", F.date_add("b", SEARCH_DAYS))).alias("date"))
    judged = decide_sessions(days, holidays, now)
    ahead = W.orderBy("date").rowsBetween(1, W.unboundedFollowing)
    nxt = judged.withColumn(
        "_open", F.min(F.when(F.col("decision") == "OPEN", F.col("date"))).over(ahead)
    ).select(F.col("date").alias("_day"), "_open")
    near = F.when(F.datediff("_open", "date") <= SEARCH_DAYS, F.col("_open"))
    return dates.join(F.broadcast(nxt), F.col("date") == F.col("_day"), "left").withColumn(
        "next_open", near
    ).drop("_day", "_open")


def latest_completed_weekday(now: Column, zone: str, ready_seconds: int) -> Column:
    """Local date whose cleaning may start: today after the ready time, else the
    previous day; weekends step back to Friday."""
    local = F.from_utc_timestamp(now, zone)
    done = (F.unix_micros(local) % F.lit(86_400_000_000)) >= F.lit(ready_seconds * 1_000_000).cast("bigint")
    day = F.when(done, F.to_date(local)).otherwise(F.date_sub(F.to_date(local), 1))
    return F.date_sub(day, F.greatest(F.lit(0), F.weekday(day) - 4))


def upcoming(holidays: DataFrame, today: Column, limit: int = 12) -> DataFrame:
    """The next holidays in date order."""
    return holidays.filter(F.col("date") >= today).orderBy("date", "name").limit(limit)


def missing_from(required: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Required values that are absent: empty when it is a subset."""
    return required.select(key).distinct().join(available.select(key), key, "left_anti")
