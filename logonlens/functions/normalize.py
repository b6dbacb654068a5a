"""Normalization and scalar functions: user / domain split, day and hour buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the log's time model (integer seconds from the dataset start).
SECONDS_PER_DAY = 86400
SECONDS_PER_HOUR = 3600
BUSINESS_START_HOUR, BUSINESS_END_HOUR = 8, 18
PERSON_PREFIX = "U"
COMPUTER_PREFIX = "C"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def account_name(col: str | Column) -> Column:
    """STR1: text before the first ``@`` (whole string when there is none)."""
    return F.substring_index(_c(col), "@", 1)


def account_domain(col: str | Column) -> Column:
    """STR2: text after the last ``@`` (whole string when there is none)."""
    return F.substring_index(_c(col), "@", -1)


def _whole(t: Column, by: int) -> Column:
    """Integer division (SQL ``div``), without going through doubles."""
    return F.call_function("div", t, F.lit(by).cast("bigint"))


def day_of(ts: str | Column = "timestamp") -> Column:
    """TIM1: floor(ts / 86400), exact on bigint and correct below zero."""
    t = _c(ts).cast("bigint")
    return _whole(t - F.pmod(t, F.lit(SECONDS_PER_DAY)), SECONDS_PER_DAY)


def hour_of(ts: str | Column = "timestamp") -> Column:
    """TIM2: hour of day 0-23 (floor modulo, so also correct below zero)."""
    return _whole(F.pmod(_c(ts).cast("bigint"), F.lit(SECONDS_PER_DAY)), SECONDS_PER_HOUR)


def is_business_hour(hour: str | Column = "hour") -> Column:
    """TIM3: 8 <= hour < 18 (half-open, not BETWEEN)."""
    h = _c(hour)
    return (h >= BUSINESS_START_HOUR) & (h < BUSINESS_END_HOUR)


def is_after_hours(hour: str | Column = "hour") -> Column:
    """TIM4: the complement of TIM3 for non-null hours."""
    h = _c(hour)
    return (h < BUSINESS_START_HOUR) | (h >= BUSINESS_END_HOUR)


def is_person(col: str | Column) -> Column:
    """STR3 for accounts: null never qualifies."""
    return _c(col).startswith(PERSON_PREFIX)


def is_computer(col: str | Column) -> Column:
    """STR3 for hosts: null never qualifies."""
    return _c(col).startswith(COMPUTER_PREFIX)


def add_day(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn("day", day_of(ts))


def normalize_auth(auth: DataFrame) -> DataFrame:
    """NRM1: add ``user``, ``domain``, ``day``; keep person accounts only.

    The prefix test is stated on ``source_user`` rather than the derived ``user``: a
    string and its text up to the first ``@`` share the first character, so the two
    are equivalent, and only this form reaches the parquet scan as a pushed filter.
    A ``day`` column already present (the bronze partition column, written as
    ``day_of(timestamp)``) is kept, so filters on ``day`` prune whole partitions; it is cast to
    bigint, since partition discovery reads it back as int.
    """
    out = auth.where(is_person("source_user")).withColumns({
        "user": account_name("source_user"),
        "domain": account_domain("source_user"),
    })
    if "day" in auth.columns:
        return out.select(*[c for c in out.columns if c != "day"], F.col("day").cast("bigint").alias("day"))
    return out.withColumn("day", day_of("timestamp"))
