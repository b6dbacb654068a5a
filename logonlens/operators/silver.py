"""Silver layer: dimensions, bridge, red-team events, activity facts, entity features.

Each builder is a pure DataFrame -> DataFrame function. Builders over the auth log take
the *normalized* log (:func:`logonlens.functions.normalize.normalize_auth`), so one
normalization can feed all of them. Aggregations are single ``groupBy().agg()`` calls:
Spark plans them as partial (map-side) + final aggregates, so a hot key (one server
taking most logons, one user with a third of the rows) is collapsed on the map side
before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logonlens.functions.metrics import n_unique, status_metrics
from logonlens.functions.normalize import (
    account_name,
    day_of,
    hour_of,
    is_business_hour,
    is_computer,
)

# ---------------------------------------------------------------- dimensions


def users_dim(norm: DataFrame) -> DataFrame:
    """One row per user with login counts and first/last login second."""
    return norm.groupBy("user").agg(
        *status_metrics("total_logins"),
        F.min("timestamp").alias("first_login"),
        F.max("timestamp").alias("last_login"),
    )


def computers_dim(norm: DataFrame) -> DataFrame:
    """One row per destination computer (``C*`` names only) of person logons."""
    return (
        norm.where(is_computer("destination_computer"))
        .groupBy(F.col("destination_computer").alias("computer"))
        .agg(
            *status_metrics("total_authentications"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
    )


def user_computers(norm: DataFrame) -> DataFrame:
    """J07 / SET1: distinct (user, computer) pairs, ``C*`` computers only."""
    return (
        norm.select("user", F.col("destination_computer").alias("computer"))
        .where(is_computer("computer"))
        .distinct()
    )


# ---------------------------------------------------------------- red team


def redteam_events(redteam: DataFrame) -> DataFrame:
    """Red-team rows with day, hour and business-hours flag; ``user`` loses its
    domain (no person filter here)."""
    return redteam.select(
        "timestamp",
        account_name("user").alias("user"),
        "source_computer",
        "destination_computer",
        day_of("timestamp").alias("day"),
        hour_of("timestamp").alias("hour"),
    ).withColumn("business_hours", is_business_hour("hour"))


def redteam_users(events: DataFrame) -> DataFrame:
    """Per red-team user: events, first/last event, distinct sources/targets."""
    return events.groupBy("user").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
        n_unique("source_computer").alias("source_computers"),
        n_unique("destination_computer").alias("target_computers"),
    )


def redteam_endpoint_counts(events: DataFrame, source_name: str = "source_events",
                            target_name: str = "target_events") -> DataFrame:
    """Events per computer as source and as target, from one scan and one aggregate.

    Each event yields a (role, computer) row for its source and one for its target; a
    computer's two counts are conditional counts of one group. This equals the full
    outer join of the two per-role counts: a computer seen in one role gets 0 for the
    other, and a NULL computer keeps one row per role (NULL keys never join).
    """
    ends = F.array(
        F.struct(F.lit("s").alias("role"), F.col("source_computer").alias("computer")),
        F.struct(F.lit("t").alias("role"), F.col("destination_computer").alias("computer")),
    )
    role = F.col("role")
    return (
        events.select(F.inline(ends))
        .groupBy("computer", F.when(F.col("computer").isNull(), role).alias("null_role"))
        .agg(F.count_if(role == "s").alias(source_name), F.count_if(role == "t").alias(target_name))
        .drop("null_role")
    )


def redteam_computers(events: DataFrame) -> DataFrame:
    """Events per computer as source and as target (zeros where absent; no ``C*``
    filter)."""
    return redteam_endpoint_counts(events)


def daily_redteam_activity(events: DataFrame) -> DataFrame:
    """Per day: events, distinct users, distinct target computers."""
    return events.groupBy("day").agg(
        F.count(F.lit(1)).alias("events"),
        n_unique("user").alias("users"),
        n_unique("destination_computer").alias("targets"),
    )


# ---------------------------------------------------------------- activity facts


def daily_activity(norm: DataFrame) -> DataFrame:
    """Status metrics per day."""
    return norm.groupBy("day").agg(*status_metrics())


def daily_computer_activity(norm: DataFrame) -> DataFrame:
    """Status metrics per (day, computer), ``C*`` computers only."""
    return (
        norm.where(is_computer("destination_computer"))
        .groupBy("day", F.col("destination_computer").alias("computer"))
        .agg(*status_metrics())
    )


def daily_user_activity(norm: DataFrame) -> DataFrame:
    """Status metrics per (day, user)."""
    return norm.groupBy("day", "user").agg(*status_metrics())


def hourly_activity(norm: DataFrame) -> DataFrame:
    """Status metrics per (day, hour)."""
    return norm.groupBy("day", hour_of("timestamp").alias("hour")).agg(*status_metrics())


def daily_activity_from_hourly(hourly: DataFrame) -> DataFrame:
    """J12 derived from J15 (identical result, no second pass over the log)."""
    return hourly.groupBy("day").agg(*[
        F.sum(c).alias(c) for c in ("authentications", "success_logins", "failed_logins")
    ])


# ---------------------------------------------------------------- shared scan
#
# One aggregate of the normalized log at the finest grain any silver table needs,
# (day, hour, user, destination_computer), carrying the three status counts and the
# first/last second. Every log-derived silver table is an exact rollup of it (sums of
# counts, min of mins, max of maxes), so the log is read and shuffled once instead of
# seven times; the rollups read a table that is at most as large as the log and usually
# far smaller (repeated logons of a user to a host within an hour collapse).


def activity_cube(norm: DataFrame) -> DataFrame:
    return norm.groupBy(
        "day", hour_of("timestamp").alias("hour"), "user", "destination_computer"
    ).agg(
        *status_metrics(),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )


def _sums(total_name: str = "authentications"):
    return [
        F.sum("authentications").alias(total_name),
        F.sum("success_logins").alias("success_logins"),
        F.sum("failed_logins").alias("failed_logins"),
    ]


def users_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("user").agg(
        *_sums("total_logins"), F.min("first_ts").alias("first_login"), F.max("last_ts").alias("last_login"))


def computers_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.where(is_computer("destination_computer"))
        .groupBy(F.col("destination_computer").alias("computer"))
        .agg(*_sums("total_authentications"), F.min("first_ts").alias("first_seen"),
             F.max("last_ts").alias("last_seen"))
    )


def user_computers_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.where(is_computer("destination_computer"))
        .select("user", F.col("destination_computer").alias("computer"))
        .distinct()
    )


def daily_user_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("day", "user").agg(*_sums())


def daily_computer_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.where(is_computer("destination_computer"))
        .groupBy("day", F.col("destination_computer").alias("computer"))
        .agg(*_sums())
    )


def hourly_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("day", "hour").agg(*_sums())


def daily_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("day").agg(*_sums())


# ---------------------------------------------------------------- features
#
# Fused forms: a dimension row (totals, first/last second) and its activity profile
# (active days, mean and max per day) are both rollups of the per-day aggregate when that
# aggregate also carries the first and last second of each day, so one groupBy over it
# replaces two aggregations and a join.


def daily_user_extended(norm: DataFrame) -> DataFrame:
    return norm.groupBy("day", "user").agg(
        *status_metrics(), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def daily_computer_extended(norm: DataFrame) -> DataFrame:
    return (
        norm.where(is_computer("destination_computer"))
        .groupBy("day", F.col("destination_computer").alias("computer"))
        .agg(*status_metrics(), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    )


def daily_user_extended_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("day", "user").agg(
        *_sums(), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def daily_computer_extended_from_cube(cube: DataFrame) -> DataFrame:
    return (
        cube.where(is_computer("destination_computer"))
        .groupBy("day", F.col("destination_computer").alias("computer"))
        .agg(*_sums(), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    )


def _dimension_with_profile(daily_ext: DataFrame, key: str, total: str, first: str,
                            last: str) -> DataFrame:
    return daily_ext.groupBy(key).agg(
        F.sum("authentications").alias(total),
        F.sum("success_logins").alias("success_logins"),
        F.sum("failed_logins").alias("failed_logins"),
        F.min("first_ts").alias(first),
        F.max("last_ts").alias(last),
        F.count(F.lit(1)).alias("active_days"),
        F.avg("authentications").alias("avg_daily_authentications"),
        F.max("authentications").alias("max_daily_authentications"),
    )


def user_features_from_daily(daily_ext: DataFrame, bridge: DataFrame, events: DataFrame) -> DataFrame:
    """J16 in one rollup of :func:`daily_user_extended` (same result as
    :func:`user_features` over the separate dimension and fact)."""
    redteam = events.groupBy("user").agg(F.count(F.lit(1)).alias("redteam_events")).withColumn(
        "is_redteam_user", F.lit(True))
    return (
        _dimension_with_profile(daily_ext, "user", "total_logins", "first_login", "last_login")
        .join(bridge.groupBy("user").agg(F.count(F.lit(1)).alias("unique_computers")), "user", "left")
        .join(redteam, "user", "left")
        .fillna(0, ["redteam_events", "unique_computers"])
        .fillna(False, ["is_redteam_user"])
    )


def computer_features_from_daily(daily_ext: DataFrame, bridge: DataFrame, events: DataFrame) -> DataFrame:
    """J17 in one rollup of :func:`daily_computer_extended`."""
    redteam = redteam_endpoint_counts(events, "redteam_source_events", "redteam_target_events")
    return (
        _dimension_with_profile(daily_ext, "computer", "total_authentications", "first_seen", "last_seen")
        .join(bridge.groupBy("computer").agg(F.count(F.lit(1)).alias("unique_users")), "computer", "left")
        .join(redteam, "computer", "left")
        .fillna(0, ["unique_users", "redteam_source_events", "redteam_target_events"])
    )



def _activity_profile(daily: DataFrame, key: str) -> DataFrame:
    return daily.groupBy(key).agg(
        F.count(F.lit(1)).alias("active_days"),
        F.avg("authentications").alias("avg_daily_authentications"),
        F.max("authentications").alias("max_daily_authentications"),
    )


def user_features(users: DataFrame, daily_user: DataFrame, bridge: DataFrame,
                  events: DataFrame) -> DataFrame:
    """Users enriched with activity profile, computer count and red-team count.

    Every side is aggregated by ``user``; the left-join chain therefore reuses that
    hash partitioning (no extra exchange) unless AQE broadcasts a small side.
    """
    redteam = events.groupBy("user").agg(F.count(F.lit(1)).alias("redteam_events")).withColumn(
        "is_redteam_user", F.lit(True))
    return (
        users.join(_activity_profile(daily_user, "user"), "user", "left")
        .join(bridge.groupBy("user").agg(F.count(F.lit(1)).alias("unique_computers")), "user", "left")
        .join(redteam, "user", "left")
        .fillna(0, ["redteam_events", "unique_computers"])
        .fillna(False, ["is_redteam_user"])
    )


def computer_features(computers: DataFrame, daily_computer: DataFrame, bridge: DataFrame,
                      events: DataFrame) -> DataFrame:
    """Computers enriched with activity profile, user count and red-team counts."""
    redteam = redteam_endpoint_counts(events, "redteam_source_events", "redteam_target_events")
    return (
        computers.join(_activity_profile(daily_computer, "computer"), "computer", "left")
        .join(bridge.groupBy("computer").agg(F.count(F.lit(1)).alias("unique_users")), "computer", "left")
        .join(redteam, "computer", "left")
        .fillna(0, ["unique_users", "redteam_source_events", "redteam_target_events"])
    )
