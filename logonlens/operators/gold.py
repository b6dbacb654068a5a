"""Gold layer: risk scores, bands, leaderboards, timeline, red-team summary, KPIs.

One-row results (summary, KPIs) are single global aggregates; where they need several
inputs, each input is aggregated to one row with the same column set and the rows are
folded by one more aggregate (``unionByName`` + ``max``), so no cross join and no
driver-side scalars are involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logonlens.functions.metrics import sum_if, sum_or_zero
from logonlens.functions.normalize import is_after_hours
from logonlens.functions.scoring import (
    RISK_INPUTS,
    RISK_WEIGHTS,
    band_ordinal,
    risk_level,
    round2,
    score_columns,
    weighted_sum,
)

# Published column lists of the gold tables, in order.
RISK_COLUMNS = ["user", "risk_score", "risk_level", "login_score", "computer_score",
                "volume_score", "redteam_score"]
TOP_USERS_COLUMNS = ["user", "risk_score", "risk_level", "redteam_events", "total_logins",
                     "unique_computers", "active_days", "max_daily_authentications"]
TOP_COMPUTERS_COLUMNS = ["computer", "total_authentications", "success_logins", "failed_logins",
                         "unique_users", "active_days", "avg_daily_authentications",
                         "max_daily_authentications", "redteam_source_events",
                         "redteam_target_events"]
TOP_USERS_K = 100
TOP_COMPUTERS_K = 100


def percentile_risk_scores(users: DataFrame) -> DataFrame:
    """Each user's four percentile scores (shared by every weighting)."""
    return score_columns(users, RISK_INPUTS, key="user")


def risk_from_scores(scored: DataFrame, weights: Sequence[tuple[str, float]] = RISK_WEIGHTS) -> DataFrame:
    """J18 from precomputed scores: weighted, rounded ``risk_score`` and its band."""
    return (
        scored.withColumn("risk_score", round2(weighted_sum(weights)))
        .withColumn("risk_level", risk_level())
        .select(*RISK_COLUMNS)
    )


def user_risk(users: DataFrame, weights: Sequence[tuple[str, float]] = RISK_WEIGHTS) -> DataFrame:
    """Risk score and band per user (sort by ``risk_score`` desc at write time)."""
    return risk_from_scores(percentile_risk_scores(users), weights)


def user_risk_weighted(users_or_scores: DataFrame, weights: Sequence[tuple[str, float]]) -> DataFrame:
    """J27 re-score: the four scores and the weighted score under caller weights. Accepts
    the users dimension or frames already carrying the four scores."""
    scored = users_or_scores if "login_score" in users_or_scores.columns else percentile_risk_scores(users_or_scores)
    return scored.withColumn("risk_score", round2(weighted_sum(weights))).select(
        "user", "login_score", "computer_score", "volume_score", "redteam_score", "risk_score")


def gold_hourly_activity(hourly: DataFrame) -> DataFrame:
    """The hourly fact as published (ordered by day, hour)."""
    return hourly.orderBy("day", "hour")


def login_timeline(hourly: DataFrame) -> DataFrame:
    """Per day totals plus logins outside 08:00-18:00."""
    return hourly.groupBy("day").agg(
        F.sum("authentications").alias("authentications"),
        F.sum("success_logins").alias("success_logins"),
        F.sum("failed_logins").alias("failed_logins"),
        sum_if(is_after_hours("hour"), "authentications").alias("after_hours_logins"),
    )


def _fold_rows(*rows: DataFrame) -> DataFrame:
    """Fold several one-row frames with disjoint columns into one row."""
    merged = rows[0]
    for r in rows[1:]:
        merged = merged.unionByName(r, allowMissingColumns=True)
    cols = []
    for r in rows:
        cols.extend(r.columns)
    return merged.agg(*[F.max(c).alias(c) for c in cols])


def redteam_summary(users: DataFrame, computers: DataFrame) -> DataFrame:
    """Totals from the enriched dimensions (so red-team entities never seen in
    the auth log are not counted)."""
    u = users.agg(
        sum_or_zero("redteam_events").alias("total_redteam_events"),
        F.count_if(F.col("redteam_events") > 0).alias("affected_users"),
    )
    c = computers.agg(
        F.count_if(F.col("redteam_source_events") > 0).alias("source_computers"),
        F.count_if(F.col("redteam_target_events") > 0).alias("target_computers"),
    )
    return _fold_rows(u, c).select(
        "total_redteam_events", "affected_users", "source_computers", "target_computers")


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Users per band present, in Critical, High, Medium, Low order."""
    return (
        risk.groupBy("risk_level").agg(F.count(F.lit(1)).alias("users"))
        .withColumn("order", band_ordinal("risk_level"))
        .orderBy("order")
        .drop("order")
    )


def _top(df: DataFrame, keys: Sequence[str], tiebreak: str, k: int) -> DataFrame:
    order: list[Column] = [F.desc_nulls_first(c) for c in keys] + [F.asc(tiebreak)]
    return df.orderBy(*order).limit(k)


def top_computers(computers: DataFrame, k: int = TOP_COMPUTERS_K) -> DataFrame:
    """Top computers by red-team target, red-team source, then total logons."""
    return _top(
        computers.select(*TOP_COMPUTERS_COLUMNS),
        ["redteam_target_events", "redteam_source_events", "total_authentications"],
        "computer", k,
    )


def top_users(users: DataFrame, risk: DataFrame, k: int = TOP_USERS_K) -> DataFrame:
    """J24 (flagship): highest-risk users with their activity figures."""
    joined = users.join(risk, "user", "inner").select(*TOP_USERS_COLUMNS)
    return _top(joined, ["risk_score"], "user", k)


def dashboard_kpis(users: DataFrame, hourly: DataFrame, risk: DataFrame) -> DataFrame:
    """The dashboard's one-row KPI set."""
    level = F.col("risk_level")
    u = users.agg(F.count(F.lit(1)).alias("total_users"))
    r = risk.agg(
        F.count_if(F.col("risk_score") >= 65).alias("suspicious_users"),
        round2(F.avg("risk_score")).alias("average_risk"),
        F.count_if(level == "Critical").alias("critical_users"),
        F.count_if(level == "High").alias("high_users"),
        F.count_if(level == "Medium").alias("medium_users"),
        F.count_if(level == "Low").alias("low_users"),
    )
    total, failed = sum_or_zero("authentications"), sum_or_zero("failed_logins")
    h = hourly.agg(
        round2(
            F.when(total == 0, F.lit(0.0)).otherwise(failed / total * F.lit(100))
        ).alias("authentication_failure_rate"),
        sum_or_zero(F.when(is_after_hours("hour"), F.col("authentications")))
        .alias("after_hours_logins"),
    )
    return _fold_rows(u, r, h).select(
        "total_users", "suspicious_users", "average_risk", "authentication_failure_rate",
        "after_hours_logins", "critical_users", "high_users", "medium_users", "low_users",
    )
