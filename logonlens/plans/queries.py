"""Registered queries: one per operator / job of the inventory, over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. The raw logs are derived from the whole
``events`` table (:mod:`logonlens.sources.testdata`), so every query's work grows with
the data. Result columns carry the same names as the oracle SQL.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logonlens.functions.normalize import SECONDS_PER_DAY, day_of, hour_of, normalize_auth
from logonlens.functions.scoring import (
    RISK_INPUTS,
    StoredRanks,
    exact_quantiles,
    percentile_scores,
    score_columns,
    value_ranks,
)
from logonlens.operators import distinct, gold, merge, moments, profile, silver, sketches, topk, validate
from logonlens.plans.layers import Layers
from logonlens.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]

# Re-score weights of the exploratory profile's "what if" query.
ALT_WEIGHTS = (("login_score", 0.40), ("computer_score", 0.20), ("volume_score", 0.20),
               ("redteam_score", 0.20))
# The incremental-merge queries split the log in the middle of day 15, so the groups of
# that day appear in both parts and really get merged.
MERGE_CUT = 15 * SECONDS_PER_DAY + SECONDS_PER_DAY // 2


_WIRING: "weakref.WeakKeyDictionary[SparkSession, dict[str, Layers]]" = weakref.WeakKeyDictionary()


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The lazy table wiring over the driver tables in ``sf_dir``, built once per session.

    Only the *plans* are shared: every execution still scans the tables in full. The
    driver tables are read-only, so a plan's file listing cannot go stale; sharing saves
    re-analysing the same deep plans (features, ranks) for every query.
    """
    per_session = _WIRING.setdefault(spark, {})
    if sf_dir not in per_session:
        ev = testdata.events(spark, sf_dir)
        per_session[sf_dir] = Layers(testdata.auth_from_events(ev), testdata.redteam_from_events(ev))
    return per_session[sf_dir]


def _q(fn: Callable[[Layers], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(layers(spark, sf_dir))
    run.__name__ = fn.__name__ if hasattr(fn, "__name__") else "query"
    return run


def _merge_daily_user(ly: Layers) -> DataFrame:
    a, b = merge.split_at(ly.auth, MERGE_CUT)
    return merge.merge_with_rule(silver.daily_user_activity(normalize_auth(a)),
                                 silver.daily_user_activity(normalize_auth(b)),
                                 merge.DAILY_USER_RULE)


def _merge_users(ly: Layers) -> DataFrame:
    a, b = merge.split_at(ly.auth, MERGE_CUT)
    return merge.merge_with_rule(silver.users_dim(normalize_auth(a)),
                                 silver.users_dim(normalize_auth(b)), merge.USERS_RULE)


def _merge_bridge(ly: Layers) -> DataFrame:
    a, b = merge.split_at(ly.auth, MERGE_CUT)
    return merge.merge_distinct(silver.user_computers(normalize_auth(a)),
                                silver.user_computers(normalize_auth(b)))


def _bronze_roundtrip(which: str) -> Query:
    """Raw headerless gzip CSV -> bronze parquet -> read back.

    The raw CSV is first produced from the driver table (there is no raw log in the test
    data); both files live under the session's checkpoint folder."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from logonlens.plans.medallion import ingest_auth, ingest_redteam
        from logonlens.session import scratch_path
        from logonlens.sources.readers import read_table

        ly = layers(spark, sf_dir)
        raw, bronze = scratch_path(spark, f"raw-{which}"), scratch_path(spark, f"bronze-{which}")
        source = ly.auth if which == "auth" else ly.redteam
        source.write.option("compression", "gzip").option("header", "false").csv(raw)
        if which == "auth":
            ingest_auth(spark, raw, bronze)
        else:
            ingest_redteam(spark, raw, bronze)
        return read_table(spark, bronze).select(*source.columns)
    run.__name__ = f"{which}_bronze_roundtrip"
    return run


# Lines of the stand-in raw log that are spoilt on purpose, by their second: a field too few, one
# too many, and a second that is no number.
BAD_LINE_MOD, FEW_FIELDS, MANY_FIELDS, BAD_SECOND = 97, 5, 6, 7


def spoilt_auth_lines(auth: DataFrame) -> DataFrame:
    """``auth`` as the text of a headerless CSV log with some malformed lines."""
    second = F.pmod(F.col("timestamp"), F.lit(BAD_LINE_MOD))
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in auth.columns]
    return auth.select(
        F.when(second == FEW_FIELDS, F.concat_ws(",", *fields[:-1]))
        .when(second == MANY_FIELDS, F.concat_ws(",", *fields, F.lit("more")))
        .when(second == BAD_SECOND, F.concat(F.lit("x"), F.concat_ws(",", *fields)))
        .otherwise(F.concat_ws(",", *fields)).alias("value"))


def _checked_ingest(what: str) -> Query:
    """J01 + J02 over a raw log with malformed lines: what the one-pass ingest counted, and what
    it wrote."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from logonlens.plans.medallion import ingest_checked_auth
        from logonlens.session import scratch_path
        from logonlens.sources.readers import read_bronze, read_rejects

        auth = layers(spark, sf_dir).auth
        raw, bronze = scratch_path(spark, "raw-spoilt"), scratch_path(spark, "bronze-checked")
        spoilt_auth_lines(auth).write.option("compression", "gzip").text(raw)
        counts = ingest_checked_auth(spark, raw, bronze)
        if what == "counts":
            return spark.createDataFrame([counts], "lines long, accepted long, rejected long, first_second long, last_second long")
        if what == "accepted":
            return read_bronze(spark, bronze).select(*auth.columns)
        return read_rejects(spark, bronze).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.min("bad_line").alias("example"))
    run.__name__ = f"auth_ingest_{what}"
    return run


_LAKES: "weakref.WeakKeyDictionary[SparkSession, dict[str, str]]" = weakref.WeakKeyDictionary()


def _full_run(layer: str, table: str) -> Query:
    """A table as the whole raw -> bronze -> silver -> gold run wrote it. The run over a
    data folder happens once per session; its raw logs and its lake lie in new folders under
    the session's checkpoint folder."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from logonlens.plans.medallion import Paths, run_medallion
        from logonlens.session import scratch_path

        lakes = _LAKES.setdefault(spark, {})
        if sf_dir not in lakes:
            ly = layers(spark, sf_dir)
            raw_auth, raw_red = scratch_path(spark, "run-raw-auth"), scratch_path(spark, "run-raw-redteam")
            ly.auth.write.option("compression", "gzip").csv(raw_auth)
            ly.redteam.write.option("compression", "gzip").csv(raw_red)
            root = scratch_path(spark, "run-lake")
            run_medallion(spark, root, raw_auth, raw_red)
            lakes[sf_dir] = root
        return spark.read.parquet(getattr(Paths(lakes[sf_dir]), layer)(table))
    run.__name__ = f"run_{table}"
    return run


ROLLING_DAYS = 7
ACTIVE = {"users": "user", "targets": "destination_computer"}
REDTEAM_SEEN = {"users": "user", "source_computers": "source_computer", "targets": "destination_computer"}


def _stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table under the checkpoint folder and read it back, as a later run would."""
    from logonlens.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rolling(log: Callable[[Layers], DataFrame], cols: dict[str, str]) -> Query:
    """AGG9 / AGG10 over days: the log comes in two batches; the second one's new values get ids
    behind the first one's, both keep bitmaps by day, and every window is merged from those."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        a, b = merge.split_at(log(layers(spark, sf_dir)), MERGE_CUT)
        ids = _stored(distinct.value_ids(a, cols), "distinct-ids")
        ids = ids.unionByName(_stored(distinct.extend_ids(ids, b, cols), "distinct-ids"))
        parts = [_stored(distinct.group_bitmaps(part, ids, cols, ["day"]), "distinct-days", ["day"]) for part in (a, b)]
        by_day = distinct.merge_bitmaps(parts[0].unionByName(parts[1]), ["day"])
        return distinct.rolling_distinct(by_day, ROLLING_DAYS, list(cols))
    return run


# Days that the stored facts of the refresh query have wrong: one lacks its afternoon, one is
# missing, one was counted twice.
SHORT_DAY, MISSING_DAY, DOUBLE_DAY = 3, 17, 25


def _refreshed_daily_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG12 / J14: a fact stored from a log with wrong days, and those days replaced from the
    complete bronze log."""
    from logonlens.plans.medallion import Paths, read_stored
    from logonlens.plans.refresh import refresh_days
    from logonlens.session import scratch_path
    from logonlens.sources.sinks import write_bronze_auth, write_by_day

    auth = layers(spark, sf_dir).auth
    day = day_of("timestamp")
    early = auth.where(F.coalesce((day != MISSING_DAY) & ((day != SHORT_DAY) | (hour_of("timestamp") < 12)), F.lit(True)))
    root = scratch_path(spark, "refresh-lake")
    write_bronze_auth(auth, Paths(root).bronze("auth"))
    write_by_day(silver.daily_user_activity(normalize_auth(early.unionAll(auth.where(day == DOUBLE_DAY)))),
                 Paths(root).silver("daily_user_activity"), ["user"])
    refresh_days(spark, root, [SHORT_DAY, MISSING_DAY, DOUBLE_DAY], ["daily_user_activity"])
    return read_stored(spark, root, "silver", "daily_user_activity")


def _colocated(what: str) -> Query:
    """JON1 / JON2 / SET2 over bucketed tables: the bridges come from the first part of the log, and
    the second part's new pairs are appended to them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        import uuid

        from logonlens.plans.colocated import Colocated
        from logonlens.session import scratch_path

        ly = layers(spark, sf_dir)
        a, b = merge.split_at(ly.auth, MERGE_CUT)
        store = Colocated(spark, f"colocated_{uuid.uuid4().hex[:12]}", scratch_path(spark, "colocated"))
        store.store(ly)
        first, second = (silver.user_computers(normalize_auth(part)) for part in (a, b))
        store.write("user_bridge", first, "user")
        store.write("computer_bridge", first, "computer")
        if what == "new_pairs":
            with store.partial_keys():
                return _stored(store.new_pairs(second), "new-pairs")
        store.append_pairs(second)
        return getattr(store, what)(ly.redteam_events)
    return run


def _stored_days(spark: SparkSession, fact: DataFrame, name: str, sort_by: list[str]) -> DataFrame:
    from logonlens.session import scratch_path
    from logonlens.sources.readers import read_by_day
    from logonlens.sources.sinks import write_by_day

    path = scratch_path(spark, name)
    write_by_day(fact, path, sort_by)
    return read_by_day(spark, path, fact.schema)


WEEK = 7
SKETCHED = {"p50": 0.50, "p90": 0.90, "p99": 0.99}


def _weekly_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA2 / STA6: quantiles of a user's logins a day, by week: the exact ones, and whether those of
    the week's merged day sketches lie within their error."""
    col = "authentications"
    fact = layers(spark, sf_dir).daily_user_activity
    by_day = _stored(sketches.quantile_sketches(fact, [col], ["day"]), "kll-days", ["day"])
    week = F.floor(F.col("day") / WEEK).alias("week")
    merged = sketches.merge_quantile_sketches(by_day.select("*", week), [col], ["week"])
    estimates = merged.select("week", *[c.alias(n) for n, c in sketches.sketch_quantiles(merged, col, SKETCHED).items()])
    rows = fact.select(week, col)
    exact = exact_quantiles(value_ranks(rows, [col], ["week"]), SKETCHED, ["week"]).drop("metric")
    return exact.join(sketches.ranks_hold(rows, estimates, col, SKETCHED, ["week"]), "week")


def _new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10 / STA7: users of each day that no earlier day had, exactly, and whether the estimate
    from stored day sketches lies within its error."""
    norm = layers(spark, sf_dir).norm
    by_day = _stored(sketches.set_sketches(norm, {"users": "user"}, ["day"]), "theta-days", ["day"])
    guess = sketches.before_each_day(by_day, "users").select(
        F.col("day").alias("d"), sketches.only_in_first("users", "before").alias("guess"),
        sketches.estimate(F.theta_union("users", F.coalesce("before", "users"))).alias("all_so_far"))
    first = norm.groupBy("user").agg(F.min("day").alias("day"))
    new = norm.select("day").distinct().join(first.groupBy("day").agg(F.count(F.lit(1)).alias("n")), "day", "left")
    off = F.abs(F.col("guess") - F.col("new_users")) <= F.lit(sketches.theta_error()) * F.col("all_so_far")
    return new.select("day", F.coalesce("n", F.lit(0)).alias("new_users")).join(guess, F.col("day") == F.col("d")) \
        .select("day", "new_users", off.alias("within"))


def _users_of_both_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10 / STA7: users seen in both logs in each week, exactly and by the intersection of merged
    day sketches."""
    ly = layers(spark, sf_dir)
    week = F.floor(F.col("day") / WEEK).alias("week")
    merged = []
    for name, log in (("auth", ly.norm), ("redteam", ly.redteam_events)):
        by_day = _stored(sketches.set_sketches(log, {name: "user"}, ["day"]), f"theta-{name}", ["day"])
        merged.append(sketches.merge_set_sketches(by_day.select("*", week), [name], ["week"]))
    guess = merged[0].join(merged[1], "week").select(
        "week", sketches.in_both("auth", "redteam").alias("guess"), sketches.estimate(F.theta_union("auth", "redteam")).alias("union"))
    both = ly.norm.select(week, "user").distinct().join(ly.redteam_events.select(week, "user").distinct(), ["week", "user"]) \
        .groupBy("week").agg(F.count(F.lit(1)).alias("n"))
    off = F.abs(F.col("guess") - F.col("users")) <= F.lit(sketches.theta_error()) * F.col("union")
    return guess.join(both, "week", "left").withColumn("users", F.coalesce("n", F.lit(0))).select("week", "users", off.alias("within"))


TOP_DAYS = (5, 24)


def _top_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP1 / TOP3 over a range of days, from the stored daily fact by thresholds."""
    fact = _stored_days(spark, layers(spark, sf_dir).daily_user_activity, "top-days", ["authentications"])
    some = fact.where(F.col("day").between(*TOP_DAYS))
    return topk.threshold_top_k(some, "user", "authentications", 20).result


# Added to every value before the states are built: the result must not depend on it.
LARGE = 10 ** 9
CORRELATED = ("authentications", "success_logins", "failed_logins", "user_length")


def _correlation_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA5 from states of single days, over values near 1e9."""
    fact = layers(spark, sf_dir).daily_user_activity.withColumn("user_length", F.length("user"))
    large = fact.select("day", *[(F.col(c) + LARGE).alias(c) for c in CORRELATED])
    by_day = _stored(moments.moment_states(large, CORRELATED, ["day"]), "moments", ["day"])
    return moments.correlations(moments.merge_states(by_day))


def _scores_of_a_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1 / WIN2: a tenth of the users comes later, and is scored against the stored population
    that it joins."""
    users = layers(spark, sf_dir).user_features
    late = F.substring("user", 2, 10).cast("int") % 10 == 0
    inputs = list(RISK_INPUTS.values())
    stored = StoredRanks(*[_stored(t, "population") for t in StoredRanks.tables(users.where(~late), inputs)])
    batch = users.where(late)
    return score_columns(batch, RISK_INPUTS, "user", ranks=stored.ranks_with(batch, inputs))


def _describe_with_null_group(ly: Layers) -> DataFrame:
    """STA6 over a group column that is NULL for users outside the red-team events."""
    users = ly.user_features.withColumn("cohort", F.when(F.col("redteam_events") > 0, F.lit("flagged")))
    return profile.describe(users, ["total_logins", "unique_computers"], ["cohort"])


def _fact_summary(ly: Layers) -> DataFrame:
    parts = [
        profile.table_summary(ly.hourly_activity, ["day", "hour"], "hourly_activity"),
        profile.table_summary(ly.daily_computer_activity, ["computer", "day"], "daily_computer_activity"),
        profile.table_summary(ly.daily_user_activity, ["user", "day"], "daily_user_activity"),
        profile.table_summary(ly.redteam_events, ["user", "day"], "redteam_events"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _percentile_scores(ly: Layers) -> DataFrame:
    scored = percentile_scores(ly.computer_features, {
        "volume_pct": "total_authentications",
        "users_pct": "unique_users",
        "avg_daily_pct": "avg_daily_authentications",
    }, key="computer")
    return scored.select("computer", "total_authentications", "unique_users",
                         "avg_daily_authentications", "volume_pct", "users_pct", "avg_daily_pct")


QUERIES: dict[str, Query] = {
    # normalization / ingest checks
    "auth_normalized": _q(lambda ly: ly.norm),
    "auth_row_count": _q(lambda ly: validate.row_count(ly.auth)),
    "auth_bronze_roundtrip": _bronze_roundtrip("auth"),
    "redteam_bronze_roundtrip": _bronze_roundtrip("redteam"),
    "auth_ingest_counts": _checked_ingest("counts"),
    "auth_ingest_accepted": _checked_ingest("accepted"),
    "auth_ingest_rejects": _checked_ingest("rejects"),
    "run_hourly_activity": _full_run("silver", "hourly_activity"),
    "run_users_features": _full_run("silver", "users_features"),
    "run_user_risk": _full_run("gold", "user_risk"),
    "run_dashboard_kpis": _full_run("gold", "dashboard_kpis"),
    "user_describe_null_group": _q(_describe_with_null_group),
    "redteam_validation": _q(lambda ly: validate.redteam_validation(ly.redteam)),
    # silver
    "users_dim": _q(lambda ly: silver.users_dim(ly.norm)),
    "computers_dim": _q(lambda ly: silver.computers_dim(ly.norm)),
    "user_computers": _q(lambda ly: silver.user_computers(ly.norm)),
    "redteam_events": _q(lambda ly: ly.redteam_events),
    "redteam_users": _q(lambda ly: silver.redteam_users(ly.redteam_events)),
    "redteam_computers": _q(lambda ly: silver.redteam_computers(ly.redteam_events)),
    "daily_redteam_activity": _q(lambda ly: silver.daily_redteam_activity(ly.redteam_events)),
    "daily_activity": _q(lambda ly: silver.daily_activity(ly.norm)),
    "daily_computer_activity": _q(lambda ly: silver.daily_computer_activity(ly.norm)),
    "daily_user_activity": _q(lambda ly: silver.daily_user_activity(ly.norm)),
    "hourly_activity": _q(lambda ly: silver.hourly_activity(ly.norm)),
    "daily_activity_from_hourly": _q(lambda ly: silver.daily_activity_from_hourly(ly.hourly_activity)),
    "activity_cube": _q(lambda ly: ly.cube),
    "users_from_cube": _q(lambda ly: silver.users_from_cube(ly.cube)),
    "computers_from_cube": _q(lambda ly: silver.computers_from_cube(ly.cube)),
    "user_computers_from_cube": _q(lambda ly: silver.user_computers_from_cube(ly.cube)),
    "user_features_from_cube": _q(lambda ly: silver.user_features_from_daily(
        silver.daily_user_extended_from_cube(ly.cube), silver.user_computers_from_cube(ly.cube),
        ly.redteam_events)),
    "computer_features_from_cube": _q(lambda ly: silver.computer_features_from_daily(
        silver.daily_computer_extended_from_cube(ly.cube), silver.user_computers_from_cube(ly.cube),
        ly.redteam_events)),
    "user_features": _q(lambda ly: ly.user_features),
    "computer_features": _q(lambda ly: ly.computer_features),
    # ranks and gold
    "percentile_scores": _q(_percentile_scores),
    "user_risk": _q(lambda ly: ly.user_risk),
    "gold_hourly_activity": _q(lambda ly: gold.gold_hourly_activity(ly.hourly_activity)),
    "login_timeline": _q(lambda ly: gold.login_timeline(ly.hourly_activity)),
    "redteam_summary": _q(lambda ly: gold.redteam_summary(ly.user_features, ly.computer_features)),
    "risk_distribution": _q(lambda ly: gold.risk_distribution(ly.user_risk)),
    "top_computers": _q(lambda ly: gold.top_computers(ly.computer_features)),
    "top_users": _q(lambda ly: gold.top_users(ly.user_features, ly.user_risk)),
    "dashboard_kpis": _q(lambda ly: gold.dashboard_kpis(ly.user_features, ly.hourly_activity, ly.user_risk)),
    # incremental merge
    "merge_daily_user_activity": _q(_merge_daily_user),
    "merge_users_dim": _q(_merge_users),
    "merge_user_computers": _q(_merge_bridge),
    # stored states that are merged over days
    "user_features_colocated": _colocated("user_features"),
    "computer_features_colocated": _colocated("computer_features"),
    "new_user_computers": _colocated("new_pairs"),
    "refresh_daily_user_activity": _refreshed_daily_user,
    "late_user_scores": _scores_of_a_batch,
    "weekly_login_quantiles": _weekly_quantiles,
    "new_users_by_day": _new_users,
    "users_of_both_logs": _users_of_both_logs,
    "top20_over_days": _top_over_days,
    "correlation_over_days": _correlation_of_days,
    "active_users_rolling": _rolling(lambda ly: ly.norm, ACTIVE),
    "redteam_distinct_rolling": _rolling(lambda ly: ly.redteam_events, REDTEAM_SEEN),
    # profile
    "user_shape": _q(lambda ly: profile.shape(ly.user_features)),
    "user_null_counts": _q(lambda ly: profile.null_counts(ly.user_features)),
    "user_describe": _q(lambda ly: profile.describe(ly.user_features)),
    "user_describe_by_cohort": _q(lambda ly: profile.describe(ly.user_features, group_cols=["is_redteam_user"])),
    "user_histogram": _q(lambda ly: profile.histogram(ly.user_features, profile.PROFILE_COLUMNS)),
    "user_correlation": _q(lambda ly: profile.correlation(ly.user_features, profile.PROFILE_COLUMNS)),
    "top20_unique_computers": _q(lambda ly: profile.top_by(ly.user_features, "unique_computers")),
    "top20_total_logins": _q(lambda ly: profile.top_by(ly.user_features, "total_logins")),
    "top20_max_daily": _q(lambda ly: profile.top_by(ly.user_features, "max_daily_authentications")),
    "fact_summary": _q(_fact_summary),
    "user_risk_weighted": _q(lambda ly: gold.user_risk_weighted(ly.risk_scores, ALT_WEIGHTS)),
    "redteam_users_flagged": _q(lambda ly: ly.user_features.where(F.col("is_redteam_user"))),
}
