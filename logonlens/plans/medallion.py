"""The full bronze -> silver -> gold run, with optional JDBC load.

Every step hands over through a written table (which also cuts lineage: a lost executor
re-reads the previous table, never the raw log). Silver tables over the auth log are pruned
aggregates over bronze, each with a small shuffle; ``shared_scan=True`` derives them from
one written activity cube instead (one scan, but the cube may be nearly as large as the log).
Tables of one dependency level are written by concurrent jobs (the same order of levels
as the reference's stages), so small tables do not leave the cluster idle.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logonlens.functions.normalize import normalize_auth
from logonlens.operators import gold, silver, validate
from logonlens.plans.layers import Layers
from logonlens.sources.readers import (
    input_bytes,
    read_auth_csv,
    read_bronze,
    read_by_day,
    read_checked,
    read_redteam_csv,
    read_table,
)
from logonlens.sources.schemas import AUTH, DAILY_COMPUTER_ACTIVITY, DAILY_USER_ACTIVITY, REDTEAM
from logonlens.sources.sinks import (
    load_tables,
    write_bronze_auth,
    write_by_day,
    write_checked,
    write_checked_auth,
    write_table,
)

# Published row order of each table (the reference sorts before writing);
# "-col" = descending with NULLs first.
SORT = {
    "redteam_events": ["timestamp"],
    "redteam_users": ["-events", "user"],
    "redteam_computers": ["-source_events", "computer"],
    "daily_redteam_activity": ["day"],
    "daily_activity": ["day"],
    "daily_computer_activity": ["day", "computer"],
    "daily_user_activity": ["day", "user"],
    "hourly_activity": ["day", "hour"],
    "user_risk": ["-risk_score", "user"],
    "gold_hourly_activity": ["day", "hour"],
    "login_timeline": ["day"],
}
# Tables that grow with the log or its users: ordered inside their parts only.
SORTED_PARTS = ("redteam_events", "user_risk")
# Facts in one folder a day, by the schema they are read with.
BY_DAY = {"daily_computer_activity": DAILY_COMPUTER_ACTIVITY, "daily_user_activity": DAILY_USER_ACTIVITY}
# The gold tables the load step publishes, in load order.
GOLD_TABLES = ("user_risk", "dashboard_kpis", "login_timeline", "risk_distribution", "top_users",
               "top_computers", "hourly_activity", "redteam_summary")


class Paths:
    def __init__(self, root: str):
        self.root = root

    def bronze(self, name: str) -> str:
        return os.path.join(self.root, "bronze", name)

    def silver(self, name: str) -> str:
        return os.path.join(self.root, "silver", name)

    def gold(self, name: str) -> str:
        return os.path.join(self.root, "gold", name)


def read_stored(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A silver or gold table as a run wrote it."""
    path = getattr(Paths(root), layer)(name)
    return read_by_day(spark, path, BY_DAY[name]) if name in BY_DAY else read_table(spark, path)


def ingest_auth(spark: SparkSession, raw: str | list[str], bronze_dir: str,
                num_partitions: int | None = None, pandas_nulls: bool = False, **writer) -> DataFrame:
    """J01 + J02: raw CSV -> bronze parts; returns the one-row validation. ``writer`` goes to
    :func:`~logonlens.sources.sinks.write_bronze_auth` (rows_per_file, day_share, ...)."""
    write_bronze_auth(read_auth_csv(spark, raw, pandas_nulls=pandas_nulls), bronze_dir,
                      num_partitions=num_partitions, source_bytes=input_bytes(spark, raw), **writer)
    return validate.row_count(read_table(spark, bronze_dir))


def ingest_redteam(spark: SparkSession, raw: str | list[str], bronze_path: str,
                   pandas_nulls: bool = False) -> DataFrame:
    """J03 + J04: raw CSV -> bronze table; returns the one-row validation."""
    write_table(read_redteam_csv(spark, raw, pandas_nulls=pandas_nulls), bronze_path)
    return validate.redteam_validation(read_table(spark, bronze_path))


def ingest_checked_auth(spark: SparkSession, raw: str | list[str], bronze_dir: str, pandas_nulls: bool = False,
                        **writer) -> dict:
    """J01 + J02 in one read of the raw log: accepted lines and rejects are written side by side
    and counted on the way (:func:`~logonlens.sources.sinks.write_checked_auth`)."""
    return write_checked_auth(read_checked(spark, raw, AUTH, pandas_nulls), bronze_dir,
                              source_bytes=input_bytes(spark, raw), **writer)


def ingest_checked_redteam(spark: SparkSession, raw: str | list[str], bronze_path: str, pandas_nulls: bool = False) -> dict:
    """J03 with rejects: the counts of :func:`~logonlens.sources.sinks.write_checked`."""
    return write_checked(read_checked(spark, raw, REDTEAM, pandas_nulls), bronze_path)


def _level(jobs: Mapping[str, Callable[[], object]], workers: int) -> dict[str, object]:
    """Run independent jobs concurrently; returns name -> result (a read-back table)."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def run_medallion(spark: SparkSession, root: str, raw_auth: str | list[str] | None = None,
                  raw_redteam: str | list[str] | None = None, skip_bronze: bool = False,
                  only_load: bool = False, jdbc_url: str | None = None,
                  jdbc_properties: Mapping[str, str] | None = None,
                  concurrent_jobs: int = 8, shared_scan: bool = False, pandas_nulls: bool = False,
                  bronze_writer: Mapping[str, object] | None = None, on_bad_lines: str = "reject") -> dict:
    """Run the stages in the reference's order; returns table paths and validations.

    ``skip_bronze`` reuses existing bronze tables; ``only_load`` only publishes existing
    gold tables (needs ``jdbc_url``); the load runs when ``jdbc_url`` is given.
    Each log-derived silver table is its own aggregate over bronze (pruned scans, small
    shuffles); ``shared_scan=True`` makes them rollups of one written cube (one scan), for
    logs in which few (day, hour, user, computer) groups hold many rows. ``pandas_nulls``
    reads the CSV reader's usual spellings of missing values as NULL. Lines that do not fit the
    declared schema go to a rejects partition of the bronze tables, with their counts under
    ``report["ingest"]``; ``on_bad_lines="fail"`` stops at the first one instead. ``bronze_writer``
    holds settings of the bronze writer (:func:`~logonlens.sources.sinks.write_checked_auth`, or
    :func:`~logonlens.sources.sinks.write_bronze_auth` with ``fail``).
    """
    if on_bad_lines not in ("reject", "fail"):
        raise ValueError("on_bad_lines must be 'reject' or 'fail'")
    p = Paths(root)
    report: dict = {"tables": {}, "validation": {}, "seconds": {}}

    def save(layer: str, name: str, build: Callable[[], DataFrame],
             sort_key: str | None = None) -> Callable[[], DataFrame]:
        def job() -> DataFrame:
            path = getattr(p, layer)(name)
            order = [F.desc_nulls_first(c[1:]) if c.startswith("-") else F.col(c)
                     for c in SORT.get(sort_key or name, [])]
            df = build()
            report["tables"][f"{layer}.{name}"] = path
            if name in BY_DAY:
                write_by_day(df, path, [c for c in SORT[name] if c != "day"])
                return read_by_day(spark, path, BY_DAY[name])
            write_table(df, path, sort_by=order, global_order=name not in SORTED_PARTS)
            # read back with the schema just written: no footer pass to infer it
            return spark.read.schema(df.schema).parquet(path)
        return job

    def level(jobs: dict[str, Callable[[], object]]) -> dict:
        start = time.perf_counter()
        out = _level(jobs, concurrent_jobs)
        report["seconds"]["+".join(jobs)] = round(time.perf_counter() - start, 3)
        return out

    if not only_load:
        if not skip_bronze:
            if raw_auth is None or raw_redteam is None:
                raise ValueError("raw_auth and raw_redteam are needed unless skip_bronze")
            # each ingest validates its own output (a one-row result) inside its job
            if on_bad_lines == "fail":
                checks = level({
                    "auth": lambda: ingest_auth(spark, raw_auth, p.bronze("auth"), pandas_nulls=pandas_nulls,
                                                **(bronze_writer or {})).first().asDict(),
                    "redteam": lambda: ingest_redteam(spark, raw_redteam, p.bronze("redteam"),
                                                      pandas_nulls).first().asDict(),
                })
                report["validation"] = dict(checks)
            else:
                counts = level({
                    "auth": lambda: ingest_checked_auth(spark, raw_auth, p.bronze("auth"), pandas_nulls=pandas_nulls,
                                                        **(bronze_writer or {})),
                    "redteam": lambda: ingest_checked_redteam(spark, raw_redteam, p.bronze("redteam"), pandas_nulls),
                })
                report["ingest"] = dict(counts)
                report["validation"] = {
                    "auth": {"rows": counts["auth"]["accepted"]},
                    "redteam": validate.redteam_validation(read_bronze(spark, p.bronze("redteam"))).first().asDict(),
                }
        auth = read_bronze(spark, p.bronze("auth"))
        redteam = read_bronze(spark, p.bronze("redteam"))

        # silver level 1: the one pass over the log, and the red-team events
        first = {"events": save("silver", "redteam_events", lambda: silver.redteam_events(redteam))}
        if shared_scan:
            first["cube"] = save("silver", "activity_cube", lambda: silver.activity_cube(normalize_auth(auth)))
        t = level(first)
        ly = Layers(auth, redteam, cube=t["cube"]) if shared_scan else Layers(auth, redteam)
        events = t["events"]
        # level 2: dimensions, bridge, facts and features (all rollups of the cube plus the
        # red-team events), red-team dimensions
        if shared_scan:
            cube = t["cube"]
            features = {
                "users_f": save("silver", "users_features", lambda: silver.user_features_from_daily(
                    silver.daily_user_extended_from_cube(cube), silver.user_computers_from_cube(cube), events)),
                "computers_f": save("silver", "computers_features", lambda: silver.computer_features_from_daily(
                    silver.daily_computer_extended_from_cube(cube), silver.user_computers_from_cube(cube), events)),
            }
        else:
            features = {}
        t.update(level({
            **features,
            "users": save("silver", "users", lambda: ly.users),
            "computers": save("silver", "computers", lambda: ly.computers),
            "bridge": save("silver", "user_computers", lambda: ly.user_computers),
            "daily": save("silver", "daily_activity", lambda: ly.daily_activity),
            "daily_computer": save("silver", "daily_computer_activity", lambda: ly.daily_computer_activity),
            "daily_user": save("silver", "daily_user_activity", lambda: ly.daily_user_activity),
            "hourly": save("silver", "hourly_activity", lambda: ly.hourly_activity),
            "rt_users": save("silver", "redteam_users", lambda: silver.redteam_users(events)),
            "rt_computers": save("silver", "redteam_computers", lambda: silver.redteam_computers(events)),
            "rt_daily": save("silver", "daily_redteam_activity", lambda: silver.daily_redteam_activity(events)),
        }))
        hourly = t["hourly"]
        if not shared_scan:
            # direct scans: features join the written dimension and fact tables
            t.update(level({
                "users_f": save("silver", "users_features", lambda: silver.user_features(
                    t["users"], t["daily_user"], t["bridge"], events)),
                "computers_f": save("silver", "computers_features", lambda: silver.computer_features(
                    t["computers"], t["daily_computer"], t["bridge"], events)),
            }))
        users_f, computers_f = t["users_f"], t["computers_f"]
        # level 3: risk, and gold tables that need only features or the hourly fact
        t.update(level({
            "risk": save("gold", "user_risk", lambda: gold.user_risk(users_f)),
            "summary": save("gold", "redteam_summary", lambda: gold.redteam_summary(users_f, computers_f)),
            "top_computers": save("gold", "top_computers", lambda: gold.top_computers(computers_f)),
            "gold_hourly": save("gold", "hourly_activity", lambda: hourly, sort_key="gold_hourly_activity"),
            "timeline": save("gold", "login_timeline", lambda: gold.login_timeline(hourly)),
        }))
        risk = t["risk"]
        # level 4: what needs the risk table
        level({
            "distribution": save("gold", "risk_distribution", lambda: gold.risk_distribution(risk)),
            "top_users": save("gold", "top_users", lambda: gold.top_users(users_f, risk)),
            "kpis": save("gold", "dashboard_kpis", lambda: gold.dashboard_kpis(users_f, hourly, risk)),
        })

    if jdbc_url:
        tables = {name: read_table(spark, p.gold(name)) for name in GOLD_TABLES}
        report["loaded"] = load_tables(tables, jdbc_url, jdbc_properties)
    elif only_load:
        raise ValueError("only_load needs jdbc_url")
    return report
