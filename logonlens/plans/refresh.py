"""Refresh of single days of the stored facts (AGG12, J12-J15).

Late or corrected log lines change the facts of a few days. Instead of building each fact anew, the
days in question are aggregated from bronze, whose other days are not even listed as partitions to
read, and replace their folders; facts with a handful of rows a day are rewritten as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from logonlens.functions.normalize import normalize_auth
from logonlens.operators import silver
from logonlens.plans.medallion import Paths
from logonlens.session import scratch_path
from logonlens.sources.readers import read_bronze, read_table
from logonlens.sources.sinks import in_days, replace_days, write_table

# Facts in one folder a day, and the order inside their files.
DAY_FACTS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str]]] = {
    "daily_user_activity": (silver.daily_user_activity, ["user"]),
    "daily_computer_activity": (silver.daily_computer_activity, ["computer"]),
}
# Facts of at most 24 rows a day, in one sorted table.
SMALL_FACTS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str]]] = {
    "daily_activity": (silver.daily_activity, ["day"]),
    "hourly_activity": (silver.hourly_activity, ["day", "hour"]),
}


def replace_small(new: DataFrame, path: str, days: Sequence[int | None], sort_by: Sequence[str]) -> None:
    """Replace days of a small table. The result is staged, since a path that is read cannot be
    overwritten; a run that is stopped after the staging can be repeated."""
    spark = new.sparkSession
    stored = read_table(spark, path)
    staged = scratch_path(spark, "refresh")
    stored.where(~in_days(days) | stored["day"].isNull() if None not in days else ~in_days(days)) \
        .unionByName(new.where(in_days(days))).write.parquet(staged)
    write_table(read_table(spark, staged), path, sort_by=sort_by)


def refresh_days(spark: SparkSession, root: str, days: Sequence[int | None], facts: Sequence[str] | None = None) -> dict:
    """Build ``days`` of the facts under ``root`` anew from its bronze log. Returns the rows that each
    day has in the facts kept by day."""
    p = Paths(root)
    norm = normalize_auth(read_bronze(spark, p.bronze("auth")).where(in_days(days)))
    wanted = list(facts) if facts is not None else [*DAY_FACTS, *SMALL_FACTS]
    rows = {}
    for name in wanted:
        if name in DAY_FACTS:
            build, order = DAY_FACTS[name]
            rows[name] = replace_days(build(norm), p.silver(name), days, order)
        else:
            build, order = SMALL_FACTS[name]
            replace_small(build(norm), p.silver(name), days, order)
    return rows
