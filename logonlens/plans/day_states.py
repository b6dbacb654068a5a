"""States of single days, kept beside the lake and merged for any range of days.

``update`` builds the states of given days from the bronze log (only those days are read) and puts
them in place of what was stored for them; a late correction of a day costs that day. The questions
below then read states, never the log:

* ``distinct``, ``rolling``: exact distinct users and targets (bitmaps over dense ids);
* ``quantiles``: logins of a user a day, by merged KLL sketches;
* ``new_users``, ``in_both_logs``: set questions, by theta sketches;
* ``correlation``: of the daily counts, by merged moment states;
* ``top_users``: the largest totals, exactly, by thresholds over the stored daily fact.

Ids are appended in batches, each under its number, and never change. A batch is only written when
there are new values, and an update that was stopped can be repeated: the ids it had already written
are found again.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from logonlens.functions.normalize import day_of, normalize_auth
from logonlens.operators import distinct, moments, silver, sketches, topk
from logonlens.plans.medallion import Paths
from logonlens.sources.readers import read_bronze, read_by_day
from logonlens.sources.schemas import DAILY_USER_ACTIVITY
from logonlens.sources.sinks import in_days, replace_days

SEEN = {"users": "user", "targets": "destination_computer"}
MEASURED = ("authentications", "success_logins", "failed_logins")
QUANTILES = {"p50": 0.50, "p90": 0.90, "p99": 0.99}

_DAY = StructField("day", LongType())


def _binary(*names: str) -> StructType:
    return StructType([_DAY, *[StructField(n, BinaryType()) for n in names]])


IDS = StructType([StructField("metric", StringType()), StructField("value", StringType()), StructField("id", LongType())])
SCHEMAS = {
    "bitmaps": StructType([_DAY, StructField("metric", StringType()), StructField("bucket", LongType()),
                           StructField("bitmap", BinaryType())]),
    "quantiles": _binary("authentications"),
    "users": _binary("auth"),
    "redteam_users": _binary("redteam"),
    "daily_user_activity": DAILY_USER_ACTIVITY,
}


class DayStates:
    """The states under ``<root>/states``, of the lake at ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.paths, self.root = spark, Paths(root), os.path.join(root, "states")

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    # ---------------------------------------------------------------- building

    def _ids(self) -> DataFrame:
        try:
            return self.spark.read.schema(IDS).option("recursiveFileLookup", "true").parquet(self.path("ids"))
        except AnalysisException:               # nothing is stored yet
            return self.spark.createDataFrame([], IDS)

    def update(self, days: Sequence[int]) -> dict[str, dict]:
        """Build the states of ``days`` anew. Returns the stored rows of each day by state."""
        norm = normalize_auth(read_bronze(self.spark, self.paths.bronze("auth")).where(in_days(days)))
        redteam = silver.redteam_events(read_bronze(self.spark, self.paths.bronze("redteam"))
                                        .withColumn("day", day_of("timestamp")).where(in_days(days)))
        ids = self._ids()
        new = distinct.extend_ids(ids, norm, SEEN)
        first = ids.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        if not new.isEmpty():
            # a batch stands under the last id before it, so a repeated update writes the same one
            new.write.mode("overwrite").parquet(os.path.join(self.path("ids"), f"after={first}"))
        daily = silver.daily_user_activity(norm)
        built = {
            "bitmaps": (distinct.group_bitmaps(norm, self._ids(), SEEN, ["day"]), ["metric", "bucket"]),
            "quantiles": (sketches.quantile_sketches(daily, ["authentications"], ["day"]), []),
            "users": (sketches.set_sketches(norm, {"auth": "user"}, ["day"]), []),
            "redteam_users": (sketches.set_sketches(redteam, {"redteam": "user"}, ["day"]), []),
            "moments": (moments.moment_states(daily, MEASURED, ["day"]), []),
            "daily_user_activity": (daily, ["authentications"]),
        }
        return {name: replace_days(df, self.path(name), days, order) for name, (df, order) in built.items()}

    def _read(self, name: str, first: int | None = None, last: int | None = None) -> DataFrame:
        """A state's rows; a range of days reads only their folders."""
        if name == "moments":
            df = self.spark.read.parquet(self.path(name)).withColumn("day", F.col("day").cast("bigint"))
        else:
            df = read_by_day(self.spark, self.path(name), SCHEMAS[name])
        for bound, keep in ((first, lambda d: F.col("day") >= d), (last, lambda d: F.col("day") <= d)):
            if bound is not None:
                df = df.where(keep(bound))
        return df

    # ---------------------------------------------------------------- questions

    def distinct(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """``users, targets``: exact distinct counts over the days."""
        return distinct.distinct_counts(distinct.merge_bitmaps(self._read("bitmaps", first, last), []), [], list(SEEN))

    def rolling(self, days: int) -> DataFrame:
        """``last_day, users, targets`` over every window of so many days."""
        return distinct.rolling_distinct(self._read("bitmaps"), days, list(SEEN))

    def quantiles(self, first: int | None = None, last: int | None = None, of: Mapping[str, float] = QUANTILES) -> DataFrame:
        """One row: quantiles of a user's logins a day, within ``sketches.kll_rank_error()``."""
        col = "authentications"
        merged = sketches.merge_quantile_sketches(self._read("quantiles", first, last), [col], [])
        return merged.select(*[c.alias(n) for n, c in sketches.sketch_quantiles(merged, col, of).items()])

    def new_users(self) -> DataFrame:
        """``day, new_users``: users that no earlier stored day had (an estimate)."""
        return sketches.before_each_day(self._read("users"), "auth").select(
            "day", sketches.only_in_first("auth", "before").alias("new_users"))

    def in_both_logs(self, by: Column) -> DataFrame:
        """``part, users``: users of both logs by any grouping of days (an estimate)."""
        a, b = (sketches.merge_set_sketches(self._read(name).select("*", by.alias("part")), [column], ["part"])
                for name, column in (("users", "auth"), ("redteam_users", "redteam")))
        return a.join(b, "part").select("part", sketches.in_both("auth", "redteam").alias("users"))

    def correlation(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """``col_a, col_b, n, corr`` of the daily counts."""
        return moments.correlations(moments.merge_states(self._read("moments", first, last)))

    def top_users(self, k: int, first: int | None = None, last: int | None = None) -> DataFrame:
        """``user, total``: the ``k`` users with most logins over the days, exactly."""
        return topk.threshold_top_k(self._read("daily_user_activity", first, last), "user", "authentications", k).result
