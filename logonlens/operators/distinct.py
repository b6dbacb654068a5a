"""Exact distinct counts that can be stored and merged (AGG9, AGG10, J09, J11).

Counts of distinct users of single days cannot be added up to those of a week. Here every value
gets a dense id once, and a day keeps the set of its ids as bitmaps; sets of any days, users or
other groups are then united by OR, and counted exactly, without going back to the log.

* :func:`value_ids`: dense ids (from 1) per metric, numbered in hash buckets side by side;
  :func:`extend_ids` gives ids to values that a later batch brings, and changes none.
* :func:`group_bitmaps`: one row per (group, metric, bucket of 32,768 ids) with a bitmap. Equal
  values of a group are folded before anything is joined, so a hot user costs a row a day.
* :func:`merge_bitmaps` and :func:`distinct_counts`: the union over coarser groups, and its size.

A NULL is a value like others (AGG9 counts it as one more).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 4


def _long(df: DataFrame, cols: Mapping[str, str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct ``group_cols, metric, value``: ``cols`` maps a metric to the column it counts."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("string").alias("value")) for m, c in cols.items()])
    return df.select(*group_cols, F.inline(pairs)).distinct()


def _numbered(values: DataFrame, first: Column) -> DataFrame:
    """``metric, value, id`` for distinct ``values``: dense from ``first + 1`` within each metric."""
    buckets = BUCKETS_PER_PARTITION * int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = values.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    # at most ``buckets`` rows for each metric
    before = Window.partitionBy("metric").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.groupBy("metric", "bucket").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("metric", "bucket").orderBy("value"))
    return own.withColumn("place", place).join(starts, ["metric", "bucket"]) \
        .select("metric", "value", (first + F.col("start") + F.col("place")).alias("id"))


def value_ids(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """``metric, value, id`` of every distinct value. Store it: bitmaps are read by these ids."""
    return _numbered(_long(df, cols), F.lit(0).cast("long"))


def extend_ids(stored: DataFrame, df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """The ids of the values of ``df`` that ``stored`` has not; append them to it."""
    known = stored.select(F.col("metric").alias("m"), F.col("value").alias("v"))
    new = _long(df, cols).join(known, (F.col("metric") == F.col("m")) & F.col("value").eqNullSafe(F.col("v")), "left_anti")
    last = stored.groupBy(F.col("metric").alias("of")).agg(F.max("id").alias("last"))     # a row per metric
    return _numbered(new, F.lit(0).cast("long")).join(last, F.col("metric") == F.col("of"), "left") \
        .select("metric", "value", (F.col("id") + F.coalesce("last", F.lit(0))).alias("id"))


def group_bitmaps(df: DataFrame, ids: DataFrame, cols: Mapping[str, str], group_cols: Sequence[str]) -> DataFrame:
    """``group_cols, metric, bucket, bitmap``: the ids that occur in each group."""
    known = ids.select(F.col("metric").alias("m"), F.col("value").alias("v"), "id")
    found = _long(df, cols, group_cols).join(known, (F.col("metric") == F.col("m")) & F.col("value").eqNullSafe(F.col("v")))
    return found.groupBy(*group_cols, "metric", F.bitmap_bucket_number("id").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The same rows for coarser groups (or for stored and new bitmaps stacked)."""
    return bitmaps.groupBy(*group_cols, "metric", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, group_cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``group_cols`` and a column of distinct counts for each metric. ``bitmaps`` has one row per
    (group, metric, bucket)."""
    n = F.bitmap_count("bitmap")
    return bitmaps.groupBy(*group_cols).agg(*[
        F.coalesce(F.sum(F.when(F.col("metric") == m, n)), F.lit(0)).alias(m) for m in metrics])


def rolling_distinct(day_bitmaps: DataFrame, days: int, metrics: Sequence[str]) -> DataFrame:
    """``last_day`` and the distinct values seen in the ``days`` days that end with it, for every
    day that has bitmaps."""
    present = day_bitmaps.select(F.col("day").alias("last_day")).distinct()
    spread = day_bitmaps.withColumn("last_day", F.explode(F.sequence(F.col("day"), F.col("day") + days - 1)))
    kept = spread.join(present, "last_day", "left_semi")
    return distinct_counts(merge_bitmaps(kept, ["last_day"]), ["last_day"], metrics)
