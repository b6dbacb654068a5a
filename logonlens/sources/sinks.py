"""Sinks: bronze parquet parts, silver/gold tables, and the JDBC load of gold tables.

All parquet writes are ``mode("overwrite")`` of a whole directory, so re-running a job
after a failure (or after losing executors mid-write) replaces its output instead of
appending to it. A job never overwrites a path it is reading: Spark deletes the target
before the read finishes, so enriched tables get their own paths.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logonlens.functions.normalize import day_of
from logonlens.sources.readers import ACCEPTED

# Uncompressed input bytes per bronze writer task.
BRONZE_BYTES_PER_WRITER = 256 << 20
# Share of the writers that one day's rows are dealt over, where their number is given.
BRONZE_DAY_SHARE = 1.0
# Hash partitions of days before they are split and joined by size: a few times the days of a log,
# so that few days share a partition (whose parts each write a file for every day in it).
DAY_PARTITIONS = 1024


def dealt_by_day(df: DataFrame, writers: int, salts: int | None = None, keys: Sequence[str] = ("day",)) -> DataFrame:
    """``df`` with its ``day``, dealt over writer tasks so that files are few and even.

    All rows of a day go to one shuffle partition, and the adaptive re-plan, which knows the
    measured sizes, splits partitions over the session's advisory size and joins small ones: a
    file a day, and one more for each full partition, however many days there are and however
    much of the log falls on one. Partitions are split between the outputs of map tasks, so a
    source of fewer tasks than ``writers`` (an unsplittable ``.gz``) is dealt by row hash first.

    ``salts`` (or a session without adaptive planning) asks for a fixed number of hash
    partitions on (day, salt) instead."""
    spark = df.sparkSession
    row_hash = F.xxhash64(*df.columns)
    with_day = day_of("timestamp")
    if salts is None and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        if df.rdd.getNumPartitions() < writers:
            df = df.repartition(writers, row_hash)
        # the day comes after it: two exchanges in a row would be made one
        return df.withColumn("day", with_day).hint("rebalance", DAY_PARTITIONS, *keys)
    return df.withColumn("day", with_day).repartition(writers, *keys, F.pmod(row_hash, F.lit(salts or max(1, round(BRONZE_DAY_SHARE * writers)))))


def _writers(df: DataFrame, source_bytes: int | None, bytes_per_writer: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-(source_bytes or 0) // bytes_per_writer))


def write_bronze_auth(df: DataFrame, path: str, num_partitions: int | None = None,
                      rows_per_file: int | None = None, partition_by_day: bool = True,
                      day_share: float = BRONZE_DAY_SHARE, mode: str = "overwrite",
                      source_bytes: int | None = None,
                      bytes_per_writer: int = BRONZE_BYTES_PER_WRITER) -> None:
    """SNK1: the raw auth log as parquet parts.

    With ``partition_by_day`` the parts go under ``day=N/`` directories (daily and
    incremental jobs then prune whole days), dealt by :func:`dealt_by_day`. No range
    shuffle: its sampling would read the unsplittable source twice. Rows are sorted by
    timestamp inside each part so row-group statistics prune time ranges.
    ``mode="append"`` adds a new batch of parts (what the incremental stream picks up).

    With ``num_partitions`` there are that many writers instead, and each day is dealt over
    ``day_share`` of them by a salt that comes from the row (deterministic, so a retried task
    sends every row to the same place). ``rows_per_file`` bounds the rows of a part, if given.
    """
    writers = num_partitions or _writers(df, source_bytes, bytes_per_writer)
    if partition_by_day:
        # (day, timestamp) satisfies the partitioned writer's required ordering on day,
        # so Spark adds no sort of its own that could reorder rows inside a day
        salts = max(1, round(day_share * writers)) if num_partitions else None
        out = dealt_by_day(df, writers, salts).sortWithinPartitions("day", "timestamp")
        writer = out.write.partitionBy("day")
    else:
        writer = df.repartition(writers).sortWithinPartitions("timestamp").write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.mode(mode).parquet(path)


def _observed(df: DataFrame, extra: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    """``df`` with the counts of an ingest, taken while its rows are written. They belong to the
    writing tasks, whose results count once even where a lost executor makes tasks run again."""
    counts = Observation()
    accepted = F.col("outcome") == ACCEPTED
    return df.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(accepted).alias("accepted"),
                      F.count_if(~accepted).alias("rejected"), *extra), counts


def write_checked_auth(df: DataFrame, path: str, source_bytes: int | None = None,
                       bytes_per_writer: int = BRONZE_BYTES_PER_WRITER, rows_per_file: int | None = None) -> dict:
    """SNK1 for a log read by :func:`~logonlens.sources.readers.read_checked`: one job over one read
    of the raw log writes accepted lines under ``outcome=accepted/day=N/`` and bad ones under
    ``outcome=rejected/``, and counts both. Returns ``lines``, ``accepted``, ``rejected`` and the
    first and last second."""
    out = dealt_by_day(df, _writers(df, source_bytes, bytes_per_writer),
                       keys=("outcome", "day")).sortWithinPartitions("outcome", "day", "timestamp")
    out, counts = _observed(out, [F.min("timestamp").alias("first_second"), F.max("timestamp").alias("last_second")])
    writer = out.write.partitionBy("outcome", "day").mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return counts.get


def write_checked(df: DataFrame, path: str) -> dict:
    """SNK2 for a small checked log: ``outcome=accepted/`` and ``outcome=rejected/``, and the counts."""
    out, counts = _observed(df)
    out.write.partitionBy("outcome").mode("overwrite").parquet(path)
    return counts.get


def write_table(df: DataFrame, path: str, sort_by: Sequence[str | object] | None = None,
                rows_per_file: int | None = None, global_order: bool = True) -> None:
    """SNK2 / SNK3: write a silver or gold table, optionally ordered.

    ``sort_by`` is the published order: over all parts by a range-partitioned sort, or with
    ``global_order=False`` inside each part only, which needs no further shuffle (large
    fact tables).
    """
    if not sort_by:
        out = df
    else:
        out = df.orderBy(*sort_by) if global_order else df.sortWithinPartitions(*sort_by)
    writer = out.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_by_day(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """A fact with a ``day``, in one folder a day (files by size, as in :func:`dealt_by_day`), each
    file ordered by ``sort_by``. Single days can then be read, and replaced, on their own."""
    _by_day(df, sort_by).mode("overwrite").parquet(path)


def _by_day(df: DataFrame, sort_by: Sequence[str]):
    return df.hint("rebalance", DAY_PARTITIONS, "day").sortWithinPartitions("day", *sort_by).write.partitionBy("day")


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, mode: str = "overwrite") -> None:
    """A catalog table in ``buckets`` hash buckets of ``by``, one file a bucket and write: joins and
    aggregates by those columns then read it where it lies. ``mode="append"`` adds files to the buckets."""
    df.repartition(buckets, *by).sortWithinPartitions(*by).write.mode(mode).format("parquet") \
        .bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(table)


def in_days(days: Sequence[int | None]) -> Column:
    """Rows of these days; None stands for rows without a day."""
    known = [d for d in days if d is not None]
    wanted = F.col("day").isin(known) if known else F.lit(False)
    return F.coalesce(wanted, F.lit(False)) | F.col("day").isNull() if None in days else wanted


def replace_days(df: DataFrame, path: str, days: Sequence[int | None], sort_by: Sequence[str] = ()) -> dict:
    """Replace single days of a fact written by :func:`write_by_day` with those of ``df``: the
    folders of ``days`` are overwritten, one that has no rows any more is dropped, and no other
    day's files are touched. Returns the rows of each day. Safe to repeat."""
    spark = df.sparkSession
    counts = Observation()
    names = {d: f"day_{k}" for k, d in enumerate(days)}
    one = [F.count_if(F.col("day").eqNullSafe(F.lit(d).cast("long"))).alias(n) for d, n in names.items()]
    new = df.where(in_days(days)).hint("rebalance", DAY_PARTITIONS, "day").sortWithinPartitions("day", *sort_by)
    new.observe(counts, *one).write.partitionBy("day").option("partitionOverwriteMode", "dynamic") \
        .mode("overwrite").parquet(path)
    rows = {d: counts.get[n] for d, n in names.items()}
    for d in (d for d, n in rows.items() if not n):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            path, "day=__HIVE_DEFAULT_PARTITION__" if d is None else f"day={d}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return rows


def jdbc_writer(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                batch_size: int = 10_000, num_partitions: int | None = None):
    """SNK4 for one table: TRUNCATE + insert, keeping the table's existing DDL.

    ``numPartitions`` caps concurrent connections; each partition commits on its own, so
    the load is per-table, not one all-table transaction (load into staging tables and
    swap them in the database if readers must never see a half-loaded set).
    """
    writer = (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", "true")
        .option("batchsize", str(batch_size))
    )
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    return writer


def load_tables(tables: Mapping[str, DataFrame], url: str,
                properties: Mapping[str, str] | None = None, num_partitions: int | None = 8) -> list[str]:
    """Load every gold table over JDBC in the given order; returns the names loaded."""
    loaded = []
    for name, df in tables.items():
        jdbc_writer(df, url, name, properties, num_partitions=num_partitions).save()
        loaded.append(name)
    return loaded
