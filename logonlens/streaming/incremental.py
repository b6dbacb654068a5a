"""Incremental refresh of the silver layer as new bronze auth parts land.

The reference aggregates each bronze part separately and merges the partials. Here the
same algebra runs as a Structured Streaming job: a file source over the bronze
directory turns newly arrived parts into micro-batches; ``foreachBatch`` aggregates each
batch to a partial :func:`~logonlens.operators.silver.activity_cube` and writes it under
``partials/batch=<id>``. A replayed batch (after a driver or executor failure) rewrites
the same directory, so each batch counts exactly once. :func:`merged_cube` folds the
partials (sum of counts, min of first, max of last), and every silver table follows from
it as a rollup (:class:`~logonlens.plans.layers.Layers` with ``cube=``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from logonlens.functions.normalize import normalize_auth
from logonlens.operators.merge import fold_partials
from logonlens.operators.silver import activity_cube
from logonlens.sources.schemas import AUTH

CUBE_KEYS = ("day", "hour", "user", "destination_computer")
CUBE_SUMS = ("authentications", "success_logins", "failed_logins")

# Bronze auth as written by write_bronze_auth: the 9 raw columns plus the day partition.
BRONZE_AUTH = StructType(AUTH.fields + [StructField("day", LongType(), True)])


def _partials(state_dir: str) -> str:
    return os.path.join(state_dir, "partials")


def start_refresh(spark: SparkSession, bronze_auth_dir: str, state_dir: str,
                  checkpoint_location: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops."""
    reader = spark.readStream.schema(BRONZE_AUTH)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(bronze_auth_dir)
    target = _partials(state_dir)

    def fold(batch: DataFrame, batch_id: int) -> None:
        partial = activity_cube(normalize_auth(batch.drop("day")))
        partial.write.mode("overwrite").parquet(os.path.join(target, f"batch={batch_id}"))

    # The checkpoint belongs to the state: a restart must resume the same batch ids, or a
    # replay would rewrite batch 0 with everything and double count later partials.
    writer = (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint_location or os.path.join(state_dir, "_checkpoint"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _snapshots(state_dir: str) -> str:
    return os.path.join(state_dir, "snapshots")


def _committed(spark: SparkSession, parent: str, key: str) -> dict[int, str]:
    """``{n: path}`` of the ``key=n`` directories under ``parent`` whose write committed
    (``_SUCCESS`` present). A directory still being written, or left half-written by a
    failure, is never read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(parent)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(key + "="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found[int(name.split("=", 1)[1])] = status.getPath().toString()
    return found


def merged_cube(spark: SparkSession, state_dir: str, last_batch: int | None = None) -> DataFrame:
    """The activity cube over every batch processed so far (AGG12 merge of partials).

    Reads the latest committed snapshot (if :func:`compact` made one) plus only the
    committed partials of later batches, so the cost follows the data since the last
    compaction, not the stream's whole history. Partials overlap on keys (an hour spans
    parts), so they are merged with the cube's rule rather than unioned. ``last_batch``
    leaves later batches out, also ones that are committed meanwhile.
    """
    def within(n: int) -> bool:
        return last_batch is None or n <= last_batch

    snapshots = {n: p for n, p in _committed(spark, _snapshots(state_dir), "upto").items() if within(n)}
    upto = max(snapshots) if snapshots else -1
    paths = [p for n, p in sorted(_committed(spark, _partials(state_dir), "batch").items()) if n > upto and within(n)]
    frames = []
    if snapshots:
        frames.append(spark.read.parquet(snapshots[upto]))
    if paths:
        frames.append(spark.read.option("basePath", _partials(state_dir)).parquet(*paths).drop("batch"))
    if not frames:
        raise ValueError(f"no committed batches under {state_dir}")
    parts = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return fold_partials(parts, CUBE_KEYS, sums=CUBE_SUMS, mins=("first_ts",), maxs=("last_ts",))


def compact(spark: SparkSession, state_dir: str) -> int:
    """Fold everything processed so far into ``snapshots/upto=<last batch>``; returns that
    batch id. Batches committed while it runs are left to the next one. Old partials and
    snapshots stay (readers skip them), a snapshot only counts once its write has committed,
    and one that is there already is not written again."""
    batches = _committed(spark, _partials(state_dir), "batch")
    if not batches:
        raise ValueError(f"no committed batches under {state_dir}")
    last = max(batches)
    if last not in _committed(spark, _snapshots(state_dir), "upto"):
        # reads older snapshots and partials only, so it never overwrites what it reads
        merged_cube(spark, state_dir, last).write.mode("overwrite").parquet(
            os.path.join(_snapshots(state_dir), f"upto={last}"))
    return last


def batches_seen(spark: SparkSession, state_dir: str) -> DataFrame:
    """One row per committed batch with its cube rows (a progress view)."""
    paths = list(_committed(spark, _partials(state_dir), "batch").values())
    if not paths:
        raise ValueError(f"no committed batches under {state_dir}")
    return (
        spark.read.option("basePath", _partials(state_dir)).parquet(*paths)
        .groupBy("batch").agg(F.count(F.lit(1)).alias("cube_rows"))
    )
