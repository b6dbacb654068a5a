"""Silver tables kept co-located by user or computer (JON1, JON2, SET2, J16, J17).

The dimensions, daily facts and bridges are catalog tables in hash buckets of their entity, all in
the same number. Feature builds then aggregate and join them bucket by bucket, with no shuffle of a
stored table; only the red-team counts move. A new batch of the bridge is compared with the stored
pairs by shuffling the batch alone, and its new pairs are appended to their buckets.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from logonlens.operators import silver
from logonlens.plans.layers import Layers
from logonlens.sources.sinks import write_bucketed

USER_TABLES = {"users": "users", "daily_user": "daily_user_activity", "user_bridge": "user_computers"}
COMPUTER_TABLES = {"computers": "computers", "daily_computer": "daily_computer_activity", "computer_bridge": "user_computers"}

# A join on (user, computer) may use buckets of the user alone: equal pairs have equal users.
_PARTIAL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def default_buckets(spark: SparkSession) -> int:
    """As many as shuffles have partitions, so that a co-located stage is as parallel as others."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Colocated:
    """The bucketed tables ``<prefix>_<name>`` under the folder ``root``."""

    def __init__(self, spark: SparkSession, prefix: str, root: str, buckets: int | None = None):
        self.spark, self.prefix, self.root = spark, prefix, root
        self.buckets = buckets or default_buckets(spark)

    def name(self, table: str) -> str:
        return f"{self.prefix}_{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def write(self, table: str, df: DataFrame, by: str, mode: str = "overwrite") -> None:
        write_bucketed(df, self.name(table), f"{self.root}/{table}", [by], self.buckets, mode)

    def store(self, layers: Layers) -> None:
        """Build all six tables (the bridge once by user and once by computer)."""
        for tables, by in ((USER_TABLES, "user"), (COMPUTER_TABLES, "computer")):
            for table, source in tables.items():
                self.write(table, getattr(layers, source), by)

    def drop(self) -> None:
        for table in (*USER_TABLES, *COMPUTER_TABLES):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def user_features(self, events: DataFrame) -> DataFrame:
        """J16 without an exchange on the stored side."""
        return silver.user_features(self.table("users"), self.table("daily_user"), self.table("user_bridge"), events)

    def computer_features(self, events: DataFrame) -> DataFrame:
        """J17 without an exchange on the stored side."""
        return silver.computer_features(self.table("computers"), self.table("daily_computer"),
                                        self.table("computer_bridge"), events)

    def new_pairs(self, batch: DataFrame, bridge: str = "user_bridge") -> DataFrame:
        """The distinct (user, computer) pairs of ``batch`` that the bridge has not. Plan and run it
        inside :meth:`partial_keys`, or the stored side is shuffled too."""
        return batch.select("user", "computer").distinct().join(self.table(bridge), ["user", "computer"], "left_anti")

    @contextmanager
    def partial_keys(self):
        before = self.spark.conf.get(_PARTIAL_KEYS)
        self.spark.conf.set(_PARTIAL_KEYS, "false")
        try:
            yield
        finally:
            self.spark.conf.set(_PARTIAL_KEYS, before)

    def append_pairs(self, batch: DataFrame) -> None:
        """SET2: append the batch's new pairs to both bridges. Each bridge is compared on its own, so
        a run that stopped between the two can be repeated."""
        with self.partial_keys():
            for bridge, by in (("user_bridge", "user"), ("computer_bridge", "computer")):
                self.write(bridge, self.new_pairs(batch, bridge), by, "append")
