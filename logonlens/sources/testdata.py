"""Adapter: derive an auth log and a red-team log from the driver's ``events`` table.

The test data ships no authentication log, so both logs are a deterministic function of
``events`` (see FIXTURES.md §2). The DuckDB oracle applies the same rules in SQL.
Everything stays a lazy projection / filter over the ``events`` scan, so its work grows
with the table.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The adapter's epoch, label rules and constant auth attributes.
EPOCH = "2024-01-01 00:00:00"
MACHINE_MOD, MACHINE_REMAINDER, ANONYMOUS_REMAINDER = 20, 0, 1
NON_COMPUTER_TARGET_MOD, NON_COMPUTER_TARGET_REMAINDER = 50, 3
SOURCE_COMPUTER_MOD = 37
REDTEAM_EVENT_TYPE, REDTEAM_MIN_VALUE = "error", 150
REDTEAM_OUTSIDER_MOD, REDTEAM_OUTSIDER = 7, "U9999@DOM1"
REDTEAM_SOURCE_ONLY = "C900"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def _seconds() -> Column:
    # timestamp_ntz arithmetic: independent of the session time zone.
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{EPOCH}', ts)")


def _person() -> Column:
    uid = F.col("user_id").cast("string")
    return F.concat(F.lit("U"), uid, F.lit("@DOM"), (F.col("user_id") % 3 + 1).cast("string"))


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def auth_from_events(ev: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    source_user = (
        F.when(eid % MACHINE_MOD == MACHINE_REMAINDER,
               F.concat(F.lit("C"), F.col("user_id").cast("string"), F.lit("$@DOM1")))
        .when(eid % MACHINE_MOD == ANONYMOUS_REMAINDER, F.lit("ANONYMOUS LOGON"))
        .otherwise(_person())
    )
    destination = (
        F.when(eid % NON_COMPUTER_TARGET_MOD == NON_COMPUTER_TARGET_REMAINDER, F.lit("TGT"))
        .otherwise(F.concat(F.lit("C"), _k()))
    )
    status = (
        F.when(F.col("event_type") == "error", F.lit("Failure"))
        .when(F.col("event_type") == "signup", F.lit("?"))
        .otherwise(F.lit("Success"))
    )
    return ev.select(
        _seconds().alias("timestamp"),
        source_user.alias("source_user"),
        _person().alias("destination_user"),
        F.concat(F.lit("C"), (eid % SOURCE_COMPUTER_MOD).cast("string")).alias("source_computer"),
        destination.alias("destination_computer"),
        F.lit("Kerberos").alias("authentication_type"),
        F.lit("Network").alias("logon_type"),
        F.lit("LogOn").alias("authentication_orientation"),
        status.alias("status"),
    )


def redteam_from_events(ev: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return (
        ev.where((F.col("event_type") == REDTEAM_EVENT_TYPE) & (F.col("value") > REDTEAM_MIN_VALUE))
        .select(
            _seconds().alias("timestamp"),
            F.when(eid % REDTEAM_OUTSIDER_MOD == 0, F.lit(REDTEAM_OUTSIDER)).otherwise(_person()).alias("user"),
            F.when(eid % 2 == 0, F.lit(REDTEAM_SOURCE_ONLY))
            .otherwise(F.concat(F.lit("C"), (eid % SOURCE_COMPUTER_MOD).cast("string")))
            .alias("source_computer"),
            F.concat(F.lit("C"), _k()).alias("destination_computer"),
        )
    )


def auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auth_from_events(events(spark, sf_dir))


def redteam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redteam_from_events(events(spark, sf_dir))
