"""Ingest validations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logonlens.functions.metrics import n_unique


def row_count(df: DataFrame) -> DataFrame:
    """The bronze auth check is a plain row count (exact distincts over the whole
    log are what exhausted memory in the reference)."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def redteam_validation(redteam: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows and distinct users / source computers / destination computers."""
    def distinct(c: str):
        return F.approx_count_distinct(c) if approximate else n_unique(c)

    return redteam.agg(
        F.count(F.lit(1)).alias("rows"),
        distinct("user").alias("users"),
        distinct("source_computer").alias("source_computers"),
        distinct("destination_computer").alias("destination_computers"),
    )
