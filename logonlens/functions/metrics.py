"""Aggregate expressions shared by the dimension and fact builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two status words the log uses; any other status counts only in
# the row total.
SUCCESS = "Success"
FAILURE = "Failure"


def status_metrics(total_name: str = "authentications", success: str = SUCCESS,
                   failure: str = FAILURE) -> list[Column]:
    """AGG1: rows, successful rows, failed rows (success + failed <= rows)."""
    return [
        F.count(F.lit(1)).alias(total_name),
        F.count_if(F.col("status") == success).alias("success_logins"),
        F.count_if(F.col("status") == failure).alias("failed_logins"),
    ]


def n_unique(col: str) -> Column:
    """AGG9: exact distinct count that counts NULL as one more value."""
    c = F.col(col)
    return F.count_distinct(c) + F.max(c.isNull().cast("int"))


def sum_or_zero(col: str | Column) -> Column:
    """AGG8 global form: an empty sum is 0, not NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.sum(c), F.lit(0))


def sum_if(cond: Column, value: str | Column) -> Column:
    """AGG5: sum of ``value`` over rows where ``cond`` holds, else 0."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))
