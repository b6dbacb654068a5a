"""Exact top-k over days without adding up every entity (TOP1, TOP3).

The stored fact has one row per (day, entity). The largest totals over a range of days are found by
the three-phase uniform threshold method, with the days as the lists:

1. Each day gives its ``k`` largest rows. The ``k``-th largest sum of these is a lower bound of the
   ``k``-th total.
2. An entity below ``bound / days`` on every day cannot reach it, so each day gives its rows from
   that value on (a filter that reaches the scan; with files ordered by value it skips row groups).
   What an entity has not shown is less than the threshold a day: that bounds its total from above,
   and the ``k``-th largest sum seen bounds the result from below once more.
3. Only the entities whose upper bound reaches it are added up in full.

Values must not be negative. Ties in the total are broken by the entity, ascending. Rows without a
value count as zero; entities of a NULL key are one entity. With fewer than ``k`` entities all are
returned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


@dataclass
class Phases:
    """The three reads of the fact, and the result."""
    first: DataFrame
    second: DataFrame
    third: DataFrame
    result: DataFrame
    threshold: float


def _kth_largest(sums: DataFrame, k: int) -> float:
    """The ``k``-th largest ``total``, or 0 if there are fewer."""
    row = sums.orderBy(F.desc("total")).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("low")).first()
    return float(row["low"]) if row["n"] == k else 0.0


def threshold_top_k(fact: DataFrame, key: str, value: str, k: int, day: str = "day") -> Phases:
    """The ``k`` entities of ``fact`` (one row per day and entity) with the largest total ``value``:
    ``result`` has ``key`` and ``total``."""
    def long_form(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(day).alias("__day"), F.col(key).alias(key), F.coalesce(F.col(value), F.lit(0)).alias("__value"))

    own = long_form(fact)
    days = own.select("__day").distinct().count()
    place = F.row_number().over(Window.partitionBy("__day").orderBy(F.desc("__value"), key))
    first = own.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")
    total = F.sum("__value").alias("total")
    threshold = _kth_largest(first.groupBy(key).agg(total), k) / max(days, 1)
    # on the stored column and in its own type, so that the filter reaches the scan
    whole = isinstance(fact.schema[value].dataType, IntegralType)
    second = long_form(fact.where(F.col(value) >= F.lit(math.ceil(threshold) if whole else threshold))) if threshold > 0 else own
    seen = second.groupBy(key).agg(total, F.count(F.lit(1)).alias("days"))
    reach = _kth_largest(seen, k)
    candidates = seen.where(F.col("total") + (days - F.col("days")) * F.lit(threshold) >= F.lit(reach)).select(F.col(key).alias("__key"))
    third = own.join(candidates, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    result = third.groupBy(key).agg(total).orderBy(F.desc("total"), F.asc(key)).limit(k)
    return Phases(first, second, third, result, threshold)
