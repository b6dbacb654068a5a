"""Sketches that are stored per day and merged over any days (STA2, STA6, AGG10, STA7).

Exact quantiles and set questions over a long range need all of its rows. A sketch per day is a few
kilobytes, is built in one pass with map-side folding, and merges with others; the answer for any
range then reads only sketches, within a known error.

* Quantiles: KLL sketches. An answer's rank is off by at most :func:`kll_rank_error` of the rows,
  which is twice the error that 99 % of sketches of that size keep.
* Sets (users of both logs, users not seen before): theta sketches with union, intersection and
  difference, off by at most :func:`theta_error` of the size of the union that was asked about. Sets
  of up to ``2 ** lg_entries`` values are held exactly.

NULLs are left out of both. Empty groups give no sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KLL_K = 400
THETA_LG_ENTRIES = 14


def kll_rank_error(k: int = KLL_K) -> float:
    """Largest error of a normalized rank to count on: twice the published 99 % bound of one-sided
    ranks, ``2.296 / k ** 0.9723``."""
    return 2 * 2.296 / k ** 0.9723


def theta_error(lg_entries: int = THETA_LG_ENTRIES) -> float:
    """Largest error of a set's size to count on, as a share of the union: four standard errors."""
    return 4 / (2 ** lg_entries) ** 0.5


def quantile_sketches(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str], k: int = KLL_K) -> DataFrame:
    """``group_cols`` and a KLL sketch of each whole-number column."""
    return df.groupBy(*group_cols).agg(*[F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), k).alias(c) for c in cols])


def merge_quantile_sketches(sketches: DataFrame, cols: Sequence[str], group_cols: Sequence[str], k: int = KLL_K) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*group_cols).agg(*[F.kll_merge_agg_bigint(c, k).alias(c) for c in cols])


def sketch_quantiles(sketches: DataFrame, col: str, quantiles: Mapping[str, float]) -> dict[str, Column]:
    """Quantile name -> its value by the sketch in ``col``."""
    return {name: F.kll_sketch_get_quantile_bigint(F.col(col), F.lit(float(q))) for name, q in quantiles.items()}


def ranks_hold(df: DataFrame, estimates: DataFrame, col: str, quantiles: Mapping[str, float], group_cols: Sequence[str],
               k: int = KLL_K) -> DataFrame:
    """``group_cols`` and ``<name>_within`` for each quantile: whether the estimate (a column of its
    name in ``estimates``, one row per group) has a rank within the error among the rows of ``df``."""
    both = df.select(*group_cols, F.col(col).alias("__x")).where("__x IS NOT NULL").join(estimates, list(group_cols))
    n = F.count(F.lit(1))
    off = kll_rank_error(k)
    within = []
    for name, q in quantiles.items():
        below, upto = F.count_if(F.col("__x") < F.col(name)) / n, F.count_if(F.col("__x") <= F.col(name)) / n
        within.append(((below - off <= q) & (upto + off >= q)).alias(f"{name}_within"))
    return both.groupBy(*group_cols).agg(*within)


def set_sketches(df: DataFrame, cols: Mapping[str, str], group_cols: Sequence[str], lg_entries: int = THETA_LG_ENTRIES) -> DataFrame:
    """``group_cols`` and a theta sketch of the distinct values of each column (``cols``: name -> column)."""
    return df.groupBy(*group_cols).agg(*[F.theta_sketch_agg(c, lg_entries).alias(name) for name, c in cols.items()])


def merge_set_sketches(sketches: DataFrame, names: Sequence[str], group_cols: Sequence[str],
                       lg_entries: int = THETA_LG_ENTRIES) -> DataFrame:
    """The sketches of the unions over coarser groups."""
    return sketches.groupBy(*group_cols).agg(*[F.theta_union_agg(c, lg_entries).alias(c) for c in names])


def estimate(sketch: str | Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def in_both(a: str | Column, b: str | Column) -> Column:
    """Estimated number of values in both sets."""
    return F.coalesce(F.theta_sketch_estimate(F.theta_intersection(a, b)), F.lit(0).cast("long"))


def only_in_first(a: str | Column, b: str | Column) -> Column:
    """Estimated number of values of ``a`` that are not in ``b`` (NULL: an empty set)."""
    b = F.col(b) if isinstance(b, str) else b
    return F.when(b.isNull(), F.theta_sketch_estimate(a)).otherwise(F.theta_sketch_estimate(F.theta_difference(a, b)))


def before_each_day(day_sketches: DataFrame, name: str, lg_entries: int = THETA_LG_ENTRIES) -> DataFrame:
    """``day``, its sketch, and ``before``: the union of all earlier days' (NULL on the first). A row
    per day goes through one window: bounded by the days that are stored."""
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return day_sketches.select("day", name, F.theta_union_agg(name, lg_entries).over(earlier).alias("before"))
