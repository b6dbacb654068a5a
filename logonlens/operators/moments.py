"""Means, variances and correlations from states that merge (STA2, STA5).

A group's state of two columns is its number of complete rows, both means, the sums of squared
and joint deviations from them, and the least and largest values (so that a column that does not vary
is known for sure, whatever rounding leaves of its deviations). Two states merge pairwise (Chan, Golub and LeVeque): the deviations
add up, plus one term of the distance of the means. No sum of squares of raw values is ever formed, so
nothing cancels where values are large and close together (seconds, or counters near 1e9). States of
days are stored, and any range is merged from them.

Rows in which either column is NULL are left out of a pair's state. A correlation is NULL where a
column does not vary.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logonlens.operators.profile import round_to

STATE = ("struct<n: bigint, mean_a: double, mean_b: double, m_a: double, m_b: double, m_ab: double, "
         "low_a: double, high_a: double, low_b: double, high_b: double>")


def moment_states(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols, col_a, col_b, state`` for every pair of columns (each also with itself)."""
    states = []
    for a, b in [*combinations(cols, 2), *[(c, c) for c in cols]]:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        n = F.count_if(both)
        states.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.struct(
            n.alias("n"), F.avg(x).alias("mean_a"), F.avg(y).alias("mean_b"), (F.var_pop(x) * n).alias("m_a"),
            (F.var_pop(y) * n).alias("m_b"), (F.covar_pop(x, y) * n).alias("m_ab"), F.min(x).alias("low_a"),
            F.max(x).alias("high_a"), F.min(y).alias("low_b"), F.max(y).alias("high_b")).cast(STATE).alias("state")))
    return df.groupBy(*group_cols).agg(F.array(*states).alias("pairs")).select(*group_cols, F.inline("pairs"))


def merge_two(a: Column, b: Column) -> Column:
    """The state of the rows of both."""
    n = a["n"] + b["n"]
    share = b["n"] / n
    dx, dy = b["mean_a"] - a["mean_a"], b["mean_b"] - a["mean_b"]
    weight = a["n"] * share
    merged = F.struct(
        n.alias("n"), (a["mean_a"] + dx * share).alias("mean_a"), (a["mean_b"] + dy * share).alias("mean_b"),
        (a["m_a"] + b["m_a"] + dx * dx * weight).alias("m_a"), (a["m_b"] + b["m_b"] + dy * dy * weight).alias("m_b"),
        (a["m_ab"] + b["m_ab"] + dx * dy * weight).alias("m_ab"),
        *[pick(a[k], b[k]).alias(k) for c in "ab" for k, pick in ((f"low_{c}", F.least), (f"high_{c}", F.greatest))])
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(merged.cast(STATE))


def merge_states(states: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The states of coarser groups. A group folds one small state for each finer one (a day)."""
    empty = F.from_json(F.lit('{"n": 0}'), STATE)
    listed = states.groupBy(*group_cols, "col_a", "col_b").agg(F.sort_array(F.collect_list("state")).alias("states"))
    return listed.select(*group_cols, "col_a", "col_b", F.aggregate("states", empty, merge_two).alias("state"))


def correlations(states: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols, col_a, col_b, n, corr`` for both orders of every pair, 6 decimals."""
    s = F.col("state")
    varies = (s["low_a"] < s["high_a"]) & (s["low_b"] < s["high_b"])
    corr = F.when(varies, round_to(s["m_ab"] / F.sqrt(F.nullif(s["m_a"], F.lit(0.0)) * F.nullif(s["m_b"], F.lit(0.0)))))
    one = states.select(*group_cols, "col_a", "col_b", s["n"].alias("n"), corr.alias("corr"))
    other = one.where("col_a != col_b").select(*group_cols, F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "n", "corr")
    return one.unionByName(other)


def mean_and_deviation(states: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols, column, n, mean, std`` (sample) of every column, 6 decimals."""
    s = F.col("state")
    return states.where("col_a = col_b").select(
        *group_cols, F.col("col_a").alias("column"), s["n"].alias("n"), round_to(s["mean_a"]).alias("mean"),
        F.when(s["low_a"] == s["high_a"], F.when(s["n"] > 1, F.lit(0.0)))
        .otherwise(round_to(F.sqrt(s["m_a"] / F.nullif(s["n"] - 1, F.lit(0))))).alias("std"))
