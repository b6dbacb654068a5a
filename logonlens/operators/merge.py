"""Mergeable aggregates (AGG12, SET2): fold a new batch's aggregate into a stored one.

The reference aggregates each bronze part on its own and merges the partials with
sum-of-sums, min-of-mins and max-of-maxes. A full build in Spark is just one
``groupBy().agg()`` (partial + final aggregate are built in); these functions keep the
merge rule as the incremental-refresh operator: ``merge(agg(A), agg(B)) == agg(A ∪ B)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Merge rules of the stored silver aggregates: (keys, summed, min-merged, max-merged).
USERS_RULE = (("user",), ("total_logins", "success_logins", "failed_logins"),
              ("first_login",), ("last_login",))
COMPUTERS_RULE = (("computer",), ("total_authentications", "success_logins", "failed_logins"),
                  ("first_seen",), ("last_seen",))
_ACTIVITY = ("authentications", "success_logins", "failed_logins")
DAILY_ACTIVITY_RULE = (("day",), _ACTIVITY, (), ())
DAILY_USER_RULE = (("day", "user"), _ACTIVITY, (), ())
DAILY_COMPUTER_RULE = (("day", "computer"), _ACTIVITY, (), ())
HOURLY_RULE = (("day", "hour"), _ACTIVITY, (), ())


def fold_partials(partials: DataFrame, keys: Sequence[str], sums: Sequence[str] = (),
                  mins: Sequence[str] = (), maxs: Sequence[str] = ()) -> DataFrame:
    """Re-aggregate stacked partial aggregates by ``keys`` with the merge rule; output
    columns keep the partials' order."""
    exprs = {c: F.sum(c).alias(c) for c in sums}
    exprs.update({c: F.min(c).alias(c) for c in mins})
    exprs.update({c: F.max(c).alias(c) for c in maxs})
    cols = [c for c in partials.columns if c in set(keys) | set(exprs)]
    return partials.groupBy(*keys).agg(*exprs.values()).select(*cols)


def merge_aggregates(stored: DataFrame, batch: DataFrame, keys: Sequence[str],
                     sums: Sequence[str] = (), mins: Sequence[str] = (),
                     maxs: Sequence[str] = ()) -> DataFrame:
    """AGG12: union the two aggregates and re-aggregate by ``keys`` with the merge rule.
    Output columns keep ``stored``'s order."""
    return fold_partials(stored.unionByName(batch), keys, sums, mins, maxs).select(*stored.columns)


def merge_with_rule(stored: DataFrame, batch: DataFrame, rule) -> DataFrame:
    keys, sums, mins, maxs = rule
    return merge_aggregates(stored, batch, keys, sums, mins, maxs)


def merge_distinct(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """SET2: distinct rows of the union of two (already distinct) sets."""
    return stored.unionByName(batch).distinct()


def split_at(df: DataFrame, cut_timestamp: int, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Split a log into the part before ``cut_timestamp`` and the rest (NULL stamps go
    to the second part, so no row is lost)."""
    before = F.col(ts) < F.lit(cut_timestamp)
    return df.where(before), df.where(~F.coalesce(before, F.lit(False)))
