"""Ranks from cells of values: the cells, the joins between their levels, stored populations."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_skew import NO_ADAPTIVE, with_conf

from logonlens.functions import scoring


def plain_scores(values):
    """Percentile of every value among all, ties sharing their average rank."""
    known = sorted(v for v in values if v is not None)
    first = {}
    for i, v in enumerate(known):
        first.setdefault(v, i)
    ties = Counter(known)
    return {v: (first[v] + (ties[v] + 1) / 2 - 1) / (len(values) - 1) * 100 for v in first} | {None: None}


def test_cells_do_not_fall_as_values_rise(spark):
    rng = random.Random(7)
    values = [0.0, 1.0, -1.0, 5e-324, 1e-300, -1e-300, 1.7e308, -1.7e308, math.inf, -math.inf, 2.0 ** 53, 2.0 ** 53 + 2]
    values += [float(i) for i in range(-50, 3000)] + [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 15) for _ in range(3000)]
    values += [math.nextafter(v, math.inf) for v in values if math.isfinite(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for cells in (1, 8, scoring.COARSE_CELLS):
        got = sorted((r.v, r.cell) for r in df.select("v", scoring.fine_cell(F.col("v"), cells).alias("cell")).collect())
        assert all(a[1] <= b[1] for a, b in zip(got, got[1:], strict=False))
    nan = spark.createDataFrame([(math.nan,), (math.inf,)], "v double")
    assert nan.select(scoring.fine_cell(F.col("v"))).distinct().count() == 1
    # whole numbers up to millions lie in fine cells of their own
    whole = spark.range(0, 2_000_000).select(scoring.fine_cell(F.col("id").cast("double")).alias("cell"))
    assert whole.distinct().count() == 2_000_000


@pytest.mark.parametrize("rows", [
    [None, 1.0], [math.nan, 1.0, math.inf, -math.inf, 0.0, -0.0, None], [1e9 + i / 1e6 for i in range(300)] * 2, [5.0] * 40 + [None] * 3])
def test_ranks_of_close_and_special_values(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "k int, x double")
    got = {(r.value, r.c, r.below) for r in scoring.value_ranks(df, ["x"]).collect() if r.value is not None and not math.isnan(r.value)}
    known = sorted(v for v in rows if v is not None and not math.isnan(v))
    assert got == {(v, known.count(v), sum(x < v for x in known)) for v in known}
    nan = [r for r in scoring.value_ranks(df, ["x"]).collect() if r.value is not None and math.isnan(r.value)]
    assert all(r.below == len(known) for r in nan)


def test_no_join_collects_a_metric(spark):
    """With nothing broadcast, every join between the levels has a cell in its key, and every window
    over values a fine cell."""
    df = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") * 31 % 613).alias("x"), (F.col("id") % 7).alias("y"))

    def run():
        return scoring.value_ranks(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()

    plan = with_conf(spark, NO_ADAPTIVE, run)
    joins = re.findall(r"SortMergeJoin \[(.*?)\], \[", plan)
    assert len(joins) == 2 and all("coarse" in j or "fine" in j for j in joins), joins
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert windows and all("metric" in keys for keys, _ in windows)
    assert all("fine" in keys for keys, order in windows if "value" in order), windows
    assert "SinglePartition" not in plan and "Broadcast" not in plan


def test_a_batch_is_scored_against_the_stored_population(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, float(rng.choice([0, 0, 0, 1, 5])), None if rng.random() < 0.1 else rng.randint(0, 400)) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, x double, y int")
    old, batch = df.where("k % 10 != 0"), df.where("k % 10 = 0")
    inputs = {"px": "x", "py": "y"}
    for name, table in zip(("hist", "cells"), scoring.StoredRanks.tables(old, ["x", "y"]), strict=True):
        table.write.parquet(str(tmp_path / name))
    stored = scoring.StoredRanks(*(spark.read.parquet(str(tmp_path / name)) for name in ("hist", "cells")))
    got = {r.k: (r.px, r.py) for r in scoring.score_columns(batch, inputs, "k", ranks=stored.ranks_with(batch, ["x", "y"])).collect()}
    want = [plain_scores([r[c] for r in rows]) for c in (1, 2)]
    assert got == {k: (want[0][x], want[1][y]) for k, x, y in rows if k % 10 == 0}
    # the batch added to the tables gives those of all rows
    merged = stored.merged_tables(batch, ["x", "y"])
    for got_table, want_table in zip(merged, scoring.StoredRanks.tables(df, ["x", "y"]), strict=True):
        assert Counter(map(tuple, got_table.select(*want_table.columns).collect())) == Counter(map(tuple, want_table.collect()))
    # values that the population does not have, and an empty batch
    new = spark.createDataFrame([(1, 2.5, 1000)], "k int, x double, y int")
    r = scoring.score_columns(new, inputs, "k", ranks=stored.ranks_with(new, ["x", "y"])).first()
    olds = [x for k, x, _ in rows if k % 10]
    assert r.px == sum(x < 2.5 for x in olds) / len(olds) * 100 and r.py == pytest.approx(
        100 * sum(y is not None for k, _, y in rows if k % 10) / len(olds))
    assert stored.ranks_with(new.limit(0), ["x", "y"]).count() == 0
