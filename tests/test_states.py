"""Sketches, moment states and thresholded top-k against plain Python."""

import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logonlens.operators import moments, sketches, topk

# ------------------------------------------------------------------ quantile sketches

QS = {"p10": 0.1, "p50": 0.5, "p99": 0.99}


def test_merged_quantile_sketches_keep_their_rank_error(spark):
    """Many days of uneven sizes, ties and NULLs; every estimate is within the promised rank."""
    n = 60_000
    df = spark.range(0, n).select(
        (F.sqrt("id").cast("long") % 20).alias("day"), (F.lit("a")).alias("all"),
        F.when(F.col("id") % 11 > 0, F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 7919) % 100_003)).alias("x"))
    by_day = sketches.quantile_sketches(df, ["x"], ["day", "all"])
    merged = sketches.merge_quantile_sketches(by_day, ["x"], ["all"])
    est = merged.select("all", *[c.alias(q) for q, c in sketches.sketch_quantiles(merged, "x", QS).items()])
    assert sketches.ranks_hold(df, est, "x", QS, ["all"]).first().asDict() == {"all": "a"} | {f"{q}_within": True for q in QS}
    wrong = est.withColumn("p50", F.col("p50") + 20_000)
    got = sketches.ranks_hold(df, wrong, "x", QS, ["all"]).first()
    assert not got.p50_within and got.p10_within
    assert by_day.count() == 20 and merged.select(F.kll_sketch_get_n_bigint("x")).first()[0] == df.where("x IS NOT NULL").count()


def test_sketches_of_no_rows(spark):
    none = spark.createDataFrame([], "day long, x long, user string")
    assert sketches.quantile_sketches(none, ["x"], ["day"]).count() == 0
    assert sketches.set_sketches(none, {"users": "user"}, ["day"]).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, "a")], "day long, user string")
    got = {r.day: r.n for r in sketches.set_sketches(nulls, {"u": "user"}, ["day"]).select("day", sketches.estimate("u").alias("n")).collect()}
    assert got == {1: 0, 2: 1}


# ------------------------------------------------------------------ set sketches

def test_set_questions(spark):
    """Small sets exactly, large ones within the error, by union, intersection and difference."""
    for size, exact in ((1000, True), (200_000, False)):
        df = spark.range(0, size * 4).select((F.col("id") % 4).alias("day"), F.when(
            F.col("id") % 2 == 0, (F.col("id") % size).cast("string")).otherwise(F.concat(F.lit("d"), F.col("id").cast("string"))).alias("user"))
        days = defaultdict(set)
        for r in df.groupBy("day").agg(F.collect_set("user").alias("u")).collect():
            days[r.day] = set(r.u)
        by_day = sketches.set_sketches(df, {"users": "user"}, ["day"])
        before = {r.day: (r.new, r.n) for r in sketches.before_each_day(by_day, "users").select(
            "day", sketches.only_in_first("users", "before").alias("new"), sketches.estimate("users").alias("n")).collect()}
        pair = by_day.where("day = 0").select(F.col("users").alias("a")).crossJoin(by_day.where("day = 2").select(F.col("users").alias("b"))) \
            .select(sketches.in_both("a", "b")).first()[0]
        seen = set()
        for day in sorted(days):
            union = len(seen | days[day])
            for got, want in ((before[day][0], len(days[day] - seen)), (before[day][1], len(days[day]))):
                assert abs(got - want) <= (0 if exact else sketches.theta_error() * union), (size, day)
            seen |= days[day]
        assert abs(pair - len(days[0] & days[2])) <= (0 if exact else sketches.theta_error() * len(days[0] | days[2]))
        all_of = sketches.merge_set_sketches(by_day, ["users"], []).select(sketches.estimate("users")).first()[0]
        assert abs(all_of - len(seen)) <= (0 if exact else sketches.theta_error() * len(seen))


# ------------------------------------------------------------------ moments

def rows_of(seed, offset=0):
    rng = random.Random(seed)
    out = []
    for day in range(12):
        for _ in range(1 if day == 3 else 40):
            x = rng.randint(0, 9)
            out.append((day, x + offset, None if rng.random() < 0.1 else 2 * x + rng.randint(0, 5) + offset, 5 + offset))
    return out


@pytest.mark.parametrize("offset", [0, 10 ** 9, -(10 ** 9)])
def test_merged_states_equal_one_pass_over_small_values(spark, offset):
    """The result does not depend on how far from zero the values lie."""
    rows = rows_of(1)
    df = spark.createDataFrame([(d, x + offset, None if y is None else y + offset, c + offset) for d, x, y, c in rows],
                               "day long, x long, y long, c long").repartition(5)
    by_day = moments.moment_states(df, ["x", "y", "c"], ["day"])
    merged = moments.merge_states(by_day)
    got = {(r.col_a, r.col_b): (r.n, r.corr) for r in moments.correlations(merged).collect()}
    pairs = [(x, y) for _, x, y, _ in rows if y is not None]
    want = statistics.correlation([x for x, _ in pairs], [y for _, y in pairs])
    assert got["x", "y"] == got["y", "x"] == (len(pairs), pytest.approx(want, abs=1e-6))
    assert got["x", "x"] == (len(rows), 1.0) and got["c", "c"] == (len(rows), None) and got["x", "c"][1] is None
    some = {r.column: r for r in moments.mean_and_deviation(merged).collect()}
    assert some["x"].mean - offset == pytest.approx(statistics.mean(x for _, x, _, _ in rows), abs=1e-3)
    assert some["x"].std == pytest.approx(statistics.stdev(x for _, x, _, _ in rows), abs=2e-6)
    # any range of days, and one merged from parts that were merged before
    halves = moments.merge_states(by_day.withColumn("half", F.col("day") % 2), ["half"])
    again = {(r.col_a, r.col_b): r.n for r in moments.correlations(moments.merge_states(halves)).collect()}
    assert again == {k: n for k, (n, _) in got.items()}


def test_a_column_that_does_not_vary_has_no_correlation(spark):
    df = spark.range(0, 1000).select((F.col("id") % 9).alias("day"), (F.lit(10 ** 12) + 1).alias("c"), F.lit(0.1).alias("d"), "id")
    merged = moments.merge_states(moments.moment_states(df, ["c", "d", "id"], ["day"]))
    assert {r.corr for r in moments.correlations(merged).collect() if (r.col_a, r.col_b) != ("id", "id")} == {None}
    assert {r.column: r.std for r in moments.mean_and_deviation(merged).collect()} == {
        "c": 0.0, "d": 0.0, "id": pytest.approx(statistics.stdev(range(1000)), abs=1e-6)}


def test_states_without_complete_rows(spark):
    df = spark.createDataFrame([(1, 1, None), (2, None, 2), (3, 4, 5)], "day long, x long, y long")
    got = {(r.col_a, r.col_b): (r.n, r.corr) for r in moments.correlations(moments.merge_states(
        moments.moment_states(df, ["x", "y"], ["day"]))).collect()}
    assert got == {("x", "y"): (1, None), ("y", "x"): (1, None), ("x", "x"): (2, 1.0), ("y", "y"): (2, 1.0)}
    assert moments.moment_states(df.limit(0), ["x", "y"], ["day"]).count() == 0


# ------------------------------------------------------------------ top-k

def plain_top(rows, k):
    total = Counter()
    for _, key, value in rows:
        total[key] += value or 0
    return sorted(total.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]


def zipf_rows(days=15, users=3000):
    rng = random.Random(3)
    return [(d, f"u{i:05}", max(1, int(2000 / (i + 1) * rng.uniform(0.7, 1.3)))) for d in range(days) for i in range(users)
            if i < 50 or rng.random() < 0.5]


def test_top_by_thresholds_reads_little_and_equals_the_full_sum(spark):
    rows = zipf_rows()
    fact = spark.createDataFrame(rows, "day long, user string, n long")
    got = topk.threshold_top_k(fact, "user", "n", 20)
    assert [(r.user, r.total) for r in got.result.collect()] == plain_top(rows, 20)
    fetched = got.first.count() + got.second.count() + got.third.count()
    assert 0 < fetched < 0.1 * len(rows), fetched
    assert got.threshold > 0 and got.second.agg(F.min("__value")).first()[0] >= got.threshold


@pytest.mark.parametrize("k", [1, 3, 5, 50])
def test_top_with_planted_ties_nulls_and_days_that_miss_entities(spark, k):
    rows = [(d, key, v) for d in range(6) for key, v in (("tie_b", 10), ("tie_a", 10), ("often", 9))]
    rows += [(0, "once", 60), (1, "tie_c", 60), (2, "zero", 0), (3, "none", None), (4, None, 60), (5, "small", 1)]
    fact = spark.createDataFrame(rows, "day long, user string, n long")
    got = topk.threshold_top_k(fact, "user", "n", k).result.collect()
    assert [(r.user, r.total) for r in got] == plain_top(rows, k)


def test_top_of_an_empty_fact_and_of_random_facts(spark):
    fact = spark.createDataFrame([], "day long, user string, n long")
    assert topk.threshold_top_k(fact, "user", "n", 5).result.count() == 0
    rng = random.Random(9)
    for _ in range(6):
        rows = [(d, f"u{u}", rng.choice([0, 1, 1, 2, 5, 40])) for d in range(rng.randint(1, 7)) for u in range(rng.randint(1, 40))
                if rng.random() < 0.7]
        k = rng.randint(1, 12)
        got = topk.threshold_top_k(spark.createDataFrame(rows, "day long, user string, n long"), "user", "n", k).result.collect()
        assert [(r.user, r.total) for r in got] == plain_top(rows, k)


def test_the_threshold_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.createDataFrame(zipf_rows(4, 200), "day long, user string, n long").write.parquet(path)
    got = topk.threshold_top_k(spark.read.parquet(path), "user", "n", 10)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = got.second._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n," in plan
