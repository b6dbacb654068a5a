"""Skew: one value holding most rows must not change results when the score join runs
as a sort-merge join that AQE splits (thresholds lowered so it triggers on test data)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from logonlens.functions import scoring
from logonlens.operators import silver

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}

NO_ADAPTIVE = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rank_exact_with_hot_value(spark):
    # 70% of rows share x = 0 (the "no red-team events" case), the rest spread out
    df = spark.range(0, 6000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 97).alias("x"))
    w = Window.orderBy("x")
    ref = df.select("k", ((F.rank().over(w) + (F.count("*").over(Window.partitionBy("x")) - 1) / 2 - 1)
                          / (F.count("*").over(Window.partitionBy()) - 1) * 100).alias("p"))
    want = {r["k"]: r["p"] for r in ref.collect()}
    for conf in (SKEW_CONF, NO_ADAPTIVE):
        assert with_conf(spark, conf, lambda: {r["k"]: r["p"] for r in scoring.percentile_scores(
            df, {"p": "x"}, key="k", buckets=8).collect()}) == want


def test_score_join_is_even_without_adaptive_planning(spark):
    """A value of 90 % of the rows, NULLs in a third of them, and values that few rows share: no
    task of the shuffled join gets over twice the median rows."""
    df = spark.range(0, 60_000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 9973).alias("x"),
        F.when(F.col("id") % 3 > 0, F.col("id") * 7919 % 60_013).alias("y"))

    def run():
        ranks = scoring.value_ranks(df, ["x", "y"])
        joined = scoring.scored_inputs(df, ["x", "y"], ["k"], ranks)
        rows = joined.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        return sorted(r["count"] for r in rows), plan

    counts, plan = with_conf(spark, NO_ADAPTIVE, run)
    assert sum(counts) == 120_000 and len(counts) == 8
    assert counts[-1] <= 2 * counts[len(counts) // 2], counts
    assert "skew=true" not in plan and "SortMergeJoin" in plan and "SinglePartition" not in plan


def test_hot_user_collapses_before_shuffle(spark):
    # a third of all rows belong to one user: partial aggregation folds them map-side
    n = 9000
    auth = spark.range(0, n).select(
        F.col("id").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "UHOT@D").otherwise(F.concat(F.lit("U"), (F.col("id") % 500).cast("string"), F.lit("@D"))).alias("user"),
        F.lit("Success").alias("status"), F.lit(0).cast("bigint").alias("day"))
    users = auth.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    plan = users._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    hot = users.where("user = 'UHOT@D'").first()["n"]
    assert hot == n // 3 + (1 if n % 3 else 0)
    assert silver.users_dim(auth).count() == users.count()
