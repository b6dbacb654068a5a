"""Plan shape: pushdown and pruning reach the parquet scan, no Python in any plan,
top-k is a bounded TakeOrderedAndProject, and no rank funnels rows into one task."""

import re

import pytest
from conftest import SF_SMALL

from logonlens.functions.normalize import normalize_auth
from logonlens.operators import silver
from logonlens.plans.layers import Layers
from logonlens.plans.queries import QUERIES, layers
from logonlens.sources.sinks import write_bronze_auth

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "auth")
    write_bronze_auth(layers(spark, SF_SMALL).auth, path, num_partitions=2)
    return path


@pytest.fixture(scope="module")
def bronze(spark, bronze_dir):
    return spark.read.parquet(bronze_dir).drop("day")


def test_day_filter_prunes_bronze_partitions(spark, bronze_dir):
    parts = spark.read.parquet(bronze_dir)
    daily = silver.daily_user_activity(normalize_auth(parts).where("day BETWEEN 3 AND 5"))
    text = plan(daily)
    assert re.search(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ >= 3\)", text)
    direct = silver.daily_user_activity(normalize_auth(parts.drop("day"))).where("day BETWEEN 3 AND 5")
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, direct.collect()))


@pytest.mark.parametrize("name", [n for n in QUERIES if "roundtrip" not in n])
def test_no_python_in_plans(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES)


def test_person_filter_and_pruning_reach_the_scan(bronze):
    text = plan(silver.users_dim(normalize_auth(bronze)))
    assert "StringStartsWith(source_user,U)" in text
    read_schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert set(read_schema.removeprefix("struct<").rstrip(">").split(",")) == {
        "timestamp:bigint", "source_user:string", "status:string"}


def test_computer_filter_reaches_the_scan(bronze):
    text = plan(silver.daily_computer_activity(normalize_auth(bronze)))
    assert "StringStartsWith(destination_computer,C)" in text


def test_partial_aggregation_before_shuffle(bronze):
    text = plan(silver.users_dim(normalize_auth(bronze)))
    assert "partial_count" in text


@pytest.mark.parametrize("name", ["top_users", "top_computers", "top20_total_logins"])
def test_topk_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["user_risk", "percentile_scores", "user_describe"])
def test_ranks_never_use_one_partition(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "SinglePartition" not in text
    for line in text.splitlines():
        if line.strip().startswith(("+- Window ", "Window ")) or " Window [" in line:
            assert "], [], [" not in line, line


def test_rollups_of_a_written_cube_never_read_the_log(spark, bronze, tmp_path):
    path = str(tmp_path / "cube")
    silver.activity_cube(normalize_auth(bronze)).write.parquet(path)
    ly = Layers(bronze, layers(spark, SF_SMALL).redteam, cube=spark.read.parquet(path))
    for table in (ly.users, ly.computers, ly.user_computers, ly.daily_user_activity, ly.hourly_activity):
        files = table.inputFiles()
        assert files and all(path in f for f in files)


@pytest.mark.parametrize("aqe", ["true", "false"])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_equal_the_window_form_whatever_the_settings(spark, aqe, broadcast, reuse):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from logonlens.functions import scoring

    settings = {"spark.sql.adaptive.enabled": aqe, "spark.sql.autoBroadcastJoinThreshold": broadcast,
                "spark.sql.exchange.reuse": reuse}
    before = {k: spark.conf.get(k) for k in settings}
    df = spark.range(0, 3000, numPartitions=7).select(
        F.col("id").alias("k"), F.when(F.col("id") % 50 != 3, F.col("id") * 31 % 613).alias("x"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ranks = scoring.value_ranks(df, ["x"], buckets=8)
        got = {(r["value"], r["c"], r["below"]) for r in ranks.collect() if r["value"] is not None}
        want = df.where("x is not null").groupBy("x").count().withColumn(
            "below", F.sum("count").over(Window.orderBy("x")) - F.col("count"))
        assert got == {(float(r["x"]), r["count"], r["below"]) for r in want.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rank_exact_without_exchange_reuse(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from logonlens.functions import scoring

    df = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 31 % 613).alias("x"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["k"]: r["p"] for r in scoring.percentile_scores(df, {"p": "x"}, key="k", buckets=8).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    w = Window.orderBy("x")
    ref = df.select("k", ((F.rank().over(w) + (F.count("*").over(Window.partitionBy("x")) - 1) / 2 - 1)
                          / (F.count("*").over(Window.partitionBy()) - 1) * 100).alias("p"))
    assert got == {r["k"]: r["p"] for r in ref.collect()}


def test_user_risk_is_written_without_a_range_shuffle(spark, tmp_path, monkeypatch):
    """Its parts are ordered inside; facts by day are dealt by day."""
    from pyspark.sql import DataFrameWriter

    from logonlens.plans import medallion

    plans = {}
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        plans.update({path.rsplit("/", 1)[1]: plan(self._df)}), write(self, path, *a, **k))[1])
    ly = layers(spark, SF_SMALL)
    ly.auth.write.csv(str(tmp_path / "raw"))
    ly.redteam.write.csv(str(tmp_path / "red"))
    medallion.run_medallion(spark, str(tmp_path / "lake"), str(tmp_path / "raw"), str(tmp_path / "red"))
    for name in ("user_risk", "daily_user_activity", "daily_computer_activity", "redteam_events"):
        assert "rangepartitioning" not in plans[name] and "Sort [" in plans[name], name
    assert "rangepartitioning" in plans["hourly_activity"]
    days = [p.name for p in (tmp_path / "lake" / "silver" / "daily_user_activity").iterdir() if p.name.startswith("day=")]
    assert len(days) == ly.daily_activity.count()
