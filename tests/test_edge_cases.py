"""Semantics the driver data never exercises: NULL keys, one-row frames, negative
seconds, unknown labels, pandas NULL spellings."""

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logonlens.functions import scoring
from logonlens.functions.metrics import n_unique
from logonlens.functions.normalize import day_of, hour_of
from logonlens.operators import silver
from logonlens.sources.readers import read_auth_csv


def test_endpoint_counts_equal_full_outer_join_with_nulls(spark):
    ev = spark.createDataFrame(
        [("a", "b"), ("a", None), (None, "a"), (None, None), ("c", "c")],
        "source_computer string, destination_computer string")
    got = Counter(tuple(r) for r in silver.redteam_computers(ev).collect())
    s = ev.groupBy(F.col("source_computer").alias("computer")).agg(F.count("*").alias("source_events"))
    t = ev.groupBy(F.col("destination_computer").alias("computer")).agg(F.count("*").alias("target_events"))
    want = Counter(tuple(r) for r in s.join(t, "computer", "full").fillna(0).collect())
    assert got == want
    assert (None, 2, 0) in got and (None, 0, 2) in got


def test_n_unique_counts_null_once(spark):
    df = spark.createDataFrame([("x",), (None,), (None,), ("y",)], "v string")
    assert df.agg(n_unique("v").alias("n")).first()["n"] == 3


def test_percentile_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None)], "k int, x int")
    got = {r["k"]: r["p"] for r in scoring.percentile_scores(df, {"p": "x"}, key="k").collect()}
    # n = 4 rows including the NULL; ties at 10 share rank 1.5
    assert got == {1: pytest.approx(50 / 3), 2: pytest.approx(50 / 3), 3: pytest.approx(200 / 3), 4: None}


def test_percentile_single_row_is_null(spark):
    df = spark.createDataFrame([(1, 5)], "k int, x int")
    row = scoring.percentile_scores(df, {"p": "x"}, key="k").first()
    assert row["p"] is None
    assert spark.range(1).select(scoring.risk_level(F.lit(None).cast("double")).alias("l")).first()["l"] == "Low"


def test_ranks_with_many_buckets_equal_window(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 997 % 250).alias("x"))
    got = {r["k"]: r["p"] for r in scoring.percentile_scores(df, {"p": "x"}, key="k", buckets=16).collect()}
    from pyspark.sql import Window
    w = Window.orderBy("x")
    ref = df.select("k", ((F.rank().over(w) + (F.count("*").over(Window.partitionBy("x")) - 1) / 2 - 1)
                          / (F.count("*").over(Window.partitionBy()) - 1) * 100).alias("p"))
    assert got == {r["k"]: pytest.approx(r["p"], abs=0) for r in ref.collect()}


def test_floor_day_and_hour_below_zero(spark):
    rows = spark.createDataFrame([(-1,), (0,), (86399,), (86400,), (-86401,)], "timestamp long").select(
        day_of("timestamp").alias("d"), hour_of("timestamp").alias("h")).collect()
    assert [(r["d"], r["h"]) for r in rows] == [(-1, 23), (0, 0), (0, 23), (1, 0), (-2, 23)]


def test_unknown_band_fails(spark):
    df = spark.createDataFrame([("Severe",)], "risk_level string")
    with pytest.raises(PySparkException):
        df.select(scoring.band_ordinal()).collect()


def test_pandas_null_spellings(spark, tmp_path):
    path = tmp_path / "auth.csv"
    path.write_text("5,U1@D,NA,C1,N/A,Kerberos,Network,LogOn,Success\n")
    keep = read_auth_csv(spark, str(path)).first()
    assert keep["destination_user"] == "NA"
    nulls = read_auth_csv(spark, str(path), pandas_nulls=True).first()
    assert nulls["destination_user"] is None and nulls["destination_computer"] is None
    assert nulls["timestamp"] == 5


def test_describe_approximate_close_to_exact(spark):
    from logonlens.operators.profile import describe
    df = spark.range(0, 5000).select((F.col("id") % 1000).alias("x"), (F.col("id") % 7).alias("y"))
    exact = {r["column"]: r for r in describe(df, ["x", "y"]).collect()}
    approx = {r["column"]: r for r in describe(df, ["x", "y"], approximate=True).collect()}
    for c in ("x", "y"):
        for k in ("count", "null_count", "mean", "std", "min", "max"):
            assert exact[c][k] == approx[c][k]
        for k in ("p25", "p50", "p75"):
            assert abs(exact[c][k] - approx[c][k]) <= 2


def test_one_row_results_on_empty_inputs(spark):
    from logonlens.operators import gold
    from logonlens.sources.schemas import COMPUTER_FEATURES, HOURLY_ACTIVITY, USER_FEATURES, USER_RISK

    users = spark.createDataFrame([], USER_FEATURES)
    hourly = spark.createDataFrame([], HOURLY_ACTIVITY)
    risk = spark.createDataFrame([], USER_RISK)
    k = gold.dashboard_kpis(users, hourly, risk).collect()
    assert [r.asDict() for r in k] == [{
        "total_users": 0, "suspicious_users": 0, "average_risk": None, "authentication_failure_rate": 0.0,
        "after_hours_logins": 0, "critical_users": 0, "high_users": 0, "medium_users": 0, "low_users": 0}]
    s = gold.redteam_summary(users, spark.createDataFrame([], COMPUTER_FEATURES)).collect()
    assert [tuple(r) for r in s] == [(0, 0, 0, 0)]
    assert gold.user_risk(users).count() == 0


def test_describe_covers_every_type(spark):
    from logonlens.operators.profile import describe

    df = spark.createDataFrame([("b", True, 1, None, 1.5), ("é", None, 2, None, None), (None, False, 3, None, 2.5), ("a", True, None, None, 0.0)],
                               "t string, f boolean, n int, none string, x double")
    rows = {r["column"]: r for r in describe(df).collect()}
    assert set(rows) == {"t", "f", "n", "none", "x"}
    assert tuple(rows["t"]) == ("t", 3, 1, None, None, None, None, None, None, None, "a", "é")
    assert tuple(rows["f"]) == ("f", 3, 1, 0.666667, None, 0.0, None, None, None, 1.0, None, None)
    assert tuple(rows["none"]) == ("none", 0, 4, None, None, None, None, None, None, None, None, None)
    assert tuple(rows["n"])[:3] == ("n", 3, 1) and rows["n"]["p50"] == 2.0 and rows["n"]["min_text"] is None
    for some in (["t"], ["f"], ["t", "f"], ["n", "t"]):
        assert {r["column"]: tuple(r) for r in describe(df, some).collect()} == {c: tuple(rows[c]) for c in some}
    near = {r["column"]: r for r in describe(df, approximate=True).collect()}
    assert {c: near[c]["count"] for c in near} == {c: rows[c]["count"] for c in rows} and near["f"]["p50"] is None
    by = {(r["f"], r["column"]): r for r in describe(df, group_cols=["f"]).collect()}
    assert set(by) == {(f, c) for f in (True, False, None) for c in ("t", "n", "none", "x")}
    assert by[None, "t"]["min_text"] == "é" and by[True, "t"]["max_text"] == "b"
    with pytest.raises(ValueError, match="no column"):
        describe(df.select(F.array("n").alias("list")))
