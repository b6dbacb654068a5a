"""End-to-end: raw gzip CSV -> bronze -> silver -> gold, the incremental stream, and the
JDBC load wiring (no database is started: the writer is replaced by a recorder)."""

from collections import Counter

import pytest
from conftest import SF_SMALL

from logonlens.functions.normalize import normalize_auth
from logonlens.operators import merge, silver
from logonlens.plans import medallion
from logonlens.plans.queries import MERGE_CUT, QUERIES, layers
from logonlens.sources.sinks import write_bronze_auth
from logonlens.streaming import incremental


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    ly = layers(spark, SF_SMALL)
    raw_auth, raw_red = str(base / "raw_auth"), str(base / "raw_redteam")
    ly.auth.write.option("compression", "gzip").csv(raw_auth)
    ly.redteam.write.option("compression", "gzip").csv(raw_red)
    root = str(base / "root")
    report = medallion.run_medallion(spark, root, raw_auth, raw_red)
    return root, report


GOLD_VS_QUERY = [
    ("gold", "user_risk", "user_risk"),
    ("gold", "top_users", "top_users"),
    ("gold", "top_computers", "top_computers"),
    ("gold", "dashboard_kpis", "dashboard_kpis"),
    ("gold", "login_timeline", "login_timeline"),
    ("gold", "redteam_summary", "redteam_summary"),
    ("gold", "risk_distribution", "risk_distribution"),
    ("gold", "hourly_activity", "gold_hourly_activity"),
    ("silver", "users_features", "user_features"),
    ("silver", "computers_features", "computer_features"),
    ("silver", "daily_activity", "daily_activity"),
    ("silver", "daily_user_activity", "daily_user_activity"),
    ("silver", "daily_computer_activity", "daily_computer_activity"),
    ("silver", "redteam_users", "redteam_users"),
    ("silver", "redteam_computers", "redteam_computers"),
    ("silver", "daily_redteam_activity", "daily_redteam_activity"),
]


def test_validations(lake):
    _, report = lake
    assert report["validation"]["auth"] == {"rows": 1000}
    assert report["validation"]["redteam"]["rows"] == 8
    assert report["validation"]["redteam"]["users"] == 5


@pytest.mark.parametrize("layer,table,query", GOLD_VS_QUERY, ids=[t for _, t, _ in GOLD_VS_QUERY])
def test_tables_equal_queries(spark, lake, layer, table, query):
    root, _ = lake
    stored = medallion.read_stored(spark, root, layer, table)
    expected = QUERIES[query](spark, SF_SMALL)
    assert stored.dtypes == expected.dtypes
    assert bag(stored) == bag(expected)


def test_direct_scan_run_equals_cube_run(spark, lake, tmp_path):
    root, _ = lake
    other = str(tmp_path / "direct")
    import shutil
    shutil.copytree(medallion.Paths(root).bronze(""), medallion.Paths(other).bronze(""))
    medallion.run_medallion(spark, other, skip_bronze=True, shared_scan=True)
    for table in ("user_risk", "dashboard_kpis", "top_users"):
        a = spark.read.parquet(medallion.Paths(root).gold(table))
        b = spark.read.parquet(medallion.Paths(other).gold(table))
        assert bag(a) == bag(b), table


def test_published_order(spark, lake):
    root, _ = lake
    risk = [r["risk_score"] for r in spark.read.parquet(medallion.Paths(root).gold("user_risk")).collect()]
    assert risk == sorted(risk, reverse=True)
    hourly = [(r["day"], r["hour"]) for r in spark.read.parquet(medallion.Paths(root).gold("hourly_activity")).collect()]
    assert hourly == sorted(hourly)


def test_rerun_from_bronze_is_idempotent(spark, lake):
    root, _ = lake
    path = medallion.Paths(root).gold("dashboard_kpis")
    before = bag(spark.read.parquet(path))
    medallion.run_medallion(spark, root, skip_bronze=True)
    assert bag(spark.read.parquet(path)) == before


def test_bronze_layout(spark, lake):
    root, _ = lake
    bronze = spark.read.parquet(medallion.Paths(root).bronze("auth"))
    assert "day" in bronze.columns
    plan = bronze.where("day = 3").select("timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    # parts are ordered by timestamp (row-group statistics can prune time ranges)
    import glob

    import pyarrow.parquet as pq
    files = glob.glob(medallion.Paths(root).bronze("auth") + "/outcome=accepted/day=*/*.parquet")
    assert files
    for f in files:
        ts = pq.read_table(f, columns=["timestamp"]).column(0).to_pylist()
        assert ts == sorted(ts)


def test_incremental_stream_equals_one_shot(spark, tmp_path):
    ly = layers(spark, SF_SMALL)
    first, second = merge.split_at(ly.auth, MERGE_CUT)
    bronze, state, ckpt = str(tmp_path / "bronze"), str(tmp_path / "state"), str(tmp_path / "ckpt")
    write_bronze_auth(first, bronze, num_partitions=2)
    incremental.start_refresh(spark, bronze, state, ckpt).awaitTermination()
    write_bronze_auth(second, bronze, num_partitions=2, mode="append")
    incremental.start_refresh(spark, bronze, state, ckpt).awaitTermination()
    assert incremental.batches_seen(spark, state).count() == 2
    merged = incremental.merged_cube(spark, state)
    one_shot = bag(silver.activity_cube(normalize_auth(ly.auth)))
    assert bag(merged) == one_shot
    # compaction folds both batches into a snapshot; reads stay exact afterwards
    assert incremental.compact(spark, state) == 1
    assert bag(incremental.merged_cube(spark, state)) == one_shot
    # every silver table follows from the merged cube
    from logonlens.plans.layers import Layers
    assert bag(Layers(ly.auth, ly.redteam, cube=merged).users) == bag(silver.users_dim(ly.norm))


def test_stream_restart_resumes_without_double_counting(spark, tmp_path):
    ly = layers(spark, SF_SMALL)
    first, second = merge.split_at(ly.auth, MERGE_CUT)
    bronze, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    write_bronze_auth(first, bronze, num_partitions=2)
    incremental.start_refresh(spark, bronze, state).awaitTermination()
    incremental.start_refresh(spark, bronze, state).awaitTermination()   # nothing new
    write_bronze_auth(second, bronze, num_partitions=2, mode="append")
    incremental.start_refresh(spark, bronze, state).awaitTermination()
    expected = bag(silver.activity_cube(normalize_auth(ly.auth)))
    assert bag(incremental.merged_cube(spark, state)) == expected
    # a partial whose write never committed (no _SUCCESS) is not read
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    hconf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        silver.activity_cube(normalize_auth(ly.auth)).write.parquet(str(tmp_path / "state" / "partials" / "batch=99"))
    finally:
        hconf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    assert bag(incremental.merged_cube(spark, state)) == expected


def test_load_wiring(spark, lake, monkeypatch):
    root, _ = lake
    calls = []

    class Recorder:
        def __init__(self, name):
            self.name = name

        def save(self):
            calls.append(self.name)

    def fake_writer(df, url, table, properties=None, batch_size=10_000, num_partitions=None):
        assert url == "jdbc:example://db" and properties == {"user": "etl"}
        return Recorder(table)

    monkeypatch.setattr("logonlens.sources.sinks.jdbc_writer", fake_writer)
    report = medallion.run_medallion(spark, root, only_load=True, jdbc_url="jdbc:example://db",
                                     jdbc_properties={"user": "etl"})
    assert calls == list(medallion.GOLD_TABLES) == report["loaded"]


def test_jdbc_writer_options():
    from logonlens.sources.sinks import jdbc_writer

    class Chain:
        def __init__(self):
            self.calls = {}

        def format(self, fmt):
            self.calls["format"] = fmt
            return self

        def mode(self, mode):
            self.calls["mode"] = mode
            return self

        def option(self, key, value):
            self.calls[key] = value
            return self

    class FakeFrame:
        write = Chain()

    writer = jdbc_writer(FakeFrame(), "jdbc:example://db", "t", {"user": "etl"}, num_partitions=4)
    assert writer.calls == {"format": "jdbc", "mode": "overwrite", "url": "jdbc:example://db",
                            "dbtable": "t", "truncate": "true", "batchsize": "10000",
                            "numPartitions": "4", "user": "etl"}


def test_command_line_maps_to_run(monkeypatch, spark):
    import logonlens.__main__ as cli
    seen = {}

    def fake_run(session, root, **kw):
        seen.update(root=root, **kw)
        return {"ok": True}

    monkeypatch.setattr("logonlens.plans.medallion.run_medallion", fake_run)
    assert cli.main(["--root", "/lake", "--skip-bronze", "--jdbc-url", "jdbc:x://h/db",
                     "--jdbc-option", "user=etl", "--direct-scans"]) == 0
    assert seen == {"root": "/lake", "raw_auth": None, "raw_redteam": None, "skip_bronze": True,
                    "only_load": False, "jdbc_url": "jdbc:x://h/db", "jdbc_properties": {"user": "etl"},
                    "shared_scan": False, "pandas_nulls": False}
    assert cli.main(["--root", "/lake", "--cube", "--missing-values"]) == 0
    assert seen["shared_scan"] and seen["pandas_nulls"]


def test_compaction_leaves_a_batch_committed_meanwhile_to_the_next(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    state = str(tmp_path)

    def commit(n):
        spark.createDataFrame([(1, 2, "u", "c", 1, 1, 0, 5, 5)], "day long, hour long, user string, "
                              "destination_computer string, authentications long, success_logins long, "
                              "failed_logins long, first_ts long, last_ts long") \
            .write.parquet(f"{state}/partials/batch={n}")

    commit(0)
    listed = incremental._committed

    def committing(session, parent, key):
        found = listed(session, parent, key)
        if key == "batch" and max(found) == 0:
            commit(1)                     # lands right after the listing
        return found

    monkeypatch.setattr(incremental, "_committed", committing)
    assert incremental.compact(spark, state) == 0
    monkeypatch.undo()
    assert incremental.merged_cube(spark, state).agg(F.sum("authentications")).first()[0] == 2
    assert incremental.compact(spark, state) == 1
    assert incremental.merged_cube(spark, state).agg(F.sum("authentications")).first()[0] == 2


def test_writers_share_few_days_and_one_heavy_day(spark, tmp_path):
    import glob

    from pyspark.sql import functions as F

    raw = spark.range(0, 40_000, numPartitions=2)
    columns = [F.concat(F.lit(f"{c}"), (F.col("id") % 97).cast("string")).alias(c) for c in (
        "source_user", "destination_user", "source_computer", "destination_computer", "auth_type", "logon_type",
        "auth_orientation", "status")]
    for name, heavy in (("even", 2), ("heavy", 10)):      # half of the rows, then 90 %, on day 0
        ts = F.when(F.col("id") % heavy == 0, 86400 + F.col("id")).otherwise(F.col("id")).cast("long").alias("timestamp")
        path = str(tmp_path / name)
        write_bronze_auth(raw.select(ts, *columns), path, num_partitions=100)
        assert spark.read.parquet(path).count() == 40_000
        rows = [r["count"] for r in spark.read.parquet(path).where("day = 0").groupBy(F.input_file_name()).count().collect()]
        assert len(rows) > 50 and max(rows) < 8 * sum(rows) / 100
        writers = {f.rsplit("part-", 1)[1][:5] for f in glob.glob(path + "/day=*/part-*.parquet")}
        assert len(writers) > 50
