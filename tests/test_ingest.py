"""Ingest of raw logs with malformed lines, and the layout of the files it writes."""

import glob
import gzip
import os
from collections import Counter

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException  # noqa: F401

from logonlens.plans import medallion
from logonlens.plans.queries import layers, spoilt_auth_lines
from logonlens.sources.readers import read_auth_csv, read_bronze, read_checked, read_rejects
from logonlens.sources.schemas import AUTH
from logonlens.sources.sinks import write_bronze_auth, write_checked_auth

GOOD = ["1,U1@D,U1@D,C1,C2,Kerberos,Network,LogOn,Success", "86400,U2@D,,C1,,,,,Failure", ",U3@D,U3@D,C1,C2,K,N,L,Success"]
BAD = {"2,U1@D,U1@D,C1,C2,Kerberos,Network,LogOn": "fields", "3,U1@D,U1@D,C1,C2,K,N,L,Success,more": "fields",
       "4.5,U1@D,U1@D,C1,C2,K,N,L,Success": "value", "x,U1@D,U1@D,C1,C2,K,N,L,Success": "value", "garbage": "fields",
       "99999999999999999999,U1@D,U1@D,C1,C2,K,N,L,Success": "value"}


@pytest.fixture
def raw(tmp_path):
    path = tmp_path / "raw"
    path.mkdir()
    for k, lines in enumerate((GOOD + list(BAD)[:3], ["", *list(BAD)[3:], GOOD[0]], [])):
        with gzip.open(path / f"auth{k}.txt.gz", "wt") as f:
            f.write("".join(x + "\n" for x in lines))
    return str(path)


def test_bad_lines_are_kept_apart_and_counted(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    counts = medallion.ingest_checked_auth(spark, raw, bronze)
    assert counts == {"lines": 10, "accepted": 4, "rejected": 6, "first_second": 1, "last_second": 86400}
    assert {r.bad_line: r.reason for r in read_rejects(spark, bronze).collect()} == BAD
    assert all(r.source_file.endswith(".txt.gz") for r in read_rejects(spark, bronze).collect())
    got = read_bronze(spark, bronze)
    assert Counter(map(tuple, got.select(*AUTH.names).collect())) == Counter(
        tuple((int(x) if k == 0 else x) if x else None for k, x in enumerate(line.split(","))) for line in [*GOOD, GOOD[0]])
    assert got.where("timestamp = 86400").first().day == 1
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        read_auth_csv(spark, raw).collect()


def test_only_bad_only_good_and_no_lines(spark, tmp_path):
    for name, lines, want in (("bad", list(BAD), (6, 0, 6)), ("good", GOOD, (3, 3, 0)), ("none", [], (0, 0, 0))):
        path = tmp_path / f"{name}.txt"
        path.write_text("".join(x + "\n" for x in lines))
        bronze = str(tmp_path / f"bronze-{name}")
        counts = medallion.ingest_checked_auth(spark, str(path), bronze)
        assert (counts["lines"], counts["accepted"], counts["rejected"]) == want
        if lines:
            assert read_bronze(spark, bronze).count() == want[1] and read_rejects(spark, bronze).count() == want[2]


def test_missing_values_are_read_as_asked(spark, tmp_path):
    path = tmp_path / "auth.txt"
    path.write_text("1,NaN,U1@D,C1,C2,K,N,L,null\n1,NaN\n")
    rows = read_checked(spark, str(path), AUTH, pandas_nulls=True).collect()
    assert [(r.source_user, r.status, r.outcome) for r in rows] == [(None, None, "accepted"), (None, None, "rejected")]


def test_one_job_reads_the_raw_log_once(spark, raw, tmp_path, monkeypatch):
    """Accepted lines, rejects and counts come from one write, and its plan has one scan."""
    plans = []
    from pyspark.sql import DataFrameWriter

    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        plans.append(self._df._jdf.queryExecution().toString()), write(self, path, *a, **k))[1])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-pass", "ingest")
    try:
        medallion.ingest_checked_auth(spark, raw, str(tmp_path / "bronze"))
        stages = [s for j in tracker.getJobIdsForGroup("one-pass") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(plans) == 1 and plans[0].split("== Physical Plan ==")[1].count("FileScan csv") == 1
    read = [tracker.getStageInfo(s) for s in set(stages)]
    # the scan's tasks ran once: three files, two shuffles behind them
    assert sum(x.numCompletedTasks for x in read if x) > 0
    assert len({x.name for x in read if x}) <= 3


def test_full_run_over_a_spoilt_log(spark, tmp_path):
    ly = layers(spark, SF_SMALL)
    raw, raw_red = str(tmp_path / "raw"), str(tmp_path / "red")
    spoilt_auth_lines(ly.auth).write.option("compression", "gzip").text(raw)
    ly.redteam.write.csv(raw_red)
    report = medallion.run_medallion(spark, str(tmp_path / "lake"), raw, raw_red)
    bad = ly.auth.where("timestamp % 97 IN (5, 6, 7)").count()
    assert bad > 0 and report["ingest"]["auth"]["rejected"] == bad
    assert report["ingest"]["auth"]["lines"] == ly.auth.count() == bad + report["validation"]["auth"]["rows"]
    assert report["ingest"]["redteam"] == {"lines": ly.redteam.count(), "accepted": ly.redteam.count(), "rejected": 0}
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        medallion.run_medallion(spark, str(tmp_path / "strict"), raw, raw_red, on_bad_lines="fail")


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.mark.parametrize(("days", "heavy"), [(58, 0), (58, 90), (3, 0)])
def test_files_are_few_and_days_are_shared(spark, tmp_path, days, heavy):
    """A file a day and one for each full partition; a day that holds most rows is split."""
    target = 1_000_000
    n = 60_000
    columns = [F.sha2(F.concat(F.col("id").cast("string"), F.lit(c)), 256).alias(c) for c in AUTH.names[1:]]
    day = F.when(F.col("id") % 100 < heavy, 7).otherwise(F.col("id") % days)
    log = spark.range(0, n, numPartitions=2).select((day * 86400 + F.col("id") % 86400).cast("long").alias("timestamp"), *columns)
    before = {k: spark.conf.get(k, None) for k in (ADVISORY,)}
    try:
        spark.conf.set(ADVISORY, str(target))
        write_bronze_auth(log, str(tmp_path / "plain"), source_bytes=16 << 28)      # 16 writers
        counts = write_checked_auth(log.select("*", *[F.lit(None).cast("string").alias(c) for c in ("bad_line", "reason", "source_file")],
                                               F.lit("accepted").alias("outcome")), str(tmp_path / "checked"), source_bytes=16 << 28)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert counts["accepted"] == n
    for name, pattern in (("plain", "day=*"), ("checked", "outcome=accepted/day=*")):
        files = glob.glob(str(tmp_path / name / pattern / "*.parquet"))
        size = sum(map(os.path.getsize, files))
        assert len(files) <= 2 * size / target + days + 1, (name, len(files), size)
        assert read_bronze(spark, str(tmp_path / name)).count() == n
        if heavy:
            own = [os.path.getsize(f) for f in files if "day=7/" in f]
            assert len(own) >= 0.4 * sum(own) / target and max(own) < 4 * target
