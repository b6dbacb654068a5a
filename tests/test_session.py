"""Scratch data lives under the session's checkpoint folder."""

import pytest

from logonlens.session import ensure_checkpoint_dir, scale_conf, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_existing_checkpoint_dir_is_kept(spark, tmp_path):
    before = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == before


def test_scale_conf_grows_with_input():
    small, big = scale_conf(1 << 30), scale_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)   # no cap
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_a_cluster_session_needs_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
