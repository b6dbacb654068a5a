"""Bucketed silver tables: no exchange on a stored table, and bridges that grow by new pairs."""

from collections import Counter

import pytest
from conftest import SF_SMALL

from logonlens.functions.normalize import normalize_auth
from logonlens.operators import merge, silver
from logonlens.plans.colocated import Colocated
from logonlens.plans.queries import MERGE_CUT, layers

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def below_exchanges(df):
    """The lines of the plan that stand below an exchange."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    out, depth = [], None
    for line in text.splitlines():
        at = len(line) - len(line.lstrip(" :+-*|"))
        if depth is not None and at <= depth:
            depth = None
        if depth is not None:
            out.append(line)
        elif "Exchange" in line:
            depth = at
    return out, text


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = Colocated(spark, "test_colocated", str(tmp_path_factory.mktemp("colocated")))
    made.store(layers(spark, SF_SMALL))
    yield made
    made.drop()


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("what", ["user_features", "computer_features"])
def test_features_move_no_stored_table(spark, store, no_broadcast, what):
    ly = layers(spark, SF_SMALL)
    df = getattr(store, what)(ly.redteam_events)
    moved, text = below_exchanges(df)
    assert text.count("Bucketed: true") == 3
    assert not any("Bucketed" in line or "test_colocated" in line for line in moved), text
    assert any("Exchange" in line for line in text.splitlines())        # the red-team counts
    want = getattr(ly, what)
    assert df.dtypes == want.dtypes and bag(df) == bag(want)


def test_new_pairs_are_appended_without_moving_the_bridge(spark, tmp_path, no_broadcast):
    ly = layers(spark, SF_SMALL)
    a, b = merge.split_at(ly.auth, MERGE_CUT)
    first, second = (silver.user_computers(normalize_auth(part)) for part in (a, b))
    grow = Colocated(spark, "test_grow", str(tmp_path), buckets=16)
    try:
        grow.write("user_bridge", first, "user")
        grow.write("computer_bridge", first, "computer")
        with grow.partial_keys():
            new = grow.new_pairs(second)
            moved, text = below_exchanges(new)
            assert "Bucketed: true" in text and not any("test_grow" in line for line in moved), text
            assert bag(new) == bag(second.exceptAll(second.intersect(first)))
        for _ in range(2):                       # the second time there is nothing new
            grow.append_pairs(second)
            for bridge in ("user_bridge", "computer_bridge"):
                assert bag(grow.table(bridge).select("user", "computer")) == bag(ly.user_computers)
        per_user = grow.table("user_bridge").groupBy("user").count()
        moved, text = below_exchanges(per_user)
        assert not moved and "Exchange" not in text
    finally:
        grow.drop()
