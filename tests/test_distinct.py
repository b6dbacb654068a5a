"""Distinct counts from stored bitmaps against sets in plain Python."""

from collections import defaultdict

import pytest

from logonlens.operators import distinct

COLS = {"users": "user", "hosts": "host"}
ROWS = [(1, "a", "x"), (1, "a", None), (1, None, "y"), (2, "b", "x"), (2, "a", "x"), (4, None, None), (4, "c", "z"), (9, "é", "")] \
    + [(5, f"u{i}", f"h{i % 7}") for i in range(500)] + [(6, f"u{i}", "h1") for i in range(400, 900)]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(ROWS, "day long, user string, host string").repartition(5)


def sets(rows):
    out = defaultdict(lambda: (set(), set()))
    for day, user, host in rows:
        out[day][0].add(user)
        out[day][1].add(host)
    return out


def test_ids_are_dense_and_stay_when_values_come_later(spark, log):
    first = distinct.value_ids(log.where("day < 5"), COLS)
    new = distinct.extend_ids(first, log, COLS)
    ids = first.unionByName(new).collect()
    for k, metric in enumerate(COLS):
        values = {r[1 + k] for r in ROWS}
        own = {r.value: r.id for r in ids if r.metric == metric}
        assert set(own) == values and sorted(own.values()) == list(range(1, len(values) + 1))
    assert max(r.id for r in first.where("metric = 'users'").collect()) == 4
    assert distinct.extend_ids(first.unionByName(new), log, COLS).count() == 0
    # a metric that the stored ids do not have yet starts at 1
    assert distinct.extend_ids(first, log.where("day = 9"), {"day": "day"}).first().id == 1


def test_counts_of_days_ranges_and_all(log):
    ids = distinct.value_ids(log, COLS)
    by_day = distinct.group_bitmaps(log, ids, COLS, ["day"])
    want = sets(ROWS)
    got = {r.day: (r.users, r.hosts) for r in distinct.distinct_counts(by_day, ["day"], list(COLS)).collect()}
    assert got == {d: (len(u), len(h)) for d, (u, h) in want.items()}
    for first, last in ((1, 4), (2, 6), (5, 9), (7, 8)):
        some = distinct.merge_bitmaps(by_day.where(f"day BETWEEN {first} AND {last}"), [])
        r = distinct.distinct_counts(some, [], list(COLS)).first()
        days = [d for d in want if first <= d <= last]
        assert (r.users, r.hosts) == tuple(len(set().union(*(want[d][k] for d in days))) for k in (0, 1))
    rolled = {r.last_day: (r.users, r.hosts) for r in distinct.rolling_distinct(by_day, 3, list(COLS)).collect()}
    assert rolled == {d: tuple(len(set().union(*(want[e][k] for e in want if d - 2 <= e <= d))) for k in (0, 1)) for d in want}


def test_more_ids_than_a_bitmap_holds(spark):
    log = spark.range(0, 100_000).selectExpr("id % 3 AS day", "CAST(id % 70000 AS string) AS user", "CAST(NULL AS string) AS host")
    ids = distinct.value_ids(log, COLS)
    by_day = distinct.group_bitmaps(log, ids, COLS, ["day"])
    assert by_day.select("bucket").distinct().count() == 3
    r = distinct.distinct_counts(distinct.merge_bitmaps(by_day, []), [], list(COLS)).first()
    assert (r.users, r.hosts) == (70_000, 1)


def test_an_empty_log(log):
    none = log.limit(0)
    ids = distinct.value_ids(none, COLS)
    assert ids.count() == 0 and distinct.group_bitmaps(none, ids, COLS, ["day"]).count() == 0


def test_every_shuffle_is_behind_a_fold(log):
    """Values of a group are made distinct in the map tasks, before the join with the ids."""
    plan = distinct.group_bitmaps(log, distinct.value_ids(log, COLS), COLS, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
