"""Micro fixture (FIXTURES.md §3): 11 auth rows and 4 red-team rows covering hour
boundaries, domainless and double-@ users, machine / anonymous accounts, a non-computer
and a NULL target, an unknown status, and red-team entities absent from auth."""

import pytest

from logonlens.operators import gold, silver
from logonlens.plans.layers import Layers
from logonlens.sources.schemas import AUTH, REDTEAM

AUTH_ROWS = [
    (1, "U1@D1", "C1", "C10", "Success"),
    (2, "U1@D1", "C1", "C10", "Failure"),
    (28800, "U1@D1", "C1", "C11", "Success"),
    (64799, "U2@D1", "C2", "C10", "Success"),
    (64800, "U2@D1", "C2", "TGT", "Success"),
    (86399, "U3@D2", "C3", "C12", "?"),
    (86400, "U1@D1", "C1", "C10", "Success"),
    (86401, "C5$@D1", "C5", "C10", "Success"),
    (90000, "ANONYMOUS LOGON@C9", "C9", "C10", "Failure"),
    (172800, "U4", "C4", "C11", "Failure"),
    (172801, "U2@X@D3", "C2", None, "Success"),
]
REDTEAM_ROWS = [
    (2, "U1@D1", "C99", "C10"),
    (86400, "U1@D1", "C99", "C11"),
    (100000, "U77@D1", "C10", "C98"),
    (28800, "U2@D1", "C99", "C10"),
]


@pytest.fixture(scope="module", params=[False, True], ids=["direct", "shared_scan"])
def ly(spark, request):
    auth = spark.createDataFrame(
        [(ts, su, "U0@D0", sc, dc, "Kerberos", "Network", "LogOn", st) for ts, su, sc, dc, st in AUTH_ROWS],
        AUTH)
    redteam = spark.createDataFrame(REDTEAM_ROWS, REDTEAM)
    return Layers(auth, redteam, shared_scan=request.param)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_users(ly):
    assert rows(ly.users, "user", "total_logins", "success_logins", "failed_logins", "first_login",
                "last_login") == [
        ("U1", 4, 3, 1, 1, 86400), ("U2", 3, 3, 0, 64799, 172801),
        ("U3", 1, 0, 0, 86399, 86399), ("U4", 1, 0, 1, 172800, 172800)]


def test_computers(ly):
    assert rows(ly.computers, "computer", "total_authentications", "success_logins", "failed_logins",
                "first_seen", "last_seen") == [
        ("C10", 4, 3, 1, 1, 86400), ("C11", 2, 1, 1, 28800, 172800), ("C12", 1, 0, 0, 86399, 86399)]


def test_bridge(ly):
    assert rows(ly.user_computers, "user", "computer") == [
        ("U1", "C10"), ("U1", "C11"), ("U2", "C10"), ("U3", "C12"), ("U4", "C11")]


def test_activity_facts(ly):
    m = ("authentications", "success_logins", "failed_logins")
    assert rows(ly.daily_activity, "day", *m) == [(0, 6, 4, 1), (1, 1, 1, 0), (2, 2, 1, 1)]
    assert rows(ly.daily_user_activity, "day", "user", *m) == [
        (0, "U1", 3, 2, 1), (0, "U2", 2, 2, 0), (0, "U3", 1, 0, 0), (1, "U1", 1, 1, 0),
        (2, "U2", 1, 1, 0), (2, "U4", 1, 0, 1)]
    assert rows(ly.daily_computer_activity, "day", "computer", *m) == [
        (0, "C10", 3, 2, 1), (0, "C11", 1, 1, 0), (0, "C12", 1, 0, 0), (1, "C10", 1, 1, 0),
        (2, "C11", 1, 0, 1)]
    assert rows(ly.hourly_activity, "day", "hour", *m) == [
        (0, 0, 2, 1, 1), (0, 8, 1, 1, 0), (0, 17, 1, 1, 0), (0, 18, 1, 1, 0), (0, 23, 1, 0, 0),
        (1, 0, 1, 1, 0), (2, 0, 2, 1, 1)]


def test_redteam(ly):
    assert rows(ly.redteam_events, "timestamp", "user", "day", "hour", "business_hours") == [
        (2, "U1", 0, 0, False), (28800, "U2", 0, 8, True), (86400, "U1", 1, 0, False),
        (100000, "U77", 1, 3, False)]
    assert rows(silver.redteam_users(ly.redteam_events), "user", "events", "first_event", "last_event",
                "source_computers", "target_computers") == [
        ("U1", 2, 2, 86400, 1, 2), ("U2", 1, 28800, 28800, 1, 1), ("U77", 1, 100000, 100000, 1, 1)]
    assert rows(silver.redteam_computers(ly.redteam_events), "computer", "source_events", "target_events") == [
        ("C10", 1, 2), ("C11", 0, 1), ("C98", 0, 1), ("C99", 3, 0)]
    assert rows(silver.daily_redteam_activity(ly.redteam_events), "day", "events", "users", "targets") == [
        (0, 2, 2, 1), (1, 2, 2, 2)]


def test_features(ly):
    assert rows(ly.user_features, "user", "active_days", "avg_daily_authentications",
                "max_daily_authentications", "unique_computers", "redteam_events", "is_redteam_user") == [
        ("U1", 2, 2.0, 3, 2, 2, True), ("U2", 2, 1.5, 2, 1, 1, True),
        ("U3", 1, 1.0, 1, 1, 0, False), ("U4", 1, 1.0, 1, 1, 0, False)]
    assert rows(ly.computer_features, "computer", "active_days", "avg_daily_authentications",
                "max_daily_authentications", "unique_users", "redteam_source_events",
                "redteam_target_events") == [
        ("C10", 2, 2.0, 3, 2, 1, 2), ("C11", 2, 1.0, 1, 2, 0, 1), ("C12", 1, 1.0, 1, 1, 0, 0)]


def test_user_risk(ly):
    got = {r["user"]: r for r in ly.user_risk.collect()}
    expect = {
        "U1": (100.0, 100.0, 100.0, 100.0, 100.0, "Critical"),
        "U2": (200 / 3, 100 / 3, 200 / 3, 200 / 3, 58.33, "Medium"),
        "U3": (50 / 3, 100 / 3, 50 / 3, 50 / 3, 20.83, "Low"),
        "U4": (50 / 3, 100 / 3, 50 / 3, 50 / 3, 20.83, "Low"),
    }
    for user, (lg, cp, vol, rt, score, level) in expect.items():
        r = got[user]
        assert r["login_score"] == pytest.approx(lg)
        assert r["computer_score"] == pytest.approx(cp)
        assert r["volume_score"] == pytest.approx(vol)
        assert r["redteam_score"] == pytest.approx(rt)
        assert r["risk_score"] == score
        assert r["risk_level"] == level


def test_gold(ly):
    assert rows(gold.login_timeline(ly.hourly_activity), "day", "authentications", "success_logins",
                "failed_logins", "after_hours_logins") == [(0, 6, 4, 1, 4), (1, 1, 1, 0, 1), (2, 2, 1, 1, 2)]
    s = gold.redteam_summary(ly.user_features, ly.computer_features).collect()
    assert [tuple(r) for r in s] == [(3, 2, 1, 2)]
    d = gold.risk_distribution(ly.user_risk).collect()
    assert [(r["risk_level"], r["users"]) for r in d] == [("Critical", 1), ("Medium", 1), ("Low", 2)]
    k = gold.dashboard_kpis(ly.user_features, ly.hourly_activity, ly.user_risk).collect()[0].asDict()
    assert k == {"total_users": 4, "suspicious_users": 1, "average_risk": 50.0,
                 "authentication_failure_rate": 22.22, "after_hours_logins": 7, "critical_users": 1,
                 "high_users": 0, "medium_users": 1, "low_users": 2}
    top = gold.top_users(ly.user_features, ly.user_risk).collect()
    assert [r["user"] for r in top] == ["U1", "U2", "U3", "U4"]
    topc = gold.top_computers(ly.computer_features).collect()
    assert [r["computer"] for r in topc] == ["C10", "C11", "C12"]
