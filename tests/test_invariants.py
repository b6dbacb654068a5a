"""Cross-table invariants at sf0.01."""

from conftest import SF_ORACLE
from pyspark.sql import functions as F

from logonlens.operators import gold
from logonlens.plans.layers import Layers
from logonlens.plans.queries import layers


def total(df, col="authentications"):
    return df.agg(F.sum(col)).first()[0]


def test_counts_agree_across_facts(spark):
    ly = layers(spark, SF_ORACLE)
    n = total(ly.hourly_activity)
    assert n == total(ly.daily_activity) == total(ly.daily_user_activity) == total(ly.users, "total_logins")
    bad = ly.daily_user_activity.where("success_logins + failed_logins > authentications").count()
    assert bad == 0


def test_shared_scan_equals_direct(spark):
    direct = layers(spark, SF_ORACLE)
    shared = Layers(direct.auth, direct.redteam, shared_scan=True)
    for name in ("users", "computers", "user_computers", "daily_activity", "daily_user_activity",
                 "daily_computer_activity", "hourly_activity"):
        a, b = getattr(direct, name), getattr(shared, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_scores_and_bands(spark):
    ly = layers(spark, SF_ORACLE)
    risk = ly.user_risk
    for c in ("risk_score", "login_score", "computer_score", "volume_score", "redteam_score"):
        lo, hi = risk.agg(F.min(c), F.max(c)).first()
        assert 0 <= lo <= hi <= 100
    k = gold.dashboard_kpis(ly.user_features, ly.hourly_activity, risk).first()
    assert k["critical_users"] + k["high_users"] + k["medium_users"] + k["low_users"] == k["total_users"]
    assert k["suspicious_users"] == k["critical_users"] + k["high_users"]
