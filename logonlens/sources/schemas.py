"""Declared schemas of the two raw logs and of every silver / gold table.

The raw CSVs are headerless, so the column *names* are fixed values; types are
declared here instead of inferred per chunk.
"""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


L, S, D, B = LongType(), StringType(), DoubleType(), BooleanType()

# Column order of the headerless raw auth log.
AUTH = _schema(
    ("timestamp", L),
    ("source_user", S),
    ("destination_user", S),
    ("source_computer", S),
    ("destination_computer", S),
    ("authentication_type", S),
    ("logon_type", S),
    ("authentication_orientation", S),
    ("status", S),
)

# Column order of the headerless raw red-team log.
REDTEAM = _schema(
    ("timestamp", L),
    ("user", S),
    ("source_computer", S),
    ("destination_computer", S),
)

USERS = _schema(
    ("user", S), ("total_logins", L), ("success_logins", L), ("failed_logins", L),
    ("first_login", L), ("last_login", L),
)

USER_FEATURES = _schema(
    *[(f.name, f.dataType) for f in USERS.fields],
    ("active_days", L), ("avg_daily_authentications", D), ("max_daily_authentications", L),
    ("unique_computers", L), ("redteam_events", L), ("is_redteam_user", B),
)

COMPUTERS = _schema(
    ("computer", S), ("total_authentications", L), ("success_logins", L), ("failed_logins", L),
    ("first_seen", L), ("last_seen", L),
)

COMPUTER_FEATURES = _schema(
    *[(f.name, f.dataType) for f in COMPUTERS.fields],
    ("active_days", L), ("avg_daily_authentications", D), ("max_daily_authentications", L),
    ("unique_users", L), ("redteam_source_events", L), ("redteam_target_events", L),
)

HOURLY_ACTIVITY = _schema(
    ("day", L), ("hour", L), ("authentications", L), ("success_logins", L), ("failed_logins", L),
)

DAILY_USER_ACTIVITY = _schema(
    ("day", L), ("user", S), ("authentications", L), ("success_logins", L), ("failed_logins", L),
)

DAILY_COMPUTER_ACTIVITY = _schema(
    ("day", L), ("computer", S), ("authentications", L), ("success_logins", L), ("failed_logins", L),
)

DAILY_ACTIVITY = _schema(
    ("day", L), ("authentications", L), ("success_logins", L), ("failed_logins", L),
)

USER_RISK = _schema(
    ("user", S), ("risk_score", D), ("risk_level", S), ("login_score", D),
    ("computer_score", D), ("volume_score", D), ("redteam_score", D),
)
