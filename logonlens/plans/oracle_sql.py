"""Independent DuckDB statements of every registered query (the correctness oracle).

functions, quantiles use ``row_number``, one-row results use scalar subqueries. The
``events`` view is provided by the checker; the raw logs are derived from it with the
same adapter rules as :mod:`logonlens.sources.testdata`.
"""

from __future__ import annotations

from logonlens.operators.profile import PROFILE_COLUMNS

AUTH = """auth AS (
  SELECT
    date_sub('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS "timestamp",
    CASE WHEN event_id % 20 = 0 THEN 'C' || user_id || '$@DOM1'
         WHEN event_id % 20 = 1 THEN 'ANONYMOUS LOGON'
         ELSE 'U' || user_id || '@DOM' || (user_id % 3 + 1) END AS source_user,
    'U' || user_id || '@DOM' || (user_id % 3 + 1) AS destination_user,
    'C' || (event_id % 37) AS source_computer,
    CASE WHEN event_id % 50 = 3 THEN 'TGT'
         ELSE 'C' || json_extract_string(props, '$.k') END AS destination_computer,
    'Kerberos' AS authentication_type,
    'Network' AS logon_type,
    'LogOn' AS authentication_orientation,
    CASE WHEN event_type = 'error' THEN 'Failure'
         WHEN event_type = 'signup' THEN '?'
         ELSE 'Success' END AS status
  FROM events)"""

REDTEAM = """redteam AS (
  SELECT
    date_sub('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS "timestamp",
    CASE WHEN event_id % 7 = 0 THEN 'U9999@DOM1'
         ELSE 'U' || user_id || '@DOM' || (user_id % 3 + 1) END AS "user",
    CASE WHEN event_id % 2 = 0 THEN 'C900' ELSE 'C' || (event_id % 37) END AS source_computer,
    'C' || json_extract_string(props, '$.k') AS destination_computer
  FROM events
  WHERE event_type = 'error' AND value > 150)"""


def _norm(src: str = "auth", name: str = "norm") -> str:
    return f"""{name} AS (
  SELECT *,
    split_part(source_user, '@', 1) AS "user",
    string_split(source_user, '@')[-1] AS domain,
    "timestamp" // 86400 AS day
  FROM {src}
  WHERE starts_with(split_part(source_user, '@', 1), 'U'))"""


NORM = _norm()

STATUS = """count(*) AS {total},
    count(*) FILTER (WHERE status = 'Success') AS success_logins,
    count(*) FILTER (WHERE status = 'Failure') AS failed_logins"""

USERS = f"""users AS (
  SELECT "user", {STATUS.format(total='total_logins')},
    min("timestamp") AS first_login, max("timestamp") AS last_login
  FROM norm GROUP BY "user")"""

COMPUTERS = f"""computers AS (
  SELECT destination_computer AS computer, {STATUS.format(total='total_authentications')},
    min("timestamp") AS first_seen, max("timestamp") AS last_seen
  FROM norm WHERE starts_with(destination_computer, 'C') GROUP BY destination_computer)"""

BRIDGE = """bridge AS (
  SELECT DISTINCT "user", destination_computer AS computer
  FROM norm WHERE starts_with(destination_computer, 'C'))"""

RTE = """rte AS (
  SELECT "timestamp", split_part("user", '@', 1) AS "user", source_computer, destination_computer,
    "timestamp" // 86400 AS day,
    ("timestamp" % 86400) // 3600 AS hour,
    (("timestamp" % 86400) // 3600 >= 8 AND ("timestamp" % 86400) // 3600 < 18) AS business_hours
  FROM redteam)"""

DAILY_USER = f"""daily_user AS (
  SELECT day, "user", {STATUS.format(total='authentications')}
  FROM norm GROUP BY day, "user")"""

DAILY_COMPUTER = f"""daily_computer AS (
  SELECT day, destination_computer AS computer, {STATUS.format(total='authentications')}
  FROM norm WHERE starts_with(destination_computer, 'C') GROUP BY day, destination_computer)"""

HOURLY = f"""hourly AS (
  SELECT day, ("timestamp" % 86400) // 3600 AS hour, {STATUS.format(total='authentications')}
  FROM norm GROUP BY day, ("timestamp" % 86400) // 3600)"""

DAILY = f"""daily AS (
  SELECT day, {STATUS.format(total='authentications')} FROM norm GROUP BY day)"""

USER_FEATURES = """uf AS (
  SELECT u.*, d.active_days, d.avg_daily_authentications, d.max_daily_authentications,
    coalesce(b.unique_computers, 0) AS unique_computers,
    coalesce(r.redteam_events, 0) AS redteam_events,
    coalesce(r.is_redteam_user, false) AS is_redteam_user
  FROM users u
  LEFT JOIN (SELECT "user", count(*) AS active_days, avg(authentications) AS avg_daily_authentications,
               max(authentications) AS max_daily_authentications
             FROM daily_user GROUP BY "user") d USING ("user")
  LEFT JOIN (SELECT "user", count(*) AS unique_computers FROM bridge GROUP BY "user") b USING ("user")
  LEFT JOIN (SELECT "user", count(*) AS redteam_events, true AS is_redteam_user
             FROM rte GROUP BY "user") r USING ("user"))"""

COMPUTER_FEATURES = """cf AS (
  SELECT c.*, d.active_days, d.avg_daily_authentications, d.max_daily_authentications,
    coalesce(b.unique_users, 0) AS unique_users,
    coalesce(s.redteam_source_events, 0) AS redteam_source_events,
    coalesce(t.redteam_target_events, 0) AS redteam_target_events
  FROM computers c
  LEFT JOIN (SELECT computer, count(*) AS active_days, avg(authentications) AS avg_daily_authentications,
               max(authentications) AS max_daily_authentications
             FROM daily_computer GROUP BY computer) d USING (computer)
  LEFT JOIN (SELECT computer, count(*) AS unique_users FROM bridge GROUP BY computer) b USING (computer)
  LEFT JOIN (SELECT source_computer AS computer, count(*) AS redteam_source_events
             FROM rte GROUP BY source_computer) s USING (computer)
  LEFT JOIN (SELECT destination_computer AS computer, count(*) AS redteam_target_events
             FROM rte GROUP BY destination_computer) t USING (computer))"""


def pct(x: str) -> str:
    """Percentile score: (average rank - 1) / (n - 1) * 100, NULL for a NULL value."""
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE "
            f"((rank() OVER (ORDER BY {x} NULLS LAST))::DOUBLE "
            f"+ ((count(*) OVER (PARTITION BY {x}))::DOUBLE - 1) / 2 - 1) "
            f"/ NULLIF(count(*) OVER () - 1, 0) * 100 END")


def r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def r6(x: str) -> str:
    return f"round_even(({x}) * 1000000, 0) / 1000000"


def risk_cte(weights=(0.20, 0.25, 0.30, 0.25)) -> str:
    wl, wc, wv, wr = weights
    return f"""scores AS (
  SELECT "user",
    {pct('total_logins')} AS login_score,
    {pct('unique_computers')} AS computer_score,
    {pct('max_daily_authentications')} AS volume_score,
    {pct('redteam_events')} AS redteam_score
  FROM uf),
weighted AS (
  SELECT *, {r2(f"login_score * {wl}::DOUBLE + computer_score * {wc}::DOUBLE + volume_score * {wv}::DOUBLE + redteam_score * {wr}::DOUBLE")} AS risk_score
  FROM scores)"""


RISK = risk_cte() + """,
risk AS (
  SELECT "user", risk_score,
    CASE WHEN risk_score >= 80 THEN 'Critical' WHEN risk_score >= 65 THEN 'High'
         WHEN risk_score >= 40 THEN 'Medium' ELSE 'Low' END AS risk_level,
    login_score, computer_score, volume_score, redteam_score
  FROM weighted)"""

BASE = [AUTH, REDTEAM, NORM]
SILVER = BASE + [USERS, COMPUTERS, BRIDGE, RTE, DAILY_USER, DAILY_COMPUTER, HOURLY, DAILY]
FEATURES = SILVER + [USER_FEATURES, COMPUTER_FEATURES]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _with_pair(ctes: list[str], pair: tuple[str, str]) -> str:
    return with_(ctes + [pair[0]], pair[1])


def _long(cols, src: str) -> str:
    return "\n  UNION ALL ".join(f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


def _describe(cols, src: str, group: str | None = None, text=(), boolean=()) -> tuple[str, str]:
    ctes, body = _describe_numbers(cols, src, group)
    gsel, by = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    body += "".join(f"""
UNION ALL SELECT {gsel}'{c}', count({c}), count(*) FILTER (WHERE {c} IS NULL), {r6(f"avg(CAST({c} AS INTEGER))")}, NULL,
  CAST(min(CAST({c} AS INTEGER)) AS DOUBLE), NULL, NULL, NULL, CAST(max(CAST({c} AS INTEGER)) AS DOUBLE), NULL, NULL FROM {src}{by}"""
                    for c in boolean)
    body += "".join(f"""
UNION ALL SELECT {gsel}'{c.strip('"')}', count({c}), count(*) FILTER (WHERE {c} IS NULL), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  min({c}), max({c}) FROM {src}{by}""" for c in text)
    return ctes, body


def _describe_numbers(cols, src: str, group: str | None = None) -> tuple[str, str]:
    gsel, gout = (f"{group}, ", f"m.{group}, ") if group else ("", "")
    same = f"m.metric = q.metric AND m.{group} IS NOT DISTINCT FROM q.{group}" if group else "m.metric = q.metric"
    long = "\n  UNION ALL ".join(
        f"SELECT {gsel}'{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)
    gpart = f"{group}, metric" if group else "metric"
    quant = ",\n    ".join(
        f"max(CASE WHEN rn - 1 = floor({q}::DOUBLE * (n - 1) + 0.5) THEN value END) AS {name}"
        for name, q in (("p25", 0.25), ("p50", 0.50), ("p75", 0.75)))
    return (f"""dlong AS ({long}),
moments AS (
  SELECT {gpart}, count(value) AS count, count(*) FILTER (WHERE value IS NULL) AS null_count,
    {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std,
    min(value) AS min, max(value) AS max
  FROM dlong GROUP BY {gpart}),
ordered AS (
  SELECT {gpart}, value, row_number() OVER (PARTITION BY {gpart} ORDER BY value) AS rn,
    count(*) OVER (PARTITION BY {gpart}) AS n
  FROM dlong WHERE value IS NOT NULL),
quants AS (
  SELECT {gpart},
    {quant}
  FROM ordered GROUP BY {gpart})""", f"""SELECT {gout}m.metric AS column, count, null_count, mean, std, min, p25, p50, p75, max,
  NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text
FROM moments m LEFT JOIN quants q ON {same}""")


def _histogram(cols, src: str, bins: int = 50) -> tuple[str, str]:
    step = f"((hi - lo) / {bins}.0::DOUBLE)"

    def edge(i: str) -> str:
        return f"(CASE WHEN {i} >= {bins} THEN hi ELSE ({i}) * {step} + lo END)"

    return (f"""hlong AS ({_long(cols, src)}),
stats AS (
  SELECT metric,
    CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
    CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
  FROM hlong WHERE value IS NOT NULL GROUP BY metric),
binned AS (
  SELECT l.metric, b.bin FROM hlong l JOIN stats s ON s.metric = l.metric JOIN range(0, {bins}) b(bin)
    ON l.value >= {edge('b.bin')} AND (l.value < {edge('b.bin + 1')} OR b.bin = {bins - 1} AND l.value <= hi)),
counts AS (SELECT metric, bin, count(*) AS cnt FROM binned GROUP BY metric, bin),
frame AS (SELECT metric, lo, hi, b.bin FROM stats, range(0, {bins}) b(bin))""", f"""SELECT f.metric AS column, CAST(f.bin AS INTEGER) AS bin,
  {edge('f.bin')} AS lower, {edge('f.bin + 1')} AS upper,
  coalesce(c.cnt, 0) AS count
FROM frame f LEFT JOIN counts c ON c.metric = f.metric AND c.bin = f.bin""")


def _correlation(cols, src: str) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                         f"{r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM {src}")
    return "\nUNION ALL ".join(parts)


def _summary(table: str, src: str, cols) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"(SELECT count(*) FROM {src}) AS rows, "
        f"(SELECT count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM {src}) AS distinct_values"
        for c in cols)


NUMERIC_USER_COLUMNS = ("total_logins", "success_logins", "failed_logins", "first_login", "last_login",
                        "active_days", "avg_daily_authentications", "max_daily_authentications",
                        "unique_computers", "redteam_events")
USER_FEATURE_COLUMNS = ('"user"',) + NUMERIC_USER_COLUMNS + ("is_redteam_user",)

_USERS_ONE_SHOT = with_(BASE + [USERS], "SELECT * FROM users")
_DAILY_USER_ONE_SHOT = with_(BASE + [DAILY_USER], "SELECT * FROM daily_user")
_BRIDGE_ONE_SHOT = with_(BASE + [BRIDGE], "SELECT * FROM bridge")


def _top20(metric: str) -> str:
    return with_(FEATURES, f'SELECT * FROM uf ORDER BY {metric} DESC NULLS FIRST, "user" LIMIT 20')


def _rolling(src: str, cols: dict[str, str], days: int = 7) -> str:
    counts = ",\n  ".join(f"count(DISTINCT x.{c}) + coalesce(max(CASE WHEN x.{c} IS NULL THEN 1 ELSE 0 END), 0) AS {m}"
                          for m, c in cols.items())
    return f"""SELECT d.day AS last_day, {counts}
FROM (SELECT DISTINCT day FROM {src}) d JOIN {src} x ON x.day BETWEEN d.day - {days - 1} AND d.day GROUP BY d.day"""


_FIELDS = """coalesce(CAST("timestamp" AS VARCHAR), '') || ',' || coalesce(source_user, '') || ',' || coalesce(destination_user, '')
  || ',' || coalesce(source_computer, '') || ',' || coalesce(destination_computer, '') || ',' || coalesce(authentication_type, '')
  || ',' || coalesce(logon_type, '') || ',' || coalesce(authentication_orientation, '')"""
_SPOILT = "\"timestamp\" % 97 IN (5, 6, 7)"

ORACLE: dict[str, str] = {
    "auth_ingest_counts": with_([AUTH], f"""SELECT count(*) AS lines, count(*) FILTER (NOT {_SPOILT}) AS accepted,
  count(*) FILTER ({_SPOILT}) AS rejected, min("timestamp") FILTER (NOT {_SPOILT}) AS first_second,
  max("timestamp") FILTER (NOT {_SPOILT}) AS last_second FROM auth"""),
    "auth_ingest_accepted": with_([AUTH], f"SELECT * FROM auth WHERE NOT {_SPOILT}"),
    "auth_ingest_rejects": with_([AUTH, f"""lines AS (SELECT CASE WHEN "timestamp" % 97 = 7 THEN 'value' ELSE 'fields' END AS reason,
  CASE "timestamp" % 97 WHEN 5 THEN {_FIELDS} WHEN 6 THEN {_FIELDS} || ',' || coalesce(status, '') || ',more'
    ELSE 'x' || {_FIELDS} || ',' || coalesce(status, '') END AS line FROM auth WHERE {_SPOILT})"""],
        "SELECT reason, count(*) AS lines, min(line) AS example FROM lines GROUP BY reason"),
    "auth_normalized": with_(BASE, "SELECT * FROM norm"),
    "auth_row_count": with_([AUTH], "SELECT count(*) AS rows FROM auth"),
    "auth_bronze_roundtrip": with_([AUTH], "SELECT * FROM auth"),
    "redteam_bronze_roundtrip": with_([REDTEAM], "SELECT * FROM redteam"),
    "redteam_validation": with_([REDTEAM], """SELECT count(*) AS rows,
  count(DISTINCT "user") + max(CASE WHEN "user" IS NULL THEN 1 ELSE 0 END) AS users,
  count(DISTINCT source_computer) + max(CASE WHEN source_computer IS NULL THEN 1 ELSE 0 END) AS source_computers,
  count(DISTINCT destination_computer) + max(CASE WHEN destination_computer IS NULL THEN 1 ELSE 0 END) AS destination_computers
FROM redteam"""),
    "users_dim": _USERS_ONE_SHOT,
    "computers_dim": with_(BASE + [COMPUTERS], "SELECT * FROM computers"),
    "user_computers": _BRIDGE_ONE_SHOT,
    "redteam_events": with_([REDTEAM, RTE], "SELECT * FROM rte"),
    "redteam_users": with_([REDTEAM, RTE], """SELECT "user", count(*) AS events,
  min("timestamp") AS first_event, max("timestamp") AS last_event,
  count(DISTINCT source_computer) + max(CASE WHEN source_computer IS NULL THEN 1 ELSE 0 END) AS source_computers,
  count(DISTINCT destination_computer) + max(CASE WHEN destination_computer IS NULL THEN 1 ELSE 0 END) AS target_computers
FROM rte GROUP BY "user\""""),
    "redteam_computers": with_([
        REDTEAM, RTE,
        "s AS (SELECT source_computer AS computer, count(*) AS source_events FROM rte GROUP BY source_computer)",
        "t AS (SELECT destination_computer AS computer, count(*) AS target_events FROM rte GROUP BY destination_computer)",
    ], """SELECT coalesce(s.computer, t.computer) AS computer,
  coalesce(s.source_events, 0) AS source_events, coalesce(t.target_events, 0) AS target_events
FROM s FULL OUTER JOIN t ON s.computer = t.computer"""),
    "daily_redteam_activity": with_([REDTEAM, RTE], """SELECT day, count(*) AS events,
  count(DISTINCT "user") + max(CASE WHEN "user" IS NULL THEN 1 ELSE 0 END) AS users,
  count(DISTINCT destination_computer) + max(CASE WHEN destination_computer IS NULL THEN 1 ELSE 0 END) AS targets
FROM rte GROUP BY day"""),
    "daily_activity": with_(BASE + [DAILY], "SELECT * FROM daily"),
    "daily_computer_activity": with_(BASE + [DAILY_COMPUTER], "SELECT * FROM daily_computer"),
    "daily_user_activity": _DAILY_USER_ONE_SHOT,
    "hourly_activity": with_(BASE + [HOURLY], "SELECT * FROM hourly"),
    "daily_activity_from_hourly": with_(BASE + [DAILY], "SELECT * FROM daily"),
    "activity_cube": with_(BASE, f"""SELECT day, ("timestamp" % 86400) // 3600 AS hour, "user", destination_computer,
  {STATUS.format(total='authentications')}, min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM norm GROUP BY ALL"""),
    "users_from_cube": _USERS_ONE_SHOT,
    "computers_from_cube": with_(BASE + [COMPUTERS], "SELECT * FROM computers"),
    "user_computers_from_cube": _BRIDGE_ONE_SHOT,
    "user_features_from_cube": with_(FEATURES, "SELECT * FROM uf"),
    "computer_features_from_cube": with_(FEATURES, "SELECT * FROM cf"),
    "user_features": with_(FEATURES, "SELECT * FROM uf"),
    "computer_features": with_(FEATURES, "SELECT * FROM cf"),
    "percentile_scores": with_(FEATURES, f"""SELECT computer, total_authentications, unique_users, avg_daily_authentications,
  {pct('total_authentications')} AS volume_pct,
  {pct('unique_users')} AS users_pct,
  {pct('avg_daily_authentications')} AS avg_daily_pct
FROM cf"""),
    "user_risk": with_(FEATURES + [RISK], "SELECT * FROM risk"),
    "gold_hourly_activity": with_(BASE + [HOURLY], "SELECT * FROM hourly ORDER BY day, hour"),
    "login_timeline": with_(BASE + [HOURLY], """SELECT day,
  sum(authentications)::BIGINT AS authentications,
  sum(success_logins)::BIGINT AS success_logins,
  sum(failed_logins)::BIGINT AS failed_logins,
  sum(CASE WHEN hour < 8 OR hour >= 18 THEN authentications ELSE 0 END)::BIGINT AS after_hours_logins
FROM hourly GROUP BY day"""),
    "redteam_summary": with_(FEATURES, """SELECT
  (SELECT coalesce(sum(redteam_events), 0)::BIGINT FROM uf) AS total_redteam_events,
  (SELECT count(*) FILTER (WHERE redteam_events > 0) FROM uf) AS affected_users,
  (SELECT count(*) FILTER (WHERE redteam_source_events > 0) FROM cf) AS source_computers,
  (SELECT count(*) FILTER (WHERE redteam_target_events > 0) FROM cf) AS target_computers"""),
    "risk_distribution": with_(FEATURES + [RISK], """SELECT risk_level, count(*) AS users FROM risk GROUP BY risk_level
ORDER BY CASE risk_level WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 END"""),
    "top_computers": with_(FEATURES, """SELECT computer, total_authentications, success_logins, failed_logins, unique_users,
  active_days, avg_daily_authentications, max_daily_authentications, redteam_source_events, redteam_target_events
FROM cf
ORDER BY redteam_target_events DESC NULLS FIRST, redteam_source_events DESC NULLS FIRST,
  total_authentications DESC NULLS FIRST, computer
LIMIT 100"""),
    "top_users": with_(FEATURES + [RISK], """SELECT "user", risk_score, risk_level, redteam_events, total_logins, unique_computers,
  active_days, max_daily_authentications
FROM uf JOIN risk USING ("user")
ORDER BY risk_score DESC NULLS FIRST, "user"
LIMIT 100"""),
    "dashboard_kpis": with_(FEATURES + [RISK], f"""SELECT
  (SELECT count(*) FROM uf) AS total_users,
  (SELECT count(*) FILTER (WHERE risk_score >= 65) FROM risk) AS suspicious_users,
  (SELECT {r2('avg(risk_score)')} FROM risk) AS average_risk,
  (SELECT CASE WHEN coalesce(sum(authentications), 0) = 0 THEN 0.0::DOUBLE
     ELSE {r2('sum(failed_logins)::DOUBLE / sum(authentications)::DOUBLE * 100')} END FROM hourly)
     AS authentication_failure_rate,
  (SELECT coalesce(sum(authentications) FILTER (WHERE hour < 8 OR hour >= 18), 0)::BIGINT FROM hourly)
     AS after_hours_logins,
  (SELECT count(*) FILTER (WHERE risk_level = 'Critical') FROM risk) AS critical_users,
  (SELECT count(*) FILTER (WHERE risk_level = 'High') FROM risk) AS high_users,
  (SELECT count(*) FILTER (WHERE risk_level = 'Medium') FROM risk) AS medium_users,
  (SELECT count(*) FILTER (WHERE risk_level = 'Low') FROM risk) AS low_users"""),
    "merge_daily_user_activity": _DAILY_USER_ONE_SHOT,
    "merge_users_dim": _USERS_ONE_SHOT,
    "merge_user_computers": _BRIDGE_ONE_SHOT,
    "user_features_colocated": with_(FEATURES, "SELECT * FROM uf"),
    "computer_features_colocated": with_(FEATURES, "SELECT * FROM cf"),
    "new_user_computers": with_(BASE, """SELECT "user", destination_computer AS computer FROM norm
WHERE starts_with(destination_computer, 'C') AND NOT coalesce("timestamp" < 15 * 86400 + 43200, false)
EXCEPT SELECT "user", destination_computer FROM norm WHERE "timestamp" < 15 * 86400 + 43200"""),
    "refresh_daily_user_activity": _DAILY_USER_ONE_SHOT,
    "late_user_scores": with_(FEATURES + [risk_cte()], """SELECT "user", login_score, computer_score, volume_score, redteam_score
FROM scores WHERE CAST(substr("user", 2, 10) AS INTEGER) % 10 = 0"""),
    "weekly_login_quantiles": with_(BASE + [DAILY_USER, """placed AS (
  SELECT day // 7 AS week, CAST(authentications AS DOUBLE) AS x, count(*) OVER (PARTITION BY day // 7) AS n,
    row_number() OVER (PARTITION BY day // 7 ORDER BY authentications) - 1 AS i FROM daily_user)"""],
        "SELECT week, " + ", ".join(f"max(CASE WHEN i = floor({q}::DOUBLE * (n - 1) + 0.5) THEN x END) AS {p}, true AS {p}_within"
                                    for p, q in (("p50", 0.50), ("p90", 0.90), ("p99", 0.99))) + " FROM placed GROUP BY week"),
    "new_users_by_day": with_(BASE, """SELECT d.day, count(f."user") AS new_users, true AS within
FROM (SELECT DISTINCT day FROM norm) d LEFT JOIN (SELECT "user", min(day) AS day FROM norm GROUP BY "user") f ON f.day = d.day
GROUP BY d.day"""),
    "users_of_both_logs": with_(BASE + [RTE], """SELECT a.week, count(r."user") AS users, true AS within
FROM (SELECT DISTINCT day // 7 AS week, "user" FROM norm) a
LEFT JOIN (SELECT DISTINCT day // 7 AS week, "user" FROM rte) r ON r.week = a.week AND r."user" = a."user"
WHERE a.week IN (SELECT day // 7 FROM rte) GROUP BY a.week"""),
    "top20_over_days": with_(BASE + [DAILY_USER], """SELECT "user", CAST(sum(authentications) AS BIGINT) AS total FROM daily_user
WHERE day BETWEEN 5 AND 24 GROUP BY "user" ORDER BY total DESC, "user" LIMIT 20"""),
    "correlation_over_days": with_(BASE + [DAILY_USER, 'du AS (SELECT *, length("user") AS user_length FROM daily_user)'],
        "\nUNION ALL ".join(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, count(*) AS n, {r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM du"
            for a in ("authentications", "success_logins", "failed_logins", "user_length")
            for b in ("authentications", "success_logins", "failed_logins", "user_length"))),
    "active_users_rolling": with_(BASE, _rolling("norm", {"users": '"user"', "targets": "destination_computer"})),
    "redteam_distinct_rolling": with_([REDTEAM, RTE], _rolling("rte", {
        "users": '"user"', "source_computers": "source_computer", "targets": "destination_computer"})),
    "user_shape": with_(FEATURES, "SELECT count(*) AS rows, 12::BIGINT AS columns FROM uf"),
    "user_null_counts": with_(FEATURES, "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in USER_FEATURE_COLUMNS) + " FROM uf"),
    "user_describe": _with_pair(FEATURES, _describe(NUMERIC_USER_COLUMNS, "uf", text=['"user"'], boolean=["is_redteam_user"])),
    "user_describe_null_group": _with_pair(
        [*FEATURES, "uc AS (SELECT *, CASE WHEN redteam_events > 0 THEN 'flagged' END AS cohort FROM uf)"],
        _describe(["total_logins", "unique_computers"], "uc", "cohort")),
    "user_describe_by_cohort": _with_pair(FEATURES, _describe(NUMERIC_USER_COLUMNS, "uf", "is_redteam_user", text=['"user"'])),
    "user_histogram": _with_pair(FEATURES, _histogram(PROFILE_COLUMNS, "uf")),
    "user_correlation": with_(FEATURES, _correlation(PROFILE_COLUMNS, "uf")),
    "top20_unique_computers": _top20("unique_computers"),
    "top20_total_logins": _top20("total_logins"),
    "top20_max_daily": _top20("max_daily_authentications"),
    "fact_summary": with_(SILVER, "\nUNION ALL ".join([
        _summary("hourly_activity", "hourly", ["day", "hour"]),
        _summary("daily_computer_activity", "daily_computer", ["computer", "day"]),
        _summary("daily_user_activity", "daily_user", ['"user"', "day"]).replace("'\"user\"'", "'user'"),
        _summary("redteam_events", "rte", ['"user"', "day"]).replace("'\"user\"'", "'user'"),
    ])),
    "user_risk_weighted": with_(FEATURES + [risk_cte((0.40, 0.20, 0.20, 0.20))],
                                "SELECT \"user\", login_score, computer_score, volume_score, redteam_score, risk_score FROM weighted"),
    "redteam_users_flagged": with_(FEATURES, "SELECT * FROM uf WHERE is_redteam_user"),
}

# The tables of the full run hold what the lazy queries of the same name give.
ORACLE |= {f"run_{name}": ORACLE[source] for name, source in (
    ("hourly_activity", "hourly_activity"), ("users_features", "user_features"),
    ("user_risk", "user_risk"), ("dashboard_kpis", "dashboard_kpis"))}
