"""DuckDB statements stating what each registered query must return.

They are written from the table definitions in plain SQL (window dedupe, join-then-group funnel,
distinct counts), not from the Spark plans. Shared with the library are the adapter rules and the
lists of fixed values: payload fields, funnel flags, metric names, policed checks, malformed rows. A
wrong entry there would match itself; tests/test_refresh.py and tests/test_staging.py hold those
against published figures and hand-written rows.
"""

from __future__ import annotations

from armlens.domain import ARM_LABELS, ARM_SHORT_LABELS, ENUMERATIONS, EVENT_CATALOG
from armlens.functions.payload import FIELDS
from armlens.operators.inference import GUARDRAILS, SECONDARY
from armlens.operators.quality import POLICY, UNIQUE_POLICY
from armlens.operators.warehouse import FUNNEL_FLAGS
from armlens.plans.workload import ORDERLESS
from armlens.sources import event_table as rules
from armlens.sources.faults import MALFORMED

Z = "1.959963984540054"
Z_SUM = "2.801585218112969"

_ENV = (
    "event_id, user_id, event_name, event_timestamp, test_group, platform, session_id, properties"
)
_FOUR = "event_id IS NOT NULL AND user_id IS NOT NULL AND event_name IS NOT NULL AND event_timestamp IS NOT NULL"
_VALID = f"{_FOUR} AND test_group IN ('A','B','C') AND platform IN ('iOS','Android')"


def _field(key: str, kind: str) -> str:
    text = f"json_extract_string(properties, '$.{key}')"
    if kind == "string":
        return text
    if kind == "double":
        return f"TRY_CAST({text} AS DOUBLE)"
    if kind == "flag":
        return f"CASE {text} WHEN 'true' THEN 1 WHEN 'false' THEN 0 END"
    return f"TRY_CAST({text} AS INTEGER)"


_PAYLOAD = ", ".join(f"{_field(key, kind)} AS {column}" for key, column, kind in FIELDS)
_TS = "date_trunc('second', CAST(event_timestamp AS TIMESTAMP))"


def _has(event: str, alias: str) -> str:
    return f"MAX(CASE WHEN e.event_name = '{event}' THEN 1 ELSE 0 END) AS {alias}"


def _first(event: str, alias: str) -> str:
    return f"MIN(CASE WHEN e.event_name = '{event}' THEN e.event_timestamp END) AS {alias}"


_MALFORMED = ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in MALFORMED
)


def _journeys() -> list[tuple[str, str]]:
    stops = ", ".join(f"({at}, '{name}', {minutes})" for at, (name, minutes, _) in enumerate(rules.JOURNEY))
    return [
        ("travellers", "SELECT user_id AS uid, MIN(ts) AS first FROM events GROUP BY user_id"),
        ("stops", f"""SELECT *, CAST(uid % 100 AS INTEGER) AS k, CAST(uid % 50 + 0.5 AS DOUBLE) AS value,
            {rules.JOURNEY_ARM} AS test_group, {rules.JOURNEY_PLATFORM} AS platform
            FROM travellers, (VALUES {stops}) AS s(leg, event_name, minutes) WHERE {rules.IN_JOURNEY}"""),
        ("journeys", f"""SELECT concat_ws('_', 'j', uid, leg) AS event_id, concat('u_', CAST(uid AS STRING)) AS user_id,
            event_name, strftime(first + to_minutes(CAST(minutes AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
            test_group, platform, concat('s_', CAST(uid AS STRING)) AS session_id,
            {rules.payload_sql(EVENT_CATALOG)} AS properties FROM stops"""),
        ("landed", f"SELECT {_ENV}, 'events.parquet' AS _source_file, 0 AS _ingest_seq FROM journeys"),
    ]


def _landed(arm: str = "test_group", injected: bool = False) -> list[tuple[str, str]]:
    extra = f"""
        UNION ALL SELECT event_id, user_id, event_name, event_timestamp, test_group, platform, 's1', '{{}}',
         'dirty_injection', 1 FROM (VALUES {_MALFORMED}
         ) AS bad(event_id, user_id, event_name, event_timestamp, test_group, platform)
        UNION ALL SELECT * FROM (SELECT {_ENV}, 'dirty_injection_dup', _ingest_seq + 1
         FROM delivered ORDER BY event_id, _ingest_seq LIMIT 3)""" if injected else ""
    return [
        ("src", """SELECT event_id AS eid, user_id AS uid, event_type AS etype, value,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp FROM events"""),
        ("named", f"""SELECT *, {rules.EVENT_NAME} AS event_name, {rules.TEST_GROUP} AS test_group,
            {rules.PLATFORM} AS platform FROM src"""),
        ("once", f"""SELECT CAST(eid AS VARCHAR) AS event_id, {rules.USER_ID} AS user_id, event_name,
            event_timestamp, {arm} AS test_group, platform, concat('s_', CAST(uid AS STRING)) AS session_id,
            {rules.payload_sql(EVENT_CATALOG)} AS properties, eid FROM named"""),
        ("delivered", f"""SELECT {_ENV}, 'events.parquet' AS _source_file, 0 AS _ingest_seq FROM once
            UNION ALL SELECT {_ENV}, 'events.parquet', 1 FROM once WHERE eid % 50 = 0"""),
        ("landed", f"SELECT * FROM delivered{extra}"),
    ]


_CODES = """concat_ws(',',
    CASE WHEN event_id IS NULL THEN 'null_event_id' END,
    CASE WHEN user_id IS NULL THEN 'null_user_id' END,
    CASE WHEN event_name IS NULL THEN 'null_event_name' END,
    CASE WHEN event_timestamp IS NULL THEN 'null_event_timestamp' END,
    CASE WHEN test_group IN ('A','B','C') THEN NULL ELSE 'bad_test_group' END,
    CASE WHEN platform IN ('iOS','Android') THEN NULL ELSE 'bad_platform' END)"""

_STAGING = [
    ("valid", f"SELECT * FROM landed WHERE {_VALID}"),
    ("rejected", f"SELECT *, 'null_or_invalid_key' AS reject_reason, {_CODES} AS reject_codes "
                 f"FROM landed WHERE ({_VALID}) IS NOT TRUE"),
    ("dedup", """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY event_id ORDER BY _ingest_seq) AS rn FROM valid) WHERE rn = 1"""),
    ("staged", f"""SELECT event_id, user_id, event_name, {_TS} AS event_timestamp,
        CAST({_TS} AS DATE) AS event_date, test_group, platform, session_id, properties, {_PAYLOAD}
        FROM dedup"""),
]


_WAREHOUSE = [
    ("users", f"""SELECT user_id, test_group, platform, {_first('app_installed', 'install_ts')},
        CAST(MIN(CASE WHEN event_name = 'app_installed' THEN event_date END) AS DATE) AS install_date,
        {_has('account_created', 'account_created_flag')},
        MAX(CASE WHEN event_name = 'account_created' THEN signup_method END) AS signup_method
        FROM staged e GROUP BY ALL"""),
    ("funnel", f"""SELECT u.user_id, u.test_group, u.platform, u.install_date, u.account_created_flag,
        {', '.join(_has(event, column) for column, event in FUNNEL_FLAGS.items())},
        MAX(CASE WHEN e.event_name = 'onboarding_completed' THEN e.steps_completed END) AS steps_completed,
        {_first('onboarding_started', 'onboarding_started_ts')},
        {_first('onboarding_completed', 'onboarding_completed_ts')},
        {_first('first_lesson_started', 'first_lesson_started_ts')},
        MAX(CASE WHEN e.event_name = 'subscription_purchased' THEN e.price_usd END) AS price_usd,
        AVG(CASE WHEN e.event_name = 'lesson_feedback_submitted' THEN e.relevance_score END) AS avg_relevance_score,
        date_diff('second', MIN(CASE WHEN e.event_name = 'onboarding_started' THEN e.event_timestamp END),
            MIN(CASE WHEN e.event_name = 'first_lesson_started' THEN e.event_timestamp END)) AS time_to_first_lesson_seconds
        FROM users u LEFT JOIN staged e ON e.user_id = u.user_id
        GROUP BY u.user_id, u.test_group, u.platform, u.install_date, u.account_created_flag"""),
]

_DESIGN = " UNION ALL ".join(
    f"SELECT '{arm}' AS test_group, {at} AS step_number, '{step}' AS step_name, "
    f"'{rules.STEP_BUCKETS[step]}' AS step_bucket"
    for arm, steps in rules.ARM_STEPS.items() for at, step in enumerate(steps, start=1)
)


def _sum(column: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT)"


def _rate(top: str, bottom: str) -> str:
    return f"ROUND(CAST({top} AS DOUBLE) / NULLIF({bottom}, 0), 4)"


_DISTINCT = {
    column: f"COUNT(DISTINCT CASE WHEN f.step_event_type = '{event}' THEN f.user_id END)"
    for column, event in (
        ("users_viewed", "onboarding_step_viewed"), ("users_completed", "onboarding_step_completed"),
        ("users_abandoned", "onboarding_step_abandoned"),
    )
}

_MARTS = [
    ("design", _DESIGN),
    ("steps", """SELECT event_id, user_id, test_group, platform, event_name AS step_event_type, step_number,
        step_name, step_bucket, time_on_step_seconds, exit_reason, event_timestamp, event_date FROM staged
        WHERE event_name IN ('onboarding_step_viewed','onboarding_step_completed','onboarding_step_abandoned')"""),
    ("kpi", f"""SELECT test_group, COUNT(*) AS users_started,
        {_sum('completed_onboarding')} AS users_completed,
        {_rate('SUM(completed_onboarding)', 'COUNT(*)')} AS onboarding_completion_rate,
        {_sum('activated')} AS users_activated,
        {_rate('SUM(activated)', 'SUM(completed_onboarding)')} AS activation_rate,
        {_sum('purchased')} AS users_purchased,
        {_rate('SUM(purchased)', 'SUM(activated)')} AS paid_conversion_rate,
        ROUND(AVG(time_to_first_lesson_seconds), 1) AS avg_time_to_first_lesson_seconds,
        {_rate('SUM(returned_day1)', 'SUM(completed_onboarding)')} AS day1_return_rate,
        {_rate('SUM(returned_day7)', 'SUM(completed_onboarding)')} AS day7_return_rate,
        {_rate('SUM(returned_day30)', 'SUM(completed_onboarding)')} AS day30_return_rate
        FROM funnel GROUP BY test_group"""),
    ("guards", f"""SELECT test_group, ROUND(AVG(avg_relevance_score), 3) AS avg_lesson_relevance_score,
        {_rate('SUM(refund_requested)', 'SUM(purchased)')} AS refund_rate,
        {_rate('SUM(subscription_cancelled)', 'SUM(purchased)')} AS cancellation_rate,
        {_rate('SUM(filed_support_ticket)', 'COUNT(*)')} AS support_ticket_rate,
        {_rate('SUM(notif_accepted)', 'SUM(notif_shown)')} AS notification_optin_rate
        FROM funnel GROUP BY test_group"""),
    ("dropoff", f"""SELECT f.test_group, f.step_number, f.step_name, ds.step_bucket,
        {', '.join(f'{text} AS {column}' for column, text in _DISTINCT.items())},
        {_rate(_DISTINCT['users_abandoned'], _DISTINCT['users_viewed'])} AS step_abandon_rate
        FROM steps f JOIN design ds ON ds.test_group = f.test_group AND ds.step_number = f.step_number
        GROUP BY f.test_group, f.step_number, f.step_name, ds.step_bucket"""),
    ("daily", f"""SELECT install_date, test_group, COUNT(*) AS users_started,
        {_sum('completed_onboarding')} AS users_completed,
        {_rate('SUM(completed_onboarding)', 'COUNT(*)')} AS onboarding_completion_rate
        FROM funnel GROUP BY install_date, test_group"""),
]

_LABEL = "CASE {0} WHEN 'A' THEN '" + ARM_LABELS["A"] + "' WHEN 'B' THEN '" + ARM_LABELS["B"] + \
    "' WHEN 'C' THEN '" + ARM_LABELS["C"] + "' END"
_SHORT = "CASE {0} WHEN 'A' THEN '" + ARM_SHORT_LABELS["A"] + "' WHEN 'B' THEN '" + \
    ARM_SHORT_LABELS["B"] + "' WHEN 'C' THEN '" + ARM_SHORT_LABELS["C"] + "' END"


def _regression(metric: str, label: str, worse: str, source: str, shown: str) -> str:
    sign = "<" if worse == "lower" else ">"
    text = (
        f"'{label} is {worse} in C (' || {shown.format('c')} || ') than A (' || {shown.format('a')} || ')'"
    )
    return f"""SELECT '{metric}' AS metric, '{worse}' AS bad_direction, a AS control_value, c AS treatment_value,
        CASE WHEN c {sign} a THEN 1 ELSE 0 END AS flagged, CASE WHEN c {sign} a THEN {text} END AS message
        FROM (SELECT MAX(CASE WHEN test_group = 'A' THEN {metric} END) AS a,
              MAX(CASE WHEN test_group = 'C' THEN {metric} END) AS c FROM {source})"""


_TWO = "format('{{:.2f}}', {0})"
_PCT = "(format('{{:.1f}}', {0} * 100) || '%')"
_FLAGS = [
    _regression("avg_lesson_relevance_score", "Lesson relevance score", "lower", "guards", _TWO),
    _regression("refund_rate", "Refund rate", "higher", "guards", _PCT),
    _regression("support_ticket_rate", "Support-ticket rate", "higher", "guards", _PCT),
    _regression("notification_optin_rate", "Notification opt-in", "lower", "guards", _PCT),
]
_MORE_FLAGS = [
    _regression("day30_return_rate", "Day-30 return rate", "lower", "kpi", _PCT),
    _regression("cancellation_rate", "Cancellation rate", "higher", "guards", _PCT),
]

_STATISTICS = [
    ("srm", """SELECT string_agg(test_group || '=' || users_started, ',' ORDER BY test_group) AS observed,
        ROUND(SUM(users_started) / 3.0::DOUBLE, 1) AS expected_per_arm,
        SUM((users_started - t.e) * (users_started - t.e) / t.e) AS chi2
        FROM kpi, (SELECT SUM(users_started) / 3.0::DOUBLE AS e FROM kpi) t"""),
    ("srm_out", """SELECT observed, expected_per_arm, ROUND(chi2, 4) AS chi2_statistic,
        ROUND(exp(-chi2 / 2), 4) AS p_value, CASE WHEN exp(-chi2 / 2) >= 0.001 THEN 1 ELSE 0 END AS passes
        FROM srm"""),
    ("srm_two", """SELECT string_agg(test_group || '=' || users_started, ',' ORDER BY test_group) AS observed,
        ROUND(SUM(users_started) / 3.0::DOUBLE, 1) AS expected_per_arm,
        SUM((users_started - t.e) * (users_started - t.e) / t.e) + MAX(t.e) AS chi2
        FROM kpi, (SELECT SUM(users_started) / 3.0::DOUBLE AS e FROM kpi WHERE test_group <> 'C') t
        WHERE test_group <> 'C'"""),
    ("arms", f"""SELECT test_group, {_LABEL.format('test_group')} AS label, users_started, users_completed,
        onboarding_completion_rate AS completion_rate,
        ROUND((p + {Z}*{Z}/(2*n) - {Z}*sqrt(p*(1-p)/n + {Z}*{Z}/(4*n*n))) / (1 + {Z}*{Z}/n), 4) AS ci_95_low,
        ROUND((p + {Z}*{Z}/(2*n) + {Z}*sqrt(p*(1-p)/n + {Z}*{Z}/(4*n*n))) / (1 + {Z}*{Z}/n), 4) AS ci_95_high
        FROM (SELECT *, CAST(users_started AS DOUBLE) AS n,
              CAST(users_completed AS DOUBLE) / users_started AS p FROM kpi)"""),
    ("pairs", f"""SELECT *, ROUND(rate_b - rate_a, 4) AS absolute_diff,
        ROUND((rate_b - rate_a) / NULLIF(rate_a, 0) * 100, 2) AS relative_lift_pct,
        {Z} * sqrt(rate_a * (1 - rate_a) / na + rate_b * (1 - rate_b) / nb) AS margin,
        (xa / na - xb / nb) / NULLIF(sqrt((xa + xb) / (na + nb) * (1 - (xa + xb) / (na + nb)) * (1 / na + 1 / nb)), 0) AS z,
        arm_a || ' (' || {_LABEL.format('arm_a')} || ') vs ' || arm_b || ' (' || {_LABEL.format('arm_b')} || ')' AS label
        FROM (SELECT a.test_group AS arm_a, b.test_group AS arm_b,
          CAST(a.users_completed AS DOUBLE) AS xa, CAST(b.users_completed AS DOUBLE) AS xb,
          CAST(a.users_started AS DOUBLE) AS na, CAST(b.users_started AS DOUBLE) AS nb,
          a.onboarding_completion_rate AS rate_a, b.onboarding_completion_rate AS rate_b
          FROM kpi a JOIN kpi b ON a.test_group < b.test_group)"""),
    # Two-sided p by Simpson's rule over the normal density from |z| to |z| + 12.
    ("tails", """SELECT arm_a, arm_b, 2 / sqrt(2 * pi()) * SUM(exp(-(abs(z) + i * 0.0006) * (abs(z) + i * 0.0006) / 2)
        * CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * 0.0006 / 3 AS p
        FROM pairs, generate_series(0, 20000) AS g(i) GROUP BY arm_a, arm_b"""),
    ("flags", " UNION ALL ".join(_FLAGS)),
    ("power", f"""SELECT n AS n_per_arm_achieved, p AS baseline_completion_rate, CAST(0.05 AS DOUBLE) AS alpha,
        CAST(0.8 AS DOUBLE) AS target_power,
        ROUND(points, 2) AS achievable_mde_pp_at_80pct_power, points
        FROM (SELECT *, abs(pow(sin(({Z_SUM} / sqrt(n / 2.0::DOUBLE) + 2 * asin(sqrt(p))) / 2), 2) - p) * 100 AS points FROM (SELECT MIN(users_started) AS n,
              MAX(CASE WHEN test_group = 'A' THEN onboarding_completion_rate END) AS p FROM kpi))"""),
    ("signals", f"""SELECT (SELECT passes FROM srm_out) AS srm,
        MAX(CASE WHEN arm_a = 'A' AND arm_b = 'B' AND abs(z) > {Z} THEN 1 ELSE 0 END) AS ab,
        MAX(CASE WHEN arm_a = 'A' AND arm_b = 'C' AND abs(z) > {Z} THEN 1 ELSE 0 END) AS ac,
        MAX(CASE WHEN arm_a = 'B' AND arm_b = 'C' AND abs(z) > {Z} THEN 1 ELSE 0 END) AS bc,
        (SELECT CAST(SUM(flagged) AS INTEGER) FROM flags) AS n FROM pairs"""),
    ("verdicts", """SELECT CASE WHEN srm = 0 THEN 'HOLD' WHEN ab = 1 AND ac = 1 AND n = 0 THEN 'SHIP (Medium, Arm B)'
          WHEN ab = 1 AND n >= 2 THEN 'SHIP WITH MITIGATION (Arm B, not C)' ELSE 'SHIP WITH MITIGATION' END AS verdict,
        CASE WHEN srm = 0 THEN 'The split is off plan; fix the randomizer and run again before reading results'
          WHEN ab = 1 AND ac = 1 AND n = 0
            THEN 'B and C both beat control and no guardrail got worse; B is the smaller change'
          WHEN ab = 1 AND n >= 2 THEN 'B beats control; C got worse on ' || n || ' guardrails, so C needs a follow-up experiment'
          ELSE 'Ship only with the guardrails watched after launch' END AS reasoning,
        n AS guardrail_regression_count, greatest(ab, ac, bc) AS any_significant FROM signals"""),
]

_CHECKS = """
    SELECT 'raw_row_count' AS check_name, COUNT(*) AS value FROM landed
    UNION ALL SELECT 'staging_rejects', COUNT(*) FROM rejected
    UNION ALL SELECT 'staging_duplicate_event_ids', COUNT(*) FROM
      (SELECT event_id FROM staged GROUP BY event_id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'users_missing_install_event', COUNT(*) FROM users WHERE install_ts IS NULL
    UNION ALL SELECT 'orphan_fact_users', COUNT(*) FROM funnel f LEFT JOIN users u ON u.user_id = f.user_id
      WHERE u.user_id IS NULL
    UNION ALL SELECT 'completed_without_started', COUNT(*) FROM funnel
      WHERE completed_onboarding = 1 AND started_onboarding = 0
    UNION ALL SELECT 'activated_without_completed', COUNT(*) FROM funnel
      WHERE activated = 1 AND completed_onboarding = 0
    UNION ALL SELECT 'purchased_without_activated', COUNT(*) FROM funnel WHERE purchased = 1 AND activated = 0
    UNION ALL SELECT 'invalid_test_group_values', COUNT(*) FROM funnel WHERE test_group NOT IN ('A','B','C')
    UNION ALL SELECT 'mart_kpi_group_count', COUNT(*) FROM kpi
    UNION ALL SELECT 'negative_time_to_first_lesson', COUNT(*) FROM funnel WHERE time_to_first_lesson_seconds < 0
    UNION ALL SELECT 'kpi_rates_out_of_bounds', COUNT(*) FROM kpi
      WHERE onboarding_completion_rate NOT BETWEEN 0 AND 1
      OR (activation_rate IS NOT NULL AND activation_rate NOT BETWEEN 0 AND 1)
      OR (paid_conversion_rate IS NOT NULL AND paid_conversion_rate NOT BETWEEN 0 AND 1)"""

_CHAIN = _STAGING + _WAREHOUSE + _MARTS + _STATISTICS + [("checks", _CHECKS)]
_TS_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_DATE_TEXT = "strftime({0}, '%Y-%m-%d')"
_GATE = f"""SELECT check_name, value, CASE WHEN ok THEN 1 ELSE 0 END AS passed,
    CASE WHEN NOT ok THEN 'value ' || value || ' violates policy' END AS detail FROM (SELECT *,
      CASE check_name WHEN 'raw_row_count' THEN value > 0 WHEN 'mart_kpi_group_count' THEN value = 3
      ELSE value = 0 END AS ok FROM checks WHERE check_name IN ({', '.join(f"'{c}'" for c in POLICY)}))"""
_RECONCILED = """SELECT landed, staged, rejected, duplicates,
    CASE WHEN landed = staged + rejected + duplicates THEN 1 ELSE 0 END AS balanced FROM (SELECT
      (SELECT COUNT(*) FROM landed) AS landed, (SELECT COUNT(*) FROM staged) AS staged,
      (SELECT COUNT(*) FROM rejected) AS rejected,
      (SELECT COUNT(*) - COUNT(DISTINCT event_id) FROM valid) AS duplicates)"""

_CATALOG_ROWS = ", ".join(
    f"('{event}', '{key}')" for event, keys in EVENT_CATALOG.items() for key in keys
)


def _violations() -> str:
    steps = "event_name LIKE 'onboarding_step_%'"
    keep = "event_id, event_name, test_group"
    parts = [
        f"SELECT {keep}, 'unknown_event' AS code, event_name AS detail FROM staged "
        f"WHERE event_name NOT IN ({', '.join(repr(e) for e in EVENT_CATALOG)})",
        f"SELECT {', '.join('s.' + c.strip() for c in keep.split(','))}, 'missing_key', c.key FROM staged s "
        f"JOIN (VALUES {_CATALOG_ROWS}) AS c(event, key) ON c.event = s.event_name "
        "WHERE NOT list_contains(json_keys(s.properties), c.key)",
        f"SELECT {keep}, 'extra_key', key FROM (SELECT *, unnest(json_keys(properties)) AS key FROM staged) s "
        f"WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_CATALOG_ROWS}) AS c(event, key) "
        "WHERE c.event = s.event_name AND c.key = s.key)",
        f"SELECT {keep}, 'bad_step_number', CAST(step_number AS VARCHAR) FROM staged "
        f"WHERE {steps} AND (step_number BETWEEN 1 AND 13) IS NOT TRUE",
        f"SELECT {keep}, 'bad_relevance_score', CAST(relevance_score AS VARCHAR) FROM staged "
        "WHERE event_name = 'lesson_feedback_submitted' AND (relevance_score BETWEEN 1 AND 5) IS NOT TRUE",
        f"SELECT {keep}, 'step_outside_design', CAST(step_number AS VARCHAR) FROM staged s WHERE {steps} "
        "AND step_number BETWEEN 1 AND 13 AND NOT EXISTS (SELECT 1 FROM design d "
        "WHERE d.test_group = s.test_group AND d.step_number = s.step_number)",
        "SELECT s.event_id, s.event_name, s.test_group, 'step_name_mismatch', s.step_name FROM staged s "
        "JOIN design d ON d.test_group = s.test_group AND d.step_number = s.step_number "
        f"WHERE {steps.replace('event_name', 's.event_name')} AND d.step_name IS DISTINCT FROM s.step_name",
    ]
    for column, (event, allowed) in ENUMERATIONS.items():
        options = ", ".join(f"'{a}'" for a in allowed)
        parts.append(
            f"SELECT {keep}, 'bad_{column}', {column} FROM staged "
            f"WHERE event_name = '{event}' AND ({column} IN ({options})) IS NOT TRUE"
        )
    return " UNION ALL ".join(parts)


def _by_metric(metrics: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, " + ", ".join(
            f"CAST(MAX(CASE WHEN test_group = '{arm}' THEN {m} END) AS DOUBLE) AS \"{arm}\"" for arm in "ABC"
        ) + f" FROM {source}" for m in metrics
    )


_RUNS = f"""SELECT 'run_' || day AS run_id, started_at, finished_at,
    CAST(date_diff('second', date_trunc('second', CAST(started_at AS TIMESTAMP)),
      date_trunc('second', CAST(finished_at AS TIMESTAMP))) AS DOUBLE) AS duration_seconds,
    CASE WHEN rejected * 20 > n THEN 'failed_validation' ELSE 'success' END AS status,
    CAST(n % 3 AS INTEGER) AS retries_used,
    CASE WHEN rejected * 20 > n THEN NULL ELSE n END AS raw_row_count,
    CASE WHEN rejected * 20 > n THEN NULL ELSE rejected END AS staging_rejects,
    CASE WHEN rejected * 20 > n THEN 'staging_rejects: value ' || rejected || ' violates policy' END AS error
    FROM (SELECT substr(event_timestamp, 1, 10) AS day, MIN(event_timestamp) AS started_at,
      MAX(event_timestamp) AS finished_at, COUNT(*) AS n,
      COUNT(*) - COUNT(CASE WHEN {_VALID} THEN 1 END) AS rejected FROM landed GROUP BY 1)"""

_ASSIGNED = """SELECT user_id, CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS test_group,
    CASE WHEN (user_id // 3) % 2 = 0 THEN 'iOS' ELSE 'Android' END AS platform
    FROM (SELECT DISTINCT user_id FROM events)"""

_PROJECTED = """SELECT test_group AS scenario, CAST(100000 AS DOUBLE) AS users,
    onboarding_completion_rate AS completion_rate, paid_conversion_rate, CAST(30 AS DOUBLE) AS arpu,
    ROUND(100000.0::DOUBLE * onboarding_completion_rate, 2) AS completions,
    ROUND(100000.0::DOUBLE * onboarding_completion_rate * paid_conversion_rate, 2) AS paying_users,
    ROUND(100000.0::DOUBLE * onboarding_completion_rate * paid_conversion_rate * 30.0::DOUBLE, 2) AS revenue
    FROM kpi"""


def _delta(measure: str) -> str:
    b, a = (f"MAX(CASE WHEN scenario = '{s}' THEN {measure} END)" for s in "BA")
    return f"ROUND({b} - {a}, 2) AS {measure}_delta"


_STAGED_TEXT = f"""SELECT * REPLACE ({_TS_TEXT.format('event_timestamp')} AS event_timestamp,
    {_DATE_TEXT.format('event_date')} AS event_date) FROM """


_MART_FIELDS = {
    "kpi_by_group": ("kpi", ("test_group",), (
        "users_started", "users_completed", "onboarding_completion_rate", "users_activated", "activation_rate",
        "users_purchased", "paid_conversion_rate", "avg_time_to_first_lesson_seconds", "day1_return_rate",
        "day7_return_rate", "day30_return_rate")),
    "guardrails_by_group": ("guards", ("test_group",), (
        "avg_lesson_relevance_score", "refund_rate", "cancellation_rate", "support_ticket_rate",
        "notification_optin_rate")),
    "step_dropoff": ("dropoff", ("test_group", "step_number", "step_name"), (
        "step_bucket", "users_viewed", "users_completed", "users_abandoned", "step_abandon_rate")),
    "daily_funnel": ("daily", ("install_date", "test_group"), (
        "users_started", "users_completed", "onboarding_completion_rate")),
}


def _long(section: str, name: str, field: str, source: str) -> str:
    text = f"CAST({field} AS VARCHAR)"
    return (f"SELECT '{section}' AS section, {name} AS label, '{field}' AS field, TRY_CAST({text} AS DOUBLE) AS value, "
            f"CASE WHEN TRY_CAST({text} AS DOUBLE) IS NULL THEN {text} END AS text FROM {source}")


def _bundle() -> str:
    """Every field of every mart row."""
    parts = []
    for section, (source, order, rest) in _MART_FIELDS.items():
        name = " || '/' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '-')" for c in order)
        parts += [_long(section, name, field, source) for field in (*order, *rest)]
    return " UNION ALL ".join(parts)


def _whole_run() -> str:
    """Every field of the marts and of the report."""
    return (_bundle() + " UNION ALL SELECT 'dq_report', check_name, 'value', CAST(value AS DOUBLE), NULL "
            "FROM (SELECT * FROM checks UNION ALL " + " UNION ALL ".join(
                f"SELECT '{name}', 0" for name in UNIQUE_POLICY) + ")")


def _recorded(number: int, policy: dict[str, tuple[str, int]]) -> str:
    """What is recorded of a run over ``landed`` that is held to a policy."""
    return f"""SELECT CAST({number} AS INTEGER) AS run,
              CASE WHEN COUNT(*) > 0 THEN 'failed_validation' ELSE 'success' END AS status,
              CAST(0 AS INTEGER) AS retries_used, string_agg(check_name || ': ' || detail, '; ' ORDER BY check_name) AS error,
              CASE WHEN COUNT(*) = 0 THEN (SELECT COUNT(*) FROM landed) END AS raw_row_count,
              CASE WHEN COUNT(*) = 0 THEN (SELECT COUNT(*) FROM rejected) END AS staging_rejects
            FROM ({_GATE}) WHERE passed = 0 AND check_name IN ({', '.join(f"'{c}'" for c in policy)})"""


def _figures(section: str, prefix: str, source: str, numbers: dict[str, str], texts: dict[str, str]) -> list[str]:
    parts = [f"SELECT '{section}' AS section, {prefix} || '{name}' AS name, ROUND(CAST({column} AS DOUBLE), 8) AS value, "
             f"CAST(NULL AS VARCHAR) AS text FROM {source}" for name, column in numbers.items()]
    return parts + [f"SELECT '{section}', {prefix} || '{name}', CAST(NULL AS DOUBLE), {column} FROM {source}"
                    for name, column in texts.items()]


def _document() -> list[str]:
    """Every figure of the results document."""
    def same(*names: str) -> dict[str, str]:
        return {n: n for n in names}

    tested = "(SELECT pairs.*, tails.p FROM pairs JOIN tails USING (arm_a, arm_b))"
    low, high = "ROUND(absolute_diff - margin, 4)", "ROUND(absolute_diff + margin, 4)"
    numbers = same("rate_a", "rate_b", "absolute_diff", "relative_lift_pct") | {
        "diff_ci_low": low, "diff_ci_high": high, "diff_ci_95/0": low, "diff_ci_95/1": high,
        "z_statistic": "ROUND(z, 4)", "p_value": "p", "significant_at_05": f"CASE WHEN abs(z) > {Z} THEN 1 ELSE 0 END"}
    pair = "arm_a || '_vs_' || arm_b || '/'"
    parts = _figures("srm", "''", "srm_out", same("expected_per_arm", "chi2_statistic", "p_value", "passes"), {
        "interpretation": "CASE WHEN passes = 1 THEN 'Allocation is consistent with the planned split' "
                          "ELSE 'Sample ratio mismatch: check the randomizer and the logging first' END"})
    parts += _figures("power", "''", "power", same(
        "n_per_arm_achieved", "baseline_completion_rate", "alpha", "target_power", "achievable_mde_pp_at_80pct_power"), {
        "interpretation": "'At 80% power, arms of ' || n_per_arm_achieved || ' users show completion rates that differ by ' "
                          "|| format('{:.1f}', points) || ' points or more; smaller differences may be missed'"})
    parts += _figures("verdict", "''", "verdicts", {
        "guardrail_regression_count_C_vs_A": "guardrail_regression_count", "any_significant": "any_significant"},
        same("verdict", "reasoning"))
    parts += ["SELECT 'observed', test_group, CAST(users_started AS DOUBLE), NULL FROM kpi",
              "SELECT 'flags', CAST(ROW_NUMBER() OVER (ORDER BY CASE metric WHEN 'avg_lesson_relevance_score' THEN 0 "
              "WHEN 'refund_rate' THEN 1 WHEN 'support_ticket_rate' THEN 2 ELSE 3 END) - 1 AS VARCHAR), NULL, message "
              "FROM flags WHERE flagged = 1"]
    for section in ("pairwise", "supporting"):
        parts += _figures(section, pair, tested, numbers, same("arm_a", "arm_b", "label"))
    parts += _figures("per_arm", "test_group || '/'", "arms", same(
        "users_started", "users_completed", "completion_rate", "ci_95_low", "ci_95_high"), same("label"))
    for section, metrics, source in (("secondary", SECONDARY, "kpi"), ("guardrail", GUARDRAILS, "guards")):
        parts += [f"SELECT '{section}', '{m}/' || test_group, ROUND(CAST({m} AS DOUBLE), 8), NULL FROM {source}" for m in metrics]
    return parts


def _reach() -> str:
    """Users by the day they were first seen at a step, per kind of event, and running sums of them."""
    step, first, columns = "test_group, step_number, step_name", [], []
    for column, text in _DISTINCT.items():
        event = text.split("'")[1]
        first.append(f"COUNT(DISTINCT CASE WHEN step_event_type = '{event}' AND event_date = first_day THEN user_id END) AS new_{column}")
        columns.append(f"CAST(SUM(new_{column}) OVER (PARTITION BY {step} ORDER BY event_date) AS BIGINT) AS {column}")
    return f"""SELECT * REPLACE ({_DATE_TEXT.format('event_date')} AS event_date), {', '.join(columns)} FROM (
        SELECT event_date, {step}, {', '.join(first)} FROM (SELECT *, MIN(event_date) OVER (
          PARTITION BY {step}, step_event_type, user_id) AS first_day FROM steps) GROUP BY event_date, {step})"""


def _bodies() -> dict[str, str]:
    """Final SELECT of each statement over the named subqueries."""
    bundle = _bundle() + " UNION ALL SELECT 'stats', 'verdict', 'verdict', NULL, (SELECT verdict FROM verdicts)"
    results = " UNION ALL ".join(_document())
    pair = "SELECT arm_a, arm_b, "
    return {
        "landed_events": f"SELECT {_ENV}, _source_file, _ingest_seq FROM landed",
        "valid_events": f"SELECT {_ENV}, _ingest_seq FROM valid",
        "staged_events": f"{_STAGED_TEXT} staged",
        "rejects": f"SELECT {_ENV}, _ingest_seq, reject_reason, reject_codes FROM rejected",
        "rejects_strict_null": f"""SELECT {_ENV}, _ingest_seq, 'null_or_invalid_key' AS reject_reason,
            {_CODES} AS reject_codes FROM landed WHERE event_id IS NULL OR user_id IS NULL OR event_name IS NULL
            OR event_timestamp IS NULL OR test_group NOT IN ('A','B','C') OR platform NOT IN ('iOS','Android')""",
        "dedup_events": f"SELECT {_ENV}, _ingest_seq FROM dedup",
        "parsed_time": f"""SELECT event_id, _ingest_seq, {_TS_TEXT.format(_TS)} AS event_timestamp,
            {_DATE_TEXT.format(_TS)} AS event_date FROM landed""",
        "flattened_props": f"SELECT event_id, _ingest_seq, {_PAYLOAD} FROM landed",
        "contract_violations": _violations(), "contract_violations_by_file": _violations(),
        "stage_reconciliation": _RECONCILED,
        "dim_user": f"""SELECT * REPLACE ({_TS_TEXT.format('install_ts')} AS install_ts,
            {_DATE_TEXT.format('install_date')} AS install_date) FROM users""",
        "dim_date": f"""SELECT {_DATE_TEXT.format('d')} AS date_key, CAST(year(d) AS INTEGER) AS year,
            CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
            CAST(dayofweek(d) AS INTEGER) AS day_of_week,
            CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
            FROM (SELECT CAST(unnest(generate_series(MIN(event_date), MAX(event_date), INTERVAL 1 DAY)) AS DATE) AS d
                  FROM staged)""",
        "dim_step": """SELECT d.*, COUNT(s.event_id) AS step_events FROM design d LEFT JOIN steps s
            ON s.test_group = d.test_group AND s.step_number = d.step_number GROUP BY ALL""",
        "step_events": f"{_STAGED_TEXT} steps",
        "user_funnel": f"""SELECT * REPLACE ({_DATE_TEXT.format('install_date')} AS install_date,
            {_TS_TEXT.format('onboarding_started_ts')} AS onboarding_started_ts,
            {_TS_TEXT.format('onboarding_completed_ts')} AS onboarding_completed_ts,
            {_TS_TEXT.format('first_lesson_started_ts')} AS first_lesson_started_ts,
            ROUND(avg_relevance_score, 6) AS avg_relevance_score) FROM funnel""",
        "orphan_users": """SELECT f.user_id, f.test_group, f.platform FROM funnel f LEFT JOIN
            (SELECT * FROM users WHERE install_ts IS NOT NULL) u ON u.user_id = f.user_id WHERE u.user_id IS NULL""",
        "mart_kpi_by_group": "SELECT * FROM kpi",
        "mart_guardrails_by_group": "SELECT * FROM guards",
        "mart_step_dropoff": "SELECT * FROM dropoff",
        "mart_step_dropoff_by_bitmaps": "SELECT * FROM dropoff",
        "step_reach": _reach(),
        "mart_daily_funnel": f"SELECT * REPLACE ({_DATE_TEXT.format('install_date')} AS install_date) FROM daily",
        "dq_report": "SELECT * FROM checks",
        "dq_gate": _GATE,
        "dq_unique_keys": """SELECT 'dim_user_duplicate_user_ids' AS check_name, COUNT(*) AS value FROM
              (SELECT user_id FROM users GROUP BY user_id HAVING COUNT(*) > 1)
            UNION ALL SELECT 'dim_date_duplicate_date_keys', 0
            UNION ALL SELECT 'fact_user_funnel_duplicate_user_ids', COUNT(*) FROM
              (SELECT user_id FROM funnel GROUP BY user_id HAVING COUNT(*) > 1)""",
        "dirty_injection": _RECONCILED,
        "corrupt_arm_gate": _GATE,
        "srm_check": "SELECT * FROM srm_out",
        "wilson_ci": "SELECT * FROM arms",
        "ztest_pairs": pair + "label, ROUND(z, 4) AS z_statistic FROM pairs",
        "ztest_pvalues": pair + "ROUND(p, 8) AS p_value, ROUND(log10(p), 6) AS log10_p_value FROM tails",
        "diff_ci": pair + "absolute_diff, ROUND(absolute_diff - margin, 4) AS diff_ci_low, "
                          "ROUND(absolute_diff + margin, 4) AS diff_ci_high FROM pairs",
        "lift": pair + "rate_a, rate_b, relative_lift_pct FROM pairs",
        "significance": pair + f"CASE WHEN abs(z) > {Z} THEN 1 ELSE 0 END AS significant_at_05 FROM pairs",
        "secondary_metrics": _by_metric(SECONDARY, "kpi"),
        "guardrail_metrics": _by_metric(GUARDRAILS, "guards"),
        "regression_flags": "SELECT * FROM flags",
        "regression_flags_extended": " UNION ALL ".join(_FLAGS + _MORE_FLAGS),
        "power_recheck": "SELECT * EXCLUDE (points), 'At 80% power, arms of ' || n_per_arm_achieved || "
                         "' users show completion rates that differ by ' || format('{:.1f}', points) || "
                         "' points or more; smaller differences may be missed' AS interpretation FROM power",
        "recommendation": "SELECT * FROM verdicts",
        "required_sample_size": f"""SELECT test_group, p1 AS baseline, mde, CASE WHEN p2 <= 1 THEN
            ROUND(pow({Z} * sqrt(p1 + p2) * sqrt(1 - (p1 + p2) / 2) + 0.8416212335729143
              * sqrt(p1 * (1 - p1) + LEAST(p2, 1) * (1 - LEAST(p2, 1))), 2) / pow(p2 - p1, 2), 1)
            END AS users_per_arm FROM (SELECT test_group, onboarding_completion_rate AS p1,
              CAST(i AS DOUBLE) / 100 AS mde, onboarding_completion_rate + CAST(i AS DOUBLE) / 100 AS p2
              FROM kpi, generate_series(1, 10) AS g(i))""",
        "revenue_projection": _PROJECTED,
        "revenue_delta": f"""SELECT 'A' AS baseline, 'B' AS scenario, {_delta('completions')},
            {_delta('paying_users')}, {_delta('revenue')} FROM ({_PROJECTED})""",
        "panel_completion": """SELECT test_group, ROUND(completion_rate * 100, 2) AS rate_pct,
            ROUND(completion_rate * 100 - ci_95_low * 100, 2) AS error_low,
            ROUND(ci_95_high * 100 - completion_rate * 100, 2) AS error_high FROM arms""",
        "panel_guardrails": " UNION ALL ".join(
            f"SELECT test_group, '{m}' AS metric, ROUND({m} * {scale}, 3) AS value FROM guards"
            for m, scale in (("avg_lesson_relevance_score", 1), ("refund_rate", 100),
                             ("support_ticket_rate", 100), ("notification_optin_rate", 100))
        ),
        "panel_step_series": "SELECT test_group, step_number, ROUND(step_abandon_rate * 100, 2) AS abandon_pct FROM dropoff",
        "panel_daily_trend": f"""SELECT test_group, {_DATE_TEXT.format('install_date')} AS install_date,
            strftime(install_date, '%m-%d') AS day_label, ROUND(onboarding_completion_rate * 100, 2) AS rate_pct
            FROM daily""",
        "panel_kpi_cards": f"""SELECT {_SHORT.format('test_group')} AS card,
              format('{{:.1f}}%', completion_rate * 100) AS headline,
              format('n={{:,}}  CI[{{:.1f}}, {{:.1f}}]%', users_started, ci_95_low * 100, ci_95_high * 100) AS detail
            FROM arms UNION ALL SELECT 'SRM check', CASE WHEN passes = 1 THEN 'passes' ELSE 'fails' END,
              'chi2=' || CAST(chi2_statistic AS VARCHAR) || ', p=' || CAST(p_value AS VARCHAR) FROM srm_out""",
        "assign_arms": _ASSIGNED,
        "arm_balance": f"""SELECT test_group, COUNT(CASE WHEN platform = 'iOS' THEN 1 END) AS users_ios,
            COUNT(CASE WHEN platform = 'Android' THEN 1 END) AS users_android FROM ({_ASSIGNED}) GROUP BY test_group""",
        "run_history_roundtrip": _RUNS,
        "run_health": f"""SELECT COUNT(*) AS recent_runs,
            ROUND(COUNT(CASE WHEN status = 'success' THEN 1 END) * 100.0::DOUBLE / COUNT(*), 2) AS success_rate_pct,
            ROUND(COALESCE(AVG(CASE WHEN status = 'success' THEN duration_seconds END), 0), 2) AS avg_success_duration,
            arg_max(run_id, started_at) AS latest_run_id, arg_max(status, started_at) AS latest_status,
            MAX(CASE WHEN rn = 1 THEN error END) AS latest_error,
            CASE WHEN arg_max(status, started_at) <> 'success' OR (COUNT(*) >= 5 AND
              COUNT(CASE WHEN status = 'success' THEN 1 END) * 100.0 / COUNT(*) < 70) THEN 1 ELSE 0 END AS unhealthy
            FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY started_at DESC) AS rn FROM ({_RUNS})) WHERE rn <= 10""",
        "csv_roundtrip": f"SELECT {_ENV} FROM landed",
        "csv_raw_line_breaks": f"""SELECT * REPLACE (replace(properties, ',', chr(10)) || chr(10) || chr(10) AS properties)
            FROM (SELECT {_ENV} FROM landed)""",
        "streamed_landing": f"SELECT {_ENV} FROM landed",
        "layer_roundtrip": f"""SELECT event_id, user_id, event_name, {_TS_TEXT.format('event_timestamp')} AS event_timestamp,
            {_DATE_TEXT.format('event_date')} AS event_date, step_number FROM staged""",
        "read_dim_step": """SELECT l.test_group, m.step_number, m.step_name, m.step_bucket FROM
            (SELECT test_group, MAX(total_steps_in_flow) AS steps FROM staged GROUP BY 1) l JOIN
            (SELECT DISTINCT step_number, step_name, step_bucket FROM staged WHERE event_name = 'onboarding_step_viewed') m
            ON m.step_number <= l.steps""",
        "read_event_catalog": """SELECT DISTINCT event_name, unnest(CASE WHEN len(json_keys(properties)) = 0
            THEN [NULL] ELSE json_keys(properties) END) AS property FROM landed""",
        "export_bundle": bundle,
        "results_document": results,
        "full_refresh": _whole_run(), "late_day_marts": _whole_run(),
        "refresh_history": " UNION ALL ".join([
            _recorded(1, POLICY), _recorded(2, ORDERLESS),
            f"SELECT * FROM ({_with(_recorded(3, POLICY), _journeys() + _CHAIN)})"]),
        "late_day_dates": """SELECT strftime(event_date, '%Y-%m-%d') AS event_date, COUNT(*) AS n_rows,
            CASE WHEN event_date = MIN(event_date) OVER () THEN 1 ELSE 0 END AS rewritten FROM staged GROUP BY event_date""",
        "staged_strict_null": f"{_STAGED_TEXT} staged",
        "srm_missing_arm": """SELECT observed, expected_per_arm, ROUND(chi2, 4) AS chi2_statistic,
            ROUND(exp(-chi2 / 2), 4) AS p_value, CASE WHEN exp(-chi2 / 2) >= 0.001 THEN 1 ELSE 0 END AS passes FROM srm_two""",
        "assign_arms_by_hash": "SELECT DISTINCT 'u_' || user_id AS user_id, 1 AS arm_fits, 1 AS platform_fits FROM events",
        "required_fields": " UNION ALL ".join(
            f"SELECT '{c}' AS field, COUNT(*) - COUNT({c}) AS rows_without FROM landed"
            for c in ("event_id", "user_id", "event_name", "event_timestamp", "test_group", "platform")),
    }


def statements() -> dict[str, str]:
    sources = {
        "corrupt_arm_gate": _landed(arm="'INVALID'"), "dirty_injection": _landed(injected=True),
    }
    return {name: _with(body, sources.get(name, _landed()) + _CHAIN) for name, body in _bodies().items()}


def _with(body: str, parts: list[tuple[str, str]]) -> str:
    """A statement with the subqueries it uses before it."""
    needed = _needed(body, parts)
    head = ", ".join(f"{n} AS ({text})" for n, text in parts if n in needed)
    return f"WITH {head} {body}" if head else body


def _needed(body: str, parts: list[tuple[str, str]]) -> set[str]:
    """Names of the subqueries a statement uses, directly or through others."""
    import re

    texts, found, queue = dict(parts), set(), [body]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in texts.keys() & words - found:
            found.add(name)
            queue.append(texts[name])
    return found
