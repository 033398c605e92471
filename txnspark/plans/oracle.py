"""The batch queries in SQL, for an engine that shares no code with Spark."""

from __future__ import annotations

from txnspark import schemas as S
from txnspark.functions.scalars import DNS_NAMESPACE
from txnspark.plans.views import NEXT_DAY, SEED_DAY, TIER_CUTS


def _list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


RISKY = _list(S.RISKY_IPS)
MOVES = _list(S.BALANCE_EVENT_TYPES)
# What the view over the events table knows; the encoder finds these in its training rows.
VIEW_TYPES = ("TRANSFER", "WITHDRAW", "DEPOSIT", "VIEW_BALANCE", "LOGIN_FAILED")
DEBITS = _list(S.DEBIT_EVENT_TYPES)


def U(key: str, salt: str, low: float = 0.0, high: float = 1.0) -> str:
    unit = f"(CAST(('0x' || substr(md5({key} || '|{salt}'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"
    return f"(({float(low)!r})::DOUBLE + {unit} * ({float(high) - float(low)!r})::DOUBLE)"


def UUID5(value: str) -> str:
    h = f"sha1(from_hex('{DNS_NAMESPACE}') || encode({value}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def LEVEL(score: str) -> str:
    return (
        f"CASE WHEN {score} > 90 THEN 'CRITICAL' WHEN {score} > 80 THEN 'HIGH' "
        f"WHEN {score} > 50 THEN 'MEDIUM' ELSE 'LOW' END"
    )


def SIGNED(amount: str = "amount") -> str:
    return (
        f"(CASE WHEN event_type IN ({DEBITS}) THEN -{amount} WHEN event_type = 'DEPOSIT' THEN {amount} "
        f"ELSE 0 END)"
    )


RATIOS = """round(coalesce({tp} / nullif({tp} + {fp}, 0)::DOUBLE, 0), 9) AS "precision",
  round(coalesce({tp} / nullif({tp} + {fn}, 0)::DOUBLE, 0), 9) AS recall,
  round(coalesce(2.0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0)::DOUBLE, 0), 9) AS f1"""

CTES = {
    "bank_events": f"""
      SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, et AS event_type,
        CAST(CASE WHEN et IN ({MOVES}) THEN value * 1000 ELSE 0 END AS DECIMAL(18,2)) AS amount,
        CASE k WHEN 97 THEN '{S.RISKY_IPS[0]}' WHEN 98 THEN '{S.RISKY_IPS[1]}' WHEN 99 THEN '{S.RISKY_IPS[2]}'
             ELSE concat('172.16.0.', CAST(k AS VARCHAR)) END AS ip_address,
        TRUE AS is_simulated, ts AS event_timestamp,
        ts + (event_id % 30) * INTERVAL 1 SECOND AS ingested_at, CAST(ts AS DATE) AS event_date,
        event_id AS n
      FROM (SELECT *, CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'click' THEN 'WITHDRAW'
                WHEN 'signup' THEN 'DEPOSIT' WHEN 'view' THEN 'VIEW_BALANCE' ELSE 'LOGIN_FAILED' END AS et,
              CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "bronze_events": """
      SELECT * EXCLUDE (copy) REPLACE (ingested_at + copy * INTERVAL 5 SECOND AS ingested_at)
      FROM (SELECT *, 'banking_events' AS kafka_topic, CAST(n % 3 AS INT) AS kafka_partition,
              n // 3 AS kafka_offset FROM bank_events) e,
           (VALUES (0), (1)) c(copy)
      WHERE copy = 0 OR n % 50 = 0""",
    "silver": f"""
      SELECT event_id AS transaction_id, user_id AS account_id, user_id, event_type, amount,
        '{S.CURRENCY}' AS currency, ip_address, is_simulated, event_timestamp, ingested_at, event_date
      FROM bronze_events WHERE event_type IN ({MOVES})
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp, ingested_at) = 1""",
    "bots": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM events WHERE user_id % 20 = 0",
    "alerts": f"""
      SELECT event_id || '-' || copy AS alert_id, user_id, user_id AS account_id,
        event_id AS transaction_id, event_id AS source_event_id, risk_score, challenger_score,
        CASE WHEN risk_score > 0.93 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level,
        CASE WHEN CAST(user_id AS BIGINT) % 20 = 0 THEN '{S.RULE_BOT}' ELSE '{S.RULE_RISKY_IP}' END AS rule_name,
        '{S.ALERT_MESSAGE_PREFIX}' || ip_address AS alert_message,
        n % 5 = 0 AS is_acknowledged, event_timestamp AS detected_at, event_timestamp AS created_at
      FROM (SELECT *, CAST(round({U("event_id", "risk", 0.82, 0.9999)}, 4) AS DECIMAL(5,4)) AS risk_score,
              CAST(round({U("event_id", "chal", 75.0, 99.9)}, 2) AS DECIMAL(5,2)) AS challenger_score
            FROM bank_events
            WHERE event_type IN ({DEBITS}) AND (CAST(user_id AS BIGINT) % 20 = 0 OR ip_address IN ({RISKY}))) e,
           (VALUES (1), (2)) c(copy)
      WHERE copy = 1 OR n % 7 = 0""",
    "labelled": f"""
      SELECT e.*, CAST(e.user_id IN (SELECT user_id FROM bots) OR ip_address IN ({RISKY}) AS INT) AS is_fraud
      FROM bank_events e""",
    "tier_history": f"""
      SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS event_date,
        CASE WHEN max(o_totalprice) < {TIER_CUTS[0]} THEN 'Normal'
             WHEN max(o_totalprice) < {TIER_CUTS[1]} THEN 'Silver' ELSE 'Gold' END AS membership_tier
      FROM orders GROUP BY 1, 2""",
    "assets": f"""
      SELECT CAST(event_timestamp AS DATE) AS day_bucket,
        CAST(sum(CASE WHEN blocked THEN 0 ELSE amount END) AS DECIMAL(18,2)) AS valid_amount,
        CAST(sum(CASE WHEN blocked THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS blocked_amount
      FROM (SELECT t.*, (transaction_id IN (SELECT source_event_id FROM alerts) OR ip_address IN ({RISKY})) AS blocked
            FROM silver t) GROUP BY 1""",
    "heatmap": """
      SELECT CAST(isodow(event_timestamp) AS INT) AS weekday, CAST(hour(event_timestamp) AS INT) AS hour_bucket,
        count(*) AS transaction_count FROM silver GROUP BY 1, 2""",
    "points": f"""
      SELECT event_id AS alert_id, user_id,
        CAST(CASE WHEN ip_address IN ({RISKY}) THEN {U("event_id", "champion", 10, 45)}
             WHEN amount > 80000 THEN {U("event_id", "champion", 80, 99)}
             ELSE {U("event_id", "champion", 5, 70)} END AS DECIMAL(5,2)) AS xgboost_score,
        CAST(CASE WHEN ip_address IN ({RISKY}) THEN {U("event_id", "challenger", 91, 99)}
             WHEN amount > 80000 THEN {U("event_id", "challenger", 80, 99)}
             ELSE {U("event_id", "challenger", 5, 75)} END AS DECIMAL(5,2)) AS iforest_score,
        CASE WHEN ip_address IN ({RISKY}) THEN 'CRITICAL' WHEN amount > 80000 THEN 'HIGH' ELSE 'LOW' END AS risk_level,
        event_timestamp AS detected_at
      FROM (SELECT * FROM bank_events ORDER BY md5(event_id), event_id LIMIT 1000)""",
    "messages": """
      SELECT e.*, n % 97 = 0 AS is_cut, n % 89 = 0 AS lacks_user FROM bank_events e""",
    "snapshot_all": "SNAPSHOT",
    "snapshot_seed": "SNAPSHOT",
    "history": f"""
      SELECT s.account_id, s.user_id, s.balance, s.account_status, s.status_reason,
        TIMESTAMP '{SEED_DAY}' AS valid_from,
        CASE WHEN changed THEN TIMESTAMP '{NEXT_DAY}' END AS valid_to, NOT changed AS is_current,
        s.source_event_id, 'seed' AS batch_id, TIMESTAMP '{SEED_DAY}' AS created_at
      FROM (SELECT s.*, coalesce(a.account_id IS NOT NULL AND (s.balance IS DISTINCT FROM a.balance
              OR s.account_status IS DISTINCT FROM a.account_status), FALSE) AS changed
            FROM snapshot_seed s LEFT JOIN snapshot_all a USING (account_id)) s
      UNION ALL
      SELECT a.account_id, a.user_id, a.balance, a.account_status, a.status_reason,
        TIMESTAMP '{NEXT_DAY}', NULL, TRUE, a.source_event_id, 'next', TIMESTAMP '{NEXT_DAY}'
      FROM snapshot_all a LEFT JOIN snapshot_seed s USING (account_id)
      WHERE s.account_id IS NULL OR s.balance IS DISTINCT FROM a.balance
         OR s.account_status IS DISTINCT FROM a.account_status""",
    "rolled": "ROLLED",
    "recent": "ROLLED",
    "featured": """
      SELECT r.*, l.is_fraud, CAST(hour(r.event_timestamp) AS INT) AS hour_of_day
      FROM rolled r JOIN labelled l USING (event_id)""",
    "ranked": """
      SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(event_id || '|split'), event_id) AS rk,
        count(*) OVER (PARTITION BY is_fraud) AS label_rows FROM labelled""",
    "split": "SELECT event_id, is_fraud, rk <= floor(label_rows * 0.2::DOUBLE + 0.5) AS is_test FROM ranked",
    "known_ips": f"""
      SELECT DISTINCT ip_address FROM bank_events
      WHERE event_timestamp < TIMESTAMP '{SEED_DAY}' AND ip_address NOT IN ({RISKY}) AND ip_address NOT LIKE '%7'""",
    "stateful": f"""
      SELECT r.*, ip_address NOT IN (SELECT ip_address FROM known_ips) AS is_unknown_ip,
        {U("event_id", "model")} AS probability FROM recent r""",
    "paired": f"""
      SELECT *, CASE WHEN champion_score > 70 AND challenger < champion_score - 25
          THEN round(champion_score * {U("event_id", "lift", 0.75, 0.88)}, 2) ELSE challenger END AS challenger_score
      FROM (SELECT *, CASE WHEN is_unknown_ip THEN 99.0::DOUBLE ELSE round(probability * 100, 2) END AS champion_score,
          CASE WHEN is_unknown_ip THEN 95.0::DOUBLE ELSE round({U("event_id", "forest", 0, 100)}, 2) END AS challenger
          FROM stateful)""",
    "judged": f"""
      SELECT *, round({U("event_id", "judge", 0, 65)} + is_fraud * 35, 1) AS score FROM labelled""",
    "evaluated": f"""
      SELECT *, CASE WHEN amount > 100000 THEN TRUE
          WHEN event_type = 'TRANSFER' AND amount > 50000 THEN {U("event_id", "champion")} < 0.7
          ELSE {U("event_id", "champion")} < 0.05 END AS champion_is_fraud,
        CASE WHEN ip_address IN ({RISKY}) THEN TRUE
          WHEN event_type IN ({DEBITS}) AND amount > 75000 THEN {U("event_id", "challenger")} < 0.6
          ELSE {U("event_id", "challenger")} < 0.08 END AS challenger_is_fraud
      FROM bank_events""",
    "curve": """
      SELECT threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS predicted, pos,
        sum(pos) OVER () AS positives
      FROM (SELECT score AS threshold, sum(is_fraud) AS pos, count(*) AS n FROM judged GROUP BY 1)
      WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)""",
    "sweep": f"""
      SELECT threshold, tp, fp, fn, {RATIOS.format(tp="tp", fp="fp", fn="fn")}
      FROM (SELECT CAST(t AS INT) AS threshold, count(*) FILTER (score > t AND is_fraud = 1) AS tp,
              count(*) FILTER (score > t AND is_fraud = 0) AS fp,
              count(*) FILTER (score <= t AND is_fraud = 1) AS fn
            FROM judged, range(0, 101) r(t) GROUP BY 1)""",
    "confused": """
      SELECT count(*) FILTER (score > 60 AND is_fraud = 1) AS tp, count(*) FILTER (score > 60 AND is_fraud = 0) AS fp,
        count(*) FILTER (score <= 60 AND is_fraud = 1) AS fn, count(*) FILTER (score <= 60 AND is_fraud = 0) AS tn
      FROM judged""",
    "steps": """
      SELECT user_id, CAST(event_timestamp AS DATE) AS day, event_type, count(*) AS steps,
        min(event_timestamp) AS first_at FROM bank_events GROUP BY 1, 2, 3""",
    "days": "SELECT DISTINCT user_id, CAST(event_timestamp AS DATE) AS d FROM bank_events",
}


def _snapshot(until: str | None) -> str:
    events = "TRUE" if until is None else f"event_timestamp < TIMESTAMP '{until}'"
    flags = "TRUE" if until is None else f"detected_at < TIMESTAMP '{until}'"
    return f"""
      SELECT u.user_id AS account_id, u.user_id,
        CAST({S.OPENING_BALANCE} + coalesce(moved, 0) AS DECIMAL(18,2)) AS balance,
        CASE WHEN f.user_id IS NOT NULL THEN 'LOCKED' ELSE 'ACTIVE' END AS account_status,
        CASE WHEN f.user_id IS NOT NULL THEN '{S.LOCK_REASON}' END AS status_reason,
        last_id AS source_event_id
      FROM (SELECT DISTINCT user_id FROM bank_events WHERE {events}) u
      LEFT JOIN (SELECT user_id, sum({SIGNED()}) AS moved FROM bank_events
                 WHERE event_type IN ({MOVES}) AND {events} GROUP BY 1) b USING (user_id)
      LEFT JOIN (SELECT user_id, event_id AS last_id FROM bank_events
                 WHERE event_type IN ({MOVES}) AND {events}
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id DESC) = 1
                ) l USING (user_id)
      LEFT JOIN (SELECT DISTINCT user_id FROM alerts
                 WHERE risk_level IN ('HIGH', 'CRITICAL') AND {flags}) f ON f.user_id = u.user_id"""


def _rolled(seconds: int, zero_average: float) -> str:
    return f"""
      SELECT *, CASE WHEN amount_avg_1h = 0 THEN {zero_average!r}
          ELSE amount::DOUBLE / amount_avg_1h::DOUBLE END AS amount_vs_avg
      FROM (SELECT *, CAST((((total * 100)::HUGEINT * 20000 + tx_count_1h) // (2 * tx_count_1h)) / 1000000.0
              AS DECIMAL(22,6)) AS amount_avg_1h
            FROM (SELECT *, count(*) OVER w AS tx_count_1h, sum(amount) OVER w AS total FROM bank_events
                  WINDOW w AS (PARTITION BY user_id ORDER BY CAST(floor(epoch(event_timestamp)) AS BIGINT)
                               RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)))"""


CTES["snapshot_all"] = _snapshot(None)
CTES["snapshot_seed"] = _snapshot(SEED_DAY)
CTES["rolled"] = _rolled(3600, 0.0)
CTES["recent"] = _rolled(300, 1.0)


def with_ctes(select: str) -> str:
    """The select with those of the common tables in front that it needs."""
    import re

    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    ordered = [name for name in _order() if name in needed]
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + select


def _order() -> list[str]:
    import re

    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in CTES:
            if other != name and re.search(rf"\b(FROM|JOIN)\s+{other}\b", CTES[name]):
                visit(other)
        done.append(name)

    for name in CTES:
        visit(name)
    return done


LOCAL = "strftime(detected_at + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')"
ALERT_HEAD = f"{UUID5(chr(39) + 'alert|' + chr(39) + ' || event_id')} AS alert_id, user_id"

THROUGHPUT = """SELECT date_trunc('minute', event_timestamp) AS minute_bucket, count(*) AS event_count,
      CAST(avg(epoch_us(ingested_at) - epoch_us(event_timestamp)) / 1e6 AS DECIMAL(8,3)) AS avg_latency_seconds
    FROM silver WHERE event_timestamp >= (SELECT max(event_timestamp) - INTERVAL {period} FROM silver) GROUP BY 1"""

AUDIT = f"""SELECT user_id, event_id, event_type, amount, CAST({SIGNED()} AS DECIMAL(18,2)) AS balance_delta,
      CAST({S.OPENING_BALANCE} + sum({SIGNED()}) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id
        ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS running_balance, event_timestamp
    FROM bank_events WHERE event_type IN ({MOVES})"""

TIERS = """SELECT user_id, membership_tier, start_date,
      lead(start_date) OVER w AS end_date, lead(start_date) OVER w IS NULL AS is_current
    FROM (SELECT user_id, membership_tier, streak, min(event_date) AS start_date
          FROM (SELECT *, sum(CASE WHEN previous IS NULL OR previous <> membership_tier THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY event_date) AS streak
                FROM (SELECT *, lag(membership_tier) OVER (PARTITION BY user_id ORDER BY event_date) AS previous
                      FROM tier_history)) GROUP BY 1, 2, 3)
    WINDOW w AS (PARTITION BY user_id ORDER BY start_date)"""

ROLLED = """SELECT event_id, user_id, tx_count_1h, amount_avg_1h, round(amount_vs_avg, 6) AS amount_vs_avg FROM rolled"""

JOURNEYS = """SELECT user_id, string_agg(CAST(day AS VARCHAR) || ' ' || event_type || ' x' || steps, ' > '
      ORDER BY day, first_at, event_type, steps) AS journey FROM steps GROUP BY 1"""

JOURNEY_PAGES = """SELECT user_id, page, count(*) AS events,
      string_agg(event_id || ' ' || event_type, ' > ' ORDER BY event_timestamp, event_id) AS steps
    FROM (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) - 1) // 50 AS page
          FROM bank_events) GROUP BY 1, 2"""

_BITS = "SELECT user_id, bit_or(CAST(1 AS BIGINT) << CAST(31 - age AS INT)) AS datelist_int FROM (SELECT user_id, date_diff('day', d, (SELECT max(d) FROM days)) AS age FROM days) WHERE age BETWEEN 0 AND 31 GROUP BY 1"


def _active(span: int) -> str:
    mask = ((1 << span) - 1) << (32 - span)
    return f"bit_count(datelist_int & {mask}::BIGINT)"


SQL = {
    "bronze_from_json": """SELECT event_id, event_timestamp, user_id, event_type,
        CASE WHEN n % 11 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END AS amount,
        CASE WHEN n % 13 = 0 THEN '0.0.0.0' ELSE ip_address END AS ip_address, is_simulated,
        'banking_events' AS kafka_topic, CAST(n % 3 AS INT) AS kafka_partition, n // 3 AS kafka_offset,
        TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, event_date
      FROM messages WHERE NOT is_cut AND NOT lacks_user""",
    "quarantined_messages": """SELECT CASE WHEN is_cut THEN substr(raw, 1, 40) ELSE raw END AS raw_message,
        'banking_events' AS kafka_topic, CAST(n % 3 AS INT) AS kafka_partition, n // 3 AS kafka_offset,
        TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
      FROM (SELECT *, '{"event_id":"' || event_id || '","timestamp":"' ||
              strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') || '"' ||
              CASE WHEN lacks_user THEN '' ELSE ',"user_id":"' || user_id || '"' END ||
              ',"event_type":"' || event_type || '"' ||
              CASE WHEN n % 11 = 0 THEN '' ELSE ',"amount":' || amount END ||
              CASE WHEN n % 13 = 0 THEN '' ELSE ',"ip_address":"' || ip_address || '"' END ||
              ',"is_simulated":true}' AS raw FROM messages)
      WHERE is_cut OR lacks_user""",
    "silver_transactions": "SELECT * FROM silver",
    "gold_throughput": THROUGHPUT.format(period="1 HOUR"),
    "gold_heatmap": "SELECT * FROM heatmap",
    "gold_protected_assets": """SELECT * FROM assets
      WHERE day_bucket > (SELECT CAST(max(event_timestamp) - INTERVAL 7 DAY AS DATE) FROM silver)""",
    "gold_divergence": "SELECT * FROM points",
    "balance_audit": AUDIT,
    "balance_audit_split_keys": AUDIT,
    "account_snapshot": "SELECT * FROM snapshot_all",
    "last_event_snapshot": f"""SELECT user_id AS account_id, user_id, amount AS balance,
        CASE WHEN round({U("event_id", "risk", 0, 100)}, 2) > 80 THEN 'LOCKED' ELSE 'ACTIVE' END AS account_status,
        '{S.MICRO_BATCH_REASON}' AS status_reason, event_id AS source_event_id
      FROM bank_events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id DESC) = 1""",
    "merged_history": "SELECT * FROM history",
    "stored_history": "SELECT * FROM history",
    "account_history_current": "SELECT * FROM history WHERE is_current",
    "account_history_newest": "SELECT * FROM history ORDER BY created_at DESC, account_id, valid_from DESC LIMIT 5",
    "account_timelines": """SELECT account_id, balance, account_status, valid_from, valid_to, is_current, batch_id
      FROM history ORDER BY account_id, valid_from, created_at""",
    "account_history_violations": """SELECT account_id, count(*) FILTER (open) AS current_versions
      FROM (SELECT *, CAST(user_id AS BIGINT) % 7 <> 0 AND (is_current OR valid_to IS NOT NULL) AS open FROM history)
      GROUP BY 1 HAVING count(*) FILTER (open) <> 1""",
    "tier_versions": TIERS,
    "tier_versions_split_keys": TIERS,
    "fraud_labels": "SELECT event_id, user_id, ip_address, is_fraud FROM labelled",
    "rolling_features": ROLLED,
    "rolling_features_split_keys": ROLLED,
    "training_features": """SELECT event_type, amount, ip_address, is_fraud, tx_count_1h, amount_avg_1h,
        round(amount_vs_avg, 6) AS amount_vs_avg, hour_of_day FROM featured""",
    "encoded_features": "SELECT event_id, CAST(tx_count_1h AS INT) AS tx_count_1h, hour_of_day, "
    "CAST(coalesce(freq, 0) AS INT) AS ip_address_freq, "
    + "round(CAST(amount AS FLOAT)::DOUBLE, 2) AS amount, round(CAST(amount_avg_1h AS FLOAT)::DOUBLE, 2) AS amount_avg_1h, "
    "round(CAST(amount_vs_avg AS FLOAT)::DOUBLE, 2) AS amount_vs_avg, "
    + ", ".join(f"CAST(event_type = '{t}' AS INT) AS event_type_{t.lower()}" for t in VIEW_TYPES)
    + """ FROM featured JOIN split s USING (event_id) LEFT JOIN (
          SELECT ip_address, count(*) AS freq FROM bank_events JOIN split USING (event_id)
          WHERE NOT is_test GROUP BY 1) f USING (ip_address) WHERE s.is_test""",
    "ip_frequencies": "SELECT ip_address, count(*) AS frequency FROM bank_events GROUP BY 1",
    "seeded_users": f"""SELECT DISTINCT user_id, 'User ' || substr(user_id, 1, 8) AS display_name,
        substr(user_id, 1, 8) || '{S.EMAIL_SUFFIX}' AS email, '{S.SEED_PHONE}' AS phone, TRUE AS is_simulated
      FROM bank_events""",
    "seeded_accounts": f"""SELECT {UUID5("user_id")} AS account_id, user_id,
        substr(replace(user_id, '-', ''), 1, 32) AS account_number, '{S.CURRENCY}' AS currency,
        CAST({S.ACCOUNT_SEED_BALANCE} AS DECIMAL(18,2)) AS balance, 'ACTIVE' AS status,
        '{S.SEED_REASON}' AS status_reason FROM (SELECT DISTINCT user_id FROM bank_events)""",
    "backfilled_alerts": f"""SELECT {ALERT_HEAD}, {UUID5("user_id")} AS account_id, event_id AS source_event_id,
        risk AS risk_score, CAST({U("event_id", "chal", 75.0, 99.9)} AS DECIMAL(5,2)) AS challenger_score,
        CASE WHEN risk > 0.93 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level,
        CASE WHEN user_id IN (SELECT user_id FROM bots) THEN '{S.RULE_BOT}' ELSE '{S.RULE_RISKY_IP}' END AS rule_name,
        '{S.ALERT_MESSAGE_PREFIX}' || ip_address AS alert_message, FALSE AS is_acknowledged,
        event_timestamp AS detected_at, event_timestamp AS created_at
      FROM (SELECT *, CAST({U("event_id", "risk", 0.82, 0.9999)} AS DECIMAL(5,4)) AS risk FROM labelled)
      WHERE event_type IN ({DEBITS}) AND is_fraud = 1""",
    "acknowledged_alerts": f"""SELECT alert_id, user_id, is_acknowledged OR user_id IN
        (SELECT user_id FROM alerts WHERE detected_at < TIMESTAMP '{SEED_DAY}') AS is_acknowledged FROM alerts""",
    "model_disagreement": """SELECT count(*) FILTER (champion_is_fraud <> challenger_is_fraud) AS disagreements,
        count(*) AS events FROM evaluated""",
    "model_evaluation_rows": """SELECT event_id, user_id, event_type, amount, champion_is_fraud, challenger_is_fraud,
        'batch-1' AS batch_id, TIMESTAMP '2024-02-01 00:00:00' AS evaluated_at FROM evaluated""",
    "random_risk_scores": f"""SELECT event_id, round({U("event_id", "risk", 0, 100)}, 2) AS risk_score,
        round({U("event_id", "risk", 0, 100)}, 2) > 80 AS is_fraud FROM bank_events""",
    "stateless_alerts": f"""SELECT {ALERT_HEAD}, event_id AS source_event_id,
        CAST(score / 100 AS DECIMAL(5,4)) AS risk_score,
        CAST(CASE WHEN ip_address IN ({RISKY}) THEN {U("event_id", "chal", 75.0, 99.9)}
             WHEN amount > 75000 THEN {U("event_id", "chal", 60.0, 85.0)}
             ELSE {U("event_id", "chal", 5.0, 45.0)} END AS DECIMAL(5,2)) AS challenger_score,
        {LEVEL("score")} AS risk_level, '{S.RULE_STATELESS}' AS rule_name,
        '{S.RULE_STATELESS} flagged ' || event_type || ' amount=' || amount || ' ip=' || ip_address AS alert_message,
        FALSE AS is_acknowledged, event_timestamp AS detected_at
      FROM (SELECT *, contains(ip_address, '10.0.0.88') AS hit, {U("event_id", "model")} AS p,
              CASE WHEN contains(ip_address, '10.0.0.88') THEN 99.0::DOUBLE ELSE {U("event_id", "model")} * 100 END AS score
            FROM bank_events) WHERE hit OR p > 0.5""",
    "stateful_alerts": f"""SELECT {ALERT_HEAD}, event_id AS source_event_id,
        CAST(score / 100 AS DECIMAL(5,4)) AS risk_score,
        CAST(CASE WHEN is_unknown_ip THEN 95.0::DOUBLE
             WHEN ip_address IN ({RISKY}) THEN {U("event_id", "chal", 80.0, 99.9)}
             ELSE score * {U("event_id", "chal", 0.8, 0.9)} END AS DECIMAL(5,2)) AS challenger_score,
        {LEVEL("score")} AS risk_level, rule AS rule_name,
        rule || ' flagged ' || event_type || ' amount=' || amount || ' ip=' || ip_address AS alert_message,
        FALSE AS is_acknowledged, event_timestamp AS detected_at
      FROM (SELECT *, CASE WHEN is_unknown_ip THEN 99.0::DOUBLE ELSE probability * 100 END AS score,
              CASE WHEN is_unknown_ip OR ip_address IN ({RISKY}) THEN '{S.RULE_UNKNOWN_IP}'
                   ELSE '{S.RULE_CHAMPION}' END AS rule
            FROM stateful) WHERE is_unknown_ip OR probability > 0.8336""",
    "paired_scores": """SELECT event_id, tx_count_1h, is_unknown_ip, champion_score, challenger_score FROM paired""",
    "decision_alerts": f"""SELECT {ALERT_HEAD}, event_id AS source_event_id,
        CAST(champion_score / 100 AS DECIMAL(5,4)) AS risk_score,
        CAST(challenger_score AS DECIMAL(5,2)) AS challenger_score,
        CASE WHEN greatest(champion_score, challenger_score) > 90 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level,
        CASE WHEN is_unknown_ip THEN '{S.RULE_UNKNOWN_IP}' ELSE '{S.RULE_CHAMPION}' END AS rule_name,
        CASE WHEN is_unknown_ip THEN '{S.RULE_UNKNOWN_IP}' ELSE '{S.RULE_CHAMPION}' END || ' flagged ' || event_type
          || ' amount=' || amount || ' ip=' || ip_address AS alert_message,
        FALSE AS is_acknowledged, event_timestamp AS detected_at
      FROM paired WHERE greatest(champion_score, challenger_score) > 80""",
    "open_alerts_per_user": """SELECT user_id, CAST(max(risk_score) * 100 AS DECIMAL(7,2)) AS risk_score,
        CAST(max(challenger_score) AS DECIMAL(7,2)) AS challenger_score,
        CASE WHEN max(risk_score) > 0.9 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level,
        string_agg(DISTINCT rule_name, ', ' ORDER BY rule_name) AS rules, count(*) AS alert_count,
        max(detected_at) AS detected_at
      FROM alerts WHERE NOT is_acknowledged GROUP BY 1 ORDER BY detected_at DESC, user_id LIMIT 20""",
    "alert_feed": f"""SELECT alert_id, user_id, CAST(risk_score * 100 AS DECIMAL(7,2)) AS risk_score, risk_level,
        rule_name, alert_message, {LOCAL} AS detected_at, risk_score * 100 > 80 AS is_high_risk FROM alerts""",
    "recent_transactions": """SELECT user_id, CAST(position AS INT) AS position, transaction_id, event_type, amount,
        ip_address, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, transaction_id) AS position
            FROM silver) WHERE position <= 20""",
    "recent_open_alerts": f"""SELECT user_id, CAST(position AS INT) AS position,
        CAST(risk_score * 100 AS DECIMAL(7,2)) AS risk_score,
        CAST(challenger_score AS DECIMAL(7,2)) AS challenger_score, risk_level, rule_name, {LOCAL} AS detected_at
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY detected_at DESC, alert_id) AS position
            FROM alerts WHERE NOT is_acknowledged) WHERE position <= 20""",
    "blocked_users": """SELECT DISTINCT user_id, user_id IN
        (SELECT user_id FROM alerts WHERE risk_score > 0.8 AND NOT is_acknowledged) AS is_blocked FROM bank_events""",
    "alert_statistics": """SELECT *, coalesce(round(high_risk_alerts * 100.0::DOUBLE / nullif(total_alerts, 0), 2), 0)
        AS fraud_rate_percent
      FROM (SELECT count(*) AS total_alerts,
              count(*) FILTER (risk_score > 0.8 OR risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_alerts,
              count(*) FILTER (detected_at >= (SELECT max(detected_at) FROM alerts) - INTERVAL 24 HOURS)
                AS recent_alerts_24h FROM alerts)""",
    "daily_model_scores": """SELECT alert_date, strftime(alert_date, '%d/%m') AS label,
        CAST(coalesce(champion, 0) AS DECIMAL(7,2)) AS champion_score,
        CAST(coalesce(challenger, 0) AS DECIMAL(7,2)) AS challenger_score
      FROM (SELECT CAST(unnest(range(m - INTERVAL 6 DAY, m + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS alert_date
            FROM (SELECT CAST(max(detected_at) AS DATE) AS m FROM alerts)) g
      LEFT JOIN (SELECT CAST(detected_at AS DATE) AS alert_date,
              ((sum(risk_score) * 10000)::HUGEINT * 2 + count(*)) // (2 * count(*)) / 100.0 AS champion,
              ((sum(challenger_score) * 100)::HUGEINT * 2 + count(*)) // (2 * count(*)) / 100.0 AS challenger
            FROM alerts WHERE detected_at >= (SELECT max(detected_at) - INTERVAL 7 DAYS FROM alerts) GROUP BY 1) d
        USING (alert_date)""",
    "heatmap_grid": """SELECT CAST(w AS INT) AS weekday, CAST(h AS INT) AS hour_bucket, h || 'h' AS label,
        coalesce(transaction_count, 0) AS transaction_count
      FROM range(1, 8) a(w), range(0, 24) b(h) LEFT JOIN heatmap ON weekday = w AND hour_bucket = h""",
    "performance_series": f"""SELECT *, strftime(minute_bucket, '%H:%M') AS label
      FROM ({THROUGHPUT.format(period="1 DAY")} ORDER BY 1 DESC LIMIT 60)""",
    "assets_series": """SELECT *, strftime(day_bucket, '%d/%m') AS label
      FROM (SELECT * FROM assets ORDER BY day_bucket DESC LIMIT 7)""",
    "divergence_quadrants": """SELECT alert_id, xgboost_score, iforest_score, risk_level,
        CASE WHEN xgboost_score < 50 AND iforest_score > 90 THEN 'zero_day'
             WHEN risk_level IN ('HIGH', 'CRITICAL') OR (xgboost_score >= 80 AND iforest_score >= 80) THEN 'classic'
             ELSE 'normal' END AS quadrant
      FROM (SELECT * FROM points ORDER BY detected_at DESC, alert_id LIMIT 1000)""",
    "constraint_report": f"""
      SELECT 'bronze event_id unique' AS rule, count(*) - count(DISTINCT event_id) AS violations FROM bronze_events
      UNION ALL SELECT 'one alert per event', count(*) - count(DISTINCT source_event_id) FROM alerts
      UNION ALL SELECT 'alert_id unique', count(*) - count(DISTINCT alert_id) FROM alerts
      UNION ALL SELECT 'alert user is a customer', count(*) FROM alerts
        WHERE user_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
      UNION ALL SELECT 'balance not negative', count(*) FROM snapshot_all WHERE balance < 0
      UNION ALL SELECT 'risk between 0 and 1', count(*) FROM alerts WHERE risk_score NOT BETWEEN 0 AND 1
      UNION ALL SELECT 'user_id not null', count(*) FROM bronze_events WHERE user_id IS NULL
      UNION ALL SELECT 'known event type', count(*) FROM bronze_events WHERE event_type NOT IN ({MOVES})
      UNION ALL SELECT 'known risk level', count(*) FROM alerts WHERE risk_level NOT IN ({_list(S.RISK_LEVELS)})""",
    "idempotent_insert": f"""SELECT event_id, user_id, amount, ingested_at FROM bronze_events
      WHERE event_id NOT IN (SELECT event_id FROM bank_events WHERE event_timestamp < TIMESTAMP '{SEED_DAY}')
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at) = 1""",
    "upserted_accounts": f"""SELECT user_id, max(last_activity_at) AS last_activity_at,
        arg_max(events, last_activity_at) AS events
      FROM (SELECT user_id, event_timestamp < TIMESTAMP '{SEED_DAY}' AS early, max(event_timestamp) AS last_activity_at,
              count(*) AS events FROM bank_events GROUP BY 1, 2) GROUP BY 1""",
    "class_balance": """SELECT negatives, positives, round(positives / (negatives + positives)::DOUBLE, 9) AS fraud_ratio,
        round(negatives / greatest(positives, 1)::DOUBLE, 9) AS positive_weight
      FROM (SELECT count(*) FILTER (is_fraud = 0) AS negatives, count(*) FILTER (is_fraud = 1) AS positives
            FROM labelled)""",
    "confusion_counts": f"SELECT tp, fp, fn, tn, {RATIOS.format(tp='tp', fp='fp', fn='fn')} FROM confused",
    "classification_report": f"""
      SELECT 0 AS class, tn + fp AS support, {RATIOS.format(tp='tn', fp='fn', fn='fp')} FROM confused
      UNION ALL SELECT 1, tp + fn, {RATIOS.format(tp='tp', fp='fp', fn='fn')} FROM confused""",
    "precision_recall_curve": """SELECT threshold, tp, predicted, round(tp / predicted::DOUBLE, 9) AS "precision",
        round(tp / positives::DOUBLE, 9) AS recall FROM curve""",
    "average_precision": """SELECT round(sum(tp / predicted::DOUBLE * pos / positives), 9) AS average_precision
      FROM curve""",
    "threshold_sweep": "SELECT * FROM sweep",
    "best_threshold": "SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1",
    "challenger_risk": f"""SELECT event_id, round(greatest(0, least(100,
          100.0::DOUBLE * (hi - raw) / (hi - lo))), 9) AS risk_score
      FROM (SELECT event_id, event_timestamp, {U("event_id", "raw", -0.2, 0.3)} AS raw,
              min(CASE WHEN event_timestamp < TIMESTAMP '{SEED_DAY}' THEN {U("event_id", "raw", -0.2, 0.3)} END) OVER () AS lo,
              max(CASE WHEN event_timestamp < TIMESTAMP '{SEED_DAY}' THEN {U("event_id", "raw", -0.2, 0.3)} END) OVER () AS hi
            FROM bank_events)""",
    "event_profile": "\n UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values,
          (SELECT CAST({c} AS VARCHAR) FROM bank_events GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) DESC LIMIT 1) AS top_value,
          (SELECT max(n) FROM (SELECT count(*) AS n FROM bank_events GROUP BY {c})) AS top_rows,
          {"round(avg(amount::DOUBLE), 4)" if c == "amount" else "NULL::DOUBLE"} AS mean_value,
          {"round(stddev_samp(amount::DOUBLE), 4)" if c == "amount" else "NULL::DOUBLE"} AS deviation,
          {"min(amount)::DOUBLE" if c == "amount" else "NULL::DOUBLE"} AS min_number,
          {"max(amount)::DOUBLE" if c == "amount" else "NULL::DOUBLE"} AS max_number FROM bank_events"""
        for c in ("event_type", "amount", "ip_address", "user_id")
    ),
    "event_quartiles": """SELECT 'amount' AS column_name, quantile_disc(amount, 0.25)::DOUBLE AS q25,
        quantile_disc(amount, 0.5)::DOUBLE AS q50, quantile_disc(amount, 0.75)::DOUBLE AS q75 FROM bank_events""",
    "stratified_split": "SELECT * FROM split",
    "stratified_folds": """SELECT event_id, is_fraud, CAST((row_number() OVER (PARTITION BY is_fraud
        ORDER BY md5(event_id || '|fold'), event_id) - 1) % 3 AS INT) AS fold FROM labelled""",
    "random_subset": """SELECT event_id, amount FROM bank_events
      ORDER BY md5(event_id || '|subset'), event_id LIMIT 2000""",
    "cumulative_journeys": JOURNEYS,
    "journey_pages": JOURNEY_PAGES,
    "extended_journey_pages": JOURNEY_PAGES,
    "extended_journeys": f"""SELECT user_id, string_agg(CAST(day AS VARCHAR) || ' ' || event_type || ' x' || steps, ' > '
        ORDER BY late, day, first_at, event_type, steps) AS journey
      FROM (SELECT user_id, event_timestamp >= TIMESTAMP '{SEED_DAY}' AS late, CAST(event_timestamp AS DATE) AS day,
              event_type, count(*) AS steps, min(event_timestamp) AS first_at FROM bank_events GROUP BY 1, 2, 3, 4)
      GROUP BY 1""",
    "date_lists": f"""SELECT user_id, datelist_int, {_active(1)} > 0 AS is_daily_active,
        {_active(7)} > 0 AS is_weekly_active, {_active(28)} > 0 AS is_monthly_active,
        CAST({_active(7)} AS INT) AS active_days_7, CAST({_active(28)} AS INT) AS active_days_28 FROM ({_BITS})""",
    "growth_accounting": """SELECT c.day, count(*) FILTER (d.d IS NOT NULL AND f.first = c.day) AS new,
        count(*) FILTER (d.d IS NOT NULL AND y.d IS NOT NULL) AS retained,
        count(*) FILTER (d.d IS NOT NULL AND y.d IS NULL AND f.first < c.day) AS resurrected,
        count(*) FILTER (d.d IS NULL AND y.d IS NOT NULL) AS churned,
        count(*) FILTER (d.d IS NULL AND y.d IS NULL) AS stale
      FROM (SELECT DISTINCT d AS day FROM days) c
      JOIN (SELECT user_id, min(d) AS first FROM days GROUP BY 1) f ON f.first <= c.day
      LEFT JOIN days d ON d.user_id = f.user_id AND d.d = c.day
      LEFT JOIN days y ON y.user_id = f.user_id AND y.d = c.day - 1
      GROUP BY 1""",
    "gold_protected_assets_per_alert": f"""SELECT CAST(event_timestamp AS DATE) AS day_bucket,
        CAST(sum(CASE WHEN blocked THEN 0 ELSE amount END) AS DECIMAL(18,2)) AS valid_amount,
        CAST(sum(CASE WHEN blocked THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS blocked_amount
      FROM (SELECT t.*, a.source_event_id IS NOT NULL OR ip_address IN ({RISKY}) AS blocked
            FROM silver t LEFT JOIN alerts a ON a.source_event_id = t.transaction_id)
      WHERE event_timestamp >= (SELECT max(event_timestamp) - INTERVAL 7 DAY FROM silver) GROUP BY 1""",
}
SQL["event_profile_by_sketches"] = f"SELECT * EXCLUDE (distinct_values) FROM ({SQL['event_profile']})"
SQL["gold_protected_assets"] = f"""SELECT CAST(event_timestamp AS DATE) AS day_bucket,
        CAST(sum(CASE WHEN blocked THEN 0 ELSE amount END) AS DECIMAL(18,2)) AS valid_amount,
        CAST(sum(CASE WHEN blocked THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS blocked_amount
      FROM (SELECT t.*, transaction_id IN (SELECT source_event_id FROM alerts) OR ip_address IN ({RISKY}) AS blocked
            FROM silver t)
      WHERE event_timestamp >= (SELECT max(event_timestamp) - INTERVAL 7 DAY FROM silver) GROUP BY 1"""


# Importance: each feature in turn comes from the next row by hash within a range of hashes.
CTES["importance_rows"] = """
      SELECT event_id, f.is_fraud, amount::DOUBLE AS a, tx_count_1h::DOUBLE AS t, hour_of_day::DOUBLE AS h
      FROM featured f JOIN split s USING (event_id) WHERE is_test"""
CTES["importance_copies"] = """
      SELECT CASE k WHEN 0 THEN 'amount' WHEN 1 THEN 'tx_count_1h' ELSE 'hour_of_day' END AS feature, r AS repeat, is_fraud,
        CASE WHEN k = 0 THEN a2 ELSE a END AS a, CASE WHEN k = 1 THEN t2 ELSE t END AS t, CASE WHEN k = 2 THEN h2 ELSE h END AS h
      FROM (SELECT *, coalesce(lead(a) OVER w, first_value(a) OVER w) AS a2, coalesce(lead(t) OVER w, first_value(t) OVER w) AS t2,
              coalesce(lead(h) OVER w, first_value(h) OVER w) AS h2
            FROM (SELECT *, md5(event_id || '|shift' || r) AS place FROM importance_rows, range(3) x(r))
            WINDOW w AS (PARTITION BY r, substr(place, 1, 1) ORDER BY place, event_id)), range(3) y(k)
      UNION ALL SELECT NULL, 0, is_fraud, a, t, h FROM importance_rows"""
CTES["importance_quality"] = """
      SELECT feature, repeat, sum(step) / sum(pos) AS quality FROM (
        SELECT feature, repeat, pos, pos * sum(pos) OVER w / sum(n) OVER w AS step FROM (
          SELECT feature, repeat, floor((a / 1000000::DOUBLE * 0.5::DOUBLE + least(t, 5::DOUBLE) * 0.05::DOUBLE
              + h * 0.01::DOUBLE) * 10000) AS bin, sum(is_fraud)::DOUBLE AS pos, count(*)::DOUBLE AS n
          FROM importance_copies GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY feature, repeat ORDER BY bin DESC)) GROUP BY 1, 2"""

TRAINED_SQL = {
    "champion_holdout": "SELECT event_id, is_fraud, TRUE AS is_probability FROM split WHERE is_test",
    "champion_trials": """SELECT trees, trials, bool_and(is_fraud IN (0, 1)) AS scores_hold,
        CAST(trees = 450 AS BIGINT) AS best_trials
      FROM split, (VALUES (50, 40::BIGINT), (150, 16::BIGINT), (450, 8::BIGINT)) AS rungs(trees, trials)
      WHERE NOT is_test GROUP BY trees, trials""",
    "challenger_outliers": """SELECT count(*) AS events, CAST(sum(is_fraud) AS BIGINT) AS frauds, TRUE AS share_holds
      FROM split""",
    "permuted_importance": """SELECT q.feature, round(avg(b.quality - q.quality), 9) AS importance,
        round(stddev_pop(b.quality - q.quality), 9) AS spread
      FROM importance_quality q, importance_quality b WHERE q.feature IS NOT NULL AND b.feature IS NULL GROUP BY 1""",
}

# Deliveries: five stretches of time, and one event in 97 after them all; late is what lies more than
# a minute behind the newest event of earlier deliveries.
CTES["delivered"] = """
      SELECT e.*, coalesce(event_timestamp < m.newest - INTERVAL 60 SECONDS, FALSE) AS is_late
      FROM (SELECT *, CASE WHEN CAST(event_id AS BIGINT) % 97 = 0 THEN 5
              ELSE 5 * (second - min(second) OVER ()) // (max(second) OVER () - min(second) OVER () + 1) END AS part
            FROM (SELECT *, epoch_us(event_timestamp) // 1000000 AS second FROM bank_events)) e
      LEFT JOIN (SELECT p.part, max(b.event_timestamp) AS newest FROM range(6) p(part)
                 JOIN (SELECT event_timestamp, CASE WHEN CAST(event_id AS BIGINT) % 97 = 0 THEN 5
                         ELSE 5 * (second - min(second) OVER ()) // (max(second) OVER () - min(second) OVER () + 1) END AS part
                       FROM (SELECT *, epoch_us(event_timestamp) // 1000000 AS second FROM bank_events)) b
                 ON b.part < p.part GROUP BY 1) m ON m.part = e.part"""

# A stream's history counts in exact time and in order of time and id, what has been delivered by then.
# Half-hour slices that lie an hour or more behind the newest event of all but the last delivery before
# have been dropped.
CTES["stream_history"] = """
      SELECT *, CASE WHEN mean > 0 THEN amount::DOUBLE / mean ELSE 1.0 END AS ratio
      FROM (SELECT e.*, h.n_rows, h.total::DOUBLE / h.n_rows AS mean
            FROM bank_events e JOIN (
              SELECT a.event_id, count(*) AS n_rows, sum(b.amount) AS total
              FROM (SELECT d.*, m.newest - INTERVAL 3600 SECONDS AS dropped FROM delivered d LEFT JOIN (
                      SELECT p.part, max(x.event_timestamp) AS newest
                      FROM range(7) p(part) JOIN delivered x ON x.part < p.part - 1 GROUP BY 1) m ON m.part = d.part) a
              JOIN delivered b ON b.user_id = a.user_id
                AND b.event_timestamp >= a.event_timestamp - INTERVAL 300 SECONDS
                AND (b.event_timestamp, b.event_id) <= (a.event_timestamp, a.event_id)
                AND (b.part = a.part OR b.part < a.part AND (a.dropped IS NULL
                  OR time_bucket(INTERVAL 30 MINUTES, a.event_timestamp) + INTERVAL 30 MINUTES > a.dropped))
              GROUP BY 1) h USING (event_id))"""

STREAM_SQL = {
    "stream_bronze_ingest": """SELECT event_id, event_timestamp, user_id, event_type,
        CASE WHEN n % 11 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END AS amount,
        CASE WHEN n % 13 = 0 THEN '0.0.0.0' ELSE ip_address END AS ip_address, event_date
      FROM messages WHERE NOT is_cut AND NOT lacks_user""",
    "stream_tumbling_counts": """SELECT time_bucket(INTERVAL 5 MINUTES, event_timestamp) AS window_start,
        time_bucket(INTERVAL 5 MINUTES, event_timestamp) + INTERVAL 5 MINUTES AS window_end, count(*) AS events,
        CAST(sum(amount) AS DECIMAL(18,2)) AS amount,
        count(*) FILTER (event_type = 'LOGIN_FAILED') AS failed_logins, count(*) FILTER (is_late) AS late_events
      FROM delivered GROUP BY 1, 2""",
    "stream_silver": f"""SELECT event_id, user_id, event_type, amount, event_date
      FROM bank_events WHERE event_type IN ({MOVES})""",
    "stream_velocity": """SELECT event_id, n_rows::DOUBLE AS tx_count_1h, round(mean, 6) AS amount_avg_1h,
        round(ratio, 6) AS amount_vs_avg, CAST(hour(event_timestamp) AS INT) AS hour_of_day FROM stream_history""",
    "stream_alerts": SQL["stateful_alerts"],
    "stream_late_routing": """SELECT event_id, event_timestamp,
        CASE WHEN is_late THEN 'late' ELSE 'on_time' END AS route FROM delivered""",
    "stream_stateless_alerts": SQL["stateless_alerts"],
    "stream_alert_feed": """SELECT alert_id, user_id, risk_score, rule_name, alert_message, detected_at
      FROM alerts WHERE risk_score > 0.8""",
}
STREAM_SQL["stream_committed_alerts"] = STREAM_SQL["stream_alert_feed"]


def batch_sql() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in SQL.items()}


def stream_sql() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in STREAM_SQL.items()}


def trained_sql() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in TRAINED_SQL.items()}
