"""Table contracts and domain constants."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


_KINDS = {
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "MONEY": MONEY,
    "RISK": T.DecimalType(5, 4),
    "PERCENT": T.DecimalType(5, 2),
    "LATENCY": T.DecimalType(8, 3),
}


def struct(columns: str) -> T.StructType:
    """A schema from "name KIND, ..."; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# The data contract of the platform this library serves.
RISKY_IPS = ("192.168.1.99", "10.0.0.88", "203.0.113.42")
BALANCE_EVENT_TYPES = ("TRANSFER", "WITHDRAW", "DEPOSIT")
DEBIT_EVENT_TYPES = ("TRANSFER", "WITHDRAW")
EVENT_TYPES = (
    "LOGIN",
    "LOGIN_FAILED",
    "LOGIN_SUCCESS",
    "LOGOUT",
    "TRANSFER",
    "VIEW_BALANCE",
    "WITHDRAW",
)
ACCOUNT_STATUSES = ("ACTIVE", "LOCKED", "CLOSED")
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
OPENING_BALANCE = "10000.00"
ACCOUNT_SEED_BALANCE = "10000000.00"
CURRENCY = "VND"
LOCK_REASON = "Suspicious activity flagged by ML model"
MICRO_BATCH_REASON = "Xử lý qua Micro-batch"
SEED_REASON = "Initial balance"
SEED_PHONE = "0912345678"
EMAIL_SUFFIX = "@bank.com"
RULE_UNKNOWN_IP = "IP lạ chưa xác thực"
RULE_CHAMPION = "XGBoost Champion Model"
RULE_BOT = "XGBoost Bot Fraud Pattern"
RULE_RISKY_IP = "High Risk IP Alert"
RULE_STATELESS = "champion_model_v1"
ALERT_MESSAGE_PREFIX = "Giao dịch bất thường phát hiện từ IP: "
# Amount limits and odds of the rule models, the blocked address, and score bands.
CHAMPION_SURE_AMOUNT, CHAMPION_TRANSFER_AMOUNT, CHALLENGER_AMOUNT = 100_000, 50_000, 75_000
CHAMPION_TRANSFER_ODDS, CHAMPION_BASE_ODDS = 0.7, 0.05
CHALLENGER_AMOUNT_ODDS, CHALLENGER_BASE_ODDS = 0.6, 0.08
BLOCKED_IP, BLOCKED_SCORE = "10.0.0.88", 99.0
CHALLENGER_RISKY_BAND, CHALLENGER_LARGE_BAND, CHALLENGER_BASE_BAND = (75.0, 99.9), (60.0, 85.0), (5.0, 45.0)
POINT_CHAMPION_BANDS = ((10, 45), (80, 99), (5, 70))
POINT_CHALLENGER_BANDS = ((91, 99), (80, 99), (5, 75))
NUMERIC_FEATURES = ("amount", "tx_count_1h", "amount_avg_1h", "amount_vs_avg", "hour_of_day")
METADATA_COLUMNS = (
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "ingested_at",
    "event_date",
    "is_simulated",
)
IDENTIFIER_COLUMNS = ("user_id", "event_id")

EVENT_MESSAGE = struct(
    "event_id STRING, timestamp STRING, user_id STRING, event_type STRING, "
    "amount MONEY, ip_address STRING, is_simulated BOOLEAN"
)

BRONZE_EVENTS = struct(
    "event_id STRING, event_timestamp TIMESTAMP, user_id STRING, event_type STRING, "
    "amount MONEY, ip_address STRING, is_simulated BOOLEAN, kafka_topic STRING, "
    "kafka_partition INT, kafka_offset BIGINT, ingested_at TIMESTAMP, event_date DATE"
)

SILVER_TRANSACTIONS = struct(
    "transaction_id STRING, account_id STRING, user_id STRING, event_type STRING, "
    "amount MONEY, currency STRING, ip_address STRING, is_simulated BOOLEAN, "
    "event_timestamp TIMESTAMP, ingested_at TIMESTAMP, event_date DATE"
)

ACCOUNT_SNAPSHOT = struct(
    "account_id STRING, user_id STRING, balance MONEY, account_status STRING, "
    "status_reason STRING, source_event_id STRING"
)

ACCOUNT_HISTORY = struct(
    "account_id STRING, user_id STRING, balance MONEY, account_status STRING, "
    "status_reason STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, is_current BOOLEAN, "
    "source_event_id STRING, batch_id STRING, created_at TIMESTAMP"
)

MODEL_EVALUATION = struct(
    "event_id STRING, user_id STRING, event_type STRING, amount MONEY, "
    "champion_is_fraud BOOLEAN, challenger_is_fraud BOOLEAN, batch_id STRING, "
    "evaluated_at TIMESTAMP"
)

FRAUD_ALERTS = struct(
    "alert_id STRING, user_id STRING, account_id STRING, transaction_id STRING, "
    "source_event_id STRING, risk_score RISK, challenger_score PERCENT, "
    "risk_level STRING, rule_name STRING, alert_message STRING, is_acknowledged BOOLEAN, "
    "detected_at TIMESTAMP, created_at TIMESTAMP"
)

USERS = struct(
    "user_id STRING, display_name STRING, email STRING, phone STRING, is_simulated BOOLEAN, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)

ACCOUNTS = struct(
    "account_id STRING, user_id STRING, account_number STRING, currency STRING, "
    "balance MONEY, status STRING, status_reason STRING, last_event_id STRING, "
    "last_activity_at TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP"
)

GOLD_PERFORMANCE = struct(
    "minute_bucket TIMESTAMP, event_count BIGINT, avg_latency_seconds LATENCY"
)
GOLD_HEATMAP = struct("weekday INT, hour_bucket INT, transaction_count BIGINT")
GOLD_ASSETS = struct("day_bucket DATE, valid_amount MONEY, blocked_amount MONEY")
GOLD_DIVERGENCE = struct(
    "alert_id STRING, user_id STRING, xgboost_score PERCENT, iforest_score PERCENT, "
    "risk_level STRING, detected_at TIMESTAMP"
)
