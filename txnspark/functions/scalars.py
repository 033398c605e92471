"""Scalar column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnspark import schemas as S

DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def hash_uniform(key: Column | str, salt: str, low: float = 0.0, high: float = 1.0) -> Column:
    """A repeatable draw from [low, high) for each key: 32 bits of md5 over key and salt."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(key.cast("string"), F.lit("|" + salt))
    unit = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.lit(float(low)) + unit * F.lit(float(high) - float(low))


def uuid5(value: Column | str, namespace_hex: str = DNS_NAMESPACE) -> Column:
    """Name-based UUID (version 5); NULL or empty names give NULL."""
    value = F.col(value) if isinstance(value, str) else value
    name = F.concat(F.unhex(F.lit(namespace_hex)), F.encode(value, "utf-8"))
    digest = F.sha1(name)
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    text = F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )
    return F.when(F.length(value) > 0, text)


def iso_weekday(ts: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(ts) + F.lit(1)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_seconds(ts)


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Difference with microseconds kept, as double."""
    return (F.unix_micros(later) - F.unix_micros(earlier)).cast("double") / F.lit(1e6)


def signed_amount(event_type: Column | str = "event_type", amount: Column | str = "amount") -> Column:
    """Debits negative, deposits positive, everything else zero."""
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    value = F.col(amount) if isinstance(amount, str) else amount
    return (
        F.when(kind.isin(*S.DEBIT_EVENT_TYPES), -value)
        .when(kind == "DEPOSIT", value)
        .otherwise(F.lit(0).cast(S.MONEY))
        .cast(S.MONEY)
    )


def is_risky_ip(ip: Column | str = "ip_address", risky=S.RISKY_IPS) -> Column:
    return F.coalesce((F.col(ip) if isinstance(ip, str) else ip).isin(*risky), F.lit(False))


def account_status(flagged: Column) -> Column:
    """LOCKED only for a true flag; NULL (no alert) counts as ACTIVE."""
    return F.when(flagged, F.lit("LOCKED")).otherwise(F.lit("ACTIVE"))


def status_reason(flagged: Column, reason: str = S.LOCK_REASON) -> Column:
    return F.when(flagged, F.lit(reason)).otherwise(F.lit(None).cast("string"))


def risk_level_100(score: Column | str) -> Column:
    """Level of a 0-100 score."""
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score > 90, "CRITICAL").when(score > 80, "HIGH").when(score > 50, "MEDIUM").otherwise("LOW")
    )


def risk_level_unit(score: Column | str, critical_above: str = "0.93") -> Column:
    """Level of a 0-1 score that is already known to be an alert."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score > F.lit(critical_above).cast("decimal(5,4)"), "CRITICAL").otherwise("HIGH")


def percent_score(score: Column | str) -> Column:
    """0-1 scores become 0-100; scores above 1 are taken to be on that scale already."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score <= 1, F.round(score * 100, 2)).otherwise(F.round(score, 2))


def quadrant(champion: Column | str, challenger: Column | str, level: Column | str) -> Column:
    """Which model saw the fraud: only the challenger, the usual pattern, or nobody."""
    x = F.col(champion) if isinstance(champion, str) else champion
    y = F.col(challenger) if isinstance(challenger, str) else challenger
    level = F.col(level) if isinstance(level, str) else level
    return (
        F.when((x < 50) & (y > 90), "zero_day")
        .when(level.isin("HIGH", "CRITICAL") | ((x >= 80) & (y >= 80)), "classic")
        .otherwise("normal")
    )


def risk_from_raw(raw: Column, raw_min: Column, raw_max: Column) -> Column:
    """Low raw scores are anomalies: map [raw_max, raw_min] to [0, 100], clipped; 50 if degenerate."""
    spread = raw_max - raw_min
    scaled = F.lit(100.0) * (raw_max - raw) / F.when(spread > 0, spread)
    return F.when(spread > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled))).otherwise(F.lit(50.0))


def finite_or_zero(value: Column | str) -> Column:
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def local_time(ts: Column | str, zone: str = "+07:00", pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A UTC instant as local wall-clock text."""
    return F.date_format(F.from_utc_timestamp(ts, zone), pattern)


def alert_message(rule: Column, event_type: Column, amount: Column, ip: Column) -> Column:
    return F.concat(
        rule, F.lit(" flagged "), event_type, F.lit(" amount="), amount.cast("string"), F.lit(" ip="), ip
    )
