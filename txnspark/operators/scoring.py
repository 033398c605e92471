"""Champion and challenger scores.

Random draws are replaced by ``hash_uniform`` over the event id, so a score does not change
between actions. Where a trained model is needed the caller supplies its output as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.alerts import alert_rows
from txnspark.operators.features import mark_members


def _over(limit: int) -> Column:
    return F.col("amount") > F.lit(limit).cast(S.MONEY)


def evaluate_models(events: DataFrame) -> DataFrame:
    """Verdicts of two rule-based models side by side."""
    champion = (
        F.when(_over(S.CHAMPION_SURE_AMOUNT), F.lit(True))
        .when(
            (F.col("event_type") == "TRANSFER") & _over(S.CHAMPION_TRANSFER_AMOUNT),
            X.hash_uniform("event_id", "champion") < S.CHAMPION_TRANSFER_ODDS,
        )
        .otherwise(X.hash_uniform("event_id", "champion") < S.CHAMPION_BASE_ODDS)
    )
    challenger = (
        F.when(X.is_risky_ip(), F.lit(True))
        .when(
            F.col("event_type").isin(*S.DEBIT_EVENT_TYPES) & _over(S.CHALLENGER_AMOUNT),
            X.hash_uniform("event_id", "challenger") < S.CHALLENGER_AMOUNT_ODDS,
        )
        .otherwise(X.hash_uniform("event_id", "challenger") < S.CHALLENGER_BASE_ODDS)
    )
    return events.withColumn("champion_is_fraud", champion).withColumn("challenger_is_fraud", challenger)


def evaluation_rows(evaluated: DataFrame, batch_id: str, evaluated_at: Column | None = None) -> DataFrame:
    """Evaluated events in the shape of the evaluation staging table."""
    at = F.current_timestamp() if evaluated_at is None else evaluated_at
    return evaluated.select(
        "event_id",
        "user_id",
        "event_type",
        "amount",
        "champion_is_fraud",
        "challenger_is_fraud",
        F.lit(batch_id).alias("batch_id"),
        at.alias("evaluated_at"),
    )


def disagreement(evaluated: DataFrame) -> DataFrame:
    """How many events the two models judge differently, in one pass."""
    return evaluated.agg(
        F.count_if(F.col("champion_is_fraud") != F.col("challenger_is_fraud")).alias("disagreements"),
        F.count(F.lit(1)).alias("events"),
    )


def random_risk(events: DataFrame, above: float = 80.0) -> DataFrame:
    """A random 0-100 risk score per event and the flag it raises."""
    score = F.round(X.hash_uniform("event_id", "risk", 0, 100), 2)
    return events.withColumn("risk_score", score).withColumn("is_fraud", F.col("risk_score") > above)


def stateless_features(events: DataFrame, tx_count: float = 45.0, amount_vs_avg: float = 50.0) -> DataFrame:
    """The five model features with constants in place of a history."""
    amount = F.col("amount").cast("double")
    return events.withColumns(
        {
            "tx_count_1h": F.lit(float(tx_count)),
            "amount_avg_1h": amount,
            "amount_vs_avg": F.lit(float(amount_vs_avg)),
            "hour_of_day": F.hour("event_timestamp").cast("int"),
        }
    )


def stateless_scores(
    events: DataFrame,
    probability: str,
    blocked_ip: str = S.BLOCKED_IP,
    blocked_score: float = S.BLOCKED_SCORE,
    flag_above: float = 0.02,
) -> DataFrame:
    """Address rule first, model probability otherwise; adds the score, the flag and a challenger."""
    by_rule = F.coalesce(F.col("ip_address").contains(blocked_ip), F.lit(False))
    score = F.when(by_rule, F.lit(float(blocked_score))).otherwise(F.col(probability) * 100)
    challenger = (
        F.when(X.is_risky_ip(), X.hash_uniform("event_id", "chal", *S.CHALLENGER_RISKY_BAND))
        .when(_over(S.CHALLENGER_AMOUNT), X.hash_uniform("event_id", "chal", *S.CHALLENGER_LARGE_BAND))
        .otherwise(X.hash_uniform("event_id", "chal", *S.CHALLENGER_BASE_BAND))
    )
    return events.withColumns(
        {
            "champion_score": score,
            "champion_flag": by_rule | (F.col(probability) > flag_above),
            "challenger_score": challenger,
        }
    )


def stateless_alerts(events: DataFrame, probability: str, **options) -> DataFrame:
    """Alerts of the model that keeps no history."""
    flagged = stateless_scores(events, probability, **options).where("champion_flag")
    return alert_rows(flagged, "champion_score", "challenger_score", F.lit(S.RULE_STATELESS))


def mark_unknown_ips(events: DataFrame, known_ips: DataFrame) -> DataFrame:
    """Adds ``is_unknown_ip``."""
    marked = mark_members(events, known_ips, "ip_address", "__known")
    return marked.withColumn("is_unknown_ip", ~F.col("__known")).drop("__known")


def stateful_scores(featured: DataFrame, probability: str, threshold: float = 0.8336) -> DataFrame:
    """Scores for events that carry their user's history features and ``is_unknown_ip``.

    An unknown address is an alert at 99/95 without asking the model; otherwise the model must
    exceed ``threshold``. Works on batch and streaming frames alike.
    """
    unknown = F.col("is_unknown_ip")
    champion = F.when(unknown, F.lit(99.0)).otherwise(F.col(probability) * 100)
    challenger = (
        F.when(unknown, F.lit(95.0))
        .when(X.is_risky_ip(), X.hash_uniform("event_id", "chal", 80.0, 99.9))
        .otherwise(champion * X.hash_uniform("event_id", "chal", 0.8, 0.9))
    )
    return featured.withColumns(
        {
            "champion_score": champion,
            "challenger_score": challenger,
            "is_alert": unknown | (F.col(probability) > threshold),
            "rule_name": F.when(unknown | X.is_risky_ip(), S.RULE_UNKNOWN_IP).otherwise(S.RULE_CHAMPION),
        }
    )


def stateful_alerts(featured: DataFrame, probability: str, threshold: float = 0.8336) -> DataFrame:
    """Alerts of the model that knows each user's recent history."""
    scored = stateful_scores(featured, probability, threshold).where("is_alert")
    return alert_rows(scored, "champion_score", "challenger_score", F.col("rule_name"))


def paired_scores(events: DataFrame, probability: str, challenger_risk: str) -> DataFrame:
    """Both models' 0-100 scores for events with ``is_unknown_ip``.

    Unknown addresses override both; a challenger more than 25 below a champion over 70 is
    lifted to 75-88 % of it.
    """
    unknown = F.col("is_unknown_ip")
    scored = events.withColumns(
        {
            "champion_score": F.when(unknown, F.lit(99.0)).otherwise(F.round(F.col(probability) * 100, 2)),
            "__challenger": F.when(unknown, F.lit(95.0)).otherwise(F.round(F.col(challenger_risk), 2)),
        }
    )
    gap = (F.col("champion_score") > 70) & (F.col("__challenger") < F.col("champion_score") - 25)
    lifted = F.round(F.col("champion_score") * X.hash_uniform("event_id", "lift", 0.75, 0.88), 2)
    return scored.withColumn(
        "challenger_score", F.when(gap, lifted).otherwise(F.col("__challenger"))
    ).drop("__challenger")


def decision_alerts(scored: DataFrame, above: float = 80.0) -> DataFrame:
    """Alerts where either score exceeds ``above``; the level follows the higher one."""
    highest = F.greatest("champion_score", "challenger_score")
    rule = F.when(F.col("is_unknown_ip"), S.RULE_UNKNOWN_IP).otherwise(S.RULE_CHAMPION)
    level = F.when(highest > 90, "CRITICAL").otherwise("HIGH")
    return alert_rows(scored.where(highest > above), "champion_score", "challenger_score", rule, level)
