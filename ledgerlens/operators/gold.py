"""Report tables derived from silver transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import (
    Money,
    count_where,
    percent,
    ratio,
    round_to,
)
from ledgerlens.functions.predicates import amount_at_least
from ledgerlens.operators.selection import exact_quantiles

# Reported accounts and alerts.
HIGH_RISK_ACCOUNTS = 1000
LARGE_ALERTS = 500


def activity(transactions: DataFrame, money: Money | None = None) -> DataFrame:
    """Totals per day, hour and type: at most five rows per hour of history.

    The day, hour and type tables all add up these rows, so one scan serves them all. money is
    Money.measured of the amounts if known.
    """
    money = money or Money.measured(transactions, "amount")
    keys = ("transaction_day", "transaction_hour", "transaction_type")
    return money.on(transactions).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transactions"),
        count_where(F.col("is_fraud")).alias("frauds"),
        count_where(F.col("is_flagged_fraud")).alias("source_flagged"),
        *money.stored_sums("amount"),
        *money.stored_sums("fraud_amount", F.col("is_fraud")),
    )


def _fraud_amount(activity_rows: DataFrame) -> Column:
    return Money.stored(activity_rows, "fraud_amount").total()


def fraud_summary_daily(activity_rows: DataFrame) -> DataFrame:
    total, frauds = F.sum("transactions"), F.sum("frauds")
    return (
        activity_rows.groupBy("transaction_day")
        .agg(
            total.alias("total_transactions"),
            frauds.alias("fraud_transactions"),
            percent(frauds, total, 4).alias("fraud_rate_pct"),
            round_to(Money.stored(activity_rows, "amount").total(), 2).alias("total_amount"),
            round_to(_fraud_amount(activity_rows), 2).alias("fraud_amount"),
            F.sum("source_flagged").alias("source_flagged_transactions"),
            round_to(ratio(_fraud_amount(activity_rows), frauds), 2).alias("avg_fraud_amount"),
        )
        .orderBy(F.asc_nulls_last("transaction_day"))
    )


def fraud_by_transaction_type(activity_rows: DataFrame) -> DataFrame:
    total, frauds = F.sum("transactions"), F.sum("frauds")
    return (
        activity_rows.groupBy("transaction_type")
        .agg(
            total.alias("total_transactions"),
            frauds.alias("fraud_transactions"),
            percent(frauds, total, 4).alias("fraud_rate_pct"),
            round_to(Money.stored(activity_rows, "amount").total(), 2).alias("total_amount"),
            round_to(_fraud_amount(activity_rows), 2).alias("fraud_amount"),
            round_to(ratio(_fraud_amount(activity_rows), frauds), 2).alias("avg_fraud_amount"),
        )
        .orderBy(F.desc("fraud_rate_pct"), F.desc("fraud_amount"), "transaction_type")
    )


def hourly_fraud_trend(activity_rows: DataFrame) -> DataFrame:
    total, frauds = F.sum("transactions"), F.sum("frauds")
    return (
        activity_rows.groupBy("transaction_hour")
        .agg(
            total.alias("total_transactions"),
            frauds.alias("fraud_transactions"),
            percent(frauds, total, 4).alias("fraud_rate_pct"),
            round_to(_fraud_amount(activity_rows), 2).alias("fraud_amount"),
        )
        .orderBy(F.asc_nulls_last("transaction_hour"))
    )


def high_risk_accounts(metrics: DataFrame, limit: int = HIGH_RISK_ACCOUNTS) -> DataFrame:
    """Accounts touching a fraud with score and band, highest score first.

    Takes account_metrics of all accounts or, cheaper, fraud_account_metrics.
    """
    rounded = metrics.filter("fraud_transactions_touched > 0").select(
        "account_id",
        "total_transactions_touched",
        "sent_transactions",
        "received_transactions",
        "fraud_transactions_touched",
        round_to(F.col("amount_touched"), 2).alias("total_amount_touched"),
        round_to(F.col("fraud_amount"), 2).alias("fraud_amount_touched"),
        round_to(F.col("fraud_amount_mean"), 2).alias("avg_fraud_amount"),
    )
    # Weights, caps and bands of the score.
    score = (
        F.col("fraud_transactions_touched") * F.lit(50.0)
        + F.least(F.col("fraud_amount_touched") / F.lit(10000.0), F.lit(50.0))
        + F.least(F.col("total_transactions_touched") / F.lit(1000.0), F.lit(20.0))
    )
    band = (
        F.when(F.col("risk_score") >= 100, "CRITICAL")
        .when(F.col("risk_score") >= 60, "HIGH")
        .when(F.col("risk_score") >= 25, "MEDIUM")
        .otherwise("LOW")
    )
    return (
        rounded.withColumn("risk_score", round_to(score, 2))
        .withColumn("risk_band", band)
        .orderBy(F.desc("risk_score"), F.desc("fraud_amount_touched"), "account_id")
        .limit(limit)
    )


def large_transaction_alerts(transactions: DataFrame, limit: int = LARGE_ALERTS) -> DataFrame:
    """Flagged, very large, or fraudulent and large transactions, highest score first."""
    # Amount quantiles, reasons and weights of the score.
    quantiles = exact_quantiles(transactions, "amount", (0.99, 0.995))
    p99, p995 = quantiles[0.99], quantiles[0.995]
    is_fraud, is_flagged, amount = F.col("is_fraud"), F.col("is_flagged_fraud"), F.col("amount")
    large_fraud = is_fraud & amount_at_least(p99)
    outlier = amount_at_least(p995)
    reason = (
        F.when(is_flagged, "source_flagged_fraud")
        .when(large_fraud, "known_fraud_large_amount")
        .when(outlier, "large_amount_outlier")
        .otherwise("watchlist_large_transaction")
    )
    p995_value = F.lit(p995).cast("double")
    size_score = F.least(ratio(amount, p995_value) * F.lit(20.0), F.lit(20.0))
    score = (
        F.when(is_fraud, 70.0).otherwise(0.0)
        + F.when(is_flagged, 30.0).otherwise(0.0)
        + size_score
    )
    return (
        transactions.filter(outlier | is_flagged | large_fraud)
        .withColumns(
            {
                "p99_amount": F.lit(p99).cast("double"),
                "p995_amount": p995_value,
                "alert_reason": reason,
                "alert_score": round_to(score, 2),
            }
        )
        .orderBy(
            F.desc("alert_score"), F.desc("amount"), "transaction_id", "source_row_number"
        )
        .limit(limit)
        .select(
            "transaction_id",
            "transaction_step",
            "transaction_day",
            "transaction_hour",
            "transaction_type",
            "amount",
            "sender_account",
            "receiver_account",
            "is_fraud",
            "is_flagged_fraud",
            "p99_amount",
            "p995_amount",
            "alert_reason",
            "alert_score",
        )
    )
