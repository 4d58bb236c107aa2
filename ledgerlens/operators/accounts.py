"""Per-account totals over both sides of every transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import Money, count_where


def account_events(transactions: DataFrame) -> DataFrame:
    """Two rows per transaction, one for the sender and one for the receiver.

    A transfer to oneself gives two rows for the same account.
    """
    sides = F.array(
        F.struct(F.col("sender_account").alias("account_id"), F.lit(True).alias("is_sender")),
        F.struct(F.col("receiver_account").alias("account_id"), F.lit(False).alias("is_sender")),
    )
    return transactions.select(
        F.inline(sides), "transaction_step", "amount", "is_fraud"
    )


def account_metrics(events: DataFrame, money: Money | None = None) -> DataFrame:
    """Counts and unrounded totals per account.

    Rows of a busy account combine before the shuffle, so a hot account costs one row per
    task. Totals nobody reads are pruned. money is Money.measured of the amounts if known.
    """
    is_sender, is_fraud = F.col("is_sender"), F.col("is_fraud")
    money = money or Money.measured(events, "amount")
    return money.on(events).groupBy("account_id").agg(
        F.min("transaction_step").alias("first_seen_step"),
        F.max("transaction_step").alias("last_seen_step"),
        F.count(F.lit(1)).alias("total_transactions_touched"),
        count_where(is_sender).alias("sent_transactions"),
        count_where(~is_sender).alias("received_transactions"),
        count_where(is_fraud).alias("fraud_transactions_touched"),
        money.total().alias("amount_touched"),
        money.total(is_sender).alias("amount_sent"),
        money.total(~is_sender).alias("amount_received"),
        money.total(is_fraud).alias("fraud_amount"),
        money.mean(is_fraud).alias("fraud_amount_mean"),
    )


def fraud_account_metrics(transactions: DataFrame, money: Money | None = None) -> DataFrame:
    """account_metrics of the accounts that touch a fraud.

    Events combine per task before anything is shuffled, so a hot account costs one row per
    task; no raw event is shuffled, however many accounts there are.
    """
    money = money or Money.measured(transactions, "amount")
    return account_metrics(account_events(transactions), money).filter(
        F.col("fraud_transactions_touched") > 0
    )
