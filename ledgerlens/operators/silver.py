"""Clean typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.casts import double_text, text_or_empty
from ledgerlens.functions.measures import Money, percent, ratio, round_to
from ledgerlens.operators.quality import clean_rows


def silver_transactions(scored: DataFrame) -> DataFrame:
    """Rows without quality issues under their final names and types.

    transaction_id is a hash of the normalised values. Rows that differ only in the raw
    spelling of the type are no duplicates but share an id; source_row_number is unique.
    """
    step = F.col("parsed_step")

    def number(name: str) -> Column:
        x = F.col(name)
        text = x.cast("string")
        is_plain = (F.abs(x) < F.lit(float("inf"))) & ~F.contains(text, F.lit("E"))
        # the long way is only for amounts with an exponent, and kept out of generated code
        other = F.get(F.transform(F.array(x), double_text), F.lit(0))
        return F.when(x.isNull(), "").when(is_plain, text).otherwise(other)

    # Fixed value: order of the id's parts.
    id_parts = (
        text_or_empty(step),
        text_or_empty(F.col("normalized_transaction_type")),
        number("parsed_amount"),
        text_or_empty(F.col("sender_account")),
        text_or_empty(F.col("receiver_account")),
        number("parsed_oldbalanceOrg"),
        number("parsed_newbalanceOrig"),
        number("parsed_oldbalanceDest"),
        number("parsed_newbalanceDest"),
        text_or_empty(F.col("parsed_isFraud")),
        text_or_empty(F.col("parsed_isFlaggedFraud")),
    )
    return clean_rows(scored).select(
        F.md5(F.concat_ws("|", *id_parts)).alias("transaction_id"),
        step.alias("transaction_step"),
        F.ceil(step / F.lit(24.0)).cast("int").alias("transaction_day"),
        ((step - 1) % 24).cast("int").alias("transaction_hour"),
        F.col("normalized_transaction_type").alias("transaction_type"),
        F.col("parsed_amount").alias("amount"),
        "sender_account",
        "receiver_account",
        F.col("parsed_oldbalanceOrg").alias("sender_old_balance"),
        F.col("parsed_newbalanceOrig").alias("sender_new_balance"),
        F.col("parsed_oldbalanceDest").alias("receiver_old_balance"),
        F.col("parsed_newbalanceDest").alias("receiver_new_balance"),
        F.col("parsed_isFraud").cast("boolean").alias("is_fraud"),
        F.col("parsed_isFlaggedFraud").cast("boolean").alias("is_flagged_fraud"),
        "source_row_number",
        "ingested_at",
        "source_file",
    )


def silver_accounts(metrics: DataFrame) -> DataFrame:
    """Profile of every account, from account_metrics."""
    return metrics.select(
        "account_id",
        F.substring("account_id", 1, 1).alias("account_prefix"),
        "first_seen_step",
        "last_seen_step",
        "total_transactions_touched",
        "sent_transactions",
        "received_transactions",
        round_to(F.col("amount_touched"), 2).alias("total_amount_touched"),
        round_to(F.col("amount_sent"), 2).alias("total_sent_amount"),
        round_to(F.col("amount_received"), 2).alias("total_received_amount"),
        "fraud_transactions_touched",
        round_to(F.col("fraud_amount"), 2).alias("fraud_amount_touched"),
        percent(
            F.col("fraud_transactions_touched"), F.col("total_transactions_touched"), 4
        ).alias("fraud_touch_rate_pct"),
    )


def silver_transaction_types(activity: DataFrame) -> DataFrame:
    """Totals per transaction type, from gold.activity."""
    total, frauds = F.sum("transactions"), F.sum("frauds")
    amount = Money.stored(activity, "amount").total()
    fraud_amount = Money.stored(activity, "fraud_amount").total()
    return (
        activity.groupBy("transaction_type")
        .agg(
            total.alias("total_transactions"),
            frauds.alias("fraud_transactions"),
            percent(frauds, total, 4).alias("fraud_rate_pct"),
            round_to(amount, 2).alias("total_amount"),
            round_to(fraud_amount, 2).alias("fraud_amount"),
            round_to(ratio(amount, total), 2).alias("average_amount"),
        )
        .orderBy(F.desc("fraud_rate_pct"), F.desc("fraud_transactions"), "transaction_type")
    )
