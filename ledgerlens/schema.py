"""Fixed names: raw columns, quality checks, lake tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# They decide results and must stay as they are.
EXPECTED_TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")

RAW_COLUMNS = (
    "step",
    "type",
    "amount",
    "nameOrig",
    "oldbalanceOrg",
    "newbalanceOrig",
    "nameDest",
    "oldbalanceDest",
    "newbalanceDest",
    "isFraud",
    "isFlaggedFraud",
)

# Check name -> issue text, in the order the issues are listed in a row
QUALITY_CHECKS = {
    "amount_positive": "amount_not_positive",
    "valid_transaction_type": "invalid_transaction_type",
    "sender_present": "missing_sender_account",
    "receiver_present": "missing_receiver_account",
    "valid_fraud_flag": "invalid_fraud_flag",
    "valid_flagged_fraud_flag": "invalid_flagged_fraud_flag",
    "non_negative_balances": "negative_or_null_balance",
    "duplicate_transaction": "duplicate_transaction",
}

# Passing this to the CSV reader saves the pass over the data that type inference costs.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives below the lake root and which column it is partitioned by."""

    path: str
    partition_by: str | None = None


# Names and places of the tables.
TABLES = {
    "bronze_transactions": TableSpec("bronze/bronze_transactions", "step_day"),
    "quarantine_bad_transactions": TableSpec("quarantine/quarantine_bad_transactions"),
    "silver_transactions": TableSpec("silver/silver_transactions", "transaction_day"),
    "silver_accounts": TableSpec("silver/silver_accounts"),
    "silver_transaction_types": TableSpec("silver/silver_transaction_types"),
    "gold_fraud_summary_daily": TableSpec("gold/gold_fraud_summary_daily"),
    "gold_fraud_by_transaction_type": TableSpec("gold/gold_fraud_by_transaction_type"),
    "gold_high_risk_accounts": TableSpec("gold/gold_high_risk_accounts"),
    "gold_hourly_fraud_trend": TableSpec("gold/gold_hourly_fraud_trend"),
    "gold_large_transaction_alerts": TableSpec("gold/gold_large_transaction_alerts"),
}

# Small tables kept beside silver, that answer parts of a question without reading transactions.
STATISTICS = {
    "amount_slices": TableSpec("statistics/amount_slices"),
    "account_sketches": TableSpec("statistics/account_sketches"),
}

# The tables the analytics functions and reports need.
REPORT_TABLES = (
    "silver_transactions",
    "gold_fraud_summary_daily",
    "gold_fraud_by_transaction_type",
    "gold_high_risk_accounts",
    "gold_hourly_fraud_trend",
    "gold_large_transaction_alerts",
)
