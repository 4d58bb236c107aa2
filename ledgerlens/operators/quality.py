"""Quality scoring of bronze rows, quarantine and check results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.casts import blank_to_null, tolerant_double, tolerant_int
from ledgerlens.operators.duplicates import rank_copies
from ledgerlens.schema import EXPECTED_TRANSACTION_TYPES, QUALITY_CHECKS, RAW_COLUMNS
from ledgerlens.sources.scratch import Scratch

_BALANCES = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")


def score_quality(
    bronze: DataFrame, scratch: Scratch | None = None, layout: str | None = None
) -> DataFrame:
    """Add parsed columns, duplicate rank and count, and quality_issues ('' for a clean row).

    Of rows that agree in all raw columns (as text, NULL the same as empty) the one with
    the lowest source_row_number is clean, the others are duplicates. NaN passes the
    amount check, since it is greater than zero. source_row_number should be unique: rows
    that share one get an arbitrary order among them.

    Finding repeated rows runs a job when this is called, see rank_copies, which also says
    what layout is for.
    """
    scratch = scratch or Scratch(bronze.sparkSession, "quality")
    parsed = {
        "parsed_step": tolerant_int(bronze, "step"),
        "normalized_transaction_type": F.upper(F.trim(F.col("type").cast("string"))),
        "parsed_amount": tolerant_double(bronze, "amount"),
        "sender_account": blank_to_null(F.col("nameOrig")),
        "receiver_account": blank_to_null(F.col("nameDest")),
        **{f"parsed_{name}": tolerant_double(bronze, name) for name in _BALANCES},
        "parsed_isFraud": tolerant_int(bronze, "isFraud"),
        "parsed_isFlaggedFraud": tolerant_int(bronze, "isFlaggedFraud"),
    }
    ranked = rank_copies(bronze, RAW_COLUMNS, "source_row_number", scratch, layout=layout)
    scored = ranked.select(
        *bronze.columns,
        *[column.alias(name) for name, column in parsed.items()],
        "duplicate_count",
        "duplicate_rank",
    )
    issues = [F.when(failed, F.lit(QUALITY_CHECKS[name])) for name, failed in _failures().items()]
    return scored.withColumn("quality_issues", F.concat_ws(",", *issues))


def _failures() -> dict[str, Column]:
    def not_one_of(name: str, allowed: tuple) -> Column:
        return ~F.coalesce(F.col(name).isin(*allowed), F.lit(False))

    def missing_or(name: str, wrong: Column) -> Column:
        return F.col(name).isNull() | wrong

    bad_balance = F.lit(False)
    for name in _BALANCES:
        bad_balance = bad_balance | missing_or(f"parsed_{name}", F.col(f"parsed_{name}") < 0)

    return {
        "amount_positive": missing_or("parsed_amount", F.col("parsed_amount") <= 0),
        "valid_transaction_type": not_one_of(
            "normalized_transaction_type", EXPECTED_TRANSACTION_TYPES
        ),
        "sender_present": F.col("sender_account").isNull(),
        "receiver_present": F.col("receiver_account").isNull(),
        "valid_fraud_flag": not_one_of("parsed_isFraud", (0, 1)),
        "valid_flagged_fraud_flag": not_one_of("parsed_isFlaggedFraud", (0, 1)),
        "non_negative_balances": bad_balance,
        "duplicate_transaction": F.col("duplicate_rank") > 1,
    }


def clean_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("quality_issues") == "")


def bad_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("quality_issues") != "")


def quarantine(scored: DataFrame) -> DataFrame:
    return bad_rows(scored).withColumn("quarantined_at", F.current_timestamp())


def quality_totals(scored: DataFrame) -> DataFrame:
    """One row: total_rows and quarantine_rows."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("quality_issues") != "").alias("quarantine_rows"),
    )


def check_results(scored: DataFrame, total_rows: int | None = None) -> DataFrame:
    """One row per check: failed_rows, total_rows and PASS or FAIL, from a single pass.

    Failed rows are all in quarantine, so with total_rows given the quarantine table will
    do in place of the scored rows.
    """
    counts = scored.agg(
        F.count(F.lit(1)).alias("rows_seen"),
        *[
            F.count_if(F.contains(F.col("quality_issues"), F.lit(issue))).alias(check)
            for check, issue in QUALITY_CHECKS.items()
        ],
    )
    total = F.col("rows_seen") if total_rows is None else F.lit(total_rows).cast("long")
    return counts.unpivot(
        "rows_seen", list(QUALITY_CHECKS), "check_name", "failed_rows"
    ).select(
        "check_name",
        "failed_rows",
        total.alias("total_rows"),
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("status"),
    )
