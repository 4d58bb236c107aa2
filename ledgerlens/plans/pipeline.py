"""Batch jobs: ingest, quality, transform, and all three with a run record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens.functions.measures import Money
from ledgerlens.operators.accounts import account_events, account_metrics
from ledgerlens.operators.gold import (
    activity,
    fraud_by_transaction_type,
    fraud_summary_daily,
    high_risk_accounts,
    hourly_fraud_trend,
    large_transaction_alerts,
)
from ledgerlens.operators.questions import account_sketches, amount_slices
from ledgerlens.operators.quality import check_results, quarantine, score_quality
from ledgerlens.operators.silver import (
    silver_accounts,
    silver_transaction_types,
    silver_transactions,
)
from ledgerlens.plans.history import History
from ledgerlens.sources.lake import Lake
from ledgerlens.sources.raw_csv import (
    bronze_records,
    find_raw_file,
    fixed_splits,
    read_raw,
    sample_files,
    to_bronze,
)
from ledgerlens.sources.scratch import Scratch


def _opened(spark: SparkSession, root: str | Lake) -> Lake:
    """The lake at a root, or the one a run already works on."""
    return root if isinstance(root, Lake) else Lake(spark, root)


def run_ingest(
    spark: SparkSession,
    root: str | Lake,
    raw_file: str | None = None,
    sample_rows: int | None = None,
    schema: StructType | None = None,
    mode: str = "KEEP",
) -> dict[str, int | str]:
    """CSV to bronze, partitioned by day.

    FAILFAST and PERMISSIVE are modes of read_raw. KEEP reads quoted line breaks and keeps cells
    that do not fit as text, for the quality checks to find.
    """
    lake = _opened(spark, root)
    source = find_raw_file(spark, lake.root, raw_file)
    scratch = Scratch(spark, "ingest")
    with fixed_splits(spark):
        if mode == "KEEP":
            bronze = bronze_records(spark, source, scratch, schema, sample_rows)
        else:
            files: str | list[str] = source
            if sample_rows:
                files = sample_files(
                    spark, source, sample_rows,
                    lambda some: read_raw(spark, some, schema, mode).count(),
                )
            bronze = to_bronze(read_raw(spark, files, schema, mode), scratch, sample_rows)
        lake.write(bronze, "bronze_transactions", rebalance=True)
    return {"raw_file": source, "bronze_rows": lake.count("bronze_transactions")}


def scored_bronze(spark: SparkSession, root: str | Lake) -> DataFrame:
    """Scored rows of bronze; all but repeated rows keep bronze's day-by-day layout."""
    bronze = _opened(spark, root).table("bronze_transactions")
    return score_quality(bronze, Scratch(spark, "quality"), layout="step_day")


def run_quality(
    spark: SparkSession, root: str | Lake, scored: DataFrame | None = None
) -> dict[str, int]:
    """Bronze to quarantine, and one quality result per check.

    Every failed row is in quarantine and the total comes from the Parquet footers, so
    counting the checks does not read bronze again.
    """
    lake = _opened(spark, root)
    scored = scored or scored_bronze(spark, root)
    bad = lake.write(quarantine(scored), "quarantine_bad_transactions")
    total_rows = lake.count("bronze_transactions")
    History(spark, lake.root).append_quality(check_results(bad, total_rows))
    return {"total_rows": total_rows, "quarantine_rows": bad.count()}


def run_transform(
    spark: SparkSession, root: str | Lake, scored: DataFrame | None = None
) -> dict[str, int]:
    """Bronze to silver and gold.

    Silver keeps the day-by-day layout of bronze, so it is written without a shuffle. Day,
    hour and type tables come from one scan of silver, both account tables from another. All
    tables change together when the last one is written.
    """
    lake = _opened(spark, root)
    scratch = Scratch(spark, "transform")
    scored = scored or scored_bronze(spark, lake)
    with lake.transaction():
        silver = lake.write(silver_transactions(scored), "silver_transactions")
        slices = lake.write(amount_slices(silver), "amount_slices")
        money = Money.of_slices(slices, "amount")
        metrics = scratch.table(account_metrics(account_events(silver), money), "account-metrics")
        totals = scratch.table(activity(silver, money), "activity")
        lake.write(silver_accounts(metrics), "silver_accounts")
        lake.write(silver_transaction_types(totals), "silver_transaction_types")
        lake.write(fraud_summary_daily(totals), "gold_fraud_summary_daily")
        lake.write(fraud_by_transaction_type(totals), "gold_fraud_by_transaction_type")
        lake.write(high_risk_accounts(metrics), "gold_high_risk_accounts")
        lake.write(hourly_fraud_trend(totals), "gold_hourly_fraud_trend")
        lake.write(large_transaction_alerts(silver), "gold_large_transaction_alerts")
        lake.write(account_sketches(silver), "account_sketches")
        counts = {
            "silver_rows": lake.count("silver_transactions"),
            "gold_daily_rows": lake.count("gold_fraud_summary_daily"),
        }
    lake.register_views()
    return counts


def run_pipeline(
    spark: SparkSession,
    root: str | Lake,
    raw_file: str | None = None,
    sample_rows: int | None = None,
    schema: StructType | None = None,
    mode: str = "KEEP",
) -> dict[str, int | str]:
    """All stages; the run is recorded as SUCCESS, or as FAILED with the error and raised.

    Quality and transform share one search for duplicates, which each does itself when run
    alone.
    A missing raw file is noticed before the run is recorded and leaves no trace. The tables of
    the run appear together at its end; a failed run leaves the lake as it was.
    """
    lake = _opened(spark, root)
    source = find_raw_file(spark, lake.root, raw_file)
    with History(spark, lake.root).recorded(source, sample_rows) as counts, lake.transaction():
        counts |= run_ingest(spark, lake, source, sample_rows, schema, mode)
        scored = scored_bronze(spark, lake)
        for stage in (run_quality, run_transform):
            counts |= stage(spark, lake, scored)
    return counts
