"""Registered queries over the test tables, and their DuckDB counterparts.

Transactions are derived from the events table. Queries on silver read a lake that is
built from it once per session, in the folder spark.checkpoint.dir names.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.functions.casts import double_text  # noqa: E402
from ledgerlens.functions.measures import Money  # noqa: E402
from ledgerlens.operators import accounts, analytics, gold, quality, rules, silver  # noqa: E402
from ledgerlens.operators.questions import Questions  # noqa: E402
from ledgerlens.plans.history import History  # noqa: E402
from ledgerlens.plans.pipeline import (  # noqa: E402
    run_pipeline,
    run_quality,
    run_transform,
    scored_bronze,
)
from ledgerlens.schema import REPORT_TABLES, TABLES  # noqa: E402
from ledgerlens.sources.events import transactions_from_events, write_raw_csv  # noqa: E402
from ledgerlens.sources.lake import Lake  # noqa: E402
from ledgerlens.sources.raw_csv import (  # noqa: E402
    bronze_records,
    fixed_splits,
    read_raw,
    sample_files,
    to_bronze,
)
from ledgerlens.sources.scratch import Scratch  # noqa: E402
from oracle_queries import ORACLE  # noqa: E402

try:
    import corpus_pipeline
    from ledgerlens.llm import queries as corpus_queries
except ModuleNotFoundError as error:  # the corpus operators are an optional part
    if error.name not in ("corpus_pipeline", "ledgerlens.llm"):
        raise
    corpus_queries = None

SAMPLE_ROWS = 500

_built: dict[tuple[str, str, str], str] = {}
_lakes: dict[str, Lake] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, build: Callable[[str], None]) -> str:
    """Path of something built at most once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _built:
        root = Scratch(spark, kind).root
        build(root)
        _built[key] = root
    return _built[key]


def _bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The derived transactions as bronze table."""

    def build(root: str) -> None:
        rows = transactions_from_events(spark, sf_dir)
        Lake(spark, root).write(rows, "bronze_transactions", rebalance=True)

    return _opened(spark, _once(spark, sf_dir, "lake", build))


def _opened(spark: SparkSession, root: str) -> Lake:
    """The lake at a root; its newest commit is looked up once."""
    if root not in _lakes:
        _lakes[root] = Lake(spark, root)
    return _lakes[root]


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Bronze, quarantine, silver and gold tables of the derived transactions."""
    lake = _bronze_lake(spark, sf_dir)

    def build(_: str) -> None:
        scored = scored_bronze(spark, lake)
        run_quality(spark, lake, scored)
        run_transform(spark, lake, scored)

    _once(spark, sf_dir, "lake-tables", build)
    return lake


def _raw_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "raw.csv",
        lambda path: write_raw_csv(transactions_from_events(spark, sf_dir), path),
    )


def _csv_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake filled from CSV files by the whole pipeline, with its run history."""
    raw = _raw_csv(spark, sf_dir)
    root = _once(spark, sf_dir, "csv-lake", lambda root: run_pipeline(spark, root, raw_file=raw))
    return _opened(spark, root)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir).table("silver_transactions")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_bronze_lake(spark, sf_dir).table("bronze_transactions"))


def _bronze(spark: SparkSession, sf_dir: str, sample_rows: int | None = None) -> DataFrame:
    with fixed_splits(spark):
        files: str | list[str] = _raw_csv(spark, sf_dir)
        if sample_rows:
            files = sample_files(
                spark, files, sample_rows, lambda some: read_raw(spark, some).count()
            )
        raw = read_raw(spark, files)
        bronze = to_bronze(raw, Scratch(spark, "bronze"), sample_rows)
    return bronze.drop("ingested_at", "source_file")


def _broken_csv(spark: SparkSession, sf_dir: str) -> str:
    """The transactions as CSV with line breaks and quotes in receivers, and cells that are no numbers."""

    def build(path: str) -> None:
        rows = transactions_from_events(spark, sf_dir)

        def every(step: int, offset: int) -> Column:
            return F.col("source_row_number") % step == offset

        broken = rows.withColumns(
            {
                "nameDest": F.when(every(13, 4), F.concat("nameDest", F.lit('\nsecond "line",\n')))
                .otherwise(F.col("nameDest")),
                "amount": F.when(every(503, 21), "n/a").otherwise(F.col("amount").cast("string")),
                "isFraud": F.when(every(601, 33), "yes").otherwise(F.col("isFraud").cast("string")),
            }
        )
        write_raw_csv(broken, path, escape='"')

    return _once(spark, sf_dir, "broken.csv", build)


def _records(spark: SparkSession, sf_dir: str, split_bytes: int) -> DataFrame:
    """Bronze rows of the broken CSV, cut into splits of some bytes whatever its size."""
    path, scratch = _broken_csv(spark, sf_dir), Scratch(spark, "records")
    settings = {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.openCostInBytes": 0}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        with fixed_splits(spark):
            rows = bronze_records(spark, path, scratch)
            return scratch.table(rows.drop("ingested_at", "source_file"), "bronze")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _bronze_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_records(spark, sf_dir, 1 << 22))


def _number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that goes into transaction_id, for amounts far from everyday ones."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    value = F.col("value")
    return events.select(
        "event_id",
        double_text(value * F.lit(1e16)).alias("huge_text"),
        double_text(value * F.lit(1e-7)).alias("tiny_text"),
        double_text(-value).alias("negative_text"),
    )


def _load_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every row of the lake filled from CSV says when and from which file it came."""
    bronze = _csv_lake(spark, sf_dir).table("bronze_transactions")
    bad = _csv_lake(spark, sf_dir).table("quarantine_bad_transactions")
    rows = bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.bool_and(F.col("source_file").endswith(".csv")).alias("all_from_csv"),
        F.bool_and(F.col("ingested_at") <= F.current_timestamp()).alias("all_loaded"),
    )
    quarantined = F.coalesce(F.col("quarantined_at") >= F.col("ingested_at"), F.lit(False))
    return rows.join(
        bad.agg(F.bool_and(quarantined).alias("all_quarantined_later")), how="cross"
    )  # one row each


def _view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts asked of the views the lake registers."""
    counts = None
    for name in _lake(spark, sf_dir).register_views():
        row = spark.sql(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def _missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report tables a lake with two of them lacks, beside the row count of those it has."""
    part = Lake(spark, Scratch(spark, "part-lake").root)
    names = ("silver_transactions", "gold_hourly_fraud_trend")
    rows = None
    for name in names:
        part.write(_lake(spark, sf_dir).table(name), name)
    missing = part.missing_tables()
    for name in REPORT_TABLES:
        count = F.lit(None).cast("long") if name in missing else F.lit(part.count(name))
        row = spark.range(1).select(
            F.lit(name).alias("table_name"), F.lit(part.has(name)).alias("present"),
            count.alias("row_count"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def _old_quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results kept before runs had an id, read together with newer ones."""
    history = History(spark, Scratch(spark, "old-history").root)
    results = quality.check_results(_scored(spark, sf_dir))
    results.withColumn("checked_at", F.current_timestamp()).write.parquet(history.results_path)
    history.append_quality(results)
    return history.quality_results().select(
        "check_name", "failed_rows", "total_rows", "status",
        F.col("quality_run_id").isNotNull().alias("has_run_id"),
    )


def _table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    counts = None
    for name in TABLES:
        row = lake.table(name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts


def _on_silver(operator: Callable[[DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    return lambda spark, sf_dir: operator(_silver(spark, sf_dir))


def _on_activity(operator: Callable[[DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    return _on_silver(lambda transactions: operator(gold.activity(transactions)))


def _on_part(operator: Callable[[DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    """The operator on some days and types."""
    return _on_silver(
        lambda transactions: operator(
            analytics.filter_transactions(transactions, 5, 20, ("CASH_OUT", "TRANSFER"))
        )
    )


def _read_back(name: str) -> Callable[..., DataFrame]:
    """A table as the pipeline wrote it, without its clock times."""
    return lambda spark, sf_dir: _lake(spark, sf_dir).table(name).drop(
        "ingested_at", "quarantined_at"
    )


def _high_risk(transactions: DataFrame) -> DataFrame:
    return gold.high_risk_accounts(accounts.fraud_account_metrics(transactions))


_APPROXIMATE = ("approx_senders", "approx_receivers")


def _approximate_counts_are_close(transactions: DataFrame) -> DataFrame:
    """Whether each approximate count is within a tenth of the exact one."""
    return _close_to_exact(
        analytics.overview_metrics(transactions).select(*_APPROXIMATE), transactions
    )


def _close_to_exact(found: DataFrame, transactions: DataFrame) -> DataFrame:
    exact = transactions.agg(
        F.count_distinct("sender_account").alias("senders"),
        F.count_distinct("receiver_account").alias("receivers"),
    )
    pair = found.join(exact, how="cross")  # one row each
    return pair.select(
        *[
            (F.abs(F.col(f"approx_{side}") - F.col(side)) <= 0.1 * F.col(side)).alias(f"{side}_close")
            for side in ("senders", "receivers")
        ]
    )


def _questions(spark: SparkSession, sf_dir: str) -> Questions:
    return Questions.on(_lake(spark, sf_dir), 5, 20, ("CASH_OUT", "TRANSFER"))


def _reused_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four questions on one filter as rows of (question, item, value)."""
    asked = _questions(spark, sf_dir)
    overview = asked.overview_metrics().drop(*_APPROXIMATE)
    rule = asked.rule_performance()
    signals = asked.behavior_signals().select(
        F.lit("signals").alias("question"),
        F.col("signal").alias("item"),
        F.col("signal_transactions").cast("double").alias("value"),
    )
    suspicious = asked.suspicious_transactions().agg(
        F.count(F.lit(1)).alias("listed"), F.sum("alert_score").alias("score")
    )
    rows = signals
    for name, row in (("overview", overview), ("rule", rule), ("suspicious", suspicious)):
        numbers = row.select(*[F.col(column).cast("double").alias(column) for column in row.columns])
        rows = rows.unionByName(
            numbers.unpivot([], numbers.columns, "item", "value").withColumn("question", F.lit(name))
        )
    return rows


def _filtered_distinct_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _questions(spark, sf_dir)
    return _close_to_exact(asked.approx_accounts(), asked.transactions)


def _amount_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money totals far above and far below everyday amounts."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_type",
        (F.col("value") * F.lit(1e13)).alias("huge"),
        (F.col("value") * F.lit(1e-8)).alias("tiny"),
    )
    huge, tiny = Money.measured(events, "huge"), Money.measured(events, "tiny")
    return tiny.on(huge.on(events)).groupBy("event_type").agg(
        huge.total().alias("huge_total"), tiny.total().alias("tiny_total")
    )


_STRICT = rules.AlertRule(percentile=0.95, require_customer_receiver=True)


def entry(spark: SparkSession) -> DataFrame:
    """Daily fraud summary of the smallest data set, from raw rows to gold."""
    return queries()["gold_fraud_summary_daily"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _lake_queries() | _corpus_queries()


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if corpus_queries is None:
        return {}
    return corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def _lake_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "bronze_transactions": _bronze,
        "bronze_sample": lambda spark, sf_dir: _bronze(spark, sf_dir, SAMPLE_ROWS),
        "bronze_quoted_breaks": lambda spark, sf_dir: _records(spark, sf_dir, 1 << 15),
        "bronze_bad_cells": _bronze_bad_cells,
        "number_texts": _number_texts,
        "load_columns": _load_columns,
        "view_counts": _view_counts,
        "missing_tables": _missing_tables,
        "old_quality_results": _old_quality_results,
        "account_ranks": _on_silver(analytics.account_ranks),
        "quality_scored": lambda spark, sf_dir: _scored(spark, sf_dir).drop("ingested_at"),
        "quarantine": lambda spark, sf_dir: quality.quarantine(_scored(spark, sf_dir)).drop(
            "ingested_at", "quarantined_at"
        ),
        "quality_totals": lambda spark, sf_dir: quality.quality_totals(_scored(spark, sf_dir)),
        "quality_results": lambda spark, sf_dir: quality.check_results(_scored(spark, sf_dir)),
        "silver_transactions": lambda spark, sf_dir: silver.silver_transactions(
            _scored(spark, sf_dir)
        ).drop("ingested_at"),
        "silver_accounts": _on_silver(
            lambda transactions: silver.silver_accounts(
                accounts.account_metrics(accounts.account_events(transactions))
            )
        ),
        "silver_transaction_types": _on_activity(silver.silver_transaction_types),
        "gold_fraud_summary_daily": _on_activity(gold.fraud_summary_daily),
        "gold_fraud_by_transaction_type": _on_activity(gold.fraud_by_transaction_type),
        "gold_high_risk_accounts": _on_silver(_high_risk),
        "gold_hourly_fraud_trend": _on_activity(gold.hourly_fraud_trend),
        "gold_large_transaction_alerts": _on_silver(gold.large_transaction_alerts),
        "filtered_transactions": _on_silver(
            lambda transactions: analytics.filter_transactions(
                transactions, 5, 20, ("CASH_OUT", "TRANSFER", "NO_SUCH_TYPE")
            ).drop("ingested_at")
        ),
        "transaction_bounds": _on_silver(analytics.transaction_bounds),
        "overview_metrics": _on_silver(
            lambda transactions: analytics.overview_metrics(transactions).drop(*_APPROXIMATE)
        ),
        "overview_approx_distinct": _on_silver(
            _approximate_counts_are_close
        ),
        "type_risk": _on_silver(analytics.type_risk),
        "daily_trend": _on_silver(analytics.daily_trend),
        "hourly_heatmap": _on_silver(analytics.hourly_heatmap),
        "behavior_signals": _on_silver(analytics.behavior_signals),
        "amount_decile_risk": _on_silver(analytics.amount_decile_risk),
        "account_risk": _on_silver(analytics.account_risk),
        "account_risk_top30": _on_silver(
            lambda transactions: analytics.account_chart(analytics.account_risk(transactions))
        ),
        "account_loss_pareto": _on_silver(
            lambda transactions: analytics.account_loss_pareto(
                analytics.account_risk(transactions)
            )
        ),
        "source_flag_performance": _on_silver(rules.source_flag_performance),
        "rule_performance": _on_silver(rules.rule_performance),
        "rule_performance_strict": _on_silver(
            lambda transactions: rules.rule_performance(transactions, _STRICT)
        ),
        "rule_confusion": _on_silver(
            lambda transactions: rules.confusion(rules.rule_performance(transactions))
        ),
        "suspicious_transactions": _on_silver(rules.suspicious_transactions),
        "filtered_type_risk": _on_part(analytics.type_risk),
        "filtered_behavior_signals": _on_part(analytics.behavior_signals),
        "filtered_amount_decile_risk": _on_part(analytics.amount_decile_risk),
        "filtered_account_risk": _on_part(analytics.account_risk),
        "filtered_rule_performance": _on_part(rules.rule_performance),
        "reused_questions": _reused_questions,
        "filtered_distinct_accounts": _filtered_distinct_accounts,
        "filtered_rule_grid": lambda spark, sf_dir: _questions(spark, sf_dir).rule_grid(),
        "rule_grid": _on_silver(rules.rule_grid),
        "amount_extremes": _amount_extremes,
        **{f"lake_{name}": _read_back(name) for name in TABLES if name != "bronze_transactions"},
        "table_counts": _table_counts,
        "run_history": lambda spark, sf_dir: History(
            spark, _csv_lake(spark, sf_dir).root
        ).recent_runs().drop("run_id", "started_at", "finished_at"),
        "latest_quality": lambda spark, sf_dir: History(
            spark, _csv_lake(spark, sf_dir).root
        ).latest_quality(),
    }


def oracle_sql() -> dict[str, str]:
    if corpus_queries is None:
        return dict(ORACLE)
    return ORACLE | corpus_queries.ORACLE
