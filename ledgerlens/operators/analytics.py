"""Questions asked of a filtered part of silver transactions."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlens.functions.measures import (
    Money,
    count_where,
    percent,
    ratio,
    round_to,
)
from ledgerlens.functions.predicates import (
    amount_at_least,
    amount_equals_prior_balance,
    receiver_is_customer,
    receiver_starts_empty,
    sender_drained,
    type_in,
)
from ledgerlens.operators.accounts import fraud_account_metrics
from ledgerlens.operators.prefix_scan import prefix_scan
from ledgerlens.operators.selection import Quantiles, exact_quantiles, tile_of
from ledgerlens.schema import EXPECTED_TRANSACTION_TYPES
from ledgerlens.sources.scratch import Scratch

# Accounts listed in the ranking, its chart and the loss chart.
RANKED_ACCOUNTS = 250
CHARTED_ACCOUNTS = 30
LOSS_ACCOUNTS = 50


def filter_transactions(
    transactions: DataFrame,
    first_day: int,
    last_day: int,
    types: Iterable[str] = EXPECTED_TRANSACTION_TYPES,
) -> DataFrame:
    """Transactions of the given types between two days, both included.

    Days are the partition column, so other days are not read. Naming no known type
    selects nothing.
    """
    return transactions.filter(
        F.col("transaction_day").between(first_day, last_day) & type_in(types)
    )


def transaction_bounds(transactions: DataFrame) -> DataFrame:
    """One row: min_day and max_day."""
    return transactions.agg(
        F.min("transaction_day").cast("int").alias("min_day"),
        F.max("transaction_day").cast("int").alias("max_day"),
    )


def amount_quantile(
    transactions: DataFrame, fraction: float, quantiles: Quantiles | None = None
) -> float | None:
    """Exact quantile of the amounts, from quantiles where they were searched before."""
    if quantiles is None:
        return exact_quantiles(transactions, "amount", (fraction,))[fraction]
    return quantiles((fraction,))[fraction]


def overview_metrics(
    transactions: DataFrame,
    quantiles: Quantiles | None = None,
    accounts_seen: DataFrame | None = None,
    money: Money | None = None,
) -> DataFrame:
    """One row of headline numbers; the two distinct counts are approximate.

    accounts_seen is a row of them (approx_senders, approx_receivers) if they are known, money
    is Money.measured of the amounts if known, here and below.
    """
    money = money or Money.measured(transactions, "amount")
    p99 = amount_quantile(transactions, 0.99, quantiles)
    is_fraud = F.col("is_fraud")
    total, frauds = F.count(F.lit(1)), count_where(is_fraud)
    rate = ratio(F.lit(100.0) * frauds.cast("double"), total)
    counts = {
        "total_transactions": total,
        "fraud_transactions": frauds,
        "fraud_rate_pct": F.coalesce(rate, F.lit(0.0)),
        "fraud_amount": round_to(money.total(is_fraud), 2),
        "total_amount": round_to(money.total(), 2),
        "p99_amount": F.lit(p99).cast("double"),
        "approx_senders": F.approx_count_distinct("sender_account"),
        "approx_receivers": F.approx_count_distinct("receiver_account"),
        "source_flagged_transactions": count_where(F.col("is_flagged_fraud")),
    }
    searched = [
        number.alias(name)
        for name, number in counts.items()
        if accounts_seen is None or not name.startswith("approx_")
    ]
    row = money.on(transactions).agg(*searched)
    if accounts_seen is not None:
        row = row.join(accounts_seen, how="cross")  # one row each
    return row.select(*counts)


def _with_baseline(grouped: DataFrame) -> DataFrame:
    """Add the overall fraud rate to a small grouped frame that covers every row once.

    The groups are transaction types or deciles, ten rows at most, so the window is tiny.
    """
    everything = Window.partitionBy()
    return grouped.withColumn(
        "baseline_rate",
        ratio(
            F.sum("fraud_transactions").over(everything),
            F.sum("total_transactions").over(everything),
        ),
    )


def _rate() -> Column:
    return ratio(F.col("fraud_transactions"), F.col("total_transactions"))


def _rate_pct() -> Column:
    return round_to(F.lit(100.0) * _rate(), 4)


def _lift() -> Column:
    return round_to(ratio(_rate(), F.col("baseline_rate")), 2)


def type_risk(transactions: DataFrame, money: Money | None = None) -> DataFrame:
    """Fraud rate, lift and excess fraud per transaction type, highest lift first."""
    is_fraud = F.col("is_fraud")
    money = money or Money.measured(transactions, "amount")
    grouped = money.on(transactions).groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        count_where(is_fraud).alias("fraud_transactions"),
        money.total().alias("amount_sum"),
        money.total(is_fraud).alias("fraud_amount_sum"),
        money.mean().alias("amount_mean"),
        money.mean(is_fraud).alias("fraud_amount_mean"),
    )
    excess = F.col("fraud_transactions").cast("double") - F.col("baseline_rate") * F.col(
        "total_transactions"
    ).cast("double")
    return (
        _with_baseline(grouped)
        .select(
            "transaction_type",
            "total_transactions",
            "fraud_transactions",
            _rate_pct().alias("fraud_rate_pct"),
            _lift().alias("fraud_lift"),
            round_to(excess, 2).alias("excess_fraud_vs_baseline"),
            round_to(F.col("amount_sum"), 2).alias("total_amount"),
            round_to(F.col("fraud_amount_sum"), 2).alias("fraud_amount"),
            round_to(F.col("amount_mean"), 2).alias("avg_amount"),
            round_to(F.col("fraud_amount_mean"), 2).alias("avg_fraud_amount"),
        )
        .orderBy(F.desc("fraud_lift"), F.desc("fraud_amount"), "transaction_type")
    )


def _fraud_by(transactions: DataFrame, *keys: str) -> DataFrame:
    is_fraud = F.col("is_fraud")
    total, frauds = F.count(F.lit(1)), count_where(is_fraud)
    money = Money.measured(transactions, "amount")
    return (
        money.on(transactions)
        .groupBy(*keys)
        .agg(
            total.alias("total_transactions"),
            frauds.alias("fraud_transactions"),
            round_to(F.lit(100.0) * ratio(frauds, total), 4).alias("fraud_rate_pct"),
            round_to(money.total(is_fraud), 2).alias("fraud_amount"),
        )
        .orderBy(*[F.asc_nulls_last(key) for key in keys])
    )


def daily_trend(transactions: DataFrame) -> DataFrame:
    return _fraud_by(transactions, "transaction_day")


def hourly_heatmap(transactions: DataFrame) -> DataFrame:
    return _fraud_by(transactions, "transaction_day", "transaction_hour")


def behavior_signals(
    transactions: DataFrame, quantiles: Quantiles | None = None, money: Money | None = None
) -> DataFrame:
    """How well six signals point at fraud; a row may show several.

    One pass counts all signals side by side. Signals no row shows are left out.
    """
    p99 = amount_quantile(transactions, 0.99, quantiles)
    # Names of the signals.
    signals = {
        "Sender drained to zero": sender_drained(),
        "Amount equals prior sender balance": amount_equals_prior_balance(),
        "Top 1% amount": amount_at_least(p99),
        "Receiver is customer account": receiver_is_customer(),
        "Receiver starts with zero balance": receiver_starts_empty(),
        "Source isFlaggedFraud rule": F.col("is_flagged_fraud"),
    }
    is_fraud = F.col("is_fraud")
    money = money or Money.measured(transactions, "amount")
    counts = [
        F.struct(
            F.lit(name).alias("signal"),
            count_where(shows).alias("signal_transactions"),
            count_where(shows & is_fraud).alias("signal_frauds"),
            money.total(shows & is_fraud).alias("fraud_amount_sum"),
        )
        for name, shows in signals.items()
    ]
    one_row = money.on(transactions).agg(
        F.count(F.lit(1)).alias("all_transactions"),
        count_where(is_fraud).alias("all_frauds"),
        F.array(*counts).alias("signals"),
    )
    rate = ratio(F.col("signal_frauds"), F.col("signal_transactions"))
    baseline = ratio(F.col("all_frauds"), F.col("all_transactions"))
    return (
        one_row.select("all_transactions", "all_frauds", F.inline("signals"))
        .filter("signal_transactions > 0")
        .select(
            "signal",
            "signal_transactions",
            "signal_frauds",
            round_to(F.lit(100.0) * rate, 4).alias("fraud_rate_pct"),
            round_to(ratio(rate, baseline), 2).alias("fraud_lift"),
            percent(F.col("signal_frauds"), F.col("all_frauds"), 2).alias("fraud_capture_pct"),
            round_to(F.col("fraud_amount_sum"), 2).alias("fraud_amount"),
        )
        .orderBy(F.desc("fraud_lift"), F.desc("signal_frauds"), "signal")
    )


def amount_decile_risk(
    transactions: DataFrame, first_counts: pd.DataFrame | None = None
) -> DataFrame:
    """Fraud rate and lift per tenth of the transactions, by amount.

    Equal amounts at a border are told apart by source_row_number.
    """
    decile = tile_of(
        transactions, "amount", "source_row_number", 10, first_counts=first_counts
    )
    grouped = (
        transactions.groupBy(decile.cast("long").alias("amount_decile"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.min("amount").alias("low"),
            F.max("amount").alias("high"),
            count_where(F.col("is_fraud")).alias("fraud_transactions"),
        )
    )
    return (
        _with_baseline(grouped)
        .select(
            "amount_decile",
            "total_transactions",
            round_to(F.col("low"), 2).alias("min_amount"),
            round_to(F.col("high"), 2).alias("max_amount"),
            "fraud_transactions",
            _rate_pct().alias("fraud_rate_pct"),
            _lift().alias("fraud_lift"),
        )
        .orderBy("amount_decile")
    )


def _borders_before(borders: list[tuple[float, str]], amount: Column, account: Column) -> Column:
    """How many of the borders, largest amount first, stand before an account.

    A binary search written as nested conditions: eight comparisons for 250 borders, in
    generated code.
    """
    if not borders:
        return F.lit(0)
    middle = len(borders) // 2
    border_amount, border_account = borders[middle]
    passed = (amount < F.lit(border_amount)) | (
        (amount == F.lit(border_amount)) & (account > F.lit(border_account))
    )
    return F.when(
        passed, _borders_before(borders[middle + 1 :], amount, account) + F.lit(middle + 1)
    ).otherwise(_borders_before(borders[:middle], amount, account))


def _by_risk() -> list[Column]:
    return [F.desc("risk_score"), F.desc("fraud_amount_touched"), F.asc("account_id")]


def _risk_band() -> Column:
    # Bands of the score.
    return (
        F.when(F.col("risk_score") >= 120, "CRITICAL")
        .when(F.col("risk_score") >= 80, "HIGH")
        .when(F.col("risk_score") >= 40, "MEDIUM")
        .otherwise("LOW")
    )


def _scored_accounts(transactions: DataFrame, money: Money | None) -> DataFrame:
    """Totals and risk score of every account that touches a fraud."""
    # Weights and caps of the score.
    score = (
        F.col("fraud_transactions_touched") * F.lit(40.0)
        + F.least(F.col("fraud_amount_touched") / F.lit(100000.0), F.lit(75.0))
        + F.least(F.col("fraud_touch_rate_pct") * F.lit(2.0), F.lit(50.0))
        + F.when(F.col("sent_transactions") == 0, 5.0).otherwise(0.0)
    )
    touch_rate = ratio(F.col("fraud_transactions_touched"), F.col("total_transactions_touched"))
    return (
        fraud_account_metrics(transactions, money)
        .select(
            "account_id",
            "total_transactions_touched",
            "sent_transactions",
            "received_transactions",
            "fraud_transactions_touched",
            round_to(F.col("amount_touched"), 2).alias("total_amount_touched"),
            round_to(F.col("fraud_amount"), 2).alias("fraud_amount_touched"),
            round_to(F.lit(100.0) * touch_rate, 4).alias("fraud_touch_rate_pct"),
        )
        .withColumn("risk_score", round_to(score, 2))
    )


def account_ranks(
    transactions: DataFrame, scratch: Scratch | None = None, money: Money | None = None
) -> DataFrame:
    """Every account that touches a fraud, with its rank and its place in the loss concentration.

    Both orders are distributed prefix scans over ranges of accounts. Equal scores and amounts
    are told apart by account_id.
    """
    scratch = scratch or Scratch(transactions.sparkSession, "account-ranks")
    scored = scratch.table(_scored_accounts(transactions, money), "scored-accounts")
    ranked = prefix_scan(scored, _by_risk(), [], scratch).withColumnRenamed("row_rank", "risk_rank")
    losses = Money.measured(scored, "fraud_amount_touched")
    whole = losses.on(scored).agg(losses.total()).first()[0]
    by_loss = [F.desc("fraud_amount_touched"), F.asc("account_id")]
    placed = prefix_scan(losses.on(ranked), by_loss, losses.names(), scratch)
    upto = losses.value({name: F.col(f"{name}_upto") for name in losses.names()})
    return placed.select(
        "account_id",
        "risk_rank",
        "risk_score",
        _risk_band().alias("risk_band"),
        "fraud_transactions_touched",
        "fraud_amount_touched",
        percent(upto, F.lit(whole).cast("double"), 2).alias("cumulative_loss_pct"),
    )


def account_risk(
    transactions: DataFrame,
    limit: int = RANKED_ACCOUNTS,
    scratch: Scratch | None = None,
    money: Money | None = None,
) -> DataFrame:
    """The riskiest accounts with rank, band and their place in the loss concentration.

    cumulative_loss_pct is the share of the fraud amount of all fraud-touching accounts
    that falls on this account and those with a larger fraud amount. Only the listed
    accounts need it, so the others are summed up between them instead of being sorted.
    """
    scratch = scratch or Scratch(transactions.sparkSession, "account-risk")
    scored = scratch.table(_scored_accounts(transactions, money), "scored-accounts")
    by_risk = _by_risk()
    listed = scratch.table(scored.orderBy(*by_risk).limit(limit), "listed-accounts")
    borders = sorted(
        ((row[0], row[1]) for row in listed.select("fraud_amount_touched", "account_id").collect()),
        key=lambda border: (-border[0], border[1]),
    )
    before = _borders_before(borders, F.col("fraud_amount_touched"), F.col("account_id"))
    losses = Money.measured(scored, "fraud_amount_touched")

    def with_place(accounts: DataFrame) -> DataFrame:
        return accounts.withColumn("listed_before", before)

    # one row per gap between listed accounts, so at most limit + 1 rows
    up_to_here = Window.orderBy("listed_before").rowsBetween(Window.unboundedPreceding, 0)
    gaps = with_place(losses.on(scored)).groupBy("listed_before").agg(*losses.stored_sums("gap"))
    gap = Money.stored(gaps, "gap")

    def over(window: WindowSpec) -> Column:
        return gap.value({name: F.sum(name).over(window) for name in gap.names()})

    cumulative = gaps.select(
        "listed_before",
        over(up_to_here).alias("cumulative_amount"),
        over(Window.partitionBy()).alias("total_amount"),
    )
    # the window covers the listed accounts only
    return (
        with_place(listed)
        .withColumn("risk_rank", F.row_number().over(Window.orderBy(*by_risk)).cast("long"))
        .join(cumulative, "listed_before")
        .select(
            "risk_rank",
            "account_id",
            "total_transactions_touched",
            "sent_transactions",
            "received_transactions",
            "fraud_transactions_touched",
            "total_amount_touched",
            "fraud_amount_touched",
            "fraud_touch_rate_pct",
            "risk_score",
            _risk_band().alias("risk_band"),
            percent(F.col("cumulative_amount"), F.col("total_amount"), 2).alias(
                "cumulative_loss_pct"
            ),
        )
        .orderBy("risk_rank")
    )


def account_chart(ranked: DataFrame) -> DataFrame:
    """The first accounts of account_risk."""
    return ranked.orderBy("risk_rank").limit(CHARTED_ACCOUNTS)


def account_loss_pareto(ranked: DataFrame) -> DataFrame:
    """Of the accounts in account_risk, those with the largest fraud amount."""
    return ranked.orderBy(F.desc("fraud_amount_touched"), "account_id").limit(LOSS_ACCOUNTS)
