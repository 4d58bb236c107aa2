"""Alert rules: how many frauds they catch, and the most suspicious transactions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
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
    receiver_is_customer,
    sender_drained,
    type_in,
)
from ledgerlens.operators.analytics import amount_quantile
from ledgerlens.operators.selection import Quantiles, exact_quantiles

# Choices and defaults of the rule, alerts listed, least score listed.
PERCENTILES = (0.90, 0.95, 0.99, 0.995)
DEFAULT_RULE_TYPES = ("TRANSFER", "CASH_OUT")
SUSPICIOUS_TRANSACTIONS = 500
SUSPICIOUS_SCORE = 55


@dataclass(frozen=True)
class AlertRule:
    """Alert on large transactions of some types, with two optional conditions.

    percentile is taken over all transactions evaluated, not only over those types.
    """

    types: Iterable[str] = DEFAULT_RULE_TYPES
    percentile: float = 0.99
    require_sender_drained: bool = True
    require_customer_receiver: bool = False

    def __post_init__(self) -> None:
        if not 0.0 <= self.percentile <= 1.0:
            raise ValueError(f"percentile must be between 0 and 1, not {self.percentile}")

    @classmethod
    def chosen(cls, percentile: float, **conditions: Any) -> AlertRule:
        """A rule as the report offers it: its percentile must be one of PERCENTILES."""
        if percentile not in PERCENTILES:
            raise ValueError(f"percentile must be one of {PERCENTILES}, not {percentile}")
        return cls(percentile=percentile, **conditions)

    def alert(self, amount_threshold: float | None) -> Column:
        condition = type_in(self.types) & amount_at_least(amount_threshold)
        if self.require_sender_drained:
            condition = condition & sender_drained()
        if self.require_customer_receiver:
            condition = condition & receiver_is_customer()
        return F.coalesce(condition, F.lit(False))


def _performance(
    transactions: DataFrame, alert: Column, *extra: Column, money: Money | None = None
) -> DataFrame:
    is_fraud = F.col("is_fraud")
    money = money or Money.measured(transactions, "amount")
    counts = money.on(transactions).agg(
        *extra,
        count_where(alert).alias("alerts"),
        count_where(alert & is_fraud).alias("true_positives"),
        count_where(alert & ~is_fraud).alias("false_positives"),
        count_where(~alert & is_fraud).alias("false_negatives"),
        count_where(is_fraud).alias("all_frauds"),
        round_to(money.total(alert & is_fraud), 2).alias("fraud_amount_captured"),
        round_to(money.total(is_fraud), 2).alias("total_fraud_amount"),
    )
    return _with_rates(counts)


def _with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 beside the counts of alerts and the captured amounts."""
    hits = F.col("true_positives")
    precision, recall = ratio(hits, F.col("alerts")), ratio(hits, F.col("all_frauds"))
    f1 = ratio(F.lit(200.0) * precision * recall, precision + recall)
    return counts.select(
        *[name for name in counts.columns if not name.endswith(("_captured", "_fraud_amount"))],
        percent(hits, F.col("alerts"), 2).alias("precision_pct"),
        percent(hits, F.col("all_frauds"), 2).alias("recall_pct"),
        round_to(f1, 2).alias("f1_pct"),
        "fraud_amount_captured",
        "total_fraud_amount",
        percent(F.col("fraud_amount_captured"), F.col("total_fraud_amount"), 2).alias(
            "fraud_amount_recall_pct"
        ),
    )


def source_flag_performance(transactions: DataFrame) -> DataFrame:
    """One row: the source system's own flag measured as an alert rule.

    Without alerts precision and F1 are NULL, without hits F1 is NULL.
    """
    return _performance(transactions, F.col("is_flagged_fraud"))


def rule_performance(
    transactions: DataFrame,
    rule: AlertRule | None = None,
    quantiles: Quantiles | None = None,
    money: Money | None = None,
) -> DataFrame:
    """One row: threshold, counts, precision, recall, F1 and captured amount of a rule."""
    rule = rule or AlertRule()
    threshold = amount_quantile(transactions, rule.percentile, quantiles)
    # NULL on empty input, like the counts
    shown = F.max(F.lit(threshold).cast("double")).alias("amount_threshold")
    return _performance(transactions, rule.alert(threshold), shown, money=money)


def rule_cube(
    transactions: DataFrame, quantiles: Quantiles | None = None, money: Money | None = None
) -> tuple[DataFrame, dict[float, float | None]]:
    """Counts of all transactions by what any rule can ask of them, and the amount thresholds.

    band is the number of PERCENTILES whose threshold the amount reaches. With type, drained
    sender, customer receiver and fraud that makes 200 rows at most, from one scan; every
    rule's performance is a sum over some of them.
    """
    if quantiles is None:
        thresholds = exact_quantiles(transactions, "amount", PERCENTILES)
    else:
        found = quantiles(PERCENTILES)
        thresholds = {fraction: found[fraction] for fraction in PERCENTILES}
    band = sum(
        (F.when(amount_at_least(limit), 1).otherwise(0) for limit in thresholds.values()), F.lit(0)
    )

    def known(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    money = money or Money.measured(transactions, "amount")
    cube = money.on(transactions).groupBy(
        band.alias("band"),
        "transaction_type",
        known(sender_drained()).alias("drained"),
        known(receiver_is_customer()).alias("customer"),
        known(F.col("is_fraud")).alias("fraud"),
    ).agg(F.count(F.lit(1)).alias("n"), *money.stored_sums("amount"))
    return cube, thresholds


def rule_grid(
    transactions: DataFrame,
    types: Iterable[str] = DEFAULT_RULE_TYPES,
    quantiles: Quantiles | None = None,
    money: Money | None = None,
) -> DataFrame:
    """rule_performance of every setting of the rule for some types, one row each.

    All 16 settings are added up from one rule_cube. No transactions give no rows.
    """
    cube, thresholds = rule_cube(transactions, quantiles, money)
    money = Money.stored(cube, "amount")
    settings = [
        F.struct(
            F.lit(percentile).alias("percentile"),
            F.lit(drained).alias("require_sender_drained"),
            F.lit(customer).alias("require_customer_receiver"),
            F.lit(thresholds[percentile]).cast("double").alias("amount_threshold"),
            (
                type_in(types)
                & (F.col("band") > number)
                & (F.col("drained") | F.lit(not drained))
                & (F.col("customer") | F.lit(not customer))
            ).alias("alert"),
        )
        for number, percentile in enumerate(PERCENTILES)
        for drained in (True, False)
        for customer in (True, False)
    ]
    alert, fraud = F.col("alert"), F.col("fraud")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    setting = [
        "percentile", "require_sender_drained", "require_customer_receiver", "amount_threshold"
    ]
    counts = (
        cube.select("*", F.inline(F.array(*settings)))
        .groupBy(*setting)
        .agg(
            total(alert).alias("alerts"),
            total(alert & fraud).alias("true_positives"),
            total(alert & ~fraud).alias("false_positives"),
            total(~alert & fraud).alias("false_negatives"),
            total(fraud).alias("all_frauds"),
            round_to(money.total(alert & fraud), 2).alias("fraud_amount_captured"),
            round_to(money.total(fraud), 2).alias("total_fraud_amount"),
        )
    )
    return _with_rates(counts).orderBy(*setting)


def confusion(performance: DataFrame) -> DataFrame:
    """Hits, false alarms and misses of a performance row as three rows."""
    # Names of the outcomes.
    return performance.select(
        F.col("true_positives").alias("True positives"),
        F.col("false_positives").alias("False positives"),
        F.col("false_negatives").alias("False negatives"),
    ).unpivot([], ["True positives", "False positives", "False negatives"], "outcome", "transactions")


def suspicious_transactions(
    transactions: DataFrame,
    limit: int = SUSPICIOUS_TRANSACTIONS,
    quantiles: Quantiles | None = None,
) -> DataFrame:
    """Transactions with an additive score of at least 55, highest score first."""
    p995 = amount_quantile(transactions, 0.995, quantiles)
    top_amount, drained, flagged = amount_at_least(p995), sender_drained(), F.col("is_flagged_fraud")
    # Weights of the score and names of the reasons.
    weights = (
        (top_amount, 35),
        (drained, 25),
        (F.col("transaction_type").isin("TRANSFER", "CASH_OUT"), 20),
        (receiver_is_customer(), 10),
        (flagged, 30),
    )
    score = sum((F.when(holds, points).otherwise(0) for holds, points in weights), F.lit(0))
    reason = (
        F.when(flagged, "source flagged")
        .when(top_amount, "top 0.5% amount")
        .when(drained, "sender drained")
        .otherwise("watchlist")
    )
    return (
        transactions.withColumns({"alert_score": score, "primary_reason": reason})
        .filter(F.col("alert_score") >= SUSPICIOUS_SCORE)
        .orderBy(
            F.desc("alert_score"), F.desc("amount"), "transaction_id", "source_row_number"
        )
        .limit(limit)
        .select(
            "transaction_id",
            "transaction_day",
            "transaction_hour",
            "transaction_type",
            "amount",
            "sender_account",
            "receiver_account",
            "sender_old_balance",
            "sender_new_balance",
            "receiver_old_balance",
            "receiver_new_balance",
            "is_fraud",
            "is_flagged_fraud",
            "alert_score",
            "primary_reason",
        )
    )
