"""Several questions about one part of silver, which share what each would search for itself.

Beside silver two small tables are kept per day and type: counts of the amounts by value slice,
and sketches of the accounts seen. Both can be added up over any days and types. The slices take
the place of the first pass of a quantile search, so only the few slices that hold the wanted
ranks are read from silver, and that once for all questions.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import Money, amount_kind
from ledgerlens.operators import analytics, rules
from ledgerlens.operators.selection import exact_quantiles, value_slices
from ledgerlens.schema import EXPECTED_TRANSACTION_TYPES
from ledgerlens.sources.lake import Lake

_KEYS = ("transaction_day", "transaction_type")


def amount_slices(transactions: DataFrame) -> DataFrame:
    """Counts of the amounts per day, type, value slice and kind of number."""
    return value_slices(transactions, "amount", _KEYS, kind=amount_kind(F.col("amount")))


def account_sketches(transactions: DataFrame) -> DataFrame:
    """Mergeable sketches of the senders and receivers per day and type."""
    return transactions.groupBy(*_KEYS).agg(
        F.hll_sketch_agg("sender_account").alias("senders"),
        F.hll_sketch_agg("receiver_account").alias("receivers"),
    )


class Questions:
    """A filtered part of silver transactions; its quantiles are searched once.

    The part is fixed when this is made; make another one after silver was written again.
    """

    def __init__(
        self,
        transactions: DataFrame,
        slices: DataFrame,
        sketches: DataFrame,
        first_day: int,
        last_day: int,
        types: Iterable[str] = EXPECTED_TRANSACTION_TYPES,
    ) -> None:
        part = (first_day, last_day, tuple(types))
        self.transactions = analytics.filter_transactions(transactions, *part)
        self._slices = analytics.filter_transactions(slices, *part)
        self._sketches = analytics.filter_transactions(sketches, *part)
        self._quantiles: dict[float, float | None] = {}

    @classmethod
    def on(
        cls,
        lake: Lake,
        first_day: int,
        last_day: int,
        types: Iterable[str] = EXPECTED_TRANSACTION_TYPES,
    ) -> Questions:
        tables = (lake.table(name) for name in ("silver_transactions", "amount_slices", "account_sketches"))
        return cls(*tables, first_day, last_day, types)

    @cached_property
    def _parts(self) -> pd.DataFrame:
        """Slices of the part added up over days and types: some thousand rows at most."""
        return (
            self._slices.groupBy("slice", "kind")
            .agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
            .toPandas()
        )

    @cached_property
    def _counts(self) -> pd.DataFrame:
        merged = self._parts.groupby("slice").agg({"rows": "sum", "low": "min", "high": "max"})
        return merged.assign(slot=0)

    @cached_property
    def _money(self) -> Money:
        kinds = self._parts.dropna(subset=["kind"])
        sizes = kinds[["low", "high"]].abs()
        rows = zip(kinds["kind"].astype(int), sizes.min(axis=1), sizes.max(axis=1), strict=True)
        ranges: dict[int, tuple[float, float]] = {}
        for kind, least, most in rows:
            known = ranges.get(kind, (least, most))
            ranges[kind] = min(known[0], least), max(known[1], most)
        return Money.of_kinds("amount", [(kind, *sizes) for kind, sizes in ranges.items()])

    def quantiles(self, fractions: Iterable[float]) -> dict[float, float | None]:
        """Exact quantiles of the amounts; the first call also finds those the rules offer."""
        wanted = {*fractions}
        if not wanted <= self._quantiles.keys():
            missing = sorted((wanted | {*rules.PERCENTILES}) - self._quantiles.keys())
            self._quantiles |= exact_quantiles(
                self.transactions, "amount", missing, first_counts=self._counts
            )
        return {fraction: self._quantiles[fraction] for fraction in wanted}

    def row_count(self) -> int:
        """Number of transactions, without reading them."""
        return int(self._counts["rows"].sum())

    def approx_accounts(self) -> DataFrame:
        """One row: approx_senders and approx_receivers, without reading transactions."""
        return self._sketches.agg(
            *[
                F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(side)), F.lit(0)).alias(f"approx_{side}")
                for side in ("senders", "receivers")
            ]
        )

    def overview_metrics(self) -> DataFrame:
        return analytics.overview_metrics(self.transactions, self.quantiles, self.approx_accounts(), self._money)

    def type_risk(self) -> DataFrame:
        return analytics.type_risk(self.transactions, self._money)

    def behavior_signals(self) -> DataFrame:
        return analytics.behavior_signals(self.transactions, self.quantiles, self._money)

    def amount_decile_risk(self) -> DataFrame:
        return analytics.amount_decile_risk(self.transactions, self._counts)

    def account_risk(self) -> DataFrame:
        return analytics.account_risk(self.transactions, money=self._money)

    def rule_performance(self, rule: rules.AlertRule | None = None) -> DataFrame:
        return rules.rule_performance(self.transactions, rule, self.quantiles, self._money)

    def rule_grid(self, types: Iterable[str] = rules.DEFAULT_RULE_TYPES) -> DataFrame:
        return rules.rule_grid(self.transactions, types, self.quantiles, self._money)

    def suspicious_transactions(self) -> DataFrame:
        return rules.suspicious_transactions(self.transactions, quantiles=self.quantiles)
