"""Behaviour predicates on silver transactions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.schema import EXPECTED_TRANSACTION_TYPES


def _sender_emptied() -> Column:
    return (F.col("sender_old_balance") > 0) & (F.col("sender_new_balance") == 0)


def sender_drained() -> Column:
    """The sender's balance fell to zero and the amount was at least 95 % of it."""
    return _sender_emptied() & (F.col("amount") >= F.col("sender_old_balance") * F.lit(0.95))


def amount_equals_prior_balance() -> Column:
    """The sender's balance fell to zero and the amount was all of it, to a cent."""
    return _sender_emptied() & (
        F.abs(F.col("amount") - F.col("sender_old_balance")) <= F.lit(0.01)
    )


def amount_at_least(threshold: float | None) -> Column:
    """False for every row when there is no threshold (no rows to take it from)."""
    return F.col("amount") >= F.lit(threshold).cast("double")


def receiver_is_customer() -> Column:
    return F.col("receiver_account").startswith("C")


def receiver_starts_empty() -> Column:
    return F.col("receiver_old_balance") == 0


def type_in(types: Iterable[str]) -> Column:
    """Transaction type is one of the named ones.

    Unknown names are ignored; with no known name left no row matches.
    """
    known = [name for name in types if name in EXPECTED_TRANSACTION_TYPES]
    return F.col("transaction_type").isin(known) if known else F.lit(False)
