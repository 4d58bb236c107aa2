"""Exact order statistics without a global sort: values at given ranks, quantiles, tiles.

Spark's percentile keeps every distinct value in the memory of one task, and ntile over a
whole table sorts it in one task. Here a rank is found by counting instead. A first pass
counts the rows per order of magnitude, finely divided; each further pass divides the slice
that holds the rank into smaller ones. Once few rows are left, their values are counted one
by one. A pass reads one column and shuffles one row per task and slice, whatever the skew.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slices per doubling of the value in the first pass, and per range in the others.
SLICES_PER_OCTAVE = 64
SLICES = 4096
# Count values one by one when at most this many rows are left.
FINAL_ROWS = 100_000


Quantiles = Callable[[Iterable[float]], dict[float, float | None]]


@dataclass(frozen=True)
class Pick:
    """The value at a rank, with the number of rows before and at that value."""

    value: float | int
    below: int
    equal: int


@dataclass
class _Range:
    """A part of the values of a group that holds some of the wanted ranks."""

    group: int
    member: Column
    low: float | int
    high: float | int
    below: int
    rows: int
    ranks: list[int]

    @property
    def is_one_value(self) -> bool:
        return self.low == self.high or math.isnan(self.low)

    def contains(self, x: Column) -> Column:
        return self.member & x.between(F.lit(self.low), F.lit(self.high))

    def slice_of(self, x: Column, slices: int) -> Column:
        share = (x - F.lit(self.low)).cast("double") / F.lit(float(self.high - self.low))
        return F.floor(share * F.lit(float(slices)))

    def divide(self, parts: pd.DataFrame) -> list[_Range]:
        """The parts (rows, low, high) of this range that hold its ranks."""
        parts = parts.sort_values("low")
        rows, low, high = (parts[name].to_numpy() for name in ("rows", "low", "high"))
        ends = np.cumsum(rows)
        held: dict[int, list[int]] = {}
        for rank in self.ranks:
            at = int(np.searchsorted(ends, rank - self.below, side="right"))
            held.setdefault(at, []).append(rank)
        return [
            _Range(
                self.group, self.member, low[at].item(), high[at].item(),
                self.below + int(ends[at] - rows[at]), int(rows[at]), ranks,
            )
            for at, ranks in held.items()
        ]


def select_ranks(
    df: DataFrame,
    column: str,
    ranks_for: Callable[[int, int], Iterable[int]],
    groups: dict[int, Column] | None = None,
    slices: int = SLICES,
    final_rows: int = FINAL_ROWS,
    first_counts: pd.DataFrame | None = None,
) -> dict[int, tuple[int, dict[int, Pick]]]:
    """Find the values at zero-based ranks of a numeric column, per group.

    groups are a few conditions that exclude each other, without them all rows are group 0.
    ranks_for(group, rows) names the ranks wanted once the row count is known. NULL values
    do not count, NaN sorts last. first_counts are value_slices of the same rows
    added up (slot 0, rows, low, high) if known, which saves the pass over all of them. Returns {group: (rows, {rank: Pick})}; an absent
    group has no rows.
    """
    x = F.col(column)
    groups = groups or {0: F.lit(True)}
    counts = first_counts
    if counts is None:
        counts = _count_parts(
            df, x,
            [(group, member & x.isNotNull(), _magnitude(x)) for group, member in groups.items()],
        )
    found: dict[int, tuple[int, dict[int, Pick]]] = {}
    ranges: list[_Range] = []
    for group, parts in counts.groupby("slot"):
        rows = int(parts["rows"].sum())
        found[group] = (rows, {})
        ranks = sorted(set(ranks_for(group, rows)))
        whole = _Range(group, groups[group], math.nan, math.nan, 0, rows, ranks)
        ranges += whole.divide(parts)

    while ranges:
        for item in ranges:
            if item.is_one_value:
                for rank in item.ranks:
                    found[item.group][1][rank] = Pick(item.low, item.below, item.rows)
        ranges = [item for item in ranges if not item.is_one_value]
        if not ranges:
            break
        last = sum(item.rows for item in ranges) <= final_rows
        counts = _count_parts(
            df, x,
            [
                (number, item.contains(x), x if last else item.slice_of(x, slices))
                for number, item in enumerate(ranges)
            ],
        )
        ranges = [
            part
            for number, item in enumerate(ranges)
            for part in item.divide(counts[counts["slot"] == number])
        ]
    return found


def _count_parts(
    df: DataFrame, x: Column, slots: list[tuple[int, Column, Column]]
) -> pd.DataFrame:
    """One pass: rows, least and greatest value per slot (number, condition) and part."""
    inside = F.lit(False)
    slot_of, part_of = F.when(F.lit(False), F.lit(None)), F.when(F.lit(False), F.lit(None))
    for number, hit, part in slots:
        inside = inside | hit
        slot_of, part_of = slot_of.when(hit, F.lit(number)), part_of.when(hit, part)
    return (
        df.filter(inside)
        .groupBy(slot_of.alias("slot"), part_of.alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(x).alias("low"), F.max(x).alias("high"))
        .select("slot", "rows", "low", "high")
        .toPandas()
    )


def value_slices(
    df: DataFrame, column: str, keys: Iterable[str], **parts: Column
) -> DataFrame:
    """Rows, least and greatest value per key and slice of the values, and per further parts.

    These counts can be added up over any keys, so a table of them answers the first pass of a
    search on every selection of keys. It has at most SLICES_PER_OCTAVE rows per key and
    doubling of the values, however many rows are counted.
    """
    x = F.col(column)
    return (
        df.filter(x.isNotNull())
        .groupBy(
            *keys,
            _magnitude(x).alias("slice"),
            *[part.alias(name) for name, part in parts.items()],
        )
        .agg(F.count(F.lit(1)).alias("rows"), F.min(x).alias("low"), F.max(x).alias("high"))
    )


def _magnitude(x: Column) -> Column:
    """A number shared by values of one sign within 1/SLICES_PER_OCTAVE of a doubling.

    Doubles span about 2100 doublings, so sizes stay within 150,000 either way; infinity is
    cut to that. Zero and NaN have numbers of their own.
    """
    value = x.cast("double")
    size = F.least(
        F.floor(F.log2(F.abs(value)) * F.lit(float(SLICES_PER_OCTAVE))), F.lit(150_000)
    )
    return (
        F.when(F.isnan(value), F.lit(500_000))
        .when(value > 0, size)
        .when(value < 0, F.lit(-500_000) - size)
        .otherwise(F.lit(-200_000))
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    fractions: Iterable[float],
    slices: int = SLICES,
    final_rows: int = FINAL_ROWS,
    first_counts: pd.DataFrame | None = None,
) -> dict[float, float | None]:
    """Continuous quantiles: linear between the two rows around rank (n - 1) * fraction.

    None for every fraction if there is no value.
    """
    fractions = list(fractions)

    def neighbours(_: int, rows: int) -> list[int]:
        return [
            rank
            for fraction in fractions
            for rank in (
                math.floor((rows - 1) * fraction),
                math.ceil((rows - 1) * fraction),
            )
        ]

    result = select_ranks(
        df, column, neighbours, slices=slices, final_rows=final_rows, first_counts=first_counts
    )
    if not result:
        return dict.fromkeys(fractions)
    rows, picks = result[0]

    def at(fraction: float) -> float:
        position = (rows - 1) * fraction
        lower, upper = math.floor(position), math.ceil(position)
        low, high = float(picks[lower].value), float(picks[upper].value)
        if lower == upper or low == high:
            return low
        weight = position - lower
        # rounded once for the product and the sum, which the reference results rely on
        return math.fma(low, 1.0 - weight, high * weight)

    return {fraction: at(fraction) for fraction in fractions}


def tile_of(
    df: DataFrame,
    column: str,
    tie_breaker: str,
    tiles: int,
    slices: int = SLICES,
    final_rows: int = FINAL_ROWS,
    first_counts: pd.DataFrame | None = None,
) -> Column:
    """NTILE(tiles) ordered by (column, tie_breaker), as an expression on each row.

    Only the last row of every tile is looked up; comparing with these rows tells a row's
    tile, so the table is neither sorted nor shuffled. tie_breaker must be unique and not
    NULL, column must not be NULL.
    """

    def tile_ends(rows: int) -> list[int]:
        size, longer = divmod(rows, tiles)
        ends = [size * tile + min(tile, longer) for tile in range(1, tiles)]
        return sorted({end for end in ends if 0 < end < rows})

    selected = select_ranks(
        df, column, lambda _, rows: [end - 1 for end in tile_ends(rows)],
        slices=slices, final_rows=final_rows, first_counts=first_counts,
    )
    if not selected:
        return F.lit(1)
    rows, picks = selected[0]
    ends = tile_ends(rows)

    # Where a tile ends among rows of equal value, the tie breaker decides.
    values: list[float] = []
    wanted: dict[int, list[int]] = {}
    for end in ends:
        pick = picks[end - 1]
        if end < pick.below + pick.equal:
            if pick.value not in values:
                values.append(pick.value)
            wanted.setdefault(values.index(pick.value), []).append(end - 1 - pick.below)
    ties: dict[int, tuple[int, dict[int, Pick]]] = {}
    if values:
        ties = select_ranks(
            df.filter(F.col(column).isin(values)), tie_breaker, lambda label, _: wanted[label],
            {number: F.col(column) == F.lit(value) for number, value in enumerate(values)},
            slices=slices, final_rows=final_rows,
        )

    tile = F.lit(1)
    for end in ends:
        pick = picks[end - 1]
        beyond = F.col(column) > F.lit(pick.value)
        if end < pick.below + pick.equal:
            cut = ties[values.index(pick.value)][1][end - 1 - pick.below].value
            beyond = beyond | (
                (F.col(column) == F.lit(pick.value)) & (F.col(tie_breaker) > F.lit(cut))
            )
        tile = tile + F.when(beyond, 1).otherwise(0)
    return tile
