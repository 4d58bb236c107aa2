"""Counts, exact money totals, ratios and rounding."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimal places at which amounts are looked for; powers of ten up to the 22nd are exact doubles.
_PLACES = (6, 14, 22)
# Whole numbers at these places are summed in pieces of so many bits, with room for 3e13 rows.
_LIMB_BITS = 18
_LIMB = 1 << _LIMB_BITS
_LARGEST_WHOLE = float(1 << 53)
# All other amounts are cut at every 24th bit, counted from the lowest one a double can have.
_BIN_BITS = 24
_LOWEST_BIT = -1074


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; NULL on empty input, like SUM(CASE ...)."""
    return F.sum(F.when(condition, 1).otherwise(0))


def round_to(x: Column, digits: int) -> Column:
    """Round half away from zero on the scaled binary value (1.005 to 2 digits is 1.0)."""
    scale = float(10**digits)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def _is_finite(x: Column) -> Column:
    return x.isNotNull() & (F.abs(x) < F.lit(float("inf")))


def _whole(x: Column, places: int) -> Column:
    return F.rint(x * F.lit(10.0**places))


def _is_named(x: Column, places: int) -> Column:
    """Whether a double is the one nearest to a decimal of so many places."""
    whole = _whole(x, places)
    return (F.abs(whole) < F.lit(_LARGEST_WHOLE)) & (whole / F.lit(10.0**places) == x)


def amount_kind(x: Column) -> Column:
    """Place in _PLACES of the first that names an amount, their number if none; else NULL."""
    kind = F.lit(len(_PLACES))
    for number, places in reversed(list(enumerate(_PLACES))):
        kind = F.when(_is_named(x, places), number).otherwise(kind)
    return F.when(_is_finite(x), kind)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times but works it out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _power(exponent: int) -> float:
    return math.ldexp(1.0, exponent)


@dataclass(frozen=True)
class Money:
    """Exact sums of a column of doubles, in any order of the rows and of any size.

    An amount that is a decimal of 6 places (or 14, or 22) counts as that decimal: as a whole
    number of millionths, summed in three pieces as bigints. Any other amount counts as the
    binary fraction it is: cut into bins of 24 bits of exponent, one bigint sum a bin. Sums are
    joined and rounded once, at the end. NaN and infinity show in the total.

    places and bins name the sums a column needs; measured finds them in one narrow pass. Amounts
    of everyday size need the three pieces alone. A row the sums have no room for is refused.
    """

    column: str
    places: tuple[int, ...] = _PLACES[:1]
    bins: tuple[int, ...] = ()

    @classmethod
    def measured(cls, df: DataFrame, column: str) -> Money:
        x = F.col(column)
        size = F.abs(x)
        kinds = df.select(amount_kind(x).alias("kind"), size.alias("size"))
        found = kinds.groupBy("kind").agg(F.min("size"), F.max("size")).collect()
        return cls.of_kinds(column, [tuple(row) for row in found])

    @classmethod
    def of_slices(cls, slices: DataFrame, column: str) -> Money:
        """The same from counts that hold the kind of the values, without reading them."""
        size = F.greatest(F.abs("low"), F.abs("high"))
        least = F.least(F.abs("low"), F.abs("high"))
        kinds = slices.groupBy("kind").agg(F.min(least), F.max(size)).collect()
        return cls.of_kinds(column, [tuple(row) for row in kinds])

    @classmethod
    def of_kinds(cls, column: str, kinds: Iterable[tuple[int | None, float, float]]) -> Money:
        """From the kinds of the amounts, each with the least and the greatest size among them."""
        places, bins = set(_PLACES[:1]), ()
        for kind, least, most in kinds:
            if kind == len(_PLACES):
                low = max(math.frexp(least)[1] - 53, _LOWEST_BIT)
                high = math.frexp(most)[1] - 1
                bins = tuple(
                    range((low - _LOWEST_BIT) // _BIN_BITS, (high - _LOWEST_BIT) // _BIN_BITS + 1)
                )
            elif kind is not None:
                places.add(_PLACES[kind])
        return cls(column, tuple(sorted(places)), bins)

    @classmethod
    def stored(cls, df: DataFrame, name: str) -> Money:
        """From a frame that holds sums of this kind under a name."""
        numbers = [
            column.removeprefix(name) for column in df.columns
            if re.fullmatch(re.escape(name) + r"_(p\d+_\d|b\d+)", column)
        ]
        places = {int(text[2:].split("_")[0]) for text in numbers if text.startswith("_p")}
        bins = {int(text[2:]) for text in numbers if text.startswith("_b")}
        return cls(name, tuple(sorted(places)), tuple(sorted(bins)))

    def named(self, name: str) -> Money:
        return replace(self, column=name)

    def names(self) -> list[str]:
        """Columns of the pieces: of each number of places, of each bin, and of what is no number."""
        return [
            *[f"{self.column}_p{places}_{limb}" for places in self.places for limb in range(3)],
            *[f"{self.column}_b{number}" for number in self.bins],
            f"{self.column}_x",
        ]

    def on(self, df: DataFrame) -> DataFrame:
        """df with the pieces of every amount as columns."""
        x = F.col(self.column)
        finite, left = _is_finite(x), F.lit(True)
        none = F.lit(0).cast("long")
        wholes: dict[str, Column] = {}
        for places in self.places:
            named = _is_named(x, places)
            whole = F.when(finite & left & named, _whole(x, places).cast("long"))
            if places == self.places[-1] and not self.bins:
                unforeseen = F.raise_error(F.lit(f"{self.column} is out of the range measured before"))
                whole = whole.when(finite & left, unforeseen.cast("long"))
            wholes[f"{self.column}_w{places}"] = F.when(x.isNotNull(), whole.otherwise(none))
            left = left & ~named
        size = F.when(finite & left, F.abs(x)).otherwise(0.0)
        sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
        mask = F.lit(_LIMB - 1).cast("long")
        pieces: list[Column] = []
        for name in wholes:
            whole = F.col(name)
            pieces += [
                whole.bitwiseAND(mask),
                F.shiftright(whole, _LIMB_BITS).bitwiseAND(mask),
                F.shiftright(whole, 2 * _LIMB_BITS),
            ]
        pieces += [F.when(x.isNotNull(), sign * self._bits(size, number)) for number in self.bins]
        pieces.append(F.when(~finite, x))
        # two steps, so that a whole number is worked out once for its three pieces
        staged = df.withColumns(wholes).withColumns(dict(zip(self.names(), pieces, strict=True)))
        return staged.drop(*wholes)

    @staticmethod
    def _bits(size: Column, number: int) -> Column:
        """The 24 bits of a bin as a whole number; scaling by a power of two and % are exact."""
        lowest = number * _BIN_BITS + _LOWEST_BIT
        half = -lowest // 2
        scaled = size * F.lit(_power(half)) * F.lit(_power(-lowest - half))
        bits = F.floor(scaled % F.lit(float(1 << _BIN_BITS)))
        beyond = lowest + _BIN_BITS + 53
        if beyond >= 1024:
            return bits
        # no bit of a size that large reaches down here
        return F.when(size >= F.lit(_power(beyond)), F.lit(0).cast("long")).otherwise(bits)

    def sums(self, where: Column | None = None) -> dict[str, Column]:
        """Sums of the pieces, over all rows or those that meet a condition (0 if none does)."""
        *numbers, rest = self.names()
        if where is None:
            return {name: F.sum(name) for name in (*numbers, rest)}
        return {
            **{name: F.sum(F.when(where, F.col(name)).otherwise(0)) for name in numbers},
            rest: F.sum(F.when(where, F.col(rest))),
        }

    def stored_sums(self, name: str, where: Column | None = None) -> list[Column]:
        """Sums of the pieces as columns that stored finds again under the name."""
        found = self.sums(where)
        return [
            column.alias(new)
            for column, new in zip(found.values(), self.named(name).names(), strict=True)
        ]

    def total(self, where: Column | None = None) -> Column:
        return self.value(self.sums(where))

    def mean(self, where: Column | None = None) -> Column:
        """Mean of the non-NULL amounts (that meet the condition); NULL if there are none."""
        x = F.col(self.column)
        return ratio(self.total(where), F.count(x if where is None else F.when(where, x)))

    def value(self, sums: dict[str, Column]) -> Column:
        """Sums of the pieces, or running ones, as one double."""
        *numbers, rest = [sums[name] for name in self.names()]
        limbs = numbers[: 3 * len(self.places)]
        wholes = [self._joined(limbs[3 * at : 3 * at + 3]) for at in range(len(self.places))]
        if self.places == _PLACES[:1]:
            cut = F.lit(Decimal(1).scaleb(-_PLACES[0])).cast(f"decimal({_PLACES[0]},{_PLACES[0]})")
            amount = (wholes[0] * cut).cast("double")
        else:
            amount = self._of_places(wholes)
        if self.bins:
            amount = self._with_bins(amount, numbers[3 * len(self.places) :])
        return F.when(rest.isNull(), amount).otherwise(rest + F.coalesce(amount, F.lit(0.0)))

    @staticmethod
    def _joined(limbs: list[Column]) -> Column:
        """Three sums of pieces as a whole number; 30 digits hold every sum there is room for."""
        whole = None
        for number, limb in enumerate(limbs):
            unit = 1 << (number * _LIMB_BITS)
            part = limb.cast("decimal(19,0)") * F.lit(unit).cast("decimal(11,0)")
            whole = part if whole is None else whole + part
        return whole.cast("decimal(31,0)")

    def _of_places(self, wholes: list[Column]) -> Column:
        """Whole numbers at several decimal places as one double, rounded once."""
        finest = _PLACES[-1]

        def number(value: int, digits: int) -> Column:
            return F.lit(Decimal(value)).cast(f"decimal({digits},0)")

        units, fraction = number(0, 31), number(0, 26)
        for whole, places in zip(wholes, self.places, strict=True):
            one = number(10**places, places + 1)
            rest = F.pmod(whole, one)
            units = (units + ((whole - rest) / one).cast("decimal(31,0)")).cast("decimal(33,0)")
            fine = rest.cast(f"decimal({places},0)") * number(10 ** (finest - places), finest - places + 1)
            fraction = (fraction + fine.cast("decimal(25,0)")).cast("decimal(26,0)")
        one = number(10**finest, finest + 1)

        def text(state: Column) -> Column:
            # below zero the fraction counts from the other side
            below = state["units"] < 0
            turned = below & (state["fraction"] > 0)
            before = (
                F.when(turned, -(state["units"] + 1)).when(below, -state["units"]).otherwise(state["units"])
            )
            after = F.when(turned, one - state["fraction"]).otherwise(state["fraction"])
            return F.concat(
                F.when(below, "-").otherwise(""),
                before.cast("decimal(35,0)").cast("string"),
                F.lit("."),
                F.lpad(after.cast(f"decimal({finest},0)").cast("string"), finest, "0"),
            )

        def carried(state: Column) -> Column:
            over = F.pmod(state["fraction"], one)
            carry = ((state["fraction"] - over) / one).cast("decimal(4,0)")
            return F.struct(
                (state["units"] + carry).cast("decimal(34,0)").alias("units"),
                over.cast(f"decimal({finest},0)").alias("fraction"),
            )

        state = F.struct(units.alias("units"), fraction.alias("fraction"))
        return _let(_let(state, carried), text).cast("double")

    def _with_bins(self, amount: Column, bins: list[Column]) -> Column:
        """The sums of the bins, rounded once to a double, and the decimals added to them."""
        # room for the carries out of the highest bin
        entries = [*[F.coalesce(column, F.lit(0).cast("long")) for column in bins]]
        spare = [F.lit(0).cast("long")] * 3
        first = self.bins[0]
        weights = F.array(
            *[
                F.lit(_power(min((first + at) * _BIN_BITS + _LOWEST_BIT, 1023)))
                for at in range(len(entries) + len(spare))
            ]
        )

        def carried(digits: Column) -> Column:
            """Bins as digits from 0 to 2**24 - 1, the highest one signed."""
            state = F.struct(
                F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits")
            )

            def step(state: Column, digit: Column) -> Column:
                whole = digit + state["carry"]
                return F.struct(
                    F.shiftright(whole, _BIN_BITS).alias("carry"),
                    F.concat(
                        state["digits"],
                        F.array(whole.bitwiseAND(F.lit((1 << _BIN_BITS) - 1).cast("long"))),
                    ).alias("digits"),
                )

            return F.aggregate(digits, state, step)

        def rounded(digits: Column) -> Column:
            """Four digits from the highest one on; a bit more tells whether anything follows."""
            used = F.filter(F.sequence(F.lit(0), F.size(digits) - 1), lambda at: F.get(digits, at) > 0)
            return _let(used, lambda places: from_top(digits, F.array_max(places), F.array_min(places)))

        def from_top(digits: Column, top: Column, least: Column) -> Column:
            def digit(below: int) -> Column:
                return F.coalesce(F.get(digits, top - below), F.lit(0).cast("long"))

            def weight(below: int) -> Column:
                return F.coalesce(F.get(weights, top - below), F.lit(0.0))

            two = F.lit(1 << _BIN_BITS).cast("long")
            upper = F.when(top >= 1, (digit(0) * two + digit(1)) * weight(1)).otherwise(
                digit(0) * weight(0)
            )
            follows = F.when(least < top - 3, 1).otherwise(0)
            lower = (
                F.when(top >= 4, ((digit(2) * two + digit(3)) * 2 + follows) * (weight(3) / F.lit(2.0)))
                .when(top == 3, (digit(2) * two + digit(3)) * weight(3))
                .otherwise(digit(2) * weight(2))
            )
            return F.coalesce(upper + lower, F.lit(0.0))

        # a negative total leaves a negative carry; its digits are those of the opposite
        total = _let(
            F.array(*entries, *spare),
            lambda whole: _let(
                carried(whole),
                lambda plus: F.when(
                    plus["carry"] < 0,
                    _let(
                        carried(F.transform(whole, lambda digit: -digit)),
                        lambda minus: -rounded(minus["digits"]),
                    ),
                ).otherwise(rounded(plus["digits"])),
            ),
        )
        return F.when(amount.isNull(), F.lit(None).cast("double")).otherwise(total + amount)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return round_to(ratio(F.lit(100.0) * numerator.cast("double"), denominator), digits)
