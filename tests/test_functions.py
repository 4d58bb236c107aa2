"""Money sums and number text at their extremes."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.casts import double_text, tolerant_double, tolerant_int
from ledgerlens.functions.measures import Money
from ledgerlens.operators.accounts import fraud_account_metrics
from ledgerlens.schema import RAW_COLUMNS, RAW_SCHEMA
from ledgerlens.sources.raw_csv import read_raw


def total(df):
    money = Money.measured(df, "x")
    return money.on(df).agg(money.total().alias("t")).first()["t"]


def test_many_large_amounts_do_not_overflow(spark):
    rows = spark.range(10_000_000).select(F.lit(9.9e11).alias("x"))
    assert total(rows) == 9.9e18


@pytest.mark.parametrize(
    "values",
    [
        [1e-7] * 1000,
        [1.5e13, 2.25e13, 1e-6, -3.5e12],
        [123456789012.34, 0.01, 999999999999.99, -0.05],
        [9.87654321e17, 1.0, -9.87654321e17],
        [0.1] * 10,
        [1.2345e-6, 2.0000001e-5],
    ],
)
def test_totals_are_exact_in_any_order(spark, values):
    exact = float(sum(Decimal(repr(value)) for value in values))
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    assert total(rows) == total(rows.orderBy("x").repartition(3)) == exact


def test_twenty_million_amounts_near_a_quintillion(spark):
    assert total(spark.range(20_000_000).select(F.lit(9e17).alias("x"))) == 1.8e25


def test_a_million_amounts_of_thirteen_places(spark):
    assert total(spark.range(1_000_000).select(F.lit(1e-13).alias("x"))) == 1e-7


@pytest.mark.parametrize("seed", range(4))
def test_any_doubles_are_summed_exactly(spark, seed):
    """Against exact fractions; amounts of some decimal places count as those decimals."""
    rng = random.Random(seed)
    kinds = [
        lambda: rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300),
        lambda: round(rng.uniform(-1e6, 1e6), 2),
        lambda: rng.choice([1e300, -1e300, 5e-324, -2.5e-310, 1.7e306, 0.0, -0.0, 2.0**70, 1e22 / 3]),
        lambda: rng.randint(-(10**18), 10**18) * 1e-21,
    ]
    for kind in (kinds[:1], kinds[2:3], kinds[1:2], kinds):
        values = [rng.choice(kind)() for _ in range(60)]
        values += [-v for v in values[:40]]
        exact = sum((Fraction(meant(v)) for v in values), Fraction(0))
        rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
        found, wanted = total(rows), float(exact)
        # binary and decimal amounts together: the last place may differ
        slack = math.ulp(wanted) if len(kind) > 1 else 0.0
        assert abs(found - wanted) <= slack, (found, wanted)


def meant(value):
    """What an amount counts as: the decimal of 6, 14 or 22 places it is nearest to, or itself."""
    for places in (6, 14, 22):
        whole = float(round(value * 10.0**places)) if abs(value * 10.0**places) < 2**53 else math.inf
        if abs(whole) < 2**53 and whole / 10.0**places == value:
            return Fraction(int(whole), 10**places)
    return Fraction(value)


def test_1e300_and_its_opposite_leave_nothing_behind(spark):
    for values in ([1e300, 1.25, -1e300], [1.25, -1e300, 1e300], [-1e300, 1e-13, 1e300], [3.0, 1e20, -1e20, 0.1]):
        rows = spark.createDataFrame([(v,) for v in values], "x double")
        assert total(rows) == float(sum(Fraction(meant(v)) for v in values))


def test_amounts_that_were_not_measured_are_refused(spark):
    rows = spark.createDataFrame([(1e300,)], "x double")
    with pytest.raises(Exception, match="measured"):
        everyday = Money("x")
        everyday.on(rows).agg(everyday.total()).collect()


def test_sums_can_be_stored_and_added_again(spark):
    rows = spark.createDataFrame([(n % 3, v) for n, v in enumerate([0.1, 1e300, 2.0, 0.2, -1e300, 1e-9, 0.3])], "k int, x double")
    money = Money.measured(rows, "x")
    parts = money.on(rows).groupBy("k").agg(*money.stored_sums("s"), *money.stored_sums("t", F.col("x") < 1))
    for name, values in (("s", [0.1, 1e300, 2.0, 0.2, -1e300, 1e-9, 0.3]), ("t", [0.1, 0.2, -1e300, 1e-9, 0.3])):
        exact = float(sum(Fraction(meant(v)) for v in values))
        stored = Money.stored(parts, name)
        assert parts.agg(stored.total()).first()[0] == exact


def test_infinite_amounts_show(spark):
    rows = spark.createDataFrame([(float("inf"),), (1.0,)], "x double")
    assert total(rows) == float("inf")
    assert total(rows.limit(0)) is None


def test_number_text(spark):
    values = [1e16, 1.5e-5, 1e-5, -2.5e17, float("nan"), float("inf"), float("-inf"), 12345678.5, 0.0001, 1e100]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in rows.select(double_text(F.col("x"))).collect()] == [
        "1e+16", "1.5e-05", "1e-05", "-2.5e+17", "nan", "inf", "-inf", "12345678.5", "0.0001", "1e+100"
    ]


def test_java_suffixes_are_no_numbers(spark):
    rows = spark.createDataFrame([(v,) for v in ("1.5d", "1f", "2L", " 1.5 ", "1e3", ".5", "x", "", "nan")], "x string")
    found = rows.select(tolerant_double(rows, "x"), tolerant_int(rows, "x")).collect()
    assert [r[0] for r in found][:8] == [None, None, None, 1.5, 1000.0, 0.5, None, None]
    assert [r[1] for r in found][:8] == [None, None, None, 2, 1000, 1, None, None]


def test_accounts_combine_before_the_shuffle(spark):
    rows = spark.createDataFrame(
        [(1, 2.0, True, "a", "b")], "transaction_step int, amount double, is_fraud boolean, sender_account string, receiver_account string"
    )
    plan = fraud_account_metrics(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.index("Exchange") < plan.index("partial_")


def test_columns_are_found_by_header(spark, tmp_path):
    names = list(RAW_COLUMNS)
    swapped = [{"nameOrig": "nameDest", "nameDest": "nameOrig"}.get(n, n) for n in names]
    cells = {n: "1" for n in names} | {"nameOrig": "sender", "nameDest": "receiver"}
    path = tmp_path / "x.csv"
    path.write_text(",".join(swapped) + "\n" + ",".join(cells[n] for n in swapped) + "\n")
    row = read_raw(spark, str(path), RAW_SCHEMA).first()
    assert (row["nameOrig"], row["nameDest"]) == ("sender", "receiver")
    path.write_text(",".join(names[1:]) + ",other\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(ValueError, match="other"):
        read_raw(spark, str(path), RAW_SCHEMA)
