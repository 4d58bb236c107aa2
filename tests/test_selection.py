import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.selection import exact_quantiles, select_ranks, tile_of


def amounts(spark, values):
    return spark.createDataFrame(
        list(enumerate(values)), "id long, amount double"
    ).repartition(4)


def skewed(count, seed=1):
    """A third of the rows share one amount; the rest has a long tail."""
    rng = random.Random(seed)
    return [
        50.0 if i % 3 == 0 else round(math.exp(rng.uniform(0, 14)), 2) for i in range(count)
    ]


@pytest.mark.parametrize("slices,final_rows", [(4, 1), (4, 50), (64, 10), (4096, 100_000)])
def test_quantiles_equal_percentile(spark, slices, final_rows):
    df = amounts(spark, skewed(1000)).cache()
    fractions = (0.0, 0.1, 0.5, 0.9, 0.95, 0.99, 0.995, 1.0)
    found = exact_quantiles(df, "amount", fractions, slices, final_rows)
    expected = df.agg(F.percentile("amount", F.array(*map(F.lit, fractions)))).first()[0]
    assert [found[f] for f in fractions] == pytest.approx(expected, rel=1e-14)
    df.unpersist()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.5, float("inf"), float("-inf"), float("nan")])
        ),
        min_size=1,
        max_size=40,
    )
)
def test_values_at_ranks(spark, values):
    df = amounts(spark, values)
    ranks = sorted({0, len(values) // 2, len(values) - 1})
    rows, picks = select_ranks(df, "amount", lambda *_: ranks, slices=3, final_rows=2)[0]
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    assert rows == len(values)
    for rank in ranks:
        value, expected = picks[rank].value, ordered[rank]
        assert value == expected or (math.isnan(value) and math.isnan(expected))
        assert picks[rank].below <= rank < picks[rank].below + picks[rank].equal


@pytest.mark.parametrize("slices,final_rows", [(3, 1), (16, 20), (4096, 100_000)])
@pytest.mark.parametrize("count", [1, 7, 10, 23, 500])
def test_tiles_equal_ntile(spark, count, slices, final_rows):
    df = amounts(spark, skewed(count)).cache()
    tile = tile_of(df, "amount", "id", 10, slices, final_rows)
    plain = F.ntile(10).over(Window.orderBy("amount", "id"))
    assert df.select(tile.alias("tile"), plain.alias("plain")).filter("tile <> plain").count() == 0
    df.unpersist()


def test_no_rows(spark):
    df = amounts(spark, [1.0]).filter("id < 0")
    assert exact_quantiles(df, "amount", (0.5,)) == {0.5: None}
    assert df.select(tile_of(df, "amount", "id", 10)).count() == 0


def test_null_values_do_not_count(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, 6.0)], "id long, amount double")
    assert exact_quantiles(df, "amount", (0.5,)) == {0.5: 5.0}


def test_passes_read_one_column(spark, tmp_path):
    amounts(spark, skewed(50)).withColumn("other", F.lit("x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    tile = tile_of(df, "amount", "id", 10)
    plan = df.select(tile.alias("t")).groupBy("t").count()._jdf.queryExecution().toString()
    scan = plan[plan.rindex("FileScan parquet"):]
    assert "ReadSchema: struct<id:bigint,amount:double>" in scan
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan
