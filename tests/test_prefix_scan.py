import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import analytics
from ledgerlens.operators.prefix_scan import prefix_scan
from ledgerlens.sources.scratch import Scratch
from test_analytics import transactions


@pytest.mark.parametrize("count", [0, 1, 50, 3000])
def test_equals_a_plain_window(spark, count):
    rng = random.Random(count)
    rows = [(n, "same" if n % 3 == 0 else f"k{rng.randint(0, 99)}", None if n % 7 else rng.randint(-9, 9)) for n in range(count)]
    df = spark.createDataFrame(rows, "id long, k string, v long").repartition(6)
    order = [F.desc("k"), F.asc("id")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = prefix_scan(df, order, ["v"], Scratch(spark, "scan"))
        rows_found = sorted(found.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    window = Window.orderBy(*order)
    plain = df.withColumns(
        {
            "row_rank": F.row_number().over(window).cast("long"),
            "v_upto": F.sum("v").over(window.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    assert rows_found == sorted(plain.collect())


def test_no_window_over_all_accounts(spark):
    rows = [("TRANSFER", 10.0 + n, f"C{n}", f"C{n + 1}", 1.0, 0.0, 0.0, n % 2 == 0, False) for n in range(40)]
    ranks = analytics.account_ranks(transactions(spark, rows))
    plan = ranks._jdf.queryExecution().analyzed().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    # over accounts within a range, or over one row per range
    assert windows and all("range#" in line for line in windows)
    found = ranks.collect()
    assert sorted(row["risk_rank"] for row in found) == list(range(1, len(found) + 1))
    assert max(row["cumulative_loss_pct"] for row in found) == 100.0


def test_account_ranks_agree_with_the_ranking(spark):
    rows = [("TRANSFER", 10.0 * (n % 9 + 1), f"C{n % 60}", f"C{(n * 7) % 50}", 1.0, 0.0, 0.0, n % 2 == 0, False) for n in range(400)]
    df = transactions(spark, rows)
    ranks = {row["account_id"]: row for row in analytics.account_ranks(df).collect()}
    listed = analytics.account_risk(df, limit=20).collect()
    assert len(listed) == 20
    for row in listed:
        other = ranks[row["account_id"]]
        for name in ("risk_rank", "risk_score", "risk_band", "cumulative_loss_pct"):
            assert row[name] == other[name]
