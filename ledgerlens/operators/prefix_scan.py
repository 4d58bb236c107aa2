"""Global row numbers and running sums without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import Scratch


def prefix_scan(
    df: DataFrame, order: list[Column], sums: list[str], scratch: Scratch
) -> DataFrame:
    """df with row_rank (from 1) and, per column of sums, the sum up to and with the row (_upto).

    Rows are dealt out by ranges of the order, which should end in a unique column; ranks and
    sums are taken within each range and moved by the totals of the ranges before it. There is
    one row of totals per range, so that table is as small as the number of tasks. NULL does
    not count in a sum; before the first value a running sum is NULL.
    """
    ranges = scratch.table(
        df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    in_range = Window.partitionBy("range").orderBy(*order)
    up_to_here = in_range.rowsBetween(Window.unboundedPreceding, 0)
    local = ranges.withColumns(
        {
            "row_rank": F.row_number().over(in_range).cast("long"),
            **{f"{name}_upto": F.sum(name).over(up_to_here) for name in sums},
        }
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranges.groupBy("range")
        .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(name).alias(name) for name in sums])
        .select(
            F.col("range"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
            *[F.sum(name).over(earlier).alias(f"{name}_before") for name in sums],
        )
    )

    def moved(name: str) -> Column:
        here, past = F.col(f"{name}_upto"), F.col(f"{name}_before")
        return F.coalesce(here + past, here, past)

    return local.join(F.broadcast(before), "range").select(
        *df.columns,
        (F.col("row_rank") + F.col("rows_before")).alias("row_rank"),
        *[moved(name).alias(f"{name}_upto") for name in sums],
    )
