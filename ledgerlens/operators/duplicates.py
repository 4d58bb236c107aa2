"""Rank and count of exact copies, safe when a third of all rows are the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.scratch import Scratch

# A group of copies is ranked in blocks of this many consecutive row numbers.
ROWS_PER_BLOCK = 1_000_000
# Groups of up to a block's rows divided by this are ranked whole.
SMALL_GROUPS = 10
# Words of 64 bits in the filter of repeated hashes; only words with a bit set are rows, so the
# broadcast filter never has more rows than this.
FILTER_WORDS = 1 << 20


def rank_copies(
    df: DataFrame,
    key_columns: tuple[str, ...],
    order_column: str,
    scratch: Scratch,
    rows_per_block: int = ROWS_PER_BLOCK,
    layout: str | None = None,
) -> DataFrame:
    """Add duplicate_count and duplicate_rank (bigint) over rows whose key columns agree.

    Columns agree when their text does and NULL is the same as empty text.

    1. Hashes that occur more than once are found from 8-byte hashes alone; equal ones combine
       before the shuffle. They set bits in a Bloom filter of bounded size, which is broadcast,
       and tell how many rows the largest group has at most.
    2. Rows the filter does not know are unique and are never shuffled.
    3. The rest, normally few, is shuffled and sorted once, by hash and exact key. If a group may
       be too large for one task, it goes by hash and block of row numbers instead: ranks are
       taken within a block, over the exact key, and shifted by the rows of the same two hashes
       (128 bits) in the blocks before it. A block holds at most rows_per_block rows as long as
       order_column is unique, however large the group is. Rows without a row number come
       last, in the order they are written down in.

    When so many rows repeat that the filter fills up, more unique rows take part in the one
    shuffle; results do not change. With layout, ranked rows are brought together by that
    column again, for writers that partition by it, and written, so that none ranks them again.
    """
    key = [part for name in key_columns for part in _key_parts(df, name)]
    hashed = df.withColumn("key_hash", F.xxhash64(*key))
    repeated = (
        hashed.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    words = scratch.table(
        repeated.groupBy(_filter_word().alias("word")).agg(
            F.bit_or(_filter_bits()).alias("bits"), F.max("n").alias("most")
        ),
        "repeated-hashes",
    )
    one = F.lit(1).cast("long")
    most = words.agg(F.max("most")).first()[0]
    if most is None:
        return df.withColumns({"duplicate_count": one, "duplicate_rank": one})

    known = F.coalesce(F.col("bits").bitwiseAND(_filter_bits()) == _filter_bits(), F.lit(False))
    bits = F.broadcast(words.drop("most"))
    sifted = hashed.withColumn("word", _filter_word()).join(bits, "word", "left")
    unique = sifted.filter(~known).withColumns({"duplicate_count": one, "duplicate_rank": one})
    number = F.col(order_column).try_cast("long")
    position = F.coalesce(number, F.monotonically_increasing_id())
    copies = sifted.filter(known).drop("word", "bits").withColumns(
        {
            "position": position,
            "block": F.struct(
                number.isNull().alias("unnumbered"),
                F.floor(position / F.lit(rows_per_block)).alias("number"),
            ),
        }
    )
    # one of the two is written, so that rows without a number keep their place
    if most <= rows_per_block // SMALL_GROUPS:
        ranked = _ranked_at_once(copies if layout else scratch.table(copies, "copies"), key)
    else:
        second = copies.withColumn("second_hash", F.xxhash64(F.lit("second"), *key))
        ranked = _ranked_by_block(scratch.table(second, "copies"), key)
    result = [*df.columns, "duplicate_count", "duplicate_rank"]
    ranked = ranked.select(*result)
    if layout:
        ranked = scratch.table(ranked.hint("rebalance", F.col(layout)), "ranked")
    return unique.select(*result).unionByName(ranked)


def _ranked_at_once(copies: DataFrame, key: list[Column]) -> DataFrame:
    """Copies with rank and count, for groups that fit into a task."""
    in_group = Window.partitionBy("key_hash", *key)
    return copies.withColumns(
        {
            "duplicate_rank": F.row_number()
            .over(in_group.orderBy("block", "position"))
            .cast("long"),
            "duplicate_count": F.count(F.lit(1)).over(in_group),
        }
    )


def _ranked_by_block(copies: DataFrame, key: list[Column]) -> DataFrame:
    """Copies with rank and count, for groups of any size."""
    group = ["key_hash", "second_hash"]
    in_group = Window.partitionBy(*group)
    earlier = in_group.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # hashes and counts only
    blocks = (
        copies.groupBy(*group, "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "rows_before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
                "rows_in_group": F.sum("n").over(in_group),
            }
        )
        .filter("rows_in_group > n")
        .drop("n")
    )
    # the join's shuffle by group and block also serves the windows
    in_block = Window.partitionBy(*group, "block", *key)
    return (
        copies.join(blocks, [*group, "block"], "left")
        .withColumns(
            {
                "local_rank": F.row_number().over(in_block.orderBy("position")),
                "local_count": F.count(F.lit(1)).over(in_block),
            }
        )
        .withColumns(
            {
                "duplicate_count": F.coalesce("rows_in_group", "local_count"),
                "duplicate_rank": F.col("local_rank") + F.coalesce("rows_before", F.lit(0)),
            }
        )
    )


def _filter_word() -> Column:
    """Which word of the filter a hash belongs to."""
    return F.col("key_hash").bitwiseAND(F.lit(FILTER_WORDS - 1).cast("long"))


def _filter_bits() -> Column:
    """The three bits of its word that a hash sets, taken from its upper half."""
    bits = F.lit(0).cast("long")
    for shift in (32, 38, 44):
        at = F.shiftrightunsigned("key_hash", shift).bitwiseAND(F.lit(63).cast("long"))
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int")))
    return bits


def _key_parts(df: DataFrame, name: str) -> list[Column]:
    """Columns that are equal exactly when the text of a column is, without making text.

    Grouping takes 0.0 and -0.0 for the same number, their text is not, so zeros add theirs.
    """
    column = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return [F.coalesce(column, F.lit(""))]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return [column, F.when(column == 0, column.cast("string"))]
    return [column]
