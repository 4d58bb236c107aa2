"""Transactions derived from the events test table, bad rows and duplicates included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schema import RAW_COLUMNS

COPY_OFFSET = 1_000_000_000


def transactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows from events.parquet.

    One row per event, and a second copy with a high row number of every 229th.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number, kind, value = F.col("event_id"), F.col("event_type"), F.col("value")

    def every(step: int, offset: int) -> Column:
        return number % step == offset

    def cents(x: Column) -> Column:
        return x.cast("decimal(18,2)").cast("double")

    zero = F.lit(0.0)
    fraud = F.when(
        kind.isin("purchase", "click")
        & (every(40, 0) | ((value > 200) & every(2, 0))),
        1,
    ).otherwise(0)
    raw = events.withColumn("fraud", fraud).select(
        (number + 1).alias("source_row_number"),
        ((F.dayofyear("ts") - 1) * 24 + F.hour("ts") + 1).cast("int").alias("step"),
        F.when(every(211, 5), "WIRE")
        .when(every(17, 0) & (kind == "purchase"), " transfer ")
        .when(kind == "view", "PAYMENT")
        .when(kind == "signup", "CASH_IN")
        .when(kind == "error", "DEBIT")
        .when(kind == "click", "CASH_OUT")
        .otherwise("TRANSFER")
        .alias("type"),
        F.when(every(307, 7), -value).when(every(401, 9), zero).otherwise(value).alias("amount"),
        F.when(every(263, 11), "  ")
        .otherwise(F.concat(F.lit("C"), (F.col("user_id") * 100 + number % 20).cast("string")))
        .alias("nameOrig"),
        F.when(every(5, 0), value)
        .when(every(5, 1), cents(value * F.lit(1.04)))
        .when(every(5, 2), zero)
        .otherwise(cents(value * 3))
        .alias("oldbalanceOrg"),
        F.when(every(353, 15), F.lit(-1.0))
        .when(number % 5 < 3, zero)
        .otherwise(cents(value * 2))
        .alias("newbalanceOrig"),
        F.when(every(331, 13), F.lit(None).cast("string"))
        .when(every(3, 0), F.concat(F.lit("M"), (number * 31 % 97).cast("string")))
        .otherwise(
            F.concat(
                F.lit("C"),
                ((F.col("user_id") * 7 + number) % 150 * 100 + number % 20).cast("string"),
            )
        )
        .alias("nameDest"),
        F.when(every(4, 0), zero).otherwise(cents(value * 10)).alias("oldbalanceDest"),
        F.when(every(4, 0), value).otherwise(cents(value * 11)).alias("newbalanceDest"),
        F.when(every(449, 17), 2).otherwise(F.col("fraud")).alias("isFraud"),
        F.when(every(467, 19), 3)
        .when((F.col("fraud") == 1) & (value > 250), 1)
        .otherwise(0)
        .alias("isFlaggedFraud"),
        F.col("ts").alias("ingested_at"),
        F.lit("events.parquet").alias("source_file"),
    )
    copies = raw.filter((F.col("source_row_number") - 1) % 229 == 3).withColumn(
        "source_row_number", F.col("source_row_number") + COPY_OFFSET
    )
    return raw.unionByName(copies).withColumn(
        "step_day", F.ceil(F.col("step") / F.lit(24.0)).cast("int")
    )


def write_raw_csv(transactions: DataFrame, path: str, escape: str = "\\") -> None:
    """Write the raw columns as CSV files whose order is the order of source_row_number."""
    (
        transactions.orderBy("source_row_number")
        .select(*RAW_COLUMNS)
        .write.option("header", True)
        .option("escape", escape)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
