"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for intermediate data.

    Only a local session may go without one; it then gets a new temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(FOLDER_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"{FOLDER_SETTING} must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


class Scratch:
    """A new subfolder of the shared folder that holds written intermediate tables.

    A written table cuts the lineage, survives lost executors, and has a size Spark knows
    when it plans a join: it is broadcast below spark.sql.autoBroadcastJoinThreshold and
    shuffled above.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4()}"
        self._count = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
