"""Raw transaction CSV files to bronze rows, numbered in file order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.sources.csv_records import read_numbered
from ledgerlens.sources.lake import is_absent
from ledgerlens.sources.scratch import Scratch

# One row per input split; a million splits of 128 MB are 128 TB of CSV and make a
# broadcast of about 200 MB.
BROADCAST_SPLITS = 1_000_000

_SPLIT = ["split_file", "split_start", "split_length"]


def find_raw_file(spark: SparkSession, root: str, raw_file: str | None = None) -> str:
    """The given path, else the first CSV below <root>/raw, else below <root>."""
    if raw_file:
        if _files(spark, raw_file):
            return raw_file
        raise FileNotFoundError(f"nothing to load at {raw_file}")
    for pattern in (f"{root}/raw/*.csv", f"{root}/*.csv"):
        files = _files(spark, pattern)
        if files:
            # a matching folder of part files is taken as a whole
            folder = files[0].rsplit("/", 1)[0]
            return folder if folder.endswith(".csv") else files[0]
    raise FileNotFoundError(f"No transaction CSV found below {root}/raw or {root}")


def _files(spark: SparkSession, path: str) -> list[str]:
    try:
        return sorted(spark.read.text(path).inputFiles())
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return []


def sample_files(
    spark: SparkSession, path: str, sample_rows: int, count: Callable[[list[str]], int]
) -> list[str]:
    """The first files below path, in order, that hold sample_rows rows together.

    Files are counted by twice as many each time until there are enough, so no more than twice
    the files needed are read and later ones are not opened.
    """
    files = _files(spark, path)
    taken = 1
    while taken < len(files) and count(files[:taken]) < sample_rows:
        taken *= 2
    return files[:taken]


def bronze_records(
    spark: SparkSession,
    path: str,
    scratch: Scratch,
    schema: StructType | None = None,
    sample_rows: int | None = None,
) -> DataFrame:
    """Bronze rows of CSV with quoted line breaks, bad cells kept as text; see csv_records.

    Without a schema the columns' types are those that hold all cells, found in the first pass.
    With sample_rows only the first files that hold so many are read.
    """
    header = spark.read.option("header", True).csv(path).columns
    if schema is not None:
        _check_header(path, header, schema)

    def read(files: list[str]) -> tuple[DataFrame, int]:
        return read_numbered(spark, files, header, scratch, schema)

    files = _files(spark, path)
    if sample_rows:
        files = sample_files(spark, path, sample_rows, lambda some: read(some)[1])
    rows, _ = read(files)
    bronze = rows.select(
        *[name for name in rows.columns if name != "source_file"],
        F.ceil(F.col("step").try_cast("double") / F.lit(24.0)).cast("int").alias("step_day"),
        F.current_timestamp().alias("ingested_at"),
        "source_file",
    )
    if sample_rows:
        bronze = bronze.filter(F.col("source_row_number") <= sample_rows)
    return bronze


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Scan a CSV file or folder with a header line.

    Without a schema the types are inferred over the whole input, which costs one more
    pass; pass schema.RAW_SCHEMA for large inputs. Its columns are found by the names in the
    header, which further files must repeat in the same order. FAILFAST refuses rows with a wrong
    number of fields, PERMISSIVE pads or cuts them.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be FAILFAST or PERMISSIVE, not {mode}")
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is None:
        return reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path)
    return reader.option("enforceSchema", False).schema(_by_header(spark, path, schema)).csv(path)


def _by_header(spark: SparkSession, path: str | list[str], schema: StructType) -> StructType:
    """The schema's fields in the order of the file's header, which must name just these."""
    header = spark.read.option("header", True).csv(path).columns
    _check_header(path, header, schema)
    return StructType([schema[name] for name in header])


def _check_header(path: str | list[str], header: list[str], schema: StructType) -> None:
    unknown, missing = set(header) - set(schema.names), set(schema.names) - set(header)
    if unknown or missing:
        raise ValueError(
            f"header of {path}: unknown columns {sorted(unknown)}, missing {sorted(missing)}"
        )


@contextmanager
def fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Keep Spark cutting files the same way while executors come and go.

    The size of a split depends on the number of cores unless this setting is given.
    """
    setting = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if not before:
            spark.conf.unset(setting)


def to_bronze(raw: DataFrame, scratch: Scratch, sample_rows: int | None = None) -> DataFrame:
    """Add row number, day and load columns; keep the first sample_rows rows if given.

    A first pass counts the rows of every split and turns the counts into start numbers.
    The second pass adds the position within the split to them, so no row moves for its
    number. Run it and the write of its result inside fixed_splits.
    """
    located = raw.select(
        "*",
        F.col("_metadata.file_path").alias("split_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_block_length").alias("split_length"),
        F.col("_metadata.file_name").alias("source_file"),
        F.monotonically_increasing_id().alias("scan_id"),
    )
    counted = located.groupBy(*_SPLIT).agg(
        F.count(F.lit(1)).alias("split_rows"), F.min("scan_id").alias("first_scan_id")
    )
    # one row per split of the input, never one per record
    earlier = Window.orderBy("split_file", "split_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = scratch.table(
        counted.select(
            *_SPLIT,
            "first_scan_id",
            F.coalesce(F.sum("split_rows").over(earlier), F.lit(0)).alias("rows_before"),
        ),
        "split-starts",
    )
    if starts.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)

    row_number = F.col("rows_before") + F.col("scan_id") - F.col("first_scan_id") + 1
    numbered = located.join(starts, _SPLIT, "left").select(
        F.coalesce(
            row_number, F.raise_error(F.lit("input split changed between passes")).cast("long")
        ).alias("source_row_number"),
        *[F.col(f"`{name}`") for name in raw.columns],
        F.ceil(F.col("step").try_cast("double") / F.lit(24.0)).cast("int").alias("step_day"),
        F.current_timestamp().alias("ingested_at"),
        "source_file",
    )
    if sample_rows:
        numbered = numbered.filter(F.col("source_row_number") <= sample_rows)
    return numbered
