"""CSV with quoted line breaks and cells that do not fit their column, read split by split.

A line break inside quotes does not end a record, so where a record starts depends on everything
before it. But only on one bit: whether the number of quotes so far is odd. A first pass counts, per
split, the lines, the lines with an odd number of quotes, and for every column the widest kind of
number or text among its cells. From these counts each split's state at its start follows by a
prefix sum over splits. Splits that start outside quotes and have no odd line hold one record a line
and are read as they are. Only the others are put together line by line, each split on its own;
a record that reaches over a split's end is completed from the next ones' first pieces.

Quotes inside quoted cells are doubled. A column whose cells do not all fit its type is kept as
text, so the quality checks find the cells.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.casts import number_text
from ledgerlens.sources.scratch import Scratch

# One row per input split; see raw_csv.
BROADCAST_SPLITS = 1_000_000
# Splits read by one task, unless that leaves fewer tasks than these for each core.
TASK_BYTES = 128 << 20
TASKS_PER_CORE = 4

_SPLIT = ["split_file", "split_start"]
_RECORD = "split_file string, split_start long, source_file string, piece long, record string"
# From narrow to wide; a column gets the widest kind of its cells.
_KINDS = (T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType())


def _packed(rows: DataFrame) -> DataFrame:
    """The same rows in fewer tasks where splits are small: up to TASK_BYTES of splits a task.

    Every task answers to the driver, so there must not be one for each split, however small.
    """
    spark = rows.sparkSession
    splits = rows.rdd.getNumPartitions()
    size = re.match(r"(\d+)\s*([bkmgt]?)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower())
    split_bytes = int(size[1]) << 10 * "bkmgt".index(size[2] or "b")
    tasks = max(
        TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-splits * split_bytes // TASK_BYTES)
    )
    return rows.coalesce(tasks) if tasks < splits else rows


def _stored(scratch: Scratch, rows: DataFrame, name: str) -> DataFrame:
    return _packed(scratch.table(rows, name))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    # numbered before splits are packed, so that a number belongs to its split
    numbered = (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", r"\r$", ""))
            .otherwise(F.col("value"))
            .alias("line"),
            F.col("_metadata.file_path").alias("split_file"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.col("_metadata.file_name").alias("source_file"),
            F.monotonically_increasing_id().alias("scan_id"),
        )
    )
    quotes = F.octet_length("line") - F.octet_length(_without(F.col("line"), '"'))
    return _packed(numbered).withColumn("odd", quotes % 2)


def _without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def _kind(cell: Column) -> Column:
    """Place in _KINDS of the narrowest type that holds a cell; empty cells fit everywhere.

    Casts are only tried where a pattern fits, since one that fails is slow. Patterns are only
    tried on cells that are neither plain digits, with a point or without, nor begin with a
    letter that no number begins with.
    """
    others = F.translate(cell, "0123456789", "")
    first = F.substring(cell, 1, 1)
    letter = first.between("A", "Z") | first.between("a", "z")
    return (
        F.when(cell.isNull() | (cell == ""), 0)
        .when((others == "") & (F.length(cell) <= 9), 0)
        .when((others == ".") & (F.length(cell) > 1), 2)
        .when(letter & ~first.isin("N", "n", "I", "i"), 3)
        .otherwise(_kind_by_pattern(cell))
    )


def _kind_by_pattern(cell: Column) -> Column:
    whole = F.when(cell.rlike(r"^\s*[+-]?\d{1,18}\s*$"), cell).try_cast("long")
    return (
        F.when(whole.between(-(1 << 31), (1 << 31) - 1), 0)
        .when(whole.isNotNull(), 1)
        .when(number_text(cell).isNotNull(), 2)
        .otherwise(3)
    )


def _kinds(header: list[str]) -> list[Column]:
    return [F.max(_kind(F.col(cell))) for cell in _cell_names(header)]


def _cell_names(header: list[str]) -> list[str]:
    return [f"cell_{at}" for at in range(len(header))]


def _with_cells(df: DataFrame, record: Column, header: list[str], mode: str) -> DataFrame:
    """df with the text of every cell; inline keeps Spark from parsing once for each cell."""
    parsed = F.from_csv(record, F.lit(_text_schema(header)), {"mode": mode, "escape": '"'})
    return df.select("*", F.inline(F.array(parsed)).alias(*_cell_names(header)))


def _like_header(line: str, header: list[str]) -> Column:
    return _without(_without(F.col(line), '"'), "\ufeff") == F.lit(",".join(header))


def _text_schema(header: list[str]) -> str:
    return ", ".join(f"`{name}` string" for name in header)


def _split_counts(lines: DataFrame, header: list[str], scratch: Scratch) -> DataFrame:
    """Per split its lines, odd lines, blank lines and kinds, and whether it starts inside quotes.

    The kinds hold if every line is a record, that is for splits that are read as they are.
    """
    like_header = _like_header("line", header)
    # a header's names are no cells, unless they stand in the middle of a file once more
    again = F.count_if(like_header) > F.max((F.col("split_start") == 0).cast("int"))
    counted = (
        _with_cells(lines, F.when(~like_header, F.col("line")), header, "PERMISSIVE")
        .groupBy(*_SPLIT)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("odd").alias("odd_lines"),
            F.count_if(F.trim("line") == "").alias("blank_lines"),
            F.min("scan_id").alias("first_scan_id"),
            *[
                F.when(again, len(_KINDS) - 1).otherwise(F.coalesce(kind, F.lit(0))).alias(f"kind_{at}")
                for at, kind in enumerate(_kinds(header))
            ],
        )
    )
    in_file = Window.partitionBy("split_file").orderBy("split_start")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    return _stored(
        scratch,
        counted.withColumn(
            "inside", F.coalesce(F.sum("odd_lines").over(earlier) % 2, F.lit(0))
        ).withColumn(
            "plain",
            (F.col("inside") == 0) & (F.col("odd_lines") == 0) & (F.col("blank_lines") == 0),
        ),
        "split-counts",
    )


def _assembled(lines: DataFrame, splits: DataFrame, scratch: Scratch) -> DataFrame:
    """Records of the splits that are not plain: split, number within it (from 1), text.

    Lines of a split meet in one task; a split is bounded by spark.sql.files.maxPartitionBytes.
    """
    odd_splits = splits.filter("not plain").select(*_SPLIT, "inside")
    in_split = Window.partitionBy(*_SPLIT).orderBy("scan_id")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    up_to = in_split.rowsBetween(Window.unboundedPreceding, 0)
    starts = (F.col("within") == 0) & (F.trim("line") != "")
    pieces = _stored(
        scratch,
        lines.join(odd_splits, _SPLIT)
        .withColumn("within", (F.col("inside") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2)
        .withColumn("piece", F.sum(F.when(starts, 1).otherwise(0)).over(up_to))
        .filter((F.col("within") == 1) | starts)
        .groupBy(*_SPLIT, "source_file", "piece")
        .agg(F.array_sort(F.collect_list(F.struct("scan_id", "line"))).alias("parts"))
        .select(
            *_SPLIT,
            "source_file",
            F.col("piece").cast("long").alias("piece"),
            F.array_join("parts.line", "\n").alias("text"),
        ),
        "pieces",
    )
    # the first piece of a split that starts inside quotes ends a record of an earlier split
    last = pieces.filter("piece > 0").groupBy(*_SPLIT).agg(F.max("piece").alias("last_piece"))
    in_file = Window.partitionBy("split_file").orderBy("split_start")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.struct(F.col("split_start").alias("split_start"), F.col("last_piece").alias("piece"))
    owners = (
        splits.select(*_SPLIT, "inside")
        .join(last, _SPLIT, "left")
        .withColumn(
            "owner", F.last(F.when(F.col("last_piece").isNotNull(), owner), ignorenulls=True).over(earlier)
        )
        .filter("inside = 1")
        .select(*_SPLIT, "owner")
    )
    heads = pieces.filter("piece = 0").join(owners, _SPLIT).select(
        "split_file",
        F.col("owner.split_start").alias("split_start"),
        F.col("owner.piece").alias("piece"),
        F.struct(F.col("split_start").alias("at"), "text").alias("head"),
    )
    tails = heads.groupBy(*_SPLIT, "piece").agg(
        F.array_join(F.array_sort(F.collect_list("head")).getField("text"), "\n").alias("tail")
    )
    return _stored(
        scratch,
        pieces.filter("piece > 0")
        .join(tails, [*_SPLIT, "piece"], "left")
        .select(
            *_SPLIT,
            "source_file",
            "piece",
            F.concat_ws("\n", "text", "tail").alias("record"),
        ),
        "records",
    )


def _column_types(kinds: list[int], header: list[str], schema: T.StructType | None) -> list[T.DataType]:
    """Type of every column: the schema's where all cells fit it, else the one that holds them."""
    types = []
    for name, kind in zip(header, kinds, strict=True):
        wanted = schema[name].dataType if schema else _KINDS[kind]
        fits = isinstance(wanted, T.StringType) or kind <= _KINDS.index(wanted)
        types.append(wanted if fits else T.StringType())
    return types


def read_numbered(
    spark: SparkSession,
    paths: list[str],
    header: list[str],
    scratch: Scratch,
    schema: T.StructType | None = None,
) -> tuple[DataFrame, int]:
    """Every record with source_row_number, the header's columns and source_file; their number.

    Two passes over the files, whose lines are only shuffled in splits with quoted line breaks
    or blank lines. Records with a wrong number of fields are refused, and so are files
    whose first line is not the header or which end inside quotes. Run it and the write of its result inside
    raw_csv.fixed_splits.
    """
    lines = _lines(spark, paths)
    splits = _split_counts(lines, header, scratch)
    left_open = splits.groupBy("split_file").agg(F.sum("odd_lines").alias("n")).filter("n % 2 = 1")
    for row in left_open.limit(1).collect():
        raise ValueError(f"{row['split_file']} ends inside quotes")
    if splits.filter("not plain").isEmpty():
        records = spark.createDataFrame([], _RECORD)
    else:
        records = _assembled(lines, splits, scratch)

    is_first = (F.col("split_start") == 0).cast("long")
    of_odd = records.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("records"))
    earlier = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    found = F.when(F.col("plain"), F.col("lines")).otherwise(F.coalesce("records", F.lit(0))) - is_first
    # one row per split of the input, never one per record
    starts = _stored(
        scratch,
        splits.join(of_odd, _SPLIT, "left").select(
            *_SPLIT,
            "plain",
            "first_scan_id",
            found.alias("found"),
            (F.coalesce(F.sum(found).over(earlier), F.lit(0)) + 1 - is_first).alias("first_number"),
        ),
        "split-starts",
    )
    split_count, total = starts.agg(F.count(F.lit(1)), F.coalesce(F.sum("found"), F.lit(0))).first()
    starts = starts.drop("found")
    if split_count <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)

    changed = F.raise_error(F.lit("input split changed between passes")).cast("long")
    of_plain = lines.join(starts, _SPLIT, "left").filter(F.coalesce("plain", F.lit(True))).select(
        F.coalesce(F.col("first_number") + F.col("scan_id") - F.col("first_scan_id"), changed).alias("number"),
        *_SPLIT,
        "source_file",
        F.col("line").alias("record"),
        (F.col("scan_id") - F.col("first_scan_id") + 1).alias("piece"),
    )
    of_others = records.join(starts, _SPLIT).select(
        (F.col("first_number") + F.col("piece") - 1).alias("number"),
        *_SPLIT,
        "source_file",
        "record",
        "piece",
    )
    is_header = (F.col("split_start") == 0) & (F.col("piece") == 1)
    unlike = F.raise_error(F.lit("the first line of a file is not the header of the first one"))
    plain_header = _like_header("record", header)
    numbered = of_plain.unionByName(of_others).filter(
        F.when(~is_header, F.lit(True)).when(plain_header, F.lit(False)).otherwise(unlike.cast("boolean"))
    )

    plain_kinds = splits.filter("plain").agg(*[F.max(f"kind_{at}").alias(f"kind_{at}") for at in range(len(header))])
    other_kinds = (
        _with_cells(records.filter(~is_header), F.col("record"), header, "FAILFAST")
        .agg(*[kind.alias(f"kind_{at}") for at, kind in enumerate(_kinds(header))])
    )
    widest = plain_kinds.unionByName(other_kinds).agg(
        *[F.coalesce(F.max(f"kind_{at}"), F.lit(0)).alias(f"kind_{at}") for at in range(len(header))]
    ).first()
    types = _column_types(list(widest), header, schema)

    def typed(name: str, kind: T.DataType) -> Column:
        cell = F.col(name)
        return cell if isinstance(kind, T.StringType) else F.when(cell != "", cell).cast(kind)

    cells = _cell_names(header)
    rows = _with_cells(numbered, F.col("record"), header, "FAILFAST").select(
        F.col("number").cast("long").alias("source_row_number"),
        *[
            typed(cell, kind).alias(name)
            for name, cell, kind in zip(header, cells, types, strict=True)
        ],
        "source_file",
    )
    return rows, total
