import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.quality import score_quality
from ledgerlens.plans.pipeline import run_ingest, run_pipeline
from ledgerlens.schema import RAW_COLUMNS, RAW_SCHEMA
from ledgerlens.sources import csv_records
from ledgerlens.sources.csv_records import read_numbered
from ledgerlens.sources.lake import Lake
from ledgerlens.sources.raw_csv import fixed_splits
from ledgerlens.sources.scratch import Scratch


@pytest.fixture
def small_splits(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(folder, files, newline="\n"):
    for name, rows in files.items():
        text = io.StringIO()
        csv.writer(text, lineterminator=newline).writerows(rows)
        (folder / name).write_bytes(text.getvalue().encode())


def read(spark, folder, header=("a", "b", "c"), schema=None):
    paths = sorted(str(path) for path in folder.iterdir())
    with fixed_splits(spark):
        rows, total = read_numbered(spark, paths, list(header), Scratch(spark, "csv"), schema)
        found = sorted(tuple(row) for row in rows.drop("source_file").collect())
    assert total == len(found)
    return rows, found


def some_rows(seed, count):
    rng = random.Random(seed)
    pool = ["plain", "two\nlines", 'say "x"', "a,b", "", " \n\n ", '"\n"', "long " * 30 + "\n" + "tail " * 20, "\n" * 40]
    return [[rng.choice(pool), str(rng.randint(-5, 5)), rng.choice(pool)] for _ in range(count)]


@pytest.mark.parametrize("size", [16, 64, 300, 100_000])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_quoted_breaks_in_any_splits(spark, tmp_path, small_splits, size, newline):
    small_splits(size)
    header = ["a", "b", "c"]
    files = {f"{n}.csv": [header, *some_rows(n, 25)] for n in range(2)}
    written(tmp_path, files, newline)
    _, found = read(spark, tmp_path)
    records = [row for rows in files.values() for row in rows[1:]]
    expected = [(n, a or None, int(b), c or None) for n, (a, b, c) in enumerate(records, 1)]
    assert [tuple(value or None if at != 2 else value for at, value in enumerate(row)) for row in found] == expected


def test_plain_files_are_not_shuffled(spark, tmp_path, small_splits):
    small_splits(200)
    written(tmp_path, {"x.csv": [["a", "b"], *[[f"t{n}", str(n)] for n in range(300)]]})
    rows, found = read(spark, tmp_path, ("a", "b"))
    assert found == [(n + 1, f"t{n}", n) for n in range(300)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan


def test_narrowest_type_that_holds_all_cells(spark, tmp_path):
    header = ["i", "l", "d", "t", "e", "q"]
    rows = [["1", "5", "1", "x", "", ""], ["-2", "5000000000", "2.5", "1", "", "7"], ["", "", "nan", "", "", ""]]
    written(tmp_path, {"x.csv": [header, *rows]})
    frame, found = read(spark, tmp_path, header)
    assert [kind for _, kind in frame.dtypes[1:7]] == ["int", "bigint", "double", "string", "int", "int"]
    assert found[1] == (2, -2, 5000000000, 2.5, "1", None, 7)


def test_blank_lines_are_no_records(spark, tmp_path, small_splits):
    small_splits(20)
    (tmp_path / "x.csv").write_text('a,b\n1,x\n\n2,"y\n\nz"\n\n\n3,w\n\n')
    _, found = read(spark, tmp_path, ("a", "b"))
    assert found == [(1, 1, "x"), (2, 2, "y\n\nz"), (3, 3, "w")]


def test_header_once_more_makes_text_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\na,b\n3,4\n")
    _, found = read(spark, tmp_path, ("a", "b"))
    assert found == [(1, "1", "2"), (2, "a", "b"), (3, "3", "4")]


@pytest.mark.parametrize("text,message", [
    ("a,b\n1,2,3\n", "(?i)malformed"),
    ('a,b\n1,"open\n2,3\n', "inside quotes"),
    ("b,a\n1,2\n", "header"),
])
def test_broken_files_are_refused(spark, tmp_path, text, message):
    (tmp_path / "x.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        read(spark, tmp_path, ("a", "b"))


def test_only_a_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n")
    assert read(spark, tmp_path, ("a", "b"))[1] == []


def transactions(count, **changes):
    good = dict(zip(RAW_COLUMNS, ["1", "PAYMENT", "10.5", "C1", "20", "9.5", "M1", "0", "0", "0", "0"]))
    return [list({**good, "nameOrig": f"C{n}", **{k: v(n) for k, v in changes.items()}}.values()) for n in range(count)]


def test_bad_cells_reach_quarantine(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    rows = transactions(
        40, amount=lambda n: "n/a" if n == 7 else "1.5d" if n == 8 else "12.25", isFraud=lambda n: "yes" if n == 9 else "0",
        nameDest=lambda n: "M1\nM2" if n % 10 == 5 else "M1",
    )
    written(tmp_path / "raw", {"x.csv": [RAW_COLUMNS, *rows]})
    counts = run_pipeline(spark, str(tmp_path), schema=RAW_SCHEMA, mode="KEEP")
    assert (counts["bronze_rows"], counts["quarantine_rows"], counts["silver_rows"]) == (40, 3, 37)
    bronze = Lake(spark, str(tmp_path)).table("bronze_transactions")
    kinds = dict(bronze.dtypes)
    assert (kinds["amount"], kinds["isFraud"], kinds["oldbalanceOrg"], kinds["step"]) == ("string", "string", "double", "int")
    issues = {row["nameOrig"]: row["quality_issues"] for row in score_quality(bronze).filter("quality_issues <> ''").collect()}
    assert issues == {"C7": "amount_not_positive", "C8": "amount_not_positive", "C9": "invalid_fraud_flag"}


@pytest.mark.parametrize("mode", ["KEEP", "FAILFAST"])
def test_sample_does_not_read_later_files(spark, tmp_path, mode):
    raw = tmp_path / "many.csv"
    raw.mkdir()
    written(raw, {f"{n}.csv": [RAW_COLUMNS, *transactions(10)] for n in range(4)})
    # any read of the later files' rows would fail
    (raw / "4.csv").write_text(",".join(RAW_COLUMNS) + "\nbroken,line\n")
    (raw / "5.csv").write_text(",".join(RAW_COLUMNS) + "\nbroken,line\n")
    counts = run_ingest(spark, str(tmp_path / "lake"), str(raw), sample_rows=15, schema=RAW_SCHEMA, mode=mode)
    bronze = Lake(spark, str(tmp_path / "lake")).table("bronze_transactions")
    assert counts["bronze_rows"] == 15
    assert {row[0] for row in bronze.select("source_file").distinct().collect()} == {"0.csv", "1.csv"}
    assert bronze.agg(F.max("source_row_number")).first()[0] == 15
    with pytest.raises(Exception):
        run_ingest(spark, str(tmp_path / "lake2"), str(raw), sample_rows=45, schema=RAW_SCHEMA, mode=mode)


def test_small_splits_share_tasks(spark, tmp_path, small_splits):
    rows = [(str(i), f"x\n{i}" if i % 5 == 0 else "plain", "") for i in range(400)]
    written(tmp_path, {"a.csv": [("a", "b", "c"), *rows]})
    small_splits(64)
    most = csv_records.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    lines = csv_records._lines(spark, [str(tmp_path / "a.csv")])
    assert lines.select("split_start").distinct().count() > 2 * most
    assert lines.rdd.getNumPartitions() <= most
    assert len(read(spark, tmp_path)[1]) == 400


def test_kinds_without_patterns(spark):
    cells = [
        None, "", "0", "12", "999999999", "2147483647", "2147483648", "9" * 18, "9" * 19, "1.5", ".5", "5.", ".", "1.2.3",
        "+7", "-7", " 7 ", "1e5", "1E-5", "nan", "NaN", "inf", "Infinity", "-inf", "in", "C12", "12C", "x", "é1", "[", "`", "1\n",
    ]
    frame = spark.createDataFrame([(c,) for c in cells], "cell string")
    cell = F.col("cell")
    plain = F.when(cell.isNull() | (cell == ""), 0).otherwise(csv_records._kind_by_pattern(cell))
    for row in frame.select("cell", csv_records._kind(cell).alias("quick"), plain.alias("plain")).collect():
        assert row["quick"] == row["plain"], row["cell"]
