import pytest
from pyspark.sql import functions as F

from ledgerlens.schema import RAW_COLUMNS, RAW_SCHEMA, TABLES
from ledgerlens.sources.lake import Lake
from ledgerlens.sources.raw_csv import find_raw_file, fixed_splits, read_raw, to_bronze
from ledgerlens.sources.scratch import Scratch, shared_folder

HEADER = ",".join(RAW_COLUMNS)


def csv_line(i):
    return f"{i % 60 + 1},PAYMENT,{i}.25,C{i},10.0,5.0,M{i},0.0,0.0,0,0"


def write_csv(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("schema", [None, RAW_SCHEMA])
def test_rows_are_numbered_in_file_order_over_many_splits(spark, tmp_path, small_splits, schema):
    write_csv(tmp_path / "in.csv" / "part-1.csv", [csv_line(i) for i in range(3000)])
    write_csv(tmp_path / "in.csv" / "part-2.csv", [csv_line(i) for i in range(3000, 4000)])
    write_csv(tmp_path / "in.csv" / "part-3.csv", [csv_line(i) for i in range(4000, 4003)])
    with fixed_splits(spark):
        raw = read_raw(spark, str(tmp_path / "in.csv"), schema)
        assert raw.rdd.getNumPartitions() > 5
        bronze = to_bronze(raw, Scratch(spark, "t")).cache()
    assert bronze.count() == 4003
    assert bronze.filter("nameOrig <> concat('C', source_row_number - 1)").count() == 0
    assert bronze.filter("step_day <> ceil(step / 24D)").count() == 0
    files = {row[0] for row in bronze.select("source_file").distinct().collect()}
    assert files == {"part-1.csv", "part-2.csv", "part-3.csv"}
    assert bronze.filter("ingested_at IS NULL").count() == 0
    bronze.unpersist()


@pytest.mark.parametrize("sample_rows,expected", [(None, 500), (0, 500), (3, 3), (10_000, 500)])
def test_sample_is_the_first_rows(spark, tmp_path, sample_rows, expected):
    path = write_csv(tmp_path / "in.csv", [csv_line(i) for i in range(500)])
    bronze = to_bronze(read_raw(spark, path), Scratch(spark, "t"), sample_rows)
    names = {row[0] for row in bronze.select("nameOrig").collect()}
    assert names == {f"C{i}" for i in range(expected)}


def test_one_bad_cell_makes_the_column_text(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [csv_line(1), csv_line(2).replace("2.25", "abc")])
    assert dict(read_raw(spark, path).dtypes)["amount"] == "string"


def test_ragged_rows_fail_unless_permitted(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [csv_line(1), "1,PAYMENT,3.0"])
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_raw(spark, path, RAW_SCHEMA).collect()
    padded = read_raw(spark, path, RAW_SCHEMA, mode="PERMISSIVE").collect()
    assert len(padded) == 2 and padded[1]["nameOrig"] is None
    with pytest.raises(ValueError):
        read_raw(spark, path, mode="DROPMALFORMED")


def test_blank_lines_do_not_shift_numbers(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [csv_line(0), "", csv_line(1), "", "", csv_line(2)])
    rows = to_bronze(read_raw(spark, path), Scratch(spark, "t")).collect()
    assert sorted((row["source_row_number"], row["nameOrig"]) for row in rows) == [
        (1, "C0"), (2, "C1"), (3, "C2"),
    ]


def test_raw_file_is_found(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        find_raw_file(spark, str(tmp_path))
    write_csv(tmp_path / "z.csv", [csv_line(1)])
    assert find_raw_file(spark, str(tmp_path)).endswith("/z.csv")
    write_csv(tmp_path / "raw" / "b.csv", [csv_line(1)])
    write_csv(tmp_path / "raw" / "a.csv", [csv_line(1)])
    assert find_raw_file(spark, str(tmp_path)).endswith("/raw/a.csv")
    write_csv(tmp_path / "raw" / "A.csv" / "part-0.csv", [csv_line(1)])
    assert find_raw_file(spark, str(tmp_path)).endswith("/raw/A.csv")
    assert find_raw_file(spark, str(tmp_path), str(tmp_path / "z.csv")) == str(tmp_path / "z.csv")
    with pytest.raises(FileNotFoundError):
        find_raw_file(spark, str(tmp_path), str(tmp_path / "none.csv"))


def test_lake_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert not lake.has("silver_transactions")
    assert len(lake.missing_tables()) == 6
    with pytest.raises(FileNotFoundError):
        lake.table("silver_transactions")

    rows = spark.range(100).select(
        "id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).cast("int").alias("transaction_day")
    )
    lake.write(rows, "silver_transactions", rebalance=True)
    read = lake.table("silver_transactions")
    assert lake.count("silver_transactions") == 100
    assert dict(read.dtypes)["transaction_day"] == "int"
    assert read.filter("transaction_day IS NULL").count() == 25

    lake.write(rows.filter("transaction_day = 2"), "silver_transactions")
    assert lake.count("silver_transactions") == 25
    assert lake.register_views() == ["silver_transactions"]
    assert spark.sql("SELECT max(transaction_day) FROM silver_transactions").first()[0] == 2
    assert "silver_transactions" in TABLES and len(lake.missing_tables()) == 5


def test_day_filter_prunes_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(90).select("id", (F.col("id") % 30).cast("int").alias("transaction_day"))
    lake.write(rows, "silver_transactions")
    kept = lake.table("silver_transactions").filter(F.col("transaction_day").between(3, 5))
    assert kept.count() == 9
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(transaction_day" in plan


def test_rebalance_cuts_a_hot_day(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100KB")
    try:
        rows = spark.range(0, 200_000, 1, 20).select(
            F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(1).cast("int").alias("step_day"),
        )
        lake.write(rows, "bronze_transactions", rebalance=True)
    finally:
        spark.conf.set(setting, before)
    files = lake.table("bronze_transactions").filter("step_day = 1").inputFiles()
    assert lake.count("bronze_transactions") == 200_000
    assert len([name for name in files if "step_day=1/" in name]) > 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    table = Scratch(spark, "t").table(spark.range(3), "numbers")
    assert shared_folder(spark) in table.inputFiles()[0] and table.count() == 3


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)
        self.conf = {}


def test_only_a_local_session_gets_its_own_folder():
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.sparkContext.folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
