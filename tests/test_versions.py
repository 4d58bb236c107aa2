from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import pipeline
from ledgerlens.plans.history import History
from ledgerlens.plans.pipeline import run_pipeline, run_transform
from ledgerlens.schema import STATISTICS, TABLES
from ledgerlens.sources.events import transactions_from_events, write_raw_csv
from ledgerlens.sources.lake import Lake


def numbers(spark, n):
    return spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("transaction_day"))


def test_tables_of_a_transaction_appear_together(spark, tmp_path):
    lake, reader = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path))
    lake.write(numbers(spark, 10), "silver_transactions")
    assert reader.count("silver_transactions") == 10
    with lake.transaction():
        lake.write(numbers(spark, 20), "silver_transactions")
        lake.write(numbers(spark, 5), "silver_accounts")
        assert lake.count("silver_transactions") == 20
        other = Lake(spark, str(tmp_path))
        assert other.count("silver_transactions") == 10 and not other.has("silver_accounts")
    assert Lake(spark, str(tmp_path)).count("silver_accounts") == 5
    # a reader keeps what it began with until it asks again
    assert reader.count("silver_transactions") == 10
    reader.refresh()
    assert reader.count("silver_transactions") == 20


def test_a_failed_transaction_changes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(numbers(spark, 10), "silver_transactions")
    with pytest.raises(RuntimeError), lake.transaction():
        lake.write(numbers(spark, 20), "silver_transactions")
        raise RuntimeError
    assert lake.count("silver_transactions") == 10 == Lake(spark, str(tmp_path)).count("silver_transactions")
    assert lake.remove_old_versions() == 1
    assert lake.count("silver_transactions") == 10


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    first, second = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)exist"), first.transaction():
        first.write(numbers(spark, 1), "silver_transactions")
        second.write(numbers(spark, 2), "silver_transactions")
    assert Lake(spark, str(tmp_path)).count("silver_transactions") == 2


def test_tables_written_before_there_were_commits(spark, tmp_path):
    numbers(spark, 7).write.parquet(str(tmp_path / "silver" / "silver_accounts"))
    lake = Lake(spark, str(tmp_path))
    assert lake.count("silver_accounts") == 7
    lake.write(numbers(spark, 3), "silver_transactions")
    assert Lake(spark, str(tmp_path)).count("silver_accounts") == 7


def test_a_run_that_breaks_midway_leaves_every_old_table(spark, sf_dir, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_raw_csv(transactions_from_events(spark, sf_dir), f"{root}/raw/transactions.csv")
    run_pipeline(spark, root)
    names = [*TABLES, *STATISTICS]
    before = {name: Lake(spark, root).table(name).count() for name in names}
    silver = Lake(spark, root).table("silver_transactions")
    # as many files as days, and again for the copies brought back to their days
    assert len(silver.inputFiles()) <= 2 * 31

    def broken(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(pipeline, "hourly_fraud_trend", broken)
    for run in (lambda: run_transform(spark, root), lambda: run_pipeline(spark, root, sample_rows=100)):
        with pytest.raises(RuntimeError, match="disk full"):
            run()
        lake = Lake(spark, root)
        assert {name: lake.table(name).count() for name in names} == before
    statuses = {row["status"]: row["n"] for row in History(spark, root).runs().groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert statuses == {"SUCCESS": 1, "FAILED": 1}
    assert silver.count() == before["silver_transactions"]


def test_finishes_at_the_same_time_resolve_alike(spark, tmp_path, monkeypatch):
    moment = datetime(2024, 1, 1)
    monkeypatch.setattr("ledgerlens.plans.history._now", lambda: moment)
    history = History(spark, str(tmp_path))
    run = {"run_id": "r"}
    history._append_event(**run, number=2, event="finish", status="SUCCESS", notes="retried")
    history._append_event(**run, number=0, event="start", status="RUNNING", raw_file="a.csv")
    history._append_event(**run, number=1, event="finish", status="FAILED", notes="lost")
    for _ in range(3):
        (row,) = history.runs().collect()
        assert (row["status"], row["notes"], row["raw_file"]) == ("SUCCESS", "retried", "a.csv")


def test_a_long_history_in_few_files(spark, tmp_path):
    history = History(spark, str(tmp_path))
    for number in range(12):
        with history.recorded(f"{number}.csv") as counts:
            counts["bronze_rows"] = number
    old = spark.sql("SELECT 'old' AS run_id, 'start' AS event, timestamp'2020-01-01' AS event_at, 'RUNNING' AS status")
    old.write.mode("append").parquet(history.events_path)
    before = sorted(history.runs().collect(), key=lambda row: row["run_id"])
    files = history._read(history.events_path, "run_id string").inputFiles()
    assert len(before) == 13 and len(files) == 25
    history.compact()
    assert len(history._read(history.events_path, "run_id string").inputFiles()) == 1
    assert sorted(history.runs().collect(), key=lambda row: row["run_id"]) == before
    # a compaction that stopped before it removed the old files
    history.events().write.mode("append").parquet(history.events_path)
    assert sorted(history.runs().collect(), key=lambda row: row["run_id"]) == before
    with history.recorded("later.csv"):
        pass
    history.compact()
    assert history.runs().count() == 14
