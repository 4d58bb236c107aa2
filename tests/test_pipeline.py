import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.history import History
from ledgerlens.plans.pipeline import run_ingest, run_pipeline, run_quality, run_transform
from ledgerlens.schema import RAW_SCHEMA
from ledgerlens.sources.events import transactions_from_events, write_raw_csv
from ledgerlens.sources.lake import Lake


@pytest.fixture(scope="module")
def finished(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    write_raw_csv(transactions_from_events(spark, sf_dir), f"{root}/raw/transactions.csv")
    return root, run_pipeline(spark, root)


def test_counts_and_tables(spark, finished):
    root, metrics = finished
    lake = Lake(spark, root)
    expected = {
        "bronze_rows": 10044, "total_rows": 10044, "quarantine_rows": 289, "silver_rows": 9755,
        "gold_daily_rows": 30,
    }
    assert {name: metrics[name] for name in expected} == expected
    assert lake.missing_tables() == [] and len(lake.register_views()) == 10
    silver = lake.table("silver_transactions")
    assert silver.filter("is_fraud").count() == 111
    assert silver.filter("is_flagged_fraud").count() == 12
    assert silver.filter("sender_old_balance > 0 AND sender_new_balance = 0").count() == 3901
    daily = lake.table("gold_fraud_summary_daily")
    assert daily.agg(F.sum("total_transactions")).first()[0] == 9755


def test_history_of_a_finished_run(spark, finished):
    root, metrics = finished
    history = History(spark, root)
    run = history.recent_runs().first()
    assert (run["run_id"], run["status"], run["silver_rows"]) == (metrics["run_id"], "SUCCESS", 9755)
    assert run["started_at"] < run["finished_at"]
    latest = {row["check_name"]: row["failed_rows"] for row in history.latest_quality().collect()}
    assert latest["duplicate_transaction"] == 44 and latest["amount_positive"] == 58
    assert history.latest_quality().columns == ["check_name", "failed_rows", "total_rows", "status"]


def test_stages_alone_replace_their_tables(spark, finished):
    root, _ = finished
    assert run_quality(spark, root) == {"total_rows": 10044, "quarantine_rows": 289}
    assert run_transform(spark, root) == {"silver_rows": 9755, "gold_daily_rows": 30}
    results = History(spark, root).quality_results()
    assert results.select("quality_run_id").distinct().count() == results.count() / 8


def test_sample_and_given_schema(spark, finished, tmp_path):
    root, _ = finished
    raw = f"{root}/raw/transactions.csv"
    metrics = run_ingest(spark, str(tmp_path), raw, sample_rows=1000, schema=RAW_SCHEMA)
    assert metrics["bronze_rows"] == 1000
    numbers = Lake(spark, str(tmp_path)).table("bronze_transactions").agg(
        F.min("source_row_number"), F.max("source_row_number")
    )
    assert tuple(numbers.first()) == (1, 1000)


def test_failed_run_is_recorded_and_raised(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "bad.csv").write_text("something\n1\n")
    with pytest.raises(Exception):
        run_pipeline(spark, str(tmp_path))
    run = History(spark, str(tmp_path)).runs().first()
    assert run["status"] == "FAILED" and run["notes"] and run["silver_rows"] is None


def test_missing_raw_file_leaves_no_trace(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, str(tmp_path))
    assert History(spark, str(tmp_path)).runs().count() == 0


def test_runs_show_their_latest_state(spark, tmp_path):
    history = History(spark, str(tmp_path))
    with history.recorded("a.csv", 10) as counts:
        (running,) = history.runs().collect()
        assert running["status"] == "RUNNING" and running["finished_at"] is None
        counts["bronze_rows"] = 7
    with pytest.raises(OSError, match="disk full"), history.recorded("b.csv") as failing:
        failing["bronze_rows"] = 5
        raise OSError("disk full")
    runs = {row["run_id"]: row for row in history.runs().collect()}
    first, second = runs[counts["run_id"]], runs[failing["run_id"]]
    assert first["status"] == "SUCCESS" and first["bronze_rows"] == 7
    assert first["notes"] is None and first["sample_rows"] == 10
    assert second["status"] == "FAILED" and second["bronze_rows"] == 5 and second["notes"] == "disk full"
    for i in range(10):
        with history.recorded(f"{i}.csv"):
            pass
    recent = history.recent_runs().collect()
    assert len(recent) == 10 and counts["run_id"] not in {row["run_id"] for row in recent}


def test_broken_history_is_not_taken_for_an_empty_one(spark, tmp_path):
    history = History(spark, str(tmp_path))
    (tmp_path / "history" / "quality_results").mkdir(parents=True)
    (tmp_path / "history" / "quality_results" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        history.quality_results().count()


def test_old_results_without_run_id_are_read(spark, tmp_path):
    history = History(spark, str(tmp_path))
    assert history.latest_quality().count() == 0
    old = spark.sql(
        "SELECT current_timestamp() AS checked_at, 'sender_present' AS check_name, "
        "9L AS failed_rows, 10L AS total_rows, 'FAIL' AS status"
    )
    old.write.parquet(history.results_path)
    assert history.quality_results().first()["quality_run_id"] is None
    assert history.latest_quality().count() == 0
    history.append_quality(old.drop("checked_at").withColumn("failed_rows", F.lit(0).cast("long")))
    assert history.latest_quality().first()["failed_rows"] == 0
