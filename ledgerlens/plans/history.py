"""Append-only history of runs and quality results, kept as Parquet below the lake root.

Events of a run are numbered, so their order does not hang on clocks. Each event is a small file;
compact puts all of them into one. An event that is found twice, as after a compaction that
did not get to its end, counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.lake import is_absent, remove_path

RUN_COUNTS = ("bronze_rows", "quarantine_rows", "silver_rows", "gold_daily_rows")
SHOWN_RUNS = 10

_EVENT_SCHEMA = (
    "run_id string, event string, event_at timestamp, status string, raw_file string, "
    "sample_rows bigint, bronze_rows bigint, quarantine_rows bigint, silver_rows bigint, "
    "gold_daily_rows bigint, notes string, number int, event_id string"
)
# Reading with the full schema gives NULL for columns that older files lack.
_RESULT_SCHEMA = (
    "quality_run_id string, checked_at timestamp, check_name string, failed_rows bigint, "
    "total_rows bigint, status string"
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class History:
    """Runs are start and finish events; the state of a run is worked out when read."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.events_path = f"{root.rstrip('/')}/history/pipeline_run_events"
        self.results_path = f"{root.rstrip('/')}/history/quality_results"

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if not is_absent(error):
                raise
            return self.spark.createDataFrame([], schema)

    def _append_event(self, **values: Any) -> None:
        values = {"event_at": _now(), "event_id": str(uuid.uuid4()), **values}
        row = self.spark.createDataFrame([values], _EVENT_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.events_path)

    @contextmanager
    def recorded(self, raw_file: str, sample_rows: int | None = None) -> Iterator[dict[str, Any]]:
        """Record a run around a block, which fills in the counts it is given.

        Leaving the block by an error records the error and the counts so far, and raises it.
        """
        counts: dict[str, Any] = {"run_id": str(uuid.uuid4()), "raw_file": raw_file}
        run = {"run_id": counts["run_id"]}
        self._append_event(
            **run, number=0, event="start", status="RUNNING", raw_file=raw_file, sample_rows=sample_rows
        )
        status, notes = "FAILED", None
        try:
            yield counts
            status = "SUCCESS"
        except BaseException as error:
            notes = str(error)
            raise
        finally:
            known = {name: counts.get(name) for name in RUN_COUNTS}
            self._append_event(
                **run, number=1, event="finish", status=status, notes=notes, **known
            )

    def events(self) -> DataFrame:
        """All events once; older ones without a number or id get them from what they hold."""
        found = self._read(self.events_path, _EVENT_SCHEMA)
        content = F.sha2(F.to_json(F.struct(*[name for name in found.columns if name != "event_id"])), 256)
        return found.withColumns(
            {
                "event_id": F.coalesce("event_id", content),
                "number": F.coalesce("number", F.when(F.col("event") == "start", 0).otherwise(1)),
            }
        ).dropDuplicates(["event_id"])

    def compact(self) -> None:
        """Put all events into one file; events appended meanwhile are kept."""
        before = self._read(self.events_path, _EVENT_SCHEMA).inputFiles()
        if len(before) < 2:
            return
        # the files read are fixed here; they go once their events are in the new one
        self.events().coalesce(1).write.mode("append").parquet(self.events_path)
        for path in before:
            remove_path(self.spark, path)

    def runs(self) -> DataFrame:
        """One row per run: its start joined with its latest finish, if any."""
        started, finished = F.col("event") == "start", F.col("event") == "finish"
        order = F.struct("number", "event_at", "event_id")
        finish = F.max_by(
            F.when(finished, F.struct("event_at", "status", *RUN_COUNTS, "notes")),
            F.when(finished, order),
        )
        start = F.min_by(
            F.struct("event_at", "status", "raw_file", "sample_rows"), F.when(started, order)
        )
        return (
            self.events()
            .groupBy("run_id")
            .agg(start.alias("start"), finish.alias("finish"))
            .select(
                "run_id",
                F.col("start.event_at").alias("started_at"),
                F.col("finish.event_at").alias("finished_at"),
                F.coalesce("finish.status", "start.status").alias("status"),
                "start.raw_file",
                "start.sample_rows",
                *[f"finish.{name}" for name in RUN_COUNTS],
                "finish.notes",
            )
        )

    def recent_runs(self, limit: int = SHOWN_RUNS) -> DataFrame:
        return (
            self.runs()
            .orderBy(F.desc("started_at"), "run_id")
            .limit(limit)
            .select("run_id", "started_at", "finished_at", "status", *RUN_COUNTS)
        )

    def append_quality(self, results: DataFrame) -> str:
        """Add the rows of quality.check_results under a new quality_run_id."""
        quality_run_id = str(uuid.uuid4())
        results.select(
            F.lit(quality_run_id).alias("quality_run_id"),
            F.lit(_now()).cast("timestamp").alias("checked_at"),
            "check_name",
            "failed_rows",
            "total_rows",
            "status",
        ).coalesce(1).write.mode("append").parquet(self.results_path)
        return quality_run_id

    def quality_results(self) -> DataFrame:
        return self._read(self.results_path, _RESULT_SCHEMA)

    def latest_quality(self) -> DataFrame:
        """Results of the newest quality run that has an id."""
        results = self.quality_results()
        newest = (
            results.filter("quality_run_id IS NOT NULL")
            .agg(F.max_by("quality_run_id", F.struct("checked_at", "quality_run_id")))
            .scalar()
        )
        return (
            results.filter(F.col("quality_run_id") == newest)
            .orderBy("check_name")
            .select("check_name", "failed_rows", "total_rows", "status")
        )
