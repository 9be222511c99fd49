"""The run log: start and stop notes are files of their own, the state of a run is derived.

Nothing is updated in place, so a run that dies leaves a start without a stop.  Notes of a run
are merged by its id, so notes that are there twice do no harm: old ones are put together
in one file before they are deleted one by one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.operators.reports import retained
from formfold.sources.staging import file_names, read_file, remove, write_file

NOTES = "id string, script_name string, start_time timestamp, stop_time timestamp, error string, noted_at timestamp"


def runs(notes: DataFrame) -> DataFrame:
    """One row per run from its notes."""
    return notes.groupBy("id").agg(
        F.max("script_name").alias("script_name"),
        F.max("start_time").alias("start_time"),
        F.max("stop_time").alias("stop_time"),
        F.max("error").alias("error"),
    )


def finished(runs_: DataFrame, failed: bool = False) -> DataFrame:
    """Runs that have stopped; those that failed only if asked for."""
    done = runs_.filter("stop_time IS NOT NULL")
    return done if failed else done.filter("error IS NULL")


def watermark(runs_: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One row: the latest start of a finished run of the given names, or null."""
    done = finished(runs_).filter(F.col("script_name").isin(list(names)))
    return done.agg(F.max("start_time").alias("since"))


def last_starts(runs_: DataFrame) -> DataFrame:
    """(script_name, since): the latest start of a run that has stopped, failed ones too."""
    return finished(runs_, failed=True).groupBy("script_name").agg(F.max("start_time").alias("since"))


def present() -> datetime:
    return datetime.now(timezone.utc)


class RunLog:
    def __init__(self, spark: SparkSession, path: str, most: int = 200, days: int = 400, clock: Callable[[], datetime] = present):
        """most: files of notes before they are put together; days: how long runs are kept then,
        but for the last that finished of each name."""
        self.spark, self.path, self.most, self.days, self.clock = spark, path, most, days, clock

    def _append(self, **note) -> None:
        self._write([{"noted_at": self.clock().isoformat(), **note}])

    def _write(self, notes: list[dict]) -> None:
        name = f"{time.time_ns()}-{uuid.uuid4().hex}.json"
        write_file(self.spark, f"{self.path}/{name}", "".join(json.dumps(n) + "\n" for n in notes))

    def start(self, name: str) -> str:
        run = uuid.uuid4().hex
        self._append(id=run, script_name=name, start_time=self.clock().isoformat())
        return run

    def stop(self, run: str, error: str | None = None) -> None:
        self._append(id=run, stop_time=self.clock().isoformat(), error=error)
        if len(file_names(self.spark, self.path)) > self.most:
            self.compact()

    def compact(self) -> None:
        """All notes in one file, one a run."""
        old, merged, last = self._names(), {}, {}
        for n in old:
            for line in read_file(self.spark, f"{self.path}/{n}").splitlines():
                note = json.loads(line)
                run = merged.setdefault(note["id"], {})
                run.update({k: v for k, v in note.items() if v is not None})
        for run in merged.values():
            if run.get("stop_time") and not run.get("error") and run.get("start_time", "") >= last.get(run.get("script_name"), ""):
                last[run.get("script_name")] = run.get("start_time", "")
        limit = (self.clock() - timedelta(days=self.days)).isoformat()
        self._write([r for r in merged.values() if r["noted_at"] >= limit or last.get(r.get("script_name")) == r.get("start_time")])
        for n in old:
            remove(self.spark, f"{self.path}/{n}")

    def _names(self) -> list[str]:
        return [n for n in file_names(self.spark, self.path) if n.endswith(".json")]

    def notes(self) -> DataFrame:
        if not self._names():
            return self.spark.createDataFrame([], NOTES)
        return self.spark.read.schema(NOTES).option("pathGlobFilter", "*.json").json(self.path)

    def runs(self) -> DataFrame:
        return runs(self.notes())

    def since(self, names: tuple[str, ...]) -> datetime | None:
        return watermark(self.runs(), names).first()["since"]

    def remembered(self, names: tuple[str, ...], hours: int = 12) -> DataFrame:
        """The runs without old ones of the given names.  Old notes are left out when the log
        is read, so that no reader and no crash ever meets a log that is being rewritten."""
        return retained(self.runs(), names, hours=hours)
