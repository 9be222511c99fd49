"""The refresh as a stream: a feed of changes drives the same merge."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formfold.catalog import FORMS
from formfold.plans.workflows import Workspace
from formfold.sources import curated

FEED = "kind string, id bigint"


def asked_keys(batch: DataFrame, records: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(encounters, persons) that a batch of (kind, id) touches.  A patient's change touches the
    encounters of the patient and the client; kinds are encounter, patient and person."""
    ids = lambda *kinds: batch.filter(F.col("kind").isin(*kinds)).select("id")
    patients = ids("patient").withColumnRenamed("id", "patient_id")
    through = records["encounter"].join(patients, "patient_id", "left_semi").select("encounter_id")
    encounters = ids("encounter").withColumnRenamed("id", "encounter_id").union(through).distinct()
    return encounters, ids("person", "patient").withColumnRenamed("id", "person_id").distinct()


def merge_batch(
    workspace: Workspace, records: Callable[[], Mapping[str, DataFrame]], tables=FORMS, stream: str = "feed",
    clients: bool = True,
) -> Callable[[DataFrame, int], None]:
    """What one micro-batch does.

    The number of the batch is noted in the same file that makes its rows current, so a batch that
    comes again is skipped; and recomputing whole encounters makes one that was half done
    change nothing when it is done again.  Copies of a batch are deleted at its end.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= curated.state(workspace.spark, workspace.root)["batches"].get(stream, -1):
            return
        with workspace.scratch():
            given, now = workspace.written(batch.select("kind", "id").distinct(), "batch"), records()
            encounters, persons = asked_keys(given, now)
            workspace.apply(now, workspace.written(encounters, "batch-encounters"), persons if clients else None, tables,
                            only=True, batch=(stream, batch_id))

    return merge


def refresh_stream(
    feed: DataFrame,
    workspace: Workspace,
    records: Callable[[], Mapping[str, DataFrame]],
    checkpoint: str,
    tables=FORMS,
    clients: bool = True,
    **trigger,
) -> StreamingQuery:
    """Start the refresh on a streaming feed of (kind, id), or of encounter_id alone.

    ``records`` is called per batch, so each one reads the record tables as they stand.
    ``clients``: the registry follows too.  Without a trigger, what is available is worked
    off and the query ends.  A stream is named by its checkpoint.
    """
    if "kind" not in feed.columns:
        feed = feed.select(F.lit("encounter").alias("kind"), F.col("encounter_id").cast("bigint").alias("id"))
    return (
        feed.writeStream.foreachBatch(merge_batch(workspace, records, tables, checkpoint, clients))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
