"""Micro-batch form of the incremental model.

The landing zone is a file source; each micro-batch runs the batch upsert. That keeps the
latest loaded copy of a late or repeated observation, where streaming deduplication would
keep the first.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelflog.operators.merge import newest_moment, read_table, since_lookback, upsert
from shelflog.operators.staging import stage_events
from shelflog.plans.intermediate import deduplicated
from shelflog.plans.load import DAY, OBSERVATIONS
from shelflog.schemas import PARTITIONS
from shelflog.sources.landing import EVENTS, conform_events, examine_lines, good_lines


LEDGER = "drain string, event string, mark timestamp_ntz, batch bigint, written timestamp"


def landed_events_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed observations as a stream of raw-table rows, stamped as they are read.

    Bad lines are left out, as in a batch scan. The stream follows the files, not the
    manifests: rows of a run that is written again replace themselves under their ids.
    """
    landed = (
        spark.readStream.schema(T.StructType([T.StructField("value", T.StringType()), *PARTITIONS.fields]))
        .option("basePath", f"{root}/{EVENTS}")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(f"{root}/{EVENTS}")
    )
    lines = examine_lines(landed.where(F.col("value").rlike(r"\S")), EVENTS)
    return conform_events(good_lines(lines)).withColumns(
        {
            "raw_payload": F.lit(None).cast("string"),
            "loaded_at": F.current_timestamp().cast("timestamp_ntz"),
        }
    )


class Ledger:
    """What a checkpoint's drains have done: a small table of events beside the checkpoint.

    A drain is opened with its high-water mark, books each batch it has applied, and is
    closed when the stream is drained. One that was never closed goes on at the next start.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}-drains"

    def entries(self) -> DataFrame:
        return read_table(self.spark, self.path, T.StructType.fromDDL(LEDGER))

    def book(self, drain: str, event: str, mark: datetime | None = None, batch: int | None = None) -> None:
        row = self.spark.createDataFrame([(drain, event, mark, batch)], "drain string, event string, mark timestamp_ntz, batch bigint")
        row.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def open_drain(self) -> tuple[str, datetime | None] | None:
        """Name and mark of the drain that was not closed."""
        closed = self.entries().where("event = 'closed'").select("drain")
        left = self.entries().where("event = 'opened'").join(closed, "drain", "left_anti").orderBy(F.desc("written")).first()
        return None if left is None else (left["drain"], left["mark"])

    def applied(self, drain: str, batch: int) -> bool:
        return not self.entries().where((F.col("drain") == drain) & (F.col("batch") == batch)).isEmpty()


class Drain:
    """A running drain; its ledger entry is closed when ``awaitTermination`` has seen the end."""

    def __init__(self, query: StreamingQuery, ledger: Ledger, name: str):
        self.query, self.ledger, self.name = query, ledger, name

    def awaitTermination(self) -> None:  # noqa: N802 (as a streaming query has it)
        self.query.awaitTermination()
        self.ledger.book(self.name, "closed")


def stream_observations(raw_events: DataFrame, table: str, checkpoint: str, *, full: bool = False) -> Drain:
    """Upsert a stream of raw-table rows into the observation table until it is drained.

    A replayed batch changes nothing. All batches apply the 48-hour lookback of the batch job
    to the newest moment stored before the first of them, so neither the size nor the order of
    the batches changes which rows are taken; an empty table is filled completely. ``full``
    takes rows however late they are.

    That moment is kept in a ledger beside the checkpoint. A drain that broke off, between
    batches or inside one, goes on at the next call with the mark it began with, and batches
    it has booked are not applied again: the table is that of an unbroken drain. Files that
    landed meanwhile are drained with it, under the same mark. A drain that is stopped on
    purpose, or not awaited, counts as broken off.
    """
    spark = raw_events.sparkSession
    ledger = Ledger(spark, checkpoint)
    resumed = ledger.open_drain()
    if resumed is None:
        name, newest = uuid.uuid4().hex, newest_moment(spark, table, OBSERVATIONS)
        ledger.book(name, "opened", mark=newest)
    else:
        name, newest = resumed
    mark = None if full else newest

    def apply(batch: DataFrame, number: int) -> None:
        if resumed is not None and ledger.applied(name, number):
            return
        upsert(deduplicated(since_lookback(stage_events(batch), mark)), table, "event_id", day=DAY, key_fixes_day=True)
        ledger.book(name, "batch", batch=number)

    query = (
        raw_events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return Drain(query, ledger, name)


def first_copies(raw_events: DataFrame, hours: int = 48) -> DataFrame:
    """Streaming deduplication alone: the first copy within the watermark is kept."""
    return (
        raw_events.withColumn("event_time", F.col("observed_at").cast("timestamp"))
        .withWatermark("event_time", f"{hours} hours")
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def drain_first_copies(raw_events: DataFrame, path: str, checkpoint: str, hours: int = 48) -> int:
    """Append the first copies of a stream to ``path``; returns how many rows came too late.

    The state store remembers ids for ``hours`` of event time and is kept by the checkpoint,
    so a later call knows the copies of an earlier one. Rows behind the watermark are dropped
    and counted from the query's progress.
    """
    query = (
        first_copies(raw_events, hours).drop("event_time")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
