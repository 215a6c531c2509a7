"""From landing files to raw tables to the incremental observation table."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.operators.merge import LOOKBACK_HOURS, insert_new, keeps_variant, newest_moment, read_table, since_lookback, upsert
from shelflog.operators.staging import stage_events
from shelflog.plans.intermediate import OBSERVATION_COLUMNS, deduplicated
from shelflog.schemas import INGESTION_RUNS, INVENTORY_EVENTS, with_variant
from shelflog.session import lean_disk, temporary_table
from shelflog.sources import landing
from pyspark.sql import types as T

DAY = "observed_date"
OBSERVATIONS = T.StructType(
    [INVENTORY_EVENTS[name] for name in OBSERVATION_COLUMNS]
    + [T.StructField(DAY, T.DateType())]
)


TYPED_EVENTS = with_variant(INVENTORY_EVENTS, "raw_payload")
TYPED_RUNS = with_variant(INGESTION_RUNS, "error_summary")


def _takes_variant(spark: SparkSession, path: str, column: str, typed: bool) -> bool:
    """A table stays as it was begun; ``typed`` decides about a new one."""
    stored = keeps_variant(spark, path, column)
    return typed if stored is None else stored


def merge_events(
    batch: DataFrame,
    path: str,
    loaded_at: datetime,
    dedupe: bool = True,
    typed: bool = False,
    complete: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Insert observations with a new event_id. Ids are derived from the time.

    ``typed`` begins a table that keeps the payloads parsed, as VARIANT columns; an existing
    table keeps its form. ``complete`` adds columns that ``batch`` lacks, to the new rows alone.
    """
    typed = _takes_variant(batch.sparkSession, path, "raw_payload", typed)
    return insert_new(
        batch,
        path,
        TYPED_EVENTS if typed else INVENTORY_EVENTS,
        "event_id",
        loaded_at,
        newest=["extracted_at", "ingestion_run_id"] if dedupe else None,
        day=DAY,
        key_fixes_day=True,
        parse="raw_payload" if typed else None,
        complete=complete,
    )


def merge_runs(batch: DataFrame, path: str, loaded_at: datetime, dedupe: bool = True, typed: bool = False) -> int:
    """Insert run manifests with a new run_id; ``typed`` as in ``merge_events``, for the reject reasons."""
    typed = _takes_variant(batch.sparkSession, path, "error_summary", typed)
    return insert_new(
        batch,
        path,
        TYPED_RUNS if typed else INGESTION_RUNS,
        "run_id",
        loaded_at,
        newest=["completed_at", "started_at"] if dedupe else None,
        parse="error_summary" if typed else None,
    )


def merge_bad_lines(batch: DataFrame, path: str, loaded_at: datetime) -> int:
    """Quarantine bad lines that the table does not hold yet."""
    return insert_new(batch, path, landing.BAD_LINE, "line_id", loaded_at)


def load_landing(
    spark: SparkSession,
    root: str,
    events_path: str,
    runs_path: str,
    loaded_at: datetime,
    combined: bool = False,
    quarantine_path: str | None = None,
    typed: bool = False,
) -> DataFrame:
    """Load all runs published under ``root``; one row of counters.

    Loading the same files again inserts nothing. With bad lines (cut, no JSON object, values
    of another type, observations without an id) nothing is loaded and ``BadLines`` is raised,
    unless ``quarantine_path`` names a table for them: then the good lines are loaded and the
    bad ones are kept there, once each. ``typed`` begins raw tables that keep JSON parsed.
    """
    with ExitStack() as scratch:
        scratch.enter_context(lean_disk(spark))
        # Parsed once; loads and quarantine read the outcome.
        lines = {
            kind: scratch.enter_context(temporary_table(_without_good_text(landing.examined(spark, root, kind, combined)), "landed-lines"))
            for kind in (landing.EVENTS, landing.PAYLOADS, landing.MANIFESTS)
        }
        bad = [landing.bad_lines(rows, kind) for kind, rows in lines.items()]
        bad = bad[0].unionByName(bad[1]).unionByName(bad[2])
        diverted = 0
        if quarantine_path is not None:
            diverted = merge_bad_lines(bad, quarantine_path, loaded_at)
        else:
            first = bad.take(1)
            if first:
                where = "/".join(str(first[0][c]) for c in ("kind", "source", "run_id", "file"))
                raise landing.BadLines(f"{first[0]['fault']} line in {where}: {first[0]['line'][:200]}")
        events = landing.conform_events(landing.good_lines(lines[landing.EVENTS]))
        payloads = landing.good_lines(lines[landing.PAYLOADS], "position")
        runs = landing.conform_runs(landing.good_lines(lines[landing.MANIFESTS]))
        counters = (
            merge_events(events, events_path, loaded_at, typed=typed, complete=lambda new: landing.attach_payloads(new, payloads)),
            merge_runs(runs, runs_path, loaded_at, typed=typed),
            landing.list_files(spark, root, landing.EVENTS, combined).count(),
            landing.list_files(spark, root, landing.MANIFESTS, combined).count(),
            diverted,
        )
    return spark.createDataFrame(
        [counters],
        "events_loaded bigint, runs_loaded bigint, events_source_files bigint, "
        "runs_source_files bigint, bad_lines bigint",
    )


def _without_good_text(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", F.when(F.col("fault").isNotNull(), F.col("value")))


def _dated(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(DAY, T.DateType())])


def read_raw_events(spark: SparkSession, path: str, with_day: bool = False) -> DataFrame:
    """The raw table with the payload as text, whichever way it is kept."""
    if keeps_variant(spark, path, "raw_payload"):
        table = read_table(spark, path, _dated(TYPED_EVENTS)).withColumn("raw_payload", F.to_json("raw_payload"))
    else:
        table = read_table(spark, path, _dated(INVENTORY_EVENTS))
    return table if with_day else table.drop(DAY)


def read_typed_events(spark: SparkSession, path: str) -> DataFrame:
    """The raw table with the payload as VARIANT, for queries by path.

    A table begun ``typed`` is read as it is, so paths reach the scan; text is parsed here.
    """
    if keeps_variant(spark, path, "raw_payload"):
        return read_table(spark, path, _dated(TYPED_EVENTS)).drop(DAY)
    return read_raw_events(spark, path).withColumn("raw_payload", F.try_parse_json("raw_payload"))


def read_raw_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table with the reject reasons as text, whichever way they are kept."""
    if keeps_variant(spark, path, "error_summary"):
        return read_table(spark, path, TYPED_RUNS).withColumn("error_summary", F.to_json("error_summary"))
    return read_table(spark, path, INGESTION_RUNS)


def read_typed_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table with the reject reasons as VARIANT."""
    if keeps_variant(spark, path, "error_summary"):
        return read_table(spark, path, TYPED_RUNS)
    return read_raw_runs(spark, path).withColumn("error_summary", F.try_parse_json("error_summary"))


def refresh_observations(
    staged: DataFrame, path: str, *, full: bool = False, key_fixes_day: bool = True
) -> None:
    """Bring the deduplicated observation table up to date with ``staged``.

    Takes rows newer than the newest stored time less 48 hours (strictly); older late rows
    wait for a ``full`` run. Running it again changes nothing. An empty table is filled
    completely.
    """
    recent = staged
    if not full:
        recent = since_lookback(staged, newest_moment(staged.sparkSession, path, OBSERVATIONS))
    upsert(deduplicated(recent), path, "event_id", day=DAY, key_fixes_day=key_fixes_day)


def refresh_from_raw(
    spark: SparkSession, events_path: str, path: str, *, full: bool = False, key_fixes_day: bool = True
) -> None:
    """``refresh_observations`` from the raw table, opening only the days of the lookback."""
    upsert(
        deduplicated(recent_staged(spark, events_path, path, full)), path, "event_id", day=DAY, key_fixes_day=key_fixes_day
    )


def recent_staged(spark: SparkSession, events_path: str, path: str, full: bool = False) -> DataFrame:
    """Staged rows of the raw table that a refresh of the observations at ``path`` takes."""
    raw = read_raw_events(spark, events_path, with_day=True)
    if not full:
        raw = since_lookback(raw, newest_moment(spark, path, OBSERVATIONS))
    return stage_events(raw.drop(DAY))


def skipped_late_rows(staged: DataFrame, path: str) -> int:
    """Observations outside the lookback that the table has never seen, copies counted once."""
    spark = staged.sparkSession
    newest = newest_moment(spark, path, OBSERVATIONS)
    if newest is None:
        return 0
    start = newest - timedelta(hours=LOOKBACK_HOURS)
    bound = F.lit(start.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    late = staged.where((F.col("observed_at") <= bound) | F.col("observed_at").isNull()).select("event_id")
    known = read_table(spark, path, OBSERVATIONS).select("event_id").distinct()
    return late.join(known, "event_id", "left_anti").distinct().count()


def recent_runs(raw_runs: DataFrame) -> DataFrame:
    """Diagnostic view: newest runs first."""
    return raw_runs.select(
        "run_id",
        "source",
        "started_at",
        "completed_at",
        "status",
        "payloads_received",
        "events_normalized",
        "events_rejected",
        "pipeline_version",
    ).orderBy(F.col("started_at").desc_nulls_first(), "run_id")


def stage_table(spark: SparkSession, events_path: str) -> DataFrame:
    return stage_events(read_raw_events(spark, events_path))
