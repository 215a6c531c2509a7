"""Landing zone: append-only JSON lines under source/year/month/day/run_id.

One folder per kind of file below the root. ``root`` is any URI Spark can reach
(``file:``, ``s3a:``, ``hdfs:``). The readers also take a combined layout, where all
kinds share one tree and are told apart by file name.

A run counts once its manifest is there: readers leave out runs without one, and writing such
a run again replaces what the broken attempt left. Lines that are no JSON object of their
kind's types, and observations without an id, are kept apart as bad lines.
"""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.functions import iso_utc, read_utc
from shelflog.session import remove_path
from shelflog.schemas import (
    INGESTION_RUNS,
    INVENTORY_EVENTS,
    LANDED_EVENT,
    LANDED_MANIFEST,
    LANDED_PAYLOAD,
    LANDED_REJECT,
    PARTITIONS,
)

PAYLOADS, EVENTS, REJECTS, MANIFESTS = (
    "raw_payloads",
    "normalized_events",
    "rejected_records",
    "manifests",
)
# File names of the combined layout.
COMBINED_FILES = {
    PAYLOADS: "raw_payloads.ndjson",
    EVENTS: "normalized_events.ndjson",
    REJECTS: "rejected_records.ndjson",
    MANIFESTS: "manifest.json",
}
SCHEMAS = {
    PAYLOADS: LANDED_PAYLOAD,
    EVENTS: LANDED_EVENT,
    REJECTS: LANDED_REJECT,
    MANIFESTS: LANDED_MANIFEST,
}
LEVELS = PARTITIONS.names
PARTS = (PAYLOADS, EVENTS, REJECTS)  # what a run holds besides its manifest
UNREADABLE, WITHOUT_KEY = "unreadable", "without key"
KEYS = {EVENTS: "event_id"}
BAD_LINE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("line_id", "kind", *LEVELS, "file", "fault", "line")]
    + [T.StructField("copies", T.LongType()), T.StructField("loaded_at", T.TimestampNTZType())]
)
# Runs without a manifest are the rare leftovers of broken writes; up to this many are sent to the tasks.
FEW_RUNS = 10_000
# Chunks of a run's digest: part of the digest's definition, whatever the size of the run.
DIGEST_CHUNKS = 4096


class RunExists(ValueError):
    """A published run must not be written again."""


class BadLines(ValueError):
    """The landing zone holds lines that can't be loaded."""


# ---- writing ---------------------------------------------------------------------------


def with_levels(df: DataFrame, moment: Column, run_id: str) -> DataFrame:
    """Add the directory columns; ``source`` must exist."""
    return df.withColumns(
        {
            "year": F.date_format(moment, "yyyy"),
            "month": F.date_format(moment, "MM"),
            "day": F.date_format(moment, "dd"),
            "run_id": F.col(run_id),
        }
    )


def _times_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: iso_utc(F.col(f.name))
            for f in df.schema
            if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))
        }
    )


def append_files(df: DataFrame, root: str, kind: str, compression: str | None = None) -> None:
    """Append rows of one kind; ``df`` carries the directory columns. No rows, no folder.

    ``compression`` names a codec of Spark's text files (``gzip``), which readers know by the
    files' names; without one the files are plain.
    """
    if df.isEmpty():
        return
    columns = [c for c in SCHEMAS[kind].names if c in df.columns and c not in LEVELS]
    # Rebalancing gathers small runs into few files and splits a run too large for one task.
    writer = _times_as_text(df.select(*columns, *LEVELS)).hint("rebalance", *LEVELS).write.partitionBy(
        *LEVELS
    ).mode("append").option("ignoreNullFields", False)
    if compression is not None:
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    writer.json(f"{root}/{kind}")


def list_files(spark: SparkSession, root: str, kind: str, combined: bool = False) -> DataFrame:
    """Files of one kind with their directory columns; lists names, opens nothing.

    Filters on the directory columns are partition filters, so other folders' files are not
    looked at.
    """
    base = root if combined else f"{root}/{kind}"
    reader = spark.read.format("binaryFile").schema(T.StructType(_binary_fields() + PARTITIONS.fields))
    if combined:
        reader = reader.option("pathGlobFilter", COMBINED_FILES[kind])
    try:
        return reader.option("basePath", base).load(base).select("path", *LEVELS)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType(_binary_fields()[:1] + PARTITIONS.fields))


def _binary_fields() -> list[T.StructField]:
    return [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]


def refuse_existing_runs(incoming: DataFrame, root: str) -> None:
    """Raise if a run of ``incoming`` (directory columns) is published, i.e. has a manifest.

    A run that received nothing has a manifest too. Looks at the years of the incoming runs.
    """
    runs, there = _incoming_and_there(incoming, root, MANIFESTS)
    taken = runs.join(there, ["source", "run_id"], "left_semi").take(1)
    if taken:
        raise RunExists(f"run {taken[0]['run_id']} already has a manifest under {root}")


def _incoming_and_there(incoming: DataFrame, root: str, kind: str) -> tuple[DataFrame, DataFrame]:
    runs = incoming.select(*LEVELS).distinct()
    first, last = runs.agg(F.min("year"), F.max("year")).first()
    there = list_files(incoming.sparkSession, root, kind)
    return runs, there.where(F.col("year").between(F.lit(first), F.lit(last))).select(*LEVELS).distinct()


def clear_unpublished(incoming: DataFrame, root: str) -> None:
    """Delete what broken writes left of the runs of ``incoming``, none of which is published.

    Only whole run folders of these runs go. One writer a run is taken for granted.
    """
    spark = incoming.sparkSession
    for kind in PARTS:
        runs, there = _incoming_and_there(incoming, root, kind)
        for row in there.join(runs.select("source", "run_id"), ["source", "run_id"], "left_semi").select(*LEVELS).toLocalIterator():
            remove_path(spark, f"{root}/{kind}/" + "/".join(f"{level}={row[level]}" for level in LEVELS))


def write_runs(
    root: str,
    payloads: DataFrame,
    events: DataFrame,
    rejects: DataFrame,
    manifests: DataFrame,
    compression: str | None = None,
) -> None:
    """Append whole runs in two phases; a published run id is an error.

    All frames carry the directory columns. The parts of the runs go first and stay invisible
    to the readers; the manifests go last, and with its manifest a run is published as a
    whole. If the write breaks before that, it can be repeated: leftovers of the same runs
    are removed first. What is published is never overwritten. ``compression`` is that of the
    parts; manifests are always plain.
    """
    append_part = append_files if compression is None else partial(append_files, compression=compression)
    incoming = payloads.select(*LEVELS).unionByName(manifests.select(*LEVELS))
    refuse_existing_runs(incoming, root)
    clear_unpublished(incoming, root)
    append_part(payloads, root, PAYLOADS)
    append_part(events, root, EVENTS)
    append_part(rejects, root, REJECTS)
    append_files(with_paths(manifests), root, MANIFESTS)


def with_paths(manifests: DataFrame) -> DataFrame:
    """Where the parts of each run lie, below the root."""
    return manifests.withColumns(
        {
            "raw_payload_path": _run_folder(PAYLOADS),
            "normalized_output_path": _run_folder(EVENTS),
            "manifest_path": _run_folder(MANIFESTS),
        }
    )


def _run_folder(kind: str) -> Column:
    pieces: list[Column] = [F.lit(kind)]
    for level in LEVELS:
        pieces += [F.lit(f"/{level}="), F.col(level)]
    return F.concat(*pieces)


def json_line(df: DataFrame, kind: str) -> Column:
    """The text one row of ``kind`` has in its landing file."""
    columns = [c for c in SCHEMAS[kind].names if c in df.columns and c not in LEVELS]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_digests(lines: DataFrame, digest_name: str, chunks: int = DIGEST_CHUNKS) -> DataFrame:
    """SHA-256 fingerprint per run over ``lines`` (run_id, line), whatever their order.

    Equal lines are counted first; lines are spread over a fixed number of chunks by their
    own hash; chunk digests are hashed once more. No task sees a whole large run.
    """
    counted = (
        lines.select("run_id", F.sha2("line", 256).alias("line_digest"))
        .groupBy("run_id", "line_digest")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("chunk", F.pmod(F.conv(F.substring("line_digest", 1, 8), 16, 10).cast("bigint"), F.lit(chunks)))
    )
    item = F.concat_ws(":", "line_digest", F.col("copies").cast("string"))
    per_part = counted.groupBy("run_id", "chunk").agg(
        F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(item))), 256).alias("part")
    )
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "part")))
    return per_part.groupBy("run_id").agg(
        F.sha2(F.concat_ws("\n", ordered["part"]), 256).alias(digest_name)
    )


def with_content_hashes(manifests: DataFrame, payloads: DataFrame, events: DataFrame) -> DataFrame:
    """Add ``content_hashes`` per run, over the lines written for it."""

    def lines(df: DataFrame, kind: str) -> DataFrame:
        text = _times_as_text(df)
        return text.select("run_id", json_line(text, kind).alias("line"))

    return (
        manifests.join(content_digests(lines(payloads, PAYLOADS), PAYLOADS), "run_id", "left")
        .join(content_digests(lines(events, EVENTS), EVENTS), "run_id", "left")
        .withColumn(
            "content_hashes",
            F.map_filter(
                F.create_map(
                    F.lit(PAYLOADS), F.col(PAYLOADS), F.lit(EVENTS), F.col(EVENTS)
                ),
                lambda key, value: value.isNotNull(),
            ),
        )
        .drop(PAYLOADS, EVENTS)
    )


# ---- reading ---------------------------------------------------------------------------


def _lines(spark: SparkSession, root: str, kind: str, combined: bool) -> DataFrame:
    """Lines that are not blank, with directory columns, file name and place: value, file, position."""
    schema = T.StructType([T.StructField("value", T.StringType()), *PARTITIONS.fields])
    path = root if combined else f"{root}/{kind}"
    reader = spark.read.schema(schema).option("basePath", path)
    if combined:
        reader = reader.option("pathGlobFilter", COMBINED_FILES[kind])
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"))
    try:
        # In the combined layout a manifest is one indented document.
        found = reader.text(path, wholetext=combined and kind == MANIFESTS).withColumns({"file": F.col("_metadata.file_name"), "position": place})
    except AnalysisException as error:
        # The folder of a kind nothing was ever written to does not exist.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], schema).withColumns(
            {"file": F.lit(None).cast("string"), "position": F.lit(None).cast("struct<file_path:string,file_block_start:bigint,line:bigint>")}
        )
    return found.where(F.col("value").rlike(r"\S"))


def examine_lines(lines: DataFrame, kind: str) -> DataFrame:
    """``lines`` (value and more) with the parsed ``line`` and its ``fault``, null for a good one.

    The text is parsed inside another document, so that a second document or anything else
    after the first makes the line unreadable, as a cut or a value of another type does. All
    columns of the kind are always parsed: what is read later never changes what is bad.
    """
    body = T.StructType([f for f in SCHEMAS[kind] if f.name not in LEVELS])
    outer = T.StructType([T.StructField("line", body), T.StructField("end", T.IntegerType()), T.StructField("bad", T.StringType())])
    parsed = F.from_json(F.concat(F.lit('{"line":'), "value", F.lit(',"end":1}')), outer, {"columnNameOfCorruptRecord": "bad"})
    # One row each; the generator keeps the parser from being copied into filter and projection.
    read = lines.select("*", F.explode(F.array(parsed)).alias("_read"))
    good = F.col("_read.bad").isNull() & (F.col("_read.end") == 1) & F.col("_read.line").isNotNull()
    # (a JSON null is read as no line, text and numbers as bad ones)
    fault = F.when(~F.coalesce(good, F.lit(False)), F.lit(UNREADABLE))
    if kind in KEYS:
        fault = fault.when(F.col(f"_read.line.{KEYS[kind]}").isNull(), F.lit(WITHOUT_KEY))
    return read.select(*lines.columns, F.col("_read.line").alias("line"), fault.alias("fault"))


def examined(spark: SparkSession, root: str, kind: str, combined: bool = False) -> DataFrame:
    """Every line of the published runs: directory columns, file, position, value, line, fault."""
    return examine_lines(_published(_lines(spark, root, kind, combined), root, combined), kind)


def good_lines(lines: DataFrame, *more: str) -> DataFrame:
    """The good ones of ``examined`` lines, as columns."""
    return lines.where("fault is null").select("line.*", *LEVELS, *more)


def bad_lines(lines: DataFrame, kind: str) -> DataFrame:
    """The bad ones of ``examined`` lines of ``kind``; copies within a file are counted.

    ``line_id`` names a bad line by its run, file and text, so that it is known again.
    """
    of = [*LEVELS, "file", "fault", "value"]
    counted = lines.where("fault is not null").groupBy(*of).agg(F.count("*").alias("copies"))
    name = F.sha2(F.concat_ws("\n", F.lit(kind), "source", "run_id", "file", "value"), 256)
    return counted.select(name.alias("line_id"), F.lit(kind).alias("kind"), *of[:-1], F.col("value").alias("line"), "copies")


def scan_bad_lines(spark: SparkSession, root: str, combined: bool = False) -> DataFrame:
    """Bad lines of all kinds of files."""
    kinds = [bad_lines(examined(spark, root, kind, combined), kind) for kind in SCHEMAS]
    out = kinds[0]
    for more in kinds[1:]:
        out = out.unionByName(more)
    return out


def unpublished_runs(spark: SparkSession, root: str, combined: bool = False) -> DataFrame:
    """Runs with files but no manifest: source, run_id. Only names are listed."""
    parts = list_files(spark, root, PARTS[0], combined)
    for kind in PARTS[1:]:
        parts = parts.unionByName(list_files(spark, root, kind, combined))
    done = list_files(spark, root, MANIFESTS, combined).select("source", "run_id").distinct()
    return parts.select("source", "run_id").distinct().join(done, ["source", "run_id"], "left_anti")


def _published(rows: DataFrame, root: str, combined: bool) -> DataFrame:
    """``rows`` without those of unpublished runs, of which there are none or few as a rule."""
    spark = rows.sparkSession
    missing = unpublished_runs(spark, root, combined)
    few = missing.take(FEW_RUNS + 1)
    if not few:
        return rows
    if len(few) <= FEW_RUNS:
        missing = F.broadcast(spark.createDataFrame(few, missing.schema))
    return rows.join(missing, ["source", "run_id"], "left_anti")


def _scan(spark: SparkSession, root: str, kind: str, combined: bool, *more: str) -> DataFrame:
    return good_lines(examined(spark, root, kind, combined), *more)


def scan_payloads(spark: SparkSession, root: str, combined: bool = False) -> DataFrame:
    """Landed payloads; ``position`` orders the lines of one file."""
    return _scan(spark, root, PAYLOADS, combined, "position")


def scan_rejects(spark: SparkSession, root: str, combined: bool = False) -> DataFrame:
    return _scan(spark, root, REJECTS, combined)


def scan_events(spark: SparkSession, root: str, combined: bool = False) -> DataFrame:
    """Landed observations as raw-table rows, but for payload and load time.

    Keys missing in a line become null, unknown keys are dropped, blank lines are skipped; bad
    lines are left out (``scan_bad_lines``).
    """
    return conform_events(_scan(spark, root, EVENTS, combined))


def conform_events(landed: DataFrame) -> DataFrame:
    """Fixed columns in fixed order; ISO times with offset become UTC wall clocks."""
    times = {"observed_at", "extracted_at"}
    columns = [c for c in INVENTORY_EVENTS.names if c not in ("raw_payload", "loaded_at")]
    typed = {f.name: f.dataType for f in INVENTORY_EVENTS}
    return landed.select(
        *[
            read_utc(F.col(c)).alias(c)
            if c in times
            else F.expr(f"try_cast({c} as {typed[c].simpleString()})").alias(c)
            for c in columns
        ],
        "run_id",
    )


def scan_runs(spark: SparkSession, root: str, combined: bool = False) -> DataFrame:
    """Landed manifests as raw-table rows, but for the load time."""
    return conform_runs(_scan(spark, root, MANIFESTS, combined))


def conform_runs(landed: DataFrame) -> DataFrame:
    times = {"observed_at", "started_at", "completed_at"}
    reasons = F.to_json(F.coalesce("error_summary", F.array().cast("array<string>")))
    return landed.select(
        *[
            read_utc(F.col(c)).alias(c)
            if c in times
            else reasons.alias(c)
            if c == "error_summary"
            else F.col(c)
            for c in INGESTION_RUNS.names
            if c != "loaded_at"
        ]
    )


def attach_payloads(events: DataFrame, payloads: DataFrame) -> DataFrame:
    """Add each event's raw payload text by product within its run; none gives ``null``.

    If a run holds several payloads of a product, the one furthest down its file counts.
    They are reduced to one before the join, map-side first.
    """
    last = (
        payloads.select(
            "run_id",
            "retailer_product_id",
            F.to_json("raw_response").alias("payload"),
            "position",
        )
        .groupBy("run_id", "retailer_product_id")
        .agg(F.max_by("payload", "position").alias("raw_payload"))
    )
    return events.join(last, ["run_id", "retailer_product_id"], "left").withColumn(
        "raw_payload", F.coalesce("raw_payload", F.lit("null"))
    )


# ---- audit -----------------------------------------------------------------------------


def audit_digests(spark: SparkSession, root: str, combined: bool = False, chunks: int = DIGEST_CHUNKS) -> DataFrame:
    """Published runs whose files no longer give the digests of their manifest.

    One row per run and kind that differs: source, run_id, kind, booked, found; ``found`` is
    null where the files are gone, ``booked`` where the manifest names no digest. Digests are
    taken of the lines as they stand in the files, for runs of any size (``content_digests``).
    """
    books = _scan(spark, root, MANIFESTS, combined).select(
        "source", "run_id", F.explode_outer("content_hashes").alias("kind", "booked")
    )
    found = None
    for kind in (PAYLOADS, EVENTS):
        lines = _published(_lines(spark, root, kind, combined), root, combined)
        source = lines.select("run_id", "source").distinct()
        one = content_digests(lines.select("run_id", F.col("value").alias("line")), "found", chunks).join(source, "run_id")
        one = one.withColumn("kind", F.lit(kind))
        found = one if found is None else found.unionByName(one)
    both = books.where("kind is not null").join(found, ["source", "run_id", "kind"], "full")
    return both.where(~F.col("booked").eqNullSafe(F.col("found"))).select("source", "run_id", "kind", "booked", "found")
