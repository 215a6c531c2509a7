"""Merging batches into Parquet tables: insert-only and upsert."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.operators.dedup import latest_per_key
from shelflog.session import temporary_table

LOOKBACK_HOURS = 48
# Fixed value: the folder of rows without a day.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def table_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table in the given columns, None while nothing has been written to ``path``."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    table = table_or_none(spark, path, schema)
    return empty_table(spark, schema) if table is None else table


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known as such to the optimizer, which drops the joins and unions with them."""
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def keeps_variant(spark: SparkSession, path: str, column: str) -> bool | None:
    """Whether the table keeps ``column`` as VARIANT; None while nothing has been written."""
    try:
        stored = spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return isinstance(stored[column].dataType, T.VariantType)


def _with_day(df: DataFrame, day: str | None, moment: str) -> DataFrame:
    return df if day is None else df.withColumn(day, F.col(moment).cast("date"))


def only_days(target: DataFrame, touched: DataFrame, day: str) -> DataFrame:
    """Target rows of the days in ``touched``, whatever their number.

    The range of days is a literal filter, so folders outside it are never listed for
    reading; inside it the semi join on the partition column drops the days between.
    """
    low, high, undated = touched.agg(F.min(day), F.max(day), F.count_if(F.col(day).isNull())).first()
    rows = target.where(F.lit(False))
    if low is not None:
        dated = touched.where(F.col(day).isNotNull()).select(day).distinct()
        rows = target.where(F.col(day).between(F.lit(low), F.lit(high))).join(dated, day, "left_semi")
    if undated:
        rows = rows.unionByName(target.where(F.col(day).isNull()))
    return rows


def insert_new(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    key: str,
    loaded_at: datetime,
    *,
    newest: list[str] | None = None,
    day: str | None = None,
    moment: str = "observed_at",
    key_fixes_day: bool = False,
    parse: str | None = None,
    complete: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Append the rows of ``batch`` whose ``key`` the table does not hold; returns how many.

    Rows already there are left alone; rows without a key are never inserted, as no load could
    know them again. ``newest`` lists the columns deciding between copies
    inside the batch, so that one is inserted; without it all copies of a new key are.
    ``day`` partitions the table by the date of ``moment``. With ``key_fixes_day`` (ids
    derived from the time) only the days of the batch are compared. ``parse`` names a column of
    JSON text that ``schema`` keeps as VARIANT: it is parsed here, for the new rows alone, and
    text that is no JSON is an error. ``complete`` adds columns of ``schema`` that ``batch`` lacks
    to the new rows, one row each. New rows, completed rows and table are then written in
    turn, so that the shuffle files of one step are gone before the next.
    """
    spark = batch.sparkSession
    columns = [f.name for f in schema if f.name != "loaded_at"]
    batch = batch.where(F.col(key).isNotNull())
    rows = batch if complete else batch.select(*columns)
    if newest:
        rows = latest_per_key(rows, key, newest)
    rows = _with_day(rows, day, moment)
    stored = T.StructType(schema.fields + ([T.StructField(day, T.DateType())] if day else []))
    begun = table_or_none(spark, path, stored)
    target = empty_table(spark, stored) if begun is None else begun
    if day and key_fixes_day:
        touched = _with_day(batch.select(moment), day, moment)
        target = only_days(target, touched, day)
    # Distinct before the join: copies in the table cannot pile up in one task.
    known = target.select(key).distinct()
    stamp = F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    new = rows.join(known, key, "left_anti")
    with ExitStack() as scratch:
        if complete:
            with temporary_table(new, "new-rows") as found:
                if begun is not None and found.isEmpty():
                    return 0
                new = scratch.enter_context(temporary_table(complete(found), "completed-rows"))
        new = new.withColumn("loaded_at", stamp)
        if parse:
            new = new.withColumn(parse, F.parse_json(parse))
        ordered = new.select(*schema.names, *([day] if day else []))

        # Counting rows reads file footers only; the difference is what this call added.
        before = target.count()
        if day:
            ordered.hint("rebalance", day).write.partitionBy(day).mode("append").parquet(path)
        else:
            ordered.write.mode("append").parquet(path)
    after = read_table(spark, path, stored)
    if day and key_fixes_day:
        after = only_days(after, touched, day)
    return after.count() - before


def newest_moment(spark: SparkSession, path: str, schema: T.StructType, day: str = "observed_date"):
    """Newest stored ``observed_at``, None for an empty table.

    The newest day comes from a listing of the folders, then only that day's files are read.
    A day whose rows all moved away leaves a folder without rows, so days are tried downwards.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if day not in files.columns:  # no folder of a day yet
        return None
    files = files.select(F.col(day).cast("date").alias(day))
    target = read_table(spark, path, schema)
    below = None
    while True:
        listed = files if below is None else files.where(F.col(day) < F.lit(below))
        below = listed.agg(F.max(day)).first()[0]
        if below is None:
            return None
        newest = target.where(F.col(day) == F.lit(below)).agg(F.max("observed_at")).first()[0]
        if newest is not None:
            return newest


def since_lookback(
    staged: DataFrame, newest: datetime | None, hours: int = LOOKBACK_HOURS, day: str = "observed_date"
) -> DataFrame:
    """Rows newer than ``newest`` less the lookback; all if nothing is stored.

    If ``staged`` still carries the ``day`` of a partitioned table, older folders are skipped.
    """
    if newest is None:
        return staged
    start = newest - timedelta(hours=hours)
    recent = staged.where(F.col("observed_at") > F.lit(start.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"))
    return recent.where(F.col(day) >= F.lit(start.date())) if day in staged.columns else recent


def upsert(
    rows: DataFrame,
    path: str,
    key: str,
    *,
    day: str = "observed_date",
    moment: str = "observed_at",
    key_fixes_day: bool = False,
) -> None:
    """Replace rows with a known ``key``, add the others. ``rows`` has one row per key.

    The table is partitioned by day and only days that hold new or replaced rows are
    rewritten. With ``key_fixes_day`` a dated row is looked for in its own day and among the
    rows without a day; a row without a day is looked for everywhere. The result is written
    to the shared folder first, as a rewrite must not read what it overwrites; both scratch
    tables are deleted when the table is whole.
    """
    with temporary_table(_with_day(rows, day, moment), "upsert-rows") as fresh:
        upsert_written(fresh, path, key, day=day, key_fixes_day=key_fixes_day)


def upsert_written(fresh: DataFrame, path: str, key: str, *, day: str = "observed_date", key_fixes_day: bool = False) -> None:
    """``upsert`` of rows that are a written table and carry their ``day``."""
    # Read in the new column set: added columns are null in old rows, removed ones dropped.
    target = table_or_none(fresh.sparkSession, path, fresh.schema)
    if target is None:
        fresh.hint("rebalance", day).write.partitionBy(day).parquet(path)
        return
    wandering = fresh.where(F.col(day).isNull()) if key_fixes_day else fresh
    touched = fresh.select(day)
    if not wandering.isEmpty():
        # A replaced row may sit in another day than its successor.
        touched = touched.union(target.select(key, day).join(wandering.select(key), key, "left_semi").select(day))
    if key_fixes_day:
        undated = target.where(F.col(day).isNull()).select(key, day)
        touched = touched.union(undated.join(fresh.select(key), key, "left_semi").select(day))
    with temporary_table(touched.distinct(), "upsert-days") as days:
        kept = only_days(target, days, day).join(fresh.select(key), key, "left_anti")
        rewrite_days(kept.unionByName(fresh), path, day, days)


def rewrite_days(rows: DataFrame, path: str, day: str, days: DataFrame) -> None:
    """Let the folders ``days`` of the table at ``path`` hold ``rows``, which may be read from it.

    The rows are written to the shared folder first, as a rewrite must not read what it
    overwrites. A day without rows is emptied.
    """
    with temporary_table(rows, "rewritten-days") as result:
        overwrite_days(result, path, day, days)


def overwrite_days(rows: DataFrame, path: str, day: str, days: DataFrame) -> None:
    """``rewrite_days`` for rows that are not read from the table at ``path``."""
    (
        rows.hint("rebalance", day)
        .write.partitionBy(day)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    _clear_emptied_days(days, rows, path, day)


def _clear_emptied_days(touched: DataFrame, result: DataFrame, path: str, day: str) -> None:
    """A day whose rows all moved away gets no new files, so it is emptied explicitly."""
    filled = result.select(F.col(day).alias("_filled")).distinct()
    emptied = touched.join(filled, F.col(day).eqNullSafe(F.col("_filled")), "left_anti").collect()
    for row in emptied:
        folder = NULL_FOLDER if row[0] is None else row[0]
        result.limit(0).drop(day).write.mode("overwrite").parquet(f"{path}/{day}={folder}")
