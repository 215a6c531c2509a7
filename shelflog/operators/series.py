"""Neighbour lookup in time series that survives a hot series.

A plain LAG window puts a whole series into one task. Series that hold a large share of
the rows are therefore cut into time slices; each slice is its own window group, and the
last row of the preceding slice travels along as a carried row, which is dropped after
the window. Results are those of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflog.session import materialize

# What one task may hold of a series, whatever the size of the input.
HOT_ROWS = 2_000_000
# Up to so many hot series are sent to all tasks; more are joined by the engine's choice.
BROADCAST_SERIES = 50_000
# A series has one observation per microsecond at most (the id is derived from the time),
# and a slice of one minute keeps the number of slices small too: half a million a year.
SLICE_SECONDS = 60


def hot_series(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of the series with more than ``hot_rows`` rows, written once."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return materialize(sizes.where(F.col("_rows") > hot_rows).select(*keys), "hot-series")


def _slice_number(time: str, tie: str, slice_seconds: int) -> Column:
    """Slices in the order of the rows. Rows without a time sort last; they are spread by the
    first three characters of ``tie``, which is their order."""
    code = F.lit(2**62)
    for place, weight in enumerate((2**42, 2**21, 1), start=1):
        code = code + F.coalesce(F.ascii(F.substring(F.col(tie), place, 1)), F.lit(0)).cast("long") * weight
    return F.coalesce(F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / slice_seconds), code)


def _tag_slices(
    df: DataFrame, keys: list[str], time: str, tie: str, hot: DataFrame, slice_seconds: int
) -> DataFrame:
    small = hot.count() <= BROADCAST_SERIES
    hot = hot.select(*[F.col(key).alias(f"_hot_{key}") for key in keys], F.lit(True).alias("_hot"))
    same_series = None
    for key in keys:
        equal = F.col(key).eqNullSafe(F.col(f"_hot_{key}"))
        same_series = equal if same_series is None else same_series & equal
    return (
        df.join(F.broadcast(hot) if small else hot, same_series, "left")
        .withColumn("_slice", F.when(F.col("_hot"), _slice_number(time, tie, slice_seconds)))
        .drop(*[f"_hot_{key}" for key in keys])
    )


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    time: str,
    tie: str,
    carry: dict[str, str],
    *,
    following: bool = False,
    hot_rows: int = HOT_ROWS,
    slice_seconds: int = SLICE_SECONDS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add columns of the preceding (or ``following``) row of the same series.

    ``carry`` maps a new column to the column it copies. Order: ``time`` with nulls
    last, then ``tie`` (text). ``hot`` hands over ``hot_series`` of the same rows or of rows
    that include them.
    """
    hot = hot_series(df, keys, hot_rows) if hot is None else hot
    tagged = _tag_slices(df, keys, time, tie, hot, slice_seconds)
    if following:
        order = [F.col(time).desc_nulls_first(), F.col(tie).desc()]
        slice_order, pick = F.col("_slice").desc(), F.min_by
    else:
        order = [F.col(time).asc_nulls_last(), F.col(tie).asc()]
        slice_order, pick = F.col("_slice").asc(), F.max_by

    kept = list(dict.fromkeys([time, tie, *carry.values()]))
    edges = (
        tagged.where("_hot")
        .groupBy(*keys, "_slice")
        .agg(pick(F.struct(*kept), F.struct(time, tie)).alias("_edge"))
    )
    carried = (
        edges.withColumn("_next", F.lead("_slice").over(Window.partitionBy(*keys).orderBy(slice_order)))
        .where("_next is not null")
        .select(*keys, F.col("_next").alias("_slice"), "_edge.*", F.lit(True).alias("_carried"))
    )
    series = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = (
        tagged.drop("_hot")
        .withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
    )
    neighbours: dict[str, Column] = {
        name: F.lag(column).over(series) for name, column in carry.items()
    }
    return rows.withColumns(neighbours).where(~F.col("_carried")).drop("_carried", "_slice")
