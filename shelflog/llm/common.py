"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


SLICE_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores added until no column of ``taken`` has it."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, so that no other name can clash."""
    return docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))


def append_column(
    docs: DataFrame,
    text_col: str,
    name: str,
    kind: T.DataType,
    make: Callable[[], Callable[[list], list]],
) -> DataFrame:
    """All columns of ``docs`` and one more, computed from whole texts inside each task.

    ``make`` runs once per task and returns a function from a list of UTF-8 texts (bytes,
    None for null) to the list of values. Rows are taken a few at a time, so the memory of
    a task follows the longest texts and not the size of an Arrow batch.
    """
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, at):
                texts = part.column(at).cast(pa.binary()).to_pylist()
                new = pa.array(work(texts), type=arrow_kind)
                yield pa.RecordBatch.from_arrays([*part.columns, new], [*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def per_worker(key: tuple, make: Callable):
    """The object made for ``key`` in this Python worker; workers outlive their tasks.

    For caches only: whether an object is new or used must not change a result.
    """
    held = sys.modules.setdefault("_shelflog_worker", types.ModuleType("_shelflog_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def slices(batch: pa.RecordBatch, at: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes in column ``at``, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(at).cast(pa.binary())), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
