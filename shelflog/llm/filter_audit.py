"""How the filters of a cascade interact, over all orders in which they could be applied."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelflog.llm.common import column, slices
from shelflog.session import materialize

FILTERS = "ABCDE"
_REPEATED = 1 << FILTERS.index("E")
_BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_LATER_BYTES = bytes(range(128, 192))  # a code point's bytes after its first
_PROFILE = "doc_id bigint, part string, mask int, digest binary"


def count_words(text: bytes, block: int = _BLOCK) -> tuple[int, int]:
    """Words of ``text`` and different ones. A long text is split block by block."""
    n, seen, at = 0, set(), 0
    while at < len(text):
        cut = _SPACE.search(text, at + block)
        end = cut.start() if cut else len(text)
        found = text[at:end].split()
        n += len(found)
        seen.update(found)
        at = end
    return n, len(seen)


def failing(text: bytes) -> int:
    """Bits of the filters A to D that ``text`` fails."""
    n, different = count_words(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _LATER_BYTES))
    signs = len(text) != len(text.translate(None, _SIGNS))
    return (n < 200) | (100 * different < 50 * n) << 1 | (100 * capitals > 3 * points) << 2 | signs << 3


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 2):
            texts = [t or b"" for t in part.column(2).cast(pa.binary()).to_pylist()]
            masks = pa.array([failing(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), masks, digests], ["doc_id", "part", "mask", "digest"])


def orders(filters: str = FILTERS) -> list[str]:
    """All orders; the place in this list is an order's Lehmer rank."""
    return ["".join(p) for p in permutations(filters)]


def removal_intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first, end): the ranks at which a document that fails ``mask`` goes at ``step``.

    The orders that begin alike are consecutive: the Lehmer digits of the common beginning
    give the first rank, the number of orders of the rest gives the length. A document goes
    at the first filter of its mask, so each beginning whose last filter alone is in the mask
    is one interval; touching intervals of a step are joined.
    """
    k = len(filters)
    found: list[tuple[int, int, int, int]] = []

    def walk(mask: int, unused: list[int], step: int, rank: int) -> None:
        width = factorial(k - step)
        for digit, f in enumerate(unused):
            first = rank + digit * width
            if mask >> f & 1:
                if found and found[-1][:2] == (mask, step) and found[-1][3] == first:
                    first = found.pop()[2]
                found.append((mask, step, first, rank + (digit + 1) * width))
            else:
                walk(mask, unused[:digit] + unused[digit + 1 :], step + 1, first)

    for mask in range(1, 1 << k):
        walk(mask, list(range(k)), 1, 0)
    return found


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Rows per part and set of failing filters: part, mask, n, good, toxic."""
    rows = docs.select(
        column(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(column(part_col).cast("string"), F.lit("")).alias("part"),
        column(text_col).alias("text"),
    )
    profiles = materialize(rows.mapInArrow(_profile, _PROFILE), "profiles")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = profiles.join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    group = ["digest", "part", "mask", "good", "toxic"]
    # Rows of one id first, so that the rows at a group's least id can be told from the rest.
    by_id = marked.groupBy("doc_id", *group).agg(F.count("*").alias("rows"))
    by_group = by_id.groupBy(*group).agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("doc_id").isNotNull(), F.col("rows")).otherwise(0)).alias("with_id"),
        F.min("doc_id").alias("first_id"),
        F.min_by("rows", "doc_id").alias("at_first"),
    )
    least = F.min("first_id").over(Window.partitionBy("digest"))
    first_rows = F.when(F.col("first_id") == least, F.col("at_first")).otherwise(0)
    split = by_group.withColumn("repeats", F.coalesce(F.col("with_id") - first_rows, F.lit(0)))
    either = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), (F.col("rows") - F.col("repeats")).alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(_REPEATED)).alias("mask"), F.col("repeats").alias("n")),
        )
    )
    counted = split.select("part", "good", "toxic", either.alias("c")).where("c.n > 0")
    return counted.groupBy("part", "c.mask").agg(
        F.sum("c.n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("c.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("c.n")).otherwise(0)).alias("toxic"),
    )


def audit_orders(spark: SparkSession, counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``counts`` (part, mask, n, good, toxic).

    Each mask adds its counts to a difference array at the two ends of its removal
    intervals; the running sum over the ranks is what each step removes in each order. All
    tables here have a fixed number of rows per part.
    """
    counts = materialize(counts, "mask-counts")
    k, names = len(filters), orders(filters)
    intervals = spark.createDataFrame(removal_intervals(filters), "mask int, step int, first int, end int")
    measures = ["n", "good", "toxic"]
    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign"))))
    differences = (
        counts.join(F.broadcast(intervals), "mask")
        .select("part", "step", *measures, ends.alias("e"))
        .groupBy("part", "step", "e.rank")
        .agg(*[F.sum(F.col(m) * F.col("e.sign")).alias(m) for m in measures])
    )
    order_rows = spark.createDataFrame(list(enumerate(names)), "rank int, filter_order string")
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"))
    spine = (
        parts.join(F.broadcast(order_rows))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    )
    along = Window.partitionBy("part", "step").orderBy("rank")
    dense = spine.join(differences, ["part", "step", "rank"], "left").na.fill(0, measures)
    removed = dense.select("part", "total", "filter_order", "step", "filter", *[F.sum(m).over(along).alias(m) for m in measures])

    letters = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(1 << i).alias("bit")) for i, f in enumerate(filters)]))
    per_filter = (
        counts.select("part", "mask", "n", letters.alias("l"))
        .groupBy("part", "l.filter")
        .agg(
            F.sum(F.when(F.col("mask").bitwiseAND(F.col("l.bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.col("mask") == F.col("l.bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
        )
    )
    so_far = F.sum("n").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    every_order = F.sum("n").over(Window.partitionBy("part", "filter"))
    return removed.join(per_filter, ["part", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - so_far).alias("kept"),
        F.col("n").alias("removed"),
        (F.col("failing") - F.col("n")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        every_order.alias("shapley"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """What each of five filters removes at each step of all 120 orders, per part.

    A text fails A with under 200 words, B with under half of its words different, C with
    over 3 % capital letters A-Z, D if it holds one of ``#$%&*|``, E if a row with a smaller
    doc_id has the identical text. Columns: part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley.

    Every text is read once; what moves afterwards is its digest, mask and marks, counted
    per group of identical texts before any shuffle by text, so a large group of copies is a
    few rows. The orders are never played through: ``audit_orders`` works on counts.

    Cases: a null text is empty (fails A only, and E after another empty one). A null part
    is the part ''. A row with a null doc_id never fails E and makes no other row fail it;
    nor do rows that agree in text and doc_id make each other fail. A document with several
    label rows is good or toxic if one of them says so; labels without doc_id and labels of
    unknown documents count for nothing. An empty table gives no rows. Other columns are not
    read.
    """
    return audit_orders(docs.sparkSession, mask_counts(docs, labels, id_col, text_col, part_col))
