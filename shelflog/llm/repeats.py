"""Repeated windows of texts: what the byte and the word operator have in common.

A window is a fixed number of units (bytes or words). Each window has an anchor, the least
hashed gram near its start, which depends on the window's content alone; successive windows
with one anchor are a run. Equal windows have their anchors at the same place and so agree in
the ``key``, the hash of what follows the anchor in every window of a run. Only runs whose key
occurs again are looked at any further. Runs with the same whole content (``chunk``) are
decided by counting; where one key has different chunks, one run of each is taken to the
operator's own method, which finds the first and the last window of it that is repeated.

Every step that brings rows of a key together is a grouped aggregate, which combines before
it shuffles, or a join that the engine can split, up to the method itself: it gets one row
for each different chunk, never one for each copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.llm.bloom import known_keys, probe
from shelflog.llm.common import id_and_text, slices
from shelflog.llm.hashing import Powers, Spans, anchors, mix, symbols, word_hashes
from shelflog.session import materialize

SLICE_BYTES = 1 << 20

RUNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("uid", T.LongType()),
        T.StructField("lo", T.IntegerType()),  # first window of the run, in units
        T.StructField("size", T.IntegerType()),  # windows after the first
        T.StructField("off", T.IntegerType()),  # the anchor's distance from the first window
        T.StructField("key", T.LongType()),
        T.StructField("chunk", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Units:
    words: bool
    window: int

    @property
    def width(self) -> int:
        """Grams to choose the anchor from."""
        return max(1, self.window * 3 // 5 if self.words else self.window // 2)

    @property
    def key_size(self) -> int:
        return self.window - self.width + 1

    @property
    def gram(self) -> int:
        return min(3 if self.words else 16, self.key_size)


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text as bytes, and uid, the same for rows that agree in both."""
    rows = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("uid"), F.col("text").cast("binary").alias("text"))


def _units(texts: list[bytes], units: Units, powers: Powers, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all units of the texts, and units per text."""
    if not units.words:
        return symbol[np.frombuffer(b"".join(texts), np.uint8)], np.array([len(t) for t in texts])
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    letter = (raw != 32) & ((raw < 9) | (raw > 13))
    start, _, ids = word_hashes(raw, letter, powers, symbol)
    edges = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(start, edges), prepend=0)
    return ids, counts


def _runs(texts: list[bytes], units: Units, powers: Powers, symbol: np.ndarray):
    """Text number, lo, size, off, key, chunk of every run of the texts."""
    ids, counts = _units(texts, units, powers, symbol)
    window, gram = units.window, units.gram
    n = len(ids)
    if n < window:
        return None
    spans = Spans(ids, powers)
    at = np.arange(n - gram + 1)
    chosen = anchors(spans.hash(at, at + gram), units.width)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(texts)), counts)
    start = np.flatnonzero(np.arange(n) + window <= ends[doc])
    if not len(start):
        return None
    anchor, owner = chosen[start], doc[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    lo = start[first]
    hi = start[np.append(first[1:], len(start)) - 1]
    anchor, owner = anchor[first], owner[first]
    key = spans.hash(anchor, anchor + units.key_size)
    chunk = spans.hash(lo, hi + window)
    return owner, lo - (ends - counts)[owner], hi - lo, anchor - lo, key.view(np.int64), chunk.view(np.int64)


def find_runs(rows: DataFrame, units: Units) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, symbol = Powers(), symbols()
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                found = _runs(part.column(2).to_pylist(), units, powers, symbol)
                if found is None:
                    continue
                owner, lo, size, off, key, chunk = found
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(take),
                        part.column(1).take(take),
                        *(pa.array(x.astype(np.int32)) for x in (lo, size, off)),
                        pa.array(key),
                        pa.array(chunk),
                    ],
                    names=RUNS.fieldNames(),
                )

    return rows.mapInArrow(run, RUNS)


@dataclass(frozen=True)
class Candidates:
    """runs: those whose key occurs again. classes: their chunks, with the first run of each
    and their number. mixed: classes whose key has other classes too."""

    runs: DataFrame
    classes: DataFrame
    mixed: DataFrame


def find_candidates(rows: DataFrame, units: Units) -> Candidates:
    runs = materialize(find_runs(rows, units), "runs")
    again = runs.groupBy("key").count().where("count > 1").select("key")
    runs = materialize(runs.join(again, "key", "left_semi"), "repeated-runs")
    classes = materialize(
        runs.groupBy("key", "chunk").agg(
            F.count("*").alias("n"),
            F.min(F.struct("doc_id", "uid", "lo")).alias("first"),
            F.min("size").alias("size"),
            F.min("off").alias("off"),
        ),
        "run-classes",
    )
    several = classes.groupBy("key").count().where("count > 1").select("key")
    return Candidates(runs, classes, materialize(classes.join(several, "key", "left_semi"), "mixed-classes"))


def cut_chunks(
    rows: DataFrame, mixed: DataFrame, units: Units, work: Callable[[Iterator[dict]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``work`` over the chunks of ``mixed``: dicts of key, chunk, n, doc_id, uid, lo, size, off, units.

    Only documents that may hold the first run of a class are shuffled, once each.
    """
    wanted = materialize(
        mixed.groupBy(F.col("first.uid").alias("uid")).agg(F.collect_list(F.struct("key", "chunk", "n", F.col("first.lo").alias("lo"), "size", "off")).alias("runs")),
        "wanted-runs",
    )
    pages, n_bits = known_keys(wanted.select("uid"), "uid", "wanted-filter")
    some = probe(rows, pages, "uid", n_bits, "hit").where("hit").select("uid", "doc_id", "text").dropDuplicates(["uid"])
    joined = some.join(wanted, "uid").select("uid", "doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 2):
                for row in part.to_pylist():
                    whole = row["text"].split() if units.words else row["text"]
                    for found in row["runs"]:
                        cut_out = whole[found["lo"] : found["lo"] + found["size"] + units.window]
                        yield found | {"uid": row["uid"], "doc_id": row["doc_id"], "units": cut_out}

    return joined.mapInArrow(lambda batches: work(cut(batches)), schema)


def remove_spans(rows: DataFrame, spans: DataFrame, units: Units) -> DataFrame:
    """doc_id, n_units, spans (merged) and kept (bytes) of every row; ``spans`` has uid, start, end.

    Documents without a span are never shuffled.
    """
    lists = materialize(spans.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("found")), "spans")
    pages, n_bits = known_keys(lists.select("uid"), "uid", "span-filter")
    probed = probe(rows, pages, "uid", n_bits, "hit")
    none = F.lit(None).cast("array<struct<start:int,end:int>>")
    plain = probed.where("not hit").select("doc_id", "text", none.alias("found"))
    joined = probed.where("hit").join(lists, "uid", "left").select("doc_id", "text", "found")
    out = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_units", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            for part in slices(batch, 1):
                done = [_removed(t, found, units) for t, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                arrays = [part.column(0), *(pa.array(x, schema.field(i + 1).type) for i, x in enumerate(zip(*done)))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return plain.unionByName(joined).mapInArrow(run, out)


def _removed(text: bytes, found: list[dict] | None, units: Units) -> tuple[int, list[dict], bytes]:
    whole = text.split() if units.words else text
    spans: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in found or []):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    parts, at = [], 0
    for start, end in [*spans, (len(whole), len(whole))]:
        parts.append(whole[at:start])
        at = end
    kept = b" ".join(w for part in parts for w in part) if units.words else b"".join(parts)
    return len(whole), [{"start": a, "end": b} for a, b in spans], kept


def whole_run(units: Units) -> Column:
    return (F.col("lo") + F.col("size") + units.window).cast("int")


def partial_run(units: Units) -> list[Column]:
    """Span of the windows from ``head`` to ``tail`` of the first run of a class."""
    return [
        F.col("first.uid").alias("uid"),
        (F.col("first.lo") + F.col("head")).cast("int").alias("start"),
        (F.col("first.lo") + F.col("tail") + units.window).cast("int").alias("end"),
    ]


def spread(key: np.ndarray) -> np.ndarray:
    return mix(key.view(np.uint64))
