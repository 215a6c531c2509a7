"""Removal of repeated word spans by suffix automata of reference shards."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflog.llm.automaton import SuffixAutomaton
from shelflog.llm.repeats import (
    Units,
    cut_chunks,
    documents,
    find_candidates,
    partial_run,
    remove_spans,
    whole_run,
)

WINDOW = 20


def remove_later_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_units (words), spans (in words), kept.

    Words are runs of anything but space and the bytes 9 to 13. A word goes if it is covered
    by a window of ``window`` words whose sequence also starts earlier: in a smaller doc_id or
    before in the same document. ``kept`` are the remaining words joined by one space.

    Each key (see ``repeats``) is a shard of the reference: the earliest run of each of its
    different chunks. A task streams the chunks of a shard in the order of the input past a
    suffix automaton of those before, whose matching statistics give the repeated windows,
    and then adds the chunk. Shards meet their chunks by their key: sending every automaton
    to every document would cost shards times documents, which grows with the square.

    Cases: a null text has no words; a text under ``window`` words loses nothing. A null
    doc_id comes before all others. Of rows that share a doc_id one text comes first, by a
    hash; rows equal in doc_id and text count as one document and keep the same words. An
    empty table gives no rows. Other columns are not read.
    """
    units = Units(words=True, window=window)
    rows = documents(docs, id_col, text_col)
    found = find_candidates(rows, units)
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["doc_id", "uid", "lo"]

    def send(chunks: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        names = ["key", "chunk", *place, "words"]
        held: list[dict] = []
        for chunk in chunks:
            held.append(chunk | {"words": b" ".join(chunk["units"])})
            if len(held) == 5000:
                yield _batch(held, names)
                held = []
        if held:
            yield _batch(held, names)

    schema = "key long, chunk long, doc_id long, uid long, lo int, words binary"
    chunks = cut_chunks(rows, found.mixed, units, send, schema)
    shards = chunks.repartition(n_parts, "key").sortWithinPartitions("key", *place)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automaton = None, SuffixAutomaton()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["key"] != key:
                    key, automaton = row["key"], SuffixAutomaton()
                sequence = row["words"].split(b" ")
                starts = [end - window + 1 for end, size in enumerate(automaton.matches(sequence)) if size >= window]
                if starts:
                    out.append({"key": key, "chunk": row["chunk"], "head": starts[0], "tail": starts[-1]})
                automaton.add(sequence)
            if out:
                yield pa.RecordBatch.from_pylist(out, _RESOLVED)

    resolved = shards.mapInArrow(stream, "key long, chunk long, head int, tail int")
    firsts = found.classes.select("key", "chunk", *[F.col(f"first.{c}").alias(f"first_{c}") for c in place])
    is_first = F.lit(True)
    for c in place:
        is_first = is_first & F.col(c).eqNullSafe(F.col(f"first_{c}"))
    whole = found.runs.join(firsts, ["key", "chunk"]).where(~is_first).select("uid", F.col("lo").alias("start"), whole_run(units).alias("end"))
    partial = found.mixed.join(resolved, ["key", "chunk"]).select(*partial_run(units))
    return remove_spans(rows, whole.unionByName(partial), units)


_RESOLVED = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("head", pa.int32()), ("tail", pa.int32())])


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"lo": pa.int32(), "words": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names)


def digest(removed: DataFrame) -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        "doc_id", F.col("n_units").alias("n_words"), gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )
