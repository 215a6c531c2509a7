"""Removal of repeated byte strings by a distributed merge sort of suffixes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflog.llm.hashing import mix, symbols
from shelflog.llm.repeats import (
    Units,
    cut_chunks,
    documents,
    find_candidates,
    partial_run,
    remove_spans,
    whole_run,
)
from shelflog.llm.suffixes import Run, merge

WINDOW = 400
RUN_BYTES = 32 << 20  # suffixes sorted at once in a task
GROUP_ROWS = 20_000  # suffixes resolved at once


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_units (bytes), spans, kept.

    A byte goes if it is covered by a string of ``window`` bytes that also starts anywhere
    else, in this or another document; strings are judged on the input. ``spans`` are the
    maximal removed runs, ``kept`` the remaining bytes.

    Suffixes start at anchors (see ``repeats``). Where copies alone don't decide, each
    different chunk sends the suffix from its anchor: a task sorts its suffixes, front-codes
    them for each target and the targets merge the runs with a loser tree that never looks at
    a known prefix again. In the merged order the shared prefixes say how far two chunks agree
    to the right of the anchor; the bytes left of it are compared inside those stretches.

    Cases: a null text is empty; a text shorter than ``window`` loses nothing; rows equal in
    doc_id and text are repeats of each other; a null doc_id is a value like any other. An
    empty table gives no rows. Other columns are not read.
    """
    units = Units(words=False, window=window)
    rows = documents(docs, id_col, text_col)
    found = find_candidates(rows, units)
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(chunks: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        size = 0
        for chunk in chunks:
            part = int(mix(np.array([chunk["key"]], np.int64).view(np.uint64))[0] % np.uint64(n_parts))
            held.setdefault(part, []).append(chunk)
            size += len(chunk["units"]) + 200
            if size > RUN_BYTES:
                yield from _front_coded(held)
                held, size = {}, 0
        yield from _front_coded(held)

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_EMPTY, *_resolved([pickle.loads(b) for b in pdf["run"]], units)])

    runs = cut_chunks(rows, found.mixed, units, send, "part long, run binary")
    resolved = runs.groupBy("part").applyInPandas(resolve, "key long, chunk long, head int, tail int")
    copies = found.classes.where("n > 1").select("key", "chunk")
    whole = found.runs.join(copies, ["key", "chunk"], "left_semi").select(
        "uid", F.col("lo").alias("start"), whole_run(units).alias("end")
    )
    single = found.mixed.where("n = 1").join(resolved, ["key", "chunk"]).select(*partial_run(units))
    return remove_spans(rows, whole.unionByName(single), units)


_EMPTY = pd.DataFrame(
    {"key": np.zeros(0, np.int64), "chunk": np.zeros(0, np.int64), "head": np.zeros(0, np.int32), "tail": np.zeros(0, np.int32)}
)


def _front_coded(held: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
    """One run for each target: its suffixes sorted and front-coded, with what belongs to them."""
    for part, chunks in held.items():
        run, order = Run.of([c["units"][c["off"] :] for c in chunks])
        chunks = [chunks[i] for i in order]
        fields = {k: np.array([c[k] for c in chunks], np.int64) for k in ("key", "chunk", "n", "size", "off")}
        left = b"".join(c["units"][: c["off"]] for c in chunks)
        plain = (run.shared, run.ends, run.rests, run.payload)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "run": [pickle.dumps((plain, fields, left))]})


def _resolved(parts: list[tuple], units: Units) -> Iterator[pd.DataFrame]:
    """Repeated windows of the merged suffixes, a bounded number of groups at a time."""
    parts.sort(key=lambda p: (p[1]["key"].tolist(), p[1]["chunk"].tolist()))
    base, runs = 0, []
    for plain, fields, _ in parts:
        run = Run(*plain)
        run.payload = run.payload + base
        base += len(fields["key"])
        runs.append(run)
    if not runs:
        return
    fields = {k: np.concatenate([p[1][k] for p in parts]) for k in parts[0][1]}
    left = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    left_end = np.cumsum(fields["off"])
    order: list[int] = []
    shared: list[int] = []
    for place, same in merge(runs):
        if same < units.key_size and len(order) >= GROUP_ROWS:
            yield _windows(np.array(order), np.array(shared), fields, left, left_end, units.window)
            order, shared = [], []
        order.append(place)
        shared.append(same)
    if order:
        yield _windows(np.array(order), np.array(shared), fields, left, left_end, units.window)


def _windows(
    order: np.ndarray, shared: np.ndarray, fields: dict, left: np.ndarray, left_end: np.ndarray, window: int
) -> pd.DataFrame:
    """First and last repeated window of each single chunk, of suffixes in merged order.

    A window begins x bytes left of the anchor. Two chunks share it if they lie in one stretch
    of neighbours sharing ``window - x`` bytes and agree in the x bytes before the anchor.
    """
    off, size = fields["off"][order], fields["size"][order]
    least_x, most_x = off - size, off
    end = left_end[order]
    symbol = symbols(1)
    low = np.full(len(order), np.iinfo(np.int64).max)
    high = np.full(len(order), -1)
    before = np.zeros(len(order), np.uint64)
    for x in range(int(most_x.max(initial=0)) + 1):
        if x:
            at = np.where(x <= most_x, end - x, 0)
            seen = left[at] if len(left) else np.zeros(len(at), np.uint8)
            before = mix(before * np.uint64(0x9E3779B97F4A7C15) + symbol[seen])
        active = np.flatnonzero((least_x <= x) & (x <= most_x))
        if len(active) < 2:
            continue
        stretch = np.cumsum(shared < window - x)[active]
        ranked = np.lexsort((before[active], stretch))
        s, b = stretch[ranked], before[active][ranked]
        same = (s[1:] == s[:-1]) & (b[1:] == b[:-1])
        hit = np.zeros(len(active), bool)
        hit[1:] |= same
        hit[:-1] |= same
        twice = active[ranked[hit]]
        low[twice] = np.minimum(low[twice], x)
        high[twice] = x
    told = np.flatnonzero((fields["n"][order] == 1) & (high >= 0))
    return pd.DataFrame(
        {
            "key": fields["key"][order][told],
            "chunk": fields["chunk"][order][told],
            "head": (off - high)[told].astype(np.int32),
            "tail": (off - low)[told].astype(np.int32),
        }
    )


def digest(removed: DataFrame) -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        "doc_id",
        F.col("n_units").alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
