"""Rounds of local training with averaged parameters."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Parameters = dict[str, np.ndarray]


def averaged_rounds(
    rows: DataFrame, start: Parameters, local: Callable[[Parameters, pd.DataFrame, int], Parameters], rounds: int
) -> Parameters:
    """Train on every ``shard`` of ``rows`` in parallel and average the results, ``rounds`` times.

    ``rows`` is a written table of a bounded sample; the driver sees one set of parameters
    per shard, whose size does not depend on the data.
    """
    now = start
    for number in range(rounds):
        found = rows.groupBy("shard").applyInPandas(_task(local, now, number), "rows long, parameters binary").collect()
        if not found:
            return now
        total = sum(r.rows for r in found)
        parts = [(r.rows / total, pickle.loads(r.parameters)) for r in sorted(found, key=lambda r: bytes(r.parameters))]
        now = {k: sum(w * p[k] for w, p in parts) for k in now}
    return now


def _task(local, now: Parameters, number: int):
    held = pickle.dumps(now)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        done = local(pickle.loads(held), pdf, number)
        return pd.DataFrame({"rows": [len(pdf)], "parameters": [pickle.dumps(done)]})

    return train


def remainder(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(folds))
