"""From collected payloads to landed runs: normalise, book, fingerprint, land."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.functions import read_utc
from shelflog.operators import normalize
from shelflog.operators.runs import build_manifests
from shelflog.session import lean_disk, materialize, temporary_table
from shelflog.sources import landing

TAKEN_IN = ["source", "run_id", "retailer_product_id", "observed_at", "raw_response", "extracted_at"]


def run_frames(
    payloads: DataFrame, catalog: DataFrame, runs: DataFrame, written: Callable[[DataFrame, str], DataFrame] = materialize
) -> dict[str, DataFrame]:
    """What the landing zone gets for ``runs``: payloads, events, rejects and manifests.

    ``payloads``: source, run_id, retailer_product_id, observed_at (text), raw_response
    (VARIANT), extracted_at. ``runs``: run_id, source, observed_at, started_at, completed_at.
    Payloads are landed in the order they arrive in, as the last one of a product counts. For
    all else, where order means nothing, they are dealt evenly to the tasks, as a written table,
    and read by their layout once; the outcome is a written table from which the other three
    frames are taken. The manifests are written too, as checks and landing look at them often.
    ``written`` writes these tables, under a label, and gives them back.
    """
    dealt = written(payloads.select(*TAKEN_IN).hint("rebalance"), "payloads")
    examined = written(normalize.examine(dealt, catalog), "examined")
    moment = read_utc(F.col("observed_at"))
    responses, digested = (landing.with_levels(rows, moment, "run_id") for rows in (payloads, dealt))
    events = landing.with_levels(normalize.accepted(examined), F.col("observed_at"), "ingestion_run_id")
    rejects = landing.with_levels(normalize.rejected(examined), F.col("occurred_at"), "ingestion_run_id")
    books = landing.with_levels(build_manifests(runs, examined), F.col("observed_at"), "run_id")
    return {
        "payloads": responses,
        "events": events,
        "rejects": rejects,
        "manifests": written(landing.with_content_hashes(books, digested, events), "manifests"),
    }


def ingest(
    spark: SparkSession, root: str, payloads: DataFrame, catalog: DataFrame, runs: DataFrame, compression: str | None = None
) -> None:
    """Land ``runs`` as a whole under ``root``; a run that is there already is refused.

    ``compression`` is that of the landed files. Tables written on the way are deleted.
    """
    with ExitStack() as scratch:
        scratch.enter_context(lean_disk(spark))
        frames = run_frames(payloads, catalog, runs, lambda df, label: scratch.enter_context(temporary_table(df, label)))
        landing.write_runs(root, **frames, compression=compression)
