import glob
import itertools
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelflog.operators.merge import only_days, newest_moment, read_table, upsert
from shelflog.operators.staging import stage_events
from shelflog.plans import load
from shelflog.schemas import INVENTORY_EVENTS
from shelflog.session import scratch_root
from shelflog.streaming.ingest import first_copies, landed_events_stream, stream_observations
from shelflog.sources import landing
from test_landing import sample_runs

NOW = datetime(2024, 3, 1)


def raw(spark, rows):
    """rows: (event_id, observed_at, loaded_at, price)."""
    base = spark.createDataFrame(
        rows, "event_id string, observed_at timestamp_ntz, loaded_at timestamp_ntz, amount int"
    ).withColumns(
        {
            "price": F.col("amount").cast("decimal(12,2)"),
            "source": F.lit("target"),
            "retailer_product_id": F.lit("p"),
            "inventory_status": F.lit("in_stock"),
            "extracted_at": F.col("observed_at"),
            "ingestion_run_id": F.lit("r"),
        }
    )
    return base.select(
        *[
            F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in INVENTORY_EVENTS
        ]
    )


def day(n, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=n, hours=hour)


def test_insert_only_keeps_what_is_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    assert load.merge_events(raw(spark, [("a", day(0), NOW, 1)]), path, NOW) == 1
    batch = raw(spark, [("a", day(0), NOW, 9), ("b", day(1), NOW, 2), ("b", day(1), NOW, 2)])
    assert load.merge_events(batch, path, NOW) == 1
    assert load.merge_events(batch, path, NOW) == 0
    got = {r["event_id"]: float(r["price"]) for r in load.read_raw_events(spark, path).collect()}
    assert got == {"a": 1.0, "b": 2.0}


def test_faithful_mode_keeps_copies_of_one_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = raw(spark, [("b", day(1), NOW, 2), ("b", day(1), NOW, 3)])
    assert load.merge_events(batch, path, NOW, dedupe=False) == 2
    assert load.merge_events(batch, path, NOW, dedupe=False) == 0


def observed(spark, path):
    rows = spark.read.parquet(path).select("event_id", "price", "observed_at").collect()
    assert len({r["event_id"] for r in rows}) == len(rows)
    return {r["event_id"]: float(r["price"]) for r in rows}


def test_upsert_takes_the_newest_copy_within_the_lookback(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", day(0), day(1), 1), ("b", day(8), day(9), 2), ("c", day(10), day(11), 3)]
    load.refresh_observations(stage_events(raw(spark, first)), path)
    later = first + [
        ("c", day(10), day(12), 4),
        ("d", day(9), day(12), 5),
        ("b", day(8), day(12), 6),  # exactly 48 hours old: strictly newer rows only
        ("e", day(2), day(12), 7),  # too late
    ]
    staged = stage_events(raw(spark, later))
    load.refresh_observations(staged, path)
    assert observed(spark, path) == {"a": 1, "b": 2, "c": 4, "d": 5}
    assert load.skipped_late_rows(staged, path) == 1
    load.refresh_observations(staged, path)
    assert observed(spark, path) == {"a": 1, "b": 2, "c": 4, "d": 5}
    load.refresh_observations(staged, path, full=True)
    assert observed(spark, path) == {"a": 1, "b": 6, "c": 4, "d": 5, "e": 7}


def test_an_empty_table_is_filled(spark, tmp_path):
    path = str(tmp_path / "t")
    load.refresh_observations(stage_events(raw(spark, [])), path)
    load.refresh_observations(stage_events(raw(spark, [("a", day(0), NOW, 1)])), path)
    assert observed(spark, path) == {"a": 1}


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:4])
def test_batches_in_any_order_give_one_table(spark, tmp_path, order):
    rows = [(f"e{i}", day(0, i % 30), day(2, i % 3), i) for i in range(40)]
    path = str(tmp_path / "t")
    parts = [rows[i::3] for i in range(3)]
    for i in order:
        load.refresh_observations(stage_events(raw(spark, parts[i])), path, full=True)
    assert observed(spark, path) == {f"e{i}": i for i in range(40)}


def test_a_row_may_move_to_another_day(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "event_id string, observed_at timestamp_ntz, v int"
    upsert(spark.createDataFrame([("a", day(0), 1), ("b", day(3), 1)], schema), path, "event_id")
    upsert(spark.createDataFrame([("a", day(5), 2)], schema), path, "event_id")
    got = {(r["event_id"], r["observed_at"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", day(5), 2), ("b", day(3), 1)}


@pytest.mark.parametrize("key_fixes_day", [False, True])
def test_a_row_may_gain_or_lose_its_day(spark, tmp_path, key_fixes_day):
    path = str(tmp_path / "t")
    schema = "event_id string, observed_at timestamp_ntz, v int"

    def put(*rows):
        upsert(spark.createDataFrame(rows, schema), path, "event_id", key_fixes_day=key_fixes_day)
        stored = spark.read.schema(schema + ", observed_date date").parquet(path).collect()
        return sorted((r["event_id"], r["observed_at"], r["v"]) for r in stored)

    assert put(("a", None, 1), ("b", day(3), 1)) == [("a", None, 1), ("b", day(3), 1)]
    assert put(("a", day(5), 2)) == [("a", day(5), 2), ("b", day(3), 1)]
    assert put(("b", None, 3)) == [("a", day(5), 2), ("b", None, 3)]
    assert put(("b", None, 4), ("c", None, 1)) == [("a", day(5), 2), ("b", None, 4), ("c", None, 1)]


def scans(df):
    """Partition filters of the file scans in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().toString()
    return [line for line in plan.splitlines() if "PartitionFilters: [" in line and "PartitionFilters: []" not in line]


def test_a_refresh_reads_only_recent_days(spark, tmp_path):
    raw_path, path = str(tmp_path / "raw"), str(tmp_path / "t")
    rows = [(f"e{i}", day(i), day(i, 1), i) for i in range(30)]
    load.merge_events(raw(spark, rows[:25]), raw_path, NOW)
    load.refresh_from_raw(spark, raw_path, path)
    load.merge_events(raw(spark, rows), raw_path, NOW)
    recent = load.recent_staged(spark, raw_path, path)
    assert any("observed_date" in line and "2024-01-23" in line for line in scans(recent))
    assert {r["event_id"] for r in recent.collect()} == {f"e{i}" for i in range(23, 30)}
    days = spark.createDataFrame([(day(28).date(),), (day(29).date(),)], "observed_date date")
    target = read_table(spark, path, load.OBSERVATIONS)
    assert any("observed_date" in line and "2024-01-29" in line for line in scans(only_days(target, days, load.DAY)))
    load.refresh_from_raw(spark, raw_path, path)
    assert observed(spark, path) == {f"e{i}": i for i in range(30)}
    assert newest_moment(spark, path, load.OBSERVATIONS) == day(29)
    assert newest_moment(spark, str(tmp_path / "none"), load.OBSERVATIONS) is None


def test_late_copies_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    load.refresh_observations(stage_events(raw(spark, [("a", day(20), NOW, 1)])), path)
    late = [("b", day(1), NOW, 1), ("b", day(1), NOW, 2), ("c", day(2), NOW, 1)]
    assert load.skipped_late_rows(stage_events(raw(spark, late)), path) == 2


def test_scratch_tables_are_deleted(spark, tmp_path):
    path, scratch = str(tmp_path / "t"), os.path.join(scratch_root(spark), "shelflog")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    for n in (1, 2):
        upsert(spark.createDataFrame([("a", day(n), n)], "event_id string, observed_at timestamp_ntz, v int"), path, "event_id")
    assert set(os.listdir(scratch)) == before


def test_columns_follow_the_new_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame([("a", day(0), 1)], "event_id string, observed_at timestamp_ntz, old int"), path, "event_id")
    upsert(
        spark.createDataFrame([("b", day(0), "x")], "event_id string, observed_at timestamp_ntz, new string"),
        path, "event_id", key_fixes_day=True,
    )
    got = {r["event_id"]: r["new"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": None, "b": "x"}
    assert "old" not in spark.read.parquet(path).columns


def test_stream_is_drained_once(spark, tmp_path):
    root, table = str(tmp_path / "zone"), str(tmp_path / "t")
    landing.write_runs(root, **sample_runs(spark))

    def drain():
        stream_observations(
            landed_events_stream(spark, root, 1), table, str(tmp_path / "checkpoint")
        ).awaitTermination()

    drain()
    assert set(observed(spark, table)) == {"e0", "e1", "e2"}
    landing.write_runs(root, **sample_runs(spark, "r2", products=5))
    drain()
    drain()
    assert set(observed(spark, table)) == {"e0", "e1", "e2", "e3", "e4"}


def test_stream_takes_old_days_in_later_batches(spark, tmp_path):
    root, table = str(tmp_path / "zone"), str(tmp_path / "t")
    landing.write_runs(root, **sample_runs(spark))
    files = sorted(glob.glob(f"{root}/{landing.EVENTS}/**/*.json*", recursive=True))
    source = files[0]
    lines = open(source).read().splitlines()

    def land(name, n, modified):  # one file a day, the newest day modified first
        rows = [json.loads(line) for line in lines]
        for i, row in enumerate(rows):
            row["event_id"], row["observed_at"] = f"{name}{i}", day(n).strftime("%Y-%m-%dT%H:%M:%SZ")
        path = os.path.join(os.path.dirname(source), f"{name}.json")
        with open(path, "w") as out:
            out.write("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (modified, modified))

    def drain():
        stream = landed_events_stream(spark, root, 1)
        stream_observations(stream, table, str(tmp_path / "checkpoint")).awaitTermination()

    for k, name in enumerate(("dayC", "dayB", "dayA")):
        land(name, 300 - 40 * k, 1_000_000 + 1000 * k)
    drain()
    assert {e[:4] for e in observed(spark, table)} >= {"dayA", "dayB", "dayC"}
    land("late", 100, 2_000_000)  # a later drain still refuses what is older than its lookback
    drain()
    assert not any(e.startswith("late") for e in observed(spark, table))


def test_watermark_deduplication_keeps_one_copy(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("a", day(0), NOW, 1), ("a", day(0), NOW, 2), ("b", day(0, 1), NOW, 3)]
    raw(spark, rows).coalesce(1).write.parquet(folder)
    stream = first_copies(spark.readStream.schema(INVENTORY_EVENTS).parquet(folder))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def land(spark, root, run, days, kind=landing.EVENTS):
    """One file of a run with one observation for each of ``days``."""
    frames = sample_runs(spark, run, products=1)
    rows = spark.createDataFrame([(f"{run}-{n}", day(n), n) for n in days], "event_id string, observed_at timestamp_ntz, n int")
    events = rows.select(
        "event_id", F.lit("TARGET").alias("source"), F.lit("p").alias("retailer_product_id"), F.col("n").cast("double").alias("price"),
        "observed_at", F.col("observed_at").alias("extracted_at"), F.lit(run).alias("ingestion_run_id"),
    )
    landing.append_files(landing.with_levels(events, F.lit("2024-01-02").cast("timestamp_ntz"), "ingestion_run_id"), root, kind)


@pytest.mark.parametrize("breaks_at, after", [(1, False), (2, False), (2, True)])
def test_a_broken_drain_goes_on_with_its_mark(spark, tmp_path, monkeypatch, breaks_at, after):
    from shelflog.streaming import ingest

    root, table, checkpoint = (str(tmp_path / n) for n in ("zone", "t", "c"))
    land(spark, root, "old", [20])
    stream = landed_events_stream(spark, root, files_per_batch=1)
    stream_observations(stream, table, checkpoint).awaitTermination()
    assert set(observed(spark, table)) == {"old-20"}
    # Newest first: without the mark of the drain's start the later files would be too late.
    for run, days in (("x", [30]), ("y", [19]), ("z", [18, 21])):
        land(spark, root, run, days)
    calls, apply = [], ingest.upsert

    def failing(rows, *args, **options):
        calls.append(1)
        if len(calls) == breaks_at and not after:
            raise RuntimeError("lost")
        apply(rows, *args, **options)
        if len(calls) == breaks_at:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(ingest, "upsert", failing)
    with pytest.raises(Exception):
        stream_observations(stream, table, checkpoint).awaitTermination()
    monkeypatch.undo()
    ledger = ingest.Ledger(spark, checkpoint)
    assert ledger.open_drain()[1] == day(20)
    stream_observations(stream, table, checkpoint).awaitTermination()
    assert set(observed(spark, table)) == {"old-20", "x-30", "y-19", "z-21"}
    assert ledger.open_drain() is None
    # The next drain begins with the newest moment again.
    land(spark, root, "late", [25, 29])
    stream_observations(stream, table, checkpoint).awaitTermination()
    assert set(observed(spark, table)) == {"old-20", "x-30", "y-19", "z-21", "late-29"}


def test_a_booked_batch_is_not_applied_again(spark, tmp_path, monkeypatch):
    from shelflog.streaming import ingest

    root, table, checkpoint = (str(tmp_path / n) for n in ("zone", "t", "c"))
    land(spark, root, "a", [1])
    book = ingest.Ledger.book

    def failing(self, drain, event, **more):
        book(self, drain, event, **more)
        if event == "batch":
            raise RuntimeError("lost between ledger and checkpoint")

    monkeypatch.setattr(ingest.Ledger, "book", failing)
    stream = landed_events_stream(spark, root)
    with pytest.raises(Exception):
        stream_observations(stream, table, checkpoint).awaitTermination()
    monkeypatch.undo()
    monkeypatch.setattr(ingest, "upsert", lambda *a, **k: pytest.fail("applied twice"))
    stream_observations(stream, table, checkpoint).awaitTermination()
    assert set(observed(spark, table)) == {"a-1"}


def test_the_stream_leaves_bad_lines_out(spark, tmp_path):
    root = str(tmp_path / "zone")
    land(spark, root, "a", [1, 2])
    folder = tmp_path / "zone" / landing.EVENTS / "source=TARGET/year=2024/month=01/day=02/run_id=a"
    (folder / "cut.json").write_text('{"event_id": "cut", "observ\n{"price": 1}\n')
    stream_observations(landed_events_stream(spark, root), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert set(observed(spark, str(tmp_path / "t"))) == {"a-1", "a-2"}
