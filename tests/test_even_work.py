"""Work of ingestion is dealt to the tasks and done once."""

from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shelflog.sources import landing
from testbed import adapter


def poll_file(folder, rows):
    """All polls in one row group, as a single split."""
    n = range(rows)
    pq.write_table(
        pa.table(
            {
                "event_id": pa.array(n, pa.int64()),
                "ts": pa.array([datetime(2024, 1, 1 + i % 28, i % 24) for i in n], pa.timestamp("us")),
                "user_id": pa.array([i % 5000 for i in n], pa.int64()),
                "event_type": pa.array(["view"] * rows),
                "value": pa.array([float(i % 90) for i in n]),
                "props": pa.array([f'{{"k": {i * 7919 % 100003}}}' for i in n]),
            }
        ),
        folder / "events.parquet",
        row_group_size=rows,
    )
    return str(folder)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_row_group_is_dealt_to_several_tasks(spark, tmp_path):
    folder = poll_file(tmp_path, 300_000)
    assert adapter.table(spark, folder, "events").rdd.getNumPartitions() == 1
    assert adapter.polls(spark, folder).rdd.getNumPartitions() > 1
    assert "RebalancePartitions" in plan(adapter.raw_events(spark, folder))


def test_payloads_are_dealt_for_examination_and_landed_in_order(spark, tmp_path):
    folder = poll_file(tmp_path, 150_000)
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "shelflog"
    before = set(shared.glob("payloads-*"))
    frames = adapter.whole_runs(spark, folder)
    (written,) = set(shared.glob("payloads-*")) - before
    assert len([*written.glob("*.parquet")]) > 1
    assert "Aggregate" not in plan(frames["manifests"]) and "Join" not in plan(frames["manifests"])
    root = str(tmp_path / "zone")
    landing.append_files(frames["payloads"], root, landing.PAYLOADS)
    landing.append_files(landing.with_paths(frames["manifests"]), root, landing.MANIFESTS)
    of = ["run_id", "retailer_product_id"]
    landed = landing.scan_payloads(spark, root).groupBy(*of).agg(F.max_by(F.to_json("raw_response"), "position").alias("last"))
    polled = adapter.payloads(spark, folder).groupBy(*of).agg(F.max_by(F.to_json("raw_response"), "poll").alias("last"))
    assert landed.exceptAll(polled).isEmpty() and polled.exceptAll(landed).isEmpty()
