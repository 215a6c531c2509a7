"""Ingestion, loads and builds give their disk back: shuffle files, scratch tables, plain text."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelflog.plans import load
from shelflog.plans.ingest import ingest
from shelflog.plans.warehouse import build_warehouse
from shelflog.session import LEAN_CONF, lean_disk
from shelflog.sources import landing

NOW = datetime(2024, 3, 1)
RUNS = 8


def taken_in(spark, first=0):
    """Payloads, catalog and runs; each run polls four products, one of them twice and one unknown."""
    polls = spark.range(first, first + RUNS).selectExpr(
        "'WALMART' as source",
        "concat('w-', id) as run_id",
        "explode(array(0, 1, 2, 2, 3)) as product",
        "id",
    )
    payloads = polls.selectExpr(
        "source",
        "run_id",
        "cast(product as string) as retailer_product_id",
        "concat('2024-01-', lpad(id % 28 + 1, 2, '0'), 'T', lpad(cast(id div 28 as int), 2, '0'), ':00:00+00:00') as observed_at",
        """parse_json(concat('{"name": "item", "salePrice": ', product + 1, ', "availableOnline": true}')) as raw_response""",
        "timestamp_ntz'2024-02-01 00:00:00' as extracted_at",
    )
    catalog = spark.range(3).selectExpr(
        "concat('c', id) as id", "'walmart' as retailer", "cast(id as string) as retailer_product_id",
        "'known' as name", "'https://x.example' as url", "'toys' as category", "cast(null as string) as store_id",
    )
    moment = F.to_timestamp("observed_at").cast("timestamp_ntz")
    runs = payloads.select("run_id", "source", moment.alias("observed_at")).distinct()
    runs = runs.withColumns({"started_at": F.col("observed_at"), "completed_at": F.col("observed_at")})
    return payloads, catalog, runs


def shared_tables(spark):
    return set((Path(spark.conf.get("spark.checkpoint.dir")) / "shelflog").glob("*-*"))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left_over(spark, before):
    """Shuffle files made since ``before``; Spark deletes them in the background."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_ingestion_deletes_what_it_wrote_on_the_way(spark, tmp_path):
    before = shared_tables(spark)
    ingest(spark, str(tmp_path / "zone"), *taken_in(spark))
    assert shared_tables(spark) == before
    assert landing.audit_digests(spark, str(tmp_path / "zone")).isEmpty()


def test_a_compressed_landing_zone_reads_as_a_plain_one(spark, tmp_path):
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    ingest(spark, plain, *taken_in(spark))
    ingest(spark, packed, *taken_in(spark), compression="gzip")
    for kind in landing.PARTS:
        assert not list(Path(packed, kind).rglob("*.json"))
        size = [sum(f.stat().st_size for f in Path(root, kind).rglob("*.json*")) for root in (plain, packed)]
        assert size[0] > 0 and (kind == landing.REJECTS or size[1] < size[0])
    for scan in (landing.scan_events, landing.scan_rejects, landing.scan_runs):
        a, b = scan(spark, plain), scan(spark, packed)
        assert a.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    bodies = [landing.scan_payloads(spark, z).withColumn("raw_response", F.to_json("raw_response")).drop("position") for z in (plain, packed)]
    assert bodies[0].count() == 5 * RUNS and bodies[0].exceptAll(bodies[1]).isEmpty()
    assert landing.audit_digests(spark, packed).isEmpty()
    with pytest.raises(landing.RunExists):
        ingest(spark, packed, *taken_in(spark), compression="gzip")


def test_loads_and_builds_leave_no_shuffle_files_and_no_scratch(spark, tmp_path):
    root, events, runs = (str(tmp_path / n) for n in ("zone", "events", "runs"))
    ingest(spark, root, *taken_in(spark), compression="gzip")
    tables, files = shared_tables(spark), shuffle_files(spark)
    counters = load.load_landing(spark, root, events, runs, NOW).first()
    assert (counters["events_loaded"], counters["runs_loaded"]) == (3 * RUNS, RUNS)
    assert not left_over(spark, files)
    assert shared_tables(spark) == tables
    products = spark.createDataFrame(
        [("a", "WALMART", "1", "n", "u", "toys", None)],
        "product_id string, retailer string, retailer_product_id string, product_name string, product_url string, category string, store_id string",
    )
    retailers = spark.createDataFrame([("WALMART", "Walmart", "w", "live")], "retailer_code string, retailer_name string, website string, integration_mode string")
    files = shuffle_files(spark)
    models = build_warehouse(spark, str(tmp_path / "wh"), load.read_raw_events(spark, events), load.read_raw_runs(spark, runs), products, retailers, NOW)
    assert not left_over(spark, files)
    assert models["mart_daily_product_availability"].count() == 3 * RUNS


def test_a_load_completes_new_rows_only(spark, tmp_path, monkeypatch):
    root, events, runs = (str(tmp_path / n) for n in ("zone", "events", "runs"))
    seen, attach = [], landing.attach_payloads

    def counting(new, payloads):
        seen.append(new.count())
        return attach(new, payloads)

    monkeypatch.setattr(landing, "attach_payloads", counting)
    ingest(spark, root, *taken_in(spark))
    for first, loaded in ((0, 3 * RUNS), (0, 0), (RUNS, 3 * RUNS)):
        if first:
            ingest(spark, root, *taken_in(spark, first))
        assert load.load_landing(spark, root, events, runs, NOW).first()["events_loaded"] == loaded
    assert seen == [3 * RUNS, 3 * RUNS]
    stored = load.read_raw_events(spark, events)
    assert stored.count() == 6 * RUNS
    price = F.get_json_object("raw_payload", "$.salePrice").cast("decimal(12,2)")
    assert stored.where(price.eqNullSafe(F.col("price"))).count() == 6 * RUNS


def test_a_used_plan_is_computed_again_and_settings_return(spark):
    before = {key: spark.conf.get(key, None) for key in LEAN_CONF}
    files = shuffle_files(spark)
    with pytest.raises(ZeroDivisionError), lean_disk(spark):
        counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        once = sorted(counts.collect())
        assert not left_over(spark, files)
        assert sorted(counts.collect()) == once and len(once) == 7
        1 / 0
    assert {key: spark.conf.get(key, None) for key in LEAN_CONF} == before
