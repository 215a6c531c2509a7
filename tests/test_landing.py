import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelflog.plans import load
from shelflog.sources import landing, seeds

NOW = datetime(2024, 3, 1)


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def sample_runs(spark, run="r1", products=3):
    rows = spark.range(products).select(
        F.lit("TARGET").alias("source"),
        F.lit(run).alias("run_id"),
        F.concat(F.lit("p"), "id").alias("retailer_product_id"),
        F.lit("2024-01-02T03:04:05+00:00").alias("observed_at"),
        F.parse_json(F.concat(F.lit('{"n": '), "id", F.lit("}"))).alias("raw_response"),
    )
    moment = ntz("2024-01-02 03:04:05")
    events = spark.range(products).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.lit("TARGET").alias("source"),
        F.concat(F.lit("p"), "id").alias("retailer_product_id"),
        F.lit(1.5).alias("price"),
        moment.alias("observed_at"),
        moment.alias("extracted_at"),
        F.lit(run).alias("ingestion_run_id"),
    )
    rejects = spark.range(0).select(
        F.lit("TARGET").alias("source"),
        F.lit("why").alias("reason"),
        moment.alias("occurred_at"),
        F.lit(run).alias("ingestion_run_id"),
    )
    manifests = spark.range(1).select(
        F.lit(run).alias("run_id"),
        F.lit("TARGET").alias("source"),
        moment.alias("observed_at"),
        moment.alias("started_at"),
        F.lit("SUCCESS").alias("status"),
        F.lit(products).cast("bigint").alias("payloads_received"),
        F.lit(products).cast("bigint").alias("events_normalized"),
    )
    frames = {
        "payloads": landing.with_levels(rows, moment, "run_id"),
        "events": landing.with_levels(events, moment, "ingestion_run_id"),
        "rejects": landing.with_levels(rejects, moment, "ingestion_run_id"),
    }
    frames["manifests"] = landing.with_content_hashes(
        landing.with_levels(manifests, moment, "run_id"), frames["payloads"], frames["events"]
    )
    return frames


def test_round_trip_and_layout(spark, tmp_path):
    root = str(tmp_path / "zone")
    landing.write_runs(root, **sample_runs(spark))
    folder = tmp_path / "zone/normalized_events/source=TARGET/year=2024/month=01/day=02/run_id=r1"
    assert folder.is_dir()
    assert not list((tmp_path / "zone").glob("rejected_records/source=*"))
    events = landing.scan_events(spark, root).orderBy("event_id").collect()
    assert [r["event_id"] for r in events] == ["e0", "e1", "e2"]
    assert events[0]["observed_at"] == datetime(2024, 1, 2, 3, 4, 5)
    assert landing.scan_rejects(spark, root).count() == 0
    run = landing.scan_runs(spark, root).first()
    assert run["error_summary"] == "[]" and run["completed_at"] is None
    assert run["raw_payload_path"].endswith("month=01/day=02/run_id=r1")
    line = json.loads(next(f for f in (tmp_path / "zone/manifests").rglob("*.json")).read_text())
    assert set(line["content_hashes"]) == {"raw_payloads", "normalized_events"}


def test_a_run_is_never_written_twice(spark, tmp_path):
    root = str(tmp_path / "zone")
    landing.write_runs(root, **sample_runs(spark))
    with pytest.raises(landing.RunExists):
        landing.write_runs(root, **sample_runs(spark))
    landing.write_runs(root, **sample_runs(spark, "r2", products=1))
    assert landing.scan_payloads(spark, root).count() == 4


def test_a_run_without_payloads_is_never_written_twice(spark, tmp_path):
    frames = sample_runs(spark, products=0)
    landing.write_runs(str(tmp_path), **frames)
    with pytest.raises(landing.RunExists):
        landing.write_runs(str(tmp_path), **frames)
    assert landing.scan_runs(spark, str(tmp_path)).count() == 1
    landing.write_runs(str(tmp_path), **sample_runs(spark, "r2"))
    with pytest.raises(landing.RunExists):
        landing.write_runs(str(tmp_path), **sample_runs(spark, "r2"))


def test_load_counts_and_repeats(spark, tmp_path):
    root, events, runs = (str(tmp_path / n) for n in ("zone", "events", "runs"))
    landing.write_runs(root, **sample_runs(spark))
    first = load.load_landing(spark, root, events, runs, NOW).first()
    assert (first["events_loaded"], first["runs_loaded"]) == (3, 1)
    assert first["events_source_files"] >= 1 and first["runs_source_files"] >= 1
    again = load.load_landing(spark, root, events, runs, NOW).first()
    assert (again["events_loaded"], again["runs_loaded"]) == (0, 0)
    stored = load.read_raw_events(spark, events).orderBy("event_id").collect()
    assert [json.loads(r["raw_payload"]) for r in stored] == [{"n": 0}, {"n": 1}, {"n": 2}]
    assert stored[0]["loaded_at"] == NOW


def test_empty_landing_zone(spark, tmp_path):
    counters = load.load_landing(
        spark, str(tmp_path / "none"), str(tmp_path / "e"), str(tmp_path / "r"), NOW
    ).first()
    assert tuple(counters) == (0, 0, 0, 0, 0)


def test_combined_layout(spark, tmp_path):
    folder = tmp_path / "raw/source=GAMESTOP/year=2024/month=01/day=02/run_id=abc"
    folder.mkdir(parents=True)
    (folder / "raw_payloads.ndjson").write_text(
        '{"retailer_product_id": "7", "raw_response": {"old": 1}}\n\n'
        '{"retailer_product_id": "7", "raw_response": {"new": 2}}\n'
    )
    event = {
        "event_id": "x", "source": "GAMESTOP", "retailer_product_id": "7", "price": 2.345,
        "observed_at": "2024-01-01T22:00:00-05:00", "ingestion_run_id": "abc", "extra": 1,
    }
    orphan = {**event, "event_id": "y", "retailer_product_id": "8"}
    (folder / "normalized_events.ndjson").write_text(
        json.dumps(event) + "\n\n" + json.dumps(orphan) + "\n"
    )
    (folder / "manifest.json").write_text(
        json.dumps({"run_id": "abc", "source": "GAMESTOP", "status": "SUCCESS",
                    "started_at": "2024-01-02T03:00:00Z"}, indent=2)
    )
    root, events, runs = str(tmp_path / "raw"), str(tmp_path / "e"), str(tmp_path / "r")
    counters = load.load_landing(spark, root, events, runs, NOW, combined=True).first()
    assert tuple(counters) == (2, 1, 1, 1, 0)
    got = {r["event_id"]: r for r in load.read_raw_events(spark, events).collect()}
    assert got["x"]["observed_at"] == datetime(2024, 1, 2, 3)
    assert str(got["x"]["price"]) == "2.35" and got["x"]["raw_payload"] == '{"new":2}'
    assert got["y"]["raw_payload"] == "null" and got["y"]["sku"] is None
    run = spark.read.parquet(runs).first()
    assert run["error_summary"] == "[]" and run["started_at"] == datetime(2024, 1, 2, 3)


BAD = [
    '{"event_id": "cut", "pri',
    '{"event_id": "t", "quantity_available": "many"}',
    '{"event_id": "u", "price": 1}{"event_id": "v", "price": 2}',
    '{"event_id": "w"}}',
    '[{"event_id": "x"}]',
    "null",
    '"text"',
]
NO_ID = '{"retailer_product_id": "p9", "price": 1.0}'


def add_lines(root, kind, lines, run="r1", name="more.json"):
    folder = root / f"{kind}/source=TARGET/year=2024/month=01/day=02/run_id={run}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_bad_lines_are_kept_apart(spark, tmp_path):
    root = tmp_path / "zone"
    landing.write_runs(str(root), **sample_runs(spark))
    good = '{"event_id": "good", "price": 2, "unknown": {"a": [1]}}'
    add_lines(root, landing.EVENTS, [*BAD, NO_ID, BAD[0], "", "  \t", good])
    add_lines(root, landing.PAYLOADS, ['{"retailer_product_id": "p0", "raw_response": {"n": 7}', "{}"])
    add_lines(root, landing.REJECTS, ['{"reason": "why"'])
    add_lines(root, landing.MANIFESTS, ['{"status": 1,'])
    ids = {r["event_id"] for r in landing.scan_events(spark, str(root)).collect()}
    assert ids == {"e0", "e1", "e2", "good"}
    assert landing.scan_payloads(spark, str(root)).count() == 4
    assert landing.scan_rejects(spark, str(root)).count() == 0
    assert landing.scan_runs(spark, str(root)).count() == 1
    rows = landing.scan_bad_lines(spark, str(root)).collect()
    events = {r["line"]: (r["fault"], r["copies"]) for r in rows if r["kind"] == landing.EVENTS}
    assert events == {b: (landing.UNREADABLE, 1 + (b == BAD[0])) for b in BAD} | {NO_ID: (landing.WITHOUT_KEY, 1)}
    assert {(r["kind"], r["file"], r["run_id"]) for r in rows if r["kind"] != landing.EVENTS} == {
        (k, "more.json", "r1") for k in (landing.PAYLOADS, landing.REJECTS, landing.MANIFESTS)
    }
    assert len({r["line_id"] for r in rows}) == len(rows) == len(BAD) + 4


def test_what_is_read_does_not_change_what_is_bad(spark, tmp_path):
    root = tmp_path / "zone"
    landing.write_runs(str(root), **sample_runs(spark))
    add_lines(root, landing.EVENTS, BAD)
    events = landing.scan_events(spark, str(root))
    assert events.count() == events.select("price").count() == len(events.select("event_id", "sku").collect()) == 3


def test_a_load_fails_or_diverts_and_never_repeats(spark, tmp_path):
    root, events, runs, bad = (str(tmp_path / n) for n in ("zone", "events", "runs", "bad"))
    landing.write_runs(root, **sample_runs(spark))
    add_lines(tmp_path / "zone", landing.EVENTS, [BAD[0], NO_ID])
    with pytest.raises(landing.BadLines):
        load.load_landing(spark, root, events, runs, NOW)
    assert load.read_raw_events(spark, events).count() == load.read_raw_runs(spark, runs).count() == 0
    for want in ((3, 1, 2, 1, 2), (0, 0, 2, 1, 0)):
        assert tuple(load.load_landing(spark, root, events, runs, NOW, quarantine_path=bad).first()) == want
    add_lines(tmp_path / "zone", landing.EVENTS, [BAD[1]], name="later.json")
    assert load.load_landing(spark, root, events, runs, NOW, quarantine_path=bad).first()["bad_lines"] == 1
    kept = spark.read.parquet(bad)
    assert {r["line"] for r in kept.collect()} == {BAD[0], NO_ID, BAD[1]}
    assert kept.where("loaded_at is null").isEmpty()


def test_rows_without_a_key_are_never_inserted(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = landing.scan_events(spark, str(tmp_path / "none")).unionByName(
        spark.createDataFrame([(None,), ("a",)], "event_id string"), allowMissingColumns=True
    ).withColumn("raw_payload", F.lit("null"))
    assert [load.merge_events(batch, path, NOW) for _ in range(2)] == [1, 0]


def test_a_combined_layout_with_a_cut_manifest(spark, tmp_path):
    folder = tmp_path / "raw/source=GAMESTOP/year=2024/month=01/day=02/run_id=abc"
    folder.mkdir(parents=True)
    (folder / "normalized_events.ndjson").write_text('{"event_id": "x"}\n{"event_id": "y"')
    (folder / "manifest.json").write_text('{\n "run_id": "abc",\n "status": "SUC')
    root = str(tmp_path / "raw")
    bad = {(r["kind"], r["file"]) for r in landing.scan_bad_lines(spark, root, combined=True).collect()}
    assert bad == {(landing.EVENTS, "normalized_events.ndjson"), (landing.MANIFESTS, "manifest.json")}
    assert landing.scan_events(spark, root, combined=True).count() == 1
    assert landing.scan_runs(spark, root, combined=True).count() == 0


@pytest.mark.parametrize("breaks_at", [landing.EVENTS, landing.REJECTS, landing.MANIFESTS])
def test_an_unfinished_run_is_invisible_and_can_be_written_again(spark, tmp_path, monkeypatch, breaks_at):
    root = str(tmp_path / "zone")
    landing.write_runs(root, **sample_runs(spark, "r0", products=2))
    append = landing.append_files

    def failing(df, where, kind):
        if kind == breaks_at:
            raise RuntimeError("lost")
        append(df, where, kind)

    monkeypatch.setattr(landing, "append_files", failing)
    with pytest.raises(RuntimeError):
        landing.write_runs(root, **sample_runs(spark, "r1"))
    monkeypatch.undo()
    assert {r["run_id"] for r in landing.unpublished_runs(spark, root).collect()} == {"r1"}
    assert {r["run_id"] for r in landing.scan_payloads(spark, root).collect()} == {"r0"}
    assert landing.scan_events(spark, root).count() == 2
    # The second attempt holds less than the first left behind.
    landing.write_runs(root, **sample_runs(spark, "r1", products=1))
    assert landing.unpublished_runs(spark, root).isEmpty()
    assert landing.scan_payloads(spark, root).count() == landing.scan_events(spark, root).count() == 3
    assert landing.audit_digests(spark, root).isEmpty()
    with pytest.raises(landing.RunExists):
        landing.write_runs(root, **sample_runs(spark, "r1"))


def test_many_unpublished_runs_take_a_plain_join(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "zone")
    for run in ("r0", "r1", "r2"):
        landing.append_files(sample_runs(spark, run)["payloads"], root, landing.PAYLOADS)
    landing.write_runs(root, **sample_runs(spark, "r3", products=1))
    monkeypatch.setattr(landing, "FEW_RUNS", 1)
    assert {r["run_id"] for r in landing.scan_payloads(spark, root).collect()} == {"r3"}


def test_the_audit_names_exactly_the_changed_runs(spark, tmp_path):
    root = tmp_path / "zone"
    for run in ("a", "b", "c", "d", "e"):
        landing.write_runs(str(root), **sample_runs(spark, run))
    assert landing.audit_digests(spark, str(root)).isEmpty()
    add_lines(root, landing.EVENTS, ['{"event_id": "added"}'], run="b")
    changed = next((root / landing.PAYLOADS).rglob("run_id=c/*.json"))
    (changed.parent / f".{changed.name}.crc").unlink()
    changed.write_text(changed.read_text().replace('{"n":1}', '{"n":2}'))
    for gone in (root / landing.EVENTS).rglob("run_id=d/*.json"):
        gone.unlink()
    found = {(r["run_id"], r["kind"], r["found"] is None) for r in landing.audit_digests(spark, str(root)).collect()}
    assert found == {("b", landing.EVENTS, False), ("c", landing.PAYLOADS, False), ("d", landing.EVENTS, True)}


def test_digests_do_not_depend_on_order_or_chunking_of_files(spark):
    lines = [("r", f"line {i % 50}") for i in range(200)] + [("q", "one")]
    a = spark.createDataFrame(lines, "run_id string, line string")
    b = spark.createDataFrame(lines[::-1], "run_id string, line string").repartition(7)

    def digests(df, chunks):
        return {r[0]: r[1] for r in landing.content_digests(df, "d", chunks).collect()}

    assert digests(a, 10) == digests(b, 10) != digests(a, 11)
    changed = spark.createDataFrame(lines[1:], "run_id string, line string")
    assert digests(changed, 10)["r"] != digests(a, 10)["r"]
    assert digests(changed, 10)["q"] == digests(a, 10)["q"]


def test_seeds(spark, tmp_path):
    (tmp_path / "products.csv").write_text(
        "product_id,retailer,retailer_product_id,product_name,product_url,category,store_id\n"
        'a-1,TARGET,007,"Box, large",https://x.example,,3991\n'
    )
    (tmp_path / "retailers.csv").write_text(
        "retailer_code,retailer_name,website,integration_mode\nTARGET,Target,https://t.example,live\n"
    )
    (tmp_path / "products.json").write_text(
        json.dumps([{"id": "a", "retailer": "TARGET", "retailer_product_id": "007", "name": "n", "url": "u"}], indent=1)
    )
    product = seeds.read_product_seed(spark, str(tmp_path / "products.csv")).first()
    assert (product["retailer_product_id"], product["product_name"], product["category"]) == ("007", "Box, large", None)
    assert seeds.read_retailer_seed(spark, str(tmp_path / "retailers.csv")).first()["integration_mode"] == "live"
    item = seeds.read_catalog(spark, str(tmp_path / "products.json")).first()
    assert item["retailer_product_id"] == "007" and item["store_id"] is None
