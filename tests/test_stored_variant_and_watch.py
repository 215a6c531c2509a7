"""Raw tables that keep JSON parsed, checks counted by the writing jobs, mounted stores, hashes."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelflog.operators import normalize, quality
from shelflog.operators.quality import Check, Watch
from shelflog.plans import load
from shelflog.plans.warehouse import write_table
from shelflog.schemas import INVENTORY_EVENTS
from shelflog.session import mount
from tests.test_normalize import read

LOADED = datetime(2024, 2, 1)


def raw(spark, rows):
    """rows: (event_id, day, payload text)."""
    short = spark.createDataFrame(
        [(i, datetime(2024, 1, day, 12), payload) for i, day, payload in rows],
        "event_id string, observed_at timestamp_ntz, raw_payload string",
    )
    empty = spark.createDataFrame([], INVENTORY_EVENTS).drop("loaded_at")
    return empty.unionByName(short, allowMissingColumns=True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payload_is_stored_parsed_and_paths_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("a", 1, '{"k": 1, "n": {"x": "y"}}'), ("b", 2, '{"k":"no number"}'), ("c", 2, "null"), ("d", 3, None)]
    assert load.merge_events(raw(spark, rows), path, LOADED, typed=True) == 4
    # An existing table keeps its form, and its rows are not inserted again.
    assert load.merge_events(raw(spark, [*rows, ("e", 3, "[1, 2]")]), path, LOADED) == 1
    typed = load.read_typed_events(spark, path)
    k = typed.select("event_id", F.try_variant_get("raw_payload", "$.k", "bigint").alias("k"))
    assert "parse_json" not in plan(k) and "raw_payload:struct<0:bigint>" in plan(k).replace(" ", "")
    assert {r["event_id"]: r["k"] for r in k.collect()} == {"a": 1, "b": None, "c": None, "d": None, "e": None}
    whole = typed.select("event_id", F.schema_of_variant("raw_payload").alias("kind"))
    assert "parse_json" not in plan(whole) and "raw_payload:struct<0:variant>" in plan(whole)
    text = {r["event_id"]: r["raw_payload"] for r in load.read_raw_events(spark, path).collect()}
    assert text == {"a": '{"k":1,"n":{"x":"y"}}', "b": '{"k":"no number"}', "c": "null", "d": None, "e": "[1,2]"}


def test_both_forms_read_alike(spark, tmp_path):
    rows = [("a", 1, '{"k":1}'), ("b", 2, '{"k":[true,null]}')]
    seen = []
    for form in (False, True):
        path = str(tmp_path / str(form))
        load.merge_events(raw(spark, rows), path, LOADED, typed=form)
        as_text = load.read_raw_events(spark, path).select("event_id", "raw_payload")
        as_variant = load.read_typed_events(spark, path).select("event_id", F.to_json("raw_payload").alias("v"))
        seen.append((sorted(map(tuple, as_text.collect())), sorted(map(tuple, as_variant.collect()))))
        assert load.stage_table(spark, path).count() == 2
    assert seen[0] == seen[1]


def test_text_that_is_no_json_is_an_error_and_inserts_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    load.merge_events(raw(spark, [("a", 1, "{}")]), path, LOADED, typed=True)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        load.merge_events(raw(spark, [("b", 1, "{cut")]), path, LOADED)
    assert [r["event_id"] for r in load.read_raw_events(spark, path).collect()] == ["a"]


def test_typed_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = spark.createDataFrame([("r1", '["a","b"]'), ("r2", "[]")], "run_id string, error_summary string")
    empty = load.read_raw_runs(spark, path).drop("loaded_at")
    batch = empty.unionByName(rows, allowMissingColumns=True)
    assert load.merge_runs(batch, path, LOADED, typed=True) == 2
    assert load.merge_runs(batch, path, LOADED) == 0
    first = load.read_typed_runs(spark, path).select("run_id", F.try_variant_get("error_summary", "$[0]", "string").alias("e"))
    assert sorted(map(tuple, first.collect())) == [("r1", "a"), ("r2", None)]
    assert {r["error_summary"] for r in load.read_raw_runs(spark, path).collect()} == {'["a","b"]', "[]"}


CHECKS = [
    Check("m", "k", "not_null"),
    Check("m", "k", "unique"),
    Check("m", "v", "accepted_range", minimum=0, maximum=100),
    Check("m", "at", "not_far_in_future"),
    Check("rules_only", "k", "not_null"),
]
ROWS = [("a", 1.0, 1), ("a", -1.0, 2), (None, None, 3), ("z", 101.0, 3)]


@pytest.mark.parametrize("day", [None, "observed_date"])
@pytest.mark.parametrize("rows", [ROWS, []])
def test_watched_writes_count_what_a_scan_counts(spark, tmp_path, day, rows):
    now = datetime(2024, 1, 2)
    frame = spark.createDataFrame(
        [(k, v, datetime(2024, 1, d), "p") for k, v, d in rows], "k string, v double, at timestamp_ntz, product_key string"
    ).withColumn("observed_date", F.to_date("at"))
    watch = Watch(CHECKS, now)
    models = {
        name: write_table(frame.repartition(3), str(tmp_path / name), day, lambda df, name=name: watch.on(name, df))
        for name in ("m", "rules_only")
    }
    watched = quality.run_checks(models, CHECKS, now, watch)
    plain = quality.run_checks(models, CHECKS, now)
    # One scan is left, that of the uniqueness check; a table with row rules only is not read.
    assert plan(plain).count("FileScan") == 3
    assert plan(watched).count("FileScan") == 1 and "rules_only" not in "".join(watched.inputFiles())
    assert sorted(map(tuple, watched.collect())) == sorted(map(tuple, plain.collect()))
    assert [watch.failures()[c] for c in CHECKS if c.kind != "unique"] == ([1, 2, 2, 1] if rows else [0, 0, 0, 0])


def test_watch_and_checks_must_share_their_time(spark):
    with pytest.raises(ValueError):
        quality.run_checks({}, [], datetime(2024, 1, 1), Watch([], datetime(2024, 1, 2)))


def test_raw_table_and_observations_behind_a_mount_table(spark, tmp_path):
    root = mount(spark, "shop", raw=str(tmp_path / "disk1"), observed=f"file://{tmp_path}/disk2")
    assert root == "viewfs://shop"
    raw_path, table = f"{root}/raw/events", f"{root}/observed/table"
    rows = [(f"e{i}", 1 + i % 3, "{}") for i in range(9)]
    batch = raw(spark, rows).withColumns({"source": F.lit("TARGET"), "retailer_product_id": F.lit("1")})
    for added in (9, 0):
        assert load.merge_events(batch, raw_path, LOADED, typed=True) == added
        load.refresh_from_raw(spark, raw_path, table)
    assert spark.read.parquet(table).count() == 9
    assert {f.split(":")[0] for f in spark.read.parquet(table).inputFiles()} == {"viewfs"}
    assert list((tmp_path / "disk1" / "events").iterdir()) and list((tmp_path / "disk2" / "table").iterdir())


PAYLOADS = [
    {"data": {"product": {"name": "é \"q\" \\ /", "available_to_promise": {"availability": "AVAILABLE"}, "z": [1, {"b": None, "a": True}]}}},
    {"data": {"product": {"available_to_promise": {"availability": "x"}, "list": [], "empty": {}, "n": -7, "t": "line\nbreak"}}},
]


def test_response_hash_equals_plain_python(spark):
    rows = normalize.accepted(read(spark, [("TARGET", p) for p in PAYLOADS])).collect()
    got = {r["observed_at"].second: r["source_response_hash"] for r in rows}
    for i, payload in enumerate(PAYLOADS):
        text = json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert got[i] == hashlib.sha256(text.encode()).hexdigest()
    assert all(r["raw_file_path"] is None for r in rows)


def test_reject_excerpt_equals_plain_python(spark):
    bad = [{"b": "x" * 600, "a": [1, None, {"c": "é"}]}, {}, {"k": "short"}]
    cases = [("POKEMON_CENTER", p) for p in bad]
    examined = read(spark, cases).where("reason <> ''")
    rows = normalize.rejected(examined).collect()
    texts = {json.dumps(p, sort_keys=True, separators=(",", ":"), ensure_ascii=False)[: normalize.EXCERPT_LENGTH] for p in bad}
    assert rows and {r["raw_excerpt"] for r in rows} <= texts and len(rows) == len(bad)
