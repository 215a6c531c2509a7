from datetime import date, datetime

import pytest

from shelflog.operators import quality
from shelflog.operators.quality import Check
from shelflog.plans import marts, reports
from shelflog.plans.warehouse import write_table


def test_suite_declares_all_checks():
    kinds = [c.kind for c in quality.SUITE]
    assert len(quality.SUITE) == 77 and len(set(quality.SUITE)) == 77
    assert kinds.count("not_null") + kinds.count("unique") == 59
    assert kinds.count("accepted_values") == 5 and kinds.count("accepted_range") == 6
    assert kinds.count("relationships") == 4


def test_checks_count_offending_rows(spark):
    child = spark.createDataFrame(
        [("a", 1.0, "x"), ("a", -1.0, "y"), (None, None, None), ("z", 101.0, "y"), ("z", 100.0, "x")],
        "k string, v double, c string",
    )
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    checks = [
        Check("m", "k", "not_null"),
        Check("m", "k", "unique"),
        Check("m", "c", "accepted_values", ("x",)),
        Check("m", "v", "accepted_range", minimum=0, maximum=100),
        Check("m", "v", "accepted_range", minimum=0, maximum=100, inclusive=False),
        Check("m", "k", "relationships", parent="p", parent_column="k"),
    ]
    results = quality.run_checks({"m": child, "p": parent}, checks)
    got = sorted((r["check"], r["failures"]) for r in results.collect())
    assert got == [
        ("accepted_range", 2), ("accepted_range", 3), ("accepted_values", 2), ("not_null", 1),
        ("relationships", 2), ("unique", 2),
    ]
    with pytest.raises(quality.ChecksFailed, match="m.k not_null: 1"):
        quality.require_clean(results)
    quality.require_clean(results.where("failures = 0"))


def test_future_limit_is_exclusive(spark):
    now = datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),), (datetime(2024, 1, 1, 12, 0, 1),)], "t timestamp_ntz")
    assert quality.far_in_future(df, "t", now).count() == 1


def test_freshness_states(spark):
    rows = [("a ", datetime(2024, 1, 1)), ("B", datetime(2024, 1, 3)), ("c", datetime(2024, 1, 4))]
    df = spark.createDataFrame(rows, "source string, loaded_at timestamp_ntz")
    got = {r["source"]: r["state"] for r in quality.freshness(df, datetime(2024, 1, 4, 4)).collect()}
    assert got == {"A": "error", "B": "warn", "C": "pass"}


def test_end_day_counts_as_midnight(spark):
    rows = [("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 2, 0, 0, 1)), ("c", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "source string, observed_at timestamp_ntz")
    got = reports.daily_observation_volume(df, date(2024, 1, 1), date(2024, 1, 2))
    assert [r["source"] for r in got.collect()] == ["c", "a"]
    none = reports.daily_observation_volume(df, date(2024, 1, 1), date(2024, 1, 2), [])
    assert none.count() == 2
    some = reports.daily_observation_volume(df, date(2024, 1, 1), date(2024, 1, 2), ["a", "b"])
    assert [r["source"] for r in some.collect()] == ["a"]


def dims(spark):
    products = spark.createDataFrame(
        [("a-1", "T", "1", "One", "u", "toys", None)],
        "product_id string, retailer string, retailer_product_id string, product_name string, "
        "product_url string, category string, store_id string",
    )
    shops = spark.createDataFrame(
        [("T", "Tee", "w", "LIVE"), ("Z", "Zed", "w", "LIVE")],
        "retailer_code string, retailer_name string, website string, integration_mode string",
    )
    return marts.dim_product(products), marts.dim_retailer(shops)


def test_facts_keep_rows_without_dimensions(spark):
    rows = [
        ("1", "T", "1", datetime(2024, 1, 1)), ("2", "T", "9", datetime(2024, 1, 1)),
        ("3", "Q", "1", datetime(2023, 12, 31)),
    ]
    columns = ["price", "currency", "inventory_status", "quantity_available", "store_id", "location_type", "extracted_at", "ingestion_run_id"]
    df = spark.createDataFrame(rows, "event_id string, source string, retailer_product_id string, observed_at timestamp_ntz")
    df = df.selectExpr("*", *[f"cast(null as string) as {c}" for c in columns])
    fact = marts.fact_inventory_observation(df, *dims(spark), marts.dim_date(spark, datetime(2024, 2, 1)))
    got = {r["event_id"]: (r["product_key"] is None, r["retailer_key"] is None, r["date_key"]) for r in fact.collect()}
    assert got == {"1": (False, False, 20240101), "2": (True, False, 20240101), "3": (True, True, None)}


def test_retailers_without_runs_stay(spark):
    runs = spark.createDataFrame(
        [("T", "UNKNOWN", 5, 0, 2, datetime(2024, 1, 1, 0, 59)), ("T", "SUCCESS", 5, 0, 4, datetime(2024, 1, 1, 0, 59))],
        "source_name string, status string, events_normalized bigint, events_rejected bigint, "
        "duration_seconds bigint, observed_at timestamp_ntz",
    )
    daily = spark.createDataFrame([("T", 50.0), ("T", 25.1)], "source string, availability_pct double")
    summary = marts.mart_retailer_summary(dims(spark)[1], runs, daily, datetime(2024, 1, 1, 1, 1))
    got = {r["source"]: r for r in summary.collect()}
    assert got["Z"]["total_runs"] is None and got["Z"]["run_success_rate_pct"] is None
    t = got["T"]
    assert (t["total_runs"], t["successful_runs"], t["failed_runs"]) == (2, 1, 0)
    assert t["run_success_rate_pct"] == 50.0 and t["hours_since_last_observation"] == 1
    assert t["avg_availability_pct"] == 37.55 and t["avg_run_duration_seconds"] == 3.0
    assert reports.stale_sources(summary, 0).count() == 1
    total = reports.overview_totals(summary).first()
    assert total["total_runs"] == 2 and total["overall_success_rate_pct"] == 50.0
    empty = reports.overview_totals(summary.where("false")).first()
    assert empty["total_runs"] is None


def test_reports_open_only_the_days_asked_for(spark, tmp_path):
    rows = [(f"k{i % 3}", f"s{i % 2}", "n", "c", date(2024, 1, 1 + i % 28), 50.0, i) for i in range(200)]
    columns = "product_key string, source string, product_name string, category string, observation_date date, availability_pct double, observation_count int"
    mart = write_table(spark.createDataFrame(rows, columns), str(tmp_path / "mart"), "observation_date")
    facts = spark.createDataFrame([(f"k{i % 3}", "s", datetime(2024, 1, 1 + i % 28, 5)) for i in range(200)], "product_key string, source string, observed_at timestamp_ntz")
    fact = write_table(facts, str(tmp_path / "fact"), reports.DAY)
    span = date(2024, 1, 5), date(2024, 1, 9)
    for df in (reports.availability_by_product(mart, *span), reports.daily_observation_volume(fact, *span)):
        df.collect()
        plan = df._jdf.queryExecution().toString()
        assert any("PartitionFilters: [" in line and "2024-01-05" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in plan.splitlines() if "PartitionFilters: [" in line)
    want = reports.daily_observation_volume(facts, *span).collect()
    assert reports.daily_observation_volume(fact, *span).collect() == want
