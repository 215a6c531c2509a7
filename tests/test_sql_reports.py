from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelflog.plans import reports, sql_reports

START, END = date(2024, 1, 2), date(2024, 1, 6)
QUOTED = "O'Neil\" --;"


@pytest.fixture(scope="module")
def models(spark):
    keys = ["k1", QUOTED, "k3"]
    when = [datetime(2024, 1, 1 + i % 8, i % 24 if i % 3 else 0) for i in range(60)]
    facts = spark.createDataFrame(
        [(f"e{i:02}", keys[i % 3], ["A", QUOTED, None][i % 3], when[i], float(i % 7), i % 2 == 0, i % 5 == 0) for i in range(60)],
        "event string, product_key string, source string, observed_at timestamp_ntz, price double, flag boolean, other boolean",
    )
    dim = spark.createDataFrame([(k, "A", f"name of {k}", "c") for k in keys[:2]], "product_key string, source string, product_name string, category string")
    mart = facts.groupBy("product_key", "source", F.to_date("observed_at").alias("observation_date")).agg(
        F.count("*").alias("observation_count"), F.round(F.avg("price") * 7, 1).alias("availability_pct"), F.avg("price").alias("avg_price")
    ).withColumns({"product_name": F.concat(F.lit("name of "), "product_key"), "category": F.lit("c"), "last_status": F.lit("IN_STOCK")})
    summary = spark.createDataFrame(
        [("r1", "A", "Aa", "live", 7, 4, 1, 2, 71.4, 10, 2, 3.5, datetime(2024, 1, 5), 3, 40.5), ("r2", QUOTED, "Bb", "live", *[None] * 11)],
        "retailer_key string, source string, retailer_name string, integration_mode string, total_runs bigint, successful_runs bigint, "
        "partial_failure_runs bigint, failed_runs bigint, run_success_rate_pct double, total_events_normalized bigint, total_events_rejected bigint, "
        "avg_run_duration_seconds double, last_observed_at timestamp_ntz, hours_since_last_observation bigint, avg_availability_pct double",
    )
    out = {
        "mart_retailer_summary": summary,
        "dim_retailer": summary.select("source", "retailer_name"),
        "dim_product": dim,
        "mart_daily_product_availability": mart,
        "fact_inventory_observation": facts,
        "fact_price_observation": facts.select(
            "product_key", "observed_at", F.col("price").alias("current_price"), F.lit(1.0).alias("previous_price"),
            F.col("flag").alias("price_changed"), F.lit(None).cast("double").alias("pct_change"),
        ),
        "fact_inventory_state_change": facts.select(
            F.col("event").alias("state_change_event_id"), "product_key", "source", "observed_at", F.lit("X").alias("previous_status"),
            F.lit("Y").alias("current_status"), F.col("flag").alias("restocked"), F.col("other").alias("went_out_of_stock"),
        ),
    }
    sql_reports.register_views(out)
    return out


CASES = {
    "overview_totals": [({}, lambda m: reports.overview_totals(m["mart_retailer_summary"]))],
    "retailer_summary": [
        ({"retailers": r}, lambda m, r=r: reports.retailer_summary(m["mart_retailer_summary"], r)) for r in (None, [], [QUOTED], ["A", "none"])
    ],
    "retailers": [({}, lambda m: reports.retailers(m["dim_retailer"]))],
    "products": [({"retailers": r}, lambda m, r=r: reports.products(m["dim_product"], r)) for r in (None, ["A"], ["B"])],
    "availability_by_product": [
        (
            {"first_day": START, "last_day": END, "retailers": r, "products": p},
            lambda m, r=r, p=p: reports.availability_by_product(m["mart_daily_product_availability"], START, END, r, p),
        )
        for r, p in ((None, None), ([QUOTED], []), (["A", QUOTED], ["k1", QUOTED]))
    ],
    "availability_timeline": [
        (
            {"first_day": START, "last_day": END, "product": QUOTED},
            lambda m: reports.availability_timeline(m["mart_daily_product_availability"], QUOTED, START, END),
        )
    ],
    "price_history": [
        ({"first_day": START, "last_day": END, "product": "k1"}, lambda m: reports.price_history(m["fact_price_observation"], "k1", START, END))
    ],
    "recent_state_changes": [
        (
            {"first_day": START, "last_day": END, "retailers": r},
            lambda m, r=r: reports.recent_state_changes(m["fact_inventory_state_change"], m["dim_product"], START, END, r),
        )
        for r in (None, ["A", QUOTED])
    ],
    "daily_observation_volume": [
        (
            {"first_day": START, "last_day": END, "retailers": r},
            lambda m, r=r: reports.daily_observation_volume(m["fact_inventory_observation"], START, END, r),
        )
        for r in (None, [QUOTED])
    ],
}


@pytest.mark.parametrize("name", sql_reports.TEXTS)
def test_texts_give_the_rows_of_the_functions(spark, models, name):
    for arguments, build in CASES[name]:
        got, want = sql_reports.report(spark, name, **arguments), build(models)
        assert got.columns == want.columns
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
