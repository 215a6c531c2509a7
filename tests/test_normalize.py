import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelflog.operators import normalize, runs

CATALOG = [
    (s.lower() + "-1", s, "1", f"Catalog {s}", "https://x.example", None, "3991")
    for s in ("TARGET", "WALMART", "POKEMON_CENTER", "GAMESTOP")
]


def read(spark, cases):
    """cases: (source, payload) -> examined rows in order."""
    rows = [
        (source, f"run-{source}", "1", f"2024-01-01T00:00:{i:02d}+00:00", json.dumps(payload), i)
        for i, (source, payload) in enumerate(cases)
    ]
    payloads = spark.createDataFrame(
        rows, "source string, run_id string, retailer_product_id string, observed_at string, raw string, i int"
    ).select(
        "*",
        F.parse_json("raw").alias("raw_response"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("extracted_at"),
    )
    catalog = spark.createDataFrame(
        CATALOG,
        "id string, retailer string, retailer_product_id string, name string, url string, "
        "category string, store_id string",
    )
    return normalize.examine(payloads, catalog)


def outcome(spark, cases):
    examined = read(spark, cases)
    good = {r["observed_at"].second: r for r in normalize.accepted(examined).collect()}
    bad = {
        r["observed_at"].second: r["reason"]
        for r in examined.where("reason <> ''").collect()
    }
    assert len(good) + len(bad) == len(cases)
    return good, bad


def target(availability="AVAILABLE", **product):
    body = {"available_to_promise": {"availability": availability}, **product}
    return "TARGET", {"data": {"product": body}}


def test_target_words(spark):
    words = {
        "available": "IN_STOCK", "IN_STOCK": "IN_STOCK", "UNAVAILABLE": "OUT_OF_STOCK",
        "not_available": "OUT_OF_STOCK", "OUT_OF_STOCK": "OUT_OF_STOCK", "PREORDER": "PREORDER",
        "BACKORDER": "BACKORDER", "SOME_NEW_STATUS": "UNKNOWN", " AVAILABLE": "UNKNOWN",
        "": "UNKNOWN",
    }
    cases = [target(w) for w in words] + [target(None)]
    good, bad = outcome(spark, cases)
    assert not bad
    assert [good[i]["inventory_status"] for i in range(len(cases))] == [*words.values(), "UNKNOWN"]
    assert good[0]["store_id"] == "3991" and good[0]["product_name"] == "Catalog TARGET"


def test_target_structure(spark):
    cases = [
        ("TARGET", {"data": {}}),
        ("TARGET", {}),
        ("TARGET", {"data": None}),
        ("TARGET", {"data": "x"}),
        ("TARGET", {"data": {"product": []}}),
        ("TARGET", {"data": {"product": ["x"]}}),
        target(price="12"),
        target(price=[1]),
        target(price=""),
        target(item=5),
        target(price={"current_retail": -1.0}),
        target(price={"current_retail": "12.5"}),
        target(price={"current_retail": "cheap"}),
        target(item={"product_description": {"title": 7}}),
        target(item={"product_description": {"title": ""}}),
        target(7),
    ]
    good, bad = outcome(spark, cases)
    assert sorted(good) == [8, 11, 14]
    assert good[8]["price"] is None and good[11]["price"] == 12.5
    assert bad[0] == bad[1] == bad[2] == "no product data"
    assert "malformed data" in bad[3] and bad[4] == "no product data"
    assert "malformed product" in bad[5] and bad[6] == bad[7] == "malformed price"
    assert bad[9] == "malformed item" and bad[10] == "price must not be negative"
    assert bad[12] == "price is not a number" and bad[13] == "name is not text"
    assert bad[15] == "malformed availability"


def test_target_quantities(spark):
    def quantity(value):
        promise = {"availability": "AVAILABLE", "available_to_promise_quantity": value}
        return "TARGET", {"data": {"product": {"available_to_promise": promise}}}

    good, bad = outcome(spark, [quantity(v) for v in (5, 5.9, "7", "7.5", -5, None, " 8 ")])
    assert {i: r["quantity_available"] for i, r in good.items()} == {0: 5, 1: 5, 2: 7, 5: None, 6: 8}
    assert bad == {3: "quantity is not a number", 4: "quantity_available must not be negative"}


def test_walmart(spark):
    cases = [
        ("WALMART", {"availableOnline": True, "salePrice": 49.88, "upc": "0001"}),
        ("WALMART", {"availableOnline": False, "stock": "Available"}),
        ("WALMART", {"stock": "Available"}),
        ("WALMART", {"stock": "Not available"}),
        ("WALMART", {"stock": "PREORDER", "availableOnline": "true"}),
        ("WALMART", {"name": "x"}),
        ("WALMART", {}),
        ("WALMART", {"salePrice": None, "msrp": 10}),
        ("WALMART", {"msrp": 10}),
        ("WALMART", {"upc": 12}),
        ("WALMART", {"stock": 5}),
        ("WALMART", ["x"]),
        ("WALMART", {"name": None, "zip": 1}),
    ]
    good, bad = outcome(spark, cases)
    status = {i: r["inventory_status"] for i, r in good.items()}
    assert status == {
        0: "IN_STOCK", 1: "OUT_OF_STOCK", 2: "IN_STOCK", 3: "OUT_OF_STOCK", 4: "PREORDER",
        5: "UNKNOWN", 7: "UNKNOWN", 8: "UNKNOWN", 10: "UNKNOWN", 12: "UNKNOWN",
    }
    assert good[7]["price"] is None and good[8]["price"] == 10.0
    assert good[5]["product_name"] == "x" and good[12]["product_name"] == "Catalog WALMART"
    assert bad[6] == "empty response" and bad[9] == "upc is not text"
    assert "not an object" in bad[11]


def test_storefront(spark):
    def shop(**variant):
        return "POKEMON_CENTER", {"product": {"title": "Plush", "variants": [variant]}}

    cases = [
        shop(price="44.99", available=True, sku="PC-1"), shop(available=False), shop(available=None),
        shop(available="true"), shop(price="n/a"), shop(sku=5),
        ("POKEMON_CENTER", {}), ("POKEMON_CENTER", {"product": {"title": "x"}}),
        ("POKEMON_CENTER", {"product": {"variants": []}}),
        ("POKEMON_CENTER", {"product": {"variants": [None]}}),
        ("POKEMON_CENTER", {"product": {"variants": {"a": 1}}}),
        ("POKEMON_CENTER", {"product": {"variants": [{}, {"price": "1"}]}}),
        ("POKEMON_CENTER", {"product": ["x"]}),
    ]
    good, bad = outcome(spark, cases)
    assert {i: r["inventory_status"] for i, r in good.items()} == {
        0: "IN_STOCK", 1: "OUT_OF_STOCK", 2: "UNKNOWN", 3: "UNKNOWN", 7: "UNKNOWN",
        8: "UNKNOWN", 11: "UNKNOWN",
    }
    assert good[0]["price"] == 44.99 and good[0]["sku"] == "PC-1" and good[11]["price"] is None
    assert bad[4] == "price is not a number" and bad[5] == "sku is not text"
    assert bad[6] == "no product data" and bad[9] == bad[10] == "malformed variants"
    assert bad[12] == "malformed product"


def test_gamestop(spark):
    def game(availability, **rest):
        return "GAMESTOP", {"availability": availability, **rest}

    cases = [
        game({"isInStock": True}, pricing={"salePrice": 59.99, "listPrice": 1}),
        game({"isInStock": False, "isPreOrder": True}, pricing={"listPrice": 5}),
        game({"isPreOrder": True}, pricing={"salePrice": None, "listPrice": 5}),
        game(None), game(""), game("soon"), game({}, pricing=3), ("GAMESTOP", {}), game({}, sku="7"),
    ]
    good, bad = outcome(spark, cases)
    assert {i: r["inventory_status"] for i, r in good.items()} == {
        0: "IN_STOCK", 1: "OUT_OF_STOCK", 2: "PREORDER", 3: "UNKNOWN", 4: "UNKNOWN", 8: "UNKNOWN",
    }
    assert [good[i]["price"] for i in (0, 1, 2)] == [59.99, 5.0, None]
    assert bad == {5: "malformed availability", 6: "malformed pricing", 7: "empty response"}


def test_untracked_product_is_rejected(spark):
    examined = read(spark, [("WALMART", {"name": "x"})])
    lost = examined.withColumn("in_catalog", F.lit(None).cast("boolean"))
    assert lost.count() == 1
    payloads = read(spark, [("WALMART", {"name": "x"})]).select(
        "source", F.col("ingestion_run_id").alias("run_id"), F.lit("other").alias("retailer_product_id"),
        F.lit("2024-01-01").alias("observed_at"), "raw_response", "extracted_at",
    )
    catalog = spark.createDataFrame(
        CATALOG, "id string, retailer string, retailer_product_id string, name string, url string, "
        "category string, store_id string")
    reject = normalize.rejected(normalize.examine(payloads, catalog)).first()
    assert reject["reason"] == "product not in catalog" and reject["raw_excerpt"] == '{"name":"x"}'


@pytest.mark.parametrize(
    "received, good, bad, status",
    [(0, 0, 0, "FAILED"), (3, 0, 3, "FAILED"), (3, 2, 1, "PARTIAL_FAILURE"), (2, 2, 0, "SUCCESS")],
)
def test_run_status(spark, received, good, bad, status):
    got = spark.range(1).select(runs.run_status(F.lit(received), F.lit(good), F.lit(bad))).first()[0]
    assert got == status


def test_manifests_and_summaries(spark):
    examined = read(spark, [("WALMART", {})] * 12 + [("WALMART", {"name": "x"}), ("GAMESTOP", {"sku": "1"})])
    opened = spark.createDataFrame(
        [(f"run-{s}", s, datetime(2024, 1, 1), datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 2))
         for s in ("WALMART", "GAMESTOP", "TARGET")],
        "run_id string, source string, observed_at timestamp_ntz, started_at timestamp_ntz, "
        "completed_at timestamp_ntz",
    )
    books = runs.build_manifests(opened, examined)
    got = {r["source"]: r for r in books.collect()}
    assert got["WALMART"]["status"] == "PARTIAL_FAILURE" and len(got["WALMART"]["error_summary"]) == 10
    assert got["GAMESTOP"]["status"] == "SUCCESS" and got["TARGET"]["status"] == "FAILED"
    total = runs.ingestion_summary(books).first()
    assert (total["total_runs"], total["total_events"], total["total_rejected"], total["failed_runs"]) == (3, 2, 12, 1)
    assert total["success_rate"] == 66.7
    none = runs.ingestion_summary(books.where("false")).first()
    assert none["total_runs"] == 0 and none["success_rate"] == 0.0
    figures = runs.run_metrics(books, spark.createDataFrame([("TARGET",)], "retailer string")).first()
    assert figures["avg_run_duration_seconds"] == 2.0 and figures["sources_seen"] == 3
