"""Staging: rename, cast and standardise raw tables; same grain as the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflog.functions import code_or_default, one_of, seconds_between, std_code
from shelflog.schemas import RUN_STATUSES, STATUSES


def stage_events(raw_events: DataFrame) -> DataFrame:
    return raw_events.select(
        "event_id",
        std_code(F.col("source")).alias("source_name"),
        "retailer_product_id",
        "product_name",
        "product_url",
        "sku",
        "upc",
        "category",
        F.expr("try_cast(price as decimal(12,2))").alias("price"),
        code_or_default(F.col("currency"), "USD").alias("currency"),
        one_of(F.col("inventory_status"), STATUSES[:4]).alias("inventory_status"),
        "quantity_available",
        "store_id",
        code_or_default(F.col("location_type"), "UNKNOWN").alias("location_type"),
        "observed_at",
        "extracted_at",
        "ingestion_run_id",
        "raw_file_path",
        "source_response_hash",
        "schema_version",
        "raw_payload",
        "loaded_at",
    )


def stage_runs(raw_runs: DataFrame) -> DataFrame:
    return raw_runs.select(
        "run_id",
        std_code(F.col("source")).alias("source_name"),
        "observed_at",
        "started_at",
        "completed_at",
        seconds_between(F.col("started_at"), F.col("completed_at")).alias("duration_seconds"),
        one_of(F.col("status"), RUN_STATUSES).alias("status"),
        "payloads_received",
        "events_normalized",
        "events_rejected",
        "raw_payload_path",
        "normalized_output_path",
        "manifest_path",
        "error_summary",
        "pipeline_version",
        "loaded_at",
    )


def stage_products(seed: DataFrame) -> DataFrame:
    return seed.select(
        "product_id",
        std_code(F.col("retailer")).alias("retailer"),
        "retailer_product_id",
        "product_name",
        "product_url",
        "category",
        "store_id",
    )


def stage_retailers(seed: DataFrame) -> DataFrame:
    return seed.select(
        std_code(F.col("retailer_code")).alias("retailer_code"),
        "retailer_name",
        "website",
        std_code(F.col("integration_mode")).alias("integration_mode"),
    )
