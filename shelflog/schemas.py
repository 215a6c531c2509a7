"""Column contracts of the landing files and the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted codes.
SOURCES = ["TARGET", "WALMART", "POKEMON_CENTER", "GAMESTOP"]
STATUSES = ["IN_STOCK", "OUT_OF_STOCK", "PREORDER", "BACKORDER", "UNKNOWN"]
LOCATIONS = ["ONLINE", "IN_STORE", "UNKNOWN"]
RUN_STATUSES = ["SUCCESS", "PARTIAL_FAILURE", "FAILED"]

PRICE = T.DecimalType(12, 2)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "price": PRICE,
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """``name type, ...``; parsing real DDL would need a running session at import time."""
    fields = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Columns of the raw tables.
INVENTORY_EVENTS = _schema(
    "event_id string, source string, retailer_product_id string, product_name string, "
    "product_url string, sku string, upc string, category string, price price, "
    "currency string, inventory_status string, quantity_available bigint, store_id string, "
    "location_type string, observed_at timestamp_ntz, extracted_at timestamp_ntz, "
    "ingestion_run_id string, raw_file_path string, source_response_hash string, "
    "schema_version string, raw_payload string, loaded_at timestamp_ntz"
)
INGESTION_RUNS = _schema(
    "run_id string, source string, observed_at timestamp_ntz, started_at timestamp_ntz, "
    "completed_at timestamp_ntz, status string, payloads_received bigint, "
    "events_normalized bigint, events_rejected bigint, raw_payload_path string, "
    "normalized_output_path string, manifest_path string, error_summary string, "
    "pipeline_version string, loaded_at timestamp_ntz"
)



def with_variant(schema: T.StructType, name: str) -> T.StructType:
    """``schema`` with the JSON text of column ``name`` kept parsed."""
    return T.StructType([T.StructField(f.name, T.VariantType()) if f.name == name else f for f in schema])


# Columns of the landing files, one JSON document per line; times are ISO-8601 text.
LANDED_EVENT = _schema(
    "event_id string, source string, retailer_product_id string, product_name string, "
    "product_url string, sku string, upc string, category string, price double, "
    "currency string, inventory_status string, quantity_available bigint, store_id string, "
    "location_type string, observed_at string, extracted_at string, "
    "ingestion_run_id string, raw_file_path string, source_response_hash string, "
    "schema_version string"
)
LANDED_PAYLOAD = _schema(
    "retailer_product_id string, observed_at string, raw_response variant"
)
LANDED_REJECT = _schema(
    "source string, reason string, retailer_product_id string, raw_excerpt string, "
    "occurred_at string"
)
LANDED_MANIFEST = _schema(
    "run_id string, source string, observed_at string, started_at string, "
    "completed_at string, status string, payloads_received bigint, "
    "events_normalized bigint, events_rejected bigint, raw_payload_path string, "
    "normalized_output_path string, manifest_path string, "
    "content_hashes map<string,string>, error_summary array<string>, pipeline_version string"
)

# Directory levels of the landing zone. Kept as text: month=01 must not become 1.
PARTITIONS = _schema(
    "source string, year string, month string, day string, run_id string"
)

PRODUCT_CATALOG = _schema(
    "id string, retailer string, retailer_product_id string, name string, url string, "
    "category string, store_id string"
)
PRODUCT_SEED = _schema(
    "product_id string, retailer string, retailer_product_id string, product_name string, "
    "product_url string, category string, store_id string"
)
RETAILER_SEED = _schema(
    "retailer_code string, retailer_name string, website string, integration_mode string"
)
