"""Deterministic identifiers and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflog.functions.times import iso_utc

# The UUID namespace of observation ids and the stand-in for a null key part.
EVENT_NAMESPACE = "6f8f2c2e-9b1d-4b1a-9b3a-1f7d9e6a0c11"
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def event_id(source: Column, retailer_product_id: Column, observed_at: Column) -> Column:
    """Name-based UUID (version 5, RFC 4122) of one observation."""
    name = F.concat(source, F.lit(":"), retailer_product_id, F.lit(":"), iso_utc(observed_at))
    namespace = F.unhex(F.lit(EVENT_NAMESPACE.replace("-", "")))
    digest = F.sha1(F.concat(namespace, F.encode(name, "UTF-8")))
    # The variant nibble keeps its low two bits and gets the high bits 10.
    variant = F.translate(
        F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the dash-joined parts. ``concat_ws`` would skip nulls, so they are named."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("-"))
        pieces.append(F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)))
    return F.md5(F.concat(*pieces))


def payload_hash(payload: Column) -> Column:
    """SHA-256 of a VARIANT's text, whose object keys come out sorted at every level."""
    return F.sha2(F.to_json(payload), 256)
