"""Deduplicated observations and the histories derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflog.functions import day_of, hours_between
from shelflog.operators.dedup import latest_per_key
from shelflog.operators.series import HOT_ROWS, with_neighbour

SERIES = ["source", "retailer_product_id"]
OBSERVATION_COLUMNS = [
    "event_id",
    "source",
    "retailer_product_id",
    "product_name",
    "product_url",
    "sku",
    "upc",
    "category",
    "price",
    "currency",
    "inventory_status",
    "quantity_available",
    "store_id",
    "location_type",
    "observed_at",
    "extracted_at",
    "ingestion_run_id",
    "raw_file_path",
    "source_response_hash",
    "schema_version",
    "loaded_at",
]


def deduplicated(staged_events: DataFrame) -> DataFrame:
    """Latest loaded copy per event_id; equal load times fall back to extraction, then run."""
    observations = staged_events.withColumnRenamed("source_name", "source").select(
        *OBSERVATION_COLUMNS
    )
    return latest_per_key(
        observations, "event_id", ["loaded_at", "extracted_at", "ingestion_run_id"]
    )


def state_changes(observations: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each observation next to the one before it in its series."""
    rows = with_neighbour(
        observations.select("event_id", *SERIES, "observed_at", "inventory_status"),
        SERIES,
        "observed_at",
        "event_id",
        {"previous_status": "inventory_status", "previous_observed_at": "observed_at"},
        hot_rows=hot_rows,
    )
    before, now = F.col("previous_status"), F.col("inventory_status")
    return rows.select(
        "event_id",
        *SERIES,
        "observed_at",
        "previous_observed_at",
        "previous_status",
        now.alias("current_status"),
        (before.isNotNull() & ~before.eqNullSafe(now)).alias("status_changed"),
        (before.isNotNull() & (before != "IN_STOCK") & (now == "IN_STOCK")).alias("restocked"),
        # Three-valued on purpose: null when nothing came before and now is OUT_OF_STOCK.
        ((before == "IN_STOCK") & (now == "OUT_OF_STOCK")).alias("went_out_of_stock"),
        hours_between(F.col("previous_observed_at"), F.col("observed_at")).alias(
            "hours_since_previous_observation"
        ),
    )


def price_changes(observations: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each priced observation next to the priced one before it."""
    rows = with_neighbour(
        observations.where("price is not null").select(
            "event_id", *SERIES, "observed_at", "price"
        ),
        SERIES,
        "observed_at",
        "event_id",
        {"previous_price": "price", "previous_observed_at": "observed_at"},
        hot_rows=hot_rows,
    )
    before, now = F.col("previous_price"), F.col("price")
    return rows.select(
        "event_id",
        *SERIES,
        "observed_at",
        "previous_observed_at",
        "previous_price",
        now.alias("current_price"),
        (before.isNotNull() & (before != now)).alias("price_changed"),
        percent_change(before, now).alias("pct_change"),
    )


def percent_change(before, now):
    """Percent to two places; null without a previous price or after a price of zero."""
    return F.when(
        before != 0, F.round(F.lit(100).cast("decimal(3,0)") * (now - before) / before, 2)
    ).cast("double")


# Numbers of the statuses in the daily roll-up; 0 is no known status.
STATUS_ORDER = [None, "UNKNOWN", "BACKORDER", "PREORDER", "OUT_OF_STOCK", "IN_STOCK"]


def daily_inventory(observations: DataFrame) -> DataFrame:
    """Roll-up per series and day, last status of the day included, in one aggregation."""
    return finish_daily(daily_states(observations))


def daily_states(observations: DataFrame) -> DataFrame:
    """Sums, counts and the dated last status per series and day: what the roll-up is made of."""
    return observations.groupBy(*SERIES, day_of(F.col("observed_at")).alias("observation_date")).agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.count_if(F.col("inventory_status") == "IN_STOCK").alias("in_stock_observations"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("priced"),
        F.max("observed_at").alias("last_observed_at"),
        F.max(_dated_status()).alias("dated_status"),
    )


def finish_daily(states: DataFrame) -> DataFrame:
    statuses = F.array(*[F.lit(s).cast("string") for s in STATUS_ORDER])
    return states.select(
        *SERIES,
        "observation_date",
        "observation_count",
        "in_stock_observations",
        share_pct("in_stock_observations", "observation_count").alias("availability_pct"),
        "min_price",
        "max_price",
        (F.col("price_sum").cast("double") / F.nullif("priced", F.lit(0))).alias("avg_price"),
        "last_observed_at",
        F.get(statuses, F.pmod("dated_status", F.lit(8)).cast("int")).alias("last_status"),
    )


def source_days(states: DataFrame, day: str = "observed_date") -> DataFrame:
    """Per source and day the sum of its products' availability and their number."""
    # Shares have one decimal, so they are summed as decimals: exact in any order.
    share = share_pct("in_stock_observations", "observation_count").cast("decimal(4,1)")
    return states.groupBy("source", day).agg(F.sum(share).alias("share_sum"), F.count(share).alias("shares"))


def availability_of(days: DataFrame) -> DataFrame:
    """Mean over product-days from the partial sums of ``source_days``."""
    mean = F.sum("share_sum").cast("double") / F.nullif(F.sum("shares"), F.lit(0))
    return days.groupBy("source").agg(mean.alias("avg_availability_pct"))


def _dated_status():
    """Time and status in one whole number, so that the latest is found by a hash aggregate.

    At equal times the status later in ``STATUS_ORDER`` counts.
    """
    code = F.lit(0)
    for place, status in enumerate(STATUS_ORDER):
        if status:
            code = F.when(F.col("inventory_status") == status, place).otherwise(code)
    instant = F.unix_micros(F.col("observed_at").cast("timestamp"))
    return F.coalesce(instant, F.lit(-(1 << 59))) * 8 + code


def share_pct(part, whole):
    """Percent to one place; null for an empty whole."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    # Decimal until rounded, so halves round away from zero.
    hundred = F.lit(100).cast("decimal(3,0)")
    return F.round(
        hundred * part.cast("decimal(18,0)") / F.nullif(whole.cast("decimal(18,0)"), F.lit(0)), 1
    ).cast("double")
