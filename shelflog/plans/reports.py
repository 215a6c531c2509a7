"""Report queries over the marts: parameters in, DataFrame out.

Empty or missing selections mean no filter. Days compared with times follow SQL: an end
day means its midnight.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflog.functions import day_of
from shelflog.operators.series import HOT_ROWS, with_neighbour
from shelflog.plans.intermediate import share_pct
from shelflog.session import materialize

STALE_AFTER_HOURS = 26
STATE_CHANGE_LIMIT = 500
LOWEST_LIMIT = 20
# The day column that warehouse tables of facts are partitioned by.
DAY = "observed_date"


def among(column: str, selected: list | None) -> Column:
    """Membership test of a value list of any length; always true for an empty one."""
    return F.col(column).isin(list(selected)) if selected else F.lit(True)


def overview_totals(retailer_summary: DataFrame) -> DataFrame:
    good = F.sum(F.col("successful_runs") + F.col("partial_failure_runs"))
    return retailer_summary.agg(
        F.sum("total_events_normalized").alias("total_observations"),
        F.sum("total_events_rejected").alias("total_rejected"),
        F.sum("total_runs").alias("total_runs"),
        F.sum("failed_runs").alias("total_failed_runs"),
        share_pct(good, F.sum("total_runs")).alias("overall_success_rate_pct"),
        F.max("last_observed_at").alias("latest_observed_at"),
        F.avg("avg_availability_pct").alias("avg_availability_pct"),
    )


def retailer_summary(summary: DataFrame, retailers: list[str] | None = None) -> DataFrame:
    return (
        summary.where(among("source", retailers))
        .select(
            "source",
            "retailer_name",
            "integration_mode",
            "total_runs",
            "successful_runs",
            "partial_failure_runs",
            "failed_runs",
            "run_success_rate_pct",
            "total_events_normalized",
            "total_events_rejected",
            "avg_run_duration_seconds",
            "last_observed_at",
            "hours_since_last_observation",
            "avg_availability_pct",
        )
        .orderBy(F.col("source").asc_nulls_last())
    )


def retailers(dim_retailer: DataFrame) -> DataFrame:
    return dim_retailer.select("source", "retailer_name").orderBy(
        F.col("retailer_name").asc_nulls_last()
    )


def products(dim_product: DataFrame, selected_retailers: list[str] | None = None) -> DataFrame:
    return (
        dim_product.where(among("source", selected_retailers))
        .select("product_key", "source", "product_name", "category")
        .orderBy(F.col("product_name").asc_nulls_last(), "product_key")
    )


def availability_by_product(
    mart_daily: DataFrame,
    start: date,
    end: date,
    selected_retailers: list[str] | None = None,
    selected_products: list[str] | None = None,
) -> DataFrame:
    """Mean daily availability, worst first. Shares have one decimal: summed exactly."""
    share = F.col("availability_pct").cast("decimal(4,1)")
    return (
        mart_daily.where(F.col("observation_date").between(F.lit(start), F.lit(end)))
        .where(among("source", selected_retailers))
        .where(among("product_key", selected_products))
        .groupBy("product_key", "source", "product_name", "category")
        .agg(
            (F.sum(share).cast("double") / F.nullif(F.count(share), F.lit(0))).alias(
                "avg_availability_pct"
            ),
            F.max("observation_date").alias("last_observation_date"),
            F.sum("observation_count").alias("total_observations"),
        )
        .orderBy(F.col("avg_availability_pct").asc_nulls_last(), "product_key", "source")
    )


def lowest_availability(by_product: DataFrame, limit: int = LOWEST_LIMIT) -> DataFrame:
    return by_product.orderBy(
        F.col("avg_availability_pct").asc_nulls_last(), "product_key", "source"
    ).limit(limit)


def availability_timeline(
    mart_daily: DataFrame, product_key: str, start: date, end: date
) -> DataFrame:
    return (
        mart_daily.where(F.col("product_key") == product_key)
        .where(F.col("observation_date").between(F.lit(start), F.lit(end)))
        .select("observation_date", "availability_pct", "last_status", "avg_price")
        .orderBy(F.col("observation_date").asc_nulls_last())
    )


def within(facts: DataFrame, start: date, end: date) -> DataFrame:
    """Rows observed from ``start`` to midnight of ``end``.

    On a fact table of the warehouse, which is partitioned by day, other days' files are
    not opened.
    """
    first, last = (F.lit(day).cast("timestamp_ntz") for day in (start, end))
    rows = facts.where(F.col("observed_at").between(first, last))
    return rows.where(F.col(DAY).between(F.lit(start), F.lit(end))) if DAY in facts.columns else rows


def price_history(fact_price: DataFrame, product_key: str, start: date, end: date) -> DataFrame:
    return (
        within(fact_price, start, end)
        .where(F.col("product_key") == product_key)
        .select("observed_at", "current_price", "previous_price", "price_changed", "pct_change")
        .orderBy(F.col("observed_at").asc_nulls_last())
    )


def price_change_points(history: DataFrame) -> DataFrame:
    return history.where("price_changed")


def recent_state_changes(
    fact_state_change: DataFrame,
    dim_product: DataFrame,
    start: date,
    end: date,
    selected_retailers: list[str] | None = None,
    limit: int = STATE_CHANGE_LIMIT,
) -> DataFrame:
    """The newest transitions. The top rows are taken before the product names are joined:
    product keys are unique, so the join neither adds nor drops rows."""
    newest = (
        within(fact_state_change, start, end)
        .where(among("source", selected_retailers))
        .orderBy(F.col("observed_at").desc_nulls_first(), F.col("state_change_event_id").desc())
        .limit(limit)
    )
    names = dim_product.select("product_key", "product_name")
    return (
        newest.join(names, "product_key", "left")
        .orderBy(F.col("observed_at").desc_nulls_first(), F.col("state_change_event_id").desc())
        .select(
            "observed_at",
            "source",
            "product_name",
            "previous_status",
            "current_status",
            "restocked",
            "went_out_of_stock",
        )
    )


def transition_totals(recent: DataFrame) -> DataFrame:
    """Restocks and stock-outs among the rows given: the rows shown, or all of ``within``."""
    return recent.agg(
        F.count_if("restocked").alias("restocks"),
        F.count_if("went_out_of_stock").alias("stock_outs"),
    )


def daily_observation_volume(
    fact_observation: DataFrame,
    start: date,
    end: date,
    selected_retailers: list[str] | None = None,
) -> DataFrame:
    return (
        within(fact_observation, start, end)
        .where(among("source", selected_retailers))
        .groupBy(day_of(F.col("observed_at")).alias("observation_date"), "source")
        .agg(F.count(F.lit(1)).alias("observations"))
        .orderBy(F.col("observation_date").asc_nulls_last(), "source")
    )


def stale_sources(summary: DataFrame, hours: int = STALE_AFTER_HOURS) -> DataFrame:
    return summary.where(F.col("hours_since_last_observation") > hours).select(
        "source", "hours_since_last_observation"
    )


def outages(fact_state_change: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """From each stock-out to the next restock per product; the end is null while it lasts.

    Only transitions into OUT_OF_STOCK and into IN_STOCK count. Of several stock-outs in a
    row the first starts the outage. The lookups split hot products.
    """
    keys = ["source", "retailer_product_id"]
    status = F.col("current_status")
    moves = fact_state_change.where(status.isin("OUT_OF_STOCK", "IN_STOCK")).select(
        "state_change_event_id", "product_key", *keys, "observed_at", "current_status"
    )
    marked = with_neighbour(
        moves, keys, "observed_at", "state_change_event_id",
        {"before": "current_status"}, hot_rows=hot_rows,
    )
    # What is left alternates between starts and ends. It is written once, as the second
    # lookup scans it several times.
    turns = materialize(
        marked.where(
            F.when(
                status == "OUT_OF_STOCK", F.coalesce(F.col("before") == "IN_STOCK", F.lit(True))
            ).otherwise(F.col("before") == "OUT_OF_STOCK")
        ).drop("before"),
        "outage-turns",
    )
    closed = with_neighbour(
        turns, keys, "observed_at", "state_change_event_id",
        {"outage_end": "observed_at"}, following=True, hot_rows=hot_rows,
    )
    seconds = F.timestamp_diff("SECOND", F.col("observed_at"), F.col("outage_end"))
    return closed.where(status == "OUT_OF_STOCK").select(
        "product_key",
        *keys,
        F.col("observed_at").alias("outage_start"),
        "outage_end",
        seconds.alias("outage_seconds"),
    )


def last_restocks(fact_state_change: DataFrame) -> DataFrame:
    """Newest transition into IN_STOCK per product."""
    return (
        fact_state_change.where("restocked")
        .groupBy("product_key", "source", "retailer_product_id")
        .agg(F.max("observed_at").alias("last_restocked_at"))
    )
