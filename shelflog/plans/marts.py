"""Star schema: dimensions, facts and summary marts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.functions import day_of, hours_between, surrogate_key
from shelflog.plans.intermediate import share_pct

# Fixed value: first day of the calendar.
CALENDAR_START = date(2024, 1, 1)


def as_moment(as_of: datetime | None):
    """The reporting clock as a UTC wall clock; the session's now if none is given."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def dim_date(spark: SparkSession, as_of: datetime | None = None) -> DataFrame:
    """Days from CALENDAR_START up to, not including, one year after ``as_of``."""
    last = F.date_sub(F.add_months(day_of(as_moment(as_of)), 12), 1)
    days = F.sequence(F.lit(CALENDAR_START), last, F.expr("interval 1 day"))
    return calendar(spark.range(1).select(F.explode(days).alias("date_day")))


def observed_calendar(observations: DataFrame) -> DataFrame:
    """All days from the first to the last observation."""
    day = day_of(F.col("observed_at"))
    span = observations.agg(F.min(day).alias("first"), F.max(day).alias("last")).where("first is not null")
    days = F.sequence("first", "last", F.expr("interval 1 day"))
    return calendar(span.select(F.explode(days).alias("date_day")))


def calendar(days: DataFrame) -> DataFrame:
    """The attributes of each ``date_day``."""
    day = F.col("date_day")
    sunday_based = F.dayofweek(day) - 1
    return days.select(
        "date_day",
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day_of_month"),
        sunday_based.alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        sunday_based.isin(0, 6).alias("is_weekend"),
    )


def dim_product(staged_products: DataFrame) -> DataFrame:
    return staged_products.select(
        surrogate_key(F.col("retailer"), F.col("retailer_product_id")).alias("product_key"),
        "product_id",
        F.col("retailer").alias("source"),
        "retailer_product_id",
        "product_name",
        "product_url",
        "category",
        "store_id",
    )


def dim_retailer(staged_retailers: DataFrame) -> DataFrame:
    return staged_retailers.select(
        surrogate_key(F.col("retailer_code")).alias("retailer_key"),
        F.col("retailer_code").alias("source"),
        "retailer_name",
        "website",
        "integration_mode",
    )


def attach_product(df: DataFrame, products: DataFrame, *attributes: str) -> DataFrame:
    """Left join on the natural product key.

    The catalog grows with the business, so there is no broadcast hint: Spark broadcasts it
    while its measured size is below the threshold and else sort-merges, where AQE splits
    the partition of a hot product.
    """
    wanted = products.select("source", "retailer_product_id", "product_key", *attributes)
    return df.join(wanted, ["source", "retailer_product_id"], "left")


def attach_retailer(df: DataFrame, retailers: DataFrame) -> DataFrame:
    return df.join(retailers.select("source", "retailer_key"), "source", "left")


def attach_date(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Left join on the day. The calendar has some hundred rows a year, so broadcast it."""
    wanted = F.broadcast(dates.select("date_day", "date_key"))
    return df.join(wanted, day_of(F.col("observed_at")) == F.col("date_day"), "left")


def _with_dimensions(
    df: DataFrame, products: DataFrame, retailers: DataFrame, dates: DataFrame
) -> DataFrame:
    return attach_date(attach_retailer(attach_product(df, products), retailers), dates)


def fact_inventory_observation(
    observations: DataFrame, products: DataFrame, retailers: DataFrame, dates: DataFrame
) -> DataFrame:
    measures = observations.select(
        "event_id",
        "source",
        "retailer_product_id",
        "price",
        "currency",
        "inventory_status",
        "quantity_available",
        "store_id",
        "location_type",
        "observed_at",
        "extracted_at",
        "ingestion_run_id",
    )
    return _with_dimensions(measures, products, retailers, dates).select(
        "event_id", "product_key", "retailer_key", "date_key", *measures.columns[1:]
    )


def fact_inventory_state_change(
    changes: DataFrame, products: DataFrame, retailers: DataFrame, dates: DataFrame
) -> DataFrame:
    moved = changes.where("status_changed")
    return _with_dimensions(moved, products, retailers, dates).select(
        F.col("event_id").alias("state_change_event_id"),
        "product_key",
        "retailer_key",
        "date_key",
        "source",
        "retailer_product_id",
        "previous_status",
        "current_status",
        "restocked",
        "went_out_of_stock",
        "previous_observed_at",
        "observed_at",
        "hours_since_previous_observation",
    )


def fact_price_observation(
    prices: DataFrame, products: DataFrame, retailers: DataFrame, dates: DataFrame
) -> DataFrame:
    return _with_dimensions(prices, products, retailers, dates).select(
        "event_id",
        "product_key",
        "retailer_key",
        "date_key",
        "source",
        "retailer_product_id",
        "previous_price",
        "current_price",
        "price_changed",
        "pct_change",
        "previous_observed_at",
        "observed_at",
    )


def mart_daily_product_availability(
    daily: DataFrame, products: DataFrame, retailers: DataFrame
) -> DataFrame:
    joined = attach_product(daily, products, "product_name", "category")
    return attach_retailer(joined, retailers).select(
        "product_key",
        "retailer_key",
        "source",
        "retailer_product_id",
        "product_name",
        "category",
        "observation_date",
        "observation_count",
        "in_stock_observations",
        "availability_pct",
        "min_price",
        "max_price",
        "avg_price",
        "last_status",
        "last_observed_at",
    )


def run_statistics(staged_runs: DataFrame) -> DataFrame:
    status = F.col("status")
    return staged_runs.groupBy(F.col("source_name").alias("source")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(status == "SUCCESS").alias("successful_runs"),
        F.count_if(status == "PARTIAL_FAILURE").alias("partial_failure_runs"),
        F.count_if(status == "FAILED").alias("failed_runs"),
        F.sum("events_normalized").alias("total_events_normalized"),
        F.sum("events_rejected").alias("total_events_rejected"),
        F.avg("duration_seconds").alias("avg_run_duration_seconds"),
        F.max("observed_at").alias("last_observed_at"),
    )


def source_availability(daily: DataFrame) -> DataFrame:
    """Mean over product-days, each counting once.

    Shares have one decimal, so they are summed as decimals: exact in any order.
    """
    share = F.col("availability_pct").cast("decimal(4,1)")
    return daily.groupBy("source").agg(
        (F.sum(share).cast("double") / F.nullif(F.count(share), F.lit(0))).alias(
            "avg_availability_pct"
        )
    )


def mart_retailer_summary(
    retailers: DataFrame,
    staged_runs: DataFrame,
    daily: DataFrame | None,
    as_of: datetime | None = None,
    availability: DataFrame | None = None,
) -> DataFrame:
    """One row per retailer; ``availability`` stands in for ``daily`` where it is known already."""
    availability = source_availability(daily) if availability is None else availability
    good = F.col("successful_runs") + F.col("partial_failure_runs")
    return (
        retailers.join(run_statistics(staged_runs), "source", "left")
        .join(availability, "source", "left")
        .select(
            "retailer_key",
            "source",
            "retailer_name",
            "integration_mode",
            "total_runs",
            "successful_runs",
            "partial_failure_runs",
            "failed_runs",
            share_pct(good, "total_runs").alias("run_success_rate_pct"),
            "total_events_normalized",
            "total_events_rejected",
            "avg_run_duration_seconds",
            "last_observed_at",
            hours_between(F.col("last_observed_at"), as_moment(as_of)).alias(
                "hours_since_last_observation"
            ),
            "avg_availability_pct",
        )
    )
