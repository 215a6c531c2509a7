"""Builds the whole warehouse under one folder.

Staging stays a view; the deduplicated table is incremental; histories, dimensions, facts
and marts are written as tables so that each is computed once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.operators import staging
from shelflog.operators.quality import Watch
from shelflog.plans import intermediate, marts
from shelflog.operators.merge import read_table
from shelflog.plans.load import DAY, OBSERVATIONS, refresh_observations
from shelflog.session import lean_disk


def write_table(
    df: DataFrame, path: str, day: str | None = None, last: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Write ``df`` and read it back; by ``day`` in folders, each sorted by product.

    A missing ``day`` column is taken from ``observed_at`` and stays in the table. ``last`` is
    applied to the rows as they are written.
    """
    if day is None:
        last(df).write.mode("overwrite").parquet(path)
    else:
        if day not in df.columns:
            df = df.withColumn(day, F.to_date("observed_at"))
        laid = df.hint("rebalance", day).sortWithinPartitions(day, "product_key")
        last(laid).write.partitionBy(day).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def build_warehouse(
    spark: SparkSession,
    folder: str,
    raw_events: DataFrame,
    raw_runs: DataFrame,
    product_seed: DataFrame,
    retailer_seed: DataFrame,
    as_of: datetime | None = None,
    watch: Watch | None = None,
) -> dict[str, DataFrame]:
    """Write every model and return all of them by name, tables read back.

    ``watch`` counts its row rules of the tables written here in the writing jobs. The
    observations are merged into their table, so their rules stay with ``run_checks``.
    """
    models: dict[str, DataFrame] = {
        "inventory_events": raw_events,
        "ingestion_runs": raw_runs,
        "seed_products": product_seed,
        "seed_retailers": retailer_seed,
        "stg_inventory_events": staging.stage_events(raw_events),
        "stg_ingestion_runs": staging.stage_runs(raw_runs),
        "stg_products": staging.stage_products(product_seed),
        "stg_retailers": staging.stage_retailers(retailer_seed),
    }

    def table(name: str, df: DataFrame, day: str | None = None) -> DataFrame:
        last = (lambda rows: watch.on(name, rows)) if watch else (lambda rows: rows)
        models[name] = write_table(df, f"{folder}/{name}", day, last)
        return models[name]

    with lean_disk(spark):
        name = "int_inventory_events_deduplicated"
        refresh_observations(models["stg_inventory_events"], f"{folder}/{name}")
        observations = read_table(spark, f"{folder}/{name}", OBSERVATIONS).drop(DAY)
        models[name] = observations

        changes = table("int_inventory_state_changes", intermediate.state_changes(observations))
        prices = table("int_product_price_changes", intermediate.price_changes(observations))
        daily = table("int_product_daily_inventory", intermediate.daily_inventory(observations))
        dims = (
            table("dim_product", marts.dim_product(models["stg_products"])),
            table("dim_retailer", marts.dim_retailer(models["stg_retailers"])),
            table("dim_date", marts.dim_date(spark, as_of)),
        )
        table("fact_inventory_observation", marts.fact_inventory_observation(observations, *dims), DAY)
        table("fact_inventory_state_change", marts.fact_inventory_state_change(changes, *dims), DAY)
        table("fact_price_observation", marts.fact_price_observation(prices, *dims), DAY)
        table(
            "mart_daily_product_availability",
            marts.mart_daily_product_availability(daily, *dims[:2]),
            "observation_date",
        )
        table(
            "mart_retailer_summary",
            marts.mart_retailer_summary(dims[1], models["stg_ingestion_runs"], daily, as_of),
        )
    return models
