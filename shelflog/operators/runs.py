"""Run books: one manifest per ingestion run, and figures over many of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASONS_KEPT = 10


def run_status(received: Column, normalized: Column, rejected: Column) -> Column:
    return (
        F.when((received == 0) | (normalized == 0), F.lit("FAILED"))
        .when(rejected > 0, F.lit("PARTIAL_FAILURE"))
        .otherwise(F.lit("SUCCESS"))
    )


def first_reasons(examined: DataFrame, limit: int = REASONS_KEPT) -> DataFrame:
    """The first ``limit`` reject reasons per run, by product.

    Ranking first cuts every run to ``limit`` rows before the shuffle, so the list stays
    short whatever the size of the run.
    """
    order = Window.partitionBy("ingestion_run_id").orderBy("retailer_product_id", "reason", "observed_at")
    return (
        examined.where("reason <> ''")
        .select("ingestion_run_id", "retailer_product_id", "observed_at", "reason")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= limit)
        .groupBy("ingestion_run_id")
        .agg(F.sort_array(F.collect_list(F.struct("_n", "reason"))).alias("_kept"))
        .select("ingestion_run_id", F.col("_kept.reason").alias("error_summary"))
    )


def build_manifests(
    runs: DataFrame,
    examined: DataFrame,
    pipeline_version: str = "0.1.0",
    reasons_kept: int = REASONS_KEPT,
) -> DataFrame:
    """``runs`` (run_id, source, observed_at, started_at, completed_at) with their outcome.

    A run that received nothing has no rows in ``examined`` and counts as failed.
    """
    good = F.col("reason") == ""
    counts = examined.groupBy("ingestion_run_id").agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(good).alias("normalized"),
        F.count_if(~good).alias("rejected"),
    )
    outcome = counts.join(first_reasons(examined, reasons_kept), "ingestion_run_id", "left").withColumnRenamed(
        "ingestion_run_id", "run_id"
    )
    received = F.coalesce("received", F.lit(0))
    normalized = F.coalesce("normalized", F.lit(0))
    rejected = F.coalesce("rejected", F.lit(0))
    return runs.join(outcome, "run_id", "left").select(
        "run_id",
        "source",
        "observed_at",
        "started_at",
        "completed_at",
        run_status(received, normalized, rejected).alias("status"),
        received.alias("payloads_received"),
        normalized.alias("events_normalized"),
        rejected.alias("events_rejected"),
        F.coalesce("error_summary", F.array().cast("array<string>")).alias("error_summary"),
        F.lit(pipeline_version).alias("pipeline_version"),
    )


def _rate(good: Column, runs: Column) -> Column:
    share = F.lit(100).cast("decimal(3,0)") * good.cast("decimal(18,0)")
    return F.coalesce(
        F.round(share / F.nullif(runs.cast("decimal(18,0)"), F.lit(0)), 1).cast("double"),
        F.lit(0.0),
    )


def ingestion_summary(manifests: DataFrame) -> DataFrame:
    """Totals over a set of runs; one row, zeros when there are none."""
    failed = F.col("status") == "FAILED"
    return manifests.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.coalesce(F.sum("events_normalized"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("events_rejected"), F.lit(0)).alias("total_rejected"),
        F.count_if(failed).alias("failed_runs"),
    ).withColumn(
        "success_rate", _rate(F.col("total_runs") - F.col("failed_runs"), F.col("total_runs"))
    )


def run_metrics(manifests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Observability figures of all manifests, with the size of the catalog; one row."""
    status = F.coalesce("status", F.lit(""))
    seconds = (
        F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at")) / 1_000_000
    )
    figures = manifests.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(status == "SUCCESS").alias("successful_runs"),
        F.count_if(status == "PARTIAL_FAILURE").alias("partial_failure_runs"),
        F.count_if(~status.isin("SUCCESS", "PARTIAL_FAILURE")).alias("failed_runs"),
        F.coalesce(F.sum("events_normalized"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("events_rejected"), F.lit(0)).alias("total_rejected"),
        F.count_distinct("source").alias("sources_seen"),
        F.min("observed_at").alias("observed_at_min"),
        F.max("observed_at").alias("observed_at_max"),
        F.round(F.avg(seconds), 3).alias("avg_run_duration_seconds"),
    ).withColumn(
        "success_rate_pct",
        _rate(F.col("successful_runs") + F.col("partial_failure_runs"), F.col("total_runs")),
    )
    tracked = catalog.agg(
        F.count(F.lit(1)).alias("products_tracked"),
        F.count_distinct("retailer").alias("retailers_tracked"),
    )
    # Two single rows become one by an aggregate over their union; no join is needed.
    both = figures.unionByName(tracked, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
