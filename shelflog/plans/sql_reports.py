"""The reports as SQL text over views of the models, with bound arguments.

Each text gives the rows of the function of the same name in ``reports``. Values never become
part of a text: days, keys and lists are bound by name, so quotes in them are harmless.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.plans.reports import DAY, STATE_CHANGE_LIMIT

FACTS = ("fact_inventory_observation", "fact_inventory_state_change", "fact_price_observation")

_SPAN = f"""{DAY} BETWEEN :first_day AND :last_day
  AND observed_at BETWEEN CAST(:first_day AS TIMESTAMP_NTZ) AND CAST(:last_day AS TIMESTAMP_NTZ)"""


def _chosen(column: str, name: str) -> str:
    return f"(NOT :has_{name} OR array_contains(:{name}, {column}))"


def _mean_share() -> str:
    return "CAST(sum(CAST(availability_pct AS DECIMAL(4,1))) AS DOUBLE) / nullif(count(availability_pct), 0)"


TEXTS = {
    "overview_totals": """
SELECT sum(total_events_normalized) AS total_observations, sum(total_events_rejected) AS total_rejected,
       sum(total_runs) AS total_runs, sum(failed_runs) AS total_failed_runs,
       CAST(round(CAST(100 AS DECIMAL(3,0)) * CAST(sum(successful_runs + partial_failure_runs) AS DECIMAL(18,0))
            / nullif(CAST(sum(total_runs) AS DECIMAL(18,0)), 0), 1) AS DOUBLE) AS overall_success_rate_pct,
       max(last_observed_at) AS latest_observed_at, avg(avg_availability_pct) AS avg_availability_pct
FROM mart_retailer_summary""",
    "retailer_summary": f"""
SELECT * EXCEPT (retailer_key) FROM mart_retailer_summary
WHERE {_chosen("source", "retailers")} ORDER BY source NULLS LAST""",
    "retailers": """
SELECT source, retailer_name FROM dim_retailer ORDER BY retailer_name NULLS LAST""",
    "products": f"""
SELECT product_key, source, product_name, category FROM dim_product
WHERE {_chosen("source", "retailers")} ORDER BY product_name NULLS LAST, product_key""",
    "availability_by_product": f"""
SELECT product_key, source, product_name, category, {_mean_share()} AS avg_availability_pct,
       max(observation_date) AS last_observation_date, sum(observation_count) AS total_observations
FROM mart_daily_product_availability
WHERE observation_date BETWEEN :first_day AND :last_day
  AND {_chosen("source", "retailers")} AND {_chosen("product_key", "products")}
GROUP BY ALL ORDER BY avg_availability_pct NULLS LAST, product_key, source""",
    "availability_timeline": """
SELECT observation_date, availability_pct, last_status, avg_price FROM mart_daily_product_availability
WHERE product_key = :product AND observation_date BETWEEN :first_day AND :last_day
ORDER BY observation_date NULLS LAST""",
    "price_history": f"""
SELECT observed_at, current_price, previous_price, price_changed, pct_change FROM fact_price_observation
WHERE {_SPAN} AND product_key = :product ORDER BY observed_at NULLS LAST""",
    "recent_state_changes": f"""
WITH newest AS (
  SELECT * FROM fact_inventory_state_change WHERE {_SPAN} AND {_chosen("source", "retailers")}
  ORDER BY observed_at DESC NULLS FIRST, state_change_event_id DESC LIMIT {STATE_CHANGE_LIMIT})
SELECT observed_at, newest.source, product_name, previous_status, current_status, restocked, went_out_of_stock
FROM newest LEFT JOIN dim_product USING (product_key)
ORDER BY observed_at DESC NULLS FIRST, state_change_event_id DESC""",
    "daily_observation_volume": f"""
SELECT CAST(observed_at AS DATE) AS observation_date, source, count(*) AS observations
FROM fact_inventory_observation WHERE {_SPAN} AND {_chosen("source", "retailers")}
GROUP BY ALL ORDER BY observation_date NULLS LAST, source""",
}


def register_views(models: Mapping[str, DataFrame]) -> None:
    """Make models views under their names; facts show the day they are partitioned by."""
    for name, model in models.items():
        if name in FACTS and DAY not in model.columns:
            model = model.withColumn(DAY, F.to_date("observed_at"))
        model.createOrReplaceTempView(name)


def _list(values: list[str] | None) -> Column:
    return F.array(*[F.lit(v) for v in values or [""]])


def report(
    spark: SparkSession,
    name: str,
    first_day: date | None = None,
    last_day: date | None = None,
    product: str | None = None,
    retailers: list[str] | None = None,
    products: list[str] | None = None,
) -> DataFrame:
    """Run the text of a report; an empty or missing list means no filter."""
    values = {
        "first_day": first_day,
        "last_day": last_day,
        "product": product,
        "retailers": _list(retailers),
        "has_retailers": bool(retailers),
        "products": _list(products),
        "has_products": bool(products),
    }
    text = TEXTS[name]
    return spark.sql(text, args={k: v for k, v in values.items() if f":{k}" in text})
