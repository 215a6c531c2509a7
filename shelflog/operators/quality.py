"""Declarative data checks. A check counts offending rows; none means it passed."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelflog.plans.marts import as_moment
from shelflog.schemas import RUN_STATUSES, SOURCES, STATUSES

HOURS_AHEAD = 2
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 26, 72


class ChecksFailed(AssertionError):
    pass


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple = ()
    minimum: float | None = None
    maximum: float | None = None
    inclusive: bool = True
    parent: str = ""
    parent_column: str = ""


# ---- offending rows --------------------------------------------------------------------


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    return counted.where("occurrences > 1")


def unaccepted(df: DataFrame, column: str, values: list | tuple) -> DataFrame:
    return df.where(~F.col(column).isin(list(values)))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys without a parent and how many rows carry them; null keys pass.

    Rows are counted per key first, so a frequent key is one row in the join.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return used.join(known, column, "left_anti")


def outside(
    column: Column, minimum: float | None, maximum: float | None, inclusive: bool = True
) -> Column:
    bad = F.lit(False)
    if minimum is not None:
        bad = bad | (column < minimum if inclusive else column <= minimum)
    if maximum is not None:
        bad = bad | (column > maximum if inclusive else column >= maximum)
    return bad


def out_of_range(
    df: DataFrame,
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    return df.where(outside(F.col(column), minimum, maximum, inclusive))


def too_far_ahead(column: Column, as_of: datetime | None, hours: int = HOURS_AHEAD) -> Column:
    return column > as_moment(as_of) + F.make_dt_interval(F.lit(0), F.lit(hours))


def far_in_future(
    df: DataFrame, column: str, as_of: datetime | None, hours: int = HOURS_AHEAD
) -> DataFrame:
    return df.where(too_far_ahead(F.col(column), as_of, hours))


def future_observations(fact_observation: DataFrame, as_of: datetime | None) -> DataFrame:
    return far_in_future(fact_observation, "observed_at", as_of).select("event_id", "observed_at")


def unreconciled_runs(staged_runs: DataFrame, fact_observation: DataFrame) -> DataFrame:
    """Runs whose manifest count differs from the observations kept for them."""
    kept = fact_observation.groupBy("ingestion_run_id").agg(
        F.count(F.lit(1)).alias("fact_event_count")
    )
    count = F.coalesce("fact_event_count", F.lit(0))
    return (
        staged_runs.select("run_id", "events_normalized")
        .join(kept, F.col("run_id") == F.col("ingestion_run_id"), "left")
        .where(F.col("events_normalized") != count)
        .select("run_id", "events_normalized", count.alias("fact_event_count"))
    )


def freshness(raw_events: DataFrame, as_of: datetime | None) -> DataFrame:
    """pass, warn or error per source by the age of its newest load."""
    age = F.timestamp_diff("SECOND", F.col("newest_load"), as_moment(as_of)) / 3600
    return (
        raw_events.groupBy(F.upper(F.trim("source")).alias("source"))
        .agg(F.max("loaded_at").alias("newest_load"))
        .select(
            "source",
            "newest_load",
            F.when(age > ERROR_AFTER_HOURS, F.lit("error"))
            .when(age > WARN_AFTER_HOURS, F.lit("warn"))
            .otherwise(F.lit("pass"))
            .alias("state"),
        )
    )


# ---- the declared suite ----------------------------------------------------------------


def _present(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in columns]


def _key(model: str, column: str) -> list[Check]:
    return [Check(model, column, "not_null"), Check(model, column, "unique")]


def _share(model: str, column: str) -> Check:
    return Check(model, column, "accepted_range", minimum=0, maximum=100)


def _child(model: str, column: str, parent: str) -> Check:
    return Check(model, column, "relationships", parent=parent, parent_column=column)


# Which model promises what.
SUITE: list[Check] = [
    *_key("inventory_events", "event_id"),
    *_present("inventory_events", "source", "retailer_product_id", "observed_at"),
    *_present("inventory_events", "ingestion_run_id"),
    *_key("ingestion_runs", "run_id"),
    *_present("ingestion_runs", "source", "status"),
    *_key("stg_inventory_events", "event_id"),
    *_present("stg_inventory_events", "source_name", "inventory_status", "observed_at"),
    Check("stg_inventory_events", "source_name", "accepted_values", tuple(SOURCES)),
    Check("stg_inventory_events", "inventory_status", "accepted_values", tuple(STATUSES)),
    Check("stg_inventory_events", "currency", "accepted_values", ("USD",)),
    Check("stg_inventory_events", "price", "accepted_range", minimum=0),
    Check("stg_inventory_events", "quantity_available", "accepted_range", minimum=0),
    *_key("stg_ingestion_runs", "run_id"),
    *_present("stg_ingestion_runs", "status"),
    Check("stg_ingestion_runs", "status", "accepted_values", (*RUN_STATUSES, "UNKNOWN")),
    *_key("stg_products", "product_id"),
    *_present("stg_products", "retailer"),
    *_key("stg_retailers", "retailer_code"),
    *_key("seed_products", "product_id"),
    *_present("seed_products", "retailer"),
    *_key("seed_retailers", "retailer_code"),
    *_key("int_inventory_events_deduplicated", "event_id"),
    *_present("int_inventory_events_deduplicated", "source", "observed_at"),
    Check("int_inventory_events_deduplicated", "observed_at", "not_far_in_future"),
    *_key("int_inventory_state_changes", "event_id"),
    *_key("int_product_price_changes", "event_id"),
    *_present("int_product_daily_inventory", "source", "retailer_product_id"),
    *_present("int_product_daily_inventory", "observation_date"),
    _share("int_product_daily_inventory", "availability_pct"),
    *_key("dim_product", "product_key"),
    *_present("dim_product", "source", "retailer_product_id"),
    *_key("dim_retailer", "retailer_key"),
    *_key("dim_retailer", "source"),
    *_key("dim_date", "date_key"),
    *_key("fact_inventory_observation", "event_id"),
    _child("fact_inventory_observation", "product_key", "dim_product"),
    _child("fact_inventory_observation", "retailer_key", "dim_retailer"),
    Check("fact_inventory_observation", "inventory_status", "accepted_values", tuple(STATUSES)),
    Check("fact_inventory_observation", "price", "accepted_range", minimum=0),
    *_key("fact_inventory_state_change", "state_change_event_id"),
    _child("fact_inventory_state_change", "product_key", "dim_product"),
    *_key("fact_price_observation", "event_id"),
    _child("fact_price_observation", "product_key", "dim_product"),
    *_present("mart_daily_product_availability", "product_key", "observation_date"),
    _share("mart_daily_product_availability", "availability_pct"),
    *_key("mart_retailer_summary", "retailer_key"),
    _share("mart_retailer_summary", "run_success_rate_pct"),
    Check("fact_inventory_observation", "observed_at", "no_future_observations"),
    Check("stg_ingestion_runs", "events_normalized", "event_counts_match"),
]


def _row_rule(check: Check, as_of: datetime | None) -> Column | None:
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))
    if check.kind == "accepted_range":
        return outside(column, check.minimum, check.maximum, check.inclusive)
    if check.kind in ("not_far_in_future", "no_future_observations"):
        return too_far_ahead(column, as_of)
    return None


def _result(model: str, column: str, kind: str, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit(kind).alias("check"),
        failures.alias("failures"),
    )


class Watch:
    """Row rules counted by the jobs that write the tables, so that no second scan is needed.

    ``on`` hangs the rules of a model on rows about to be written. Call it on the frame that is
    written itself, behind its last shuffle: the counts then come from the tasks of the writing
    stage, each of which is counted once even if it is run again. Only ``on`` frames whose write
    then happens may be handed to ``run_checks``.
    """

    def __init__(self, checks: list[Check], as_of: datetime | None = None):
        self.checks, self.as_of = list(checks), as_of
        self._seen: dict[str, tuple[Observation, list[Check]]] = {}

    def on(self, model: str, df: DataFrame) -> DataFrame:
        rules = [(c, _row_rule(c, self.as_of)) for c in self.checks if c.model == model]
        rules = [(c, rule) for c, rule in rules if rule is not None]
        if not rules:
            return df
        seen = Observation(f"{model}-{uuid.uuid4().hex}")
        self._seen[model] = seen, [c for c, _ in rules]
        return df.observe(seen, *[F.count(F.when(rule, 1)).alias(f"c{i}") for i, (_, rule) in enumerate(rules)])

    def failures(self) -> dict[Check, int]:
        """Offending rows of each check that a write has counted."""
        return {c: seen.get[f"c{i}"] for seen, checks in self._seen.values() for i, c in enumerate(checks)}


def run_checks(
    models: dict[str, DataFrame], checks: list[Check], as_of: datetime | None = None, watch: Watch | None = None
) -> DataFrame:
    """One row per check: model, column_name, check, failures.

    All row rules of a model share one scan and one aggregate; each uniqueness or parent
    check is one more aggregate. Hand in tables rather than views, as every model is read
    several times. Rules that ``watch`` counted while their table was written are not counted again.
    """
    counted_before = watch.failures() if watch else {}
    if watch and watch.as_of != as_of:
        raise ValueError("the watch and the checks look at different times")
    results: list[DataFrame] = []
    known = [(c.model, c.column, c.kind, counted_before[c]) for c in checks if c in counted_before]
    if known:
        spark = models[known[0][0]].sparkSession
        results.append(spark.createDataFrame(known, "model string, column_name string, check string, failures bigint"))
    for model in dict.fromkeys(c.model for c in checks):
        df = models[model]
        row_rules = []
        for check in (c for c in checks if c.model == model and c not in counted_before):
            rule = _row_rule(check, as_of)
            if rule is not None:
                row_rules.append((check, rule))
            elif check.kind == "unique":
                counted = duplicates(df, check.column).agg(F.count(F.lit(1)).alias("n"))
                results.append(_single(check, counted))
            elif check.kind == "relationships":
                lost = orphans(df, check.column, models[check.parent], check.parent_column)
                counted = lost.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n"))
                results.append(_single(check, counted))
            elif check.kind == "event_counts_match":
                open_runs = unreconciled_runs(df, models["fact_inventory_observation"])
                results.append(_single(check, open_runs.agg(F.count(F.lit(1)).alias("n"))))
            else:
                raise ValueError(f"unknown check {check.kind}")
        if row_rules:
            counts = df.agg(
                *[F.count_if(rule).alias(f"c{i}") for i, (_, rule) in enumerate(row_rules)]
            )
            cells = [
                _result(c.model, c.column, c.kind, F.col(f"c{i}"))
                for i, (c, _) in enumerate(row_rules)
            ]
            results.append(counts.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, results)


def _single(check: Check, counted: DataFrame) -> DataFrame:
    row = _result(check.model, check.column, check.kind, F.col("n"))
    return counted.select(F.inline(F.array(row)))


def require_clean(results: DataFrame) -> None:
    """Raise with every failed check; the result has one short row per check."""
    failed = results.where("failures > 0").collect()
    if failed:
        lines = [f"{r['model']}.{r['column_name']} {r['check']}: {r['failures']}" for r in failed]
        raise ChecksFailed("; ".join(lines))
