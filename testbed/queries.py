"""One registered query per inventory row, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.functions import event_id, payload_hash, read_utc, surrogate_key, utc_text
from shelflog.operators import normalize, quality, staging
from shelflog.operators.runs import build_manifests, ingestion_summary, run_metrics
from shelflog.plans import intermediate, load, marts, reports, sql_reports
from shelflog.plans.incremental import Warehouse
from shelflog.plans.warehouse import build_warehouse, write_table
from shelflog.session import materialize, mount, scratch_path
from shelflog.sources import landing, seeds
from shelflog.streaming.ingest import drain_first_copies, landed_events_stream, stream_observations
from testbed import adapter
from testbed.adapter import AS_OF, EARLY_AS_OF

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return register


class Models:
    """The models over one data folder; every property is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def stg_events(self) -> DataFrame:
        return staging.stage_events(adapter.raw_events(self.spark, self.sf_dir))

    @property
    def stg_runs(self) -> DataFrame:
        return staging.stage_runs(adapter.raw_runs(self.spark, self.sf_dir))

    @property
    def stg_products(self) -> DataFrame:
        return staging.stage_products(adapter.product_seed(self.spark, self.sf_dir))

    @property
    def stg_retailers(self) -> DataFrame:
        return staging.stage_retailers(adapter.retailer_seed(self.spark, self.sf_dir))

    @property
    def observations(self) -> DataFrame:
        return intermediate.deduplicated(self.stg_events)

    def stored_observations(self, measure: str) -> DataFrame:
        """Observations as a table, as in the warehouse: a series lookup scans them thrice."""
        columns = ["event_id", *intermediate.SERIES, "observed_at", measure]
        return materialize(self.observations.select(*columns), "observations")

    @property
    def state_changes(self) -> DataFrame:
        return intermediate.state_changes(self.stored_observations("inventory_status"))

    @property
    def price_changes(self) -> DataFrame:
        return intermediate.price_changes(self.stored_observations("price"))

    @property
    def daily(self) -> DataFrame:
        return intermediate.daily_inventory(self.observations)

    @property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, AS_OF)

    @property
    def observed_dates(self) -> DataFrame:
        return marts.observed_calendar(self.stg_events)

    @property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.stg_products)

    @property
    def dim_retailer(self) -> DataFrame:
        return marts.dim_retailer(self.stg_retailers)

    @property
    def dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.dim_product, self.dim_retailer, self.dim_date

    @property
    def fact_observation(self) -> DataFrame:
        return marts.fact_inventory_observation(self.observations, *self.dims)

    @property
    def fact_state_change(self) -> DataFrame:
        return marts.fact_inventory_state_change(self.state_changes, *self.dims)

    @property
    def fact_price(self) -> DataFrame:
        return marts.fact_price_observation(self.price_changes, *self.dims)

    @property
    def mart_daily(self) -> DataFrame:
        return marts.mart_daily_product_availability(
            self.daily, self.dim_product, self.dim_retailer
        )

    def laid_out(self, attribute: str, day: str) -> DataFrame:
        """A fact or mart as the warehouse keeps it."""
        return write_table(getattr(self, attribute), scratch_path(self.spark, attribute), day)

    @property
    def daily_table(self) -> DataFrame:
        return self.laid_out("mart_daily", "observation_date")

    @property
    def mart_retailer(self) -> DataFrame:
        return marts.mart_retailer_summary(self.dim_retailer, self.stg_runs, self.daily, AS_OF)


def _model(name: str, attribute: str) -> None:
    REGISTRY[name] = lambda spark, sf_dir: getattr(Models(spark, sf_dir), attribute)


for _name, _attribute in {
    "T1_stg_inventory_events": "stg_events",
    "T6_stg_ingestion_runs": "stg_runs",
    "T9_stg_products": "stg_products",
    "T10_stg_retailers": "stg_retailers",
    "I2_deduplicated_observations": "observations",
    "I3_state_changes": "state_changes",
    "I8_price_changes": "price_changes",
    "I11_daily_inventory": "daily",
    "M1_dim_date": "observed_dates",
    "M2_dim_product": "dim_product",
    "M3_dim_retailer": "dim_retailer",
    "M4_fact_inventory_observation": "fact_observation",
    "M5_fact_inventory_state_change": "fact_state_change",
    "M6_fact_price_observation": "fact_price",
    "M7_mart_daily_product_availability": "mart_daily",
    "M10_mart_retailer_summary": "mart_retailer",
}.items():
    _model(_name, _attribute)


@query("M8_run_statistics")
def run_statistics(spark, sf_dir):
    return marts.run_statistics(Models(spark, sf_dir).stg_runs)


@query("M9_source_availability")
def source_availability(spark, sf_dir):
    return marts.source_availability(Models(spark, sf_dir).daily)


@query("I3_state_changes_lineitem")
def state_changes_lineitem(spark, sf_dir):
    return intermediate.state_changes(adapter.line_prices(spark, sf_dir))


@query("I8_price_changes_lineitem")
def price_changes_lineitem(spark, sf_dir):
    return intermediate.price_changes(adapter.line_prices(spark, sf_dir))


# ---- normalisation ---------------------------------------------------------------------


def _examined(spark, sf_dir, sources=None):
    return normalize.examine(adapter.payloads(spark, sf_dir), adapter.catalog(spark, sf_dir), sources)


def _mapping_query(source: str) -> Query:
    def run(spark, sf_dir):
        # Two engines' texts of a payload differ by spacing; tests compute its hash in Python.
        return normalize.accepted(_examined(spark, sf_dir, [source])).drop("source_response_hash")

    return run


for _name, _source in {
    "N1_target_mapping": "TARGET",
    "N2_walmart_mapping": "WALMART",
    "N3_storefront_mapping": "POKEMON_CENTER",
    "N4_gamestop_mapping": "GAMESTOP",
}.items():
    REGISTRY[_name] = _mapping_query(_source)


@query("N5_event_id")
def event_ids(spark, sf_dir):
    polls = adapter.table(spark, sf_dir, "events")
    return polls.select(
        "event_id",
        event_id(F.expr(adapter.SOURCE), F.col("user_id").cast("string"), F.col("ts")).alias("uuid"),
        event_id(
            F.expr(adapter.SOURCE), F.col("user_id").cast("string"), F.date_trunc("second", "ts")
        ).alias("uuid_whole_second"),
    )


@query("N6_payload_hash")
def payload_hashes(spark, sf_dir):
    polls = adapter.table(spark, sf_dir, "events").selectExpr("*", f"{adapter.K} as k")
    one_order = F.expr("""concat('{"z": ', user_id, ', "a": ', k, '}')""")
    other_order = F.expr("""concat('{"a":', k, ',"z":', user_id, '}')""")
    first, second = (payload_hash(F.try_parse_json(text)) for text in (one_order, other_order))
    nested = """concat('{"n":{"y":[', user_id, ',null],"b":{"t":true}},"a":"', event_type, '"}')"""
    turned = """concat('{ "a": "', event_type, '", "n": {"b": {"t": true}, "y": [', user_id, ', null]} }')"""
    deep, turned_deep = (payload_hash(F.try_parse_json(F.expr(text))) for text in (nested, turned))
    return polls.select(
        "event_id",
        first.alias("digest"),
        (first == second).alias("same"),
        deep.alias("nested_digest"),
        (deep == turned_deep).alias("nested_same"),
    )


@query("N7_validation_reasons")
def validation_reasons(spark, sf_dir):
    examined = _examined(spark, sf_dir)
    return (
        examined.where("reason <> ''")
        .select("source", F.explode(F.split("reason", normalize.SEPARATOR)).alias("reason"))
        .groupBy("source", "reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query("N8_utc_normalisation")
def utc_normalisation(spark, sf_dir):
    polls = adapter.table(spark, sf_dir, "events")
    shift = F.expr("event_id % 5")
    # The same instant written naive, as UTC and with a negative offset.
    text = (
        F.when(shift == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(shift == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(shift == 2, F.lit("not a time"))
        .otherwise(
            F.date_format(F.expr("ts - interval 7 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-07:00'")
        )
    )
    read = read_utc(text)
    return polls.select("event_id", read.alias("observed_at"), utc_text(read).alias("text"))


def _excerpt_facts(rejects: DataFrame) -> DataFrame:
    """The excerpt without blanks, from its first sign on as far as no number is printed.

    Two engines order keys and print numbers in their own ways; the first key is theirs too.
    """
    text = F.regexp_replace("raw_excerpt", r"\s", "")
    return rejects.select(
        *[c for c in rejects.columns if c != "raw_excerpt"],
        (F.length("raw_excerpt") <= normalize.EXCERPT_LENGTH).alias("excerpt_fits"),
        F.when(F.length(text) == 2, text).alias("excerpt_if_empty"),
        F.regexp_count(text, F.lit('"')).cast("bigint").alias("excerpt_quotes"),
    )


@query("N9_rejected_records")
def rejected_records(spark, sf_dir):
    return _excerpt_facts(normalize.rejected(_examined(spark, sf_dir)))


@query("N9_valid_rejected_split")
def valid_rejected_split(spark, sf_dir):
    return (
        _examined(spark, sf_dir)
        .groupBy("source")
        .agg(
            F.count_if(F.col("reason") == "").alias("valid"),
            F.count_if(F.col("reason") != "").alias("rejected"),
        )
    )


@query("N10_name_fallback")
def name_fallback(spark, sf_dir):
    return (
        normalize.accepted(_examined(spark, sf_dir))
        .groupBy("source", F.startswith("product_name", F.lit("Product ")).alias("from_catalog"))
        .agg(F.count(F.lit(1)).alias("observations"))
    )


@query("N11_catalog_of_source")
def catalog_of_source(spark, sf_dir):
    return (
        _examined(spark, sf_dir)
        .groupBy("source", F.col("in_catalog").isNotNull().alias("tracked"))
        .agg(F.count_distinct("retailer_product_id").alias("products"))
    )


@query("N12_constants")
def constants(spark, sf_dir):
    return (
        normalize.accepted(_examined(spark, sf_dir))
        .groupBy("source", "currency", "location_type", "schema_version")
        .agg(F.count(F.lit(1)).alias("observations"))
    )


def _manifests(spark, sf_dir):
    """Payloads are parsed once; counts and reasons are read from the written outcome."""
    outcome = _examined(spark, sf_dir).select("ingestion_run_id", "retailer_product_id", "observed_at", "reason")
    return build_manifests(adapter.runs(spark, sf_dir), materialize(outcome, "outcome"))


@query("N13_run_status")
def run_statuses(spark, sf_dir):
    return _manifests(spark, sf_dir).select(
        "run_id", "status", "payloads_received", "events_normalized", "events_rejected"
    )


@query("N14_manifests")
def manifests(spark, sf_dir):
    return _manifests(spark, sf_dir).withColumn("error_summary", F.to_json("error_summary"))


@query("N15_ingestion_summary")
def summary(spark, sf_dir):
    return ingestion_summary(_manifests(spark, sf_dir))


@query("N16_run_metrics")
def metrics(spark, sf_dir):
    return run_metrics(_manifests(spark, sf_dir), Models(spark, sf_dir).stg_products)


# ---- landing zone and raw tables ---------------------------------------------------------


@query("S1_scan_events")
def scan_events(spark, sf_dir):
    return landing.scan_events(spark, adapter.landed(spark, sf_dir, landing.EVENTS)).drop(
        "source_response_hash"
    )


@query("S2_scan_payloads")
def scan_payloads(spark, sf_dir):
    found = landing.scan_payloads(spark, adapter.landed(spark, sf_dir, landing.PAYLOADS))
    return found.select(
        "source",
        "run_id",
        "retailer_product_id",
        read_utc(F.col("observed_at")).alias("observed_at"),
        F.col("raw_response").isNotNull().alias("has_response"),
        *_payload_leaves(F.col("raw_response")),
    )


def _payload_leaves(payload: Column) -> list[Column]:
    """Text and price leaves of the four layouts, wherever the payload has them."""

    def first(kind: str, *paths: str) -> Column:
        return F.coalesce(*[F.try_variant_get(payload, path, kind) for path in paths])

    return [
        first("string", *adapter.NAME_PATHS).alias("name"),
        first("double", *adapter.PRICE_PATHS).alias("price"),
        first("string", *adapter.CODE_PATHS).alias("code"),
    ]


@query("S3_scan_manifests")
def scan_manifests(spark, sf_dir):
    found = landing.scan_runs(spark, adapter.landed(spark, sf_dir, landing.MANIFESTS))
    return found.drop("raw_payload_path", "normalized_output_path", "manifest_path")


@query("S7_written_runs")
def written_runs(spark, sf_dir):
    found = landing.scan_runs(spark, adapter.landed(spark, sf_dir, landing.MANIFESTS))
    return found.select("run_id", "raw_payload_path", "normalized_output_path", "manifest_path")


@query("S8_immutability_guard")
def immutability_guard(spark, sf_dir):
    frames = adapter.whole_runs(spark, sf_dir)
    root = scratch_path(spark, "landing")
    landing.write_runs(root, **frames)
    try:
        landing.write_runs(root, **frames)
        refused = False
    except landing.RunExists:
        refused = True
    # A run that received nothing leaves a manifest only; it is refused all the same.
    silent = {k: v.where("run_id like '%-20240105'") if k == "manifests" else v.limit(0) for k, v in frames.items()}
    other = scratch_path(spark, "landing")
    landing.write_runs(other, **silent)
    try:
        landing.write_runs(other, **silent)
        refused_silent = False
    except landing.RunExists:
        refused_silent = True
    kept = landing.scan_payloads(spark, root).groupBy("source").agg(
        F.count(F.lit(1)).alias("payloads")
    )
    return kept.withColumns(
        {"second_write_refused": F.lit(refused), "silent_run_refused": F.lit(refused_silent)}
    )


@query("S9_scan_rejects")
def scan_rejects(spark, sf_dir):
    found = landing.scan_rejects(spark, adapter.landed(spark, sf_dir, landing.REJECTS))
    return _excerpt_facts(
        found.select(
            "run_id",
            "source",
            "reason",
            "retailer_product_id",
            read_utc(F.col("occurred_at")).alias("occurred_at"),
            "raw_excerpt",
        )
    )


def _write_lines(lines: DataFrame, root: str, kind: str) -> None:
    """Text lines (directory columns, value) into the folders of their runs."""
    folders = lines.select("value", *landing.LEVELS).hint("rebalance", *landing.LEVELS)
    folders.write.partitionBy(*landing.LEVELS).mode("append").text(f"{root}/{kind}")


def _damaged(spark, sf_dir) -> str:
    """A landing zone with bad lines among the good ones: every 20th poll leaves one behind."""
    root = adapter.landed(spark, sf_dir)
    polls = adapter.payloads(spark, sf_dir).where("cast(retailer_product_id as bigint) % 20 < 4")
    event = F.concat(F.lit('{"event_id": "'), "retailer_product_id", F.lit('-'), "observed_at", F.lit('"'))
    of_kind = F.expr("cast(retailer_product_id as bigint) % 20")
    value = (
        F.when(of_kind == 0, event)  # cut
        .when(of_kind == 1, F.concat(event, F.lit(', "quantity_available": "many"}')))
        .when(of_kind == 2, F.concat(event, F.lit("}"), event, F.lit("}")))
        .otherwise(F.concat(F.lit('{"retailer_product_id": "'), "retailer_product_id", F.lit('"}')))
    )
    _write_lines(landing.with_levels(polls.withColumn("value", value), read_utc(F.col("observed_at")), "run_id"), root, landing.EVENTS)
    return root


@query("S1_bad_lines")
def bad_lines(spark, sf_dir):
    """What a damaged zone quarantines; the good lines are those of an undamaged one."""
    root, tables = _damaged(spark, sf_dir), scratch_path(spark, "raw")
    paths = f"{tables}/events", f"{tables}/runs"
    first = load.load_landing(spark, root, *paths, AS_OF, quarantine_path=f"{tables}/bad").first()
    again = load.load_landing(spark, root, *paths, AS_OF, quarantine_path=f"{tables}/bad").first()
    kept = spark.read.parquet(f"{tables}/bad")
    return kept.groupBy("kind", "source", "run_id", "fault", "line").agg(F.sum("copies").alias("copies")).withColumns(
        {
            "good_lines": F.lit(first["events_loaded"]).cast("bigint"),
            "loaded_again": F.lit(again["events_loaded"] + again["bad_lines"]).cast("bigint"),
        }
    )


@query("S8_unfinished_runs")
def unfinished_runs(spark, sf_dir):
    """A write that broke before its manifests shows nothing and can be repeated with other content."""
    root = scratch_path(spark, "landing")
    frames = adapter.whole_runs(spark, sf_dir)
    landing.append_files(frames["payloads"], root, landing.PAYLOADS)
    landing.append_files(frames["events"], root, landing.EVENTS)
    unseen = landing.scan_payloads(spark, root).count() + landing.scan_events(spark, root).count()
    open_runs = landing.unpublished_runs(spark, root).count()
    half = F.expr("cast(retailer_product_id as bigint) % 2 = 0")
    landing.write_runs(
        root, frames["payloads"].where(half), frames["events"].where(half), frames["rejects"].where(half), frames["manifests"]
    )
    return (
        landing.scan_events(spark, root)
        .groupBy("source", "run_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumns({"seen_before": F.lit(unseen).cast("bigint"), "open_runs": F.lit(open_runs).cast("bigint")})
    )


@query("S10_artefact_audit")
def artefact_audit(spark, sf_dir):
    """Files of two days are tampered with after landing; the audit names these runs."""
    root = adapter.landed(spark, sf_dir)
    touched = adapter.runs(spark, sf_dir).where("day(observed_at) in (3, 17)")
    added = landing.with_levels(touched.withColumn("value", F.lit("{}")), F.col("observed_at"), "run_id")
    _write_lines(added.where("day(observed_at) = 3"), root, landing.PAYLOADS)
    _write_lines(added.where("day(observed_at) = 17"), root, landing.EVENTS)
    return landing.audit_digests(spark, root).select(
        "source", "run_id", "kind", F.col("booked").isNotNull().alias("was_booked"), F.col("found").isNotNull().alias("is_there")
    )


@query("S10_content_digests")
def content_digests(spark, sf_dir):
    polls = adapter.table(spark, sf_dir, "events")
    lines = polls.selectExpr(f"{adapter.RUN_ID} as run_id", "concat(event_type, event_id) as line")
    return landing.content_digests(lines, "digest")


@query("S11_run_files")
def run_files(spark, sf_dir):
    root = adapter.landed(spark, sf_dir, landing.EVENTS)
    return landing.list_files(spark, root, landing.EVENTS).select("source", "run_id").distinct()


def _loaded(spark, sf_dir):
    root, tables = adapter.landed(spark, sf_dir), scratch_path(spark, "raw")
    return root, f"{tables}/events", f"{tables}/runs"


@query("S12_mounted_stores")
def mounted_stores(spark, sf_dir):
    """Landing zone, raw tables and observations behind a mount table, on a store of its own each."""
    tables = scratch_path(spark, "mounted")
    root = mount(spark, f"m{tables[-32:]}", zone=f"{tables}/a", raw=f"{tables}/b", observed=f"{tables}/c")
    adapter.land_all(spark, sf_dir, f"{root}/zone")
    load.load_landing(spark, f"{root}/zone", f"{root}/raw/events", f"{root}/raw/runs", AS_OF, typed=True)
    load.refresh_from_raw(spark, f"{root}/raw/events", f"{root}/observed/table")
    return spark.read.parquet(f"{root}/observed/table").select(
        "event_id", "source", "retailer_product_id", "price", "inventory_status",
        "quantity_available", "observed_at",
    )


@query("S13_attached_payloads")
def attached_payloads(spark, sf_dir):
    root = adapter.landed(spark, sf_dir, landing.PAYLOADS, landing.EVENTS)
    joined = landing.attach_payloads(
        landing.scan_events(spark, root), landing.scan_payloads(spark, root)
    )
    payload = F.try_parse_json("raw_payload")
    return joined.select(
        "event_id", "source", (F.col("raw_payload") == "null").alias("without"), *_payload_leaves(payload)
    )


@query("S16_payload_paths")
def payload_paths(spark, sf_dir):
    """Paths into the payloads of the raw table, which stores them parsed."""
    path = scratch_path(spark, "raw-events")
    load.merge_events(adapter.raw_events(spark, sf_dir), path, AS_OF, typed=True)
    stored = load.read_typed_events(spark, path)
    return stored.select(
        "event_id",
        F.try_variant_get("raw_payload", "$.k", "bigint").alias("k"),
        F.schema_of_variant("raw_payload").alias("kind"),
    )


@query("S17_insert_only_events")
def insert_only_events(spark, sf_dir):
    path = scratch_path(spark, "raw-events")
    batch = adapter.raw_events(spark, sf_dir)
    first = load.merge_events(batch.where("event_id % 2 = 0"), path, AS_OF)
    second = load.merge_events(batch, path, AS_OF)
    third = load.merge_events(batch, path, AS_OF)
    return (
        load.read_raw_events(spark, path)
        .groupBy("source", "loaded_at")
        .agg(F.count(F.lit(1)).alias("stored"), F.count_distinct("event_id").alias("ids"))
        .withColumns({
                "first": F.lit(first).cast("bigint"),
                "second": F.lit(second).cast("bigint"),
                "third": F.lit(third).cast("bigint"),
            })
    )


@query("S18_insert_only_runs")
def insert_only_runs(spark, sf_dir):
    path = scratch_path(spark, "raw-runs")
    batch = adapter.raw_runs(spark, sf_dir)
    load.merge_runs(batch.where("events_rejected > 0"), path, AS_OF)
    load.merge_runs(batch, path, AS_OF)
    return spark.read.parquet(path)


@query("S19_load_counters")
def load_counters(spark, sf_dir):
    root, events, runs = _loaded(spark, sf_dir)
    first = load.load_landing(spark, root, events, runs, AS_OF).withColumn("load", F.lit(1))
    again = load.load_landing(spark, root, events, runs, AS_OF).withColumn("load", F.lit(2))
    # One file per run and kind at these scales; the landing queries show the same runs.
    return first.unionByName(again)


@query("P1_payloads_to_mart")
def payloads_to_mart(spark, sf_dir):
    """The whole way: ingest, land, load the raw tables, build the warehouse, read the mart."""
    root, events, runs = _loaded(spark, sf_dir)
    load.load_landing(spark, root, events, runs, AS_OF)
    models = build_warehouse(
        spark,
        scratch_path(spark, "warehouse"),
        load.read_raw_events(spark, events),
        load.read_raw_runs(spark, runs),
        materialize(adapter.product_seed(spark, sf_dir), "products"),
        adapter.retailer_seed(spark, sf_dir),
        AS_OF,
    )
    return models["mart_daily_product_availability"]


@query("S21_recent_runs")
def recent_runs(spark, sf_dir):
    return load.recent_runs(adapter.raw_runs(spark, sf_dir))


@query("I1_incremental_observations")
def incremental_observations(spark, sf_dir):
    """Two loads that overlap by the lookback give the table of one full build.

    Both read the partitioned raw table, the second and third only its last days.
    """
    raw, path = scratch_path(spark, "raw-events"), scratch_path(spark, "observations")
    batch = adapter.raw_events(spark, sf_dir)
    stored = batch.withColumn(load.DAY, F.to_date("observed_at"))
    first = stored.where("observed_at < timestamp_ntz'2024-01-20'")
    first.hint("rebalance", load.DAY).write.partitionBy(load.DAY).parquet(raw)
    load.refresh_from_raw(spark, raw, path)
    rest = stored.where("observed_at >= timestamp_ntz'2024-01-20'")
    rest.hint("rebalance", load.DAY).write.partitionBy(load.DAY).mode("append").parquet(raw)
    load.refresh_from_raw(spark, raw, path)
    load.refresh_from_raw(spark, raw, path)
    return spark.read.parquet(path).drop(load.DAY)


@query("L1_streamed_observations")
def streamed_observations(spark, sf_dir):
    """The zone as a stream: first what was landed, then late rows that the lookback refuses."""
    root, table = adapter.landed(spark, sf_dir, landing.EVENTS), scratch_path(spark, "observations")
    stream = landed_events_stream(spark, root, files_per_batch=100)
    checkpoint = scratch_path(spark, "stream")
    stream_observations(stream, table, checkpoint).awaitTermination()
    late = landing.scan_events(spark, root).where("observed_at < timestamp_ntz'2024-01-10'")
    late = late.withColumns({"event_id": F.concat(F.lit("late-"), "event_id"), "ingestion_run_id": F.concat("run_id", F.lit("-late"))})
    late = landing.with_levels(late.drop("run_id"), F.col("observed_at"), "ingestion_run_id")
    landing.append_files(late, root, landing.EVENTS)
    stream_observations(stream, table, checkpoint).awaitTermination()
    return spark.read.parquet(table).select(
        "event_id", "source", "retailer_product_id", "price", "inventory_status",
        "quantity_available", "observed_at",
    )


@query("L1_resumed_drain")
def resumed_drain(spark, sf_dir):
    """A drain that broke off after the newest days goes on under the mark it began with."""
    root, table, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "observations"), scratch_path(spark, "stream")
    frames = adapter.whole_runs(spark, sf_dir)
    recent = F.col("observed_at") >= F.expr("timestamp_ntz'2024-01-25'")
    landing.append_files(frames["events"].where(recent), root, landing.EVENTS)
    stream = landed_events_stream(spark, root, files_per_batch=50)
    broken = stream_observations(stream, table, checkpoint)
    broken.query.awaitTermination()  # never closed in the ledger
    landing.append_files(frames["events"].where(~recent), root, landing.EVENTS)
    stream_observations(stream, table, checkpoint).awaitTermination()
    return spark.read.parquet(table).select(
        "event_id", "source", "retailer_product_id", "price", "inventory_status",
        "quantity_available", "observed_at",
    )


@query("L2_watermark_deduplication")
def watermark_deduplication(spark, sf_dir):
    """First copies by the stream's own state: late rows of the second batch are dropped and counted."""
    raw, out = scratch_path(spark, "raw-stream"), scratch_path(spark, "first-copies")
    polls = adapter.raw_events(spark, sf_dir).select("event_id", "observed_at", "retailer_product_id")
    late = 0
    for part in ("cast(event_id as bigint) % 2 = 0", "true"):
        polls.where(part).write.mode("append").parquet(raw)
        stream = spark.readStream.schema(polls.schema).parquet(raw)
        late += drain_first_copies(stream, out, f"{out}-checkpoint")
    return spark.read.parquet(out).select("event_id", "observed_at", F.lit(late).cast("bigint").alias("late_rows"))


@query("L2_repeated_delivery")
def repeated_delivery(spark, sf_dir):
    models = Models(spark, sf_dir)
    path = scratch_path(spark, "observations")
    for _ in range(2):
        load.refresh_observations(models.stg_events, path)
    return spark.read.parquet(path).groupBy("source").agg(
        F.count(F.lit(1)).alias("stored"), F.count_distinct("event_id").alias("ids")
    )


@query("L3_late_rows_skipped")
def late_rows_skipped(spark, sf_dir):
    """The newest days are stored first; the rest is late and only a full run adds it."""
    staged = Models(spark, sf_dir).stg_events
    path = scratch_path(spark, "observations")
    load.refresh_observations(staged.where("observed_at >= timestamp_ntz'2024-01-25'"), path)
    load.refresh_observations(staged, path)
    skipped = load.skipped_late_rows(staged, path)
    stored = spark.read.parquet(path).count()
    load.refresh_observations(staged, path, full=True)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("after_full")).withColumns(
        {"stored": F.lit(stored).cast("bigint"), "skipped": F.lit(skipped).cast("bigint")}
    )


@query("L4_freshness")
def freshness(spark, sf_dir):
    return quality.freshness(adapter.raw_events(spark, sf_dir), AS_OF)


# ---- checks ------------------------------------------------------------------------------


def _check_query(name: str, *checks: quality.Check, models: dict[str, str]) -> None:
    def run(spark, sf_dir):
        ready = Models(spark, sf_dir)
        return quality.run_checks(
            {model: getattr(ready, attribute) for model, attribute in models.items()},
            list(checks),
            EARLY_AS_OF,
        )

    REGISTRY[name] = run


_Check = quality.Check
_check_query(
    "Q1_not_null",
    _Check("observations", "price", "not_null"),
    _Check("observations", "event_id", "not_null"),
    _Check("observations", "sku", "not_null"),
    models={"observations": "observations"},
)
_check_query(
    "Q2_unique",
    _Check("staged", "event_id", "unique"),
    _Check("staged", "sku", "unique"),
    models={"staged": "stg_events"},
)
_check_query(
    "Q3_accepted_values",
    _Check("staged", "inventory_status", "accepted_values", ("IN_STOCK", "PREORDER")),
    _Check("staged", "currency", "accepted_values", ("USD",)),
    models={"staged": "stg_events"},
)
_check_query(
    "Q4_relationships",
    _Check("fact", "retailer_product_id", "relationships", parent="product",
           parent_column="retailer_product_id"),
    _Check("fact", "product_key", "relationships", parent="product",
           parent_column="product_key"),
    models={"fact": "fact_observation", "product": "dim_product"},
)
_check_query(
    "Q5_accepted_range",
    _Check("daily", "availability_pct", "accepted_range", minimum=0, maximum=100),
    _Check("daily", "max_price", "accepted_range", minimum=1, maximum=50),
    _Check("daily", "observation_count", "accepted_range", minimum=1, inclusive=False),
    models={"daily": "daily"},
)


@query("Q6_far_in_future")
def far_in_future(spark, sf_dir):
    rows = quality.far_in_future(Models(spark, sf_dir).observations, "observed_at", EARLY_AS_OF)
    return rows.select("event_id", "observed_at", "price")


@query("Q7_future_observations")
def future_observations(spark, sf_dir):
    return quality.future_observations(Models(spark, sf_dir).fact_observation, EARLY_AS_OF)


@query("Q8_unreconciled_runs")
def unreconciled_runs(spark, sf_dir):
    models = Models(spark, sf_dir)
    return quality.unreconciled_runs(models.stg_runs, models.fact_observation)


@query("Q9_check_suite")
def check_suite(spark, sf_dir):
    """All declared checks; row rules of written tables are counted while these are written."""
    watch = quality.Watch(quality.SUITE, AS_OF)
    models = build_warehouse(
        spark,
        scratch_path(spark, "warehouse"),
        materialize(adapter.raw_events(spark, sf_dir), "raw-events"),
        materialize(adapter.raw_runs(spark, sf_dir), "raw-runs"),
        materialize(adapter.product_seed(spark, sf_dir), "products"),
        adapter.retailer_seed(spark, sf_dir),
        AS_OF,
        watch,
    )
    return quality.run_checks(models, quality.SUITE, AS_OF, watch)


# ---- reports -----------------------------------------------------------------------------

START, END = date(2024, 1, 5), date(2024, 1, 25)
CHOSEN = ["TARGET", "GAMESTOP"]
# What a reader of the report ticked; the list length is theirs, not the data's.
CHOSEN_PRODUCTS = ["3", "4", "5", "7", "8", "9", "12"]


def _busiest(_: Models) -> Column:
    """The key of a product present at every scale."""
    return surrogate_key(F.lit("GAMESTOP"), F.lit("7"))


def _report(name: str, build: Callable[[Models], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf_dir: build(Models(spark, sf_dir))


def _by_product(m: Models) -> DataFrame:
    sources = ["TARGET", "WALMART", "POKEMON_CENTER", "GAMESTOP"]
    chosen = [surrogate_key(F.lit(sources[int(p) % 4]), F.lit(p)) for p in CHOSEN_PRODUCTS]
    return reports.availability_by_product(m.daily_table, START, END, CHOSEN + ["WALMART"], chosen)


def _recent(m: Models, chosen: list[str] | None = None) -> DataFrame:
    return reports.recent_state_changes(m.laid_out("fact_state_change", reports.DAY), m.dim_product, START, END, chosen)


_report("R1_overview_totals", lambda m: reports.overview_totals(m.mart_retailer))
_report("R2_retailer_summary", lambda m: reports.retailer_summary(m.mart_retailer))
_report("R3_retailers", lambda m: reports.retailers(m.dim_retailer))
_report("R4_products", lambda m: reports.products(m.dim_product, CHOSEN))
_report("R4_products_all", lambda m: reports.products(m.dim_product))
_report(
    "R5_availability_by_product",
    lambda m: reports.availability_by_product(m.daily_table, START, END),
)
_report(
    "R6_availability_timeline",
    lambda m: reports.availability_timeline(m.daily_table, _busiest(m), START, END),
)
_report("R7_price_history", lambda m: reports.price_history(m.laid_out("fact_price", reports.DAY), _busiest(m), START, END))
_report("R8_recent_state_changes", lambda m: _recent(m, CHOSEN))
_report(
    "R9_daily_observation_volume",
    lambda m: reports.daily_observation_volume(m.laid_out("fact_observation", reports.DAY), START, END),
)
_report("R10_membership_filters", _by_product)
_report("R11_stale_sources", lambda m: reports.stale_sources(m.mart_retailer))
_report("R12_transition_totals", lambda m: reports.transition_totals(_recent(m)))
_report(
    "R12_all_transition_totals",
    lambda m: reports.transition_totals(
        reports.within(m.laid_out("fact_state_change", reports.DAY), START, END)
    ),
)
_report(
    "R13_price_change_points",
    lambda m: reports.price_change_points(
        reports.price_history(m.laid_out("fact_price", reports.DAY), _busiest(m), START, END)
    ),
)
_report(
    "R14_lowest_availability",
    lambda m: reports.lowest_availability(
        reports.availability_by_product(m.daily_table, START, END)
    ),
)
_report("R15_filtered_summary", lambda m: reports.retailer_summary(m.mart_retailer, CHOSEN))
_report(
    "R15_filtered_volume",
    lambda m: reports.daily_observation_volume(m.laid_out("fact_observation", reports.DAY), START, END, CHOSEN),
)
_report(
    "X1_outages",
    lambda m: reports.outages(materialize(m.fact_state_change, "state-changes")),
)
_report("X2_last_restocks", lambda m: reports.last_restocks(m.fact_state_change))


def _as_text(name: str, text: str, views: dict[str, Callable[[Models], DataFrame]], **arguments) -> None:
    """A report run as SQL over views of the models."""

    def run(spark, sf_dir):
        models = Models(spark, sf_dir)
        sql_reports.register_views({view: build(models) for view, build in views.items()})
        bound = {k: v(spark) if callable(v) else v for k, v in arguments.items()}
        return sql_reports.report(spark, text, **bound)

    REGISTRY[name] = run


def _chosen_keys(spark: SparkSession) -> list[str]:
    sources = ["TARGET", "WALMART", "POKEMON_CENTER", "GAMESTOP"]
    keys = [surrogate_key(F.lit(sources[int(p) % 4]), F.lit(p)) for p in CHOSEN_PRODUCTS]
    return list(spark.range(1).select(*keys).first())


_DAYS = {"first_day": START, "last_day": END}
_as_text("R1_overview_totals_text", "overview_totals", {"mart_retailer_summary": lambda m: m.mart_retailer})
_as_text(
    "R8_recent_state_changes_text",
    "recent_state_changes",
    {"fact_inventory_state_change": lambda m: m.laid_out("fact_state_change", reports.DAY), "dim_product": lambda m: m.dim_product},
    **_DAYS,
    retailers=CHOSEN,
)
_as_text(
    "R9_daily_observation_volume_text",
    "daily_observation_volume",
    {"fact_inventory_observation": lambda m: m.laid_out("fact_observation", reports.DAY)},
    **_DAYS,
)
_as_text(
    "R10_membership_filters_text",
    "availability_by_product",
    {"mart_daily_product_availability": lambda m: m.daily_table},
    **_DAYS,
    retailers=CHOSEN + ["WALMART"],
    products=_chosen_keys,
)


@query("S22_incremental_refresh")
def incremental_refresh(spark, sf_dir):
    """The state-change facts after an early half, late rows of all days, and newer copies."""
    models = Models(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    staged = models.stg_events
    for part in ("cast(event_id as bigint) % 3 = 0", "cast(event_id as bigint) % 3 <> 0"):
        warehouse.refresh(staged.where(part), models.stg_runs, models.stg_products, models.stg_retailers, AS_OF, full=True)
    return spark.read.schema(models.fact_state_change.schema).parquet(warehouse.path("fact_inventory_state_change")).select(
        models.fact_state_change.columns
    )


# ---- single rules of the models ------------------------------------------------------------


def _count_by(attribute: str, *columns: str) -> Query:
    def run(spark, sf_dir):
        model = getattr(Models(spark, sf_dir), attribute)
        return model.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))

    return run


def _columns_of(attribute: str, *columns: str) -> Query:
    return lambda spark, sf_dir: getattr(Models(spark, sf_dir), attribute).select(*columns)


REGISTRY["T2_source_codes"] = _count_by("stg_events", "source_name")
REGISTRY["T3_price_cast"] = _columns_of("stg_events", "event_id", "loaded_at", "price")
REGISTRY["T4_blank_defaults"] = _count_by("stg_events", "currency", "location_type")
REGISTRY["T5_status_whitelist"] = _count_by("stg_events", "inventory_status")
REGISTRY["T7_run_duration"] = _columns_of("stg_runs", "run_id", "duration_seconds")
REGISTRY["T8_run_status_whitelist"] = _count_by("stg_runs", "status")
REGISTRY["I4_status_changed"] = _count_by("state_changes", "source", "status_changed")
REGISTRY["I5_restocked"] = _count_by("state_changes", "source", "restocked")
REGISTRY["I6_went_out_of_stock"] = _count_by("state_changes", "source", "went_out_of_stock")
REGISTRY["I7_hours_since_previous"] = _columns_of(
    "state_changes", "event_id", "hours_since_previous_observation"
)
REGISTRY["I9_price_changed"] = _count_by("price_changes", "source", "price_changed")
REGISTRY["I10_pct_change"] = _columns_of("price_changes", "event_id", "pct_change")
REGISTRY["I12_last_status"] = _columns_of(
    "daily", "source", "retailer_product_id", "observation_date", "last_status"
)
REGISTRY["I14_availability_pct"] = _columns_of(
    "daily", "source", "retailer_product_id", "observation_date", "availability_pct"
)


@query("I13_rollup_with_last_status")
def rollup_with_last_status(spark, sf_dir):
    """The two-step form of the daily roll-up: ranked rows joined to the aggregate."""
    keys = ["source", "retailer_product_id", "observation_date"]
    rows = Models(spark, sf_dir).observations.withColumn(
        "observation_date", F.to_date("observed_at")
    )
    order = F.array_position(F.array(*[F.lit(s or "") for s in intermediate.STATUS_ORDER]), F.col("inventory_status"))
    newest = Window.partitionBy(*keys).orderBy(F.desc("observed_at"), F.desc(order))
    last = (
        rows.withColumn("n", F.row_number().over(newest))
        .where("n = 1")
        .select(*keys, F.col("inventory_status").alias("last_status"))
    )
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("observation_count"))
    return counted.join(last, keys)


@query("S5_product_seed")
def product_seed_file(spark, sf_dir):
    path = scratch_path(spark, "seed")
    adapter.product_seed(spark, sf_dir).write.csv(path, header=True)
    return seeds.read_product_seed(spark, path)


@query("S6_retailer_seed")
def retailer_seed_file(spark, sf_dir):
    path = scratch_path(spark, "seed")
    adapter.retailer_seed(spark, sf_dir).write.csv(path, header=True)
    return staging.stage_retailers(seeds.read_retailer_seed(spark, path))


@query("S4_catalog_file")
def catalog_file(spark, sf_dir):
    """The catalog as JSON arrays of about ten thousand products each."""
    path = scratch_path(spark, "catalog")
    items = adapter.catalog(spark, sf_dir)
    parts = 1 + items.count() // 10_000
    (
        items.groupBy(F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"))
        .agg(F.to_json(F.collect_list(F.struct(*items.columns))).alias("value"))
        .select("value", "part")
        .write.partitionBy("part")
        .text(path)
    )
    return seeds.read_catalog(spark, f"{path}/part=*")


def prices_as_double(df: DataFrame) -> DataFrame:
    """Prices leave as doubles, so that no client compares decimals with floats."""
    return df.select(
        *[
            F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema
        ]
    )


def registered() -> dict[str, Query]:
    def bind(run: Query) -> Query:
        return lambda spark, sf_dir: prices_as_double(run(spark, sf_dir))

    return {name: bind(run) for name, run in REGISTRY.items()}
