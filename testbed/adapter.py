"""Driver tables seen as the raw inputs of the inventory history.

``events`` becomes the observation stream: a user is a product, an event a poll of it, and
every tenth poll is delivered twice. Codes are untidy on purpose so that staging has
something to do. ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.plans.ingest import ingest, run_frames
from shelflog.schemas import INVENTORY_EVENTS
from shelflog.session import prepare, scratch_path
from shelflog.sources import landing

AS_OF = datetime(2024, 2, 1)
EARLY_AS_OF = datetime(2024, 1, 29)

UNTIDY_SOURCE = """
    case user_id % 4 when 0 then ' target ' when 1 then 'Walmart'
                     when 2 then 'POKEMON_CENTER' else 'gamestop' end"""
SOURCE = f"upper(trim({UNTIDY_SOURCE}))"
PRODUCT_NAME = "concat('Product ', user_id)"
PRODUCT_URL = "concat('https://shop.example/', user_id)"
CATEGORY = "case user_id % 3 when 0 then 'trading-cards' when 1 then 'video-games' end"
STORE_ID = "case when user_id % 4 = 0 then '3991' end"
RUN_ID = f"concat({SOURCE}, '-', date_format(ts, 'yyyyMMdd'))"
K = "cast(get_json_object(props, '$.k') as bigint)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``, dealt evenly to the tasks: a file may hold a million narrow rows in one row group."""
    return table(spark, sf_dir, "events").hint("rebalance")


def raw_events(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    delivery = (
        "explode(case when event_id % 10 = 0 then array(0, 1) else array(0) end)"
        if copies
        else "0"
    )
    delivered = polls(spark, sf_dir).selectExpr("*", f"{K} as k", f"{delivery} as copy")
    return delivered.selectExpr(
        "cast(event_id as string) as event_id",
        f"{UNTIDY_SOURCE} as source",
        "cast(user_id as string) as retailer_product_id",
        f"{PRODUCT_NAME} as product_name",
        f"{PRODUCT_URL} as product_url",
        "case when user_id % 4 >= 2 then concat('SKU-', user_id) end as sku",
        "case when user_id % 4 = 1 then lpad(cast(user_id as string), 12, '0') end as upc",
        f"{CATEGORY} as category",
        "case when event_type <> 'error' then cast(value as decimal(12,2)) + copy end as price",
        "case k % 3 when 0 then '' when 1 then ' usd ' end as currency",
        """case event_type when 'purchase' then 'in_stock' when 'click' then 'in_stock'
                           when 'view' then 'OUT_OF_STOCK' when 'signup' then ' preorder '
                           else 'n/a' end as inventory_status""",
        "k as quantity_available",
        f"{STORE_ID} as store_id",
        """case k % 4 when 0 then ' online ' when 1 then 'in_store' when 2 then ''
           end as location_type""",
        "ts as observed_at",
        "ts + interval 5 seconds as extracted_at",
        f"{RUN_ID} as ingestion_run_id",
        "cast(null as string) as raw_file_path",
        "sha2(cast(event_id as string), 256) as source_response_hash",
        "'1.0' as schema_version",
        "props as raw_payload",
        "ts + make_dt_interval(0, 1 + copy) as loaded_at",
    ).select(*[F.col(f.name).cast(f.dataType) for f in INVENTORY_EVENTS])


def raw_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.expr("user_id % 4").alias("source_no"),
            F.expr("cast(ts as date)").alias("run_day"),
        )
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("completed_at"),
            F.count(F.lit(1)).alias("polls"),
            F.count_if(F.expr("event_type = 'error'")).alias("errors"),
        )
        .selectExpr("*", "source_no as user_id", "cast(run_day as timestamp_ntz) as ts")
        .selectExpr(
            f"{RUN_ID} as run_id",
            f"{UNTIDY_SOURCE} as source",
            "started_at as observed_at",
            "started_at",
            "completed_at",
            """case when day(run_day) = 15 then 'failed' when day(run_day) = 16 then 'odd'
                    when errors > 0 then ' partial_failure ' else 'SUCCESS' end as status""",
            "polls + errors as payloads_received",
            "polls + case when day(run_day) in (10, 20, 30) then 1 else 0 end as events_normalized",
            "errors as events_rejected",
            f"concat('raw_payloads/', {RUN_ID}) as raw_payload_path",
            f"concat('normalized_events/', {RUN_ID}) as normalized_output_path",
            f"concat('manifests/', {RUN_ID}) as manifest_path",
            "'[]' as error_summary",
            "'0.1.0' as pipeline_version",
            "completed_at + interval 1 hour as loaded_at",
        )
    )


def product_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product seen, but for some that are left out to give facts without a product."""
    seen = table(spark, sf_dir, "events").where("user_id % 29 <> 0").select("user_id").distinct()
    return seen.selectExpr(
        f"concat(lower({SOURCE}), '-', user_id) as product_id",
        f"{UNTIDY_SOURCE} as retailer",
        "cast(user_id as string) as retailer_product_id",
        f"{PRODUCT_NAME} as product_name",
        f"{PRODUCT_URL} as product_url",
        f"{CATEGORY} as category",
        f"{STORE_ID} as store_id",
    )


# The four retailers, by the source number of their products.
RETAILER_NAME = """case user_id % 4 when 0 then 'Target' when 1 then 'Walmart'
                                    when 2 then 'Pokemon Center' else 'GameStop' end"""
RETAILER_SITE = "concat('https://', lower(replace(" + RETAILER_NAME + ", ' ', '')), '.example')"
RETAILER_MODE = "case user_id % 4 when 0 then 'fixture_only' when 1 then 'live' when 2 then 'live ' else 'fixture_only' end"


def retailer_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retailers that any product belongs to."""
    seen = table(spark, sf_dir, "events").selectExpr("user_id % 4 as user_id").distinct()
    return seen.selectExpr(
        f"{UNTIDY_SOURCE} as retailer_code",
        f"{RETAILER_NAME} as retailer_name",
        f"{RETAILER_SITE} as website",
        f"{RETAILER_MODE} as integration_mode",
    )


def line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a long price history with many equal times."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        """concat(lpad(cast(l_orderkey as string), 12, '0'), '-', l_linenumber, '-',
                  l_partkey, '-', l_suppkey, '-', l_quantity) as event_id""",
        "cast(l_suppkey as string) as source",
        "cast(l_partkey as string) as retailer_product_id",
        "l_shipdate as observed_at",
        "cast(l_extendedprice as decimal(12,2)) as price",
        "case l_returnflag when 'N' then 'IN_STOCK' when 'R' then 'OUT_OF_STOCK' "
        "else 'PREORDER' end as inventory_status",
    )


# Payload text in the shapes of the four sources, written so that every rule is met: absent
# keys, explicit nulls, blank names, text where a flag belongs, negative and unreadable
# numbers, empty responses. Plain concatenation gives the same text in both engines.
PAYLOAD = """
case user_id % 4
when 0 then
  case when k % 10 = 0 then '{"data": {}}' else concat(
    '{"data":{"product":{"item":{"product_description":{"title":',
    case k % 7 when 0 then '""' when 1 then 'null' else concat('"Target item ', user_id, '"') end,
    '}},"price":{"current_retail":',
    case when event_type = 'error' and k % 2 = 0 then '-1.5' else amount end,
    '},"available_to_promise":{"availability":',
    case event_type when 'purchase' then '"in_stock"' when 'click' then '"AVAILABLE"'
      when 'view' then '"Not_Available"' when 'signup' then '"PREORDER"'
      else case k % 4 when 0 then 'null' when 1 then '"BACKORDER"' when 2 then '" AVAILABLE"'
           else '5' end end,
    ',"available_to_promise_quantity":',
    case k % 9 when 0 then '-2' when 1 then 'null' when 2 then '"7"' when 3 then '4.9'
      else cast(k as string) end,
    '},"tcin":"', user_id, '"}}}') end
when 1 then
  case when k % 10 = 0 then '{}' else concat(
    '{"itemId":"', user_id, '"',
    case k % 7 when 0 then '' else concat(',"name":"Walmart item ', user_id, '"') end,
    case k % 5 when 0 then concat(',"msrp":', amount)
      when 1 then concat(',"salePrice":null,"msrp":', amount)
      else concat(',"salePrice":', amount) end,
    case event_type when 'purchase' then ',"availableOnline":true'
      when 'view' then ',"availableOnline":false,"stock":"Available"'
      when 'click' then ',"availableOnline":"true","stock":"Available"'
      when 'signup' then ',"stock":"Preorder"' else ',"stock":"NOT available"' end,
    case k % 11 when 0 then ',"upc":12345' when 1 then '' else ',"upc":"00012345"' end, '}') end
when 2 then
  case k % 10 when 0 then '{"product":null}'
  when 1 then concat('{"product":{"title":"Shop item ', user_id, '","variants":[]}}')
  else concat('{"product":{"title":"Shop item ', user_id, '","variants":[{"price":"',
    case when k % 13 = 0 then 'n/a' else amount end, '","available":',
    case event_type when 'purchase' then 'true' when 'click' then '"true"'
      when 'view' then 'false' when 'signup' then 'null' else '1' end,
    ',"sku":"PC-', user_id, '"},{"price":"1.00","available":false}]}}') end
else
  case when k % 10 = 0 then '{}' else concat(
    '{"productName":"Game ', user_id, '","pricing":{',
    case k % 5 when 0 then concat('"listPrice":', amount)
      when 1 then concat('"salePrice":null,"listPrice":', amount)
      else concat('"salePrice":', amount, ',"listPrice":99') end,
    '},"availability":',
    case event_type when 'purchase' then '{"isInStock":true}'
      when 'view' then '{"isInStock":false,"isPreOrder":true}'
      when 'signup' then '{"isPreOrder":true}' when 'click' then 'null'
      else '{"isInStock":null,"isPreOrder":false}' end,
    case k % 11 when 0 then ',"sku":77' else concat(',"sku":"G-', user_id, '"') end, '}') end
end"""


# Where the four layouts keep names, prices and codes.
NAME_PATHS = ["$.data.product.item.product_description.title", "$.name", "$.product.title", "$.productName"]
PRICE_PATHS = ["$.data.product.price.current_retail", "$.salePrice", "$.msrp", "$.pricing.salePrice", "$.pricing.listPrice"]
CODE_PATHS = ["$.data.product.tcin", "$.itemId", "$.product.variants[0].sku", "$.sku"]


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected responses as they arrive: times as text, bodies as VARIANT."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", f"{K} as k", "cast(cast(value as decimal(12,2)) as string) as amount")
        .selectExpr(
            f"{SOURCE} as source",
            f"{RUN_ID} as run_id",
            "cast(user_id as string) as retailer_product_id",
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\") as observed_at",
            f"try_parse_json({PAYLOAD}) as raw_response",
            "ts + interval 5 seconds as extracted_at",
            "event_id as poll",
            "ts",
        )
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_seed(spark, sf_dir).selectExpr(
        "product_id as id",
        "retailer",
        "retailer_product_id",
        "product_name as name",
        "product_url as url",
        "category",
        "store_id",
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs as the collector opened them, before anything was normalised."""
    return raw_runs(spark, sf_dir).selectExpr(
        "run_id",
        "upper(trim(source)) as source",
        "observed_at",
        "started_at",
        "completed_at",
    )


def whole_runs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Everything one ingestion writes."""
    return run_frames(payloads(spark, sf_dir), catalog(spark, sf_dir), runs(spark, sf_dir))


def land_all(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All runs, with their manifests, in the landing zone ``root``, as compressed files."""
    ingest(prepare(spark), root, payloads(spark, sf_dir), catalog(spark, sf_dir), runs(spark, sf_dir), compression="gzip")


def landed(spark: SparkSession, sf_dir: str, *kinds: str) -> str:
    """A new landing zone holding the given kinds of files, all if none is given.

    The manifests are always there, as runs without one are not read.
    """
    root = scratch_path(prepare(spark), "landing")
    if not kinds:
        land_all(spark, sf_dir, root)
        return root
    frames = whole_runs(spark, sf_dir)
    names = {landing.PAYLOADS: "payloads", landing.EVENTS: "events", landing.REJECTS: "rejects", landing.MANIFESTS: "manifests"}
    for kind in dict.fromkeys([*kinds, landing.MANIFESTS]):
        frame = frames[names[kind]]
        landing.append_files(landing.with_paths(frame) if kind == landing.MANIFESTS else frame, root, kind)
    return root
