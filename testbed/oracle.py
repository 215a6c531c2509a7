"""Oracle SQL, composed from shared common table expressions."""

from __future__ import annotations

import re

from testbed.adapter import CODE_PATHS, NAME_PATHS, PAYLOAD, PRICE_PATHS

CTES: dict[str, str] = {}
QUERIES: dict[str, str] = {}

_SRC = """case user_id % 4 when 0 then 'TARGET' when 1 then 'WALMART'
               when 2 then 'POKEMON_CENTER' else 'GAMESTOP' end"""
_UNTIDY = """case user_id % 4 when 0 then ' target ' when 1 then 'Walmart'
               when 2 then 'POKEMON_CENTER' else 'gamestop' end"""
_K = "cast(json_extract_string(props, '$.k') as bigint)"


def share(part: str, whole: str) -> str:
    """Exact percent to one place by integers, halves away from zero."""
    return f"(((2000 * ({part}) + ({whole})) // nullif(2 * ({whole}), 0)) / 10.0)::double"


def crossed(unit: str, a: str, b: str) -> str:
    return f"date_diff('{unit}', {a}, {b})::bigint"


CTES["raw_events"] = f"""
select cast(event_id as varchar) as event_id, {_UNTIDY} as source,
       cast(user_id as varchar) as retailer_product_id,
       'Product ' || user_id as product_name, 'https://shop.example/' || user_id as product_url,
       case when user_id % 4 >= 2 then 'SKU-' || user_id end as sku,
       case when user_id % 4 = 1 then lpad(cast(user_id as varchar), 12, '0') end as upc,
       case user_id % 3 when 0 then 'trading-cards' when 1 then 'video-games' end as category,
       cast(case when event_type <> 'error' then cast(value as decimal(12,2)) + copy end
            as decimal(12,2)) as price,
       case {_K} % 3 when 0 then '' when 1 then ' usd ' end as currency,
       case event_type when 'purchase' then 'in_stock' when 'click' then 'in_stock'
                       when 'view' then 'OUT_OF_STOCK' when 'signup' then ' preorder '
                       else 'n/a' end as inventory_status,
       {_K} as quantity_available,
       case when user_id % 4 = 0 then '3991' end as store_id,
       case {_K} % 4 when 0 then ' online ' when 1 then 'in_store' when 2 then '' end
            as location_type,
       ts as observed_at, ts + interval 5 second as extracted_at,
       {_SRC} || '-' || strftime(ts, '%Y%m%d') as ingestion_run_id,
       cast(null as varchar) as raw_file_path,
       sha256(cast(event_id as varchar)) as source_response_hash, '1.0' as schema_version,
       props as raw_payload, ts + to_hours(cast(1 + copy as integer)) as loaded_at
from (select *, unnest(case when event_id % 10 = 0 then [0, 1] else [0] end) as copy
      from events)"""
CTES["raw_runs"] = f"""
select {_SRC} || '-' || strftime(run_day, '%Y%m%d') as run_id, {_UNTIDY} as source,
       started_at as observed_at, started_at, completed_at,
       case when day(run_day) = 15 then 'failed' when day(run_day) = 16 then 'odd'
            when errors > 0 then ' partial_failure ' else 'SUCCESS' end as status,
       polls + errors as payloads_received,
       polls + case when day(run_day) in (10, 20, 30) then 1 else 0 end as events_normalized,
       errors as events_rejected,
       'raw_payloads/' || {_SRC} || '-' || strftime(run_day, '%Y%m%d') as raw_payload_path,
       'normalized_events/' || {_SRC} || '-' || strftime(run_day, '%Y%m%d')
           as normalized_output_path,
       'manifests/' || {_SRC} || '-' || strftime(run_day, '%Y%m%d') as manifest_path,
       '[]' as error_summary, '0.1.0' as pipeline_version,
       completed_at + interval 1 hour as loaded_at
from (select user_id % 4 as user_id, cast(ts as date) as run_day, min(ts) as started_at,
             max(ts) as completed_at, count(*)::bigint as polls,
             count(*) filter (event_type = 'error')::bigint as errors
      from events group by 1, 2)"""
CTES["product_seed"] = f"""
select lower({_SRC}) || '-' || user_id as product_id, {_UNTIDY} as retailer,
       cast(user_id as varchar) as retailer_product_id, 'Product ' || user_id as product_name,
       'https://shop.example/' || user_id as product_url,
       case user_id % 3 when 0 then 'trading-cards' when 1 then 'video-games' end as category,
       case when user_id % 4 = 0 then '3991' end as store_id
from (select distinct user_id from events where user_id % 29 <> 0)"""
CTES["retailer_seed"] = f"""
select {_UNTIDY} as retailer_code,
       case user_id when 0 then 'Target' when 1 then 'Walmart' when 2 then 'Pokemon Center'
                    else 'GameStop' end as retailer_name,
       case user_id when 0 then 'https://target.example' when 1 then 'https://walmart.example'
                    when 2 then 'https://pokemoncenter.example'
                    else 'https://gamestop.example' end as website,
       case user_id when 0 then 'fixture_only' when 1 then 'live' when 2 then 'live '
                    else 'fixture_only' end as integration_mode
from (select distinct user_id % 4 as user_id from events)"""

CTES["stg_inventory_events"] = """
select event_id, upper(trim(source)) as source_name, retailer_product_id, product_name,
       product_url, sku, upc, category, price,
       coalesce(nullif(upper(trim(currency)), ''), 'USD') as currency,
       case when upper(trim(inventory_status)) in ('IN_STOCK', 'OUT_OF_STOCK', 'PREORDER',
            'BACKORDER') then upper(trim(inventory_status)) else 'UNKNOWN' end
            as inventory_status,
       quantity_available, store_id,
       coalesce(nullif(upper(trim(location_type)), ''), 'UNKNOWN') as location_type,
       observed_at, extracted_at, ingestion_run_id, raw_file_path, source_response_hash,
       schema_version, raw_payload, loaded_at
from raw_events"""
CTES["stg_ingestion_runs"] = f"""
select run_id, upper(trim(source)) as source_name, observed_at, started_at, completed_at,
       {crossed('second', 'started_at', 'completed_at')} as duration_seconds,
       case when upper(trim(status)) in ('SUCCESS', 'PARTIAL_FAILURE', 'FAILED')
            then upper(trim(status)) else 'UNKNOWN' end as status,
       payloads_received, events_normalized, events_rejected, raw_payload_path,
       normalized_output_path, manifest_path, error_summary, pipeline_version, loaded_at
from raw_runs"""
CTES["stg_products"] = """
select product_id, upper(trim(retailer)) as retailer, retailer_product_id, product_name,
       product_url, category, store_id
from product_seed"""
CTES["stg_retailers"] = """
select upper(trim(retailer_code)) as retailer_code, retailer_name, website,
       upper(trim(integration_mode)) as integration_mode
from retailer_seed"""

CTES["deduplicated"] = """
select event_id, source_name as source, retailer_product_id, product_name, product_url, sku,
       upc, category, price, currency, inventory_status, quantity_available, store_id,
       location_type, observed_at, extracted_at, ingestion_run_id, raw_file_path,
       source_response_hash, schema_version, loaded_at
from stg_inventory_events
qualify row_number() over (partition by event_id
    order by loaded_at desc nulls first, extracted_at desc nulls first,
             ingestion_run_id desc nulls first) = 1"""


def _state_changes(source: str) -> str:
    return f"""
select event_id, source, retailer_product_id, observed_at, previous_observed_at,
       previous_status, inventory_status as current_status,
       previous_status is not null and previous_status is distinct from inventory_status
           as status_changed,
       previous_status is not null and previous_status <> 'IN_STOCK'
           and inventory_status = 'IN_STOCK' as restocked,
       previous_status = 'IN_STOCK' and inventory_status = 'OUT_OF_STOCK' as went_out_of_stock,
       {crossed('hour', 'previous_observed_at', 'observed_at')}
           as hours_since_previous_observation
from (select *, lag(inventory_status) over series as previous_status,
             lag(observed_at) over series as previous_observed_at
      from {source}
      window series as (partition by source, retailer_product_id
                        order by observed_at nulls last, event_id))"""


def _price_changes(source: str) -> str:
    # Percent change in whole cents, so that rounding is exact.
    return f"""
select event_id, source, retailer_product_id, observed_at, previous_observed_at,
       previous_price, price as current_price,
       previous_price is not null and previous_price <> price as price_changed,
       (sign(now_c - before_c)
        * ((20000 * abs(now_c - before_c) + before_c) // nullif(2 * before_c, 0)) / 100.0)::double
           as pct_change
from (select *, cast(price * 100 as bigint) as now_c, cast(previous_price * 100 as bigint)
             as before_c
      from (select *, lag(price) over series as previous_price,
                   lag(observed_at) over series as previous_observed_at
            from {source} where price is not null
            window series as (partition by source, retailer_product_id
                              order by observed_at nulls last, event_id)))"""


CTES["state_changes"] = _state_changes("deduplicated")
CTES["price_changes"] = _price_changes("deduplicated")
def _daily(source: str) -> str:
    return f"""
select source, retailer_product_id, observation_date, observation_count,
       in_stock_observations,
       {share('in_stock_observations', 'observation_count')} as availability_pct,
       min_price, max_price, avg_price, last_observed_at, last_status
from (select source, retailer_product_id, cast(observed_at as date) as observation_date,
             count(*)::bigint as observation_count,
             count(*) filter (inventory_status = 'IN_STOCK')::bigint as in_stock_observations,
             min(price) as min_price, max(price) as max_price,
             sum(price)::double / nullif(count(price), 0) as avg_price,
             max(observed_at) as last_observed_at
      from {source} group by 1, 2, 3)
join (select source, retailer_product_id, cast(observed_at as date) as observation_date,
             inventory_status as last_status
      from {source}
      qualify row_number() over (
          partition by source, retailer_product_id, cast(observed_at as date)
          order by observed_at desc nulls last,
                   list_position(['UNKNOWN', 'BACKORDER', 'PREORDER', 'OUT_OF_STOCK',
                                  'IN_STOCK'], inventory_status) desc) = 1)
using (source, retailer_product_id, observation_date)"""


CTES["daily_inventory"] = _daily("deduplicated")
_CALENDAR = """
select date_day, cast(strftime(date_day, '%Y%m%d') as integer) as date_key,
       year(date_day)::integer as year, month(date_day)::integer as month,
       day(date_day)::integer as day_of_month, dayofweek(date_day)::integer as day_of_week,
       strftime(date_day, '%a') as day_name, strftime(date_day, '%b') as month_name,
       weekofyear(date_day)::integer as week_of_year,
       dayofweek(date_day) in (0, 6) as is_weekend
from (select cast(unnest(generate_series({first}, {last}, interval 1 day)) as date) as date_day
      {source})"""
CTES["dim_date"] = _CALENDAR.format(first="timestamp '2024-01-01'", last="timestamp '2025-01-31'", source="")
CTES["observed_calendar"] = _CALENDAR.format(
    first="first", last="last",
    source="from (select date_trunc('day', min(ts)) as first, date_trunc('day', max(ts)) as last from events)",
)
CTES["dim_product"] = """
select md5(coalesce(retailer, '_dbt_utils_surrogate_key_null_') || '-'
           || coalesce(retailer_product_id, '_dbt_utils_surrogate_key_null_')) as product_key,
       product_id, retailer as source, retailer_product_id, product_name, product_url, category,
       store_id
from stg_products"""
CTES["dim_retailer"] = """
select md5(coalesce(retailer_code, '_dbt_utils_surrogate_key_null_')) as retailer_key,
       retailer_code as source, retailer_name, website, integration_mode
from stg_retailers"""
_DIMS = """
left join dim_product p on p.source = e.source and p.retailer_product_id = e.retailer_product_id
left join dim_retailer r on r.source = e.source"""
_DATE = "left join dim_date d on d.date_day = cast(e.observed_at as date)"
CTES["fact_inventory_observation"] = f"""
select e.event_id, product_key, retailer_key, date_key, e.source, e.retailer_product_id, price,
       currency, inventory_status, quantity_available, e.store_id, location_type, observed_at,
       extracted_at, ingestion_run_id
from deduplicated e {_DIMS} {_DATE}"""
CTES["fact_inventory_state_change"] = f"""
select e.event_id as state_change_event_id, product_key, retailer_key, date_key, e.source,
       e.retailer_product_id, previous_status, current_status, restocked, went_out_of_stock,
       previous_observed_at, observed_at, hours_since_previous_observation
from (select * from state_changes where status_changed) e {_DIMS} {_DATE}"""
CTES["fact_price_observation"] = f"""
select e.event_id, product_key, retailer_key, date_key, e.source, e.retailer_product_id,
       previous_price, current_price, price_changed, pct_change, previous_observed_at,
       observed_at
from price_changes e {_DIMS} {_DATE}"""
def _mart_daily(daily: str) -> str:
    return f"""
select product_key, retailer_key, e.source, e.retailer_product_id, product_name, category,
       observation_date, observation_count, in_stock_observations, availability_pct, min_price,
       max_price, avg_price, last_status, last_observed_at
from {daily} e {_DIMS}"""


CTES["mart_daily"] = _mart_daily("daily_inventory")
CTES["run_statistics"] = """
select source_name as source, count(*)::bigint as total_runs,
       count(*) filter (status = 'SUCCESS')::bigint as successful_runs,
       count(*) filter (status = 'PARTIAL_FAILURE')::bigint as partial_failure_runs,
       count(*) filter (status = 'FAILED')::bigint as failed_runs,
       sum(events_normalized)::bigint as total_events_normalized,
       sum(events_rejected)::bigint as total_events_rejected,
       avg(duration_seconds)::double as avg_run_duration_seconds,
       max(observed_at) as last_observed_at
from stg_ingestion_runs group by 1"""
CTES["source_availability"] = """
select source, sum(cast(availability_pct as decimal(4,1)))::double
               / nullif(count(availability_pct), 0) as avg_availability_pct
from daily_inventory group by 1"""
CTES["mart_retailer_summary"] = f"""
select retailer_key, r.source, retailer_name, integration_mode, total_runs, successful_runs,
       partial_failure_runs, failed_runs,
       {share('successful_runs + partial_failure_runs', 'total_runs')} as run_success_rate_pct,
       total_events_normalized, total_events_rejected, avg_run_duration_seconds,
       last_observed_at,
       {crossed('hour', 'last_observed_at', "timestamp '2024-02-01'")}
           as hours_since_last_observation,
       avg_availability_pct
from dim_retailer r
left join run_statistics s on s.source = r.source
left join source_availability a on a.source = r.source"""

for _name, _cte in {
    "T1_stg_inventory_events": "stg_inventory_events",
    "T6_stg_ingestion_runs": "stg_ingestion_runs",
    "T9_stg_products": "stg_products",
    "T10_stg_retailers": "stg_retailers",
    "I2_deduplicated_observations": "deduplicated",
    "I3_state_changes": "state_changes",
    "I8_price_changes": "price_changes",
    "I11_daily_inventory": "daily_inventory",
    "M1_dim_date": "observed_calendar",
    "M2_dim_product": "dim_product",
    "M3_dim_retailer": "dim_retailer",
    "M4_fact_inventory_observation": "fact_inventory_observation",
    "M5_fact_inventory_state_change": "fact_inventory_state_change",
    "M6_fact_price_observation": "fact_price_observation",
    "M7_mart_daily_product_availability": "mart_daily",
    "M8_run_statistics": "run_statistics",
    "M9_source_availability": "source_availability",
    "M10_mart_retailer_summary": "mart_retailer_summary",
}.items():
    QUERIES[_name] = f"select * from {_cte}"

CTES["line_prices"] = """
select lpad(cast(l_orderkey as varchar), 12, '0') || '-' || l_linenumber || '-' || l_partkey
           || '-' || l_suppkey || '-' || l_quantity as event_id,
       cast(l_suppkey as varchar) as source, cast(l_partkey as varchar) as retailer_product_id,
       l_shipdate as observed_at, cast(l_extendedprice as decimal(12,2)) as price,
       case l_returnflag when 'N' then 'IN_STOCK' when 'R' then 'OUT_OF_STOCK'
            else 'PREORDER' end as inventory_status
from lineitem"""
CTES["line_state_changes"] = _state_changes("line_prices")
CTES["line_price_changes"] = _price_changes("line_prices")
QUERIES["I3_state_changes_lineitem"] = "select * from line_state_changes"
QUERIES["I8_price_changes_lineitem"] = "select * from line_price_changes"


# ---- normalisation ---------------------------------------------------------------------

_PAYLOAD = PAYLOAD.replace("as string", "as varchar")
CTES["payloads"] = f"""
select {_SRC} as source, {_SRC} || '-' || strftime(ts, '%Y%m%d') as run_id,
       cast(user_id as varchar) as retailer_product_id, ts as observed_at,
       ts + interval 5 second as extracted_at, event_id as poll, cast({_PAYLOAD} as json) as j
from (select *, {_K} as k, cast(cast(value as decimal(12,2)) as varchar) as amount from events)"""
_ID = """
substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
|| translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3)
|| '-' || substr(h, 21, 12)"""


def _name_digest(source: str, product: str, moment: str) -> str:
    text = f"""{source} || ':' || {product} || ':' || strftime({moment}, '%Y-%m-%dT%H:%M:%S')
        || case when date_part('microseconds', {moment}) % 1000000 = 0 then ''
                else '.' || strftime({moment}, '%f') end || '+00:00'"""
    return f"sha1(unhex('6f8f2c2e9b1d4b1a9b3a1f7d9e6a0c11') || encode({text}))"


def _path(path: str) -> str:
    return f"json_extract(j, '$.{path}')"


def _text(path: str) -> str:
    return f"json_extract_string(j, '$.{path}')"


def _kind(path: str) -> str:
    return f"coalesce(json_type({_path(path)}), 'ABSENT')"


_T = "data.product"
_FLAG = {
    "WALMART": "availableOnline",
    "POKEMON_CENTER": "product.variants[0].available",
    "GAMESTOP": "availability.isInStock",
}


def _flag(source: str, otherwise: str) -> str:
    path = _FLAG[source]
    return f"""case when {_kind(path)} = 'BOOLEAN' and {_text(path)} = 'true' then 'IN_STOCK'
        when {_kind(path)} = 'BOOLEAN' and {_text(path)} = 'false' then 'OUT_OF_STOCK'
        else {otherwise} end"""


_PREORDER = """case when json_extract_string(j, '$.availability.isPreOrder') = 'true'
    then 'PREORDER' else 'UNKNOWN' end"""
_STOCK_WORD = """case lower(json_extract_string(j, '$.stock')) when 'available' then 'IN_STOCK'
    when 'not available' then 'OUT_OF_STOCK' when 'unavailable' then 'OUT_OF_STOCK'
    when 'preorder' then 'PREORDER' else 'UNKNOWN' end"""
_TARGET_WORD = f"""case upper({_text(_T + '.available_to_promise.availability')})
    when 'AVAILABLE' then 'IN_STOCK' when 'IN_STOCK' then 'IN_STOCK'
    when 'UNAVAILABLE' then 'OUT_OF_STOCK' when 'OUT_OF_STOCK' then 'OUT_OF_STOCK'
    when 'NOT_AVAILABLE' then 'OUT_OF_STOCK' when 'PREORDER' then 'PREORDER'
    when 'BACKORDER' then 'BACKORDER' else 'UNKNOWN' end"""


def _first_key(first: str, second: str) -> str:
    return f"case when {_kind(first)} = 'ABSENT' then {_text(second)} else {_text(first)} end"


CTES["read_payloads"] = f"""
select p.*, c.source is not null as in_catalog, c.product_name as catalog_name, c.product_url,
       c.category, case when p.source = 'TARGET' then c.store_id end as store_id,
       case p.source when 'TARGET' then {_text(_T + '.item.product_description.title')}
            when 'WALMART' then {_text('name')}
            when 'POKEMON_CENTER' then {_text('product.title')}
            else {_text('productName')} end as own_name,
       case p.source when 'TARGET' then {_text(_T + '.price.current_retail')}
            when 'WALMART' then {_first_key('salePrice', 'msrp')}
            when 'POKEMON_CENTER' then {_text('product.variants[0].price')}
            else {_first_key('pricing.salePrice', 'pricing.listPrice')} end as price_text,
       case p.source when 'TARGET' then {_TARGET_WORD}
            when 'WALMART' then {_flag('WALMART', _STOCK_WORD)}
            when 'POKEMON_CENTER' then {_flag('POKEMON_CENTER', "'UNKNOWN'")}
            else {_flag('GAMESTOP', _PREORDER)} end as inventory_status,
       case when p.source = 'TARGET'
            then {_text(_T + '.available_to_promise.available_to_promise_quantity')} end
            as quantity_text,
       case p.source when 'POKEMON_CENTER' then {_kind('product.variants[0].sku')}
            when 'GAMESTOP' then {_kind('sku')} else 'ABSENT' end as sku_kind,
       case p.source when 'POKEMON_CENTER' then {_text('product.variants[0].sku')}
            when 'GAMESTOP' then {_text('sku')} end as sku,
       case p.source when 'WALMART' then {_kind('upc')} else 'ABSENT' end as upc_kind,
       case p.source when 'WALMART' then {_text('upc')} end as upc,
       case p.source when 'TARGET' then {_kind(_T)} = 'ABSENT'
            when 'POKEMON_CENTER' then {_kind('product')} in ('ABSENT', 'NULL') else false end
            as no_product,
       p.source in ('WALMART', 'GAMESTOP') and len(json_keys(j)) = 0 as empty_response,
       p.source = 'TARGET'
           and {_kind(_T + '.available_to_promise.availability')} in ('UBIGINT', 'BIGINT')
           as odd_availability
from payloads p
left join (select *, upper(trim(retailer)) as source from product_seed) c
  using (source, retailer_product_id)"""
CTES["examined"] = """
select *, try_cast(price_text as double) as price,
       cast(trunc(try_cast(quantity_text as double)) as bigint) as quantity_available,
       list_filter([case when no_product then 'no product data' end,
         case when empty_response then 'empty response' end,
         case when odd_availability then 'malformed availability' end,
         case when not in_catalog then 'product not in catalog' end,
         case when price_text is not null and try_cast(price_text as double) is null
              then 'price is not a number' end,
         case when try_cast(price_text as double) < 0 then 'price must not be negative' end,
         case when try_cast(quantity_text as double) < 0
              then 'quantity_available must not be negative' end,
         case when sku_kind not in ('ABSENT', 'NULL', 'VARCHAR') then 'sku is not text' end,
         case when upc_kind not in ('ABSENT', 'NULL', 'VARCHAR') then 'upc is not text' end],
         lambda x: x is not null) as reasons
from read_payloads"""
CTES["accepted"] = f"""
select {_ID} as event_id, source, retailer_product_id,
       coalesce(nullif(own_name, ''), catalog_name) as product_name, product_url, sku, upc,
       category, price, 'USD' as currency, inventory_status, quantity_available, store_id,
       'ONLINE' as location_type, observed_at, extracted_at, run_id as ingestion_run_id,
       '1.0' as schema_version
from (select *, {_name_digest('source', 'retailer_product_id', 'observed_at')} as h
      from examined where len(reasons) = 0)"""
for _name, _source in {
    "N1_target_mapping": "TARGET",
    "N2_walmart_mapping": "WALMART",
    "N3_storefront_mapping": "POKEMON_CENTER",
    "N4_gamestop_mapping": "GAMESTOP",
}.items():
    QUERIES[_name] = f"select *, cast(null as varchar) as raw_file_path from accepted where source = '{_source}'"
QUERIES["N5_event_id"] = f"""
select event_id, {_ID} as uuid, {_ID.replace('(h,', '(h0,')} as uuid_whole_second
from (select event_id, {_name_digest(_SRC, 'user_id', 'ts')} as h,
             {_name_digest(_SRC, 'user_id', "date_trunc('second', ts)")} as h0 from events)"""
QUERIES["N6_payload_hash"] = f"""
select event_id, sha256('{{"a":' || {_K} || ',"z":' || user_id || '}}') as digest, true as same,
       sha256('{{"a":"' || event_type || '","n":{{"b":{{"t":true}},"y":[' || user_id || ',null]}}}}') as nested_digest,
       true as nested_same
from events"""
QUERIES["N7_validation_reasons"] = """
select source, reason, count(*)::bigint as records
from (select source, unnest(reasons) as reason from examined) group by 1, 2"""
QUERIES["N8_utc_normalisation"] = """
select event_id, case when event_id % 5 <> 2 then ts end as observed_at,
       case when event_id % 5 <> 2 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as text
from events"""
QUERIES["N9_rejected_records"] = """
select run_id as ingestion_run_id, source, array_to_string(reasons, '; ') as reason,
       retailer_product_id, extracted_at as occurred_at, true as excerpt_fits,
       case when length(cast(j as varchar)) = 2 then cast(j as varchar) end as excerpt_if_empty,
       (length(cast(j as varchar)) - length(replace(cast(j as varchar), '"', '')))::bigint
           as excerpt_quotes
from examined where len(reasons) > 0"""
QUERIES["N9_valid_rejected_split"] = """
select source, count(*) filter (len(reasons) = 0)::bigint as valid,
       count(*) filter (len(reasons) > 0)::bigint as rejected
from examined group by 1"""
QUERIES["N10_name_fallback"] = """
select source, starts_with(product_name, 'Product ') as from_catalog,
       count(*)::bigint as observations
from accepted group by 1, 2"""
QUERIES["N11_catalog_of_source"] = """
select source, in_catalog as tracked, count(distinct retailer_product_id)::bigint as products
from examined group by 1, 2"""
QUERIES["N12_constants"] = """
select source, currency, location_type, schema_version, count(*)::bigint as observations
from accepted group by 1, 2, 3, 4"""
CTES["run_counts"] = """
select run_id, count(*)::bigint as payloads_received,
       count(*) filter (len(reasons) = 0)::bigint as events_normalized,
       count(*) filter (len(reasons) > 0)::bigint as events_rejected
from examined group by 1"""
CTES["run_reasons"] = """
select run_id, list(reason order by n) as reasons
from (select run_id, array_to_string(reasons, '; ') as reason,
             row_number() over (partition by run_id order by retailer_product_id,
                                array_to_string(reasons, '; '), observed_at) as n
      from examined where len(reasons) > 0) where n <= 10 group by 1"""
CTES["manifests"] = """
select r.run_id, upper(trim(r.source)) as source, observed_at, started_at, completed_at,
       case when payloads_received = 0 or events_normalized = 0 then 'FAILED'
            when events_rejected > 0 then 'PARTIAL_FAILURE' else 'SUCCESS' end as status,
       c.payloads_received, c.events_normalized, c.events_rejected,
       '[' || coalesce('"' || array_to_string(reasons, '","') || '"', '') || ']'
           as error_summary,
       '0.1.0' as pipeline_version
from (select run_id, source, observed_at, started_at, completed_at from raw_runs) r
left join run_counts c using (run_id) left join run_reasons using (run_id)"""
QUERIES["N13_run_status"] = """
select run_id, status, payloads_received, events_normalized, events_rejected from manifests"""
QUERIES["N14_manifests"] = "select * from manifests"
QUERIES["N15_ingestion_summary"] = f"""
select count(*)::bigint as total_runs, sum(events_normalized)::bigint as total_events,
       sum(events_rejected)::bigint as total_rejected,
       count(*) filter (status = 'FAILED')::bigint as failed_runs,
       {share("count(*) filter (status <> 'FAILED')", "count(*)")} as success_rate
from manifests"""
QUERIES["N16_run_metrics"] = f"""
select count(*)::bigint as total_runs,
       count(*) filter (status = 'SUCCESS')::bigint as successful_runs,
       count(*) filter (status = 'PARTIAL_FAILURE')::bigint as partial_failure_runs,
       count(*) filter (status not in ('SUCCESS', 'PARTIAL_FAILURE'))::bigint as failed_runs,
       sum(events_normalized)::bigint as total_events,
       sum(events_rejected)::bigint as total_rejected,
       count(distinct source)::bigint as sources_seen, min(observed_at) as observed_at_min,
       max(observed_at) as observed_at_max,
       round(sum(date_diff('microsecond', started_at, completed_at)) / 1000000.0 / count(*), 3)
           as avg_run_duration_seconds,
       {share("count(*) filter (status in ('SUCCESS', 'PARTIAL_FAILURE'))", "count(*)")}
           as success_rate_pct,
       (select count(*)::bigint from stg_products) as products_tracked,
       (select count(distinct retailer)::bigint from stg_products) as retailers_tracked
from manifests"""


# ---- landing zone and raw tables ---------------------------------------------------------

QUERIES["S1_scan_events"] = """
select *, cast(null as varchar) as raw_file_path, ingestion_run_id as run_id from accepted"""


def _first_leaf(paths: list[str]) -> str:
    return "coalesce(" + ", ".join(f"json_extract_string(j, '{path}')" for path in paths) + ")"


_LEAVES = f"""{_first_leaf(NAME_PATHS)} as name, cast({_first_leaf(PRICE_PATHS)} as double) as price,
       {_first_leaf(CODE_PATHS)} as code"""
QUERIES["S2_scan_payloads"] = f"""
select source, run_id, retailer_product_id, observed_at, true as has_response, {_LEAVES}
from payloads"""
QUERIES["S3_scan_manifests"] = "select * from manifests"


def _folder(kind: str) -> str:
    return f"""'{kind}/source=' || source || '/year=' || strftime(observed_at, '%Y')
    || '/month=' || strftime(observed_at, '%m') || '/day=' || strftime(observed_at, '%d')
    || '/run_id=' || run_id"""


QUERIES["S7_written_runs"] = f"""
select run_id, {_folder('raw_payloads')} as raw_payload_path,
       {_folder('normalized_events')} as normalized_output_path,
       {_folder('manifests')} as manifest_path
from manifests"""
QUERIES["S8_immutability_guard"] = """
select source, count(*)::bigint as payloads, true as second_write_refused,
       true as silent_run_refused
from payloads group by 1"""
QUERIES["S9_scan_rejects"] = QUERIES["N9_rejected_records"].replace(
    "run_id as ingestion_run_id", "run_id"
)
_BAD_EVENT = """'{"event_id": "' || retailer_product_id || '-' || text_time || '"'"""
CTES["payload_texts"] = "select *, strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as text_time from payloads"
CTES["bad_lines"] = f"""
select source, run_id, case when cast(retailer_product_id as bigint) % 20 = 3 then 'without key' else 'unreadable' end as fault,
       case cast(retailer_product_id as bigint) % 20
            when 0 then {_BAD_EVENT}
            when 1 then {_BAD_EVENT} || ', "quantity_available": "many"}}'
            when 2 then {_BAD_EVENT} || '}}' || {_BAD_EVENT} || '}}'
            else '{{"retailer_product_id": "' || retailer_product_id || '"}}' end as line
from payload_texts where cast(retailer_product_id as bigint) % 20 < 4"""
QUERIES["S1_bad_lines"] = """
select 'normalized_events' as kind, source, run_id, fault, line, count(*)::bigint as copies,
       (select count(*)::bigint from accepted) as good_lines, 0::bigint as loaded_again
from bad_lines group by all"""
QUERIES["S8_unfinished_runs"] = """
select source, ingestion_run_id as run_id, count(*)::bigint as events, 0::bigint as seen_before,
       (select count(distinct run_id)::bigint from payloads) as open_runs
from accepted where cast(retailer_product_id as bigint) % 2 = 0 group by 1, 2"""
QUERIES["S10_artefact_audit"] = """
select source, run_id, case day(observed_at) when 3 then 'raw_payloads' else 'normalized_events' end as kind,
       run_id in (select run_id from payloads) and (day(observed_at) = 3
           or run_id in (select ingestion_run_id from accepted)) as was_booked, true as is_there
from manifests where day(observed_at) in (3, 17)"""
CTES["line_digests"] = f"""
select {_SRC} || '-' || strftime(ts, '%Y%m%d') as run_id, sha256(event_type || event_id) as digest,
       count(*) as copies
from events group by 1, 2"""
CTES["chunk_digests"] = """
select run_id, cast('0x' || substr(digest, 1, 8) as bigint) % 4096 as chunk,
       sha256(string_agg(digest || ':' || copies, chr(10) order by digest || ':' || copies)) as part
from line_digests group by 1, 2"""
QUERIES["S10_content_digests"] = """
select run_id, sha256(string_agg(part, chr(10) order by chunk)) as digest
from chunk_digests group by 1"""
QUERIES["S11_run_files"] = "select distinct source, run_id from accepted join payloads using (source) " \
    "where ingestion_run_id = run_id"
QUERIES["S13_attached_payloads"] = f"""
select event_id, source, false as without, {_LEAVES}
from accepted join last_payloads using (ingestion_run_id, retailer_product_id)"""
CTES["last_payloads"] = """
select run_id as ingestion_run_id, retailer_product_id, j from payloads
qualify row_number() over (partition by run_id, retailer_product_id order by poll desc) = 1"""
QUERIES["S16_payload_paths"] = f"""
select distinct event_id, {_K.replace('props', 'raw_payload')} as k, 'OBJECT<k: BIGINT>' as kind from raw_events"""
QUERIES["S6_retailer_seed"] = "select * from stg_retailers"
QUERIES["S17_insert_only_events"] = """
select source, timestamp '2024-02-01' as loaded_at, count(distinct event_id)::bigint as stored,
       count(distinct event_id)::bigint as ids,
       (select count(*)::bigint from events where event_id % 2 = 0) as first,
       (select count(*)::bigint from events where event_id % 2 = 1) as second,
       0::bigint as third
from raw_events group by 1"""
QUERIES["S18_insert_only_runs"] = """
select * replace (timestamp '2024-02-01' as loaded_at) from raw_runs"""
QUERIES["S19_load_counters"] = """
select 1::integer as load, (select count(*)::bigint from accepted) as events_loaded,
       (select count(*)::bigint from manifests) as runs_loaded,
       (select count(distinct ingestion_run_id)::bigint from accepted) as events_source_files,
       (select count(*)::bigint from manifests) as runs_source_files, 0::bigint as bad_lines
union all select 2, 0, 0, (select count(distinct ingestion_run_id)::bigint from accepted),
       (select count(*)::bigint from manifests), 0"""
# Landed prices have the raw table's two places.
CTES["ingested"] = "select * replace (cast(price as decimal(12,2)) as price) from accepted"
CTES["ingested_daily"] = _daily("ingested")
CTES["ingested_mart"] = _mart_daily("ingested_daily")
QUERIES["P1_payloads_to_mart"] = """
select * replace (min_price::double as min_price, max_price::double as max_price)
from ingested_mart"""
QUERIES["S21_recent_runs"] = """
select run_id, source, started_at, completed_at, status, payloads_received, events_normalized,
       events_rejected, pipeline_version
from raw_runs"""
QUERIES["I1_incremental_observations"] = "select * from deduplicated"
QUERIES["L1_streamed_observations"] = """
select event_id, source, retailer_product_id, cast(price as decimal(12,2))::double as price,
       inventory_status, quantity_available, observed_at
from accepted"""
QUERIES["S12_mounted_stores"] = QUERIES["L1_streamed_observations"]
QUERIES["L1_resumed_drain"] = QUERIES["L1_streamed_observations"]
CTES["first_half"] = "select distinct event_id, observed_at from raw_events where cast(event_id as bigint) % 2 = 0"
CTES["second_half"] = """
select event_id, observed_at, observed_at <= (select date_trunc('milliseconds', max(observed_at)) - interval 48 hours
                                             from first_half) as late
from raw_events"""
QUERIES["L2_watermark_deduplication"] = """
select event_id, observed_at, (select count(*)::bigint from second_half where late) as late_rows from first_half
union
select event_id, observed_at, (select count(*)::bigint from second_half where late) as late_rows
from second_half where not late"""
QUERIES["L2_repeated_delivery"] = """
select source, count(*)::bigint as stored, count(distinct event_id)::bigint as ids
from deduplicated group by 1"""
QUERIES["L3_late_rows_skipped"] = """
select count(*)::bigint as after_full,
       count(*) filter (observed_at >= timestamp '2024-01-25')::bigint as stored,
       (select count(distinct event_id)::bigint from stg_inventory_events
        where observed_at < timestamp '2024-01-25') as skipped
from deduplicated"""
QUERIES["L4_freshness"] = """
select source_name as source, max(loaded_at) as newest_load,
       case when date_diff('second', max(loaded_at), timestamp '2024-02-01') > 72 * 3600
            then 'error'
            when date_diff('second', max(loaded_at), timestamp '2024-02-01') > 26 * 3600
            then 'warn' else 'pass' end as state
from stg_inventory_events group by 1"""

# ---- checks ------------------------------------------------------------------------------


def _count(model: str, column: str, check: str, source: str, bad: str, label: str = "") -> str:
    return f"""select '{label or model}' as model, '{column}' as column_name, '{check}' as "check",
       count(*) filter ({bad})::bigint as failures from {source}"""


def _unique(model: str, column: str, source: str) -> str:
    grouped = f"""(select {column} from {source} where {column} is not null
        group by 1 having count(*) > 1)"""
    return _count(model, column, "unique", grouped, "true")


def _parent(model: str, column: str, source: str, parent: str) -> str:
    return _count(
        model, column, "relationships", source,
        f"{column} is not null and {column} not in (select {column} from {parent} "
        f"where {column} is not null)",
    )


def _all(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


QUERIES["Q1_not_null"] = _all(
    [
        _count("observations", c, "not_null", "deduplicated", f"{c} is null")
        for c in ("price", "event_id", "sku")
    ]
)
QUERIES["Q2_unique"] = _all(
    [_unique("staged", c, "stg_inventory_events") for c in ("event_id", "sku")]
)
QUERIES["Q3_accepted_values"] = _all(
    [
        _count("staged", "inventory_status", "accepted_values", "stg_inventory_events",
               "inventory_status not in ('IN_STOCK', 'PREORDER')"),
        _count("staged", "currency", "accepted_values", "stg_inventory_events",
               "currency not in ('USD')"),
    ]
)
QUERIES["Q4_relationships"] = _all(
    [
        _parent("fact", c, "fact_inventory_observation", "dim_product")
        for c in ("retailer_product_id", "product_key")
    ]
)
QUERIES["Q5_accepted_range"] = _all(
    [
        _count("daily", "availability_pct", "accepted_range", "daily_inventory",
               "availability_pct < 0 or availability_pct > 100"),
        _count("daily", "max_price", "accepted_range", "daily_inventory",
               "max_price < 1 or max_price > 50"),
        _count("daily", "observation_count", "accepted_range", "daily_inventory",
               "observation_count <= 1"),
    ]
)
QUERIES["Q6_far_in_future"] = """
select event_id, observed_at, price::double as price from deduplicated
where observed_at > timestamp '2024-01-29 02:00:00'"""
QUERIES["Q7_future_observations"] = """
select event_id, observed_at from fact_inventory_observation
where observed_at > timestamp '2024-01-29 02:00:00'"""
CTES["unreconciled"] = """
select run_id, events_normalized, coalesce(n, 0)::bigint as fact_event_count
from stg_ingestion_runs
left join (select ingestion_run_id, count(*)::bigint as n from fact_inventory_observation
           group by 1) on ingestion_run_id = run_id
where events_normalized <> coalesce(n, 0)"""
QUERIES["Q8_unreconciled_runs"] = "select * from unreconciled"

_TABLES = {
    "inventory_events": "raw_events",
    "ingestion_runs": "raw_runs",
    "seed_products": "product_seed",
    "seed_retailers": "retailer_seed",
    "int_inventory_events_deduplicated": "deduplicated",
    "int_inventory_state_changes": "state_changes",
    "int_product_price_changes": "price_changes",
    "int_product_daily_inventory": "daily_inventory",
    "mart_daily_product_availability": "mart_daily",
}
# Columns declared unique and present, and columns declared present only.
_SUITE_KEYS = [
    "inventory_events.event_id",
    "ingestion_runs.run_id",
    "stg_inventory_events.event_id",
    "stg_ingestion_runs.run_id",
    "stg_products.product_id",
    "stg_retailers.retailer_code",
    "seed_products.product_id",
    "seed_retailers.retailer_code",
    "int_inventory_events_deduplicated.event_id",
    "int_inventory_state_changes.event_id",
    "int_product_price_changes.event_id",
    "dim_product.product_key",
    "dim_retailer.retailer_key",
    "dim_retailer.source",
    "dim_date.date_key",
    "fact_inventory_observation.event_id",
    "fact_inventory_state_change.state_change_event_id",
    "fact_price_observation.event_id",
    "mart_retailer_summary.retailer_key",
]
_SUITE_PRESENT = _SUITE_KEYS + [
    "inventory_events.source",
    "inventory_events.retailer_product_id",
    "inventory_events.observed_at",
    "inventory_events.ingestion_run_id",
    "ingestion_runs.source",
    "ingestion_runs.status",
    "stg_inventory_events.source_name",
    "stg_inventory_events.inventory_status",
    "stg_inventory_events.observed_at",
    "stg_ingestion_runs.status",
    "stg_products.retailer",
    "seed_products.retailer",
    "int_inventory_events_deduplicated.source",
    "int_inventory_events_deduplicated.observed_at",
    "int_product_daily_inventory.source",
    "int_product_daily_inventory.retailer_product_id",
    "int_product_daily_inventory.observation_date",
    "dim_product.source",
    "dim_product.retailer_product_id",
    "mart_daily_product_availability.product_key",
    "mart_daily_product_availability.observation_date",
]
_STATUS_LIST = "'IN_STOCK', 'OUT_OF_STOCK', 'PREORDER', 'BACKORDER', 'UNKNOWN'"
_SUITE_ROWS = [
    ("stg_inventory_events", "source_name", "accepted_values",
     "source_name not in ('TARGET', 'WALMART', 'POKEMON_CENTER', 'GAMESTOP')"),
    ("stg_inventory_events", "inventory_status", "accepted_values",
     f"inventory_status not in ({_STATUS_LIST})"),
    ("stg_inventory_events", "currency", "accepted_values", "currency <> 'USD'"),
    ("stg_inventory_events", "price", "accepted_range", "price < 0"),
    ("stg_inventory_events", "quantity_available", "accepted_range", "quantity_available < 0"),
    ("stg_ingestion_runs", "status", "accepted_values",
     "status not in ('SUCCESS', 'PARTIAL_FAILURE', 'FAILED', 'UNKNOWN')"),
    ("int_inventory_events_deduplicated", "observed_at", "not_far_in_future",
     "observed_at > timestamp '2024-02-01 02:00:00'"),
    ("int_product_daily_inventory", "availability_pct", "accepted_range",
     "availability_pct < 0 or availability_pct > 100"),
    ("fact_inventory_observation", "inventory_status", "accepted_values",
     f"inventory_status not in ({_STATUS_LIST})"),
    ("fact_inventory_observation", "price", "accepted_range", "price < 0"),
    ("mart_daily_product_availability", "availability_pct", "accepted_range",
     "availability_pct < 0 or availability_pct > 100"),
    ("mart_retailer_summary", "run_success_rate_pct", "accepted_range",
     "run_success_rate_pct < 0 or run_success_rate_pct > 100"),
    ("fact_inventory_observation", "observed_at", "no_future_observations",
     "observed_at > timestamp '2024-02-01 02:00:00'"),
]


def _suite() -> str:
    def split(item: str) -> tuple[str, str, str]:
        model, column = item.split(".")
        return model, column, _TABLES.get(model, model)

    parts = [
        _count(m, c, "not_null", t, f"{c} is null") for m, c, t in map(split, _SUITE_PRESENT)
    ]
    parts += [_unique(m, c, t) for m, c, t in map(split, _SUITE_KEYS)]
    parts += [_count(m, c, k, _TABLES.get(m, m), bad) for m, c, k, bad in _SUITE_ROWS]
    parts += [
        _parent("fact_inventory_observation", "product_key", "fact_inventory_observation",
                "dim_product"),
        _parent("fact_inventory_observation", "retailer_key", "fact_inventory_observation",
                "dim_retailer"),
        _parent("fact_inventory_state_change", "product_key", "fact_inventory_state_change",
                "dim_product"),
        _parent("fact_price_observation", "product_key", "fact_price_observation",
                "dim_product"),
        _count("stg_ingestion_runs", "events_normalized", "event_counts_match", "unreconciled",
               "true"),
    ]
    return _all(parts)


QUERIES["Q9_check_suite"] = _suite()

# ---- reports -----------------------------------------------------------------------------

_DAYS = "between date '2024-01-05' and date '2024-01-25'"
_TIMES = "between timestamp '2024-01-05' and timestamp '2024-01-25'"
_CHOSEN = "source in ('TARGET', 'GAMESTOP')"
_ONE = "product_key = (select product_key from dim_product where retailer_product_id = '7')"
CTES["report_summary"] = """
select source, retailer_name, integration_mode, total_runs, successful_runs,
       partial_failure_runs, failed_runs, run_success_rate_pct, total_events_normalized,
       total_events_rejected, avg_run_duration_seconds, last_observed_at,
       hours_since_last_observation, avg_availability_pct
from mart_retailer_summary"""


def _availability(where: str) -> str:
    return f"""
select product_key, source, product_name, category,
       sum(cast(availability_pct as decimal(4,1)))::double / nullif(count(availability_pct), 0)
           as avg_availability_pct,
       max(observation_date) as last_observation_date,
       sum(observation_count)::bigint as total_observations
from mart_daily where observation_date {_DAYS} {where} group by 1, 2, 3, 4"""


def _newest(where: str) -> str:
    return f"""
select observed_at, f.source, product_name, previous_status, current_status, restocked,
       went_out_of_stock
from fact_inventory_state_change f left join dim_product p using (product_key)
where observed_at {_TIMES} {where}
order by observed_at desc, state_change_event_id desc limit 500"""


def _volume(where: str) -> str:
    return f"""
select cast(observed_at as date) as observation_date, source, count(*)::bigint as observations
from fact_inventory_observation where observed_at {_TIMES} {where} group by 1, 2"""


QUERIES["R1_overview_totals"] = f"""
select sum(total_events_normalized)::bigint as total_observations,
       sum(total_events_rejected)::bigint as total_rejected,
       sum(total_runs)::bigint as total_runs, sum(failed_runs)::bigint as total_failed_runs,
       {share('sum(successful_runs + partial_failure_runs)', 'sum(total_runs)')}
           as overall_success_rate_pct,
       max(last_observed_at) as latest_observed_at,
       avg(avg_availability_pct)::double as avg_availability_pct
from mart_retailer_summary"""
QUERIES["R2_retailer_summary"] = "select * from report_summary"
QUERIES["R3_retailers"] = "select source, retailer_name from dim_retailer"
QUERIES["R4_products"] = f"""
select product_key, source, product_name, category from dim_product where {_CHOSEN}"""
QUERIES["R4_products_all"] = "select product_key, source, product_name, category from dim_product"
QUERIES["R5_availability_by_product"] = _availability("")
QUERIES["R6_availability_timeline"] = f"""
select observation_date, availability_pct, last_status, avg_price from mart_daily
where {_ONE} and observation_date {_DAYS}"""
CTES["one_price_history"] = f"""
select observed_at, current_price::double as current_price,
       previous_price::double as previous_price, price_changed, pct_change
from fact_price_observation where {_ONE} and observed_at {_TIMES}"""
QUERIES["R7_price_history"] = "select * from one_price_history"
QUERIES["R8_recent_state_changes"] = _newest("and f.source in ('TARGET', 'GAMESTOP')")
QUERIES["R9_daily_observation_volume"] = _volume("")
QUERIES["R10_membership_filters"] = _availability(
    "and source in ('TARGET', 'GAMESTOP', 'WALMART') and product_key in "
    "(select product_key from dim_product where retailer_product_id in "
    "('3', '4', '5', '7', '8', '9', '12'))"
)
QUERIES["R11_stale_sources"] = """
select source, hours_since_last_observation from report_summary
where hours_since_last_observation > 26"""
QUERIES["R12_transition_totals"] = f"""
select count(*) filter (restocked)::bigint as restocks,
       count(*) filter (went_out_of_stock)::bigint as stock_outs
from ({_newest("")})"""
QUERIES["R12_all_transition_totals"] = """
select count(*) filter (restocked)::bigint as restocks,
       count(*) filter (went_out_of_stock)::bigint as stock_outs
from fact_inventory_state_change
where observed_at between timestamp '2024-01-05' and timestamp '2024-01-25'"""
QUERIES["R13_price_change_points"] = "select * from one_price_history where price_changed"
QUERIES["R14_lowest_availability"] = (
    f"select * from ({_availability('')}) "
    "order by avg_availability_pct nulls last, product_key nulls first, source limit 20"
)
QUERIES["R15_filtered_summary"] = f"select * from report_summary where {_CHOSEN}"
QUERIES["R15_filtered_volume"] = _volume(f"and {_CHOSEN}")
CTES["moves"] = """
select *, lag(current_status) over (partition by source, retailer_product_id
                                    order by observed_at, state_change_event_id) as before
from fact_inventory_state_change where current_status in ('OUT_OF_STOCK', 'IN_STOCK')"""
CTES["starts"] = """
select * from moves
where current_status = 'OUT_OF_STOCK' and before is distinct from 'OUT_OF_STOCK'"""
QUERIES["X1_outages"] = """
select product_key, source, retailer_product_id, outage_start, outage_end,
       (date_diff('microsecond', outage_start, outage_end) // 1000000)::bigint
           as outage_seconds
from (select s.product_key, s.source, s.retailer_product_id, s.observed_at as outage_start,
             min(e.observed_at) as outage_end
      from starts s left join moves e
        on e.source = s.source and e.retailer_product_id = s.retailer_product_id
       and e.current_status = 'IN_STOCK' and e.observed_at > s.observed_at
      group by 1, 2, 3, 4)"""
QUERIES["X2_last_restocks"] = """
select product_key, source, retailer_product_id, max(observed_at) as last_restocked_at
from fact_inventory_state_change where restocked group by 1, 2, 3"""


# ---- single rules of the models ------------------------------------------------------------


def _count_by(model: str, *columns: str) -> str:
    names = ", ".join(columns)
    return f"select {names}, count(*)::bigint as rows from {model} group by {names}"


_DAY_KEYS = "source, retailer_product_id, observation_date"
QUERIES["T2_source_codes"] = _count_by("stg_inventory_events", "source_name")
QUERIES["T3_price_cast"] = """
select event_id, loaded_at, price::double as price from stg_inventory_events"""
QUERIES["T4_blank_defaults"] = _count_by("stg_inventory_events", "currency", "location_type")
QUERIES["T5_status_whitelist"] = _count_by("stg_inventory_events", "inventory_status")
QUERIES["T7_run_duration"] = "select run_id, duration_seconds from stg_ingestion_runs"
QUERIES["T8_run_status_whitelist"] = _count_by("stg_ingestion_runs", "status")
QUERIES["I4_status_changed"] = _count_by("state_changes", "source", "status_changed")
QUERIES["I5_restocked"] = _count_by("state_changes", "source", "restocked")
QUERIES["I6_went_out_of_stock"] = _count_by("state_changes", "source", "went_out_of_stock")
QUERIES["I7_hours_since_previous"] = """
select event_id, hours_since_previous_observation from state_changes"""
QUERIES["I9_price_changed"] = _count_by("price_changes", "source", "price_changed")
QUERIES["I10_pct_change"] = "select event_id, pct_change from price_changes"
QUERIES["I12_last_status"] = f"select {_DAY_KEYS}, last_status from daily_inventory"
QUERIES["I13_rollup_with_last_status"] = f"""
select {_DAY_KEYS}, observation_count, last_status from daily_inventory"""
QUERIES["I14_availability_pct"] = f"select {_DAY_KEYS}, availability_pct from daily_inventory"
QUERIES["S5_product_seed"] = """
select * replace (trim(retailer) as retailer) from product_seed"""
QUERIES["S4_catalog_file"] = """
select product_id as id, retailer, retailer_product_id, product_name as name,
       product_url as url, category, store_id
from product_seed"""


def compose(body: str) -> str:
    """Prefix ``body`` with the common table expressions it needs, in order."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            pending.append(CTES[name])
    if not needed:
        return body
    ordered = [name for name in CTES if name in needed]
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in ordered) + "\n" + body


# Prices leave both engines as doubles; inside they are decimal(12,2).
PRICES = {
    "T1_stg_inventory_events": ["price"],
    "I1_incremental_observations": ["price"],
    "I2_deduplicated_observations": ["price"],
    "I8_price_changes": ["previous_price", "current_price"],
    "I8_price_changes_lineitem": ["previous_price", "current_price"],
    "I11_daily_inventory": ["min_price", "max_price"],
    "M4_fact_inventory_observation": ["price"],
    "M6_fact_price_observation": ["previous_price", "current_price"],
    "M7_mart_daily_product_availability": ["min_price", "max_price"],
}


def _final(name: str, body: str) -> str:
    if name not in PRICES:
        return compose(body)
    swaps = ", ".join(f"{column}::double as {column}" for column in PRICES[name])
    return compose(f"select * replace ({swaps}) from ({body})")


for _name in ("R1_overview_totals", "R8_recent_state_changes", "R9_daily_observation_volume", "R10_membership_filters"):
    QUERIES[f"{_name}_text"] = QUERIES[_name]
QUERIES["S22_incremental_refresh"] = QUERIES["M5_fact_inventory_state_change"]


def oracle_sql() -> dict[str, str]:
    return {name: _final(name, body) for name, body in QUERIES.items()}
