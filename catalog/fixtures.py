"""Inputs derived from the given tables.

Each fixture is SQL that Spark and DuckDB read alike; where their dialects differ a fixture has
one text per engine. All rows of the given tables take part.
"""

FIXTURES: dict[str, str | dict[str, str]] = {}

# ---- events --------------------------------------------------------------------------------

# deliveries: purchases are delivered twice, the second time an hour later
FIXTURES["deliveries"] = """
select event_id, cast(ts as timestamp) as ts, user_id, event_type, value, props from events
union all
select event_id, cast(ts as timestamp) + interval 1 hour as ts, user_id, event_type, value, props
from events where event_type = 'purchase'
"""

FIXTURES["raw_events"] = """
select
  day(ts) as _version,
  case when user_id % 10 = 3 then 'CA' else 'US' end as country_iso_2_code,
  case event_type when 'click' then 'BIS' when 'error' then 'BIS' when 'view' then 'AVOD BISCTV'
    when 'purchase' then 'BISSocial' else 'PlayOn' end as provider_code,
  case event_type when 'click' then 'desktop display' when 'error' then 'social display'
    when 'view' then 'ctv video' when 'purchase' then 'social video' else 'mobile video' end
    as source_channel,
  cast(event_id as string) as provider_occurrence_id,
  event_id % 997 as provider_creative_id,
  cast(ts as date) as capture_date,
  year(ts) * 100 + month(ts) as capture_month,
  ts as capture_timestamp,
  ts + interval 2 hour as created_timestamp,
  cast(user_id % 25 as int) as region_dma_id,
  case when user_id % 4 = 0 then null else 'NATION_' || cast(user_id % 25 as string) end
    as region_dma_name,
  case when user_id % 2 = 0 then 'us' else 'US' end as region_country_code,
  cast(user_id % 7 as int) as region_city_id,
  case when user_id % 7 = 0 then null else 'City' || cast(user_id % 7 as string) end
    as region_city_name,
  cast(user_id % 5 as int) as region_state_id,
  case when user_id % 5 = 0 then null else 'State' || cast(user_id % 5 as string) end
    as region_state_name,
  case event_type when 'click' then 'html5' when 'error' then 'banner' when 'signup' then 'flash'
    else 'video' end as creative_type,
  case when event_type = 'view' then 'video/mp4'
    when event_type = 'purchase' then null
    when event_type = 'signup' then 'image/gif'
    when event_type = 'click' and event_id % 3 = 0 then 'application/json'
    when event_type = 'click' then 'application/octet-stream'
    when event_id % 2 = 0 then 'carousel' else null end as creative_mime_type,
  user_id as publisher_id,
  'pub' || cast(user_id as string) || '.example.com' as publisher_domain,
  cast(event_id % 400 as int) as creative_width,
  cast((event_id * 7) % 300 as int) as creative_height,
  cast(case when event_id % 11 = 0 then null else event_id % 300 end as int) as creative_duration,
  'http://cdn' || cast(event_id % 3 as string) || '.example.com/a' || cast(event_id % 997 as string)
    || case when event_id % 5 = 0 then '' else '.' end
    || case event_id % 5 when 0 then '' when 1 then 'gif' when 2 then 'bmp' when 3 then 'jpg'
       else 'xyz' end as creative_url,
  (event_id % 997) * 31 + 7 as creative_url_hash,
  case when event_id % 50 = 0 then true when event_id % 49 = 0 then null else false end as retransmit,
  event_id % 101 as provider_campaign_id,
  event_id % 103 as provider_campaign_product_id,
  event_id % 107 as provider_campaign_advertiser_id,
  'campaign ' || cast(event_id % 101 as string) as provider_campaign_name,
  'product ' || cast(event_id % 103 as string) as provider_campaign_product_name,
  'advertiser ' || cast(event_id % 107 as string) as provider_campaign_advertiser_name,
  case when event_id % 6 = 0 then null else 'about ' || event_type end as provider_campaign_description,
  'https://www.land' || cast(event_id % 13 as string) || '.example.com/x?y=1'
    as provider_campaign_landing_page,
  case event_id % 4 when 0 then null when 1 then 'http://pub' || cast(user_id as string)
    || '.example.com/ads/1' when 2 then 'http://other.example.com/content/2' else 'text' end
    as occurrence_description,
  'http://link.example.com/' || cast(event_id as string) as occurrence_link_url,
  case when event_id % 8 = 0 then null else
    '[{"id":' || cast(event_id % 5 as string) || ',"role":"role' || cast(event_id % 3 as string)
    || '","index":2,"roleId":' || cast(event_id % 3 as string) || ',"mediator":"m'
    || cast(event_id % 5 as string) || '"},{"id":' || cast(user_id % 6 as string)
    || ',"role":"role' || cast(user_id % 3 as string) || '","index":1,"roleId":'
    || cast(user_id % 3 as string) || ',"mediator":"m' || cast(user_id % 6 as string)
    || '"}]' end as daisy_chain,
  cast(event_id % 4 as int) as purchase_method_id,
  case when event_id % 9 = 0 then null else 'pre' end as ad_insertion_point,
  '{"mainAdvertiserCategory":"cat' || cast(event_id % 9 as string) || '","occurrence":{"creativeUrl":"'
    || case event_id % 3 when 0 then 'https://www.srv' || cast(event_id % 20 as string)
       || '.example.com/ad/9' when 1 then 'no url' else 'http://srv.example.org:80/content/1' end
    || '","socialCampaignText":"text ' || cast(event_id % 17 as string) || '"}}' as raw_json
from deliveries
"""

# rows as landed: one JSON text per delivery
FIXTURES["landed"] = """
select
  '{"channel":"' || upper(event_type) || '","retransmit":'
  || case when event_id % 50 = 0 then 'true' else 'false' end
  || ',"occurrence":{"id":"' || cast(event_id as string) || '","captureDate":"'
  || substr(cast(date_trunc('second', ts) as string), 1, 10) || 'T'
  || substr(cast(date_trunc('second', ts) as string), 12, 8) || '.000+0000","purchaseMethod":'
  || cast(event_id % 4 as string) || ',"source":{"id":' || cast(user_id as string)
  || ',"publisher":{"id":' || cast(user_id as string) || ',"domain":"pub' || cast(user_id as string)
  || '.example.com"},"region":{"countryId":"us","dmaId":' || cast(user_id % 25 as string)
  || ',"dmaName":"NATION_' || cast(user_id % 25 as string) || '","cityId":"x"}},"creative":{"id":'
  || cast(event_id % 997 as string) || ',"url":"http://cdn.example.com/a'
  || cast(event_id % 997 as string) || '.mp4","type":"'
  || case when event_type = 'error' then 'banner' else 'video' end || '","mimeType":"'
  || case when event_type = 'click' then 'image/gif' else 'video/mp4' end
  || '","videoAttributes":{"duration":' || cast((event_id % 40) * 250 as string)
  || '}},"campaign":{"id":' || cast(event_id % 101 as string) || ',"name":"campaign","product":{"id":"bad"}},'
  || '"unifiedChain":[{"id":' || cast(event_id % 5 as string) || ',"index":1}]}}' as json_data,
  cast(event_id as int) as record_index,
  ts + interval 2 hour as created_timestamp,
  (event_id % 997) * 31 + 7 as creative_url_hash,
  day(ts) as _version
from deliveries
"""

# rows already in the raw table: the first week
FIXTURES["raw_stored"] = """
select distinct cast(event_id as string) as provider_occurrence_id,
  year(ts) * 100 + month(ts) as capture_month
from deliveries where ts < timestamp '2024-01-08 00:00:00'
"""

# ---- dimensions ----------------------------------------------------------------------------

FIXTURES["data_provider"] = """
select
  case r_regionkey when 0 then 2 when 1 then 11 when 2 then 13 when 3 then 16 else 18 end
    as data_provider_id,
  case r_regionkey when 0 then 'BIS' when 1 then 'TV' when 2 then 'PlayOn' when 3 then 'BISSocial'
    else 'AVOD BISCTV' end as data_provider_code,
  'ACTIVE' as record_status_flag
from region
"""

FIXTURES["source_channel"] = """
select
  n_nationkey as source_channel_id,
  case n_nationkey when 0 then 'Desktop Display' when 1 then 'Social Display' when 2 then 'CTV Video'
    when 3 then 'Social Video' when 4 then 'Mobile Video' when 5 then 'Mobile Video'
    else 'Other ' || n_name end as short_desc,
  case when n_nationkey = 5 then 'INACTIVE' else 'ACTIVE' end as record_status_flag
from nation
"""

FIXTURES["mime_type"] = """
select
  n_nationkey as mime_type_id,
  case n_nationkey when 0 then 'Evaliant/Video' when 1 then 'Evaliant/RichMedia' when 2 then 'image/jpeg'
    when 3 then 'image/bmp' when 4 then 'image/gif' when 5 then 'video/mp4'
    else 'type ' || n_name end as description,
  case when n_nationkey = 3 then 'INACTIVE' else 'ACTIVE' end as record_status_flag
from nation
"""

# publishers by channel, as seen in the events
FIXTURES["publisher_channel"] = """
select distinct user_id,
  case event_type when 'click' then 0 when 'error' then 1 when 'view' then 2 when 'purchase' then 3
    else 4 end as channel_id,
  case event_type when 'click' then 2 when 'error' then 2 when 'view' then 18 when 'purchase' then 16
    else 13 end as provider_id
from events
"""

FIXTURES["media_property"] = """
select
  s_suppkey as media_property_id,
  s_suppkey + 5000 as legacy_media_property_id,
  s_name as media_property_name,
  s_nationkey as primary_media_category_id,
  'C' || cast(s_nationkey as string) as primary_media_category_code,
  'US' as legacy_country_code,
  'en' as primary_language_code,
  'https://pub' || cast(s_suppkey as string) || '.example.com/home?x=1' as domain_url,
  1 as country_id,
  channel_id as source_channel_id,
  case when s_acctbal < 0 then 93 else 92 end as media_property_status_id,
  s_nationkey as market_id,
  s_nationkey + 40 as parent_company_id
from supplier join publisher_channel on s_suppkey = user_id
"""

FIXTURES["property_provider"] = """
select
  1 as country_id, user_id as media_property_id, channel_id as source_channel_id,
  provider_id as data_provider_id, user_id as publisher_id,
  case when user_id % 9 = 4 then 'INACTIVE' else 'ACTIVE' end as record_status_flag
from publisher_channel
"""

FIXTURES["market"] = """
select n_nationkey as market_id, 'Market ' || n_name as market_name from nation
union all
select n_nationkey + 100 as market_id, 'Metro ' || n_name as market_name from nation
where n_regionkey <> 2
"""

FIXTURES["provider_market"] = """
select n_name as provider_dma_city_name, n_nationkey + 100 as market_id from nation
where n_regionkey <> 0
union all
select 'City' || cast(n_nationkey % 7 as string) || ', State' || cast(n_nationkey % 5 as string)
  as provider_dma_city_name, n_nationkey as market_id from nation where n_regionkey <> 1
"""

FIXTURES["media"] = """
select n_nationkey + 5 as media_id, 'Medium ' || n_name as media_name from nation
"""

FIXTURES["origin"] = """
select n_nationkey as origin_channel_id, short_desc as origin_channel_name, record_status_flag
from nation join source_channel on n_nationkey = source_channel_id
"""

FIXTURES["company"] = """
select n_nationkey + 900 as company_id, n_nationkey + 40 as legacy_id, 3 as companylevel_id
from nation where n_regionkey in (1, 2)
union all
select n_nationkey + 700 as company_id, n_nationkey + 40 as legacy_id, 2 as companylevel_id
from nation where n_regionkey in (2, 3)
union all
select 1 as company_id, 9999 as legacy_id, 3 as companylevel_id from region where r_regionkey = 0
"""

FIXTURES["product_flat"] = """
select
  p_partkey as product_id,
  case when p_size < 10 then null else p_partkey - p_partkey % 3 end as current_product_id,
  900 + p_partkey % 25 as parent_id,
  case when p_size > 40 then null else 700 + p_partkey % 20 end as subsidiary_id
from part
"""

FIXTURES["ad_size"] = """
select
  p_partkey as size_id, p_name as size_name, (p_size * 13) % 400 as size_width,
  (p_size * 29) % 300 as size_height, 'US' as country_iso_2_code,
  case when p_type = 'STANDARD' then 'INACTIVE' else 'ACTIVE' end as record_status_flag
from part
"""

FIXTURES["ad_server"] = """
select
  case when n_regionkey = 1 then 'https://www.srv' else 'srv' end || cast(n_nationkey as string)
    || '.example.com/path' as ad_server,
  timestamp '2024-01-01 00:00:00' + n_nationkey * interval 1 day as inserted_at_timestamp,
  case when n_regionkey = 4 then 'INACTIVE' else 'ACTIVE' end as record_status_flag
from nation
"""

FIXTURES["spend_property"] = """
select s_suppkey + 5000 as media_property_id, s_acctbal * 1.5 as average_impressions,
  s_acctbal / 4 as average_spend
from supplier where s_acctbal > 2000
"""

FIXTURES["spend_channel"] = """
select n_nationkey as source_channel_id, cast(n_nationkey * 10.0 + 0.5 as double) as average_impressions,
  cast(n_nationkey * 0.25 as double) as average_spend
from nation where n_nationkey <> 3
"""

FIXTURES["match_type"] = """
select r_regionkey as match_type_id, case r_regionkey when 0 then 'Map' when 1 then 'Revision'
  else r_name end as match_type
from region
"""

# ---- creatives -----------------------------------------------------------------------------

FIXTURES["creative"] = """
select
  p_partkey + 1000 as creative_id,
  p_partkey * 31 + 7 as creative_url_hash,
  'US' as country_iso_2_code,
  p_partkey as provider_creative_id,
  case when p_partkey % 2 = 0 then 'BIS' else 'AVOD BISCTV' end as provider_code,
  case when p_size <= 30 then 'Advert' when p_size <= 36 then 'NonAd' when p_size <= 42 then 'BadAd'
    else null end as classification_type,
  case when p_size % 5 = 0 then null when p_size % 5 = 1 then 'image/gif' else 'video/mp4' end
    as creative_mime_type,
  case when p_size % 10 = 9 then null else p_partkey end as primary_product_id,
  p_name as creative_title,
  p_size as creative_duration,
  timestamp '2024-01-01 00:00:00' + p_size * interval 1 day as updated_timestamp,
  timestamp '2023-06-01 00:00:00' + p_size * interval 1 day as created_timestamp,
  cast(p_partkey as string) as first_seen_provider_occurrence_id,
  case when p_size % 4 = 0 then p_partkey + 75000000000 else null end as first_seen_occurrence_id,
  case when p_size % 7 = 0 then null else
    timestamp '2024-01-02 00:00:00' + (p_partkey % 20) * interval 1 day end
    as first_seen_occurrence_timestamp,
  case when p_size % 6 = 0 then null else
    timestamp '2024-01-20 00:00:00' + (p_partkey % 9) * interval 1 day end as last_seen_timestamp
from part
"""

FIXTURES["dedupe_map"] = """
select
  p_partkey as creative_dedupe_map_id, 'US' as country_iso_2_code,
  p_partkey + 1000 as child_creative_id, p_partkey * 31 + 7 as child_creative_url_hash,
  p_partkey - p_partkey % 5 + 1000 as parent_creative_id,
  (p_partkey - p_partkey % 5) * 31 + 7 as parent_creative_url_hash,
  case when p_size % 3 = 2 then 'Revision' else 'Map' end as match_type,
  timestamp '2024-01-01 00:00:00' + p_size * interval 1 day as updated_timestamp
from part where p_partkey % 5 <> 0
"""

FIXTURES["first_seen"] = """
select
  p_partkey + 1000 as creative_id,
  p_partkey * 31 + 7 as creative_url_hash,
  p_partkey as provider_creative_id,
  cast((p_partkey % 25) + 5 as int) as media_id,
  'occ' || cast(p_partkey as string) as occurrence_id,
  case when p_size % 8 = 0 then null else
    timestamp '2024-01-05 00:00:00' + ((p_partkey * 7) % 20) * interval 1 day
    + p_size * interval 1 hour end as occurrence_timestamp,
  cast(case p_partkey % 5 when 0 then 2 when 1 then 11 when 2 then 13 when 3 then 16 else 99 end as int)
    as provider_id,
  cast(p_size as int) as media_property_id,
  'property ' || cast(p_size as string) as media_property_name,
  cast(p_partkey % 25 as int) as market_id,
  'market ' || cast(p_partkey % 25 as string) as market_name,
  timestamp '2024-01-01 00:00:00' + p_size * interval 1 day as updated_timestamp
from part
"""

# known creatives: brand decides, and whether they are staged
FIXTURES["registry"] = """
select
  p_partkey + 1000 as creative_id, p_partkey as provider_creative_id,
  'http://stored.example.com/' || cast(p_partkey as string) as provider_creative_url,
  p_partkey * 31 + 7 as creative_url_hash,
  timestamp '2023-12-01 00:00:00' as created_timestamp,
  p_size > 25 as is_staged,
  5 as first_seen_media_id, 2 as first_seen_provider_id
from part where p_size > 15
"""

FIXTURES["chaff"] = """
select p_partkey * 31 + 7 as creative_url_hash from part where p_type = 'PROMO' and p_size < 10
"""

FIXTURES["summary_buffer"] = """
select
  'held' || cast(o_orderkey as string) as provider_occurrence_id,
  (o_custkey % 997) * 31 + 7 as creative_url_hash,
  'BIS' as provider_code, 'US' as country_iso_2_code, 'desktop display' as source_channel,
  'NATION_' || cast(o_custkey % 25 as string) as provider_dma_city_name,
  o_custkey % 100 as publisher_id,
  cast(o_orderdate as date) as capture_date,
  cast(o_orderdate as timestamp) as capture_timestamp
from orders where o_orderpriority = '1-URGENT'
"""

FIXTURES["event_buffer"] = """
select
  case when o_orderstatus = 'P' then cast(o_orderkey as string)
    else 'held' || cast(o_orderkey as string) end as provider_occurrence_id,
  'US' as country_iso_2_code,
  'BIS' as provider_code, 'desktop display' as source_channel,
  o_custkey % 997 as provider_creative_id,
  (o_custkey % 997) * 31 + 7 as provider_creative_url_hash,
  cast(o_orderdate as date) as capture_date,
  year(o_orderdate) * 100 + month(o_orderdate) as capture_month,
  cast(o_orderdate as timestamp) as capture_timestamp,
  cast(o_custkey % 40 + 5000 as int) as media_property_id,
  cast(o_orderkey % 4 as int) as purchase_method_id,
  '[{"id":' || cast(o_custkey % 5 as string) || ',"index":1,"roleId":2}]' as daisy_chain,
  cast(1 as bigint) as provider_campaign_product_id, 'p' as provider_campaign_product_name,
  cast(2 as bigint) as provider_campaign_id, 'c' as provider_campaign_name,
  cast(3 as bigint) as provider_campaign_advertiser_id, 'a' as provider_campaign_advertiser_name,
  'http://held.example.com/' as provider_campaign_landing_page,
  'held.example.com' as provider_campaign_landing_page_domain,
  cast(null as string) as ad_insertion_point, 'earlier' as job_log_key,
  '{"region_dma_name":"NATION_' || cast(o_custkey % 25 as string) || '"}' as provider_raw_json
from orders where o_orderpriority = '2-HIGH'
"""

FIXTURES["gold_stored"] = """
select distinct
  'US' as country_iso_2_code, cast(ts as date) as capture_date,
  year(ts) * 100 + month(ts) as capture_month, cast(event_id as string) as provider_occurrence_id
from deliveries where event_type = 'error'
"""

# stored gold events: one per event
FIXTURES["gold_event"] = """
select
  event_id + 75000000000 as occurrence_id,
  'US' as country_iso_2_code,
  case when user_id % 3 = 0 then (event_id % 997) - (event_id % 997) % 5 else event_id % 997 end + 1000
    as creative_id,
  (event_id % 997) * 31 + 7 as provider_original_creative_url_hash,
  cast(case when user_id % 3 = 0 then ((event_id % 997) - (event_id % 997) % 5) * 31 + 7 else null end
    as bigint) as provider_parent_creative_url_hash,
  cast(event_id % 997 as string) as provider_occurrence_id,
  cast(ts as timestamp) as capture_timestamp,
  year(ts) * 100 + month(ts) as capture_month,
  case when event_type = 'error' then null when event_type = 'signup' then true else false end
    as delete_flag,
  cast(ts as timestamp) + interval 1 day as updated_timestamp
from events
"""

# ---- nested products -----------------------------------------------------------------------

FIXTURES["returned_element"] = """
select l_orderkey, l_partkey,
  '{"sort_order":' || cast(l_linenumber as string) || ',"type":"t' || l_linestatus || '","subtype":'
  || case when l_quantity > 25 then 'null' else '"s"' end || ',"product_id":'
  || cast(l_partkey as string) || ',"is_dominant":'
  || case when l_quantity > 40 then 'true' else 'false' end || '}' as elem
from lineitem
"""

FIXTURES["returned"] = {
    "spark": """
select l_orderkey, array_join(array_sort(collect_list(elem)), ',') as elems,
  array_join(transform(array_sort(collect_list(l_partkey)), x -> cast(x as string)), '|') as ids
from returned_element group by l_orderkey
""",
    "duckdb": """
select l_orderkey, string_agg(elem, ',' order by elem) as elems,
  string_agg(cast(l_partkey as string), '|' order by l_partkey) as ids
from returned_element group by l_orderkey
""",
}

FIXTURES["advert"] = """
select
  o_orderkey as creative_id,
  o_orderkey * 31 + 7 as creative_url_hash,
  o_custkey as primary_product_id,
  o_custkey as legacy_creative_id,
  cast(null as int) as mr_company_id,
  case when o_orderstatus = 'P' then 'NonAd' when o_orderpriority = '5-LOW' then null else 'Advert' end
    as classification_type,
  case when elems is not null then '[' || elems || ']' when o_orderstatus = 'O' then '[]' else null end
    as secondary_products,
  case when o_orderstatus = 'F' then '[{"id":' || cast(o_custkey % 40 as string) || '},{"id":'
    || cast(o_custkey % 30 as string) || '}]' else null end as attribution_competitor,
  case when o_orderstatus = 'O' then '[{"id":7,"first_name":"A"}]' when o_orderstatus = 'F'
    then '[{"id":null}]' else null end as attribution_celebrity,
  o_orderpriority as creative_title,
  cast(o_orderdate as timestamp) as updated_timestamp,
  cast(o_orderdate as timestamp) as created_timestamp
from orders left join returned on l_orderkey = o_orderkey
"""

FIXTURES["product_map_source"] = """
select upper(md5(cast(p_partkey as string) || '1')) as mapping_hash, 1 as system_id,
  p_partkey + 100000 as target_product_id, p_partkey as primary_product_id, p_size % 2 as set_id,
  timestamp '2024-01-01 00:00:00' + p_size * interval 1 day as change_dt
from part where p_size <> 7
union all
select upper(md5(cast(p_partkey as string) || '2')) as mapping_hash, 2 as system_id,
  p_partkey + 200000 as target_product_id, p_partkey as primary_product_id, p_size % 2 as set_id,
  timestamp '2024-01-01 00:00:00' + p_size * interval 1 day as change_dt
from part where p_size <> 9
union all
select distinct upper(md5(cast(o_custkey as string) || '1' || ids)) as mapping_hash, 1 as system_id,
  o_custkey + 100000 as target_product_id, o_custkey as primary_product_id, 1 as set_id,
  timestamp '2023-01-01 00:00:00' as change_dt
from orders join returned on l_orderkey = o_orderkey where o_orderpriority <> '1-URGENT'
union all
select distinct upper(md5(cast(o_custkey as string) || '2' || ids)) as mapping_hash, 2 as system_id,
  o_custkey + 200000 as target_product_id, o_custkey as primary_product_id, 1 as set_id,
  timestamp '2023-01-01 00:00:00' as change_dt
from orders join returned on l_orderkey = o_orderkey where o_orderpriority <> '2-HIGH'
"""

# one code per key: the concatenated texts of different ids can be equal
FIXTURES["product_map"] = """
select mapping_hash, system_id, max(target_product_id) as target_product_id,
  max(primary_product_id) as primary_product_id, max(set_id) as set_id, max(change_dt) as change_dt
from product_map_source group by mapping_hash, system_id
"""

FIXTURES["advertiser_map"] = """
select n_nationkey as vx0_company_id, 'A' || cast(n_nationkey as string) as vx2_code from nation
"""

# translated creatives, as the code translation leaves them
FIXTURES["advert_coded"] = """
select creative_id, creative_url_hash, legacy_creative_id, primary_product_id, mr_company_id,
  classification_type, secondary_products, attribution_celebrity, creative_title,
  updated_timestamp, created_timestamp,
  case when creative_id % 3 = 0 then null else primary_product_id + 100000 end as vx1_product_id,
  primary_product_id + 200000 as vx2_product_id,
  case when creative_id % 4 = 0 then null else '[1]' end as vx1_secondary_products,
  cast('[2]' as string) as vx2_secondary_products,
  creative_id % 6 = 0 as holding_flag
from advert
"""

# ---- components ----------------------------------------------------------------------------

FIXTURES["attribute_element"] = """
select l_orderkey,
  '{"fkey":"' || case l_partkey % 5 when 0 then 'Product' when 1 then 'Manufacturer'
    when 2 then 'Mattress Product' when 3 then 'Promotional Gift' else 'Color' end
  || '","value":"v' || cast(l_suppkey % 8 as string) || '","id":' ||
  case when l_partkey % 7 = 0 then 'null' when l_partkey % 5 = 1
    then '"' || cast(l_suppkey % 25 as string) || '"' else '"' || cast(l_partkey as string) || '"' end
  || ',"referenceType":"r' || l_linestatus || '","unit":'
  || case when l_quantity > 25 then 'null' else '"u"' end || '}' as elem
from lineitem
"""

FIXTURES["attributes"] = {
    "spark": """
select l_orderkey, array_join(array_sort(collect_list(elem)), ',') as elems
from attribute_element group by l_orderkey
""",
    "duckdb": """
select l_orderkey, string_agg(elem, ',' order by elem) as elems
from attribute_element group by l_orderkey
""",
}

FIXTURES["component"] = """
select
  o_orderkey + 500 as component_coding_id,
  o_custkey as creative_id,
  cast(o_orderkey % 6 as int) as component_template_id,
  cast(o_orderkey % 3 as int) as order_number,
  case when elems is null then null else '[' || elems || ']' end as attribute_response,
  o_orderstatus = 'P' as is_logically_deleted,
  cast(o_orderdate as timestamp) as created,
  cast(o_orderdate as timestamp) + interval 1 day as modified,
  case when o_orderstatus = 'O' then 'Open' else 'Coding Completed' end as status
from orders left join attributes on l_orderkey = o_orderkey
"""

FIXTURES["component_creative"] = """
select c_custkey as creative_id, c_custkey + 9000 as legacy_creative_id from customer
where c_acctbal > 0
"""

FIXTURES["component_template"] = """
select r_regionkey as componenttemplateid, 'template ' || r_name as componenttemplatename from region
"""

FIXTURES["component_held"] = """
select o_orderkey + 500 as component_coding_id from orders where o_orderpriority = '1-URGENT'
"""

FIXTURES["product_name"] = """
select p_partkey + 200000 as prseq, p_name as prname from part where p_type <> 'PROMO'
"""

FIXTURES["advertiser_name"] = """
select 'A' || cast(n_nationkey as string) as code, 'name ' || n_name as name from nation
where n_regionkey <> 3
"""

FIXTURES["value_map"] = """
select 'v' || cast(n_nationkey as string) as vx0_component_value,
  'w' || cast(n_nationkey as string) as vx2_component_value from nation where n_regionkey <> 0
"""

FIXTURES["mattress_map"] = """
select 'v' || cast(n_nationkey % 8 as string) as vx2_mattress_product,
  'A' || cast(n_nationkey as string) as vx2_advertiser_code,
  n_nationkey + 40 as cmp_seq from nation
"""

# ---- merge inputs --------------------------------------------------------------------------

# one row per part that was ordered, as a merge source
FIXTURES["part_delta"] = """
select l_partkey as k, cast(max(l_quantity) as int) as v, count(*) as n,
  max(cast(l_shipdate as timestamp)) as ts,
  cast(case when max(l_quantity) > 48 then null else max(l_linenumber) end as int) as w
from lineitem group by l_partkey
union all
select p_partkey + 10000000 as k, p_size as v, cast(1 as bigint) as n,
  timestamp '2024-01-01 00:00:00' as ts, 1 as w
from part where p_type = 'PROMO'
"""

FIXTURES["part_state"] = """
select p_partkey as k, p_size as v, cast(p_size as bigint) as n,
  case when p_size % 5 = 0 then null else timestamp '2001-01-01 00:00:00' + p_size * interval 30 day end
    as ts, p_size as w, p_name as label
from part where p_type <> 'SMALL'
"""

FIXTURES["daily"] = """
select
  l_partkey as creative_id, l_suppkey as market_id,
  case when l_linenumber = 7 then null else l_linenumber end as media_property_id,
  cast(l_shipdate as date) as capture_date, count(*) as occ_cnt,
  min(cast(l_shipdate as timestamp)) as first_run, max(cast(l_shipdate as timestamp)) as last_run
from lineitem group by 1, 2, 3, 4
"""

FIXTURES["summary_stored"] = """
select l_partkey as creative_id, l_suppkey as market_id,
  case when l_linenumber = 7 then null else l_linenumber end as media_property_id,
  count(*) as occurrence_count, min(cast(l_shipdate as timestamp)) as first_run,
  max(cast(l_shipdate as timestamp)) as last_run
from lineitem where l_returnflag = 'A' group by 1, 2, 3
"""

# ---- control -------------------------------------------------------------------------------

FIXTURES["control"] = """
select
  'flow ' || r_name as watermark_name,
  timestamp '2024-01-01 00:00:00' as start_timestamp,
  timestamp '2024-01-05 00:00:00' + r_regionkey * interval 1 day as end_timestamp,
  cast(nullif(r_regionkey, 0) as bigint) as last_commit_version,
  cast(r_regionkey + 10 as bigint) as current_commit_version,
  'SUCCEEDED' as transaction_status,
  timestamp '2023-01-01 00:00:00' as created_timestamp,
  timestamp '2023-01-01 00:00:00' as updated_timestamp
from region
"""

# one version per day, committed at the day's last event; two days share a commit time
FIXTURES["manifest"] = """
select cast(day(ts) as bigint) as version,
  case when day(max(ts)) in (9, 10) then timestamp '2024-01-10 12:00:00'
    else max(cast(ts as timestamp)) end as committed_at
from events group by day(ts)
"""
