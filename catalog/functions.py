"""Scalar functions (section 2.10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from sightline.functions import jsons, keys, nested, text, times

HOST = r"^(?:https?://)?(?:[@\n]+@)?(?:www.)?([^:/\n?]+)"


@query(
    "f_json_path",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.missing') AS missing FROM events
""",
)
def _(t):
    props = F.col("props")
    return t.events.select(
        "event_id",
        jsons.text_at(props, "$.k").try_cast("bigint").alias("k"),
        jsons.text_at(props, "$.missing").alias("missing"),
    )


@query(
    "f_json_build_keepnull",
    """
SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN NULL ELSE s_name END AS name,
  CAST(s_nationkey AS VARCHAR) AS nation, 2 AS n_keys, s_nationkey < 5 AS has_null FROM supplier
""",
)
def _(t):
    name = F.when(F.col("s_nationkey") >= 5, F.col("s_name"))
    built = jsons.object_keep_null({"name": name, "nation": F.col("s_nationkey")})
    return t.supplier.select("s_suppkey", built.alias("j")).select(
        "s_suppkey",
        jsons.text_at(F.col("j"), "$.name").alias("name"),
        jsons.text_at(F.col("j"), "$.nation").alias("nation"),
        F.size(F.json_object_keys("j")).alias("n_keys"),
        F.col("j").contains('"name":null').alias("has_null"),
    )


@query(
    "f_json_build_typed",
    """
SELECT provider_occurrence_id, capture_timestamp,
  CASE WHEN provider_code = 'BISSocial' THEN COALESCE(region_dma_name, 'NA') ELSE region_dma_name END
    AS dma,
  CASE WHEN provider_code = 'BISSocial' THEN COALESCE(region_city_name, 'NA') ELSE region_city_name END
    AS city,
  CAST(region_state_id AS VARCHAR) AS state_id,
  CASE WHEN provider_code = 'BISSocial' THEN json_extract_string(raw_json, '$.mainAdvertiserCategory') END
    AS category,
  CASE WHEN provider_code = 'BISSocial' THEN 'NA' END AS first_seen,
  CASE WHEN provider_code = 'BISSocial' THEN 14 ELSE 7 END AS n_keys
FROM raw_events
""",
)
def _(t):
    from sightline.plans.events import region_json

    j = F.col("j")
    return t.raw_events.withColumn("j", region_json()).select(
        "provider_occurrence_id",
        "capture_timestamp",
        jsons.text_at(j, "$.region_dma_name").alias("dma"),
        jsons.text_at(j, "$.region_city_name").alias("city"),
        jsons.text_at(j, "$.region_state_id").alias("state_id"),
        jsons.text_at(j, "$.MAIN_ADVERTISER_CATEGORY").alias("category"),
        jsons.text_at(j, "$.FIRST_SEEN_DATE").alias("first_seen"),
        F.size(F.json_object_keys(j)).alias("n_keys"),
    )


@query(
    "f_json_merge",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS kept,
  event_type AS kind, value > 50 AS large FROM events
""",
)
def _(t):
    merged = jsons.merge_objects(
        F.col("props"),
        jsons.object_typed({"kind": F.lit("old"), "large": F.lit(None)}),
        jsons.object_typed({"kind": F.col("event_type"), "large": F.col("value") > 50}),
    )
    return t.events.select("event_id", merged.alias("j")).select(
        "event_id",
        jsons.text_at(F.col("j"), "$.k").cast("bigint").alias("kept"),
        jsons.text_at(F.col("j"), "$.kind").alias("kind"),
        jsons.text_at(F.col("j"), "$.large").cast("boolean").alias("large"),
    )


@query(
    "f_json_len",
    "SELECT creative_id, COALESCE(CAST(json_array_length(secondary_products) AS INT), 0) AS n FROM advert",
)
def _(t):
    return t.advert.select("creative_id", jsons.array_size(F.col("secondary_products")).alias("n"))


@query(
    "f_json_array_cast",
    """
SELECT creative_id, COUNT(e) AS n, CAST(SUM(CAST(e ->> '$.product_id' AS BIGINT)) AS BIGINT) AS total
FROM advert LEFT JOIN LATERAL (
  SELECT UNNEST(CAST(json(COALESCE(secondary_products, '[]')) AS JSON[])) AS e) x ON TRUE
GROUP BY creative_id
""",
)
def _(t):
    array = jsons.parsed(
        jsons.default_array(F.col("secondary_products")), jsons.SECONDARY_PRODUCT
    )
    total = F.aggregate(
        F.col("a"), F.lit(None).cast("bigint"),
        lambda s, e: F.coalesce(s, F.lit(0)) + e["product_id"],
    )
    return t.advert.select("creative_id", array.alias("a")).select(
        "creative_id", F.size("a").cast("bigint").alias("n"), total.alias("total")
    )


CHAIN_SQL = """
WITH parsed AS (
  SELECT DISTINCT daisy_chain, CAST(json(daisy_chain) AS JSON[]) AS es FROM raw_events
  WHERE daisy_chain IS NOT NULL),
elements AS (
  SELECT daisy_chain, UNNEST(es) AS e FROM parsed),
typed AS (
  SELECT daisy_chain, CAST(e ->> '$.index' AS BIGINT) AS i, CAST(e ->> '$.id' AS BIGINT) AS id,
    CAST(e ->> '$.roleId' AS BIGINT) AS r FROM elements)
SELECT daisy_chain,
  string_agg(id || '(' || r || ')', ',' ORDER BY i, id, r) AS with_roles,
  string_agg(id || '.' || r, '|' ORDER BY i, id, r) AS path
FROM typed GROUP BY daisy_chain
"""


@query("f_transform", CHAIN_SQL)
def _(t):
    chain = F.col("daisy_chain")
    return (
        t.raw_events.filter(chain.isNotNull())
        .select("daisy_chain")
        .distinct()
        .select(
            "daisy_chain",
            nested.chain_with_roles(chain).alias("with_roles"),
            nested.chain_path(chain).alias("path"),
        )
    )


@query(
    "f_substring_index",
    """
SELECT page_id,
  array_to_string(list_slice(string_split(url, '/'), 1, 3), '/') AS head,
  list_extract(string_split(url, '.'), -1) AS tail,
  array_to_string(list_slice(string_split(url, '.'), -2, -1), '.') AS last_two FROM pages
""",
)
def _(t):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        text.segments(url, "/", 3).alias("head"),
        text.segments(url, ".", -1).alias("tail"),
        text.segments(url, ".", -2).alias("last_two"),
    )


@query(
    "f_split_part",
    """
SELECT page_id, split_part(url, '.', 1) AS first, split_part(url, '.', -1) AS last,
  split_part(url, '.', 9) AS ninth FROM pages
""",
)
def _(t):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        text.part_of(url, ".", 1).alias("first"),
        text.part_of(url, ".", -1).alias("last"),
        text.part_of(url, ".", 9).alias("ninth"),
    )


@query(
    "f_url_host",
    f"""
SELECT page_id, COALESCE(regexp_extract(lower(COALESCE(
  regexp_replace(CASE WHEN page_id % 7 = 0 THEN NULL ELSE url END, '[\\n\\r]+', '', 'g'), ' ')),
  '{HOST}', 1), '') AS host FROM pages
""",
)
def _(t):
    url = F.when(F.col("page_id") % 7 != 0, F.col("url"))
    return t.pages.select("page_id", text.url_host(url).alias("host"))


@query(
    "f_url_valid",
    """
WITH u AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url
  WHEN page_id % 3 = 1 THEN split_part(url, '?', 1) ELSE 'ftp' || url END AS u FROM pages)
SELECT page_id, CASE WHEN regexp_matches(u, '^(https?://)([\\w.-]+)(:[0-9]+)?(/.*)?$') THEN u END AS valid
FROM u
""",
)
def _(t):
    url = F.col("url")
    mixed = (
        F.when(F.col("page_id") % 3 == 0, url)
        .when(F.col("page_id") % 3 == 1, F.split_part(url, F.lit("?"), F.lit(1)))
        .otherwise(F.concat(F.lit("ftp"), url))
    )
    return t.pages.select("page_id", text.valid_url(mixed).alias("valid"))


@query(
    "f_url_domain_chain",
    """
SELECT page_id, split_part(split_part(list_extract(string_split(
  array_to_string(list_slice(string_split(url, '/'), 1, 3), '/'), '://'), -1), '/', 1), '?', 1) AS domain
FROM pages
""",
)
def _(t):
    return t.pages.select("page_id", text.domain_chain(F.col("url")).alias("domain"))


@query(
    "f_strpos",
    """
SELECT page_id, strpos(html, regexp_extract(url, '://([^/]+)', 1)) > 0 AS mentions_host,
  strpos(html, '') > 0 AS empty_part FROM pages
""",
)
def _(t):
    host = text.domain_chain(F.col("url"))
    return t.pages.select(
        "page_id",
        text.contains(F.col("html"), host).alias("mentions_host"),
        text.contains(F.col("html"), F.lit("")).alias("empty_part"),
    )


@query(
    "f_like_rules",
    """
SELECT provider_occurrence_id, capture_timestamp, CASE
  WHEN occurrence_description LIKE '%/ad/%' OR occurrence_description LIKE '%/ads/%'
    OR occurrence_description LIKE '%/campaign/%' OR occurrence_description LIKE '%/campaigns/%'
    OR occurrence_description LIKE '%/promotional/%' OR occurrence_description LIKE '%/sponsor/%' THEN 150
  WHEN occurrence_description LIKE '%/content/%' THEN -150 ELSE 0 END AS score FROM raw_events
""",
)
def _(t):
    return t.raw_events.select(
        "provider_occurrence_id",
        "capture_timestamp",
        text.path_score(F.col("occurrence_description")).alias("score"),
    )


@query(
    "f_case_text",
    """
SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low,
  c_name || ', ' || c_mktsegment AS joined,
  c_mktsegment || 'x' AS clean FROM customer
""",
)
def _(t):
    dirty = F.concat(F.col("c_mktsegment"), F.expr("decode(X'00', 'UTF-8')"), F.lit("x"))
    return t.customer.select(
        "c_custkey",
        F.upper("c_mktsegment").alias("up"),
        F.lower("c_name").alias("low"),
        F.concat("c_name", F.lit(", "), "c_mktsegment").alias("joined"),
        text.strip_nul(dirty).alias("clean"),
    )


@query(
    "f_md5_key",
    """
SELECT p_partkey, upper(md5(CAST(p_partkey AS VARCHAR) || '2' || p_brand)) AS key,
  CASE WHEN p_size < 20 THEN NULL ELSE upper(md5(CAST(p_size AS VARCHAR) || '1')) END AS maybe FROM part
""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        keys.product_key(F.col("p_partkey"), "2", F.col("p_brand")).alias("key"),
        keys.product_key(F.when(F.col("p_size") >= 20, F.col("p_size")), "1").alias("maybe"),
    )


@query(
    "f_hash64_id",
    """
SELECT COUNT(DISTINCT n_text) AS n_texts, COUNT(DISTINCT n_text) AS n_ids, COUNT(*) AS n_rows,
  CAST(0 AS BIGINT) AS null_ids
FROM (SELECT c_mktsegment || CAST(c_nationkey AS VARCHAR) AS n_text FROM customer)
""",
)
def _(t):
    # the value differs by engine, so the equality classes are compared
    key = F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))
    return t.customer.select(key.alias("x"), keys.stable_id(key).alias("id")).agg(
        F.countDistinct("x").alias("n_texts"),
        F.countDistinct("id").alias("n_ids"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("id").isNull()).alias("null_ids"),
    )


@query(
    "f_ts_parse",
    """
SELECT event_id, date_trunc('second', ts) AS iso, date_trunc('second', ts) AS offset_form,
  date_trunc('second', ts) AS plain, CAST(NULL AS TIMESTAMP) AS bad FROM events
""",
)
def _(t):
    seconds = F.date_trunc("second", F.col("ts").cast("timestamp"))
    day, clock = F.date_format(seconds, "yyyy-MM-dd"), F.date_format(seconds, "HH:mm:ss")
    return t.events.select(
        "event_id",
        times.parse_capture(F.concat(day, F.lit("T"), clock, F.lit("Z"))).alias("iso"),
        times.parse_capture(F.concat(day, F.lit("T"), clock, F.lit(".000+0000"))).alias(
            "offset_form"
        ),
        times.parse_capture(F.concat(day, F.lit(" "), clock)).alias("plain"),
        times.parse_capture(F.col("event_type")).alias("bad"),
    )


@query(
    "f_ts_format",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS text,
  CAST(strftime(ts, '%Y%m') AS INT) AS month FROM events
""",
)
def _(t):
    ts = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id", times.timestamp_text(ts).alias("text"), times.month_number(ts).alias("month")
    )


@query(
    "f_interval",
    """
SELECT event_id, ts + INTERVAL 4 HOUR AS due, 202312 AS floor_month FROM events
""",
)
def _(t):
    floor = times.previous_month_number(dt.date(2024, 1, 31))
    return t.events.select(
        "event_id",
        times.due_after_four_hours(F.col("ts").cast("timestamp")).alias("due"),
        F.lit(floor).alias("floor_month"),
    )


@query(
    "f_safe_cast",
    """
SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS BIGINT) AS number,
  TRY_CAST(c_name AS INT) AS bad, TRY_CAST(CASE WHEN c_nationkey > 12 THEN 'true' ELSE 'maybe' END AS BOOLEAN)
  AS flag FROM customer
""",
)
def _(t):
    flag = F.when(F.col("c_nationkey") > 12, "true").otherwise("maybe")
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 10, 100).try_cast("bigint").alias("number"),
        F.col("c_name").try_cast("int").alias("bad"),
        flag.try_cast("boolean").alias("flag"),
    )


@query(
    "f_ms_to_s",
    """
SELECT event_id, CASE WHEN ms IS NULL OR ms = 0 THEN ms
  ELSE CAST(floor(ms / 1000.0 + 0.5) AS INT) END AS seconds
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST((event_id % 37) * 250 AS INT) END
  AS ms FROM events)
""",
)
def _(t):
    millis = F.when(F.col("event_id") % 10 != 0, ((F.col("event_id") % 37) * 250).cast("int"))
    return t.events.select("event_id", text.whole_seconds(millis).alias("seconds"))


@query(
    "f_null_handling",
    """
SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'P'), 'NA') AS status,
  COALESCE(NULLIF(trim(CASE WHEN o_custkey % 2 = 0 THEN '  ' ELSE 'x' END), ''), o_orderpriority) AS filled
FROM orders
""",
)
def _(t):
    blank = F.when(F.col("o_custkey") % 2 == 0, "  ").otherwise("x")
    return t.orders.select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("NA")).alias("status"),
        F.coalesce(F.nullif(F.trim(blank), F.lit("")), F.col("o_orderpriority")).alias("filled"),
    )


@query(
    "f_between",
    """
SELECT provider_occurrence_id, capture_timestamp,
  COALESCE(creative_duration, 30) BETWEEN 2 AND 220 AS in_range FROM raw_events
""",
)
def _(t):
    seconds = F.coalesce("creative_duration", F.lit(30))
    return t.raw_events.select(
        "provider_occurrence_id", "capture_timestamp", seconds.between(2, 220).alias("in_range")
    )


