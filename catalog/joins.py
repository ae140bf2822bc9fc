"""Joins (section 2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from sightline.functions import jsons
from sightline.operators.joins import (
    constant_lookup,
    in_any,
    membership,
    near_size_join,
    null_safe,
    only_needed,
)

EVENT = ["provider_occurrence_id", "capture_timestamp"]


@query(
    "join_inner",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp, p.data_provider_id, c.source_channel_id
FROM raw_events e JOIN data_provider p ON p.data_provider_code = e.provider_code
  AND p.record_status_flag = 'ACTIVE'
JOIN source_channel c ON lower(c.short_desc) = e.source_channel AND c.record_status_flag = 'ACTIVE'
""",
)
def _(t):
    from sightline.plans.enrich import Dims, active_channels, active_providers

    dims = Dims(data_provider=t.data_provider, source_channel=t.source_channel)
    return (
        t.raw_events.join(active_providers(dims), "provider_code")
        .join(active_channels(dims), "source_channel")
        .select(*EVENT, "data_provider_id", "source_channel_id")
    )


@query(
    "join_left",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp, m.market_id FROM raw_events e
LEFT JOIN provider_market m ON m.provider_dma_city_name = e.region_dma_name
""",
)
def _(t):
    places = t.provider_market.withColumnRenamed("provider_dma_city_name", "region_dma_name")
    return t.raw_events.join(places, "region_dma_name", "left").select(*EVENT, "market_id")


@query(
    "join_composite",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp, p.media_property_id
FROM raw_events e JOIN source_channel c ON lower(c.short_desc) = e.source_channel
LEFT JOIN property_provider p ON p.publisher_id = e.publisher_id
  AND p.source_channel_id = c.source_channel_id AND CAST(p.country_id AS VARCHAR) = '1'
  AND p.record_status_flag = 'ACTIVE'
""",
)
def _(t):
    channels = t.source_channel.select(
        F.lower("short_desc").alias("source_channel"), "source_channel_id"
    )
    links = t.property_provider.filter("record_status_flag = 'ACTIVE'").select(
        "publisher_id", "source_channel_id", F.col("country_id").cast("string").alias("country"),
        "media_property_id",
    )
    keyed = t.raw_events.join(channels, "source_channel").withColumn("country", F.lit("1"))
    return keyed.join(links, ["publisher_id", "source_channel_id", "country"], "left").select(
        *EVENT, "media_property_id"
    )


@query(
    "join_anti",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp FROM raw_events e
WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.creative_url_hash = e.creative_url_hash AND r.is_staged)
  AND e.creative_url_hash NOT IN (SELECT creative_url_hash FROM chaff)
""",
)
def _(t):
    staged = t.registry.filter("is_staged").select("creative_url_hash")
    return (
        t.raw_events.join(staged, "creative_url_hash", "left_anti")
        .join(t.chaff, "creative_url_hash", "left_anti")
        .select(*EVENT)
    )


@query(
    "join_semi",
    """
SELECT mapping_hash, system_id, target_product_id FROM product_map
WHERE mapping_hash IN (SELECT upper(md5(CAST(primary_product_id AS VARCHAR) || '1')) FROM advert
  WHERE classification_type = 'Advert')
""",
)
def _(t):
    from sightline.functions.keys import product_key

    needed = t.advert.filter("classification_type = 'Advert'").select(
        product_key(F.col("primary_product_id"), "1").alias("h")
    )
    return only_needed(t.product_map, "mapping_hash", needed, "h").select(
        "mapping_hash", "system_id", "target_product_id"
    )


@query(
    "join_range",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp, s.size_id FROM raw_events e
LEFT JOIN ad_size s ON e.creative_width BETWEEN s.size_width - 10 AND s.size_width + 10
  AND e.creative_height BETWEEN s.size_height - 10 AND s.size_height + 10
  AND e.country_iso_2_code = s.country_iso_2_code
""",
)
def _(t):
    events = t.raw_events.select(*EVENT, "creative_width", "creative_height", "country_iso_2_code")
    sizes = t.ad_size.select(
        "size_id", "size_width", "size_height", F.col("country_iso_2_code").alias("size_country")
    )
    return near_size_join(
        events, sizes, width="creative_width", height="creative_height",
        size_width="size_width", size_height="size_height", tolerance=10,
        equal=[("country_iso_2_code", "size_country")], pack=512,
    ).select(*EVENT, "size_id")


@query(
    "join_conditional",
    """
SELECT s.s_suppkey, n.n_name FROM supplier s
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND s.s_acctbal > 3000
  AND (n.n_regionkey = -1 OR n.n_regionkey <> 2)
""",
)
def _(t):
    s, n = t.supplier, t.nation
    on = (
        (n["n_nationkey"] == s["s_nationkey"])
        & (s["s_acctbal"] > 3000)
        & ((n["n_regionkey"] == -1) | (n["n_regionkey"] != 2))
    )
    return s.join(n, on, "left").select("s_suppkey", "n_name")


@query(
    "join_constant",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp, m.media_id, x.media_id AS unknown_media
FROM raw_events e LEFT JOIN media m ON m.media_id = 5 LEFT JOIN media x ON x.media_id = 4
""",
)
def _(t):
    known = constant_lookup(t.raw_events, t.media, "media_id", 5, "media_id")
    return constant_lookup(known, t.media, "media_id", 4, "unknown_media").select(
        *EVENT, "media_id", "unknown_media"
    )


@query(
    "join_twice",
    """
SELECT p.product_id, p.parent_id, c.parent_id AS current_parent,
  COALESCE(c.subsidiary_id, p.subsidiary_id) AS subsidiary_id
FROM product_flat p LEFT JOIN product_flat c ON c.product_id = p.current_product_id
""",
)
def _(t):
    p, c = t.product_flat.alias("p"), t.product_flat.alias("c")
    return p.join(c, F.col("c.product_id") == F.col("p.current_product_id"), "left").select(
        "p.product_id",
        "p.parent_id",
        F.col("c.parent_id").alias("current_parent"),
        F.coalesce("c.subsidiary_id", "p.subsidiary_id").alias("subsidiary_id"),
    )


@query(
    "join_coalesced_key",
    """
SELECT e.provider_occurrence_id, e.capture_timestamp, c.creative_id
FROM raw_events e LEFT JOIN dedupe_map d ON d.child_creative_url_hash = e.creative_url_hash
  AND d.match_type = 'Map'
LEFT JOIN creative c ON c.creative_url_hash = COALESCE(d.parent_creative_url_hash, e.creative_url_hash)
""",
)
def _(t):
    from sightline.plans.families import mapped

    parents = mapped(t.dedupe_map).select(
        F.col("child_creative_url_hash").alias("creative_url_hash"), "parent_creative_url_hash"
    )
    keyed = t.raw_events.join(parents, "creative_url_hash", "left").withColumn(
        "subject", F.coalesce("parent_creative_url_hash", "creative_url_hash")
    )
    subjects = t.creative.select(F.col("creative_url_hash").alias("subject"), "creative_id")
    return keyed.join(subjects, "subject", "left").select(*EVENT, "creative_id")


@query(
    "join_null_safe",
    """
SELECT d.creative_id, d.market_id, d.media_property_id, d.capture_date, s.occurrence_count
FROM daily d JOIN summary_stored s ON d.creative_id = s.creative_id AND d.market_id = s.market_id
  AND COALESCE(d.media_property_id, -1) = COALESCE(s.media_property_id, -1)
""",
)
def _(t):
    d, s = t.daily, t.summary_stored
    on = null_safe(d, s, ["creative_id", "market_id", "media_property_id"])
    return d.join(s, on).select(
        d["creative_id"], d["market_id"], d["media_property_id"], "capture_date", "occurrence_count"
    )


@query(
    "join_explode",
    """
SELECT creative_id, CAST(e ->> '$.product_id' AS BIGINT) AS product_id,
  CAST(e ->> '$.sort_order' AS INT) AS sort_order, e ->> '$.type' AS type
FROM (SELECT creative_id, UNNEST(CAST(json(secondary_products) AS JSON[])) AS e FROM advert
  WHERE secondary_products IS NOT NULL)
""",
)
def _(t):
    elements = F.explode(jsons.parsed(F.col("secondary_products"), jsons.SECONDARY_PRODUCT))
    return t.advert.select("creative_id", elements.alias("e")).select(
        "creative_id", "e.product_id", "e.sort_order", "e.type"
    )


@query(
    "join_explode_pos",
    """
SELECT component_coding_id, CAST(i AS INT) AS seq, a ->> '$.fkey' AS fkey, a ->> '$.id' AS id
FROM (SELECT component_coding_id, CAST(json(attribute_response) AS JSON[]) AS es FROM component
    WHERE attribute_response IS NOT NULL) c,
  LATERAL (SELECT UNNEST(es) AS a, generate_subscripts(es, 1) AS i) u
""",
)
def _(t):
    elements = F.posexplode(jsons.parsed(F.col("attribute_response"), jsons.ATTRIBUTES))
    return t.component.select("component_coding_id", elements.alias("pos", "a")).select(
        "component_coding_id", (F.col("pos") + 1).alias("seq"), "a.fkey", "a.id"
    )


@query(
    "or_of_semis",
    """
SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AS big
FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)
  OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09 AND l_returnflag = 'R')
""",
)
def _(t):
    big = t.lineitem.filter("l_quantity > 49").select("l_partkey")
    cheap = t.lineitem.filter("l_discount > 0.09 and l_returnflag = 'R'").select("l_partkey")
    on = {"p_partkey": "l_partkey"}
    return in_any(t.part, (big, on, "big"), (cheap, on, "cheap")).select("p_partkey", "big")


@query(
    "join_cross_const",
    """
SELECT n_name AS watermark_name, 'SUCCEEDED' AS status, TIMESTAMP '1900-01-01 00:00:00' AS start_timestamp
FROM nation CROSS JOIN (SELECT 1) one
""",
)
def _(t):
    # one constant row adds constant columns; no join is needed
    return t.nation.select(
        F.col("n_name").alias("watermark_name"),
        F.lit("SUCCEEDED").alias("status"),
        F.lit("1900-01-01 00:00:00").cast("timestamp").alias("start_timestamp"),
    )


@query(
    "join_membership",
    """
SELECT creative_id, creative_url_hash IN (SELECT creative_url_hash FROM chaff) AS rejected FROM creative
""",
)
def _(t):
    on = {"creative_url_hash": "creative_url_hash"}
    return membership(t.creative, t.chaff, on, "rejected").select("creative_id", "rejected")
