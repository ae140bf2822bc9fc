"""Creative push, first seen and occurrence summary (C2 to C9, C31, C32)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.enrichment import CITY_BLANKS, CITY_STRICT, dims, enriched
from catalog.projections import MIME
from catalog.registry import query
from sightline import constants as C
from sightline.functions import jsons, rules
from sightline.plans import enrich, push, summary
from sightline.session import new_scratch

NOW = dt.datetime(2024, 2, 1)
KEY = ["provider_occurrence_id", "capture_timestamp"]

FIRST = """first_events AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY creative_url_hash
    ORDER BY capture_timestamp, provider_occurrence_id) AS rn FROM raw_events
  WHERE country_iso_2_code = 'US' AND creative_url IS NOT NULL AND COALESCE(retransmit, FALSE) = FALSE)
  WHERE rn = 1)"""

HOST = r"^(?:https?://)?(?:[@\n]+@)?(?:www.)?([^:/\n?]+)"
CANDIDATES = f"""{FIRST},
fresh AS (SELECT * EXCLUDE (rn) REPLACE ({MIME} AS creative_mime_type), {CITY_STRICT} AS city,
    CASE WHEN regexp_matches(json_extract_string(raw_json, '$.occurrence.creativeUrl'),
      '^(https?://)([\\w.-]+)(:[0-9]+)?(/.*)?$') THEN json_extract_string(raw_json, '$.occurrence.creativeUrl')
      END AS occurrence_creative_url,
    CASE WHEN provider_code = 'BISSocial' THEN 'NA' END AS attribution_status,
    CASE WHEN provider_code = 'BISSocial'
      THEN COALESCE(json_extract_string(raw_json, '$.occurrence.socialCampaignText'), '') END
      AS social_campaign_text
  FROM first_events f
  WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.creative_url_hash = f.creative_url_hash AND r.is_staged)
    AND NOT EXISTS (SELECT 1 FROM chaff r WHERE r.creative_url_hash = f.creative_url_hash)),
looked_up AS ({enriched('fresh')}),
typed AS (SELECT l.*, mt.mime_type_id FROM looked_up l LEFT JOIN (SELECT lower(description) AS d, mime_type_id
    FROM mime_type WHERE record_status_flag = 'ACTIVE') mt ON mt.d = l.creative_mime_type),
candidates AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY creative_url_hash
    ORDER BY capture_timestamp, media_property_id NULLS LAST, market_id NULLS LAST) AS rn,
    COALESCE(regexp_extract(lower(COALESCE(occurrence_creative_url, ' ')), '{HOST}', 1), '') AS url_domain
  FROM typed) WHERE rn = 1)"""

SHOWN = [
    "creative_url_hash", "provider_occurrence_id", "provider_code", "source_channel", "capture_timestamp",
    "mime_type_id", "media_property_id", "media_property_name", "media_category_code", "market_id",
    "market_name", "occurrence_creative_url", "attribution_status", "social_campaign_text",
]


@query(
    "new_creatives",
    f"WITH {CANDIDATES} SELECT {', '.join(SHOWN)}, url_domain FROM candidates",
)
def _(t):
    found = push.new_creatives(t.raw_events, t.registry, t.chaff, dims(t))
    return found.select(*SHOWN, F.col("occurrence_creative_url_domain").alias("url_domain"))


def _like(column: str) -> str:
    paths = ["/ad/", "/ads/", "/campaign/", "/campaigns/", "/promotional/", "/sponsor/"]
    any_path = " OR ".join(f"{column} LIKE '%{p}%'" for p in paths)
    return f"CASE WHEN {any_path} THEN 150 WHEN {column} LIKE '%/content/%' THEN -150 ELSE 0 END"


DOMAIN = """split_part(split_part(list_extract(string_split(
  array_to_string(list_slice(string_split(c.domain_url, '/'), 1, 3), '/'), '://'), -1), '/', 1), '?', 1)"""
SCORED = f"""sizes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY size_width, size_height,
    country_iso_2_code ORDER BY size_name DESC, size_id) AS srn FROM ad_size
  WHERE country_iso_2_code = 'US' AND record_status_flag = 'ACTIVE' AND size_id <> 5) WHERE srn = 1),
servers AS (SELECT DISTINCT COALESCE(regexp_extract(lower(ad_server), '{HOST}', 1), '') AS s
  FROM ad_server WHERE record_status_flag = 'ACTIVE'),
scored AS (SELECT c.creative_url_hash, c.provider_code, c.creative_type, c.creative_duration,
    CASE WHEN z.size_id IS NOT NULL THEN 30 ELSE 0 END AS ad_size_score,
    CASE c.creative_type WHEN 'html5' THEN 1500 WHEN 'flash' THEN 330 ELSE 0 END AS creative_type_score,
    CASE WHEN COALESCE(v.s, '') <> '' THEN 500 ELSE 0 END AS ad_server_score,
    {_like('c.occurrence_description')} AS href_score,
    {_like('c.occurrence_creative_url')} AS creative_url_score,
    CASE WHEN COALESCE(c.occurrence_description, '') <> ''
      THEN CASE WHEN strpos(c.occurrence_description, {DOMAIN}) > 0 THEN 160 ELSE 300 END ELSE 0 END
      AS click_through_score
  FROM (SELECT * FROM candidates WHERE provider_code = 'BIS') c
  LEFT JOIN sizes z ON c.creative_width BETWEEN z.size_width - 10 AND z.size_width + 10
    AND c.creative_height BETWEEN z.size_height - 10 AND z.size_height + 10
    AND c.country_iso_2_code = z.country_iso_2_code
  LEFT JOIN servers v ON v.s = c.url_domain),
rejected AS (SELECT DISTINCT * FROM (SELECT *, CASE
    WHEN creative_type = 'video' THEN NOT (COALESCE(creative_duration, 30) BETWEEN 2 AND 220)
    WHEN creative_type IN ('html5', 'flash', 'banner', 'BANNER')
      THEN ad_size_score + creative_type_score + ad_server_score + href_score + creative_url_score
        + click_through_score < 315
    ELSE FALSE END AS is_auto_chaff FROM scored) WHERE is_auto_chaff)"""


@query(
    "autochaff_score",
    f"""WITH {CANDIDATES}, {SCORED}
SELECT creative_url_hash, creative_type, creative_duration, ad_size_score, creative_type_score,
  ad_server_score, href_score, creative_url_score, click_through_score, is_auto_chaff FROM rejected""",
)
def _(t):
    candidates = push.new_creatives(t.raw_events, t.registry, t.chaff, dims(t))
    return push.autochaff(candidates, dims(t)).drop("provider_code", "data_provider_code_score")


@query(
    "exclude_autochaff",
    f"""WITH {CANDIDATES}, {SCORED}
SELECT creative_url_hash, provider_code FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM rejected r
  WHERE r.creative_url_hash = c.creative_url_hash AND r.provider_code = c.provider_code)""",
)
def _(t):
    candidates, rejected = push.scored_candidates(t.raw_events, t.registry, t.chaff, dims(t))
    kept = push.exclude_autochaff(candidates, rejected)
    return kept.select("creative_url_hash", "provider_code")


METADATA = """provider_occurrence_id AS occurrence_id,
  strftime(capture_timestamp + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS due_timestamp,
  CAST(market_id AS VARCHAR) AS meta_market"""


@query(
    "autochaff_records",
    f"""WITH {CANDIDATES}, {SCORED}
SELECT c.creative_url_hash, CASE WHEN provider_code = 'AVOD BISCTV' THEN 30 ELSE 5 END AS media_id,
  {METADATA}, 26 AS n_keys
FROM candidates c WHERE c.creative_url_hash IN (SELECT creative_url_hash FROM rejected)""",
)
def _(t):
    candidates, rejected = push.scored_candidates(t.raw_events, t.registry, t.chaff, dims(t))
    records = push.autochaff_records(candidates, rejected, F.lit(NOW))
    meta = F.col("first_seen_metadata")
    return records.select(
        "creative_url_hash", "media_id",
        jsons.text_at(meta, "$.occurrence_id").alias("occurrence_id"),
        jsons.text_at(meta, "$.due_timestamp").alias("due_timestamp"),
        jsons.text_at(meta, "$.market_id").alias("meta_market"),
        F.size(F.json_object_keys(meta)).alias("n_keys"),
    )


KEPT = f"""{CANDIDATES}, {SCORED},
kept AS (SELECT c.* FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM rejected r
  WHERE r.creative_url_hash = c.creative_url_hash AND r.provider_code = c.provider_code)),
new_rows AS (SELECT k.*, 26000000000 + row_number() OVER (ORDER BY created_timestamp, creative_url_hash) - 1
    AS creative_id FROM kept k WHERE k.creative_url_hash NOT IN (SELECT creative_url_hash FROM registry)),
staged AS (SELECT * FROM new_rows UNION ALL
  SELECT k.*, r.creative_id FROM kept k JOIN registry r ON r.creative_url_hash = k.creative_url_hash
    AND NOT r.is_staged)"""


def pushed(t) -> push.Push:
    return push.push(
        t.raw_events, t.registry, t.chaff, dims(t), C.CREATIVE_ID_START, F.lit(NOW)
    )


@query(
    "stage_creatives",
    f"""WITH {KEPT}
SELECT creative_id, creative_url_hash, CASE WHEN provider_code = 'AVOD BISCTV' THEN 30 ELSE 5 END AS media_id,
  CASE WHEN provider_code = 'BISSocial' THEN 'O' END AS record_status,
  CASE WHEN provider_code = 'BISSocial' THEN '{{"attribution_status":"NA"}}' END AS response,
  {METADATA}, 29 AS n_keys FROM staged""",
)
def _(t):
    meta = F.col("first_seen_metadata")
    return pushed(t).staged.select(
        "creative_id", "creative_url_hash", "media_id", "record_status",
        F.col("creative_machine_learning_response").alias("response"),
        jsons.text_at(meta, "$.occurrence_id").alias("occurrence_id"),
        jsons.text_at(meta, "$.due_timestamp").alias("due_timestamp"),
        jsons.text_at(meta, "$.market_id").alias("meta_market"),
        F.size(F.json_object_keys(meta)).alias("n_keys"),
    )


@query(
    "register_creatives",
    f"""WITH {KEPT}
SELECT creative_id, creative_url_hash, CASE WHEN creative_url_hash IN (SELECT creative_url_hash FROM staged)
  THEN TRUE ELSE is_staged END AS is_staged, first_seen_provider_id FROM registry
UNION ALL
SELECT creative_id, creative_url_hash, TRUE, data_provider_id FROM new_rows""",
)
def _(t):
    return pushed(t).registry.select(
        "creative_id", "creative_url_hash", "is_staged", "first_seen_provider_id"
    )


@query(
    "seed_first_seen",
    f"""WITH {KEPT}
SELECT creative_id, creative_url_hash, provider_occurrence_id AS occurrence_id,
  capture_timestamp AS occurrence_timestamp, capture_timestamp + INTERVAL 4 HOUR AS due_timestamp,
  data_provider_id AS provider_id, media_property_name, CAST(publisher_id AS INT) AS provider_publisher_id,
  market_id, market_name, provider_campaign_landing_page FROM staged
WHERE creative_url_hash NOT IN (SELECT creative_url_hash FROM first_seen WHERE media_property_id > 10)""",
)
def _(t):
    stored = t.first_seen.filter("media_property_id > 10")
    return push.seed_first_seen(stored, pushed(t).staged, dims(t), F.lit(NOW)).select(
        "creative_id", "creative_url_hash", "occurrence_id", "occurrence_timestamp",
        "due_timestamp", "provider_id", "media_property_name", "provider_publisher_id",
        "market_id", "market_name", "provider_campaign_landing_page",
    )


@query(
    "first_seen_update",
    f"""WITH {FIRST},
known AS (SELECT f.* EXCLUDE (rn), r.creative_id, {CITY_BLANKS} AS city FROM first_events f
  JOIN registry r ON r.creative_url_hash = f.creative_url_hash),
looked_up AS ({enriched('known')}),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY creative_url_hash ORDER BY capture_timestamp,
    media_property_id NULLS LAST, market_id) AS rn FROM looked_up) WHERE rn = 1)
SELECT s.creative_id, s.creative_url_hash,
  CASE WHEN hit THEN o.provider_occurrence_id ELSE s.occurrence_id END AS occurrence_id,
  CASE WHEN hit THEN o.capture_timestamp ELSE s.occurrence_timestamp END AS occurrence_timestamp,
  CASE WHEN hit THEN CASE WHEN o.provider_code = 'AVOD BISCTV' THEN 30 ELSE 5 END ELSE s.media_id END AS media_id,
  CASE WHEN hit THEN o.data_provider_id ELSE s.provider_id END AS provider_id,
  CASE WHEN hit THEN o.media_property_id ELSE s.media_property_id END AS media_property_id,
  CASE WHEN hit THEN o.market_id ELSE s.market_id END AS market_id,
  CASE WHEN hit THEN o.market_name ELSE s.market_name END AS market_name,
  CASE WHEN hit THEN TIMESTAMP '2024-02-01 00:00:00' ELSE s.updated_timestamp END AS updated_timestamp
FROM first_seen s LEFT JOIN one o ON o.creative_url_hash = s.creative_url_hash,
LATERAL (SELECT COALESCE(s.occurrence_timestamp > o.capture_timestamp, FALSE) AS hit) h""",
)
def _(t):
    found = push.first_seen_candidates(t.raw_events, t.registry, dims(t), F.lit(NOW))
    return push.first_seen_update(t.first_seen, found).select(
        "creative_id", "creative_url_hash", "occurrence_id", "occurrence_timestamp", "media_id",
        "provider_id", "media_property_id", "market_id", "market_name", "updated_timestamp",
    )


@query(
    "enrich_media_market",
    f"""WITH source AS (SELECT *, {CITY_STRICT} AS city FROM raw_events), looked_up AS ({enriched('source')})
SELECT provider_occurrence_id, capture_timestamp, data_provider_id, source_channel_id, media_property_id,
  media_property_name, media_category_id, domain_url, market_id, market_name FROM looked_up""",
)
def _(t):
    rows = enrich.enrich_media_market(
        t.raw_events, dims(t), city_key=enrich.city_key_of(rules.CITY_STRICT)
    )
    return rows.select(
        *KEY, "data_provider_id", "source_channel_id", "media_property_id", "media_property_name",
        "media_category_id", "domain_url", "market_id", "market_name",
    )


@query(
    "property_company_view",
    """
SELECT m.legacy_media_property_id, m.source_channel_id, COALESCE(p.company_id, s.company_id, 0)
  AS vx0_parent_company_id
FROM media_property m
LEFT JOIN company p ON m.parent_company_id = p.legacy_id AND p.companylevel_id = 3 AND p.legacy_id <> 9999
LEFT JOIN company s ON m.parent_company_id = s.legacy_id AND s.companylevel_id = 2 AND s.legacy_id <> 9999
WHERE m.media_property_status_id = 92 AND m.legacy_country_code = 'US'
""",
)
def _(t):
    return enrich.property_company_view(dims(t)).select(
        "legacy_media_property_id", "source_channel_id", "vx0_parent_company_id"
    )


SUMMARY = f"""both_sides AS (SELECT provider_occurrence_id, creative_url_hash, provider_code, country_iso_2_code,
    source_channel, {CITY_STRICT} AS city, publisher_id, capture_date, capture_timestamp FROM raw_events
  UNION SELECT provider_occurrence_id, creative_url_hash, provider_code, country_iso_2_code,
    source_channel, provider_dma_city_name, publisher_id, capture_date, capture_timestamp FROM summary_buffer),
one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY provider_code,
    provider_occurrence_id ORDER BY capture_date DESC, capture_timestamp DESC) AS rn FROM both_sides)
  WHERE rn = 1 AND creative_url_hash NOT IN (SELECT creative_url_hash FROM chaff)),
looked_up AS ({enriched('one', channel='LEFT JOIN')}),
candidates AS (SELECT l.*, r.creative_id, CASE WHEN l.provider_code = 'AVOD BISCTV' THEN 30 ELSE 5 END AS media_id
  FROM looked_up l LEFT JOIN registry r ON r.creative_url_hash = l.creative_url_hash),
by_day AS (SELECT creative_id, creative_url_hash, country_iso_2_code, market_id, media_id, media_property_id,
    capture_date, MIN(capture_timestamp) AS lo, MAX(capture_timestamp) AS hi, COUNT(*) AS occ_cnt
  FROM candidates WHERE creative_id IS NOT NULL AND media_property_id IS NOT NULL GROUP BY ALL),
stored AS (SELECT creative_id + 1000 AS creative_id, creative_id * 31 + 7 AS creative_url_hash,
    'US' AS country_iso_2_code, market_id + 100 AS market_id, 5 AS media_id,
    market_id + 5000 AS media_property_id, CAST(SUM(occurrence_count) AS BIGINT) AS occurrence_count,
    TIMESTAMP '2024-01-05 00:00:00' AS first_run, TIMESTAMP '2024-01-06 00:00:00' AS last_run,
    CAST(2 AS BIGINT) AS seven_days_occ_count FROM summary_stored GROUP BY ALL)"""
GROUP = "creative_id, creative_url_hash, country_iso_2_code, market_id, media_id, media_property_id"


def summary_run(t):
    stored = (
        t.summary_stored.groupBy("creative_id", "market_id")
        .agg(F.sum("occurrence_count").alias("occurrence_count"))
        .select(
            (F.col("creative_id") + 1000).alias("creative_id"),
            (F.col("creative_id") * 31 + 7).alias("creative_url_hash"),
            F.lit("US").alias("country_iso_2_code"),
            (F.col("market_id") + 100).alias("market_id"),
            F.lit(5).alias("media_id"),
            (F.col("market_id") + 5000).alias("media_property_id"),
            "occurrence_count",
            F.lit(dt.datetime(2024, 1, 5)).alias("first_run"),
            F.lit(dt.datetime(2024, 1, 6)).alias("last_run"),
            F.lit(2).cast("bigint").alias("seven_days_occ_count"),
        )
    )
    return stored, summary.occurrence_summary(
        t.raw_events, t.summary_buffer, stored, t.registry, t.chaff, dims(t)
    )


@query(
    "occurrence_summary",
    f"""WITH {SUMMARY},
totals AS (SELECT {GROUP}, CAST(SUM(n) AS BIGINT) AS occurrence_count, MIN(lo) AS first_run, MAX(hi) AS last_run,
    CAST(SUM(early) AS BIGINT) AS early FROM (
    SELECT {GROUP}, occurrence_count AS n, first_run AS lo, last_run AS hi, seven_days_occ_count AS early FROM stored
    UNION ALL SELECT {GROUP}, occ_cnt, lo, hi, 0 FROM by_day) GROUP BY ALL),
soon AS (SELECT d.{GROUP.replace(', ', ', d.')}, CAST(SUM(d.occ_cnt) AS BIGINT) AS n FROM by_day d JOIN totals t
  USING ({GROUP}) WHERE d.capture_date - CAST(t.first_run AS DATE) < 7 GROUP BY ALL)
SELECT t.{GROUP.replace(', ', ', t.')}, t.occurrence_count, t.first_run, t.last_run,
  t.early + COALESCE(s.n, 0) AS seven_days_occ_count FROM totals t LEFT JOIN soon s USING ({GROUP})""",
)
def _(t):
    stored, run = summary_run(t)
    state = summary.summary_state(t.spark, new_scratch(t.spark, "summary"), stored, 8)
    state.apply(stored, lambda _, batch: batch, 0)
    summary.fold_summary(state, run.daily, 1)
    return state.read()


@query(
    "summary_buffer_next",
    f"""WITH {SUMMARY}
SELECT b.provider_occurrence_id, b.provider_code, b.creative_url_hash FROM summary_buffer b
WHERE NOT EXISTS (SELECT 1 FROM candidates c WHERE c.provider_occurrence_id = b.provider_occurrence_id
  AND c.provider_code = b.provider_code AND c.creative_id IS NOT NULL)
UNION ALL
SELECT DISTINCT provider_occurrence_id, provider_code, creative_url_hash FROM candidates c
WHERE creative_id IS NULL AND NOT EXISTS (SELECT 1 FROM summary_buffer b
  WHERE c.provider_occurrence_id = b.provider_occurrence_id AND c.provider_code = b.provider_code)""",
)
def _(t):
    return summary_run(t)[1].buffer.select(
        "provider_occurrence_id", "provider_code", "creative_url_hash"
    )
