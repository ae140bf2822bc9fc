"""SQL of the shared media and market lookup, and its dimensions as DataFrames."""

from __future__ import annotations

from sightline.plans.enrich import Dims

CITY_STRICT = """CASE WHEN provider_code IN ('BIS', 'BISSocial') THEN COALESCE(region_dma_name, region_city_name)
    WHEN provider_code IN ('PlayOn', 'AVOD BISCTV') THEN region_city_name || ', ' || region_state_name END"""
CITY_BLANKS = """CASE WHEN provider_code IN ('BIS', 'BISSocial') THEN COALESCE(region_dma_name, region_city_name)
    WHEN provider_code IN ('PlayOn', 'AVOD BISCTV')
    THEN COALESCE(region_city_name, '') || ', ' || COALESCE(region_state_name, '') END"""


def enriched(source: str, *, channel: str = "JOIN", extra: str = "") -> str:
    """SELECT over a relation with a ``city`` column; joined columns have fixed names."""
    return f"""
SELECT e.*, dp.data_provider_id, sc.source_channel_id, pl.legacy_media_property_id AS media_property_id,
  pl.media_property_name, pl.media_category_id, pl.media_category_code, pl.domain_url,
  CASE WHEN pm.market_id IS NOT NULL THEN pm.market_id WHEN pl.market_id > 0 THEN pl.market_id ELSE 302 END
    AS market_id,
  CASE WHEN mk.market_name IS NOT NULL THEN mk.market_name
    WHEN pl.market_id > 0 AND pl.market_name IS NOT NULL THEN pl.market_name ELSE '~NOT SPECIFIED' END
    AS market_name{extra}
FROM {source} e
JOIN data_provider dp ON dp.data_provider_code = e.provider_code AND dp.record_status_flag = 'ACTIVE'
{channel} (SELECT lower(short_desc) AS ch, source_channel_id FROM source_channel
  WHERE record_status_flag = 'ACTIVE') sc ON sc.ch = e.source_channel
LEFT JOIN (SELECT mp.*, pp.data_provider_id, pp.publisher_id, gm.market_name,
    mp.primary_media_category_id AS media_category_id, mp.primary_media_category_code AS media_category_code
  FROM media_property mp JOIN property_provider pp ON mp.country_id = pp.country_id
    AND mp.media_property_id = pp.media_property_id AND mp.source_channel_id = pp.source_channel_id
    AND pp.record_status_flag = 'ACTIVE' AND mp.media_property_status_id = 92
  LEFT JOIN market gm ON gm.market_id = mp.market_id) pl
  ON pl.legacy_country_code = e.country_iso_2_code AND pl.data_provider_id = dp.data_provider_id
  AND pl.source_channel_id = sc.source_channel_id AND pl.publisher_id = e.publisher_id
LEFT JOIN provider_market pm ON pm.provider_dma_city_name = e.city
LEFT JOIN market mk ON mk.market_id = pm.market_id
"""


def dims(t) -> Dims:
    return Dims(
        data_provider=t.data_provider,
        source_channel=t.source_channel,
        mime_type=t.mime_type,
        media_property=t.media_property,
        property_provider=t.property_provider,
        market=t.market,
        provider_market=t.provider_market,
        media=t.media,
        origin=t.origin,
        product=t.product_flat,
        company=t.company,
        ad_size=t.ad_size,
        ad_server=t.ad_server,
        spend_by_property=t.spend_property,
        spend_by_channel=t.spend_channel,
        match_type=t.match_type,
    )
