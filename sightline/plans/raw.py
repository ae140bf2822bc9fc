"""Staging rows to typed raw occurrences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import text, times
from sightline.operators.merge import absent_rows
from sightline.operators.picks import latest_per_key
from sightline.session import materialize

# every leaf is read as text and cast safely afterwards; one parse per row
_LANDED = """
struct<
  channel: string, retransmit: string,
  occurrence: struct<
    id: string, captureDate: string, purchaseMethod: string, unifiedChain: string,
    source: struct<
      id: string,
      publisher: struct<id: string, domain: string>,
      region: struct<countryId: string, dmaId: string, dmaName: string, cityId: string,
                     cityName: string, stateId: string, stateName: string>>,
    creative: struct<id: string, url: string, type: string, mimeType: string,
                     videoAttributes: struct<duration: string>>,
    campaign: struct<id: string, name: string, description: string, landingPage: string,
                     product: struct<id: string, name: string>,
                     advertiser: struct<id: string, name: string>>>>
"""


def typed_projection(staging: DataFrame, now: Column) -> DataFrame:
    """The 42 raw columns from landed JSON; a value that does not fit its type is NULL."""
    # projections of their own, so that text is parsed once per row however often it is used
    rows = staging.withColumn("_j", F.from_json("json_data", _LANDED)).withColumn(
        "_captured", times.parse_capture(F.col("_j.occurrence.captureDate"))
    )
    occ, creative = F.col("_j.occurrence"), F.col("_j.occurrence.creative")
    source, region = occ["source"], occ["source"]["region"]
    campaign = occ["campaign"]
    captured = F.col("_captured")
    null = F.lit(None)
    return rows.select(
        F.upper(region["countryId"]).alias("country_iso_2_code"),
        F.lit(C.PROVIDER_CTV).alias("provider_code"),
        F.lower("_j.channel").alias("source_channel"),
        occ["id"].alias("provider_occurrence_id"),
        creative["id"].try_cast("bigint").alias("provider_creative_id"),
        source["id"].try_cast("bigint").alias("provider_source_id"),
        captured.cast("date").alias("capture_date"),
        times.month_number(captured).alias("capture_month"),
        captured.alias("capture_timestamp"),
        null.cast("timestamp").alias("eventhub_enqueued_timestamp"),
        now.alias("created_timestamp"),
        region["dmaId"].try_cast("int").alias("region_dma_id"),
        region["dmaName"].alias("region_dma_name"),
        region["countryId"].alias("region_country_code"),
        region["cityId"].try_cast("int").alias("region_city_id"),
        region["cityName"].alias("region_city_name"),
        region["stateId"].try_cast("int").alias("region_state_id"),
        region["stateName"].alias("region_state_name"),
        creative["type"].alias("creative_type"),
        creative["mimeType"].alias("creative_mime_type"),
        source["publisher"]["id"].try_cast("bigint").alias("publisher_id"),
        source["publisher"]["domain"].alias("publisher_domain"),
        null.cast("int").alias("creative_width"),
        null.cast("int").alias("creative_height"),
        text.whole_seconds(creative["videoAttributes"]["duration"].try_cast("int")).alias(
            "creative_duration"
        ),
        creative["url"].alias("creative_url"),
        "creative_url_hash",
        F.col("_j.retransmit").try_cast("boolean").alias("retransmit"),
        campaign["id"].try_cast("bigint").alias("provider_campaign_id"),
        campaign["product"]["id"].try_cast("bigint").alias("provider_campaign_product_id"),
        campaign["advertiser"]["id"].try_cast("bigint").alias("provider_campaign_advertiser_id"),
        campaign["name"].alias("provider_campaign_name"),
        campaign["product"]["name"].alias("provider_campaign_product_name"),
        campaign["advertiser"]["name"].alias("provider_campaign_advertiser_name"),
        campaign["description"].alias("provider_campaign_description"),
        campaign["landingPage"].alias("provider_campaign_landing_page"),
        null.cast("string").alias("occurrence_description"),
        null.cast("string").alias("occurrence_link_url"),
        occ["unifiedChain"].alias("daisy_chain"),
        occ["purchaseMethod"].try_cast("smallint").alias("purchase_method_id"),
        null.cast("string").alias("ad_insertion_point"),
        F.col("json_data").alias("raw_json"),
        F.col("created_timestamp").alias("_loaded_at"),
        F.col("record_index").alias("_index"),
    )


def is_whitelisted(publishers: Sequence[int] = C.RAW_PUBLISHER_IDS) -> Column:
    return (
        (F.col("creative_type") == C.RAW_CREATIVE_TYPE)
        & (F.col("creative_mime_type") == C.RAW_MIME_TYPE)
        & F.col("publisher_id").isin(list(publishers))
    )


def whitelisted(raw: DataFrame, publishers: Sequence[int] = C.RAW_PUBLISHER_IDS) -> DataFrame:
    return raw.filter(is_whitelisted(publishers))


def raw_occurrences(
    staging: DataFrame,
    target: DataFrame | None,
    now: Column,
    publishers: Sequence[int] = C.RAW_PUBLISHER_IDS,
) -> DataFrame:
    """New raw rows: latest landed row per occurrence id, whitelisted, not yet in the target.

    Only the newest delivery of an id counts, so the pick comes before the whitelist. Rows that
    are not whitelisted take part in the pick without their payload, which keeps the shuffle
    close to the size of the result.
    """
    typed = typed_projection(staging, now)
    columns = [c for c in typed.columns if c not in ("_loaded_at", "_index")]
    slim = typed.select(
        "provider_occurrence_id",
        "_loaded_at",
        "_index",
        F.xxhash64("raw_json").alias("_tie"),
        F.when(is_whitelisted(publishers), F.struct(*columns)).alias("_row"),
    )
    newest = latest_per_key(
        slim, ["provider_occurrence_id"], "_loaded_at", F.desc("_index"), F.desc("_tie")
    )
    fresh = newest.filter(F.col("_row").isNotNull()).select("_row.*")
    if target is None:
        return fresh
    # stored once: the merge reads it twice, and its JSON must not be parsed twice
    fresh = materialize(fresh, "raw")
    return absent_rows(target, fresh, ["provider_occurrence_id", "capture_month"])
