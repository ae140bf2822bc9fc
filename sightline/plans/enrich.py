"""The media, market and channel lookup shared by the pipelines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import rules


@dataclass(frozen=True)
class Dims:
    """Reference dimensions; each pipeline uses those it names."""

    data_provider: DataFrame | None = None
    source_channel: DataFrame | None = None
    mime_type: DataFrame | None = None
    media_property: DataFrame | None = None
    property_provider: DataFrame | None = None
    market: DataFrame | None = None
    provider_market: DataFrame | None = None
    media: DataFrame | None = None
    origin: DataFrame | None = None
    product: DataFrame | None = None
    company: DataFrame | None = None
    ad_size: DataFrame | None = None
    ad_server: DataFrame | None = None
    spend_by_property: DataFrame | None = None
    spend_by_channel: DataFrame | None = None
    match_type: DataFrame | None = None


def active(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("record_status_flag") == C.ACTIVE)


def active_channels(dims: Dims) -> DataFrame:
    return active(dims.source_channel).select(
        F.lower("short_desc").alias("source_channel"), "source_channel_id"
    )


def active_providers(dims: Dims) -> DataFrame:
    return active(dims.data_provider).select(
        F.col("data_provider_code").alias("provider_code"), "data_provider_id"
    )


def property_lookup(dims: Dims) -> DataFrame:
    """Active properties by (country, provider, channel, publisher), with their market's name."""
    properties = dims.media_property.filter(
        F.col("media_property_status_id") == C.ACTIVE_PROPERTY_STATUS
    )
    links = active(dims.property_provider).select(
        "country_id", "media_property_id", "source_channel_id", "data_provider_id", "publisher_id"
    )
    named = properties.join(links, ["country_id", "media_property_id", "source_channel_id"])
    markets = dims.market.select(
        F.col("market_id").alias("_m"), F.col("market_name").alias("property_market_name")
    )
    return named.join(markets, named["market_id"] == markets["_m"], "left").select(
        F.col("legacy_country_code").alias("country_iso_2_code"),
        "data_provider_id",
        "source_channel_id",
        "publisher_id",
        F.col("legacy_media_property_id").alias("media_property_id"),
        "media_property_name",
        F.col("primary_media_category_id").alias("media_category_id"),
        F.col("primary_media_category_code").alias("media_category_code"),
        "domain_url",
        F.col("market_id").alias("property_market_id"),
        "property_market_name",
    )


def enrich_media_market(
    events: DataFrame,
    dims: Dims,
    *,
    city_key: Column,
    require_channel: bool = True,
    mime: bool = False,
) -> DataFrame:
    """Add provider, channel, property, market and (optionally) MIME type ids to events.

    Events of unknown providers leave; events of unknown channels leave unless
    ``require_channel`` is false. Everything else is a left lookup.
    """
    lookup = property_lookup(dims)
    places = dims.provider_market.select(
        F.col("provider_dma_city_name"), F.col("market_id").alias("mapped_market_id")
    )
    names = dims.market.select(
        F.col("market_id").alias("mapped_market_id"),
        F.col("market_name").alias("mapped_market_name"),
    )
    enriched = (
        events.withColumn("provider_dma_city_name", city_key)
        .join(active_providers(dims), "provider_code")
        .join(active_channels(dims), "source_channel", "inner" if require_channel else "left")
        .join(
            lookup,
            ["country_iso_2_code", "data_provider_id", "source_channel_id", "publisher_id"],
            "left",
        )
        .join(places, "provider_dma_city_name", "left")
        .join(names, "mapped_market_id", "left")
    )
    if mime:
        types = active(dims.mime_type).select(
            F.lower("description").alias("creative_mime_type"), "mime_type_id"
        )
        enriched = enriched.join(types, "creative_mime_type", "left")
    return enriched.withColumns(
        {
            "market_id": rules.market_id(F.col("mapped_market_id"), F.col("property_market_id")),
            "market_name": rules.market_name(
                F.col("mapped_market_name"),
                F.col("property_market_id"),
                F.col("property_market_name"),
            ),
        }
    ).drop("mapped_market_id", "mapped_market_name", "property_market_id", "property_market_name")


def city_key_of(mode: str) -> Column:
    """Place key from the region columns of an event."""
    return rules.city_key(
        F.col("provider_code"),
        F.col("region_dma_name"),
        F.col("region_city_name"),
        F.col("region_state_name"),
        mode,
    )


def property_company_view(dims: Dims) -> DataFrame:
    """Active properties of the country with the company id from either of two levels, or 0."""
    companies = dims.company.filter(F.col("legacy_id") != C.COMPANY_LEGACY_EXCLUDED)

    def level(number: int, name: str) -> DataFrame:
        rows = companies.filter(F.col("companylevel_id") == number)
        return rows.select(
            F.col("legacy_id").alias("parent_company_id"), F.col("company_id").alias(name)
        )

    properties = dims.media_property.filter(
        (F.col("media_property_status_id") == C.ACTIVE_PROPERTY_STATUS)
        & (F.col("legacy_country_code") == C.COUNTRY_US)
    )
    return (
        properties.join(level(C.COMPANY_LEVEL_PARENT, "_parent"), "parent_company_id", "left")
        .join(level(C.COMPANY_LEVEL_SUBSIDIARY, "_subsidiary"), "parent_company_id", "left")
        .withColumn(
            "vx0_parent_company_id", F.coalesce("_parent", "_subsidiary", F.lit(0))
        )
        .drop("_parent", "_subsidiary")
    )
