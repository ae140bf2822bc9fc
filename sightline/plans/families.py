"""Updates of stored creatives from their families and their gold events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import times
from sightline.operators.merge import differs, merge
from sightline.operators.picks import first_per_key
from sightline.plans.enrich import Dims, active

#: first-seen columns of a creative and the first-seen table's columns they come from
FIRST_SEEN = {
    "first_seen_provider_occurrence_id": "occurrence_id",
    "first_seen_occurrence_timestamp": "occurrence_timestamp",
    "first_seen_provider_code": "data_provider_code",
    **{
        f"first_seen_{c}": c
        for c in (
            "media_property_id", "media_property_name", "media_category_id",
            "media_category_code", "provider_creative_link_url", "provider_publisher_id",
            "provider_publisher_domain", "provider_campaign_id", "provider_campaign_name",
            "provider_advertiser_id", "provider_advertiser_name", "provider_product_id",
            "provider_product_name", "provider_campaign_landing_page", "market_id",
            "market_name", "daypart_id", "daypart_name", "affiliate_id", "affiliate_name",
        )
    },
}


def mapped(dedupe_map: DataFrame) -> DataFrame:
    return dedupe_map.filter(F.col("match_type") == C.MATCH_TYPE_MAP)


def families_of(changed: DataFrame, dedupe_map: DataFrame) -> DataFrame:
    """(parent, member) pairs of every family that holds a changed creative.

    The map has two levels, so a parent is found with one join; a creative without a parent
    is its own family.
    """
    links = mapped(dedupe_map).select(
        "parent_creative_id", F.col("child_creative_id").alias("creative_id")
    )
    parents = (
        changed.join(links, "creative_id", "left")
        .select(F.coalesce("parent_creative_id", "creative_id").alias("parent_creative_id"))
        .distinct()
    )
    children = links.join(parents, "parent_creative_id", "left_semi")
    selves = parents.withColumn("creative_id", F.col("parent_creative_id"))
    return children.unionByName(selves)


def family_first_seen(
    changed: DataFrame, dedupe_map: DataFrame, first_seen: DataFrame, dims: Dims
) -> DataFrame:
    """Earliest first-seen row of each affected family, for known providers and media."""
    members = families_of(changed, dedupe_map).join(first_seen, "creative_id")
    earliest = first_per_key(
        members,
        ["parent_creative_id"],
        [F.asc_nulls_last("occurrence_timestamp"), F.asc("creative_id")],
    )
    providers = active(dims.data_provider).select(
        F.col("data_provider_id").alias("provider_id"), "data_provider_code"
    )
    media = dims.media.select(F.col("media_id").cast("string").alias("_media"))
    return earliest.join(
        media, earliest["media_id"].cast("string") == media["_media"], "left_semi"
    ).join(providers, "provider_id")


def apply_family_first_seen(creatives: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Parents whose stored first event differs; a parent without one is left alone."""
    source = found.select(
        F.col("parent_creative_id").alias("creative_id"),
        *[F.col(theirs).alias(ours) for ours, theirs in FIRST_SEEN.items() if theirs in found.columns],
        now.alias("updated_timestamp"),
    )
    return merge(
        creatives,
        source,
        ["creative_id"],
        when=differs("first_seen_occurrence_timestamp"),
        insert=False,
    )


def first_seen_event_id(
    creatives: DataFrame, events: DataFrame, *, updated_from: dt.date, today: dt.date
) -> DataFrame:
    """Internal event id for creatives that still lack it, from recent event partitions."""
    open_rows = creatives.filter(
        F.col("first_seen_occurrence_id").isNull()
        # a range on the column itself, so that the filter reaches the scan
        & (F.col("updated_timestamp") >= F.lit(dt.datetime.combine(updated_from, dt.time())))
    ).select("creative_id", "creative_url_hash", "first_seen_provider_occurrence_id")
    recent = events.filter(F.col("capture_month") >= times.previous_month_number(today)).select(
        "occurrence_id",
        F.col("provider_original_creative_url_hash").alias("creative_url_hash"),
        F.col("provider_occurrence_id").alias("first_seen_provider_occurrence_id"),
    )
    hits = open_rows.join(recent, ["creative_url_hash", "first_seen_provider_occurrence_id"])
    return hits.groupBy("creative_id", "creative_url_hash").agg(
        F.min("occurrence_id").alias("occurrence_id")
    )


def apply_event_id(creatives: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    source = found.select(
        "creative_id",
        "creative_url_hash",
        F.col("occurrence_id").alias("first_seen_occurrence_id"),
        now.alias("updated_timestamp"),
    )
    return merge(creatives, source, ["creative_id", "creative_url_hash"], insert=False)


def last_seen(events: DataFrame, since: Column) -> DataFrame:
    """Latest live event of each creative with a changed event."""
    changed = events.filter(F.col("updated_timestamp") > since).select("creative_id").distinct()
    live = events.filter(F.col("delete_flag") == F.lit(False)).select(
        "creative_id", "capture_timestamp"
    )
    # a maximum combines before the shuffle, unlike ranking every event
    return (
        live.join(changed, "creative_id", "left_semi")
        .groupBy("creative_id")
        .agg(F.max("capture_timestamp").alias("last_seen_timestamp"))
    )


def apply_last_seen(creatives: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    return merge(
        creatives,
        found.withColumn("updated_timestamp", now),
        ["creative_id"],
        when=differs("last_seen_timestamp"),
        insert=False,
    )
