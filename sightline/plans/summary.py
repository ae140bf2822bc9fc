"""Occurrence counts per creative, market and property."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import rules
from sightline.operators.buckets import BucketedState
from sightline.operators.joins import constant_lookup
from sightline.operators.merge import accumulate, count_first_days, merge, park_release
from sightline.operators.picks import latest_per_key
from sightline.plans.enrich import Dims, city_key_of, enrich_media_market
from sightline.session import materialize

BUFFER_KEY = ["provider_occurrence_id", "provider_code"]
BUFFER_COLUMNS = [
    "provider_occurrence_id", "creative_url_hash", "provider_code", "country_iso_2_code",
    "source_channel", "provider_dma_city_name", "publisher_id", "capture_date",
    "capture_timestamp",
]
GROUP = [
    "creative_id", "creative_url_hash", "country_iso_2_code", "market_id", "media_id",
    "media_property_id",
]


def summary_candidates(
    events: DataFrame, buffer: DataFrame, registry: DataFrame, chaff: DataFrame, dims: Dims
) -> DataFrame:
    """New and parked events, each once, with creative, market and property where known.

    Equal deliveries need no separate de-duplication: the pick per event id covers them.
    """
    fresh = events.withColumn("provider_dma_city_name", city_key_of(rules.CITY_STRICT))
    both = fresh.select(BUFFER_COLUMNS).unionByName(buffer.select(BUFFER_COLUMNS))
    # a total order over all columns, so that the kept row does not depend on arrival
    ties = [F.desc_nulls_last(c) for c in ("capture_timestamp", "creative_url_hash",
                                          "publisher_id", "source_channel",
                                          "provider_dma_city_name", "country_iso_2_code")]
    one = latest_per_key(both, BUFFER_KEY, "capture_date", *ties)
    kept = one.join(chaff.select("creative_url_hash"), "creative_url_hash", "left_anti")
    enriched = enrich_media_market(
        kept, dims, city_key=F.col("provider_dma_city_name"), require_channel=False
    )
    ids = registry.select("creative_url_hash", "creative_id")
    placed = constant_lookup(
        enriched.join(ids, "creative_url_hash", "left"),
        dims.media, "media_id", C.DIGITAL_MEDIA_ID, "_digital",
    )
    return placed.withColumn(
        "media_id", rules.media_id(F.col("provider_code"), F.col("_digital"))
    ).select(
        *BUFFER_COLUMNS, "creative_id", "market_id", "media_id", "media_property_id"
    )


def daily_counts(candidates: DataFrame) -> DataFrame:
    """Counts per group and day over resolved rows."""
    resolved = candidates.filter(
        F.col("creative_id").isNotNull() & F.col("media_property_id").isNotNull()
    )
    return resolved.groupBy(*GROUP, "capture_date").agg(
        F.min("capture_timestamp").alias("min_capture_timestamp"),
        F.max("capture_timestamp").alias("max_capture_timestamp"),
        F.count(F.lit(1)).alias("occ_cnt"),
    )


def updated_summary(summary: DataFrame, daily: DataFrame) -> DataFrame:
    """Summary with a batch of daily counts added.

    The first-days count only sees the new batch, against the group's first run including it.
    """
    delta = daily.select(
        *GROUP,
        F.col("occ_cnt").alias("occurrence_count"),
        F.col("min_capture_timestamp").alias("first_run"),
        F.col("max_capture_timestamp").alias("last_run"),
        F.lit(0).cast("bigint").alias("seven_days_occ_count"),
    )
    totals = accumulate(
        summary,
        delta,
        GROUP,
        add=["occurrence_count", "seven_days_occ_count"],
        low=["first_run"],
        high=["last_run"],
    )
    early = count_first_days(
        daily, totals.select(*GROUP, "first_run"), GROUP,
        day="capture_date", first_ts="first_run", days=7, add="occ_cnt",
    )
    return merge(
        totals,
        early,
        GROUP,
        values={
            "seven_days_occ_count": lambda t, s: t("seven_days_occ_count") + s("occ_cnt")
        },
        update=[],
        insert=False,
        null_safe=True,
    )


def summary_state(spark: SparkSession, path: str, like: DataFrame, buckets: int = 256) -> BucketedState:
    """A kept summary: one row per group, by hash buckets."""
    schema = ", ".join(f"{name} {kind}" for name, kind in like.dtypes)
    return BucketedState(spark, path, GROUP, schema, buckets)


def fold_summary(state: BucketedState, daily: DataFrame, batch: int) -> list[int]:
    """Add a batch of daily counts to a kept summary; returns the buckets that were rewritten.

    A batch that is run again under its number changes nothing.
    """
    return state.apply(daily, updated_summary, batch)


@dataclass(frozen=True)
class Summary:
    candidates: DataFrame
    daily: DataFrame
    summary: DataFrame
    buffer: DataFrame


def occurrence_summary(
    events: DataFrame,
    buffer: DataFrame,
    summary: DataFrame,
    registry: DataFrame,
    chaff: DataFrame,
    dims: Dims,
) -> Summary:
    """Counts for new and released events; unresolved events wait in the buffer.

    The summary is computed over all of its rows. For one that is kept, apply ``daily`` by
    :func:`fold_summary`, which rewrites touched buckets alone and applies a batch once.
    """
    # stored, because the counts and the buffer both read them
    candidates = materialize(
        summary_candidates(events, buffer, registry, chaff, dims), "summary-candidates"
    )
    daily = materialize(daily_counts(candidates), "daily-counts")
    resolved: Column = F.col("creative_id").isNotNull()
    return Summary(
        candidates=candidates,
        daily=daily,
        summary=updated_summary(summary, daily),
        buffer=park_release(buffer, candidates, BUFFER_KEY, resolved, ~resolved),
    )
