"""Raw occurrences to gold events, with a buffer for events whose creative is not ready."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import jsons, keys, nested, rules, text
from sightline.operators.ids import assign_dense_ids
from sightline.operators.joins import membership
from sightline.operators.merge import absent_rows, merge, park_release, update_by_keys
from sightline.operators.picks import first_per_key, latest_per_key
from sightline.plans.enrich import (
    Dims,
    active,
    enrich_media_market,
    property_company_view,
)
from sightline.plans.families import mapped
from sightline.session import discard, materialize

EVENT_KEY = ["country_iso_2_code", "provider_occurrence_id"]
GOLD_KEY = ["country_iso_2_code", "capture_date", "capture_month", "provider_occurrence_id"]
CAMPAIGN = [
    "provider_campaign_product_id", "provider_campaign_product_name", "provider_campaign_id",
    "provider_campaign_name", "provider_campaign_advertiser_id",
    "provider_campaign_advertiser_name", "provider_campaign_landing_page",
]


def new_events(changes: DataFrame) -> DataFrame:
    """Scoped changes, latest row per (country, provider, event id)."""
    scoped = changes.filter(rules.in_scope(F.col("country_iso_2_code"), F.col("retransmit")))
    return latest_per_key(
        scoped,
        ["country_iso_2_code", "provider_code", "provider_occurrence_id"],
        "capture_timestamp",
        F.desc_nulls_last("creative_url_hash"),
        F.desc_nulls_last("created_timestamp"),
    )


# ---- deployment chains ---------------------------------------------------------------------


def deployment_chains(events: DataFrame) -> DataFrame:
    """Distinct chains with both text forms and their key. Only distinct chains are parsed."""
    chains = events.select("purchase_method_id", "daisy_chain").distinct()
    parsed = chains.filter(F.col("daisy_chain").isNotNull()).withColumns(
        {
            "daisy_chain_transformed_1": nested.chain_with_roles(F.col("daisy_chain")),
            "daisy_chain_transformed_2": nested.chain_path(F.col("daisy_chain")),
        }
    )
    path = F.col("daisy_chain_transformed_2")
    return parsed.filter(F.coalesce(path, F.lit("")) != "").withColumn(
        "md5_hashcode", keys.md5_key(F.col("purchase_method_id"), path)
    )


def new_chains(stored: DataFrame, chains: DataFrame, now: Column) -> DataFrame:
    """Chains whose key is not stored yet, one per key, with a stable id."""
    rows = chains.select(
        keys.stable_id(F.col("md5_hashcode")).alias("deployment_chain_id"),
        "daisy_chain",
        "daisy_chain_transformed_1",
        "daisy_chain_transformed_2",
        F.col("purchase_method_id").cast("smallint").alias("purchase_method_id"),
        F.col("md5_hashcode").alias("purchase_method_daisy_chain_2_md5_hashcode"),
        now.alias("created_timestamp"),
    )
    key = "purchase_method_daisy_chain_2_md5_hashcode"
    return absent_rows(stored, first_per_key(rows, [key], [F.asc("daisy_chain")]), [key])


def chain_members(events: DataFrame, id: str, name: str) -> DataFrame:
    """Distinct (id, name) pairs of chain elements, one name per id."""
    chains = events.select("daisy_chain").filter(F.col("daisy_chain").isNotNull()).distinct()
    element = F.explode(jsons.parsed(F.col("daisy_chain"), jsons.CHAIN)).alias("e")
    pairs = chains.select(element).select(F.col(f"e.{id}").alias("id"), F.col(f"e.{name}").alias("name"))
    return pairs.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("name").alias("name"))


def new_roles(stored: DataFrame, events: DataFrame) -> DataFrame:
    rows = chain_members(events, "roleId", "role").toDF("role_id", "role_name")
    return absent_rows(stored, rows, ["role_id"])


def new_mediators(stored: DataFrame, events: DataFrame) -> DataFrame:
    rows = chain_members(events, "id", "mediator").toDF("mediator_id", "mediator_name")
    return absent_rows(stored, rows, ["mediator_id"])


# ---- combine -------------------------------------------------------------------------------

REGION = [
    "region_city_id", "region_city_name", "region_country_code", "region_dma_id",
    "region_dma_name", "region_state_id", "region_state_name",
]

# --- fixed values: extra keys of social rows and where they are in the raw JSON ---
SOCIAL_KEYS = {
    "MAIN_ADVERTISER_CATEGORY": "$.mainAdvertiserCategory",
    "SECOND_ADVERTISER_CATEGORY": "$.secondAdvertiserCategory",
    "OCCURRENCE_SOCIAL_PAGE_LINK": "$.occurrence.socialPageLink",
    "OCCURRENCE_SOCIAL_PAGE_NAME": "$.occurrence.socialPageName",
    "OCCURRENCE_SOCIAL_CAMPAIGN_TEXT": "$.occurrence.socialCampaignText",
    "OCCURRENCE_CREATIVEURL": "$.occurrence.creativeUrl",
    "FIRST_SEEN_DATE": "$.occurrence.creative.firstSeenDate",
}


def region_json() -> Column:
    """Region of an event as JSON; social rows have more keys and 'NA' for missing values."""
    missing = F.lit("NA")
    social = {c: F.coalesce(F.col(c).cast("string"), missing) for c in REGION} | {
        k: F.coalesce(jsons.text_at(F.col("raw_json"), path), missing)
        for k, path in SOCIAL_KEYS.items()
    }
    plain = {c: F.col(c) for c in REGION}
    is_social = F.col("provider_code") == C.PROVIDER_SOCIAL
    return F.when(is_social, jsons.object_typed(social)).otherwise(jsons.object_typed(plain))


def compact_events(changes: DataFrame) -> DataFrame:
    """Only the columns gold needs, with the region JSON in place of the raw JSON.

    Run before the first shuffle: the raw JSON is most of an event's bytes.
    """
    return changes.select(
        "country_iso_2_code", "provider_code", "source_channel", "provider_occurrence_id",
        "provider_creative_id", "creative_url_hash", "capture_date", "capture_month",
        "capture_timestamp", "created_timestamp", "retransmit", "publisher_id",
        "purchase_method_id", *CAMPAIGN, "daisy_chain", "ad_insertion_point",
        region_json().alias("provider_raw_json"),
    )


#: what is only carried along: no join or pick between the pick per event and gold reads it
PAYLOAD = [
    "provider_occurrence_id", "provider_creative_id", "capture_date", "capture_month", "purchase_method_id", *CAMPAIGN,
    "provider_campaign_landing_page_domain", "ad_insertion_point", "provider_raw_json", "daisy_chain",
]
#: the key of an event without NULLs, so that its payload is joined on the key it lies by
ROW_KEY = ["_country", "_occurrence"]


def picked_events(fresh: DataFrame, held: DataFrame) -> DataFrame:
    """New and held events, one row per event, the held copy first, with place key and chain key.

    Both keys are read from the payload before the pick, and the order of the pick ends in a hash of the
    whole row, so that a frame without the payload picks the same rows.
    """
    if "provider_raw_json" not in fresh.columns:
        fresh = compact_events(fresh)
    new_side = fresh.select(
        F.lit(C.SOURCE_NEW).alias("source_flag"),
        "creative_url_hash", "country_iso_2_code", "provider_code", "source_channel",
        "provider_occurrence_id", "provider_creative_id", "capture_date", "capture_month",
        "capture_timestamp", F.lit(None).cast("int").alias("held_property_id"),
        "purchase_method_id", *CAMPAIGN,
        text.url_host(F.col("provider_campaign_landing_page")).alias(
            "provider_campaign_landing_page_domain"
        ),
        "ad_insertion_point", "provider_raw_json", "daisy_chain", "publisher_id",
    )
    held_side = held.select(
        F.lit(C.SOURCE_HELD).alias("source_flag"),
        F.col("provider_creative_url_hash").alias("creative_url_hash"), "country_iso_2_code",
        "provider_code", "source_channel", "provider_occurrence_id", "provider_creative_id",
        "capture_date", "capture_month", "capture_timestamp",
        F.col("media_property_id").cast("int").alias("held_property_id"),
        "purchase_method_id", *CAMPAIGN, "provider_campaign_landing_page_domain",
        "ad_insertion_point", "provider_raw_json", "daisy_chain",
        F.lit(None).cast("bigint").alias("publisher_id"),
    )
    both = new_side.unionByName(held_side)
    raw = F.col("provider_raw_json")
    city = rules.city_key(
        F.col("provider_code"),
        jsons.text_at(raw, "$.region_dma_name"),
        jsons.text_at(raw, "$.region_city_name"),
        jsons.text_at(raw, "$.region_state_name"),
        rules.CITY_BY_DMA,
    )
    marked = both.withColumns(
        {
            "_city": city,
            "chain_md5": nested.chain_key(
                F.col("purchase_method_id"), nested.chain_path(F.col("daisy_chain"))
            ),
            "_tie": F.xxhash64(*both.columns),
            **{
                key: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
                for key, c in zip(ROW_KEY, EVENT_KEY, strict=True)
            },
        }
    )
    return first_per_key(
        marked,
        ROW_KEY,
        [F.desc("source_flag"), F.asc("capture_timestamp"), F.asc("provider_code"),
         F.asc_nulls_last("creative_url_hash"), F.asc("_tie")],
    ).drop("_tie")


def looked_up(picked: DataFrame, dedupe_map: DataFrame, dims: Dims) -> DataFrame:
    """Picked events with parent, property and market."""
    parents = mapped(dedupe_map).filter(F.col("parent_creative_id").isNotNull()).select(
        F.col("child_creative_url_hash").alias("creative_url_hash"), "parent_creative_url_hash"
    )
    # the parent comes last: the advert is looked up next, by the same key
    enriched = enrich_media_market(picked, dims, city_key=F.col("_city")).join(parents, "creative_url_hash", "left")
    is_held = F.col("source_flag") == C.SOURCE_HELD
    return enriched.withColumn(
        "media_property_id",
        F.when(is_held, F.col("held_property_id")).otherwise(F.col("media_property_id")),
    ).drop("held_property_id", "_city")


def with_chain_roles(events: DataFrame) -> DataFrame:
    return events.withColumn("mediator_chain", nested.chain_with_roles(F.col("daisy_chain")))


def combine_events(
    fresh: DataFrame, held: DataFrame, dedupe_map: DataFrame, dims: Dims
) -> DataFrame:
    """New and held events, the held copy first, with chain key, parent, property and market."""
    picked = with_chain_roles(picked_events(fresh, held)).drop(*ROW_KEY)
    return looked_up(picked, dedupe_map, dims)


# ---- gate ----------------------------------------------------------------------------------


def subjects(creatives: DataFrame, dedupe_map: DataFrame) -> DataFrame:
    """Per creative hash: the advert an event of it belongs to, and whether it is one itself.

    A mapped creative's advert is its parent, any other's is itself. The tables joined here
    are of the size of the creatives, so that the far larger events need only one join, on the
    same key that already brought them their parent.
    """
    adverts = creatives.filter(F.col("classification_type") == C.ADVERT)
    fields = [
        F.col("creative_url_hash").alias("_subject"),
        "creative_id",
        "primary_product_id",
        "classification_type",
        F.col("creative_mime_type").alias("_mime"),
    ]
    links = mapped(dedupe_map).filter(F.col("parent_creative_id").isNotNull()).select(
        F.col("child_creative_url_hash").alias("creative_url_hash"),
        F.col("parent_creative_url_hash").alias("_parent"),
    ).distinct()
    children = membership(
        links, adverts, {"creative_url_hash": "creative_url_hash"}, "_own_is_advert"
    ).withColumn("_target", F.coalesce("_parent", "creative_url_hash"))
    of_children = children.join(
        adverts.select(*fields), F.col("_target") == F.col("_subject"), "left"
    ).drop("_target")
    alone = adverts.join(links, "creative_url_hash", "left_anti").select(
        "creative_url_hash",
        F.lit(None).cast("bigint").alias("_parent"),
        F.lit(True).alias("_own_is_advert"),
        *fields,
    )
    return of_children.unionByName(alone)


def gate_events(
    combined: DataFrame,
    creatives: DataFrame,
    dedupe_map: DataFrame,
    chains: DataFrame,
    dims: Dims,
    run_key: Column,
    key: Sequence[str] = tuple(EVENT_KEY),
) -> DataFrame:
    """Combined events with hold flag, delete flag and house-ad flag, one row per event (``key``)."""
    products = dims.product
    first = products.select(
        F.col("product_id").alias("primary_product_id"), F.col("current_product_id").alias("_cur"),
        F.col("parent_id").alias("_p1"), F.col("subsidiary_id").alias("_s1"),
    )
    current = products.select(
        F.col("product_id").alias("_cur"), F.col("parent_id").alias("_p2"),
        F.col("subsidiary_id").alias("_s2"),
    )
    # an advert's product is looked up per creative, not per event
    lookup = (
        subjects(creatives, dedupe_map)
        .withColumnRenamed("creative_url_hash", "_own")
        .join(first, "primary_product_id", "left")
        .join(current, "_cur", "left")
    )
    seen = combined.join(lookup, F.col("creative_url_hash") == F.col("_own"), "left").filter(
        # an event row belongs to one of its creative's parents
        F.col("_own").isNull() | F.col("parent_creative_url_hash").eqNullSafe(F.col("_parent"))
    )
    origins = active(dims.origin).select(
        F.lower("origin_channel_name").alias("source_channel"), "origin_channel_id"
    )
    # chains are only kept for web and social events
    links = chains.select(
        F.col("purchase_method_daisy_chain_2_md5_hashcode").alias("_chain"),
        F.col("deployment_chain_id").alias("_chain_id"),
    )
    with_chain = F.col("provider_code").isin(C.PROVIDER_WEB, C.PROVIDER_SOCIAL) & (
        F.col("chain_md5") == F.col("_chain")
    )
    companies = property_company_view(dims).select(
        F.col("legacy_media_property_id").alias("media_property_id"), "source_channel_id",
        "vx0_parent_company_id",
    )
    joined = (
        seen.join(origins, "source_channel", "left")
        .join(links, with_chain, "left")
        .join(companies, ["media_property_id", "source_channel_id"], "left")
    ).filter(rules.passes_video_guard(F.col("source_channel"), F.col("_mime")))
    subject = F.col("_subject")
    parent_ready = (subject == F.col("parent_creative_url_hash")) & F.col("_own_is_advert")
    own_ready = subject == F.col("creative_url_hash")
    has_product = F.coalesce("primary_product_id", F.lit(-1)) != -1
    # the stricter rules with a known chain are special cases of these two
    ready = has_product & (parent_ready | own_ready)
    rejected = F.col("classification_type").isin(C.NON_AD, C.BAD_AD)
    owner = F.col("vx0_parent_company_id")
    house = (owner == F.coalesce("_p2", "_p1")) | (owner == F.coalesce("_s2", "_s1"))
    flagged = joined.withColumns(
        {
            "deployment_chain_id": F.coalesce("_chain_id", F.lit(-1).cast("bigint")),
            "delete_flag": (F.col("provider_code") != C.PROVIDER_SOCIAL)
            & F.coalesce(rejected, F.lit(False)),
            "occurrence_hold_flag": F.when(F.coalesce(ready, F.lit(False)), C.NOT_HOLD).otherwise(
                C.HOLD
            ),
            "is_house_ad": F.coalesce(house, F.lit(False)),
            "job_log_key": run_key,
        }
    ).drop(
        "_own", "_parent", "_subject", "_own_is_advert", "_mime", "_chain", "_chain_id", "_cur",
        "_p1", "_s1", "_p2", "_s2",
    )
    return latest_per_key(
        flagged,
        key,
        "capture_timestamp",
        F.asc_nulls_last("creative_id"),
        F.asc_nulls_last("media_property_id"),
        F.asc_nulls_last("market_id"),
        F.desc("is_house_ad"),
    )


# ---- gold ----------------------------------------------------------------------------------


def with_spend(events: DataFrame, dims: Dims) -> DataFrame:
    """Estimates by property, else by channel."""
    by_property = dims.spend_by_property.select(
        "media_property_id", F.col("average_impressions").alias("_pi"),
        F.col("average_spend").alias("_ps"),
    )
    by_channel = dims.spend_by_channel.select(
        "source_channel_id", F.col("average_impressions").alias("_ci"),
        F.col("average_spend").alias("_cs"),
    )
    return (
        events.join(by_property, "media_property_id", "left")
        .join(by_channel, "source_channel_id", "left")
        .withColumns(
            {
                # a fraction is rounded, not cut
                "prelim_impressions": F.round(F.coalesce("_pi", "_ci")).cast("bigint"),
                "prelim_spend": F.coalesce("_ps", "_cs").cast("double"),
            }
        )
        .drop("_pi", "_ps", "_ci", "_cs")
    )


def gold_candidates(classified: DataFrame, dims: Dims, next_id: int, now: Column) -> DataFrame:
    """Released events with estimates and ids, in gold form (38 columns)."""
    ready = classified.filter(F.col("occurrence_hold_flag") == C.NOT_HOLD)
    numbered = assign_dense_ids(
        with_spend(ready, dims),
        ["capture_timestamp", "provider_occurrence_id", "country_iso_2_code"],
        next_id,
        "occurrence_id",
    )
    c = F.col
    return numbered.select(
        "occurrence_id", "country_iso_2_code", "provider_code",
        c("source_channel_id").cast("int"), "creative_id", "provider_occurrence_id",
        c("parent_creative_url_hash").alias("provider_parent_creative_url_hash"),
        c("provider_creative_id").alias("provider_original_creative_id"),
        c("creative_url_hash").alias("provider_original_creative_url_hash"),
        "capture_date", "capture_month", "capture_timestamp",
        now.alias("created_timestamp"), now.alias("updated_timestamp"),
        c("media_property_id").cast("int"), c("market_id").cast("smallint"),
        c("purchase_method_id").cast("smallint"), "deployment_chain_id", "mediator_chain",
        c("origin_channel_id").cast("smallint"), "prelim_impressions", "prelim_spend",
        F.lit(None).cast("bigint").alias("final_impressions"),
        F.lit(None).cast("double").alias("final_spend"),
        "delete_flag", "is_house_ad", F.lit(None).cast("bigint").alias("historical_creative_id"),
        *CAMPAIGN, "provider_campaign_landing_page_domain", "provider_raw_json",
        "ad_insertion_point", "job_log_key",
    )


HELD_COLUMNS = [
    "provider_occurrence_id", "country_iso_2_code", "provider_code", "source_channel",
    "provider_creative_id", "provider_creative_url_hash", "capture_date", "capture_month",
    "capture_timestamp", "media_property_id", "purchase_method_id", "daisy_chain", *CAMPAIGN,
    "provider_campaign_landing_page_domain", "ad_insertion_point", "job_log_key",
    "provider_raw_json",
]


def next_buffer(buffer: DataFrame, classified: DataFrame) -> DataFrame:
    """Buffer after the run: released held events leave, new unresolved events enter."""
    rows = classified.withColumn("provider_creative_url_hash", F.col("creative_url_hash"))
    flag, source = F.col("occurrence_hold_flag"), F.col("source_flag")
    return park_release(
        buffer,
        rows,
        GOLD_KEY,
        (flag == C.NOT_HOLD) & (source == C.SOURCE_HELD),
        (flag == C.HOLD) & (source == C.SOURCE_NEW),
    )


@dataclass(frozen=True)
class GoldRun:
    inserts: DataFrame
    buffer: DataFrame
    chains: DataFrame
    classified: DataFrame


def gold_events(
    changes: DataFrame,
    buffer: DataFrame,
    gold: DataFrame,
    creatives: DataFrame,
    dedupe_map: DataFrame,
    chains: DataFrame,
    dims: Dims,
    *,
    next_id: int,
    now: Column,
    run_key: Column,
) -> GoldRun:
    """One run from raw changes to gold inserts and the next buffer.

    Gold is insert-only here, so a run appends ``inserts`` and never rewrites stored events.
    """
    # the changes, the new chains and the gated events are each read more than once
    fresh = materialize(new_events(compact_events(changes)), "new-events")
    added = materialize(new_chains(chains, deployment_chains(fresh), now), "chains")
    known = chains.unionByName(added, allowMissingColumns=True)
    # lookups and the gate shuffle an event's keys only; its payload is shuffled once and joined at the end
    picked = picked_events(fresh, buffer)
    slim = looked_up(picked.drop(*PAYLOAD), dedupe_map, dims)
    gated = gate_events(slim, creatives, dedupe_map, known, dims, run_key, ROW_KEY)
    payload = with_chain_roles(picked.select(*ROW_KEY, *PAYLOAD))
    classified = materialize(gated.join(payload, ROW_KEY).drop(*ROW_KEY), "classified")
    candidates = gold_candidates(classified, dims, next_id, now)
    return GoldRun(
        inserts=absent_rows(gold, candidates, GOLD_KEY),
        buffer=next_buffer(buffer, classified),
        chains=added,
        classified=classified,
    )


# ---- reaction to creative changes ----------------------------------------------------------


def newest_creatives(creatives: DataFrame, since: Column) -> DataFrame:
    """Changed creatives, the newest row per (hash, country)."""
    changed = creatives.filter(F.col("updated_timestamp") > since)
    return latest_per_key(
        changed, ["creative_url_hash", "country_iso_2_code"], "updated_timestamp",
        F.asc("creative_id"),
    )


def reparented(gold: DataFrame, changed: DataFrame, dedupe_map: DataFrame) -> DataFrame:
    """(event, new creative, new parent hash) for events whose creative must change.

    Adverts that now map to a parent move to it; creatives without a mapping get their events
    back.
    """
    events = gold.select(
        "occurrence_id", F.col("creative_id").alias("event_creative_id"),
        F.col("provider_original_creative_url_hash").alias("creative_url_hash"),
    )
    links = dedupe_map.select(
        F.col("child_creative_url_hash").alias("creative_url_hash"), "match_type",
        "parent_creative_id", "parent_creative_url_hash",
    )
    mine = changed.select("creative_id", "creative_url_hash", "classification_type")
    to_parent = (
        mine.filter(F.col("classification_type") == C.ADVERT)
        .join(links.filter(F.col("match_type") == C.MATCH_TYPE_MAP), "creative_url_hash")
        .filter(F.col("parent_creative_id").isNotNull())
        .join(events, "creative_url_hash")
        .filter(F.col("parent_creative_id") != F.col("event_creative_id"))
        .select(
            "occurrence_id", F.col("parent_creative_id").alias("creative_id"),
            F.col("parent_creative_url_hash").alias("provider_parent_creative_url_hash"),
        )
    )
    to_self = (
        mine.join(links, "creative_url_hash", "left")
        .filter(F.coalesce("match_type", F.lit("")) != C.MATCH_TYPE_MAP)
        .join(events, "creative_url_hash")
        .filter(F.col("creative_id") != F.col("event_creative_id"))
        .select(
            "occurrence_id", "creative_id",
            F.lit(None).cast("bigint").alias("provider_parent_creative_url_hash"),
        )
    )
    return to_parent.unionByName(to_self).distinct()


def apply_reparent(gold: DataFrame, moves: DataFrame, now: Column) -> DataFrame:
    return merge(
        gold, moves.withColumn("updated_timestamp", now), ["occurrence_id"], insert=False
    )


def set_delete_flag(gold: DataFrame, changed: DataFrame, now: Column) -> DataFrame:
    """Flag live events of creatives that turned out to be no adverts."""
    rejected = changed.filter(F.col("classification_type").isin(C.NON_AD, C.BAD_AD))
    return update_by_keys(
        gold,
        rejected,
        ["creative_id"],
        {"delete_flag": F.lit(True), "updated_timestamp": now},
        ~F.col("delete_flag"),
    )


def touched_months(
    gold: DataFrame, changed: DataFrame, moves: DataFrame, month: str = "capture_month"
) -> DataFrame:
    """Months with an event that moves or is flagged; reads only key columns of gold."""
    keys = gold.select("occurrence_id", "creative_id", "delete_flag", month)
    rejected = changed.filter(F.col("classification_type").isin(C.NON_AD, C.BAD_AD))
    moved = keys.join(moves.select("occurrence_id"), "occurrence_id", "left_semi")
    live = keys.filter(~F.col("delete_flag"))
    flagged = live.join(rejected.select("creative_id"), "creative_id", "left_semi")
    return moved.select(month).union(flagged.select(month)).distinct()


def rewrite_months(
    path: str, months: DataFrame, change: Callable[[DataFrame], DataFrame], month: str = "capture_month"
) -> int:
    """Apply ``change`` to the rows of the listed months of a table partitioned by month, and write these
    months alone. Returns how many.

    The new months are written to the shared folder first, so a lost executor never reads what is being
    replaced.
    """
    spark = months.sparkSession
    months = materialize(months.select(month).distinct(), "months")
    count = months.count()
    if count:
        gold = spark.read.parquet(path)
        part = gold.join(months, month, "left_semi").select(gold.columns)
        fresh = materialize(change(part), "reacted")
        writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(month).parquet(path)
        discard(fresh)
    discard(months)
    return count


def reparent_in_place(
    path: str, creatives: DataFrame, dedupe_map: DataFrame, since: Column, now: Column, month: str = "capture_month"
) -> int:
    """:func:`apply_reparent` on a table partitioned by month; rewrites months with an event that moves."""
    gold = creatives.sparkSession.read.parquet(path)
    moves = materialize(reparented(gold, newest_creatives(creatives, since), dedupe_map), "moves")
    months = gold.select("occurrence_id", month).join(moves.select("occurrence_id"), "occurrence_id", "left_semi")
    count = rewrite_months(path, months, lambda part: apply_reparent(part, moves, now), month)
    discard(moves)
    return count


def flag_in_place(path: str, creatives: DataFrame, since: Column, now: Column, month: str = "capture_month") -> int:
    """:func:`set_delete_flag` on a table partitioned by month; rewrites months with an event to flag."""
    gold = creatives.sparkSession.read.parquet(path)
    changed = materialize(newest_creatives(creatives, since), "changed")
    months = touched_months(gold, changed, gold.select("occurrence_id").limit(0), month)
    count = rewrite_months(path, months, lambda part: set_delete_flag(part, changed, now), month)
    discard(changed)
    return count


def react_in_place(
    path: str, creatives: DataFrame, dedupe_map: DataFrame, since: Column, now: Column,
    month: str = "capture_month",
) -> int:
    """As :func:`react_to_creatives` on a table partitioned by month; rewrites only touched months.

    Gold is read by its key columns to find the moves and the months, and then in whole only in
    those months. A repeated reaction gives the same rows. Returns the number of months written.
    """
    gold = creatives.sparkSession.read.parquet(path)
    changed = materialize(newest_creatives(creatives, since), "changed")
    moves = materialize(reparented(gold, changed, dedupe_map), "moves")
    months = touched_months(gold, changed, moves, month)
    count = rewrite_months(path, months, lambda part: set_delete_flag(apply_reparent(part, moves, now), changed, now), month)
    discard(changed, moves)
    return count


def react_to_creatives(
    gold: DataFrame, creatives: DataFrame, dedupe_map: DataFrame, since: Column, now: Column
) -> DataFrame:
    """Gold events after creative changes: re-parented first, then flagged."""
    changed = newest_creatives(creatives, since)
    moved = apply_reparent(gold, reparented(gold, changed, dedupe_map), now)
    return set_delete_flag(moved, changed, now)
