"""New creatives from raw occurrences: candidate, scoring, staging, first seen."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import constants as C
from sightline.functions import jsons, rules, text, times
from sightline.operators.ids import assign_dense_ids
from sightline.operators.joins import near_size_join
from sightline.operators.merge import absent_rows, insert_only, merge, update_by_keys
from sightline.operators.picks import earliest_per_key, first_per_key
from sightline.plans.enrich import Dims, active, city_key_of, enrich_media_market
from sightline.session import materialize

HASH = "creative_url_hash"


def scoped(events: DataFrame) -> DataFrame:
    return events.filter(
        rules.in_scope(F.col("country_iso_2_code"), F.col("retransmit"))
        & F.col("creative_url").isNotNull()
    )


def first_events(events: DataFrame) -> DataFrame:
    """Earliest scoped event of each creative."""
    return earliest_per_key(
        scoped(events), [HASH], "capture_timestamp", F.asc("provider_occurrence_id")
    )


def new_creatives(events: DataFrame, registry: DataFrame, chaff: DataFrame, dims: Dims) -> DataFrame:
    """First event of each creative that is neither staged nor rejected, enriched.

    The pick and both anti joins come before the lookups, so only one row per new creative is
    enriched.
    """
    staged = registry.filter("is_staged").select(HASH)
    fresh = (
        first_events(events)
        .join(staged, HASH, "left_anti")
        .join(chaff.select(HASH), HASH, "left_anti")
    )
    social = F.col("provider_code") == C.PROVIDER_SOCIAL
    declared = jsons.text_at(F.col("raw_json"), "$.occurrence.creativeUrl")
    shaped = fresh.withColumns(
        {
            "creative_mime_type": rules.normalize_mime(
                F.col("source_channel"), F.col("creative_mime_type"), F.col("creative_url")
            ),
            "provider_campaign_description": F.when(
                social, F.coalesce("provider_campaign_description", F.lit(""))
            ).otherwise(F.col("provider_campaign_description")),
            "occurrence_creative_url": text.valid_url(declared),
            "attribution_status": F.when(social, F.lit("NA")),
            "social_campaign_text": F.when(
                social,
                F.coalesce(
                    jsons.text_at(F.col("raw_json"), "$.occurrence.socialCampaignText"), F.lit("")
                ),
            ),
        }
    )
    enriched = enrich_media_market(
        shaped, dims, city_key=city_key_of(rules.CITY_STRICT), mime=True
    ).withColumn("occurrence_creative_url_domain", text.url_host(F.col("occurrence_creative_url")))
    # a creative may match several properties or markets: keep one row
    one = earliest_per_key(
        enriched,
        [HASH],
        "capture_timestamp",
        F.asc_nulls_last("media_property_id"),
        F.asc_nulls_last("market_id"),
        F.asc_nulls_last("mime_type_id"),
    )
    return one.select(
        "country_iso_2_code", "provider_code", "source_channel", "provider_creative_id",
        "capture_month", "capture_timestamp", "creative_type", "mime_type_id",
        "media_property_id", "publisher_domain", "creative_width", "creative_height",
        "creative_duration", "creative_url", HASH, "provider_occurrence_id",
        "media_property_name", "media_category_id", "media_category_code",
        F.col("occurrence_link_url").alias("provider_creative_link_url"),
        F.col("publisher_id").alias("provider_publisher_id"),
        F.col("publisher_domain").alias("provider_publisher_domain"),
        "provider_campaign_id", "provider_campaign_name", "provider_campaign_advertiser_id",
        "provider_campaign_advertiser_name", "provider_campaign_product_id",
        "provider_campaign_product_name", "occurrence_description", "attribution_status",
        "provider_campaign_description", "social_campaign_text", "created_timestamp",
        "source_channel_id", "market_id", "market_name", "occurrence_creative_url",
        "occurrence_creative_url_domain", "domain_url", "provider_campaign_landing_page",
    )


# ---- scoring -------------------------------------------------------------------------------


def standard_sizes(ad_size: DataFrame) -> DataFrame:
    """Active sizes of the country, one per (width, height): the last by name."""
    sizes = active(ad_size).filter(
        (F.col("country_iso_2_code") == C.COUNTRY_US) & (F.col("size_id") != C.SIZE_ID_EXCLUDED)
    )
    return first_per_key(
        sizes,
        ["size_width", "size_height", "country_iso_2_code"],
        [F.desc("size_name"), F.asc("size_id")],
    ).select("size_id", "size_name", "size_width", "size_height", "country_iso_2_code")


def known_servers(ad_server: DataFrame) -> DataFrame:
    hosts = active(ad_server).select(text.url_host(F.col("ad_server")).alias("ad_server"))
    return hosts.distinct()


def autochaff_scores(candidates: DataFrame, dims: Dims) -> DataFrame:
    """Scores of web candidates, one row per matching size."""
    web = candidates.filter(F.col("provider_code") == C.PROVIDER_WEB)
    sized = near_size_join(
        web,
        standard_sizes(dims.ad_size).withColumnRenamed("country_iso_2_code", "size_country"),
        width="creative_width",
        height="creative_height",
        size_width="size_width",
        size_height="size_height",
        tolerance=C.SIZE_TOLERANCE,
        equal=[("country_iso_2_code", "size_country")],
    )
    servers = known_servers(dims.ad_server)
    served = sized.join(
        servers, sized["occurrence_creative_url_domain"] == servers["ad_server"], "left"
    )
    described = F.coalesce("occurrence_description", F.lit("")) != ""
    same_host = text.contains(
        F.col("occurrence_description"), text.domain_chain(F.col("domain_url"))
    )
    type_score = F.lit(0)
    for kind, score in C.SCORE_TYPE.items():
        type_score = F.when(F.col("creative_type") == kind, score).otherwise(type_score)
    return served.select(
        HASH,
        "provider_code",
        "creative_type",
        "creative_duration",
        F.lit(0).alias("data_provider_code_score"),
        F.when(F.col("size_id").isNotNull(), C.SCORE_SIZE).otherwise(0).alias("ad_size_score"),
        type_score.alias("creative_type_score"),
        F.when(F.coalesce("ad_server", F.lit("")) != "", C.SCORE_SERVER)
        .otherwise(0)
        .alias("ad_server_score"),
        text.path_score(F.col("occurrence_description")).alias("href_score"),
        text.path_score(F.col("occurrence_creative_url")).alias("creative_url_score"),
        F.when(
            described,
            F.when(same_host, C.SCORE_CLICK_SAME_HOST).otherwise(C.SCORE_CLICK_OTHER_HOST),
        )
        .otherwise(0)
        .alias("click_through_score"),
    )


SCORES = [
    "data_provider_code_score", "ad_size_score", "creative_type_score", "ad_server_score",
    "href_score", "creative_url_score", "click_through_score",
]


def autochaff(candidates: DataFrame, dims: Dims) -> DataFrame:
    """Rejected web candidates, one row per creative."""
    total = sum((F.col(c) for c in SCORES[1:]), F.col(SCORES[0]))
    flagged = autochaff_scores(candidates, dims).withColumn(
        "is_auto_chaff",
        rules.is_chaff(
            F.col("creative_type"), F.col("provider_code"), F.col("creative_duration"), total
        ),
    )
    rejected = flagged.filter("is_auto_chaff")
    return first_per_key(
        rejected, [HASH], [F.desc(c) for c in SCORES] + [F.asc_nulls_last("creative_duration")]
    )


def exclude_autochaff(candidates: DataFrame, chaff: DataFrame) -> DataFrame:
    return candidates.join(chaff, [HASH, "provider_code"], "left_anti")


# ---- staging -------------------------------------------------------------------------------


def first_seen_metadata(*, social: bool) -> Column:
    """JSON text of the first event; every value is text and NULL values are kept."""
    c = F.col
    pairs = {
        "occurrence_id": c("provider_occurrence_id"),
        "occurrence_timestamp": times.timestamp_text(c("capture_timestamp")),
        "provider_code": c("provider_code"),
        "media_property_id": c("media_property_id"),
        "media_property_name": c("media_property_name"),
        "media_category_id": c("media_category_id"),
        "media_category_code": c("media_category_code"),
        "provider_creative_link_url": c("provider_creative_link_url"),
        "provider_publisher_id": c("provider_publisher_id"),
        "provider_publisher_domain": c("provider_publisher_domain"),
        "provider_campaign_id": c("provider_campaign_id"),
        "provider_campaign_name": c("provider_campaign_name"),
        "provider_advertiser_id": c("provider_campaign_advertiser_id"),
        "provider_advertiser_name": c("provider_campaign_advertiser_name"),
        "provider_product_id": c("provider_campaign_product_id"),
        "provider_product_name": c("provider_campaign_product_name"),
        "due_timestamp": times.timestamp_text(times.due_after_four_hours(c("capture_timestamp"))),
        "market_id": c("market_id"),
        "market_name": c("market_name"),
        "daypart_id": F.lit(None),
        "daypart_name": F.lit(None),
        "affiliate_id": F.lit(None),
        "affiliate_name": F.lit(None),
        "occurrence_description": c("occurrence_description"),
    }
    if social:
        pairs |= {
            "attribution_status": c("attribution_status"),
            "provider_campaign_description": c("provider_campaign_description"),
            "social_campaign_text": c("social_campaign_text"),
        }
    pairs |= {
        "provider_campaign_landing_page": c("provider_campaign_landing_page"),
        "adclarity_url": c("occurrence_creative_url"),
    }
    return jsons.object_keep_null(pairs)


def _staging_columns(*, social: bool, now: Column) -> list[Column]:
    is_social = F.col("provider_code") == C.PROVIDER_SOCIAL
    text_null = F.lit(None).cast("string")
    status = jsons.object_keep_null({"attribution_status": F.col("attribution_status")})
    c = F.col
    return [
        F.lit(None).cast("bigint").alias("legacy_creative_id"),
        *[
            c(n)
            for n in (
                "country_iso_2_code", "provider_code", "source_channel", "provider_creative_id",
                "capture_month", "capture_timestamp", "creative_type", "mime_type_id",
            )
        ],
        rules.media_id(c("provider_code"), F.lit(C.DIGITAL_MEDIA_ID)).alias("media_id"),
        *[
            c(n)
            for n in (
                "media_property_id", "publisher_domain", "creative_width", "creative_height",
                "creative_duration", "creative_url", HASH,
            )
        ],
        (F.when(is_social, status) if social else text_null).alias(
            "creative_machine_learning_response"
        ),
        text_null.alias("creative_url_override"),
        text_null.alias("creative_payload"),
        (F.when(is_social, F.lit("O")) if social else text_null).alias("record_status"),
        first_seen_metadata(social=social).alias("first_seen_metadata"),
        F.lit(None).cast("int").alias("suggested_vx0_product_id"),
        c("created_timestamp") if social else now.alias("created_timestamp"),
        now.alias("updated_timestamp"),
    ]


def autochaff_records(candidates: DataFrame, chaff: DataFrame, now: Column) -> DataFrame:
    """Records kept for rejected candidates."""
    rejected = candidates.join(chaff.filter("is_auto_chaff").select(HASH), HASH, "left_semi")
    return rejected.select(
        *_staging_columns(social=False, now=now), F.lit(None).cast("bigint").alias("creative_id")
    )


def stage_creatives(
    kept: DataFrame, registry: DataFrame, next_id: int, now: Column
) -> DataFrame:
    """Staging rows: new creatives get the next ids, unstaged known ones keep theirs."""
    known = registry.filter(~F.col("is_staged")).select(HASH, "creative_id")
    new = kept.join(registry.select(HASH), HASH, "left_anti")
    numbered = assign_dense_ids(new, ["created_timestamp", HASH], next_id, "creative_id")
    again = kept.join(known, HASH).select(numbered.columns)
    rows = numbered.unionByName(again)
    return rows.select(*_staging_columns(social=True, now=now), "creative_id")


def register_creatives(
    registry: DataFrame, staged: DataFrame, dims: Dims, now: Column
) -> DataFrame:
    """Registry with the new creatives added as not staged."""
    providers = active(dims.data_provider).select(
        F.col("data_provider_code").alias("provider_code"),
        F.col("data_provider_id").alias("first_seen_provider_id"),
    ).distinct()
    rows = staged.join(providers, "provider_code", "left").select(
        "creative_id",
        "provider_creative_id",
        F.col("creative_url").alias("provider_creative_url"),
        HASH,
        now.alias("created_timestamp"),
        F.lit(False).alias("is_staged"),
        F.col("media_id").alias("first_seen_media_id"),
        "first_seen_provider_id",
    )
    return insert_only(registry, rows, [HASH])


def mark_staged(registry: DataFrame, staged: DataFrame) -> DataFrame:
    return update_by_keys(
        registry, staged, [HASH], {"is_staged": F.lit(True)}, ~F.col("is_staged")
    )


def scored_candidates(
    events: DataFrame, registry: DataFrame, chaff: DataFrame, dims: Dims
) -> tuple[DataFrame, DataFrame]:
    """Stored candidates and stored rejects."""
    candidates = materialize(new_creatives(events, registry, chaff, dims), "candidates")
    return candidates, materialize(autochaff(candidates, dims), "rejected")


@dataclass(frozen=True)
class Push:
    """Results of one push run."""

    staged: DataFrame
    chaff: DataFrame
    registry: DataFrame


def push(
    events: DataFrame,
    registry: DataFrame,
    chaff: DataFrame,
    dims: Dims,
    next_id: int,
    now: Column,
) -> Push:
    """Candidate to registry in one go; the caller writes the three tables, then the mark.

    Candidates, rejects and staged rows are each stored once because several results read
    them: the events are scanned a single time.
    """
    candidates, rejected = scored_candidates(events, registry, chaff, dims)
    kept = exclude_autochaff(candidates, rejected)
    staged = materialize(stage_creatives(kept, registry, next_id, now), "staged")
    records = autochaff_records(candidates, rejected, now)
    return Push(
        staged=staged,
        chaff=absent_rows(chaff, records, [HASH]),
        registry=mark_staged(register_creatives(registry, staged, dims, now), staged),
    )


# ---- first seen ----------------------------------------------------------------------------

_METADATA_TYPES = {
    "occurrence_id": "string", "occurrence_timestamp": "timestamp",
    "media_property_name": "string", "media_category_id": "int", "media_category_code": "string",
    "provider_creative_link_url": "string", "provider_publisher_id": "int",
    "provider_publisher_domain": "string", "provider_campaign_id": "int",
    "provider_campaign_name": "string", "provider_advertiser_id": "int",
    "provider_advertiser_name": "string", "provider_product_id": "int",
    "provider_product_name": "string", "due_timestamp": "timestamp", "market_id": "int",
    "market_name": "string", "daypart_id": "int", "daypart_name": "string",
    "affiliate_id": "int", "affiliate_name": "string", "provider_campaign_landing_page": "string",
}


def seed_first_seen(
    target: DataFrame | None, staged: DataFrame, dims: Dims, now: Column
) -> DataFrame:
    """First-seen rows unpacked from the staged metadata, for creatives that have none."""
    ddl = "struct<" + ",".join(f"{k}:string" for k in _METADATA_TYPES) + ">"
    # the metadata is JSON text, so a NUL character appears as its escape
    clean = F.replace(F.col("first_seen_metadata"), F.lit("\\u0000"), F.lit(""))
    providers = dims.data_provider.select(
        F.col("data_provider_code").alias("provider_code"),
        F.col("data_provider_id").alias("provider_id"),
    )
    rows = (
        staged.withColumn("_m", F.from_json(clean, ddl))
        .join(providers, "provider_code")
        .select(
            "creative_id", HASH, "provider_creative_id", "country_iso_2_code", "media_id",
            *[F.col(f"_m.{k}").cast(t).alias(k) for k, t in _METADATA_TYPES.items()],
            "provider_id", F.col("media_property_id").cast("int"),
            now.alias("created_timestamp"), now.alias("updated_timestamp"),
        )
    )
    one = first_per_key(rows, [HASH], [F.asc("creative_id"), F.asc("provider_id")])
    return one if target is None else absent_rows(target, one, [HASH])


def first_seen_candidates(events: DataFrame, registry: DataFrame, dims: Dims, now: Column) -> DataFrame:
    """Earliest new event of each registered creative, enriched to first-seen form."""
    ids = registry.select(HASH, "creative_id")
    known = first_events(events).join(ids, HASH)
    enriched = enrich_media_market(known, dims, city_key=city_key_of(rules.CITY_BLANKS))
    one = earliest_per_key(
        enriched,
        [HASH],
        "capture_timestamp",
        F.asc_nulls_last("media_property_id"),
        F.asc_nulls_last("market_id"),
    )
    c = F.col
    return one.select(
        "creative_id", HASH, "provider_creative_id", "country_iso_2_code",
        rules.media_id(c("provider_code"), F.lit(C.DIGITAL_MEDIA_ID)).alias("media_id"),
        c("provider_occurrence_id").alias("occurrence_id"),
        c("capture_timestamp").alias("occurrence_timestamp"),
        c("data_provider_id").alias("provider_id"),
        "media_property_id", "media_property_name", "media_category_id", "media_category_code",
        text.strip_nul(c("occurrence_link_url")).alias("provider_creative_link_url"),
        c("publisher_id").alias("provider_publisher_id"),
        c("publisher_domain").alias("provider_publisher_domain"),
        "provider_campaign_id", "provider_campaign_name",
        c("provider_campaign_advertiser_id").alias("provider_advertiser_id"),
        c("provider_campaign_product_id").alias("provider_product_id"),
        c("provider_campaign_product_name").alias("provider_product_name"),
        c("provider_campaign_advertiser_name").alias("provider_advertiser_name"),
        times.due_after_four_hours(c("capture_timestamp")).alias("due_timestamp"),
        "market_id", "market_name", "created_timestamp",
        now.alias("updated_timestamp"),
        text.strip_nul(c("provider_campaign_landing_page")).alias("provider_campaign_landing_page"),
    )


#: identity columns that an earlier event does not change
_FIRST_SEEN_KEPT = {HASH, "creative_id", "country_iso_2_code", "created_timestamp"}


def first_seen_update(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """Stored rows pulled back to an earlier event where one arrived; nothing is inserted."""
    taken = [
        c for c in candidates.columns if c in stored.columns and c not in _FIRST_SEEN_KEPT
    ]
    return merge(
        stored,
        candidates,
        [HASH],
        update=taken,
        when=lambda t, s: t("occurrence_timestamp") > s("occurrence_timestamp"),
        insert=False,
    )
