"""Copy of the creatives in scope, and of what depends on them, from a source system."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.ids import remap_ids
from sightline.operators.merge import replace_scope, upsert
from sightline.operators.picks import first_per_key
from sightline.session import materialize

NEW, UPDATE, ALL = "NEW", "UPDATE", "ALL"
HASH = "creative_url_hash"


def anchors_new(staging: DataFrame, since: Column) -> DataFrame:
    """Own creatives staged since the mark."""
    return staging.filter(F.col("updated_timestamp") > since).select(
        HASH, F.col("creative_id").alias("reserved_id")
    )


def anchors_updated(
    staging: DataFrame, source_creative: DataFrame, own_dedupe: DataFrame, since: Column
) -> DataFrame:
    """Own creatives whose source row changed, or whose parent's source row changed."""
    changed = source_creative.filter(F.col("updated_timestamp") > since).select(HASH)
    own = staging.join(changed, HASH, "left_semi").select(
        HASH, F.col("creative_id").alias("reserved_id")
    )
    parents = changed.select(F.col(HASH).alias("parent_creative_url_hash"))
    children = own_dedupe.join(parents, "parent_creative_url_hash", "left_semi").select(
        F.col("child_creative_url_hash").alias(HASH),
        F.col("child_creative_id").alias("reserved_id"),
    )
    return own.unionByName(children).distinct()


def seed_anchors(
    mode: str,
    staging: DataFrame,
    source_creative: DataFrame,
    own_dedupe: DataFrame,
    *,
    new_since: Column,
    update_since: Column,
) -> DataFrame:
    if mode not in (NEW, UPDATE, ALL):
        raise ValueError(f"mode must be one of {NEW}, {UPDATE}, {ALL}: {mode}")
    parts = []
    if mode in (NEW, ALL):
        parts.append(anchors_new(staging, new_since))
    if mode in (UPDATE, ALL):
        parts.append(anchors_updated(staging, source_creative, own_dedupe, update_since))
    anchors = parts[0]
    for more in parts[1:]:
        anchors = anchors.unionByName(more)
    return anchors.distinct()


def id_map(
    anchors: DataFrame, staging: DataFrame, source_creative: DataFrame, source_dedupe: DataFrame
) -> DataFrame:
    """(source id, own id, hash, is_own) for the anchors and their one-hop parents.

    A parent that is one of ours takes its own id; an external one keeps the source's.
    """
    known = source_creative.select(HASH, F.col("creative_id").alias("source_id"))
    ours = anchors.join(known, HASH).select(
        "source_id", F.col("reserved_id").alias("own_id"), HASH, F.lit(True).alias("is_own")
    )
    scope = ours.select("source_id")
    parents = (
        source_dedupe.join(
            scope.withColumnRenamed("source_id", "child_creative_id"),
            "child_creative_id",
            "left_semi",
        )
        .select(
            F.col("parent_creative_id").alias("source_id"),
            F.col("parent_creative_url_hash").alias(HASH),
        )
        .distinct()
        .join(scope, "source_id", "left_anti")
        .join(source_creative.select(F.col("creative_id").alias("source_id")), "source_id", "left_semi")
    )
    mapped = remap_ids(
        parents.withColumn("own_id", F.col("source_id")), staging, HASH, "creative_id", "own_id"
    )
    return ours.unionByName(mapped.select("source_id", "own_id", HASH, F.col("is_own")))


@dataclass(frozen=True)
class Footprint:
    """Tables of one system. ``multi`` has several rows per creative and ``single`` one."""

    creative: DataFrame
    dedupe_map: DataFrame
    first_seen: DataFrame
    staging: DataFrame | None = None
    summary: DataFrame | None = None
    single: dict[str, DataFrame] = field(default_factory=dict)
    multi: dict[str, DataFrame] = field(default_factory=dict)


def _copied(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the mapped creatives under their own ids."""
    renamed = table.withColumnRenamed("creative_id", "source_id")
    columns = ["creative_id" if c == "source_id" else c for c in renamed.columns]
    return renamed.join(ids.select("source_id", F.col("own_id").alias("creative_id")), "source_id").select(
        columns
    )


def seed_footprint(
    own: Footprint, source: Footprint, anchors: DataFrame, media: DataFrame, now: Column
) -> Footprint:
    """Own tables after loading the anchors, their parents and everything that depends on them.

    Single-row tables are upserted; the scope of multi-row tables is replaced, so rows removed
    at the source disappear. Values we know ourselves win over the source's.
    """
    # stored once: every dependent table is built from these four
    ids = materialize(id_map(anchors, own.staging, source.creative, source.dedupe_map), "ids")
    external = ids.filter(~F.col("is_own"))
    own_scope = ids.select(F.col("own_id").alias("creative_id"))

    # first seen: external parents only, ours come from the event pipeline
    first_seen = replace_scope(
        own.first_seen,
        _copied(source.first_seen, external).withColumn("updated_timestamp", now),
        external.select(F.col("own_id").alias("creative_id")),
        ["creative_id"],
    )
    first_seen = materialize(first_seen, "first_seen")
    dedupe = materialize(_own_dedupe(own, source, ids, first_seen, media, now), "dedupe")
    parents = dedupe.join(
        own_scope.select(F.col("creative_id").alias("child_creative_id")),
        "child_creative_id", "left_semi",
    ).select(F.col("parent_creative_id").alias("own_id")).distinct()
    # ours, or a parent of a creative of this run
    related = ids.filter("is_own").unionByName(
        ids.filter(~F.col("is_own")).join(parents, "own_id", "left_semi").select(ids.columns)
    )
    related = materialize(related, "related")

    summary = own.summary
    if summary is not None:
        fresh = _copied(source.summary, external.join(parents, "own_id", "left_semi"))
        summary = replace_scope(
            summary, fresh, external.select(F.col("own_id").alias("creative_id")), ["creative_id"]
        )

    creative = upsert(
        own.creative, _own_creative(own, source, related, first_seen, now), ["creative_id"]
    )
    single = {}
    for name, table in own.single.items():
        copied = _copied(source.single[name], related)
        newest = first_per_key(copied, ["creative_id"], [F.desc(c) for c in copied.columns[1:]])
        single[name] = upsert(table, newest, ["creative_id"])
    multi = {
        name: replace_scope(table, _copied(source.multi[name], related), own_scope, ["creative_id"])
        for name, table in own.multi.items()
    }
    return Footprint(
        creative=creative, dedupe_map=dedupe, first_seen=first_seen, staging=own.staging,
        summary=summary, single=single, multi=multi,
    )


def _described(prefix: str, staging: DataFrame, first_seen: DataFrame, media: DataFrame) -> DataFrame:
    """Descriptors of creatives by id: provider, type, hash and the medium's name."""
    seen = first_seen.select("creative_id", "media_id").join(
        media.select("media_id", "media_name"), "media_id", "left"
    ).select("creative_id", F.col("media_name").alias(f"{prefix}_medium"))
    base = staging.select(
        "creative_id",
        F.col("provider_code").alias(f"{prefix}_provider"),
        F.col("creative_type").alias(f"{prefix}_type"),
        F.col(HASH).alias(f"{prefix}_hash"),
    )
    return base.join(seen, "creative_id", "left")


def _own_dedupe(
    own: Footprint, source: Footprint, ids: DataFrame, first_seen: DataFrame, media: DataFrame,
    now: Column,
) -> DataFrame:
    """Mapping rows whose child is ours, described by our own tables where possible."""
    to_own = ids.select("source_id", "own_id")
    child = _described("_c", own.staging, first_seen, media).withColumnRenamed("creative_id", "_child")
    ours = _described("_p", own.staging, first_seen, media).withColumnRenamed("creative_id", "_parent")
    theirs = _described("_s", source.staging, source.first_seen, media).withColumnRenamed(
        "creative_id", "parent_creative_id"
    )
    rows = (
        source.dedupe_map.join(
            to_own.toDF("child_creative_id", "_child"), "child_creative_id"
        )
        .join(to_own.toDF("parent_creative_id", "_parent"), "parent_creative_id", "left")
        .join(child.filter(F.col("_c_medium").isNotNull()), "_child")
        .join(ours, "_parent", "left")
        .join(theirs, "parent_creative_id", "left")
    )
    fresh = rows.withColumns(
        {
            "child_creative_id": F.col("_child"),
            "child_provider_code": F.col("_c_provider"),
            "child_creative_type": F.col("_c_type"),
            "child_creative_subtype": F.col("_c_medium"),
            "parent_creative_url_hash": F.coalesce("_p_hash", "parent_creative_url_hash"),
            "parent_creative_provider_code": F.coalesce(
                "_p_provider", "_s_provider", "parent_creative_provider_code"
            ),
            "parent_creative_type": F.coalesce("_p_type", "_s_type", "parent_creative_type"),
            "parent_creative_subtype": F.coalesce(
                "_p_medium", "_s_medium", "parent_creative_subtype"
            ),
            "parent_creative_id": F.coalesce("_parent", "parent_creative_id"),
            "updated_timestamp": now,
        }
    )
    scope = ids.select(F.col("own_id").alias("child_creative_id"))
    return replace_scope(own.dedupe_map, fresh, scope, ["child_creative_id"])


def _own_creative(
    own: Footprint, source: Footprint, ids: DataFrame, first_seen: DataFrame, now: Column
) -> DataFrame:
    """Source rows under own ids; what our staging knows wins over the source."""
    copied = _copied(source.creative, ids)
    known = own.staging.select(
        "creative_id",
        *[
            F.col(c).alias(f"_own_{c}")
            for c in own.staging.columns
            if c in copied.columns and c in OWN_WINS
        ],
    )
    providers = first_seen.select("creative_id", F.col("provider_id").alias("_own_provider_id"))
    joined = copied.join(known, "creative_id", "left").join(providers, "creative_id", "left")
    winners = {
        c[len("_own_"):]: F.coalesce(c, c[len("_own_"):])
        for c in joined.columns
        if c.startswith("_own_") and c[len("_own_"):] in copied.columns
    }
    return joined.withColumns(winners | {"updated_timestamp": now}).select(copied.columns)


#: creative columns for which our own value is preferred
OWN_WINS = [
    "provider_creative_id", "source_channel_id", "creative_type_id", "mime_type_id",
    "creative_width", "creative_height", "creative_duration",
]
