"""Laws of the pipelines: a second run changes nothing, buffer and gold do not overlap."""

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from catalog.enrichment import dims
from sightline import constants as C
from sightline.plans import events, push, summary
from sightline.session import materialize



def run_gold(t, buffer, gold, chains, changes=None):
    return events.gold_events(
        t.raw_events if changes is None else changes, buffer, gold, t.creative, t.dedupe_map, chains,
        dims(t), next_id=C.OCCURRENCE_ID_START, now=F.lit(dt.datetime(2024, 2, 1)),
        run_key=F.lit("run"),
    )


def test_gold_run_twice(spark, tables):
    t = tables
    chains = spark.createDataFrame(
        [], "deployment_chain_id bigint, purchase_method_daisy_chain_2_md5_hashcode string"
    )
    # a parked row is always a copy of an event, so start with an empty buffer
    first = run_gold(t, t.event_buffer.limit(0), t.gold_stored, chains)
    key = events.GOLD_KEY
    first = dataclasses.replace(
        first, inserts=materialize(first.inserts, "inserts"), buffer=materialize(first.buffer, "buffer")
    )
    gold = t.gold_stored.select(key).unionByName(first.inserts.select(key))
    assert first.inserts.count() > 0
    waiting = first.buffer.select(key)
    assert waiting.join(first.inserts, key, "left_semi").count() == 0
    ids = first.inserts.agg(F.count("occurrence_id"), F.countDistinct("occurrence_id")).first()
    assert ids[0] == ids[1]
    known = chains.unionByName(first.chains.select(chains.columns))
    second = run_gold(t, first.buffer, gold, known, t.raw_events)
    assert second.inserts.count() == 0
    assert second.chains.count() == 0
    again, before = materialize(second.buffer.select(key), "again"), first.buffer.select(key)
    assert again.count() == before.count()
    assert again.join(before, key, "left_anti").count() == 0


def test_push_twice(tables):
    t = tables
    now = F.lit(dt.datetime(2024, 2, 1))
    first = push.push(t.raw_events, t.registry, t.chaff, dims(t), C.CREATIVE_ID_START, now)
    assert first.staged.count() > 0
    chaff = t.chaff.unionByName(first.chaff.select("creative_url_hash"))
    registry = first.registry
    second = push.push(t.raw_events, registry, chaff, dims(t), C.CREATIVE_ID_START, now)
    assert second.staged.count() == 0
    assert second.registry.count() == registry.count()


def test_summary_released_after_registration(tables):
    t = tables
    none = t.summary_stored.limit(0).select(
        "creative_id", F.col("creative_id").alias("creative_url_hash"),
        F.lit("US").alias("country_iso_2_code"), F.lit(1).alias("market_id"),
        F.lit(1).alias("media_id"), F.lit(1).cast("bigint").alias("media_property_id"),
        "occurrence_count", "first_run", "last_run",
        F.lit(0).cast("bigint").alias("seven_days_occ_count"),
    )
    first = summary.occurrence_summary(
        t.raw_events, t.summary_buffer, none, t.registry, t.chaff, dims(t)
    )
    everything = t.part.select(
        (F.col("p_partkey") + 1000).alias("creative_id"),
        (F.col("p_partkey") * 31 + 7).alias("creative_url_hash"),
    ).unionByName(
        t.raw_events.join(
            t.part.select((F.col("p_partkey") * 31 + 7).alias("creative_url_hash")),
            "creative_url_hash", "left_anti",
        ).select(F.lit(1).cast("bigint").alias("creative_id"), "creative_url_hash").distinct()
    )
    rest = t.summary_buffer.select("creative_url_hash").join(everything, "creative_url_hash", "left_anti")
    everything = everything.unionByName(
        rest.distinct().select(F.lit(2).cast("bigint").alias("creative_id"), "creative_url_hash")
    )
    second = summary.occurrence_summary(
        t.raw_events.limit(0), first.buffer, first.summary, everything, t.chaff, dims(t)
    )
    assert first.buffer.count() > 0
    rejected = first.buffer.join(t.chaff, "creative_url_hash", "left_semi").count()
    assert second.buffer.count() == rejected


def test_payload_and_keys_are_of_one_row(spark):
    # two held copies of an event that differ in the payload alone, and events without a key
    held = spark.createDataFrame(
        [("1", "US", "a"), ("1", "US", "b"), (None, "US", "c"), (None, None, "d"), ("", None, "e"), ("=", "US", "f")],
        "provider_occurrence_id string, country_iso_2_code string, provider_campaign_name string",
    )
    types = {"capture_timestamp": "timestamp", "capture_date": "date", "provider_creative_url_hash": "bigint"}
    held = held.withColumns(
        {c: F.lit(None).cast(types.get(c, "string")) for c in events.HELD_COLUMNS if c not in held.columns}
    ).withColumn("purchase_method_id", F.when(F.col("provider_campaign_name") == "a", 1).otherwise(2))
    names = {"provider_creative_url_hash": "creative_url_hash", "media_property_id": "publisher_id"}
    fresh = held.limit(0).withColumnsRenamed(names).withColumn("publisher_id", F.lit(1).cast("bigint"))
    picked = events.picked_events(fresh, held)
    keys = picked.drop(*events.PAYLOAD).join(picked.select(*events.ROW_KEY, *events.PAYLOAD), events.ROW_KEY)
    columns = sorted(picked.columns)
    found = keys.select(columns).collect()
    assert sorted(map(str, found)) == sorted(map(str, picked.select(columns).collect()))
    assert len(found) == 5
    assert "a" not in {r["provider_campaign_name"] for r in found} or "b" not in {r["provider_campaign_name"] for r in found}


def test_creatives_are_described_before_they_are_expanded(tables, capsys):
    from catalog.sync import MARK, NOW, creative_tables
    from sightline.plans import sync

    t = creative_tables(tables)
    rows = sync.changed_creatives(t, F.lit(MARK), F.lit(NOW))

    def plan(df):
        df.explain()
        return capsys.readouterr().out

    expanded = plan(sync.expand_creatives(rows, t).select("creative_id", "creative_payload", "attribution_celebrity")).splitlines()
    made = [i for i, line in enumerate(expanded) if "AS creative_payload" in line or "has_no_audio" in line]
    joined = [i for i, line in enumerate(expanded) if "Join" in line]
    assert made and min(made) > joined[0]
    # products are compared as values, their text is not a key of any grouping
    lines = plan(sync.collapse_creatives(rows, t, dims(tables))).splitlines()
    keys = [line.split("functions=")[0] for line in lines if "Aggregate(keys=[" in line]
    assert keys and not [k for k in keys if "_kind" in k or "to_json" in k]
