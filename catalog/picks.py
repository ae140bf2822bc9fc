"""Windows, sorting, set operations and identifiers (sections 2.7 to 2.9 and 2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from sightline import constants as C
from sightline.operators.ids import assign_dense_ids, remap_ids
from sightline.operators.picks import (
    earliest_per_key,
    first_per_key,
    latest_per_key,
    with_collected,
)
from sightline.session import new_scratch
from sightline.sources.tables import newest_one, sorted_by_month


@query(
    "latest_per_key",
    """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM deliveries) WHERE rn = 1
""",
)
def _(t):
    return latest_per_key(t.deliveries, ["user_id", "event_type"], "ts", F.desc("event_id")).select(
        "user_id", "event_id", "ts", "event_type"
    )


@query(
    "earliest_per_key",
    """
SELECT creative_url_hash, provider_occurrence_id, capture_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY creative_url_hash
    ORDER BY capture_timestamp, provider_occurrence_id) AS rn FROM raw_events) WHERE rn = 1
""",
)
def _(t):
    return earliest_per_key(
        t.raw_events, ["creative_url_hash"], "capture_timestamp", F.asc("provider_occurrence_id")
    ).select("creative_url_hash", "provider_occurrence_id", "capture_timestamp")


@query(
    "family_earliest",
    """
SELECT p, creative_id, occurrence_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY p ORDER BY occurrence_timestamp ASC NULLS LAST, creative_id) AS rn
  FROM (SELECT *, creative_id - creative_id % 5 AS p FROM first_seen)) WHERE rn = 1
""",
)
def _(t):
    family = t.first_seen.withColumn("p", F.col("creative_id") - F.col("creative_id") % 5)
    return earliest_per_key(family, ["p"], "occurrence_timestamp", F.asc("creative_id")).select(
        "p", "creative_id", "occurrence_timestamp"
    )


@query(
    "latest_nulls_last",
    """
SELECT p, creative_id, occurrence_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY p ORDER BY occurrence_timestamp DESC NULLS LAST, creative_id) AS rn
  FROM (SELECT *, creative_id % 20 AS p FROM first_seen)) WHERE rn = 1
""",
)
def _(t):
    family = t.first_seen.withColumn("p", F.col("creative_id") % 20)
    return latest_per_key(family, ["p"], "occurrence_timestamp", F.asc("creative_id")).select(
        "p", "creative_id", "occurrence_timestamp"
    )


BOTH_SIDES = """
SELECT '1-RawOccurrence' AS source_flag, provider_occurrence_id, capture_timestamp, creative_url_hash
FROM raw_events
UNION ALL
SELECT '2-IntermediateStaging' AS source_flag, provider_occurrence_id, capture_timestamp,
  provider_creative_url_hash AS creative_url_hash
FROM event_buffer
"""


def both_sides(t):
    new = t.raw_events.select(
        F.lit(C.SOURCE_NEW).alias("source_flag"),
        "provider_occurrence_id", "capture_timestamp", "creative_url_hash",
    )
    held = t.event_buffer.select(
        F.lit(C.SOURCE_HELD).alias("source_flag"),
        "provider_occurrence_id",
        "capture_timestamp",
        F.col("provider_creative_url_hash").alias("creative_url_hash"),
    )
    return new.unionByName(held)


@query(
    "prefer_source",
    f"""
SELECT source_flag, provider_occurrence_id, capture_timestamp, creative_url_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY provider_occurrence_id
    ORDER BY source_flag DESC, capture_timestamp) AS rn FROM ({BOTH_SIDES})) WHERE rn = 1
""",
)
def _(t):
    order = [F.desc("source_flag"), F.asc("capture_timestamp")]
    return first_per_key(both_sides(t), ["provider_occurrence_id"], order)


@query(
    "dense_ids",
    """
SELECT 75000000000 + row_number() OVER (ORDER BY ts, event_id) - 1 AS occurrence_id, event_id FROM deliveries
""",
)
def _(t):
    rows = t.deliveries.select("ts", "event_id")
    return assign_dense_ids(
        rows, ["ts", "event_id"], C.OCCURRENCE_ID_START, "occurrence_id"
    ).select("occurrence_id", "event_id")


@query(
    "window_collect",
    """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, string_agg(flag, '|' ORDER BY flag)
  OVER (PARTITION BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS labels
FROM (SELECT *, CASE WHEN l_discount > 0.02 THEN l_returnflag END AS flag FROM lineitem)
""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_discount") > 0.02, F.col("l_returnflag")).alias("flag"),
    )
    return with_collected(rows, ["l_orderkey"], "flag", "a").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        F.when(F.size("a") > 0, F.array_join("a", "|")).alias("labels"),
    )


@query(
    "distinct_on",
    """
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderdate AS inserted_at, o_orderkey FROM orders
ORDER BY o_custkey, o_orderdate DESC, o_orderkey
""",
)
def _(t):
    rows = t.orders.select(
        "o_custkey", F.col("o_orderdate").cast("timestamp").alias("inserted_at"), "o_orderkey"
    )
    return latest_per_key(rows, ["o_custkey"], "inserted_at", F.asc("o_orderkey"))


@query(
    "dedup_after_fanout",
    """
SELECT provider_occurrence_id, capture_timestamp, market_id FROM (
  SELECT e.provider_occurrence_id, e.capture_timestamp, n.n_nationkey AS market_id,
    row_number() OVER (PARTITION BY e.provider_occurrence_id, e.capture_timestamp
      ORDER BY n.n_nationkey) AS rn
  FROM raw_events e LEFT JOIN nation n ON n.n_regionkey = e.purchase_method_id) WHERE rn = 1
""",
)
def _(t):
    places = t.nation.select(
        F.col("n_regionkey").alias("purchase_method_id"), F.col("n_nationkey").alias("market_id")
    )
    wide = t.raw_events.join(places, "purchase_method_id", "left")
    key = ["provider_occurrence_id", "capture_timestamp"]
    return first_per_key(wide, key, [F.asc("market_id")]).select(*key, "market_id")


# ---- sorting -------------------------------------------------------------------------------


@query(
    "newest_one",
    """
SELECT version, committed_at FROM manifest ORDER BY committed_at DESC, version DESC LIMIT 1
""",
)
def _(t):
    return newest_one(t.manifest)


@query(
    "array_sort",
    """
SELECT o, string_agg(k, '|' ORDER BY i, id, r) AS sorted FROM (
  SELECT l_orderkey AS o, l_linenumber AS i, l_suppkey AS id, l_partkey % 9 AS r,
    l_linenumber || ':' || l_suppkey || ':' || l_partkey % 9 AS k FROM lineitem) GROUP BY o
""",
)
def _(t):
    element = F.struct(
        F.col("l_linenumber").alias("i"), F.col("l_suppkey").alias("id"),
        (F.col("l_partkey") % 9).alias("r"),
    )
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("o")).agg(F.collect_list(element).alias("a"))
    text = F.transform(F.array_sort("a"), lambda e: F.concat_ws(":", e["i"], e["id"], e["r"]))
    return rows.select("o", F.array_join(text, "|").alias("sorted"))


SORTED_SQL = """
SELECT capture_month, COUNT(*) AS n, TRUE AS sorted FROM raw_events GROUP BY capture_month
"""


@query("sorted_write", SORTED_SQL)
def _(t):
    # written by month and sorted by id; each file must come back in order
    path = new_scratch(t.spark, "sorted")
    rows = t.raw_events.select("capture_month", "provider_occurrence_id", "capture_timestamp")
    ordered = sorted_by_month(rows, "capture_month", "provider_occurrence_id")
    ordered.write.partitionBy("capture_month").parquet(path)
    stored = t.spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")
    )
    previous = F.expr("lag(provider_occurrence_id) over (partition by f order by i)")
    checked = stored.withColumn("up", F.coalesce(previous <= F.col("provider_occurrence_id"), F.lit(True)))
    return checked.groupBy(F.col("capture_month").cast("int")).agg(
        F.count(F.lit(1)).alias("n"), F.min("up").alias("sorted")
    )


# ---- set operations ------------------------------------------------------------------------


@query("union_all", BOTH_SIDES)
def _(t):
    return both_sides(t)


@query(
    "union_distinct",
    """
SELECT creative_id FROM creative WHERE updated_timestamp > TIMESTAMP '2024-01-25 00:00:00'
UNION
SELECT creative_id FROM first_seen WHERE updated_timestamp > TIMESTAMP '2024-02-05 00:00:00'
""",
)
def _(t):
    changed = t.creative.filter("updated_timestamp > timestamp '2024-01-25 00:00:00'")
    seen = t.first_seen.filter("updated_timestamp > timestamp '2024-02-05 00:00:00'")
    return changed.select("creative_id").union(seen.select("creative_id")).distinct()


# ---- identifiers ---------------------------------------------------------------------------


@query(
    "assign_dense_ids",
    """
SELECT 26000000000 + row_number() OVER (ORDER BY created_timestamp, creative_url_hash) - 1 AS creative_id,
  creative_url_hash
FROM (SELECT creative_url_hash, MIN(created_timestamp) AS created_timestamp FROM raw_events
  GROUP BY creative_url_hash)
WHERE creative_url_hash NOT IN (SELECT creative_url_hash FROM registry)
""",
)
def _(t):
    first = t.raw_events.groupBy("creative_url_hash").agg(
        F.min("created_timestamp").alias("created_timestamp")
    )
    new = first.join(t.registry, "creative_url_hash", "left_anti")
    return assign_dense_ids(
        new, ["created_timestamp", "creative_url_hash"], C.CREATIVE_ID_START, "creative_id"
    ).drop("created_timestamp")


@query(
    "remap_ids",
    """
SELECT d.creative_dedupe_map_id, COALESCE(r.creative_id + 500000, d.parent_creative_id) AS parent_creative_id,
  r.creative_id IS NOT NULL AS is_own
FROM dedupe_map d LEFT JOIN registry r ON r.creative_url_hash = d.parent_creative_url_hash
""",
)
def _(t):
    own = t.registry.select(
        F.col("creative_url_hash").alias("parent_creative_url_hash"),
        (F.col("creative_id") + 500000).alias("creative_id"),
    )
    return remap_ids(
        t.dedupe_map, own, "parent_creative_url_hash", "creative_id", "parent_creative_id"
    ).select("creative_dedupe_map_id", "parent_creative_id", "is_own")


