"""Merge and write semantics (section 2.4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from sightline.functions import jsons
from sightline.operators import merge as m
from sightline.operators.buckets import BucketedState
from sightline.operators.layout import BucketedTable
from sightline.plans import events
from sightline.session import new_scratch

NOW = dt.datetime(2024, 2, 1)


@query(
    "append_absent",
    "SELECT k, v, n, ts, w FROM part_delta d WHERE NOT EXISTS (SELECT 1 FROM part_state s WHERE s.k = d.k)",
)
def _(t):
    return m.absent_rows(t.part_state, t.part_delta, ["k"])


@query(
    "insert_do_nothing",
    """
SELECT k, v, label FROM part_state
UNION ALL
SELECT k, v, NULL AS label FROM (
  SELECT l_partkey AS k, CAST(l_quantity AS INT) AS v, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_quantity, l_orderkey) AS rn FROM lineitem)
WHERE rn = 1 AND k NOT IN (SELECT k FROM part_state)
""",
)
def _(t):
    source = t.lineitem.select(
        F.col("l_partkey").alias("k"), F.col("l_quantity").cast("int").alias("v"), "l_orderkey"
    )
    return m.insert_do_nothing(
        t.part_state.select("k", "v", "label"), source, ["k"], [F.asc("v"), F.asc("l_orderkey")]
    ).drop("l_orderkey")


@query(
    "merge_insert_only",
    """
SELECT creative_id, market_id, occurrence_count FROM (
  SELECT creative_id, market_id, CAST(SUM(occurrence_count) AS BIGINT) AS occurrence_count
  FROM summary_stored GROUP BY ALL) s
UNION ALL
SELECT creative_id, market_id, occ FROM (
  SELECT creative_id, market_id, CAST(SUM(occ_cnt) AS BIGINT) AS occ FROM daily GROUP BY ALL) d
WHERE NOT EXISTS (SELECT 1 FROM summary_stored s WHERE s.creative_id = d.creative_id
  AND s.market_id = d.market_id)
""",
)
def _(t):
    key = ["creative_id", "market_id"]
    stored = t.summary_stored.groupBy(*key).agg(F.sum("occurrence_count").alias("occurrence_count"))
    new = t.daily.groupBy(*key).agg(F.sum("occ_cnt").alias("occurrence_count"))
    return m.insert_only(stored, new, key)


UPSERTED = """
SELECT s.k, s.v, s.n, s.ts, s.w FROM part_state s WHERE s.k NOT IN (SELECT k FROM part_delta)
UNION ALL SELECT k, v, n, ts, w FROM part_delta
"""


@query("merge_upsert_all", UPSERTED)
def _(t):
    return m.upsert(t.part_state.drop("label"), t.part_delta, ["k"])


@query("merge_bucketed", UPSERTED)
def _(t):
    # the state lies in buckets of its key; two merges on it move the delta alone
    table = BucketedTable(t.spark, new_scratch(t.spark, "parts"), ["k"], 8)
    table.load(t.part_state.drop("label"))
    for version in range(2):
        table.merge(t.part_delta, lambda state, delta: m.upsert(state, delta, ["k"]), version)
    return table.read(2)


@query(
    "merge_update_subset",
    """
SELECT COALESCE(s.k, d.k) AS k, CASE WHEN d.k IS NULL THEN s.v ELSE d.v END AS v,
  CASE WHEN s.k IS NULL THEN d.n ELSE s.n END AS n,
  CASE WHEN d.k IS NULL THEN s.ts ELSE d.ts END AS ts,
  CASE WHEN d.k IS NULL THEN s.w WHEN s.k IS NULL THEN d.w ELSE COALESCE(d.w, s.w) END AS w, s.label
FROM part_state s FULL JOIN part_delta d ON s.k = d.k
""",
)
def _(t):
    return m.merge(
        t.part_state, t.part_delta, ["k"], update=["v", "ts"],
        values={"w": m.keep_old_when_null("w")},
    )


@query(
    "merge_guarded",
    """
SELECT s.k, CASE WHEN s.ts <> d.ts THEN d.v ELSE s.v END AS v, s.n,
  CASE WHEN s.ts <> d.ts THEN d.ts ELSE s.ts END AS ts, s.w, s.label
FROM part_state s LEFT JOIN part_delta d ON s.k = d.k
""",
)
def _(t):
    return m.merge(
        t.part_state, t.part_delta, ["k"], update=["v", "ts"], when=m.differs("ts"), insert=False
    )


@query(
    "update_if_earlier",
    """
SELECT s.k, CASE WHEN s.ts > d.ts THEN d.v ELSE s.v END AS v, s.n,
  CASE WHEN s.ts > d.ts THEN d.ts ELSE s.ts END AS ts, s.w, s.label
FROM part_state s LEFT JOIN part_delta d ON s.k = d.k
""",
)
def _(t):
    return m.merge(
        t.part_state, t.part_delta, ["k"], update=["v", "ts"], when=m.is_earlier("ts"), insert=False
    )


GROUP = ["creative_id", "market_id", "media_property_id"]
DELTA = """SELECT creative_id, market_id, media_property_id, CAST(SUM(occ_cnt) AS BIGINT) AS n,
  MIN(first_run) AS f, MAX(last_run) AS l FROM daily GROUP BY ALL"""


@query(
    "merge_accumulate",
    f"""
SELECT COALESCE(s.creative_id, d.creative_id) AS creative_id, COALESCE(s.market_id, d.market_id) AS market_id,
  COALESCE(s.media_property_id, d.media_property_id) AS media_property_id,
  COALESCE(s.occurrence_count, 0) + COALESCE(d.n, 0) AS occurrence_count,
  LEAST(s.first_run, d.f) AS first_run, GREATEST(s.last_run, d.l) AS last_run
FROM summary_stored s FULL JOIN ({DELTA}) d ON s.creative_id = d.creative_id AND s.market_id = d.market_id
  AND COALESCE(s.media_property_id, -1) = COALESCE(d.media_property_id, -1)
""",
)
def _(t):
    stored, delta = t.summary_stored, t.daily.withColumnRenamed("occ_cnt", "occurrence_count")
    columns = [*GROUP, "occurrence_count", "first_run", "last_run"]
    schema = ", ".join(f"{name} {kind}" for name, kind in stored.select(columns).dtypes)
    state = BucketedState(t.spark, new_scratch(t.spark, "summary"), GROUP, schema, 8)

    def step(state, batch):
        return m.accumulate(state, batch, GROUP, add=["occurrence_count"], low=["first_run"], high=["last_run"])

    state.apply(stored.select(columns), lambda _, batch: batch, 0)
    for _run in range(2):  # a batch that runs again is applied once
        state.apply(delta.select(columns), step, 1)
    return state.read()


@query(
    "merge_first_n_days",
    """
SELECT d.creative_id, d.market_id, d.media_property_id, CAST(SUM(d.occ_cnt) AS BIGINT) AS occ_cnt
FROM daily d JOIN summary_stored s ON s.creative_id = d.creative_id AND s.market_id = d.market_id
  AND COALESCE(s.media_property_id, -1) = COALESCE(d.media_property_id, -1)
WHERE d.capture_date - CAST(s.first_run AS DATE) < 7 GROUP BY ALL
""",
)
def _(t):
    return m.count_first_days(
        t.daily, t.summary_stored.select(*GROUP, F.col("first_run").alias("first_ts")), GROUP,
        day="capture_date", first_ts="first_ts", days=7, add="occ_cnt",
    )


@query(
    "park_release",
    """
WITH cand AS (SELECT 'held' || o_orderkey AS provider_occurrence_id, 'BIS' AS provider_code,
  o_totalprice > 200000 AS resolved FROM orders)
SELECT b.provider_occurrence_id, b.provider_code FROM summary_buffer b
  LEFT JOIN cand c ON c.provider_occurrence_id = b.provider_occurrence_id
  WHERE NOT COALESCE(c.resolved, FALSE)
UNION ALL
SELECT c.provider_occurrence_id, c.provider_code FROM cand c WHERE NOT resolved
  AND c.provider_occurrence_id NOT IN (SELECT provider_occurrence_id FROM summary_buffer)
""",
)
def _(t):
    rows = t.orders.select(
        F.concat(F.lit("held"), F.col("o_orderkey").cast("string")).alias("provider_occurrence_id"),
        F.lit("BIS").alias("provider_code"),
        (F.col("o_totalprice") > 200000).alias("resolved"),
    )
    buffer = t.summary_buffer.select("provider_occurrence_id", "provider_code")
    resolved = F.col("resolved")
    return m.park_release(
        buffer, rows, ["provider_occurrence_id", "provider_code"], resolved, ~resolved
    )


@query(
    "delete_by_keys",
    """
SELECT creative_dedupe_map_id, child_creative_id FROM dedupe_map
WHERE child_creative_id NOT IN (SELECT creative_id FROM creative
  WHERE classification_type = 'BadAd')
""",
)
def _(t):
    gone = t.creative.filter("classification_type = 'BadAd'").select("creative_id")
    kept = m.delete_by_keys(t.dedupe_map, gone, {"child_creative_id": "creative_id"})
    return kept.select("creative_dedupe_map_id", "child_creative_id")


@query(
    "update_by_keys",
    """
SELECT creative_id, CASE WHEN NOT is_staged AND creative_url_hash IN
  (SELECT creative_url_hash FROM raw_events) THEN TRUE ELSE is_staged END AS is_staged FROM registry
""",
)
def _(t):
    from sightline.plans.push import mark_staged

    return mark_staged(t.registry, t.raw_events).select("creative_id", "is_staged")


@query(
    "replace_scope",
    """
SELECT k, v FROM part_state WHERE k NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)
UNION ALL
SELECT l_partkey, CAST(l_quantity AS INT) FROM lineitem WHERE l_returnflag = 'R'
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)
""",
)
def _(t):
    scope = t.part.filter("p_size > 25").select(F.col("p_partkey").alias("k"))
    fresh = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("k"), F.col("l_quantity").cast("int").alias("v")
    )
    return m.replace_scope(
        t.part_state.select("k", "v"), fresh.join(scope, "k", "left_semi"), scope, ["k"]
    )


@query(
    "upsert_excluded",
    """
SELECT COALESCE(d.k, s.k) AS k, CASE WHEN d.k IS NOT NULL THEN d.v ELSE s.v END AS v,
  CASE WHEN d.k IS NOT NULL THEN d.ts ELSE s.ts END AS ts
FROM part_state s FULL JOIN part_delta d ON s.k = d.k
""",
)
def _(t):
    columns = ["k", "v", "ts"]
    return m.upsert(t.part_state.select(columns), t.part_delta.select(columns), ["k"])


@query(
    "propagate_parent_flag",
    """
WITH f AS (SELECT creative_id, classification_type = 'BadAd' AS hold FROM creative)
SELECT f.creative_id, CASE WHEN f.creative_id IN (SELECT child_creative_id FROM dedupe_map d
  JOIN f p ON p.creative_id = d.parent_creative_id AND p.hold) THEN TRUE ELSE hold END AS hold FROM f
""",
)
def _(t):
    rows = t.creative.select("creative_id", F.expr("classification_type = 'BadAd'").alias("hold"))
    return m.spread_flag(rows, t.dedupe_map, id="creative_id", flag="hold")


CHANGED = """changed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY creative_url_hash,
    country_iso_2_code ORDER BY updated_timestamp DESC, creative_id) AS rn FROM creative
  WHERE updated_timestamp > TIMESTAMP '2024-01-10 00:00:00') WHERE rn = 1)"""
MOVES = f"""{CHANGED},
moves AS (
  SELECT e.occurrence_id, COALESCE(d.parent_creative_id, c.creative_id) AS creative_id,
    d.parent_creative_url_hash AS p
  FROM changed c JOIN dedupe_map d ON c.creative_url_hash = d.child_creative_url_hash AND d.match_type = 'Map'
  JOIN gold_event e ON c.creative_url_hash = e.provider_original_creative_url_hash
  WHERE c.classification_type = 'Advert' AND d.parent_creative_id IS NOT NULL
    AND d.parent_creative_id <> e.creative_id
  UNION
  SELECT e.occurrence_id, c.creative_id, CAST(NULL AS BIGINT) AS p
  FROM changed c LEFT JOIN dedupe_map d ON c.creative_url_hash = d.child_creative_url_hash
  JOIN gold_event e ON c.creative_url_hash = e.provider_original_creative_url_hash
    AND c.creative_id <> e.creative_id
  WHERE COALESCE(d.match_type, '') <> 'Map')"""
MARK = dt.datetime(2024, 1, 10)


def stored_by_month(t) -> str:
    """Gold events as a stored table that is partitioned by month."""
    path = new_scratch(t.spark, "gold")
    t.gold_event.write.partitionBy("capture_month").parquet(path)
    return path


@query(
    "reparent",
    f"""
WITH {MOVES}
SELECT e.occurrence_id, COALESCE(m.creative_id, e.creative_id) AS creative_id,
  CASE WHEN m.occurrence_id IS NOT NULL THEN m.p ELSE e.provider_parent_creative_url_hash END AS parent_hash,
  CASE WHEN m.occurrence_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE e.updated_timestamp END
    AS updated_timestamp
FROM gold_event e LEFT JOIN moves m ON m.occurrence_id = e.occurrence_id
""",
)
def _(t):
    path = stored_by_month(t)
    events.reparent_in_place(path, t.creative, t.dedupe_map, F.lit(MARK), F.lit(NOW))
    return t.spark.read.parquet(path).select(
        "occurrence_id", "creative_id",
        F.col("provider_parent_creative_url_hash").alias("parent_hash"), "updated_timestamp",
    )


@query(
    "set_delete_flag",
    f"""
WITH {CHANGED}
SELECT e.occurrence_id, CASE WHEN b.creative_id IS NOT NULL AND e.delete_flag = FALSE THEN TRUE
  ELSE e.delete_flag END AS delete_flag
FROM gold_event e LEFT JOIN changed b ON b.creative_id = e.creative_id
  AND b.classification_type IN ('NonAd', 'BadAd')
""",
)
def _(t):
    path = stored_by_month(t)
    events.flag_in_place(path, t.creative, F.lit(MARK), F.lit(NOW))
    return t.spark.read.parquet(path).select("occurrence_id", "delete_flag")


@query(
    "change_log",
    """
SELECT creative_id, TIMESTAMP '2024-02-01 00:00:00' AS created_timestamp,
  updated_timestamp AS psql_updated_timestamp, creative_title AS title, classification_type AS kind,
  CAST(vx1_product_id AS BIGINT) AS vx1, classification_type IS NOT NULL AS has_kind
FROM advert_coded WHERE NOT holding_flag
""",
)
def _(t):
    from sightline import constants as C
    from sightline.plans.sync import change_log, completed

    j = F.col("json_log")
    rows = completed(t.advert_coded, C.LOGGED_COLUMNS)
    return change_log(rows, F.lit(NOW)).select(
        "creative_id", "created_timestamp", "psql_updated_timestamp",
        jsons.text_at(j, "$.creative_title").alias("title"),
        jsons.text_at(j, "$.classification_type").alias("kind"),
        jsons.text_at(j, "$.vx1_product_id").cast("bigint").alias("vx1"),
        # a NULL field is left out of the object
        F.array_contains(F.json_object_keys(j), "classification_type").alias("has_kind"),
    )


@query(
    "prior_value_log",
    """
SELECT creative_id, primary_product_id, vx1_product_id, vx2_product_id, secondary_products,
  vx1_secondary_products, TIMESTAMP '2024-02-01 00:00:00' AS created_timestamp FROM advert_coded
""",
)
def _(t):
    from sightline.plans.translate import CODES, prior_values

    held = t.advert_coded.withColumnsRenamed({c: f"old_{c}" for c in CODES})
    return prior_values(held, F.lit(NOW)).select(
        "creative_id", "primary_product_id", "vx1_product_id", "vx2_product_id",
        "secondary_products", "vx1_secondary_products", "created_timestamp",
    )


@query(
    "multi_match_check",
    """
SELECT l_orderkey, l_linenumber, COUNT(*) AS matches FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1
""",
)
def _(t):
    return m.multi_matches(t.lineitem, ["l_orderkey", "l_linenumber"])
