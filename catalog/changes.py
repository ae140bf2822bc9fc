"""Incremental reads and durable marks (section 2.2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from sightline.operators import increments as inc
from sightline.operators.collect import write_reported
from sightline.session import new_scratch
from sightline.sources.tables import version_range

NOW = dt.datetime(2024, 2, 1)


@query(
    "changes_since_version",
    """
SELECT 'first' AS branch, provider_occurrence_id, capture_timestamp FROM raw_events WHERE _version <= 20
UNION ALL
SELECT 'same', provider_occurrence_id, capture_timestamp FROM raw_events WHERE FALSE
UNION ALL
SELECT 'next', provider_occurrence_id, capture_timestamp FROM raw_events WHERE _version > 20 AND _version <= 25
""",
)
def _(t):
    parts = []
    for branch, start, end in (("first", None, 20), ("same", 20, 20), ("next", 20, 25)):
        rows = inc.changes_since_version(t.raw_events, start, end)
        parts.append(
            rows.select(F.lit(branch).alias("branch"), "provider_occurrence_id", "capture_timestamp")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "wm_begin_version",
    """
SELECT watermark_name, last_commit_version, transaction_status, updated_timestamp,
  CASE WHEN watermark_name = 'flow ASIA' THEN v ELSE current_commit_version END AS current_commit_version
FROM (SELECT watermark_name, last_commit_version, current_commit_version,
  (SELECT MAX(version) FROM manifest) AS v,
  CASE WHEN watermark_name = 'flow ASIA' THEN 'InProgress' ELSE transaction_status END AS transaction_status,
  CASE WHEN watermark_name = 'flow ASIA' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE updated_timestamp END
    AS updated_timestamp FROM control)
""",
)
def _(t):
    end = t.manifest.agg(F.max("version")).scalar()
    return inc.begin_version(t.control, "flow ASIA", end, F.lit(NOW)).select(
        "watermark_name", "last_commit_version", "current_commit_version", "transaction_status",
        "updated_timestamp",
    )


@query(
    "wm_finish_version",
    """
SELECT watermark_name, current_commit_version, 'SUCCEEDED' AS transaction_status,
  CASE WHEN watermark_name = 'flow ASIA' THEN current_commit_version ELSE last_commit_version END
    AS last_commit_version FROM control
""",
)
def _(t):
    running = inc.begin_version(
        t.control, "flow ASIA", F.col("current_commit_version"), F.lit(NOW)
    )
    return inc.finish_version(running, "flow ASIA", F.lit(NOW)).select(
        "watermark_name", "current_commit_version", "transaction_status", "last_commit_version"
    )


@query(
    "changes_since_ts",
    "SELECT creative_id, updated_timestamp FROM creative WHERE updated_timestamp > TIMESTAMP '2024-01-20 00:00:00'",
)
def _(t):
    mark = F.lit(dt.datetime(2024, 1, 20))
    return inc.changes_since_ts(t.creative, "updated_timestamp", mark).select(
        "creative_id", "updated_timestamp"
    )


@query(
    "changes_inclusive",
    "SELECT creative_id, updated_timestamp FROM creative WHERE updated_timestamp >= TIMESTAMP '2024-01-20 00:00:00'",
)
def _(t):
    mark = F.lit(dt.datetime(2024, 1, 20))
    return inc.changes_inclusive(t.creative, "updated_timestamp", mark).select(
        "creative_id", "updated_timestamp"
    )


MOVED = """SELECT watermark_name,
  CASE WHEN watermark_name = '{flow}' AND m IS NOT NULL THEN end_timestamp ELSE start_timestamp END AS start_timestamp,
  CASE WHEN watermark_name = '{flow}' AND m IS NOT NULL THEN m ELSE end_timestamp END AS end_timestamp
FROM control, ({top}) x"""


@query(
    "wm_finish_from_result",
    MOVED.format(
        flow="flow EUROPE", top="SELECT MAX(updated_timestamp) AS m FROM advert_coded WHERE NOT holding_flag"
    ),
)
def _(t):
    # the mark moves by what the write has seen, in the same pass
    path = new_scratch(t.spark, "result")
    rows = t.advert_coded.select("creative_id", "updated_timestamp", "holding_flag").filter(~F.col("holding_flag"))
    report = write_reported(rows, lambda df: df.write.parquet(path), ts="updated_timestamp")
    moved = inc.finish_at(t.control, "flow EUROPE", report.newest, F.lit(NOW))
    # a result without rows leaves the mark alone
    same = inc.finish_from_result(
        moved, "flow ASIA", t.advert_coded, "updated_timestamp", F.lit(NOW), F.lit(False)
    )
    return same.select("watermark_name", "start_timestamp", "end_timestamp")


@query(
    "wm_advance_from_source",
    MOVED.format(
        flow="flow AFRICA",
        top="SELECT MAX(updated_timestamp) AS m FROM creative WHERE updated_timestamp > "
        "(SELECT end_timestamp FROM control WHERE watermark_name = 'flow AFRICA')",
    ),
)
def _(t):
    path = new_scratch(t.spark, "changes")
    own = t.control.filter("watermark_name = 'flow AFRICA'").agg(F.max("end_timestamp"))
    rows = t.creative.select("creative_id", "updated_timestamp").filter(F.col("updated_timestamp") > own.scalar())
    report = write_reported(rows, lambda df: df.write.parquet(path), ts="updated_timestamp")
    return inc.finish_at(t.control, "flow AFRICA", report.newest, F.lit(NOW)).select("watermark_name", "start_timestamp", "end_timestamp")


@query(
    "wm_ts_begin_finish",
    """
SELECT c.watermark_name, b.start_ts,
  CASE WHEN c.watermark_name = 'flow AMERICA' THEN b.start_ts ELSE c.start_timestamp END AS start_timestamp,
  CASE WHEN c.watermark_name = 'flow AMERICA' THEN TIMESTAMP '2024-01-25 00:00:00' ELSE c.end_timestamp END
    AS end_timestamp
FROM control c, (SELECT end_timestamp AS start_ts FROM control WHERE watermark_name = 'flow AMERICA') b
""",
)
def _(t):
    start = inc.begin_ts(t.control, "flow AMERICA")
    moved = inc.finish_ts(
        t.control, "flow AMERICA", start.scalar(), F.lit(dt.datetime(2024, 1, 25)), F.lit(NOW)
    )
    return moved.withColumn("start_ts", start.scalar()).select(
        "watermark_name", "start_ts", "start_timestamp", "end_timestamp"
    )


@query(
    "version_range_for_ts",
    """
SELECT (SELECT version FROM manifest WHERE committed_at <= TIMESTAMP '2024-01-10 12:00:00'
    ORDER BY committed_at DESC, version DESC LIMIT 1) AS start_version,
  (SELECT version FROM manifest ORDER BY committed_at DESC, version DESC LIMIT 1) AS end_version,
  (SELECT committed_at FROM manifest ORDER BY committed_at DESC, version DESC LIMIT 1) AS end_committed_at
""",
)
def _(t):
    return version_range(t.manifest, F.lit(dt.datetime(2024, 1, 10, 12)))


@query(
    "wm_seed_missing",
    """
SELECT watermark_name, end_timestamp, last_commit_version, transaction_status FROM control
UNION ALL
SELECT DISTINCT 'flow ' || n, TIMESTAMP '1900-01-01 00:00:00', CAST(NULL AS BIGINT), 'SUCCEEDED'
FROM (SELECT r_name AS n FROM region UNION ALL SELECT c_mktsegment FROM customer)
WHERE 'flow ' || n NOT IN (SELECT watermark_name FROM control)
""",
)
def _(t):
    names = t.region.select(F.col("r_name").alias("n")).unionByName(
        t.customer.select(F.col("c_mktsegment").alias("n"))
    )
    processes = names.select(F.concat(F.lit("flow "), "n").alias("watermark_name"))
    start = F.lit(dt.datetime(1900, 1, 1))
    return inc.seed_missing(t.control, processes, start, F.lit(NOW)).select(
        "watermark_name", "end_timestamp", "last_commit_version", "transaction_status"
    )


@query(
    "wm_init_at_max",
    """
SELECT 'mark' AS kind, watermark_name AS name, CASE WHEN watermark_name = 'flow ASIA'
  THEN (SELECT MAX(change_dt) FROM product_map) ELSE end_timestamp END AS end_timestamp FROM control
""",
)
def _(t):
    seeded = inc.init_at_max(t.control, "flow ASIA", t.product_map, "change_dt", F.lit(NOW))
    mark = seeded.filter("watermark_name = 'flow ASIA'").agg(F.max("end_timestamp"))
    # the first run reads nothing
    first_run = inc.changes_since_ts(t.product_map, "change_dt", mark.scalar()).select(
        F.lit("row").alias("kind"), F.col("mapping_hash").alias("name"),
        F.col("change_dt").alias("end_timestamp"),
    )
    marks = seeded.select(
        F.lit("mark").alias("kind"), F.col("watermark_name").alias("name"), "end_timestamp"
    )
    return marks.unionByName(first_run)


@query(
    "changes_from_two",
    """
SELECT creative_id FROM first_seen WHERE updated_timestamp > TIMESTAMP '2024-02-01 00:00:00'
UNION
SELECT creative_id FROM creative WHERE updated_timestamp > TIMESTAMP '2024-01-28 00:00:00'
""",
)
def _(t):
    return inc.changed_ids(
        (t.first_seen, "creative_id", "updated_timestamp", F.lit(NOW)),
        (t.creative, "creative_id", "updated_timestamp", F.lit(dt.datetime(2024, 1, 28))),
    )


@query(
    "reread_held",
    """
SELECT component_coding_id, creative_id, modified FROM component WHERE modified > TIMESTAMP '2000-01-01 00:00:00'
UNION
SELECT c.component_coding_id, creative_id, modified FROM component c
JOIN component_held h ON h.component_coding_id = c.component_coding_id
""",
)
def _(t):
    changed = F.col("modified") > F.lit(dt.datetime(2000, 1, 1))
    return inc.reread_held(t.component, changed, t.component_held, "component_coding_id").select(
        "component_coding_id", "creative_id", "modified"
    )


@query(
    "seed_modes",
    """
WITH changed AS (SELECT creative_url_hash FROM creative WHERE updated_timestamp > TIMESTAMP '2024-02-01 00:00:00'),
new AS (SELECT s.creative_url_hash, s.creative_id AS reserved_id FROM registry s JOIN creative c
  ON c.creative_id = s.creative_id WHERE c.created_timestamp > TIMESTAMP '2023-07-01 00:00:00'),
upd AS (
  SELECT creative_url_hash, creative_id AS reserved_id FROM registry
    WHERE creative_url_hash IN (SELECT creative_url_hash FROM changed)
  UNION
  SELECT child_creative_url_hash, child_creative_id FROM dedupe_map
    WHERE parent_creative_url_hash IN (SELECT creative_url_hash FROM changed))
SELECT 'NEW' AS mode, * FROM new UNION ALL SELECT 'UPDATE', * FROM upd
UNION ALL SELECT 'ALL', * FROM (SELECT * FROM new UNION SELECT * FROM upd)
""",
)
def _(t):
    from sightline.plans.seeding import ALL, NEW, UPDATE, seed_anchors

    created = t.creative.select("creative_id", F.col("created_timestamp").alias("updated_timestamp"))
    staging = t.registry.select("creative_id", "creative_url_hash").join(created, "creative_id")
    parts = [
        seed_anchors(
            mode, staging, t.creative, t.dedupe_map,
            new_since=F.lit(dt.datetime(2023, 7, 1)), update_since=F.lit(NOW),
        ).select(F.lit(mode).alias("mode"), "creative_url_hash", "reserved_id")
        for mode in (NEW, UPDATE, ALL)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
