"""Sources, landing, refresh and sinks (section 2.1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from sightline.functions.keys import url_fingerprint
from sightline.operators.collect import write_reported
from sightline.session import materialize, new_scratch
from sightline.sources import landing, refresh
from sightline.sources.tables import Tables, sorted_by_month
from sightline.streaming import flows

NOW = dt.datetime(2024, 2, 1)


#: deliveries in one landed file: a file is packed by one task, so more rows come in more files
ROWS_PER_FILE = 50_000


def file_sets(rows, files: int) -> int:
    """How many sets of ``files`` files the rows fill; one at least."""
    return max(1, -(-rows.count() // (files * ROWS_PER_FILE)))


def landed_folder(t, rows, files: int, path: str | None = None) -> str:
    """Write JSON lines as whole sets of ``files`` bzip2 files to a shared folder, a fresh one by default."""
    path = path or new_scratch(t.spark, "landed")
    lines = rows.select(F.col("json_data").alias("value")).repartition(files * file_sets(rows, files))
    lines.write.mode("append").option("compression", "bzip2").text(path)
    return path


def store(t) -> Tables:
    return Tables(t.spark, new_scratch(t.spark, "tables"))


@query("land_json_lines", "SELECT json_data AS value FROM landed")
def _(t):
    return landing.land_json_lines(t.spark, landed_folder(t, t.landed, 4)).select("value")


@query(
    "json_array_rows",
    """
SELECT 'row' AS kind, CAST(event_id AS VARCHAR) AS id, event_type FROM events WHERE event_type <> 'signup'
UNION ALL
SELECT 'reject', '{"event_id":' || event_id, NULL FROM events WHERE event_type = 'signup'
""",
)
def _(t):
    one = F.to_json(F.struct("event_id", "event_type"))
    events = t.events.withColumn("j", one)
    arrays = (
        events.filter("event_type not in ('signup', 'error')")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.array_join(F.collect_list("j"), ",").alias("a"))
        .select(F.concat(F.lit("["), "a", F.lit("]")).alias("value"))
    )
    single = events.filter("event_type = 'error'").select(F.col("j").alias("value"))
    broken = events.filter("event_type = 'signup'").select(
        F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string")).alias("value")
    )
    lines = arrays.unionByName(single).unionByName(broken)
    rows = landing.json_array_rows(lines).select(
        F.lit("row").alias("kind"),
        F.get_json_object("json_data", "$.event_id").alias("id"),
        F.get_json_object("json_data", "$.event_type").alias("event_type"),
    )
    bad = landing.rejected_lines(lines).select(
        F.lit("reject").alias("kind"), F.col("value").alias("id"),
        F.lit(None).cast("string").alias("event_type"),
    )
    return rows.unionByName(bad)


URL_KEY = "split_part({0}, '.', 1) || '.' || split_part({0}, '.', 2) || '.' || split_part({0}, '.', -1)"


@query(
    "staging_rows",
    f"""
SELECT json_data, MIN(json_data) OVER (PARTITION BY {URL_KEY.format('u')}) AS first_of_url, TRUE AS gapless, TRUE AS named
FROM (SELECT json_data, json_extract_string(json_data, '$.occurrence.creative.url') AS u FROM landed)
""",
)
def _(t):
    # the hash has no counterpart in the SQL engine, so each row is compared by the first row of its class
    rows = landing.json_array_rows(
        landing.land_json_lines(t.spark, landed_folder(t, t.landed, 3))
    )
    staged = materialize(landing.staging_rows(rows, F.lit(NOW)), "staged")
    index, n = F.col("record_index"), F.count(F.lit(1))
    files = staged.groupBy("source_filename").agg(
        ((F.min(index) == 0) & (F.max(index) == n - 1) & (F.countDistinct(index) == n)).alias("gapless")
    )
    first = staged.groupBy("creative_url_hash").agg(F.min("json_data").alias("first_of_url"))
    named = F.col("blob_name") == F.concat("source_filename", F.lit(".bz2"))
    same = F.col("creative_url_hash").eqNullSafe(F.col("_hash"))
    return (
        staged.join(files, "source_filename")
        .join(first.withColumnRenamed("creative_url_hash", "_hash"), same)
        .select("json_data", "first_of_url", "gapless", named.alias("named"))
    )


@query(
    "url_fingerprint",
    f"""
WITH k AS (SELECT page_id, CASE WHEN html LIKE '%nav%' THEN url END AS url FROM pages)
SELECT page_id, url IS NULL AS unknown, MIN(page_id) OVER (PARTITION BY {URL_KEY.format('url')}) AS first_page FROM k
""",
)
def _(t):
    url = F.when(F.col("html").contains("nav"), F.col("url"))
    hashed = t.pages.select("page_id", url_fingerprint(url).alias("h"))
    first = hashed.groupBy("h").agg(F.min("page_id").alias("first_page")).withColumnRenamed("h", "_h")
    return hashed.join(first, F.col("h").eqNullSafe(F.col("_h"))).select("page_id", F.col("h").isNull().alias("unknown"), "first_page")


STAGED = """
SELECT json_data, json_extract_string(json_data, '$.occurrence.creative.url') IS NOT NULL AS hashed, TRUE AS gapless
FROM landed
"""


@query("land_once", STAGED)
def _(t):
    early = F.col("_version") <= 15
    folder = landed_folder(t, t.landed.filter(early), 2)
    out, mark = new_scratch(t.spark, "staging"), new_scratch(t.spark, "mark")
    # processed files are moved aside after the next batch is committed
    archive = new_scratch(t.spark, "archive")

    def run() -> None:
        files = flows.landed_files(t.spark, folder, archive=archive)
        flows.run_available(files, mark, flows.land_batches(out, NOW))

    run()
    landed_folder(t, t.landed.filter(~early), 2, folder)
    run()
    run()  # nothing new
    staged = t.spark.read.parquet(out)
    per_file = staged.groupBy("blob_name").agg(
        (F.max("record_index") + 1 == F.countDistinct("record_index")).alias("gapless")
    )
    return staged.join(per_file, "blob_name").select(
        "json_data", F.col("creative_url_hash").isNotNull().alias("hashed"), "gapless"
    )


@query("bounded_append", "SELECT json_data, 3 AS n_batches, TRUE AS bounded FROM landed")
def _(t):
    folder, out = landed_folder(t, t.landed, 6), new_scratch(t.spark, "staging")
    # a batch takes a third of the files, as with one set of six
    most_files = 2 * file_sets(t.landed, 6)
    files = flows.landed_files(t.spark, folder, max_files=most_files)
    flows.run_available(files, new_scratch(t.spark, "mark"), flows.land_batches(out, NOW))
    rows = t.spark.read.parquet(out)
    batches = rows.groupBy("version").agg(F.countDistinct("blob_name").alias("files"))
    n_batches, most = F.count(F.lit(1)).cast("int"), F.max("files")
    return rows.select(
        "json_data", batches.agg(n_batches).scalar().alias("n_batches"), (batches.agg(most).scalar() <= most_files).alias("bounded")
    )


@query("refresh_table", "SELECT p_partkey, p_name, p_size FROM part")
def _(t):
    tables = store(t)
    source = t.part.select("p_partkey", "p_name", "p_size")
    refresh.refresh_table(tables, "part", source.filter("p_size <= 25"), 1)
    refresh.refresh_table(tables, "part", source, 2)
    return tables.replaced("part")


@query(
    "normalize_types",
    """
SELECT event_id, to_base64(encode(event_type)) AS payload, ts FROM events
""",
)
def _(t):
    rows = t.events.select("event_id", F.to_binary("event_type", F.lit("utf-8")).alias("payload"), "ts")
    return refresh.normalize_types(rows)


@query(
    "evolve_additive",
    """
SELECT p_partkey, p_name, NULL AS p_brand FROM part WHERE p_size > 25
UNION ALL SELECT p_partkey, p_name, p_brand FROM part WHERE p_size <= 25
""",
)
def _(t):
    old = t.part.filter("p_size > 25").select("p_partkey", "p_name")
    new = t.part.filter("p_size <= 25").select("p_brand", "p_partkey", "p_name")
    return refresh.union_evolved(old, refresh.evolve_additive(old.schema, new))


@query(
    "refresh_many",
    """
SELECT 'customer' AS name, COUNT(*) AS n FROM customer UNION ALL SELECT 'nation', COUNT(*) FROM nation
UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
""",
)
def _(t):
    tables = store(t)
    sources = {"customer": t.customer, "nation": t.nation, "supplier": t.supplier, "part": t.part}
    done = refresh.refresh_many(tables, sources, 1, ["customer", "nation", "supplier"])
    parts = [
        tables.replaced(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in done
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "read_remote_table",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01 00:00:00'",
)
def _(t):
    # a Parquet stand-in; with format="jdbc" the same filter goes to the database
    return refresh.read_remote_table(
        t.spark, {"path": f"{t.folder}/orders.parquet"}, "o_orderdate", dt.datetime(1999, 6, 1),
        format="parquet", split=("o_orderkey", 4),
    ).select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))


@query(
    "partitioned_append",
    """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS month, COUNT(*) AS n,
  MIN(o_orderkey) AS first_key FROM orders GROUP BY 1
""",
)
def _(t):
    tables = store(t)
    rows = t.orders.select(
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month"), "o_orderkey"
    )
    for version, status in enumerate(("month < 199800", "month >= 199800")):
        batch = sorted_by_month(rows.filter(status), "month", "o_orderkey")
        tables.write("orders", batch, version, partition_by=["month"])
    return tables.appended("orders").groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key")
    )


@query(
    "as_of_read",
    """
SELECT 'as of' AS kind, event_id FROM events WHERE day(ts) <= 20
UNION ALL SELECT 'changes', event_id FROM events WHERE day(ts) > 10
""",
)
def _(t):
    tables = store(t)
    day = F.dayofmonth("ts")
    for version, low, high in ((1, 0, 10), (2, 10, 20), (3, 20, 31)):
        batch = t.events.filter((day > low) & (day <= high)).select("event_id")
        tables.write("events", batch, version)
    pinned = tables.appended("events", upto=2).select(F.lit("as of").alias("kind"), "event_id")
    changes = tables.appended("events", after=1, upto=3).select(F.lit("changes").alias("kind"), "event_id")
    return pinned.unionByName(changes)


@query(
    "run_summary",
    """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT primary_product_id) AS n_ids,
  CAST(COUNT_IF(NOT holding_flag) AS BIGINT) AS merged, CAST(COUNT_IF(holding_flag) AS BIGINT) AS held,
  MAX(CASE WHEN NOT holding_flag THEN updated_timestamp END) AS newest FROM advert_coded
""",
)
def _(t):
    # the report comes from the write itself; only distinct ids are counted on the written column
    path = new_scratch(t.spark, "merged")
    rows = t.advert_coded.select("primary_product_id", "updated_timestamp", "holding_flag")
    report = write_reported(rows, lambda df: df.write.parquet(path), ts="updated_timestamp", held=F.col("holding_flag"))
    return t.spark.read.parquet(path).agg(F.countDistinct("primary_product_id").alias("n_ids")).select(
        F.lit(report.n_rows).cast("long").alias("n_rows"), "n_ids", F.lit(report.merged).cast("long").alias("merged"),
        F.lit(report.held).cast("long").alias("held"), report.newest.alias("newest"),
    )
