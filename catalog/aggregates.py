"""Aggregations (section 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from sightline.functions import jsons, nested
from sightline.operators import collect


@query(
    "agg_summary",
    """
SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day, MIN(l_shipdate) AS first_run,
  MAX(l_shipdate) AS last_run, COUNT(*) AS occ_cnt
FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY ALL
""",
)
def _(t):
    ts = F.col("l_shipdate").cast("timestamp")
    return (
        t.lineitem.filter(F.col("l_linestatus").isNotNull())
        .groupBy("l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("day"))
        .agg(
            F.min(ts).alias("first_run"), F.max(ts).alias("last_run"),
            F.count(F.lit(1)).alias("occ_cnt"),
        )
    )


@query(
    "agg_collapse",
    """
SELECT l_orderkey, MAX(l_suppkey) AS l_suppkey, arg_min(l_shipdate, k) AS shipped,
  arg_min(l_tax, k) AS l_tax, string_agg(l_partkey, '|' ORDER BY l_partkey) AS parts
FROM (SELECT *, (l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity) AS k FROM lineitem)
GROUP BY l_orderkey
""",
)
def _(t):
    tie = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    rows = t.lineitem.select(
        "l_orderkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("shipped"), "l_tax",
        F.col("l_partkey").alias("parts"), tie.alias("tie"),
    )
    one = collect.collapse(
        rows, ["l_orderkey"], tie=F.col("tie"), lists=["parts"], maxima=["l_suppkey"]
    )
    return one.withColumn("parts", nested.sorted_ids(F.col("parts"))).drop("tie")


@query(
    "agg_filtered",
    """
SELECT l_orderkey, COUNT(*) AS n_rows, COUNT(x) AS n_kept,
  string_agg(x, '|' ORDER BY x) FILTER (WHERE x IS NOT NULL) AS kept
FROM (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN l_partkey END AS x FROM lineitem)
GROUP BY l_orderkey
""",
)
def _(t):
    kept = F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))
    return (
        t.lineitem.groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.collect_list(kept).alias("a"))
        .select(
            "l_orderkey",
            "n_rows",
            F.size("a").cast("bigint").alias("n_kept"),
            F.when(F.size("a") > 0, nested.sorted_ids(F.col("a"))).alias("kept"),
        )
    )


@query(
    "agg_ordered_list",
    """
SELECT l_orderkey, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts
FROM lineitem GROUP BY l_orderkey
""",
)
def _(t):
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    parts = collect.ordered_list(order, F.col("l_partkey").cast("string"))
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(parts, ",").alias("parts"))


@query(
    "agg_sorted_join",
    """
SELECT l_orderkey, string_agg(l_partkey, '|' ORDER BY l_partkey) AS ids FROM lineitem GROUP BY l_orderkey
""",
)
def _(t):
    ids = nested.sorted_ids(F.collect_list("l_partkey"))
    return t.lineitem.groupBy("l_orderkey").agg(ids.alias("ids"))


@query(
    "agg_all_or_null",
    """
SELECT l_orderkey, CASE WHEN COUNT(x) = COUNT(*) THEN string_agg(x, '|' ORDER BY x) END AS codes
FROM (SELECT l_orderkey, CASE WHEN l_partkey % 11 <> 0 THEN l_partkey + 100000 END AS x FROM lineitem)
GROUP BY l_orderkey
""",
)
def _(t):
    code = F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey") + 100000)
    codes = collect.all_or_null(code, nested.sorted_ids(F.collect_list(code)))
    return t.lineitem.groupBy("l_orderkey").agg(codes.alias("codes"))


@query(
    "agg_conditional",
    """
SELECT l_suppkey, CAST(COUNT_IF(l_returnflag = 'R') AS BIGINT) AS returned,
  MAX(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS last_open,
  COUNT(CASE WHEN l_discount > 0.05 THEN 1 END) AS discounted,
  MIN(CASE WHEN l_tax = 0 THEN l_partkey END) AS first_untaxed
FROM lineitem GROUP BY l_suppkey
""",
)
def _(t):
    shipped = F.col("l_shipdate").cast("timestamp")
    return t.lineitem.groupBy("l_suppkey").agg(
        collect.count_where(F.col("l_returnflag") == "R").alias("returned"),
        collect.max_where(F.col("l_linestatus") == "O", shipped).alias("last_open"),
        collect.count_where(F.col("l_discount") > 0.05).alias("discounted"),
        F.min(F.when(F.col("l_tax") == 0, F.col("l_partkey"))).alias("first_untaxed"),
    )


@query(
    "agg_distinct",
    """
SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers
FROM lineitem GROUP BY l_returnflag
""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers")
    )


@query("agg_global_max", "SELECT MAX(ts) AS newest, MAX(event_id) AS last_id FROM events")
def _(t):
    return t.events.agg(
        F.max("ts").cast("timestamp").alias("newest"), F.max("event_id").alias("last_id")
    )


@query(
    "agg_last_run",
    """
SELECT c.creative_id, c.media_id, MAX(s.last_run) AS last_seen_timestamp
FROM (SELECT p_partkey AS creative_id, p_size % 4 AS media_id FROM part) c
LEFT JOIN (SELECT creative_id, market_id % 4 AS media_id, last_run FROM summary_stored) s
  ON s.creative_id = c.creative_id AND s.media_id = c.media_id
GROUP BY c.creative_id, c.media_id
""",
)
def _(t):
    from sightline.plans.sync import last_runs

    creatives = t.part.select(
        F.col("p_partkey").alias("creative_id"), F.col("p_partkey").alias("creative_url_hash"),
        (F.col("p_size") % 4).alias("media_id"),
    )
    runs = t.summary_stored.select(
        "creative_id", F.col("creative_id").alias("creative_url_hash"),
        (F.col("market_id") % 4).cast("int").alias("media_id"), "last_run",
    )
    return last_runs(creatives, runs).drop("creative_url_hash")


@query(
    "agg_json_array",
    """
SELECT o_orderkey,
  CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS selected,
  CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS answer,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'cm' END AS unit, 5 AS n_keys, 1 AS n
FROM orders
""",
)
def _(t):
    from sightline.plans.sync import reshape_attributes

    grouped = F.col("o_custkey") % 2 == 0
    element = F.struct(
        F.lit("f").alias("fKey"),
        F.when(grouped, F.lit("g")).alias("gKey"),
        F.when(grouped, F.col("o_orderstatus")).alias("selectedOptValue"),
        F.col("o_orderpriority").alias("respValue"),
        F.lit("s").alias("subfKey"),
        F.when(F.col("o_custkey") % 3 == 0, "").otherwise("cm").alias("unit"),
    )
    built = reshape_attributes(F.to_json(F.array(element)))
    j = F.col("j")
    return t.orders.select("o_orderkey", built.alias("j")).select(
        "o_orderkey",
        jsons.text_at(j, "$[0].selectedOptValue").alias("selected"),
        jsons.text_at(j, "$[0].respValue").alias("answer"),
        jsons.text_at(j, "$[0].unit").alias("unit"),
        F.size(F.json_object_keys(jsons.text_at(j, "$[0]"))).alias("n_keys"),
        jsons.array_size(j).alias("n"),
    )
