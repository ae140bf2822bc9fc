"""Streaming flows (section 2.13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.projections import HOLD_NOW, HOLD_SQL, hold_columns, hold_reason_of
from catalog.registry import query
from sightline.constants import NO_END
from sightline.functions import rules
from sightline.operators.buckets import BucketedState
from sightline.session import new_scratch
from sightline.streaming import flows, stateful


def feed(t, rows, run, session=None, backwards: bool = False) -> None:
    """Append rows to a folder part by part and run the consumer after each."""
    path = new_scratch(t.spark, "stream")
    part = F.floor((F.dayofmonth("ts") - 1) / 10)
    for number in reversed(range(4)) if backwards else range(4):
        rows.filter(part == number).write.mode("append").parquet(path)
        run(flows.file_stream(session or t.spark, path, rows.schema))


def mark(t) -> str:
    return new_scratch(t.spark, "mark")


@query("stream_land", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    # the given table itself is the stream's source
    source = flows.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet")
    out = new_scratch(t.spark, "landed")
    position = mark(t)
    for _run in range(2):  # the second run finds nothing new
        flows.copy_available(source, position, out)
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@query(
    "stream_new_rows",
    """
SELECT 'slow' AS consumer, event_id FROM events UNION ALL SELECT 'fast', event_id FROM events
""",
)
def _(t):
    path = new_scratch(t.spark, "source")
    day = F.dayofmonth("ts")
    t.events.filter(day <= 15).write.parquet(path)
    outs = {name: (mark(t), new_scratch(t.spark, name)) for name in ("fast", "slow")}

    def run(name: str) -> None:
        source = flows.file_stream(t.spark, path, t.events.schema)
        flows.copy_available(source.select("event_id"), *outs[name])

    run("fast")
    t.events.filter(day > 15).write.mode("append").parquet(path)
    run("fast")
    run("slow")
    parts = [
        t.spark.read.parquet(out).select(F.lit(name).alias("consumer"), "event_id")
        for name, (_, out) in outs.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "stream_dedup",
    """
SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS rn
  FROM deliveries) WHERE rn = 1
""",
)
def _(t):
    rows = t.deliveries.select("event_id", "ts", "user_id", "event_type")
    out, position = new_scratch(t.spark, "events"), mark(t)
    handle = flows.append_once(out, ["event_id"], [F.asc("ts")])
    feed(t, rows, lambda stream: flows.run_available(stream, position, handle))
    return flows.rows_so_far(t.spark, out, rows.schema).select("event_id", "user_id", "event_type")


@query(
    "stream_near_repeats",
    "SELECT event_id, user_id, event_type, FALSE AS is_late FROM events",
)
def _(t):
    # a purchase is delivered again after one hour, inside the delay
    rows = t.deliveries.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    out, late, position = new_scratch(t.spark, "events"), new_scratch(t.spark, "late"), mark(t)
    handle = flows.once_within(out, late, ["event_id"], "ts", dt.timedelta(days=2))
    feed(t, rows, lambda stream: flows.run_available(stream, position, handle))
    parts = [
        flows.rows_so_far(t.spark, path, rows.schema).select("event_id", "user_id", "event_type", F.lit(path == late).alias("is_late"))
        for path in (out, late)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "stream_merge",
    """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_event, MAX(ts) AS ts FROM events GROUP BY user_id
""",
)
def _(t):
    from sightline.operators.merge import merge
    from sightline.operators.picks import latest_per_key

    def step(state, batch):
        newest = latest_per_key(batch, ["user_id"], "ts", F.desc("last_event"))
        # a batch may come late: only a newer event replaces the stored one
        return merge(state, newest, ["user_id"], when=lambda t, s: t("ts") < s("ts"))

    rows = t.events.select(
        "user_id", F.col("event_id").alias("last_event"), F.col("ts").cast("timestamp").alias("ts")
    )
    state = BucketedState(t.spark, new_scratch(t.spark, "users"), ["user_id"], "user_id long, last_event long, ts timestamp", 16)
    handle, position = flows.merge_batches(state, step), mark(t)
    feed(t, rows, lambda stream: flows.run_available(stream, position, handle))
    return state.read()


LATE = """
SELECT 'out' AS kind, event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'wait', event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
"""


@query("stream_late_dimension", LATE.replace("customer)", "customer WHERE c_acctbal > 0)"))
def _(t):
    # two streams: half of the dimension arrives before the last events, half after them
    session = flows.state_session(t.spark)
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    events, dimension, out, position = (new_scratch(t.spark, x) for x in ("events", "dimension", "out", "mark"))
    day, early = F.dayofmonth("ts"), F.col("c_nationkey") < 12
    known.limit(0).write.parquet(dimension)
    for new_rows, new_known in ((day <= 10, None), (day.between(11, 20), early), (day > 20, None), (None, ~early)):
        if new_rows is not None:
            rows.filter(new_rows).write.mode("append").parquet(events)
        if new_known is not None:
            known.filter(new_known).write.mode("append").parquet(dimension)
        stream = stateful.wait_for_dimension(
            flows.file_stream(session, events, rows.schema), flows.file_stream(session, dimension, known.schema), "user_id", ["event_id"]
        )
        flows.copy_available(stream, position, out)
    done = t.spark.read.parquet(out).select("kind", "event_id")
    waiting = stateful.waiting_events(session, position, rows)
    return done.unionByName(waiting.select(F.lit("wait").alias("kind"), "event_id"))


@query(
    "stream_summary",
    """
SELECT user_id, event_type, COUNT(*) AS n, MIN(ts) AS first_run, MAX(ts) AS last_run FROM events GROUP BY ALL
""",
)
def _(t):
    session = flows.state_session(t.spark)
    rows = t.events.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    key = ["user_id", "event_type"]

    def counted(stream):
        return stream.groupBy(*key).agg(
            F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_run"), F.max("ts").alias("last_run")
        )

    out, position = new_scratch(t.spark, "summary"), mark(t)
    feed(t, rows, lambda stream: flows.run_available(counted(stream), position, flows.changed_rows(out), "update"), session)
    return flows.newest_rows(t.spark, out, counted(rows).schema, key)


@query(
    "stream_first_n_days",
    """
WITH f AS (SELECT user_id, MIN(CAST(ts AS DATE)) AS first_day FROM events GROUP BY user_id)
SELECT e.user_id, COUNT(*) AS n, f.first_day, CAST(COUNT_IF(CAST(ts AS DATE) - first_day < 7) AS BIGINT) AS early
FROM events e JOIN f ON f.user_id = e.user_id GROUP BY ALL
""",
)
def _(t):
    session = flows.state_session(t.spark)
    rows = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    key = ["user_id"]
    # the last weeks arrive first
    out, position, seen = new_scratch(t.spark, "days"), mark(t), []

    def run(stream):
        parts = stateful.first_days(stream, key, "ts", days=7)
        seen.append(parts.schema)
        flows.run_available(parts, position, flows.changed_rows(out), "update")

    feed(t, rows, run, session, backwards=True)
    parts = flows.newest_rows(t.spark, out, seen[0], [*key, "_salt"])
    return stateful.first_days_of(parts, key)


@query(
    "stream_hold_timeout",
    HOLD_SQL.replace("SELECT o_orderkey, reason, reason IN", "SELECT o_orderkey, CASE WHEN reason IN")
    .replace(" AS hold FROM (", """ THEN CASE WHEN reason = 'not yet asked' AND o_orderdate + INTERVAL 48 HOUR
  <= TIMESTAMP '1998-02-01 00:00:00' THEN 'timer' ELSE 'held' END ELSE 'at once' END AS released FROM (""")
    .replace("SELECT o_orderkey, CASE WHEN o_orderdate <", "SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate <"),
)
def _(t):
    # a month after the rules' time is over in half a minute; no row changes after the first run
    session = flows.state_session(t.spark)
    columns, reason = hold_columns(), F.col("reason")
    rows = t.orders.select("o_orderkey", hold_reason_of(columns).alias("reason"), F.col("o_orderdate").cast("timestamp").alias("classified"))
    end = rules.hold_end(reason, columns | {"classified_ts": F.col("classified"), "ai_sent_ts": F.lit(NO_END).cast("timestamp")})
    path, out, position = new_scratch(t.spark, "rows"), new_scratch(t.spark, "out"), mark(t)
    rows.write.parquet(path)
    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=30)
    until = F.when(end <= F.lit(HOLD_NOW + dt.timedelta(days=31)), F.lit(soon)).when(end.isNotNull(), F.lit(NO_END).cast("timestamp"))

    def run(at):
        stream = flows.file_stream(session, path, rows.schema)
        flows.run_timed(stateful.hold_until(stream, ["o_orderkey"], until, F.col("classified")), position, flows.changed_rows(out), at)

    run(soon - dt.timedelta(seconds=30))
    run(soon + dt.timedelta(seconds=1))
    like = stateful.hold_until(flows.file_stream(session, path, rows.schema), ["o_orderkey"], until, F.col("classified")).schema
    done = flows.rows_so_far(t.spark, out, like).select(
        "o_orderkey", F.when(F.col("released_by_timer"), "timer").otherwise("at once").alias("released")
    )
    held = stateful.held_rows(session, position, rows)
    return done.unionByName(held.select("o_orderkey", F.lit("held").alias("released")))
