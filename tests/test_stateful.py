"""Streams with state and timers: restarts, arrival order, holds that end although nothing changes."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from sightline.streaming import flows, stateful

EVENT, KNOWN = "event_id long, user_id long, ts timestamp, note string", "user_id long, segment string, since timestamp"


@pytest.fixture(scope="module")
def session(spark):
    return flows.state_session(spark, 2)


def day(n):
    return dt.datetime(2024, 1, n)


def add(session, path, rows, schema):
    session.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def streams(session, folder, **kwargs):
    made = []
    for name, schema in (("events", EVENT), ("known", KNOWN)):
        like = session.createDataFrame([], schema)
        like.write.mode("append").parquet(f"{folder}/{name}")
        made.append(flows.file_stream(session, f"{folder}/{name}", like.schema))
    return made[0], stateful.wait_for_dimension(*made, "user_id", ["event_id"], take=["segment", "since"], **kwargs)


def waiting(session, folder, events):
    return sorted(r["event_id"] for r in stateful.waiting_events(session, f"{folder}/mark", events).collect())


@pytest.mark.parametrize("salts", [1, 3])
def test_events_wait_and_leave_once(session, folder, salts):
    out = f"{folder}/out"

    def run():  # a new query from the same checkpoint each time
        events, joined = streams(session, folder, salts=salts)
        flows.copy_available(joined, f"{folder}/mark", out)
        rows = session.read.parquet(out).select("kind", "event_id", "segment", "since", "note").collect()
        return sorted(tuple(r) for r in rows), waiting(session, folder, events)

    big = 2**60 + 1  # an id that a float does not hold
    add(session, f"{folder}/events", [(1, 10, day(1), None), (big, 20, None, "é"), (3, None, day(3), "x"), (1, 10, day(1), None)], EVENT)
    assert run() == ([], [1, 3, big])
    add(session, f"{folder}/known", [(20, "b", day(9)), (30, "c", None)], KNOWN)
    first = [("out", big, "b", day(9), "é")]
    assert run() == (first, [1, 3])
    assert run() == (first, [1, 3])  # nothing new
    add(session, f"{folder}/events", [(big, 20, None, "again"), (4, 30, day(4), "y"), (1, 10, day(2), "copy")], EVENT)
    add(session, f"{folder}/known", [(10, "a", day(1))], KNOWN)
    assert run() == (sorted([*first, ("out", 1, "a", day(1), None), ("out", 4, "c", None, "y")]), [3])


def test_state_does_not_depend_on_the_worker_clock_zone(session, folder):
    events, _ = streams(session, folder)
    with pytest.raises(ValueError, match="nested"):
        stateful.wait_for_dimension(events.withColumn("a", F.array("ts")), events, "user_id", ["event_id"])


def test_patience_ends_by_a_timer(session, folder):
    events, joined = streams(session, folder, patience=dt.timedelta(seconds=3), salts=2)
    add(session, f"{folder}/events", [(1, 10, day(1), "x"), (2, 20, day(1), "y")], EVENT)
    add(session, f"{folder}/known", [(20, "b", day(9))], KNOWN)
    end = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=9)
    flows.run_timed(joined, f"{folder}/mark", flows.changed_rows(f"{folder}/out"), end)
    rows = flows.rows_so_far(session, f"{folder}/out", joined.schema).select("kind", "event_id", "segment").collect()
    assert sorted(map(tuple, rows)) == [("expired", 1, None), ("out", 2, "b")]
    assert waiting(session, folder, events) == []


def first_days(session, folder, parts, **kwargs):
    like = session.createDataFrame([], "k string, ts timestamp")
    out, seen = f"{folder}/out", None
    for rows in parts:
        add(session, f"{folder}/src", rows, "k string, ts timestamp")
        changed = stateful.first_days(flows.file_stream(session, f"{folder}/src", like.schema), ["k"], "ts", **kwargs)
        flows.run_available(changed, f"{folder}/mark", flows.changed_rows(out), "update")
        seen = changed.schema
    newest = flows.newest_rows(session, out, seen, ["k", "_salt"])
    return sorted((tuple(r) for r in stateful.first_days_of(newest, ["k"]).collect()), key=str)


def test_first_days_do_not_depend_on_arrival(session, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), None if rng.random() < 0.1 else day(rng.randint(1, 25)) + dt.timedelta(hours=rng.randint(0, 23)))
            for _ in range(90)]
    want = []
    for key in {k for k, _ in rows}:
        days = [ts.date() for k, ts in rows if k == key and ts]
        first = min(days)
        want.append((key, sum(k == key for k, _ in rows), first, sum((d - first).days < 7 for d in days)))
    want.sort(key=str)
    orders = [rows, sorted(rows, key=lambda r: str(r[1])), sorted(rows, key=lambda r: str(r[1]), reverse=True)]
    for i, (order, salts) in enumerate(itertools.product(orders, [1, 3])):
        if (i, salts) in ((0, 1), (3, 3), (4, 1)):
            parts = [order[:30], order[30:60], order[60:]]
            assert first_days(session, str(tmp_path / str(i)), parts, salts=salts) == want


def test_only_changed_groups_leave_a_batch(session, folder):
    add(session, f"{folder}/src", [("a", day(1)), ("b", day(2))], "k string, ts timestamp")
    like = session.createDataFrame([], "k string, ts timestamp").schema

    def run():
        counted = flows.file_stream(session, f"{folder}/src", like).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"))
        flows.run_available(counted, f"{folder}/mark", flows.changed_rows(f"{folder}/out"), "update")
        return counted.schema

    run()
    add(session, f"{folder}/src", [("b", day(1))], "k string, ts timestamp")
    schema = run()
    written = flows.rows_so_far(session, f"{folder}/out", schema).select("version", "k", "n").collect()
    assert sorted(map(tuple, written)) == [(0, "a", 1), (0, "b", 1), (1, "b", 2)]
    newest = flows.newest_rows(session, f"{folder}/out", schema, ["k"]).collect()
    assert sorted(map(tuple, newest)) == [("a", 1, day(1)), ("b", 2, day(1))]


def test_hold_ends_although_no_row_changes(session, folder):
    schema = "id long, until timestamp, changed timestamp, v string"
    start = dt.datetime.now(dt.timezone.utc)
    far = start + dt.timedelta(days=9)
    add(session, f"{folder}/src", [(1, None, day(1), "free"), (2, start - dt.timedelta(1), day(1), "over"),
                                   (4, far, day(1), "far"), (5, far, day(2), "new"), (5, None, day(1), "old"), (6, far, None, "held")], schema)
    like = session.createDataFrame([], schema)

    def run(until):
        rows = flows.file_stream(session, f"{folder}/src", like.schema)
        held = stateful.hold_until(rows, ["id"], F.col("until"), F.col("changed"))
        flows.run_timed(held, f"{folder}/mark", flows.changed_rows(f"{folder}/out"), until)
        got = flows.rows_so_far(session, f"{folder}/out", held.schema).select("released_by_timer", "id", "v").collect()
        return sorted(map(tuple, got)), sorted((r["id"], r["v"]) for r in stateful.held_rows(session, f"{folder}/mark", like).collect())

    free = [(False, 1, "free"), (False, 2, "over")]
    assert run(start) == (free, [(4, "far"), (5, "new"), (6, "held")])
    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=30)
    add(session, f"{folder}/src", [(3, soon, day(1), "soon")], schema)
    assert run(start) == (free, [(3, "soon"), (4, "far"), (5, "new"), (6, "held")])
    assert run(soon) == (free + [(True, 3, "soon")], [(4, "far"), (5, "new"), (6, "held")])
    add(session, f"{folder}/src", [(6, None, day(3), "changed")], schema)
    assert run(start) == (sorted(free + [(True, 3, "soon"), (False, 6, "changed")]), [(4, "far"), (5, "new")])


def groups_of(session, folder, name):
    state = session.read.format("statestore").option("stateVarName", name).load(f"{folder}/mark")
    return state.select("key").distinct().count(), state.count()


def test_held_keys_share_groups_of_state(session, folder):
    schema, far = "id double, until timestamp, changed timestamp", dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=9)
    add(session, f"{folder}/src", [(float(i), far, day(1)) for i in range(60)] + [(float("nan"), far, day(2)), (None, far, day(1))], schema)
    like = session.createDataFrame([], schema)

    def run():
        rows = flows.file_stream(session, f"{folder}/src", like.schema)
        held = stateful.hold_until(rows, ["id"], F.col("until"), F.col("changed"), groups=3)
        flows.run_timed(held, f"{folder}/mark", flows.changed_rows(f"{folder}/out"), dt.datetime.now(dt.timezone.utc))
        return flows.rows_so_far(session, f"{folder}/out", held.schema).count()

    assert run() == 0
    assert groups_of(session, folder, stateful.HELD) == (3, 62)
    add(session, f"{folder}/src", [(float("nan"), None, day(3)), (5.0, None, day(3))], schema)
    assert run() == 2
    assert stateful.held_rows(session, f"{folder}/mark", like).count() == 60


def test_waiting_keys_share_groups_of_state(session, folder):
    add(session, f"{folder}/events", [(i, i % 40, day(1), None) for i in range(80)], EVENT)
    events, joined = streams(session, folder, salts=2, groups=2)
    flows.copy_available(joined, f"{folder}/mark", f"{folder}/out")
    assert groups_of(session, folder, stateful.WAITING) == (4, 80)
    add(session, f"{folder}/known", [(7, "b", day(9))], KNOWN)
    flows.copy_available(streams(session, folder, salts=2, groups=2)[1], f"{folder}/mark", f"{folder}/out")
    assert sorted(r["event_id"] for r in session.read.parquet(f"{folder}/out").collect()) == [7, 47]
    assert waiting(session, folder, events) == [i for i in range(80) if i % 40 != 7]


def test_days_are_counted_before_the_shuffle():
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"k": ["a", None, "a"] * 50, "_salt": [0] * 150, "_day": [dt.date(2024, 1, 1)] * 150, "_n": [1] * 150})
    found = [row for batch in stateful._combined(iter([rows, rows])) for row in batch.to_pylist()]
    assert sorted((str(r["k"]), r["_n"]) for r in found) == [("None", 100), ("a", 200)]
