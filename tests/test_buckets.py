"""State by buckets: only touched buckets are read and written, batches are applied once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sightline.operators.buckets import BucketedState
from sightline.operators.merge import accumulate


def add(state, batch):
    return accumulate(state, batch, ["k", "g"], add=["n"], low=["lo"], high=["hi"])


def rows_of(spark, seed, n, keys):
    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        key = (rng.choice(keys), rng.choice(["x", None]))
        rows[key] = (*key, rng.randint(0, 9), rng.randint(0, 99), rng.randint(0, 99))
    return spark.createDataFrame(list(rows.values()), "k long, g string, n long, lo long, hi long"), rows


def state_of(spark, folder):
    return BucketedState(spark, folder + "/state", ["k", "g"], "k long, g string, n long, lo long, hi long", 8)


def found(state, **kwargs):
    return sorted((tuple(r) for r in state.read(**kwargs).collect()), key=str)


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_batches_touch_their_buckets_only(spark, folder):
    state, want = state_of(spark, folder), {}
    assert found(state) == []
    for batch, keys in enumerate([list(range(40)) + [None], [3], [7, 100], [3]]):
        delta, rows = rows_of(spark, batch, 60, keys)
        before = files(folder)
        touched = state.apply(delta, add, batch)
        again = files(folder)
        assert before <= again  # no file is changed
        assert {f.split("_bucket=")[1].split("/")[0] for f in again - before} == {str(b) for b in touched}
        assert len(touched) <= len({k for k in rows})
        for key, (_, _, n, lo, hi) in rows.items():
            old = want.get(key, (0, 10**9, -1))
            want[key] = (old[0] + n, min(old[1], lo), max(old[2], hi))
        assert found(state) == sorted(((*k, *v) for k, v in want.items()), key=str)
        if batch == 2:
            as_it_was = found(state)
            state.apply(delta, add, batch)  # the batch again, as after a failure
            assert found(state) == as_it_was
    assert found(state, before=3) == as_it_was
    state.apply(delta.limit(0), add, 4)
    assert state.forget(3) > 0
    assert found(state) == sorted(((*k, *v) for k, v in want.items()), key=str)
    assert state.forget(3) == 0


def test_scan_lists_touched_buckets_only(spark, folder):
    state = state_of(spark, folder)
    delta, _ = rows_of(spark, 1, 60, list(range(40)))
    state.apply(delta, add, 0)
    seen = []

    def step(stored, batch):
        seen.append(stored.inputFiles())
        return add(stored, batch)

    touched = state.apply(delta.limit(1), step, 1)
    assert len(touched) == 1 and {f.split("_bucket=")[1].split("/")[0] for f in seen[0]} == {str(touched[0])}


def test_a_batch_that_stops_half_way(spark, folder):
    state = state_of(spark, folder)
    delta, _ = rows_of(spark, 1, 60, list(range(40)))
    state.apply(delta, add, 0)
    once = found(state)

    def breaks(stored, batch):
        return add(stored, batch).withColumn("n", F.when(F.col("k") == 5, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("n")))

    with pytest.raises(Exception):
        state.apply(delta, breaks, 1)
    assert found(state, before=1) == once
    state.apply(delta, add, 1)
    assert found(state) == sorted(((k, g, 2 * n, lo, hi) for k, g, n, lo, hi in once), key=str)
