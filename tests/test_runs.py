"""Runs under a mark, id blocks, and updates that touch only some months."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sightline.plans import events, runs
from sightline.sources.tables import Tables

NOW = dt.datetime(2024, 1, 1)


def total(tables):
    """Step: new rows are appended to one table and added to a running sum in another."""

    def step(changes, version):
        stored = tables.replaced("sums", before=version)
        old = changes.limit(0).selectExpr("k", "n") if stored is None else stored.select("k", "n")
        sums = old.union(changes.selectExpr("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
        return {"rows": changes.select("k", "n"), "sums": sums}

    return step


def source(spark, tables, batches):
    for i, rows in enumerate(batches):
        tables.write("source", spark.createDataFrame(rows, "k int, n long"), i + 1)


def state(tables):
    both = tables.appended("rows"), tables.replaced("sums")
    return tuple(sorted(tuple(r) for r in t.select("k", "n").collect()) for t in both)


@pytest.mark.parametrize("broken", ["rows", "sums", "control/finish", "after sums"])
def test_run_that_stops_is_finished_by_the_next(spark, folder, broken):
    first, more = [(1, 1), (2, 5)], [(1, 10)]
    clean, faulty = Tables(spark, folder + "/a"), Tables(spark, folder + "/b")
    source(spark, clean, [first])
    assert runs.Marked(clean, "source", "p").run(total(clean), NOW) == 1
    source(spark, clean, [first, more])
    assert runs.Marked(clean, "source", "p").run(total(clean), NOW) == 2
    assert runs.Marked(clean, "source", "p").run(total(clean), NOW) is None

    source(spark, faulty, [first])
    real, stopped = Tables.write, []

    def write(self, name, df, version, **kwargs):
        at = f"{name}/finish" if name == "control" and version % 2 == 0 else name
        if at == broken and not stopped:
            stopped.append(at)
            raise RuntimeError("stopped")
        real(self, name, df, version, **kwargs)
        if f"after {name}" == broken and not stopped:
            stopped.append(broken)
            raise RuntimeError("stopped")

    Tables.write = write
    try:
        with pytest.raises(RuntimeError):
            runs.Marked(faulty, "source", "p").run(total(faulty), NOW)
        source(spark, faulty, [first, more])  # the source grows before the run is repeated
        assert runs.Marked(faulty, "source", "p").run(total(faulty), NOW) == 1
        assert runs.Marked(faulty, "source", "p").run(total(faulty), NOW) == 2
    finally:
        Tables.write = real
    assert state(faulty) == state(clean)


def test_id_blocks_do_not_overlap_and_repeat_for_their_owner(spark, folder):
    tables = Tables(spark, folder)
    take = lambda owner, n: runs.reserve_ids(tables, "blocks", owner, n, 100)
    assert [take("a", 10), take("b", 5), take("a", 10), take("c", 1)] == [100, 110, 100, 115]


def test_reaction_rewrites_only_touched_months(spark, tables, folder):
    gold, path = tables.gold_event, folder + "/gold"
    month = "capture_month"
    if month not in gold.columns:
        gold = gold.withColumn(month, (F.col("occurrence_id") % 12).cast("int"))
    # one month more, which no creative change can touch
    quiet = gold.limit(5).withColumns(
        {month: F.lit(199001), "occurrence_id": -F.col("occurrence_id"), "creative_id": F.lit(-1).cast("bigint"),
         "provider_original_creative_url_hash": F.lit(-1).cast("bigint"), "delete_flag": F.lit(False)}
    )
    gold = gold.withColumn(month, F.col(month).cast("int"))
    gold.unionByName(quiet).write.partitionBy(month).parquet(path)
    since, now = F.lit(dt.datetime(2024, 1, 10)), F.lit(dt.datetime(2024, 2, 1))
    before = spark.read.parquet(path)
    columns = ["occurrence_id", "creative_id", "provider_parent_creative_url_hash", "delete_flag"]
    want = events.react_to_creatives(before, tables.creative, tables.dedupe_map, since, now).select(columns)
    want = sorted(map(tuple, want.collect()), key=str)
    files = set(os.listdir(f"{path}/{month}=199001"))
    assert events.react_in_place(path, tables.creative, tables.dedupe_map, since, now, month) > 0
    assert set(os.listdir(f"{path}/{month}=199001")) == files
    assert sorted(map(tuple, spark.read.parquet(path).select(columns).collect()), key=str) == want
