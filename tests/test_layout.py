"""Bucketed tables: merges of a large source leave the table where it lies."""

import pytest
from pyspark.sql import functions as F

from sightline.operators import merge as m
from sightline.operators.layout import BucketedTable


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges_above_scan(df) -> int:
    """Exchanges between the table's scan and the root, of the plan's text tree."""
    found, path = 0, []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        while path and path[-1][0] >= depth:
            path.pop()
        path.append((depth, name))
        if "FileScan" in name and "Bucketed: true" in name:
            found += sum("Exchange" in x for _, x in path)
    return found


@pytest.mark.parametrize("kind", ["upsert", "merge", "insert_only"])
def test_repeated_merges_do_not_shuffle_the_table(spark, folder, no_broadcast, kind):
    table = BucketedTable(spark, folder + "/t", ["k"], 5)  # not the session's number of partitions
    table.load(spark.range(2000).selectExpr("id as k", "id * 2 as v"))
    step = {"upsert": lambda t, s: m.upsert(t, s, ["k"]), "merge": lambda t, s: m.merge(t, s, ["k"]),
            "insert_only": lambda t, s: m.insert_only(t, s, ["k"])}[kind]
    want = {k: 2 * k for k in range(2000)}
    for version, low in enumerate((1000, 2500)):
        source = spark.range(low, low + 1500).selectExpr("id as k", "-id as v")
        plan = step(table.read(version), table.dealt(source))
        assert "Bucketed: true" in plan._jdf.queryExecution().executedPlan().toString() and exchanges_above_scan(plan) == 0
        table.merge(source, step, version)
        table.merge(source, step, version)  # again, as after a failure
        want = {**want, **{k: -k for k in range(low, low + 1500) if kind != "insert_only" or k not in want}}
    assert {r["k"]: r["v"] for r in table.read(2).collect()} == want
    assert table.read(0).count() == 2000
    grouped = table.read(2).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert exchanges_above_scan(grouped) == 0 and grouped.filter("n > 1").count() == 0
    table.forget(0)
    table.forget(1)
    assert table.read(2).count() == len(want)


def test_without_the_layout_the_target_is_shuffled(spark, folder, no_broadcast):
    spark.range(2000).selectExpr("id as k", "id * 2 as v").write.parquet(folder + "/plain")
    plan = m.merge(spark.read.parquet(folder + "/plain"), spark.range(9).selectExpr("id as k", "id as v"), ["k"])
    assert "Exchange hashpartitioning(k" in plan._jdf.queryExecution().executedPlan().toString()
