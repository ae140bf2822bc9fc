"""Landing, versioned tables and refresh."""

import bz2
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sightline.operators.buckets import BucketedState
from sightline.sources import landing, refresh
from sightline.sources.tables import Tables
from sightline.streaming import flows

NOW = dt.datetime(2024, 1, 1)


def line(n):
    return json.dumps({"n": n, "occurrence": {"creative": {"url": f"http://h{n}.x.mp4"}}})


def staged(spark, folder):
    rows = landing.json_array_rows(landing.land_json_lines(spark, folder))
    return landing.staging_rows(rows, F.lit(NOW))


def test_both_kinds_of_files(spark, tmp_path):
    two_streams = bz2.compress(f"{line(1)}\n".encode()) + bz2.compress(f"{line(2)}\n".encode())
    (tmp_path / "packed.json.bz2").write_bytes(two_streams)
    plain = f"  {line(3)}  \n\n[{line(4)}, {line(5)}]\n{{broken\n{line(6)}"
    (tmp_path / "plain.json.bz2").write_text(plain)
    (tmp_path / "other.txt").write_text(line(7))
    out = staged(spark, str(tmp_path)).collect()
    got = {}
    for r in out:
        name = r["source_filename"].rsplit("/", 1)[-1]
        got.setdefault(name, {})[r["record_index"]] = json.loads(r["json_data"])["n"]
        assert r["blob_name"].endswith(".bz2")
        assert r["creative_url_hash"] is not None
    assert got == {"packed.json": {0: 1, 1: 2}, "plain.json": {0: 3, 1: 4, 2: 5, 3: 6}}
    bad = landing.rejected_lines(landing.land_json_lines(spark, str(tmp_path)))
    assert [r["value"] for r in bad.collect()] == ["{broken"]


def test_index_over_many_blocks_of_one_file(spark, tmp_path):
    n = 30000
    body = "".join(f'{{"n":{i},"pad":"{(i * 7919) % 99991:040d}{i * i}"}}\n' for i in range(n))
    (tmp_path / "big.json.bz2").write_bytes(bz2.compress(body.encode(), 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        rows = staged(spark, str(tmp_path))
        got = [(r["record_index"], json.loads(r["json_data"])["n"]) for r in rows.collect()]
        blocks = landing.land_json_lines(spark, str(tmp_path)).select("block_start").distinct()
        assert blocks.count() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == [(i, i) for i in range(n)]


def test_empty_folder(spark, tmp_path):
    assert landing.land_json_lines(spark, str(tmp_path)).count() == 0


def test_versions_by_filters(spark, folder):
    tables = Tables(spark, folder)
    assert tables.newest("t") is None and tables.appended("t") is None and tables.replaced("t") is None
    tables.write("t", spark.range(50), 1)
    tables.write("t", spark.range(3), 1)  # the same version again, as after a failure
    tables.write("t", spark.range(3, 5), 2)
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(tables.appended("t")) == [0, 1, 2, 3, 4]
    assert ids(tables.appended("t", upto=1)) == [0, 1, 2]
    assert ids(tables.appended("t", after=1, upto=2)) == [3, 4]
    assert ids(tables.appended("t", after=2, upto=2)) == []
    assert ids(tables.appended("t", before=2)) == [0, 1, 2]
    plan = tables.appended("t", after=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan
    assert ids(tables.replaced("t")) == [3, 4] and ids(tables.replaced("t", upto=1)) == [0, 1, 2]
    tables.write("t", spark.range(0), 3)  # an empty load replaces the table by nothing
    assert tables.newest("t") == 3 and ids(tables.replaced("t")) == [] and len(ids(tables.appended("t"))) == 5
    tables.write("t", spark.range(9, 10).withColumn("more", F.lit("x")), 4)
    assert [tuple(r)[:2] for r in tables.appended("t", after=1).orderBy("id").collect()] == [(3, None), (4, None), (9, "x")]


def test_refresh_keeps_old_data_on_failure(spark, folder):
    tables = Tables(spark, folder)
    refresh.refresh_table(tables, "t", spark.range(3).withColumn("b", F.lit(bytearray(b"hi"))), 1)
    assert tables.replaced("t").first()["b"] == "aGk="
    with pytest.raises(refresh.SchemaDrift):
        refresh.refresh_table(tables, "t", spark.range(9), 2)
    with pytest.raises(refresh.SchemaDrift):
        refresh.refresh_table(tables, "t", spark.range(9).selectExpr("cast(id as int) id", "'x' b"), 2)
    assert tables.replaced("t").count() == 3
    refresh.refresh_table(tables, "t", spark.range(4).selectExpr("id", "'x' b", "1 c"), 2)
    assert "c" in tables.replaced("t").columns and "c" not in tables.replaced("t", upto=1).columns
    with pytest.raises(KeyError):
        refresh.refresh_many(tables, {"t": spark.range(1)}, 3, ["u"])
    failing = spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("id"))
    with pytest.raises(Exception):
        refresh.refresh_many(tables, {"v": failing, "w": spark.range(1)}, 3)
    assert tables.replaced("v") is None and tables.replaced("w") is None


def test_remote_filter_is_pushed_down(spark, folder):
    path = folder + "/r"
    spark.range(10).select("id", F.timestamp_seconds("id").alias("u")).write.parquet(path)
    df = refresh.read_remote_table(
        spark, {"path": path}, "u", dt.datetime(1970, 1, 1, 0, 0, 5), format="parquet"
    )
    assert df.count() == 4
    assert "GreaterThan(u" in df._jdf.queryExecution().executedPlan().toString()


def test_remote_reads_are_split_by_the_changed_rows(spark, folder):
    path = folder + "/r"
    spark.range(100).select("id", F.timestamp_seconds("id").alias("u")).write.parquet(path)
    since = dt.datetime(1970, 1, 1, 0, 0, 39)
    rows = spark.read.parquet(path).filter(F.col("u") > F.lit(since))
    assert refresh.split_options(rows, "id", 8) == {"partitionColumn": "id", "lowerBound": "40", "upperBound": "99", "numPartitions": "8"}
    assert refresh.split_options(rows, "u", 2)["lowerBound"] == "1970-01-01 00:00:40"
    assert refresh.split_options(rows.limit(0), "id", 8) == {}
    df = refresh.read_remote_table(spark, {"path": path}, "u", since, format="parquet", split=("id", 8))
    assert df.count() == 60


def test_batch_that_fails_after_its_write_is_not_applied_twice(spark, folder):
    src = folder + "/src"
    spark.range(10).selectExpr("id % 3 as k", "1L as n").write.parquet(src)
    state = BucketedState(spark, folder + "/sum", ["k"], "k long, n long", 4)
    handle = flows.merge_batches(state, flows.running_summary(["k"], add=["n"], low=[], high=[]))
    failed = []

    def breaks_once(batch, key):
        handle(batch, key)
        if not failed:
            failed.append(key)
            raise RuntimeError("stopped before the position moved")

    def run():
        stream = flows.file_stream(spark, src, spark.read.parquet(src).schema)
        flows.run_available(stream, folder + "/mark", breaks_once)

    with pytest.raises(Exception):
        run()
    run()
    spark.range(2).selectExpr("id as k", "1L as n").write.mode("append").parquet(src)
    run()
    assert {r["k"]: r["n"] for r in state.read().collect()} == {0: 5, 1: 4, 2: 3}


def test_two_consumers_of_one_table_do_not_share_batch_names(spark, folder):
    src, out = folder + "/src", folder + "/rows"
    spark.range(5).write.parquet(src)
    handle = flows.append_once(out, ["id"], [F.asc("id")])

    def run(mark):
        flows.run_available(flows.file_stream(spark, src, spark.read.parquet(src).schema), mark, handle)

    run(folder + "/mark1")
    spark.range(5, 8).write.mode("append").parquet(src)
    run(folder + "/mark2")  # a new checkpoint counts its batches from 0 again
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(8))


def test_append_once_reads_row_groups_of_the_batch_keys_only(spark, folder):
    out = folder + "/rows"
    handle = flows.append_once(out, ["id"], [F.asc("id")])
    for number in range(4):
        handle(spark.range(number * 1000, number * 1000 + 1000), flows.BatchKey("a", number))
    handle(spark.range(3500, 4500).union(spark.range(3500, 3600)), flows.BatchKey("a", 4))
    handle(spark.range(3500, 4500), flows.BatchKey("a", 4))  # again, as after a failure
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(4500))
    stored = flows.rows_so_far(spark, out, spark.range(1).schema, flows.BatchKey("a", 4)).filter(F.col("id").between(3500, 4499))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,3500)" in plan and "LessThanOrEqual(id,4499)" in plan


def test_stream_lands_both_kinds_of_files_and_archives_them(spark, tmp_path):
    source, archive, out = tmp_path / "in", tmp_path / "done", str(tmp_path / "staging")
    source.mkdir()

    def run():
        files = flows.landed_files(spark, str(source), max_files=1, archive=str(archive))
        flows.run_available(files, str(tmp_path / "mark"), flows.land_batches(out, NOW))

    (source / "packed.json.bz2").write_bytes(bz2.compress(f"{line(1)}\n".encode()))
    (source / "plain.json.bz2").write_text(f"[{line(2)},{line(3)}]\n{line(4)}")
    run()
    (source / "late.json.bz2").write_text(line(5))
    run()
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted(json.loads(r["json_data"])["n"] for r in rows) == [1, 2, 3, 4, 5]
    plain = {json.loads(r["json_data"])["n"]: r["record_index"] for r in rows if "plain" in r["blob_name"]}
    assert plain == {2: 0, 3: 1, 4: 2}
    assert any(archive.rglob("*.bz2"))


def test_late_rows_are_kept_apart(spark, folder):
    out, late = folder + "/on_time", folder + "/late"
    day = lambda n: dt.datetime(2024, 1, n)
    handle = flows.once_within(out, late, ["k"], "ts", dt.timedelta(days=2))
    batches = [[(1, day(10)), (1, day(10)), (2, day(9))], [(2, day(10)), (3, day(1)), (4, day(8))], [(5, None), (1, day(11))]]
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k int, ts timestamp")
        for _ in range(2):  # a batch that runs again changes nothing
            handle(df, flows.BatchKey("a", number))
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2, 4, 5]
    assert [r["k"] for r in spark.read.parquet(late).collect()] == [3]


def test_names_of_stores():
    assert landing.library_uri("s3a://b/x") == "s3://b/x"
    assert landing.library_uri("wasbs://c@a/x") == "abfss://c@a/x"
    assert landing.library_uri("file:/tmp/x") == "file:/tmp/x"
    assert landing.library_uri("/tmp/x") == "file:///tmp/x"
    with pytest.raises(ValueError, match="ftp"):
        landing.library_uri("ftp://h/x")


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from sightline.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_more_deliveries_come_in_more_files(spark, tmp_path, monkeypatch):
    import os
    from types import SimpleNamespace

    from catalog import landing as queries

    monkeypatch.setattr(queries, "ROWS_PER_FILE", 10)
    rows = spark.range(95).select(F.to_json(F.struct("id")).alias("json_data"))
    for files, expected in ((4, 12), (20, 20)):
        folder = queries.landed_folder(SimpleNamespace(spark=spark), rows, files, str(tmp_path / str(files)))
        assert sum(name.endswith(".bz2") for name in os.listdir(folder)) == expected
        assert landing.land_json_lines(spark, folder).distinct().count() == 95
