"""Operators against brute force, also with one key that holds a third of all rows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from sightline.operators import increments as inc
from sightline.operators import merge as m
from sightline.operators.collect import write_reported
from sightline.operators.ids import assign_dense_ids
from sightline.operators.joins import near_size_join
from sightline.operators.picks import first_per_key, latest_per_key
from sightline.plans import translate

NOW = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rng.randrange(1, 400)
        rows.append((i, key, rng.choice([None, *range(50)]), rng.randrange(400), rng.randrange(300)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, k bigint, ts int, w int, h int").repartition(6)


def test_latest_per_key_with_hot_key(spark, skewed):
    best = {}
    for i, k, ts, *_ in skewed:
        rank = (ts if ts is not None else -1, -i)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, i)
    out = latest_per_key(frame(spark, skewed), ["k"], "ts", F.asc("id"))
    assert {r["k"]: r["id"] for r in out.collect()} == {k: v[1] for k, v in best.items()}
    # only the best row per task reaches the shuffle
    text = plan(out)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dense_ids_with_equal_order_values(spark, skewed):
    out = assign_dense_ids(frame(spark, skewed), ["k", "id"], 100, "n").collect()
    want = sorted((k, i) for i, k, *_ in skewed)
    assert [(r["k"], r["id"]) for r in sorted(out, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in out) == list(range(100, 100 + len(want)))


def test_size_join_matches_brute_force(spark, skewed):
    rng = random.Random(3)
    sizes = [(n, rng.randrange(-5, 410), rng.randrange(-5, 310)) for n in range(300)]
    hot = [(i, k, ts, 100 if k == 0 else w, 100 if k == 0 else h) for i, k, ts, w, h in skewed]
    out = near_size_join(
        frame(spark, hot), spark.createDataFrame(sizes, "size bigint, sw int, sh int"),
        width="w", height="h", size_width="sw", size_height="sh", tolerance=10,
    )
    want = set()
    for i, _, _, w, h in hot:
        near = [n for n, sw, sh in sizes if abs(w - sw) <= 10 and abs(h - sh) <= 10]
        want |= {(i, n) for n in near} or {(i, None)}
    got = [(r["id"], r["size"]) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_size_join_in_packs_matches_brute_force(spark, skewed):
    rng = random.Random(5)
    few = [(rng.randrange(400), rng.randrange(300)) for _ in range(12)] + [(100, 100)]
    sizes = [(n, rng.choice([None, "a", "b"]), *rng.choice(few), rng.choice("xy")) for n in range(200)]
    # packs of one place and packs of several, with rows near a pack but near none of its sizes
    sizes += [(n, "c", rng.randrange(-5, 410), rng.randrange(-5, 310), "x") for n in range(200, 500)]
    sizes += [sizes[0], (900, "a", None, 5, "x"), (901, "a", 5, 5, None)]
    rows = [
        (i, *((100, 100) if k == 0 else (w, h)), "z" if i % 7 == 1 else "x")
        for i, k, _, w, h in skewed
    ]
    rows += [rows[0], (9000, None, 5, "x"), (9001, 5, None, "x"), (9002, 100, 100, None)]
    events = spark.createDataFrame(rows, "id bigint, w int, h int, c string").coalesce(1)
    table = spark.createDataFrame(sizes, "size bigint, tag string, sw int, sh int, sc string")
    near = {
        "width": "w", "height": "h", "size_width": "sw", "size_height": "sh",
        "tolerance": 10, "equal": [("c", "sc")],
    }
    want = []
    for row in rows:
        _, w, h, c = row
        found = [
            s for s in sizes
            if None not in (w, h, s[2], s[3]) and abs(w - s[2]) <= 10 and abs(h - s[3]) <= 10
            and c == s[4]
        ]
        want += [row + s for s in found or [(None,) * 5]]
    assert len(want) > len(rows) + 2000
    for pack in (3, 1000):
        out = near_size_join(events, table, **near, pack=pack)
        assert out.columns == [*events.columns, *table.columns]
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    # sizes without columns of their own
    out = near_size_join(events, table.select("sw", "sh", "sc"), **near, pack=3)
    bare = [w[:4] + w[6:] for w in want]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(bare, key=repr)
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_size_join_in_packs_shares_a_hot_place(spark):
    # one input task and one place: many tasks make the pairs, and rows are shuffled once
    events = spark.range(2000, numPartitions=1).selectExpr("id", "100 as w", "100 as h")
    table = spark.range(300).selectExpr("id as size", "105 as sw", "95 as sh")
    out = near_size_join(
        events, table, width="w", height="h", size_width="sw", size_height="sh", tolerance=10,
        pack=20,
    )
    counts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 600_000 and max(counts) < 120_000
    left = plan(out).split("SortMergeJoin")[1].split("Exchange")
    assert "REPARTITION_BY_NUM" in left[1]


def test_range_query_makes_pairs_in_many_tasks(spark, tables):
    from catalog.registry import QUERIES

    out = QUERIES["join_range"](spark, tables.folder)
    counts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(counts) < sum(counts) / 4


def test_merge_rules(spark):
    rng = random.Random(1)
    target = [(k, rng.choice([None, 1, 2]), rng.choice([None, 5, 6])) for k in range(200)]
    source = [(k, rng.choice([None, 1, 2]), rng.choice([None, 5, 6])) for k in range(100, 300)]
    t = spark.createDataFrame(target, "k bigint, a int, b int")
    s = spark.createDataFrame(source, "k bigint, a int, b int")
    new = {k: (a, b) for k, a, b in source}
    old = {k: (a, b) for k, a, b in target}

    def result(df):
        rows = [tuple(r) for r in df.select("k", "a", "b").collect()]
        assert len(rows) == len({r[0] for r in rows})
        return {k: (a, b) for k, a, b in rows}

    assert result(m.merge(t, s, ["k"])) == {**old, **new}
    assert result(m.upsert(t, s, ["k"])) == {**old, **new}
    guarded = {
        k: new[k] if k in new and None not in (v[0], new[k][0]) and v[0] != new[k][0] else v
        for k, v in old.items()
    }
    assert result(m.merge(t, s, ["k"], when=m.differs("a"), insert=False)) == guarded
    keep = m.merge(t, s, ["k"], update=["a"], values={"b": m.keep_old_when_null("b")})
    want = {k: (new[k][0], new[k][1] if new[k][1] is not None else v[1]) if k in new else v
            for k, v in old.items()} | {k: v for k, v in new.items() if k not in old}
    assert result(keep) == want
    # a second run changes nothing
    again = m.merge(m.merge(t, s, ["k"]), s, ["k"])
    assert result(again) == {**old, **new}


def test_merge_null_safe_key(spark):
    t = spark.createDataFrame([(1, None, 10), (2, 5, 20)], "k int, p int, v int")
    s = spark.createDataFrame([(1, None, 11), (3, None, 30)], "k int, p int, v int")
    out = m.merge(t, s, ["k", "p"], null_safe=True)
    assert {tuple(r) for r in out.collect()} == {(1, None, 11), (2, 5, 20), (3, None, 30)}


def test_small_source_does_not_shuffle_the_target(spark):
    target = spark.range(0, 2_000_000, numPartitions=4).selectExpr("id as k", "id % 7 as v")
    source = spark.range(10).selectExpr("id as k", "1L as v")
    text = plan(m.merge(target, source, ["k"]))
    # only the few matched keys may be shuffled, for the inserts
    assert len(re.findall(r"BroadcastHashJoin .*Left(?:Outer|Semi)", text)) == 2
    assert not re.search(r"SortMergeJoin .*Left(?:Outer|Semi)", text)


def test_single_match(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert m.require_single_match(df, ["k"]).count() == 2
    with pytest.raises(Exception, match="more than one source row"):
        m.require_single_match(df.unionAll(df), ["k"]).collect()


def test_park_release(spark):
    buffer = spark.createDataFrame([(1,), (2,)], "k int")
    rows = spark.createDataFrame([(1, True), (2, False), (3, False), (4, True)], "k int, ok boolean")
    ok = F.col("ok")
    once = m.park_release(buffer, rows, ["k"], ok, ~ok)
    assert {r["k"] for r in once.collect()} == {2, 3}
    twice = m.park_release(once, rows, ["k"], ok, ~ok)
    assert sorted(r["k"] for r in twice.collect()) == [2, 3]


def test_batches_equal_one_batch(spark):
    rows = [(i % 5, dt.date(2024, 1, 1 + i % 20), 1) for i in range(200)]
    days = spark.createDataFrame(rows, "k int, day date, n bigint")
    empty = days.limit(0).select("k", "n")

    def add(state, part):
        return m.accumulate(state, part, ["k"], add=["n"])

    whole = add(empty, days)
    split = empty
    for low in range(1, 21, 5):
        part = days.filter((F.dayofmonth("day") >= low) & (F.dayofmonth("day") < low + 5))
        split = add(split, part)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))


def test_marks(spark):
    control = inc.seed_missing(
        inc.empty_control(spark), spark.createDataFrame([("a",), ("b",), ("a",)], "watermark_name string"),
        F.lit(dt.datetime(1900, 1, 1)), F.lit(NOW),
    )
    assert control.count() == 2
    again = inc.seed_missing(control, control, F.lit(NOW), F.lit(NOW))
    assert again.count() == 2
    pinned = inc.begin_version(control, "a", F.lit(7).cast("bigint"), F.lit(NOW))
    assert inc.read_mark(pinned, "a").last_version is None
    done = inc.finish_version(pinned, "a", F.lit(NOW))
    assert inc.read_mark(done, "a").last_version == 7
    assert inc.read_mark(done, "b").last_version is None
    assert inc.read_mark(done, "zzz").end is None


def test_translation_with_hot_product(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    known = {p for p in range(60) if p % 11}
    for i in range(600):
        extra = [0 if rng.random() < 0.5 else rng.randrange(60) for _ in range(rng.randrange(4))]
        extra = [p if rng.random() < 0.9 else 11 for p in extra]
        json = "[" + ",".join(f'{{"sort_order":{n},"product_id":{p}}}' for n, p in enumerate(extra)) + "]"
        rows.append((i, i, 1 + i % 10, json))
        codes = [p + 100 for p in extra]
        expected[i] = codes if extra and all(p in known for p in extra) else None
    base = spark.createDataFrame(
        rows, "creative_id bigint, creative_url_hash bigint, primary_product_id bigint, secondary_products string"
    )
    single = spark.createDataFrame([(p,) for p in sorted(known)], "p bigint")
    product_map = single.select(
        F.upper(F.md5(F.concat(F.col("p").cast("string"), F.lit("1")))).alias("mapping_hash"),
        F.lit(1).alias("system_id"), (F.col("p") + 100).alias("target_product_id"),
    )
    out = translate.translate_codes(base, product_map, ["creative_id"]).select(
        "creative_id",
        F.transform(
            F.from_json("vx1_secondary_products", "array<struct<product_id:bigint>>"),
            lambda e: e["product_id"],
        ).alias("codes"),
    )
    assert {r["creative_id"]: r["codes"] for r in out.collect()} == expected


def test_secondary_products_are_hashed_once_each(spark, tmp_path):
    import json

    elements = [{"sort_order": 2, "type": "t", "product_id": p} for p in (5, 5, None)]
    lists = [elements[:2], elements[:1], elements, [None, elements[0]], []]
    base = spark.createDataFrame(
        [(i, 1, json.dumps(x)) for i, x in enumerate(lists)] + [(1, 1, json.dumps(lists[1]))],
        "creative_id bigint, primary_product_id bigint, secondary_products string",
    )
    key = lambda system: F.upper(F.md5(F.concat(F.lit("5"), F.lit(system))))
    # the map names two targets for one key: both are listed, as by a plain join
    codes = spark.sql("select 1 as system_id, 7 as target_product_id union all select 1, 8 union all select 2, 9")
    codes = codes.withColumn("mapping_hash", key(F.col("system_id").cast("string")))
    out = translate.translate_codes(base, codes, ["creative_id"])
    products = lambda c: F.from_json(c, "array<struct<product_id:bigint>>")["product_id"]
    found = out.select("creative_id", products("vx1_secondary_products"), products("vx2_secondary_products")).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == {
        0: ([7, 7, 8, 8], [9, 9]), 1: ([7, 7, 8, 8], [9, 9]), 2: (None, None), 3: ([7, 8], [9]), 4: (None, None),
    }
    # one row per element, not one per element and system, goes to the code lookup, without its hash
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, (_product" in plan


def test_first_per_key_is_stable(spark, skewed):
    df = frame(spark, skewed)
    order = [F.desc_nulls_last("ts"), F.asc("id")]
    a = sorted(map(tuple, first_per_key(df, ["k"], order).collect()), key=str)
    b = sorted(map(tuple, first_per_key(df.repartition(3), ["k"], order).collect()), key=str)
    assert a == b


def test_second_source_row_fails_a_merge(spark):
    t = spark.createDataFrame([(1, 10)], "k int, v int")
    twice = spark.createDataFrame([(1, 11), (1, 12)], "k int, v int")
    for run in (lambda: m.merge(t, twice, ["k"]), lambda: m.upsert(t, twice, ["k"])):
        with pytest.raises(Exception, match="more than one source row"):
            run().collect()
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k int, v int")
    assert m.merge(t, nulls, ["k"]).count() == 3


def test_collected_keeps_rows_without_a_key(spark):
    from sightline.operators.picks import with_collected

    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (None, None)], "k int, v string")
    out = [(r["k"], r["v"], r["all"]) for r in with_collected(df, ["k"], "v", "all").collect()]
    assert sorted(out, key=str) == sorted(
        [(1, "b", ["a", "b"]), (1, "a", ["a", "b"]), (None, "c", ["c"]), (None, None, ["c"])], key=str
    )


def test_report_of_a_write_comes_from_the_same_pass(spark, folder):
    rows = [(1, dt.datetime(2024, 1, 3), False), (2, dt.datetime(2024, 1, 9), True), (3, dt.datetime(2024, 1, 5), None), (3, None, False)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, held boolean")
    report = write_reported(df, lambda x: x.write.parquet(folder + "/out"), ts="ts", held=F.col("held"))
    assert (report.n_rows, report.merged, report.held) == (4, 3, 1)
    assert spark.read.parquet(folder + "/out").count() == 4
    control = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), "x", None), ("b", None, None, "x", None)],
                                    "watermark_name string, start_timestamp timestamp, end_timestamp timestamp, transaction_status string, updated_timestamp timestamp")
    moved = inc.finish_at(control, "a", report.newest, F.lit(dt.datetime(2024, 2, 1))).orderBy("watermark_name").collect()
    assert (moved[0]["start_timestamp"], moved[0]["end_timestamp"]) == (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 5))
    assert moved[1]["end_timestamp"] is None and moved[1]["transaction_status"] == "x"
    none = write_reported(df.limit(0), lambda x: x.write.parquet(folder + "/none"), ts="ts")
    assert (none.n_rows, none.newest_micros) == (0, None)
    assert inc.finish_at(control, "a", none.newest, F.lit(None)).filter("watermark_name = 'a'").first()["transaction_status"] == "x"
