import random
import zlib
from collections import Counter, defaultdict

from helpers import AWKWARD, documents, prose

from sightline.llm import sharding


def check(rows, texts, shards, tolerance):
    assert len(rows) == len(texts)
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        text = (texts[r["doc_id"] - 1] or "").encode()
        assert r["size"] == len(text) + 1 and r["text_crc32"] == zlib.crc32(text) and r["law"] == "bytes"
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    ideal = sum(sizes.values()) / shards
    assert max(abs(sizes[s] - ideal) for s in range(shards)) <= tolerance


def test_near_equal_and_gapless(spark):
    rng = random.Random(0)
    texts = [prose(i, rng.randint(1, 200)) for i in range(1500)] + AWKWARD
    longest = max(len((t or "").encode()) for t in texts) + 1
    check(sharding.shard_table(documents(spark, texts)).collect(), texts, 8, 2 * longest)


def test_hot_text_is_spread_and_groups_stay(spark):
    texts = [prose(7, 50)] * 900 + [prose(100 + i // 3, 50) for i in range(1800)]
    rows = sharding.shard_table(documents(spark, texts)).collect()
    check(rows, texts, 8, 3000)
    where = defaultdict(set)
    for r in rows:
        where[texts[r["doc_id"] - 1]].add(r["shard"])
    assert len(where.pop(texts[0])) > 2
    assert sum(len(x) > 1 for x in where.values()) <= 8  # only where an edge had to cut


def test_repeated_and_empty(spark):
    docs = documents(spark, ["same text"])
    many = docs
    for _ in range(6):
        many = many.union(many)
    rows = sharding.shard_table(many).collect()
    assert len(rows) == 64
    assert sharding.shard_table(docs.limit(0)).collect() == []


def test_written_shards(spark, folder):
    texts = [prose(i, 30) for i in range(300)] + AWKWARD
    docs = documents(spark, texts)
    sharding.write_shards(docs, folder + "/out", sharding.Sharding(shards=4))
    back = spark.read.parquet(folder + "/out")
    want = docs.drop("shard")
    assert sorted(map(repr, back.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
