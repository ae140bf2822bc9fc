import random
from collections import Counter
from itertools import combinations

import numpy as np
from helpers import AWKWARD, documents, prose

from sightline.llm import graph, neardup
from sightline.llm.text import split_words
from sightline.session import materialize


def sets_of(texts):
    out = []
    for text in texts:
        found = split_words(text)
        out.append({tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set())
    return out


def components_of(texts):
    sets, root = sets_of(texts), list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(texts)), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) + 1 for i in range(len(texts))], sets


def edited(rng, text, n):
    found = text.split()
    for _ in range(n):
        found[rng.randrange(len(found))] = f"w{rng.randrange(10**6)}"
    return " ".join(found)


def test_components_against_brute_force(spark):
    rng = random.Random(8)
    base = [prose(i, 120) for i in range(25)]
    passage = prose(77, 60)
    texts = [*AWKWARD, *base]
    texts += [edited(rng, t, n) for t in base[:12] for n in (1, 2, 4, 6)]  # on both sides of the limit
    texts += [edited(rng, base[0], rng.randint(1, 5)) for _ in range(120)] + [base[1].upper()] * 60
    texts += [passage + " " + prose(200 + i, rng.randint(1, 60)) for i in range(60)]
    texts += ["the same three", "The Same\tthree", "the same four", prose(3, 4000), edited(rng, prose(3, 4000), 100)]
    want, sets = components_of(texts)
    rows = {r["doc_id"]: r for r in neardup.near_components(documents(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i in range(len(texts)):
        r = rows[i + 1]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), want[i], want[i] == i + 1), i


def test_kept_rows(spark):
    docs = documents(spark, [prose(1, 30), prose(1, 30), None, "", prose(2, 30)])
    out = neardup.deduplicated(docs.union(docs.filter("doc_id = 5")))
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4, 5]
    assert neardup.near_components(docs.limit(0)).collect() == []


def test_sketch_keeps_links_and_drops_others(spark):
    p, rng, rows = neardup.NearDup(), np.random.default_rng(0), []
    for n in (20, 150, 600, 3000):
        for kind, similar in (("link", 0.76), ("other", 0.55)):
            for _ in range(60):
                shared = round(2 * n * similar / (1 + similar))
                pool = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64) * np.uint64(2)
                sides = [np.sort(pool[:n]), np.sort(np.concatenate([pool[:shared], pool[n:]]))]
                rows.append((kind, *({"n_shingles": n, "n_samples": k, "sketch": s.tolist()} for k, s in (neardup.odd_sketch(x, p) for x in sides))))
    side = "struct<n_shingles:long,n_samples:int,sketch:array<long>>"
    df = spark.createDataFrame(rows, f"kind string, x {side}, y {side}")
    passed = Counter(r["kind"] for r in df.filter(neardup._near(p)).select("kind").collect())
    assert passed["link"] == 240 and passed["other"] < 12


def test_links_of_small_sets_are_never_dropped(spark):
    p, rng, sides, pairs = neardup.NearDup(), np.random.default_rng(5), [], []
    for shared, union in ((3, 4), (6, 8), (9, 12), (4, 5), (5, 6), (7, 9), (54, 72)):
        for _ in range(2000):
            pool = rng.integers(0, 1 << 64, union, dtype=np.uint64)
            middle = shared + (union - shared) // 2
            for own in (np.sort(pool[:middle]), np.sort(np.concatenate([pool[:shared], pool[middle:]]))):
                size, sketch = neardup.odd_sketch(own, p)
                sides.append((len(sides), len(own), size, sketch.tolist()))
            pairs.append((len(sides) - 2, len(sides) - 1))
    sketches = spark.createDataFrame(sides, "doc_id long, n_shingles long, n_samples int, sketch array<long>")
    found = neardup.likely(spark.createDataFrame(pairs, "a long, b long"), sketches, p)
    assert found.count() == len(pairs)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(graph.components(df, "a", "b").collect())
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100)}
    assert graph.components(df.limit(0), "a", "b").collect() == []


def test_the_sketch_test_of_a_pair_stays_short(spark):
    from sightline.llm.neardup import NearDup, _near

    # code of a pair's test that grows with the words of the sketch is not compiled by the JVM
    assert str(_near(NearDup())).count("bit_count") == 1


def test_stars_take_no_round_and_lists_few_files(spark, monkeypatch):
    written = []

    def counted(df, label, tasks=None):
        stored = materialize(df, label, tasks)
        written.append(len(stored.inputFiles()))
        return stored

    monkeypatch.setattr(graph, "materialize", counted)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        stars = spark.createDataFrame([(1, x) for x in range(2, 60)] + [(100, x) for x in range(101, 160)], "a long, b long")
        found = dict(graph.components(stars, "a", "b", tasks=3).collect())
        assert len(written) == 1 and written[0] <= 3
        assert found == {x: 1 for x in range(1, 60)} | {x: 100 for x in range(100, 160)}
        chain = spark.createDataFrame([(x, x + 1) for x in range(40)] + [(3, 3), (None, 5)], "a long, b long")
        assert dict(graph.components(chain, "a", "b", tasks=3).collect()) == dict.fromkeys(range(41), 0)
        assert max(written) <= 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_of_a_bucket_lose_no_pair(spark):
    p = neardup.NearDup(block=4)
    rows = [(i, 10, 10, [0] * 32, [7, 8 + i % 2]) for i in range(40)]
    classes = spark.createDataFrame(rows, "doc_id long, n_shingles long, n_samples int, sketch array<long>, bands array<long>")
    members = spark.createDataFrame([(7, i, i // 2) for i in range(40)], "bucket long, doc_id long, component long")
    found = neardup.across(members, classes, p)
    pairs = sorted(tuple(r) for r in found.collect())
    assert pairs == [(a, b) for a, b in combinations(range(40), 2) if a // 2 != b // 2]
