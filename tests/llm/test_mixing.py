from collections import Counter

import pytest
from helpers import AWKWARD, WORD, documents, prose
from pyspark.sql import functions as F

from sightline.llm import mixing


def words(text):
    return len(WORD.findall(text or ""))


def targets(sizes, weights, total, most):
    """Shares of ``total`` by weight; what a source cannot give is shared again by the others."""
    out, active, rest = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while active:
        unit = rest / sum(weights[i] for i in active)
        full = [i for i in active if unit * weights[i] > most * sizes[i]]
        for i in full or active:
            out[i] = float(most * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        rest -= sum(out[i] for i in full)
        active = [i for i in active if i not in full]
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 5], [0, 0], [0, 7], [1, 1, 1, 1, 10**12], [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]])
def test_targets_are_shared_again(spark, sizes):
    p = mixing.Mix()
    weights = [p.weights[i % 3] for i in range(len(sizes))]
    rows = spark.createDataFrame(list(zip(range(len(sizes)), sizes, weights, strict=True)), "source long, source_size long, weight int")
    found = [r["target"] for r in mixing.with_targets(rows, p).orderBy("source").collect()]
    assert found == pytest.approx(targets(sizes, weights, 1.5 * sum(sizes), 2))


def test_tree_is_exact_and_seeded():
    quotas, sizes = [1000, 1, 0, 333], mixing.even(1334, 7)
    leaves = mixing.split_quotas(quotas, sizes, 3)
    assert [sum(x) for x in zip(*leaves, strict=True)] == quotas
    assert [sum(x) for x in leaves] == sizes and max(sizes) - min(sizes) <= 1
    assert leaves == mixing.split_quotas(quotas, sizes, 3) != mixing.split_quotas(quotas, sizes, 4)
    mean = [sum(mixing.split_quotas([50, 150], mixing.even(200, 4), s)[0][0] for s in range(200)) / 200]
    assert mean[0] == pytest.approx(12.5, abs=0.7)
    assert 0 <= mixing.hypergeometric(mixing.np.random.default_rng(0), 3 * 10**9, 10**9, 10**9) <= 10**9


def test_chunks_of_strata_keep_the_sums(spark):
    quotas = [(2 * i, (i * 37) % 11) for i in range(23)]
    p = mixing.Mix(chunk=8, shards=5)
    rows = mixing.leaf_starts(spark.createDataFrame(quotas, "stratum long, quota long"), p).collect()
    starts = {r["stratum"]: r["starts"] for r in rows}
    assert sorted(starts) == [s for s, _ in quotas]
    per_shard = [0] * 5
    for stratum, quota in quotas:
        ends = [*starts[stratum], quota]
        parts = [b - a for a, b in zip([0, *starts[stratum]], ends, strict=True)]
        assert min(parts) >= 0 and sum(parts) == quota
        per_shard = [a + b for a, b in zip(per_shard, parts, strict=True)]
    assert per_shard == mixing.even(sum(q for _, q in quotas), 5)


def test_draw_against_brute_force(spark):
    """Blocks in the order of their keys, cut where the words are reached and dealt by the leaves."""
    texts = [prose(i, 5 + 11 * (i % 30)) for i in range(90)] + ["", None]
    docs = documents(spark, texts)
    p = mixing.Mix(block_words=32, shards=6, buckets=8, chunk=2)
    rows = mixing.mix_table(docs, p).collect()
    sizes = {i + 1: words(t) for i, t in enumerate(texts)}
    source = lambda i: (i - 1) % 3
    every = [(i, turn, b, min(32, n - 32 * b)) for i, n in sizes.items() for turn in range(2) for b in range(-(-n // 32))]
    hashed = spark.createDataFrame(every, "doc_id long, turn int, block long, words long").withColumn("key", mixing._key(p, F.col("turn"), F.col("block")))
    order, per_source = sorted(map(tuple, hashed.select("key", "doc_id", "turn", "block", "words").collect())), Counter()
    for i, n in sizes.items():
        per_source[source(i)] += n
    want = targets([per_source[s] for s in range(3)], [5, 2, 1], 1.5 * sum(sizes.values()), 2)
    drawn, quotas = {}, {}
    for s in range(3):
        left = round(want[s])
        for turn in range(2):
            need, own = min(left, per_source[s]), []
            left -= need
            for _, i, t, _, n in order:
                if t == turn and source(i) == s and need > 0:
                    own.append((i, min(n, need)))
                    need -= min(n, need)
            if own:
                drawn[2 * s + turn], quotas[2 * s + turn] = own, len(own)
    starts = {r["stratum"]: r["starts"] for r in mixing.leaf_starts(spark.createDataFrame(list(quotas.items()), "stratum long, quota long"), p).collect()}
    expected = {i: [] for i in sizes}
    for stratum, own in drawn.items():
        for rank, (i, n) in enumerate(own):
            expected[i].append((sum(x <= rank for x in starts[stratum]), n))
    assert {r["doc_id"]: [tuple(x) for x in r["shard_words"]] for r in rows} == {i: sorted(x) for i, x in expected.items()}
    assert all(r["taken"] == sum(n for _, n in expected[r["doc_id"]]) for r in rows)


def test_taken_words(spark):
    texts = [prose(i, 10 + 7 * (i % 40)) for i in range(400)] + AWKWARD
    docs = documents(spark, texts)
    p = mixing.Mix(block_words=64, shards=8, buckets=16)
    rows = {r["doc_id"]: r for r in mixing.mix_table(docs, p).collect()}
    assert len(rows) == len(texts)
    sizes, taken, target = Counter(), Counter(), {}
    for i, text in enumerate(texts):
        r, source = rows[i + 1], i % 3
        assert r["size"] == words(text) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[source] += r["size"]
        taken[source] += r["taken"]
        target[source] = r["target"]
    order = [0, 1, 2]  # s0, s1, then null
    want = targets([sizes[s] for s in order], [5, 2, 1], 1.5 * sum(sizes.values()), 2)
    assert [target[s] for s in order] == pytest.approx(want)
    assert all(rows[i + 1]["source_size"] == sizes[i % 3] for i in range(len(texts)))
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_table(docs.repartition(7), p).collect()}
    assert again == {k: r["taken"] for k, r in rows.items()}

    mixed = mixing.mixed(docs, p)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += words(r["text"])
        assert r["text"].strip() in texts[r["doc_id"] - 1] and r["n_chars"] == len(r["text"])
    assert got == Counter({k: r["taken"] for k, r in rows.items() if r["taken"]})


def test_one_repeated_row_and_empty(spark):
    docs = documents(spark, [prose(1, 30)])
    many = docs
    for _ in range(5):
        many = many.union(many)
    rows = mixing.mix_table(many).collect()
    assert len(rows) == 32 and sum(r["taken"] for r in rows) == 1440
    assert mixing.mix_table(docs.limit(0)).collect() == [] and mixing.mixed(docs.limit(0)).collect() == []
    assert [tuple(r) for r in mixing.mix_table(documents(spark, [None, ""])).select("size", "taken").collect()] == [(0, 0)] * 2
