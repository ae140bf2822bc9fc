import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import table

from sightline.llm import prefixtrie as t

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, b string, turns string, place string, h string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(found)] for c, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += worth
    sha = lambda x: hashlib.sha256(",".join(map(str, sorted(x))).encode()).hexdigest()
    out = [(min(c), len(n), min(members[n[:-1]]) if n else None, len(c), children[n], leaves[n], saved[n], sha(ends[n])) for n, c in members.items()]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, n, least=0):
    rng = random.Random(seed)
    rows = []
    for c in range(least, least + n):
        for turn in range(rng.randint(0, 11)):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["a", "b", "é", "", None, "x" * 30])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("p", [t.Trie(), t.Trie(share=1, least_unit=1, most_unit=1, queue=2, chunk=1), t.Trie(least_unit=9, most_unit=9, queue=1, chunk=3)])
def test_against_brute_force(spark, p):
    rows = corpus(1, 160) + [(None, 1, "user", "lost"), (7, None, "user", "first"), (7, None, None, None), (8, 3, "user", "a"), (8, 3, "user", "a")]
    rows += [(1001, i, "user", "same") for i in range(3)] + [(1006, 0, None, None)]  # 1000 is absent
    rows += [(c, i, "bot", "copy") for c in range(2000, 2300, 5) for i in range(2)]  # a hot sequence, a leaf with many members
    assert found(t.prefix_trie(table(spark, rows, SCHEMA).repartition(5), p)) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(2)
    rows = [(5, i, "user", rng.choice(["a", "b", "é" * 9])) for i in range(400)] + corpus(3, 25, 10)
    rows += [(c, i, r, x) for _, i, r, x in rows[:9] for c in (20, 21, 22)]
    p = t.Trie(least_unit=20, most_unit=20, queue=5)
    assert found(t.prefix_trie(table(spark, rows, SCHEMA).repartition(7), p)) == brute(rows)


def test_deep_and_repeated(spark):
    rows = [(c, None, "user", "same") for c in (0, 5, 10, 11) for _ in range(120)] + [(1, 2**40, "bot", "z" * 100_000)]
    assert found(t.prefix_trie(table(spark, rows, SCHEMA), t.Trie(least_unit=50, most_unit=50))) == brute(rows)
    assert t.prefix_trie(table(spark, rows, SCHEMA).limit(0)).collect() == []


def test_running_sums_cross_tasks(spark):
    rng = random.Random(4)
    rows = sorted((rng.choice([1, 1, 1, 2, 3, -9]), i, rng.getrandbits(61), i % 7) for i in range(500))
    df = spark.createDataFrame(rows, "k long, o long, x long, y long")
    for mask in (-1, t.MASK):
        out = t.running_sums(df.repartition(3), "k", ["o"], ["x" if mask > 0 else "y"], ["o"], mask)
        so_far, want = defaultdict(int), []
        for k, o, x, y in rows:
            so_far[k] += x if mask > 0 else y
            want.append((k, o, so_far[k] & mask))
        assert sorted(map(tuple, out.collect())) == want


def test_queue_spills():
    rng = random.Random(6)
    queue, want = t.SpillingQueue(50), defaultdict(lambda: [0, 0, 0])
    for _ in range(5000):
        key, a, b = (rng.randint(-40, 0), rng.randint(0, 9), 0), rng.randint(0, 5), rng.randint(0, 2**40)
        queue.push(*key, a, b)
        want[key] = [want[key][0] + 1, want[key][1] + a, want[key][2] + b]
    assert queue.spilled > 50 and len(queue.heap) <= 50
    assert all(list(queue.take(key)) == want[key] for key in sorted(want))
    assert queue.take((1, 0, 0)) == (0, 0, 0)
