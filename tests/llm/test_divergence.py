import random
import re
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from helpers import table

from sightline.llm import divergence as d

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, p):
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        counts, in_docs = defaultdict(Counter), Counter()
        for own, source, text in rows:
            if own == lang:
                found = TERM.findall(text.translate(LOWER))
                counts[source].update(found)
                in_docs.update(set(found))
        kept = [t for t, n in in_docs.items() if n >= p.least_docs]
        every = sum((Counter(c) for c in counts.values()), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept) + p.prior * len(kept)
            return {t: 1 + d.SCALE * (c[t] + p.prior) // total for t in kept}

        own, q = {s: shares(c) for s, c in counts.items()}, shares(every)
        for s in counts:
            pairs = [(o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in counts if o != s]
            over = [(t, own[s][t] - q[t]) for t in kept if counts[s][t] and own[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, p.most_terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def corpus(seed, n, sources, parts):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        source = rng.choices(sources, [len(sources) ** 2] + [1 + i for i in range(len(sources) - 1)])[0]
        words = rng.choices(parts, [1 / (1 + (i + len(source or "")) % len(parts)) for i in range(len(parts))], k=rng.randint(0, 40))
        rows.append((rng.choice(["en", "en", "de", None, ""]), source, rng.choice([" ", "\n", ", ", "1"]).join(words)))
    return rows


WORDS = ["The", "the", "İst", "straße", "É", "é", "a\x00b", "x_y", "漢字", "don't", "Zz", "zz", "K", "\x80q", "of", "and", "é"]


@pytest.mark.parametrize("p", [d.Audit(least_docs=3, least_block=40, held=7, most_terms=4), d.Audit(least_docs=12), d.Audit(least_docs=10_000)])
def test_against_brute_force(spark, p):
    sources = ["a", None, "", "b", "ä", "Z", "src10", "src9"]
    rows = corpus(1, 400, sources, WORDS) + [("xx", "only", "a b c"), ("yy", "s", None), ("yy", "t", ""), (None, None, None)]
    rows += [("en", "long", "The " * 50_000), ("en", "none", "123 456")]
    docs = table(spark, rows, "lang string, source string, text string, n long, docs long, item string, term string, postings string, peers string".replace("long", "string"))
    found = sorted(tuple(r) for r in d.audit(docs, p).collect())
    assert found == brute(rows, p)


def test_empty_and_repeated(spark):
    rows = corpus(2, 60, ["a", "b"], WORDS[:5])
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    p = d.Audit(least_docs=5)
    assert d.audit(docs.limit(0), p).collect() == []
    twice = sorted(tuple(r) for r in d.audit(docs.union(docs), p).collect())
    assert twice == brute(rows + rows, p)


def test_counts_beyond_64_bits_stay_exact(spark):
    n = 3 * 10**15
    got = spark.range(1).select(d.share(*[d.F.lit(x).cast("long") for x in (n, 7 * n, 1000)], 5)).first()[0]
    assert got == 1 + d.SCALE * (n + 5) // (7 * n + 5000)
    import numpy as np

    assert d._shares(np.array([n, 0]), np.array([7 * n, 7 * n]), 5).tolist() == [1 + d.SCALE * (x + 5) // (7 * n) for x in (n, 0)]


def test_blocks_and_task_sums_do_not_matter(spark):
    docs = spark.createDataFrame(corpus(3, 300, ["a", "b", "c", "d"], WORDS), "lang string, source string, text string")
    p = d.Audit(least_docs=2)
    want = sorted(map(tuple, d.audit(docs, p).collect()))
    assert sorted(map(tuple, d.audit(docs.repartition(7), replace(p, least_block=1, held=1)).collect())) == want
