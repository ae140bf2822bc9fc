import numpy as np

from sightline.llm import permutation
from sightline.llm.text import table


def brute(rows, every, nearest):
    own = {}
    for k, v in rows:
        if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            own[k] = min(own.get(k, v), v)
    ids = sorted(own)
    x = np.array([own[k] for k in ids])
    x = x / np.linalg.norm(x, axis=1)[:, None]
    out = []
    for i, k in enumerate(ids):
        if k % every == 0:
            score = np.round(x @ x[i], 12)
            order = [j for j in np.lexsort((ids, -score)) if j != i][:nearest]
            out += [(k, n + 1, ids[j], round(float(score[j]), 9)) for n, j in enumerate(order)]
    return out


def test_whole_rerank_is_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype("f4").astype(float).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)]  # one vector in many rows
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [1.0] * 7 + [None]), (1003, [float("nan")] * 8), (1004, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(7, rows[7][1]), (1005, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS ids", "3 AS block")
    p = permutation.Permutations(pivots=32, prefix=16, rerank=1.0, block_rows=100, block_queries=3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in permutation.nearest_neighbours(df, p).collect())
    assert got == brute([r for r in rows if r[1] is None or len(r[1]) == 8], 50, 5)
    assert permutation.nearest_neighbours(df.limit(0)).collect() == []
    few = df.filter("vec_id in (0, 1, 2)")
    assert permutation.nearest_neighbours(few).filter("query_id = 0").count() == 2


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(2)
    own = np.array([rng.permutation(20)[:6] for _ in range(50)], np.int32)
    files = permutation.PivotFiles(own, 20)
    for q in own[:5]:
        want = [sum(abs(list(x).index(p) - i) if p in x else 6 - i for i, p in enumerate(q)) for x in own]
        assert files.footrule(q).tolist() == want


def test_recall_with_production_parameters(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    p = permutation.Permutations(every=5)
    key = lambda df: {(r["query_id"], r["vec_id"]) for r in df.collect()}
    found, exact = key(permutation.nearest_neighbours(rows, p)), key(permutation.exact_neighbours(rows, 5, p))
    assert len(found & exact) / len(exact) >= 0.9


def test_extreme_components_keep_their_cosines(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 8))
    scales = np.array([1e300, 1e-300, 1.0, 1e160])[np.arange(60) % 4]
    rows = [(i, [float(v) for v in x * s]) for i, (x, s) in enumerate(zip(vectors, scales, strict=True))]
    p = permutation.Permutations(every=10, rerank=1.0)
    found = permutation.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), p).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    assert len(found) == 30
    for r in found:
        assert abs(r["score"] - unit[r["query_id"]] @ unit[r["vec_id"]]) < 1e-12
