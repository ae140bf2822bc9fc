import random
import zlib

import numpy as np
from helpers import AWKWARD, documents, prose

from sightline.llm import toxicity
from sightline.llm.text import table


def corpus():
    rng = random.Random(6)
    stems = ["zorb", "quix", "plonk"]
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        found = prose(i, 60).split()
        for _ in range(3 if bad else 0):
            found.insert(rng.randrange(60), rng.choice(stems) + rng.choice(["", "ing", "er", "ed"]))
        texts.append(" ".join(found))
        labels.append((i + 1, int(bad)))
    return texts + AWKWARD, labels


def test_held_out_accuracy_and_split(spark):
    texts, labels = corpus()
    marks = spark.createDataFrame([*labels, labels[0], (None, 1), (10**9, None)], "doc_id long, toxic int").selectExpr("*", "1 AS quality", "2 AS score")
    rows = toxicity.toxicity_table(documents(spark, texts), marks).collect()
    assert len(rows) == len(texts)
    truth = dict(labels)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 90 and right / len(held) > 0.97
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] not in truth)

    # a held-out label is never seen
    flipped = spark.createDataFrame([(d, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, t in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity_table(documents(spark, texts), flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in rows)


def test_held_out_rows_of_the_given_tables(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = toxicity.toxicity_table(docs, labels).filter("held_out").join(labels.filter("toxic is not null"), "doc_id")
    sums = dict(rows.groupBy("toxic").agg({"predicted": "avg"}).collect())
    assert sums[1] >= 0.85 and sums[0] <= 0.005, sums


def test_without_labels_and_empty(spark):
    docs = documents(spark, ["you pathetic moron, you stupid idiot", prose(1, 40), None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_table(docs, none).collect()}
    assert scores[1] > scores[2] and scores[1] > scores[3]
    assert toxicity.toxicity_table(docs.limit(0), none).collect() == []


def test_label_model_down_weights_copies():
    rng = np.random.default_rng(3)
    truth = rng.random(3000) < 0.3
    vote = lambda right: np.where(rng.random(3000) < right, truth, ~truth).astype(float)
    good, weak = [vote(0.85) for _ in range(4)], vote(0.6)
    votes = np.column_stack([*good, *[weak] * 6])  # six copies of one weak voter
    found = toxicity.label_model(votes, vote(0.8), toxicity.Toxicity(trust=0.8)) > 0.5
    assert (found == truth).mean() > 0.93
