"""The pipeline, stage by stage, on the smallest data against the operators' own laws."""

from collections import Counter

from helpers import WORD
from test_mixing import targets
from test_neardup import components_of
from test_pii import base
from test_quality import base as counts

import corpus_pipeline as c
from sightline.llm import pii
from sightline.llm.text import table
from sightline.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = []
    for name, stage in c.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        seen.append((docs.collect(), out.collect(), out.columns))
        docs = out
    assert all(cols == columns for *_, cols in seen[:-1])

    before, after, _ = seen[0]
    kept = {r["doc_id"] for r in after}
    good = {r["doc_id"] for r in table(spark, SF, "labels").filter("quality = 1 and toxic = 0").collect()}
    for r in before:
        n, _, _, _, repeated = counts(r["text"])
        failed = n < 10 or 100 * repeated > 20 * n
        assert not (failed and r["doc_id"] in kept)
        assert failed or r["doc_id"] in kept or r["doc_id"] not in good

    before, after, _ = seen[1]
    before = sorted(before)
    want, _ = components_of([r["text"] for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({before[i - 1]["doc_id"] for i in want})

    before, after, _ = seen[2]
    assert len(before) == len(after)
    clean = {r["doc_id"]: r["text"] for r in after}
    for r in before:
        assert (clean[r["doc_id"]] == r["text"]) == (not pii.spans_of(r["text"]))
        assert base(clean[r["doc_id"]]) == []

    before, after, _ = seen[3]
    size, took, source = Counter(), Counter(), {r["doc_id"]: r["source"] for r in before}
    for r in before:
        size[r["source"]] += len(WORD.findall(r["text"]))
    for r in after:
        took[source[r["doc_id"]]] += len(WORD.findall(r["text"]))
    order = sorted(size)
    want = targets([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(size.values()), 2)
    assert all(abs(took[s] - t) <= 1 for s, t in zip(order, want, strict=True))

    before, after, _ = seen[4]
    assert sum(r["length"] for r in after if r["start"] == 0) > 0
    assert sum(r["doc_tokens"] for r in after if r["start"] == 0) == sum(r["length"] for r in after)
    assert Counter(r["doc_id"] for r in after if r["start"] == 0) == Counter(r["doc_id"] for r in before)
    used = Counter()
    for r in after:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048
