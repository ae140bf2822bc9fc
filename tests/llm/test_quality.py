import math
import random
from collections import Counter

import pytest
from helpers import AWKWARD, WORD, documents, prose, table

from sightline.llm import quality


def base(text):
    found = WORD.findall(text or "")
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {i + k for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a", "b ", "c\n", "# ", "\x0b", "é|", "d e f g h ", "\r\n"], k=rng.randint(0, 60))) for _ in range(300)]
    texts += AWKWARD
    got = {r["doc_id"]: r for r in quality.assess(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i + 1]
        assert tuple(r[c] for c in quality.COUNTS) == base(text), repr(text)
        n, repeated = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 10 or 100 * repeated > 20 * n)
        assert not (r["kept"] and r["base_failed"])


def test_distance(spark):
    def shannon(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        part = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
        return math.sqrt((part(p, q) + part(q, p)) / 2)

    cases = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([1.0, 0.0], [0.0, 1.0]), ([5.0, 5.0], [1.0, 1.0])]
    df = spark.createDataFrame(cases, "p array<double>, q array<double>")
    got = [r[0] for r in df.select(quality.distance(df.p, df.q)).collect()]
    assert got == pytest.approx([shannon(*c) for c in cases])


def test_divergent_documents_go_and_guards_hold(spark):
    clean = [prose(i, 120) for i in range(40)]
    symbols = " ".join(w + "%%%" for w in prose(99, 120).split())
    short = "%%% ### !!! $$$ && || << >> %% ## ** &&"
    rows = [(i, t, "en") for i, t in enumerate(clean)] + [(100, symbols, "en"), (101, short, "en"), (102, symbols, None), (103, symbols, "xx")]
    kept = {r["doc_id"]: r["kept"] for r in quality.assess(table(spark, rows, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(40))
    assert not kept[100]
    assert kept[101] and kept[102] and kept[103]  # too short, and no reference


def test_menus_and_texts_without_function_words_go(spark):
    rows, bad = [], {}
    for lang, listed in quality.COMMON_WORDS.items():
        rng, common = random.Random(lang), listed.split()
        for i in range(60):  # a fifth of the words are common ones
            found = [rng.choice(common) if rng.random() < 0.2 else w for w in prose(f"{lang}{i}", 150).split()]
            rows.append((len(rows), " ".join(found), lang))
        other = [w for w in prose(f"{lang}x", 400).split() if w not in common]
        bad |= {len(rows): "menu", len(rows) + 1: "no function words", len(rows) + 2: "one of them"}
        rows += [(len(rows), " | ".join(other[:70]), lang), (len(rows) + 1, " ".join(other[:120]), lang)]
        rows.append((len(rows), " ".join([*other[:119], common[0]]), lang))
        rows.append((len(rows), " | ".join(other[:29]), lang))  # 57 words: under the guard
    docs = table(spark, rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.assess(docs).collect()}
    for i, r in got.items():
        assert not r["base_failed"] and r["char_distance"] <= quality.Quality().far_chars, i  # words alone decide
        assert r["kept"] == (i not in bad), (i, bad.get(i), r["word_distance"])


def test_columns_stay_and_empty_table(spark):
    docs = documents(spark, [prose(5, 50), None])
    out = quality.passing(docs)
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [tuple(docs.first())]
    assert quality.assess(docs.limit(0)).collect() == []
