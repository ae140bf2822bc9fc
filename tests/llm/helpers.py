"""Small tables with the awkward rows every operator must take."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: besides the columns of ``documents``: names that the operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, shard string, score string, row string"


def table(spark, rows, schema=SCHEMA):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *("x",) * (width - len(r))) for r in rows], schema)


def documents(spark, texts, lang="en"):
    """One row per text, ids from 1; every third source is null."""
    rows = [(i + 1, t, lang, None if i % 3 == 2 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return table(spark, rows)


def prose(seed, n):
    rng = random.Random(seed)
    parts = "the of and to in is that ing er st nd on re ti es or th an he ha".split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


AWKWARD = [None, "", " \n\t ", "one", "é ß 漢字 🙂", "a\x1cb\xa0c", "word " * 30, "x" * 5000, prose(1, 40), prose(1, 40)]
