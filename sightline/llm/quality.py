"""Quality rules: counts with fixed limits, and divergence from a language's own histograms."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import GAP, bound, words

#: fixed values: frequent function words of each language with a reference
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are as with be by this from at or an he have",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
}
#: fixed values: character classes, taken out of a text one after the other
CLASSES = {
    "lower": "[a-z]+",
    "white": GAP,
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "punctuation": r"""[.,;:!?'"()\-]+""",
    "symbol": "[#*$%&|<>]+",
    "ascii": r"[\x00-\x7F]+",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Quality:
    """Limits. A text shorter than a guard is not compared, as its histogram says too little.

    ``far_words`` must lie below the distance of a text without any common word, which a reference
    with a fifth of common words puts at 0.31 to 0.33: a menu or a keyword list can be no farther.
    """

    least_words: int = 10
    most_repeated: int = 20  # percent of the words
    window: int = 5
    guard_chars: int = 200
    guard_words: int = 60
    far_chars: float = 0.35
    far_words: float = 0.28
    languages: dict[str, str] = field(default_factory=lambda: COMMON_WORDS)


def repeated_words(found: Column, width: int) -> Column:
    """Number of words in ``width``-word windows that occur twice or more, the first included.

    Windows are compared by 64-bit hashes. A text without repeats costs one pass; else hashes and
    positions are sorted, and the gaps between marked positions are added up.
    """
    starts = F.sequence(F.lit(0), F.size(found) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(found[i + k] for k in range(width))))

    def marked(pairs: Column) -> Column:
        def twin(pair: Column, i: Column) -> Column:
            same = lambda at: F.coalesce(F.get(pairs, at)["h"] == pair["h"], F.lit(False))
            return same(i - 1) | same(i + 1)

        return F.sort_array(F.transform(F.filter(pairs, twin), lambda pair: pair["at"]))

    def covered(places: Column) -> Column:
        own = F.transform(places, lambda x, j: F.when(j == 0, width).otherwise(F.least(F.lit(width), x - F.get(places, j - 1))))
        return F.aggregate(own, F.lit(0), lambda total, x: total + x)

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        slow = bound(bound(pairs, marked), covered)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(slow)

    return F.when(F.size(found) > width, bound(hashes, count)).otherwise(0).cast("long")


def histograms(docs: DataFrame, p: Quality) -> DataFrame:
    """Adds ``_words`` and the two histograms; a language without a reference has null ``_common``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.withColumns({"_t0": text, "_words": words(text)})
    lengths = {"_n0": F.length("_t0")}
    for i, pattern in enumerate(CLASSES.values()):
        docs = docs.withColumn(f"_t{i + 1}", F.regexp_replace(f"_t{i}", pattern, ""))
        lengths[f"_n{i + 1}"] = F.length(f"_t{i + 1}")
    docs = docs.withColumns(lengths)
    last = len(CLASSES)
    classes = F.array(*(F.col(f"_n{i}") - F.col(f"_n{i + 1}") for i in range(last)), F.col(f"_n{last}"))

    known = sorted({w for listed in p.languages.values() for w in listed.split()})
    of = reduce(
        lambda rest, lang: F.when(F.col("lang") == lang, F.array(*map(F.lit, p.languages[lang].split()))).otherwise(rest),
        p.languages,
        F.lit(None).cast("array<string>"),
    )
    hits = F.filter("_words", lambda w: w.isin(known))
    listed = bound(hits, lambda h: F.transform(of, lambda c: F.size(F.filter(h, lambda w: w == c))))
    common = bound(listed, lambda n: F.concat(n, F.array(F.size("_words") - F.aggregate(n, F.lit(0), lambda a, x: a + x))))
    return docs.withColumns({"_classes": classes, "_common": common}).drop(*(f"_t{i}" for i in range(1, last + 1)))


def references(docs: DataFrame, p: Quality) -> dict[str, tuple[list, list]]:
    """Per language, the summed histograms of all its documents: one row per known language."""
    found = histograms(docs.select("text", "lang"), p).filter(F.col("_common").isNotNull())
    lengths = {lang: len(listed.split()) + 1 for lang, listed in p.languages.items()}
    sizes = {"_classes": len(CLASSES) + 1, "_common": max(lengths.values(), default=1)}
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, n in sizes.items() for i in range(n)]
    rows = found.groupBy("lang").agg(*sums).collect()  # at most one row for each language named in p
    return {
        r["lang"]: ([r[f"_classes{i}"] for i in range(sizes["_classes"])], [r[f"_common{i}"] for i in range(lengths[r["lang"]])])
        for r in rows
    }


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two arrays of counts."""
    shares = lambda a: bound(F.aggregate(a, F.lit(0.0), lambda t, x: t + x), lambda total: F.transform(a, lambda x: x / total))

    def term(x: Column, y: Column) -> Column:
        part = lambda v: F.when(v > 0, v * F.log2(2 * v / (x + y))).otherwise(0.0)
        return (part(x) + part(y)) / 2

    total = F.aggregate(F.zip_with(shares(counts), shares(reference), term), F.lit(0.0), lambda t, x: t + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def judged(docs: DataFrame, refs: dict[str, tuple[list, list]], p: Quality) -> DataFrame:
    """The columns of ``docs`` with counts, distances and verdicts, in one pass without a shuffle."""
    rows = histograms(docs, p)
    lines = F.filter(F.split("_t0", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": (F.col("_n0") - (F.col("_n1") - F.col("_n2"))).cast("long"),
            "n_symbols": (F.col("_n5") - F.col("_n6")).cast("long"),
            "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words"), p.window),
        }
    )

    def reference(which: int) -> Column:
        out = F.lit(None).cast("array<double>")
        for lang, both in refs.items():
            out = F.when(F.col("lang") == lang, F.array(*(F.lit(float(x)) for x in both[which]))).otherwise(out)
        return out

    compared = lambda c, which: distance(F.transform(c, lambda x: x.cast("double")), reference(which))
    rows = rows.withColumns(
        {
            "char_distance": F.when((F.col("_n0") >= p.guard_chars) & F.col("_common").isNotNull(), compared("_classes", 0)),
            "word_distance": F.when(F.col("n_words") >= p.guard_words, compared("_common", 1)),
            "base_failed": (F.col("n_words") < p.least_words) | (100 * F.col("n_repeat_words") > p.most_repeated * F.col("n_words")),
        }
    )
    near = lambda c, most: F.coalesce(F.col(c) <= most, F.lit(True))
    rows = rows.withColumn("kept", ~F.col("base_failed") & near("char_distance", p.far_chars) & near("word_distance", p.far_words))
    return rows.drop("_t0", "_words", "_classes", "_common", *(f"_n{i}" for i in range(len(CLASSES) + 1)))


def assess(docs: DataFrame, p: Quality | None = None) -> DataFrame:
    """One verdict per row: counts, distances to the references of its language, ``kept``.

    A null text counts as empty and fails the base rules. A null or unknown language has no
    reference, and texts under the guards are not compared: both pass. A repeated row gets its
    own verdict each time. An empty table gives no rows. Columns of ``docs`` other than
    ``doc_id, text, lang`` are not read.
    """
    p = p or Quality()
    base = docs.select("doc_id", "text", "lang")
    return judged(base, references(base, p), p).drop("text", "lang")


def passing(docs: DataFrame, p: Quality | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    p = p or Quality()
    base = docs.select("text", "lang", F.struct(*docs.columns).alias("_row"))
    rows = judged(base, references(base, p), p)
    # not a filter: that would be pushed below, and each count in it written out once per use
    return rows.select(F.inline(F.when(F.col("kept"), F.array("_row"))))
