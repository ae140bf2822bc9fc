"""How the word use of a language's sources differs, by row-wise sparse accumulation.

The terms of each language form a term-major index: one row per term with the sources that use it.
A group is a row of the sparse matrix of counts; it scatters its terms through the index into one
dense accumulator over its peers, so pairs of postings are never emitted. What a group holds where
it does not use a term (its zero baseline) is a constant of the group; the accumulator starts from
the baselines of all terms and corrects them for the terms that either side uses.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import discard, materialize

#: fixed values: a term is a run of ASCII letters and code points beyond ASCII; A-Z become a-z
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCALE = 1_000_000_000
COUNTS = "lang string, source string, term string, n long, docs long"
POSTINGS = "array<struct<source:string,n:long>>"
PAIRS = "lang string, source string, item string, value long"


@dataclass(frozen=True)
class Audit:
    """``least_docs``: documents of a language that make a term count there. ``prior``: added to each
    count. ``most_terms``: ranks of part ``term``. ``held``: terms a task sums before it passes them
    on. ``least_block``: postings of one block of terms, which grows with the square of the sources
    up to ``most_block``."""

    least_docs: int = 30
    prior: int = 5
    most_terms: int = 50
    held: int = 300_000
    least_block: int = 16_384
    most_block: int = 2_000_000


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def term_counts(docs: DataFrame, held: int) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents, summed within each task as far
    as ``held`` terms go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def parts() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in sums.items():
                found = list(n)
                one = lambda value: pa.repeat(pa.scalar(value, pa.string()), len(found))  # noqa: E731, B023
                columns = [one(lang), one(source), pa.array(found, pa.binary()).cast(pa.string()),
                           pa.array(n.values(), pa.int64()), pa.array(map(in_docs.__getitem__, found), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = terms(text)
                if not own:
                    continue
                n, in_docs = sums.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(own)
                in_docs.update(set(own))
                size += len(n)
                if size > held:
                    yield from parts()
                    sums.clear()
                    size = 0
        yield from parts()

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(run, COUNTS)


def term_index(docs: DataFrame, p: Audit) -> DataFrame:
    """``lang, term, n, postings``: the kept terms, each with its sources and their counts.

    One shuffle, on (lang, term), of counts that tasks have summed; a hot source or language is
    spread over its terms.
    """
    counts = term_counts(docs, p.held).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("postings")
    )
    return rows.filter(F.col("docs") >= p.least_docs).select("lang", "term", "n", "postings")


def share(n: Column, total: Column, kept: Column, prior: int) -> Column:
    """``1 + floor(SCALE * (n + prior) / (total + prior * kept))``, exact at any size of the counts."""
    wide = lambda c: c.cast("decimal(28,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * (wide(n) + prior)
    return (F.call_function("div", top, wide(total) + wide(kept) * prior) + 1).cast("long")


def _shares(n: np.ndarray, total: np.ndarray, prior: int) -> np.ndarray:
    if len(n) and int(n.max()) + prior >= 2**63 // SCALE:
        n, total = n.astype(object), total.astype(object)
    return (1 + SCALE * (n + prior) // total).astype(np.int64)


def _accumulated(lang: str, first: bool, kept: int, peers: list[dict], lists: pa.ListArray, prior: int) -> Iterator[tuple]:
    """``(source, item, values)`` from the rows of one block: a group's accumulator over all peers, and
    what its own terms add to the accumulators of its peers."""
    names = np.array([x["source"] for x in peers], object)
    total = np.array([x["n"] for x in peers], np.int64) + prior * kept
    if not kept:
        for i in range(len(names)):
            yield i, np.zeros(len(names), np.int64), None
        return
    zero = _shares(np.zeros(len(names), np.int64), total, prior)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    flat = lists.flatten()
    peer = pc.index_in(flat.field("source"), pa.array(names, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
    n = flat.field("n").to_numpy(zero_copy_only=False)
    p = _shares(n, total[peer], prior)
    term = np.repeat(np.arange(len(lengths)), lengths)
    by_peer = np.argsort(peer, kind="stable")
    ends = np.searchsorted(peer[by_peer], np.arange(len(names) + 1))
    for i in range(len(names)):
        own = by_peer[ends[i] : ends[i + 1]]
        if not len(own) and not first:
            continue
        apart = np.abs(zero[i] - zero)
        # own terms against the zero baselines of all peers
        mine = np.sort(p[own])
        sums = np.concatenate([[0], np.cumsum(mine)])
        below = np.searchsorted(mine, zero)
        alone = sums[-1] - 2 * sums[below] + zero * (2 * below - len(mine)) - len(mine) * apart
        row = alone + kept * apart if first else alone.copy()
        # own terms through the index: the peers that use them are not at their baseline
        size = lengths[term[own]]
        at = np.repeat(starts[term[own]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        a, b, j = np.repeat(p[own], size), p[at], peer[at]
        np.add.at(row, j, np.abs(a - b) - np.abs(a - zero[j]) - np.abs(zero[i] - b) + apart[j])
        yield i, row, alone


def pair_sums(index: DataFrame, groups: DataFrame, langs: DataFrame, p: Audit) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, by blocks of terms."""
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    postings = index.join(langs.select("lang", "blocks"), "lang").select(
        "lang", block.alias("block"), F.lit(None).cast("long").alias("kept"), "postings", F.lit(None).cast(POSTINGS).alias("peers")
    )
    peers = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("peers"))
    heads = langs.join(peers, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "kept",
        F.lit(None).cast(POSTINGS).alias("postings"), "peers",
    )
    prior = p.prior

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang, block = key[0].as_py(), key[1].as_py()
        is_head = pc.is_valid(rows["kept"])
        head = rows.filter(is_head)
        lists = rows.filter(pc.invert(is_head))["postings"].combine_chunks()
        peers = head["peers"][0].as_py()
        names = pa.array([x["source"] for x in peers], pa.string())
        places = np.arange(len(names))
        left, right, values = [], [], []
        for i, row, alone in _accumulated(lang, block == 0, head["kept"][0].as_py(), peers, lists, prior):
            others = places[places != i]
            left.append(np.full(len(others), i))
            right.append(others)
            values.append(row[others])
            if alone is not None:
                left.append(others)
                right.append(np.full(len(others), i))
                values.append(alone[others])
        joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        source = names.take(pa.array(joined(left), pa.int64()))
        item = names.take(pa.array(joined(right), pa.int64()))
        return pa.table([pa.repeat(pa.scalar(lang, pa.string()), len(source)), source, item, pa.array(joined(values), pa.int64())],
                        names=["lang", "source", "item", "value"])

    parts = postings.unionByName(heads).groupBy("lang", "block").applyInArrow(run, PAIRS)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, p: Audit = Audit()) -> DataFrame:
    """``lang, source, part, item, value, rank`` as in the module's docstring.

    Null text, lang and source are empty; a group without terms is compared by its baseline; a
    language without kept terms gives zeros; equal values are ranked by the item's UTF-8; repeated
    rows count twice; other columns are ignored; an empty table gives no rows. Counts are exact. The
    dense accumulators and their sum hold what the result holds: one number for two sources.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    index = materialize(term_index(docs, p), "terms")
    used = index.select("lang", F.explode("postings").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("n"))
    seen = docs.select("lang", "source").distinct()
    groups = materialize(seen.join(used, ["lang", "source"], "left").na.fill(0, ["n"]), "groups")
    sizes = index.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("n").alias("total"), F.sum(F.size("postings")).alias("postings")
    )
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    langs = sources.join(sizes, "lang", "left").na.fill(0, ["kept", "total", "postings"])
    block = F.greatest(F.lit(p.least_block), F.least(F.lit(p.most_block), F.col("sources") * F.col("sources")))
    langs = materialize(langs.withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("postings") / block))), "langs")

    per_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pair_sums(index, groups, langs, p).withColumn("rank", F.row_number().over(per_group))
    totals = groups.select("lang", "source", F.col("n").alias("own_total")).join(langs.select("lang", "kept", "total"), "lang")
    postings = index.select("lang", "term", F.col("n").alias("lang_n"), F.explode("postings").alias("x"))
    postings = postings.select("lang", "x.source", "term", "x.n", "lang_n").join(totals, ["lang", "source"])
    excess = share(F.col("n"), F.col("own_total"), F.col("kept"), p.prior) - share(F.col("lang_n"), F.col("total"), F.col("kept"), p.prior)
    over = postings.select("lang", "source", F.col("term").alias("item"), excess.alias("value")).filter("value > 0")
    over = over.withColumn("rank", F.row_number().over(per_group)).filter(F.col("rank") <= p.most_terms)

    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in (("pair", pairs), ("term", over))]
    result = materialize(out[0].unionByName(out[1]), "audit")
    discard(index, groups, langs)
    return result
