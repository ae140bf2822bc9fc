"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation, components."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.graph import components
from sightline.llm.text import map_texts, split_words, with_long_id
from sightline.session import discard, materialize


@dataclass(frozen=True)
class NearDup:
    """``similar`` of 100 is the least Jaccard similarity of a link.

    A pair at 0.75 shares no band with probability (1 - 0.75^5)^45 < 6e-6. The odd sketch folds one
    MinHash sample for each of ``bins`` parts of the hash range into ``bits`` parities. It only
    drops a candidate whose estimate lies below ``floor``: for the largest sets the floor is four
    standard deviations under 0.75. Where a side has ``small`` shingles or fewer, one bin that two
    of them share may move the estimate under the floor, so sketches are not asked there. ``parts``
    splits a bucket where neighbours are compared; ``block`` members of a bucket meet as many at once.
    Intermediate lists are written by one task for ``task_rows`` documents, or two for each core.
    """

    width: int = 5
    similar: int = 75
    bands: int = 45
    rows: int = 5
    bins: int = 1024
    bits: int = 2048
    floor: float = 0.67
    small: int = 64
    parts: int = 64
    block: int = 256
    task_rows: int = 5000
    seed: int = 20240607

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    found = split_words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)
    span = min(width, len(hashes))
    mixed = np.full(len(hashes) - span + 1, span, np.uint64)
    for i in range(span):
        mixed = (mixed ^ hashes[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def samples(own: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One minimum per hash function, in pieces that stay in the processor's cache."""
    short = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 512):
        np.minimum(least, (factors * short[at : at + 512] + offsets).min(axis=1), out=least)
    return least


def odd_sketch(own: np.ndarray, p: NearDup) -> tuple[int, np.ndarray]:
    """How many bins have a sample, and the parities of the samples as 64-bit words.

    ``own`` is sorted, so the least hash of a bin is the first in it.
    """
    part = own >> np.uint64(64 - (p.bins - 1).bit_length())
    least = own[np.append(True, part[1:] != part[:-1])]
    mixed = (least ^ (least >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    parity = np.bincount(((mixed >> np.uint64(33)) % np.uint64(p.bits)).astype(np.int64), minlength=p.bits) & 1
    return len(least), np.packbits(parity.astype(np.uint8)).view(np.int64)


def describe(docs: DataFrame, p: NearDup) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, n_samples, sketch`` per row; null for a document without words."""

    def make(texts, kept):
        rng = np.random.default_rng(p.seed)
        factors = rng.integers(0, 1 << 32, (p.samples, 1), np.uint32) | np.uint32(1)
        offsets = rng.integers(0, 1 << 32, (p.samples, 1), np.uint32)
        counts, digests, bands, sizes, sketches = [], [], [], [], []
        for text in texts:
            own = shingles(text, p.width)
            counts.append(len(own))
            if not len(own):
                for column in (digests, bands, sizes, sketches):
                    column.append(None)
                continue
            least = samples(own, factors, offsets)
            digests.append(xxhash.xxh3_128_digest(own.tobytes()))
            banded = enumerate(least.reshape(p.bands, p.rows))
            bands.append([xxhash.xxh3_64_intdigest(band.tobytes(), seed=i) - (1 << 63) for i, band in banded])
            size, sketch = odd_sketch(own, p)
            sizes.append(size)
            sketches.append(sketch)
        return kept["doc_id"], counts, digests, bands, sizes, sketches

    schema = "doc_id long, n_shingles long, digest binary, bands array<long>, n_samples int, sketch array<long>"
    return map_texts(with_long_id(docs), "text", ["doc_id"], make, schema)


def shingle_sets(docs: DataFrame, p: NearDup) -> DataFrame:
    """``doc_id, own``: the full shingle set of each row."""

    def make(texts, kept):
        return kept["doc_id"], [shingles(t, p.width).view(np.int64) for t in texts]

    return map_texts(with_long_id(docs), "text", ["doc_id"], make, "doc_id long, own array<long>")


def _near(p: NearDup) -> Column:
    """A pair whose sizes and sketches allow a link (columns of sides ``x`` and ``y``).

    The population count of the XOR gives the number of samples on one side only, and so that of
    the samples on both, ``same``. Bins with a different sample on each side count for two: how
    many there are follows from the sizes of two sets at ``floor``, with shared and own shingles
    spread over the bins at random.
    """
    words = F.zip_with("x.sketch", "y.sketch", lambda v, w: F.bit_count(v.bitwiseXOR(w)))
    odd = F.aggregate(words, F.lit(0), lambda total, n: total + n)
    a, b = F.col("x.n_samples"), F.col("y.n_samples")
    n_x, n_y = F.col("x.n_shingles"), F.col("y.n_shingles")
    shared = (n_x + n_y) * (p.floor / (1 + p.floor))
    empty = lambda n: F.exp(-n / p.bins)
    both = 1 - empty(n_x) - empty(n_y) + empty(n_x + n_y - shared)
    twice = (both - (1 - empty(n_x + n_y - shared)) * p.floor) * p.bins
    sizes = F.least(n_x, n_y) * 100 >= F.greatest(n_x, n_y) * p.similar
    # same >= (a + b - same - twice) * floor, solved for the population count, which then stands here once and as
    # a loop: word by word the join's code grows beyond what the JVM compiles, and each pair costs tenfold
    differing = a + b - (a + b - twice) * (2 * p.floor / (1 + p.floor))
    most = (1 - F.exp(differing * (-2.0 / p.bits))) * (p.bits / 2)
    return sizes & (F.least(odd, F.lit(p.bits // 2 - 1)) <= most)


def _open(p: NearDup) -> Column:
    """A pair that only full sets may discard: sizes allow a link, and sketches too unless a side is small."""
    few, many = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
    return (few * 100 >= many * p.similar) & ((few <= p.small) | _near(p))


def likely(pairs: DataFrame, sketches: DataFrame, p: NearDup) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and sketches leave over."""
    x, y = sketches.alias("x"), sketches.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.doc_id")).join(y, F.col("b") == F.col("y.doc_id"))
    return both.filter(_open(p)).select("a", "b").distinct()


def confirm(sets: DataFrame, pairs: DataFrame, p: NearDup) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are similar enough.

    Pairs may repeat where a doc_id does. They are not made distinct here, so that Spark can split the
    join where one document stands in very many pairs.
    """
    left = sets.select(F.col("doc_id").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("own").alias("own_b"))
    shared = F.size(F.array_intersect("own_a", "own_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", shared.alias("shared"), (F.size("own_a") + F.size("own_b")).alias("total"))
    return both.filter(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * p.similar).select("a", "b")


def open_members(members: DataFrame, labels: DataFrame, tasks: int | None = None) -> DataFrame:
    """``bucket, doc_id, component`` of the buckets that still hold more than one component."""
    labelled = members.join(labels, members.doc_id == labels.node, "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    # stored and merged, so that Spark can split a bucket with very many members
    mixed = materialize(mixed.filter("low < high").select("bucket"), "mixed", tasks)
    left = materialize(labelled.join(mixed.hint("merge"), "bucket", "left_semi"), "open", tasks)
    discard(mixed)
    return left


def chained(members: DataFrame, p: NearDup) -> DataFrame:
    """Pairs of neighbours of different components, in a random order of each part of a bucket."""
    part = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(p.parts))
    order = Window.partitionBy("bucket", "part").orderBy(F.xxhash64("bucket", "doc_id"), "doc_id")
    near = members.withColumn("part", part)
    for k in (1, 2):
        near = near.withColumns({f"doc{k}": F.lag("doc_id", k).over(order), f"component{k}": F.lag("component", k).over(order)})
    found = [near.filter(F.col(f"component{k}") != F.col("component")).select("doc_id", F.col(f"doc{k}").alias("other")) for k in (1, 2)]
    return found[0].union(found[1]).select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()


def across(members: DataFrame, classes: DataFrame, p: NearDup, tasks: int | None = None) -> DataFrame:
    """All pairs of one bucket and different components that sizes and sketches leave over.

    A pair that meets in several buckets comes from the smallest of them. The members of a bucket are
    cut into blocks by a hash, and each block meets itself and each later one under a key of its own, so
    no task gets more than the pairs of two blocks.
    """
    blocks = materialize(members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / p.block).alias("blocks")), "blocks", tasks)
    members = members.join(blocks.hint("merge"), "bucket")
    own = F.pmod(F.xxhash64(F.lit(p.seed), "doc_id"), F.col("blocks"))
    sides = classes.select("doc_id", "n_shingles", "n_samples", "sketch", "bands")
    members = materialize(members.withColumn("own", own).join(sides, "doc_id"), "across", tasks)
    later = F.explode(F.sequence("own", F.col("blocks") - 1))
    earlier = F.explode(F.sequence(F.lit(0).cast("long"), F.col("own")))
    x = members.withColumns({"left": F.col("own"), "right": later}).alias("x")
    y = members.withColumns({"left": earlier, "right": F.col("own")}).alias("y")
    first = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket")
    met = reduce(Column.__and__, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("bucket", "left", "right")])
    # in one block a pair stands in both orders, in two blocks in one
    once = (F.col("x.component") < F.col("y.component")) | ((F.col("x.left") < F.col("x.right")) & (F.col("x.component") > F.col("y.component")))
    both = x.join(y, met & once & _open(p) & first)
    return both.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def near_components(docs: DataFrame, p: NearDup | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Equal shingle sets are one class, of which the smallest ``doc_id`` stands for all. Classes
    meet in bands, and a bucket is worked off in three steps, each only where the one before left
    several components: its members against its smallest, neighbours in a random order, and then
    every pair of different components. So a bucket full of copies costs a few comparisons each,
    and every pair of a bucket is looked at. Sketches discard hopeless pairs of larger sets, small
    ones go to the full sets at once; a link counts only when the full sets confirm it.

    A null or empty text has no shingles and is linked with nothing. Rows with one ``doc_id`` are
    one document that is linked by any of its texts; rows without one are linked with nothing. An
    empty table gives an empty result; further columns are ignored.
    """
    p = p or NearDup()
    rows = materialize(describe(docs, p), "minhash")
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, rows.count() // p.task_rows)
    full = rows.filter(F.col("digest").isNotNull())
    classes = materialize(_first_of(full).select("digest", "doc_id", "n_shingles", "bands", "n_samples", "sketch"), "classes", tasks)
    sketches = classes.select("doc_id", "n_shingles", "n_samples", "sketch")

    posted = classes.filter("doc_id is not null").select(F.explode("bands").alias("bucket"), "doc_id")
    buckets = posted.groupBy("bucket").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last"))
    buckets = materialize(buckets.filter("lead < last").select("bucket", "lead"), "buckets", tasks)
    members = materialize(posted.join(buckets.hint("merge"), "bucket"), "members", tasks)
    discard(buckets)
    # texts are always met by a sort-merge join, so that the plan is the same at every size
    wanted = members.select("doc_id").distinct().hint("merge")
    sets = materialize(shingle_sets(with_long_id(docs).join(wanted, "doc_id", "left_semi"), p), "sets", tasks)

    def linked(labels: DataFrame | None, pairs: DataFrame) -> DataFrame:
        edges = confirm(sets, pairs, p)
        if labels is not None:
            edges = edges.union(labels.select("node", "component"))
        return components(edges, "a", "b", tasks=tasks)

    star = members.filter("doc_id != lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
    labels = materialize(linked(None, likely(star, sketches, p)), "labels", tasks)
    left = open_members(members.select("bucket", "doc_id"), labels, tasks)
    discard(members)
    labels = materialize(linked(labels, likely(chained(left, p), sketches, p)), "labels", tasks)
    left = open_members(left.select("bucket", "doc_id"), labels, tasks)
    edges = confirm(sets, across(left, classes, p, tasks), p).union(labels.select("node", "component"))

    named = classes.select("digest", F.col("doc_id").alias("head"))
    copies = full.select("doc_id", "digest").join(named, "digest").filter("doc_id != head")
    final = materialize(components(edges.union(copies.select("doc_id", "head")), "a", "b", tasks=tasks), "components", tasks)
    discard(classes, sets, left, labels)
    out = rows.select("doc_id", "n_shingles").join(final, rows.doc_id == final.node, "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))


def _first_of(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last())
    return rows.withColumn("place", F.row_number().over(order)).filter("place = 1")


def deduplicated(docs: DataFrame, p: NearDup | None = None) -> DataFrame:
    """The rows of ``docs`` that are the first of their group; all columns stay.

    Of rows that repeat a kept ``doc_id`` all but one go as well.
    """
    kept = near_components(docs, p).filter("kept")
    number = kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    number = materialize(number, "kept")
    # documents without an id keep nothing to be told apart by, and stay
    joined = docs.join(number.select("doc_id"), "doc_id", "left_semi")
    if not number.filter("n > 1").isEmpty():
        joined = joined.dropDuplicates(["doc_id"])
    return joined.union(docs.filter(F.col("doc_id").isNull()))
