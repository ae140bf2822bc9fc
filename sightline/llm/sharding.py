"""Shards of near equal size by sampled splitters over the key (text hash, doc_id)."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import discard, materialize


@dataclass(frozen=True)
class Sharding:
    """``samples`` keys are drawn in expectation; the driver holds those and ``ranges`` rows.

    A range is overfull at ``overfull`` times the mean size and then cut by a finer sample of its
    own rows, at most ``rounds`` times.
    """

    shards: int = 8
    ranges: int = 1024
    samples: int = 16384
    overfull: float = 2.0
    rounds: int = 4


def sized(docs: DataFrame) -> DataFrame:
    """One narrow row per document, stored once: everything later reads this instead of texts.

    ``key`` is the hash of the text, so equal texts lie side by side; ``part`` orders rows within
    one text by ``doc_id``, and rows equal in both by their position.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialize(rows, "sized")


def _drawn(rows: DataFrame, rate: Column) -> DataFrame:
    """Rows drawn with probability size x rate, decided by a hash, so that reruns agree."""
    chance = F.pmod(F.xxhash64("key", "part", "row", F.lit(97)), F.lit(1 << 40)) / float(1 << 40)
    return rows.filter(chance < F.col("size") * rate)


def splitters(sample: list[tuple], ranges: int) -> list[tuple]:
    """Quantile boundaries ``(key, part, row)`` of the weighted sample.

    A boundary is moved to the start of its text's group, unless the group holds several quantiles:
    only such a group is cut inside.
    """
    if not sample:
        return []
    sample = sorted(sample)
    reached = list(accumulate(w for *_, w in sample))
    cuts = [sample[min(bisect_right(reached, reached[-1] * i / ranges), len(sample) - 1)][:3] for i in range(1, ranges)]
    keys = pd.Series([c[0] for c in cuts]).value_counts()
    first = -(1 << 63)
    return sorted({c if keys[c[0]] > 1 else (c[0], first, first) for c in cuts} | {(c[0], first, first) for c in cuts})


def located(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Adds ``range``: how many boundaries are at or before the row's key. Bounded by the cuts."""
    keys = np.array([c[0] for c in cuts], np.int64)

    @F.pandas_udf("int")
    def place(key: pd.Series, part: pd.Series, row: pd.Series) -> pd.Series:
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        for i in np.flatnonzero(high > low):  # the row's own text has boundaries
            low[i] = bisect_right(cuts, (key.iat[i], part.iat[i], row.iat[i]))
        return pd.Series(low.astype(np.int32))

    return rows.withColumn("range", place("key", "part", "row") if cuts else F.lit(0))


def fitted(rows: DataFrame, p: Sharding) -> tuple[list[tuple], list[int]]:
    """Boundaries, and the shard of each range, from exact sizes of ranges."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [], [0]
    mean = total / p.ranges
    weight = F.greatest(F.col("size").cast("double"), F.lit(total / p.samples))
    names = ["key", "part", "row"]
    sample = _drawn(rows, F.lit(p.samples / total)).select(*names, weight.alias("w")).collect()
    cuts = splitters([tuple(r) for r in sample], p.ranges)
    for _ in range(p.rounds):
        placed = located(rows, cuts)
        sizes = placed.groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.max("size").alias("most")).collect()
        over = {r["range"]: r["size"] for r in sizes if r["n"] > 1 and r["size"] > max(p.overfull * mean, 1.01 * r["most"])}
        if not over:
            break
        # about 64 draws for each mean size, from overfull ranges alone
        finer = _drawn(placed.filter(F.col("range").isin(list(over))), F.lit(64 / mean))
        weight = F.greatest(F.col("size").cast("double"), F.lit(mean / 64))
        more: dict[int, list] = {}
        for r in finer.select("range", *names, weight.alias("w")).collect():
            more.setdefault(r["range"], []).append(tuple(r)[1:])
        new = {c for number, own in more.items() for c in splitters(own, int(over[number] / mean) + 1)}
        if new <= set(cuts):
            break
        cuts = sorted(set(cuts) | new)
    sizes = dict(located(rows, cuts).groupBy("range").agg(F.sum("size")).collect())
    return cuts, shard_of_ranges([sizes.get(i, 0) for i in range(len(cuts) + 1)], p.shards)


def shard_of_ranges(sizes: list[int], shards: int) -> list[int]:
    """Consecutive ranges per shard: the edge of a shard is the cut nearest to its ideal place."""
    ends = [0, *accumulate(sizes)]
    edges = []
    for s in range(1, shards):
        ideal = ends[-1] * s / shards
        at = bisect_right(ends, ideal)
        edges.append(at - 1 if at == len(ends) or ideal - ends[at - 1] <= ends[at] - ideal else at)
    return [bisect_right(edges, i) for i in range(len(sizes))]


def shard_table(docs: DataFrame, p: Sharding | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: shards of near equal bytes.

    Rows are numbered from 0 in each shard by range, and within a range by key, so no window spans
    more than one range. A shard's size differs from the ideal by at most two ranges; a range is
    larger than twice the mean only where one document is. Equal texts share a shard unless their
    group reaches over a shard's edge and fills several ranges.

    A null text has one byte; it and empty texts are ordinary rows. Rows without a doc_id come
    first within their text. Repeated rows are counted and placed each. An empty table gives no
    rows; other columns are ignored.
    """
    p = p or Sharding()
    rows = sized(docs)
    cuts, shards = fitted(rows, p)
    shard = F.element_at(F.array(*map(F.lit, shards)), F.col("range") + 1)
    placed = materialize(located(rows, cuts).withColumn("shard", shard), "placed")
    discard(rows)
    counts = sorted(tuple(r) for r in placed.groupBy("shard", "range").agg(F.count(F.lit(1))).collect())
    starts, before = [0] * len(shards), {}
    for s, number, n in counts:  # one row for each range
        starts[number] = before.get(s, 0)
        before[s] = starts[number] + n
    order = Window.partitionBy("range").orderBy("key", "part", "row")
    start = F.element_at(F.array(*(F.lit(x).cast("long") for x in starts)), F.col("range") + 1)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (start + F.row_number().over(order) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, p: Sharding | None = None) -> None:
    """Write all columns of ``docs`` as Parquet under ``shard=<n>``, in one pass over the texts.

    Documents are range-partitioned by the fitted boundaries, so a task holds some ranges of one
    key interval and a hot text is spread over as many tasks as it has ranges. A column ``shard``
    of ``docs`` itself is replaced.
    """
    p = p or Sharding()
    rows = sized(docs)
    cuts, shards = fitted(rows, p)
    discard(rows)
    text = F.col("text").cast("string")
    part = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    own = F.struct(*(c for c in docs.columns if c != "shard")).alias("own")
    keyed = docs.select(own, F.xxhash64(text).alias("key"), part.alias("part"), F.monotonically_increasing_id().alias("row"))
    shard = F.element_at(F.array(*map(F.lit, shards)), F.col("range") + 1)
    placed = located(keyed, cuts).withColumn("shard", shard)
    placed.repartition("shard", "range").select("own.*", "shard").write.partitionBy("shard").parquet(path)
