"""Mixing sources to target weights: exact block quotas per output shard, disjoint permuted blocks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.text import GAP, WORD
from sightline.operators.ids import assign_dense_ids
from sightline.session import discard, materialize, new_scratch

#: the column in which rows are numbered while they are mixed
UID = "_mixing_uid"


@dataclass(frozen=True)
class Mix:
    """``share`` of all words is taken, by ``weights`` repeated over the sources in code point order.

    A source gives at most ``most`` times its words; a block is ``block_words`` words of one
    document. The tree splits the quotas of ``chunk`` strata (a source and a pass) at a time.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    block_words: int = 4096
    shards: int = 64
    buckets: int = 1024
    chunk: int = 4096
    seed: int = 11


def with_targets(sources: DataFrame, p: Mix) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: shares of the total by weight; what a
    source cannot give is shared again by the others. One aggregate over the sources for each round."""
    full = F.lit(p.most) * F.col("source_size")
    unit, given = None, F.lit(False)
    while True:
        total, held, weights = sources.agg(
            F.sum("source_size"), F.sum(F.when(given, full)), F.sum(F.when(~given, F.col("weight")))
        ).first()
        if not weights:
            break
        after = (p.share * total - (held or 0)) / weights
        if after == unit:
            break
        unit = after
        given = given | (F.lit(unit) * F.col("weight") > full)
    shared = F.lit(0.0) if unit is None else F.lit(unit) * F.col("weight")
    return sources.withColumn("target", F.when(given, full.cast("double")).otherwise(shared))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn``; beyond the generator's range by its normal limit, kept in bounds."""
    total = good + bad
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    if total < 10**9:
        return int(rng.hypergeometric(good, bad, drawn))
    mean = drawn * (good / total)
    deviation = (mean * (bad / total) * ((total - drawn) / (total - 1))) ** 0.5
    return min(max(round(rng.normal(mean, deviation)), low), high)


def split_quotas(quotas: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Blocks of each stratum (inner list) for each shard, by a binary tree of exact splits.

    A node's quotas are divided between its halves by one multivariate hypergeometric draw, stratum
    by stratum. Rows sum to the shard ``sizes``, columns to the quotas.
    """
    rng = np.random.default_rng(seed)
    leaves: list[list[int]] = [[]] * len(sizes)
    nodes = [(0, len(sizes), list(quotas))]
    while nodes:
        low, high, own = nodes.pop()
        if high - low == 1:
            leaves[low] = own
            continue
        middle = (low + high) // 2
        wanted, rest, left = sum(sizes[low:middle]), sum(own), []
        for q in own:
            n = hypergeometric(rng, q, rest - q, wanted)
            left.append(n)
            wanted, rest = wanted - n, rest - q
        nodes += [(low, middle, left), (middle, high, [q - n for q, n in zip(own, left, strict=True)])]
    return leaves


def even(total: int, shards: int) -> list[int]:
    """Sizes at most one apart that sum to the total."""
    return [total * (j + 1) // shards - total * j // shards for j in range(shards)]


def leaf_starts(quotas: DataFrame, p: Mix) -> DataFrame:
    """``stratum, starts``: the rank of the first block of every shard but the first.

    ``quotas`` has one row per stratum. The tree first divides chunks of strata among the shards, by
    their sums, and then, chunk after chunk, the strata of each. Only the sums of the chunks and the
    strata of one chunk are on the driver at once; the result is a stored table.
    """
    spark = quotas.sparkSession
    schema = "stratum long, starts array<long>"
    chunk = F.floor(F.col("stratum") / p.chunk).alias("chunk")
    sums = sorted(map(tuple, quotas.groupBy(chunk).agg(F.sum("quota")).collect()))
    of_chunks = split_quotas([n for _, n in sums], even(sum(n for _, n in sums), p.shards), p.seed)
    path = new_scratch(spark, "leaves")
    spark.createDataFrame([], schema).write.parquet(path)
    for i, (number, _) in enumerate(sums):
        rows = quotas.filter((F.col("stratum") >= number * p.chunk) & (F.col("stratum") < (number + 1) * p.chunk))
        own = sorted(map(tuple, rows.select("stratum", "quota").collect()))
        leaves = np.array(split_quotas([q for _, q in own], [shard[i] for shard in of_chunks], p.seed + 1 + number), np.int64)
        starts = np.cumsum(leaves.reshape(p.shards, -1), axis=0)[:-1].T.tolist()
        found = [(stratum, x) for (stratum, _), x in zip(own, starts, strict=True)]
        spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, uid``, stored once; ``size`` is the number of words. ``uid`` is a column of
    ``docs``, or made here."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    uid = F.col(UID) if UID in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(doc_id, F.col("source").cast("string").alias("source"), size.alias("size"), uid.alias("uid"))
    return materialize(rows, "measured")


def _key(p: Mix, turn: int | Column, block: Column) -> Column:
    """Place of a block in the random order of its source; depends on ids alone."""
    return F.xxhash64(F.lit(p.seed), F.lit(turn) if isinstance(turn, int) else turn, "doc_id", block)


def planned(rows: DataFrame, p: Mix) -> DataFrame:
    """``source, source_size, target, cuts``: targets, and for each pass where in the source's random
    order the leaves of the splitting tree begin and where its words are reached.

    A source is gone through at most ``most`` times (passes), each in an order of its own. Words and
    blocks before a block are sums over hash buckets plus a window inside one bucket, so a source
    with a third of all rows is spread over ``buckets`` windows.
    """
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("last", F.col("source").isNull())
    placed = assign_dense_ids(found, ["last", "source"], 0, "position")
    weights = F.array(*[F.lit(w) for w in p.weights])
    weight = F.get(weights, (F.col("position") % len(p.weights)).cast("int"))
    sources = materialize(with_targets(placed.withColumn("weight", weight), p), "sources")

    turns = F.explode(F.sequence(F.lit(0), F.lit(p.most - 1))).alias("turn")
    strata = sources.select("source", "source_size", F.bround("target").cast("long").alias("wanted"), "position", turns)
    need = F.least(F.col("wanted") - F.col("turn") * F.col("source_size"), F.col("source_size"))
    stratum = F.col("position") * p.most + F.col("turn")
    strata = materialize(strata.select("source", "turn", need.alias("need"), stratum.alias("stratum")).filter("need > 0"), "strata")

    starts = F.sequence(F.lit(0), F.floor((F.col("size") - 1) / p.block_words))
    blocks = rows.filter("size > 0").withColumn("block", F.explode(starts))
    blocks = blocks.join(strata.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    key = _key(p, F.col("turn"), F.col("block").cast("long"))
    words = F.least(F.lit(p.block_words), F.col("size") - F.col("block") * p.block_words)
    blocks = blocks.select("stratum", "need", "uid", "block", key.alias("key"), words.cast("long").alias("words"))
    # buckets follow the order of keys
    blocks = blocks.withColumn("bucket", F.shiftright("key", 32).cast("long") * p.buckets / float(1 << 32))
    blocks = materialize(blocks.withColumn("bucket", F.floor("bucket").cast("int")), "blocks")
    sums = blocks.groupBy("stratum", "bucket").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("stratum").orderBy("bucket")
    sums = sums.select("stratum", "bucket", *((F.sum(c).over(over) - F.col(c)).alias(f"{c}_before") for c in ("w", "n")))
    within = Window.partitionBy("stratum", "bucket").orderBy("key", "uid", "block")
    ranked = (
        blocks.withColumns({"w_in": F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, 0)), "n_in": F.row_number().over(within)})
        .join(sums, ["stratum", "bucket"])
        .select("stratum", "need", "uid", "block", "key", "words", (F.col("w_before") + F.col("w_in") - F.col("words")).alias("before"), (F.col("n_before") + F.col("n_in") - 1).alias("rank"))
    )
    ranked = materialize(ranked.filter("before < need"), "ranked")
    last = ranked.filter("before + words >= need").select("stratum", "rank", "key", "uid", "block", (F.col("need") - F.col("before")).alias("cut"))
    last = materialize(last, "last")
    leaves = leaf_starts(last.select("stratum", (F.col("rank") + 1).alias("quota")), p)
    # where leaves begin, as blocks: a leaf after the last block begins at the end of the order
    wanted = leaves.select("stratum", F.posexplode("starts").alias("leaf", "rank"))
    ends = F.struct(*[F.lit((1 << 63) - 1).alias(c) for c in ("key", "uid", "block")])
    at = F.when(F.col("key").isNotNull(), F.struct("key", "uid", F.col("block").cast("long").alias("block"))).otherwise(ends)
    edges = wanted.join(ranked.select("stratum", "rank", "key", "uid", "block"), ["stratum", "rank"], "left")
    edges = edges.groupBy("stratum").agg(F.transform(F.array_sort(F.collect_list(F.struct("leaf", at.alias("at")))), lambda x: x["at"]).alias("edges"))
    cuts = last.join(edges, "stratum", "left").join(strata.select("stratum", "source", "turn"), "stratum")
    none = F.array().cast("array<struct<key:bigint,uid:bigint,block:bigint>>")
    cut = F.struct("turn", "key", "uid", F.col("block").cast("long").alias("block"), "cut", F.coalesce("edges", none).alias("edges"))
    cuts = cuts.groupBy(F.col("source").alias("s")).agg(F.array_sort(F.collect_list(cut)).alias("cuts"))
    plan = sources.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    plan = materialize(plan.select("source", "source_size", "target", "cuts"), "plan")
    discard(sources, strata, blocks, ranked, last)
    return plan


def _taken(p: Mix, turn: int, block: Column) -> Column:
    """Words taken from a block in a pass: all before the cut, some at it, none after."""
    cut = F.get("cuts", F.lit(turn))
    own = F.struct(_key(p, turn, block).alias("key"), F.col("uid"), block.alias("block"))
    at = F.struct(cut["key"].alias("key"), cut["uid"].alias("uid"), cut["block"].alias("block"))
    words = F.least(F.lit(p.block_words), F.col("size") - block * p.block_words)
    taken = F.when(own < at, words).when(own == at, cut["cut"]).otherwise(0)
    return F.when(cut.isNull(), 0).otherwise(taken).cast("long")


def _blocks(p: Mix) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(F.col("size") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / p.block_words))).otherwise(none)


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    sources = plan.withColumnRenamed("source", "planned_source")
    return rows.join(sources, F.col("source").eqNullSafe(F.col("planned_source")), "left")


def _draws(p: Mix) -> Column:
    """The drawn blocks of a row: block, words, the shard whose leaf holds it, and its key."""

    def drawn(turn: int):
        def block(b: Column) -> Column:
            key = _key(p, turn, b)
            at = F.struct(key.alias("key"), F.col("uid"), b.alias("block"))
            shard = F.size(F.filter(F.get("cuts", F.lit(turn))["edges"], lambda e: e <= at))
            return F.struct(b.alias("block"), _taken(p, turn, b).alias("words"), shard.alias("shard"), key.alias("key"))

        return block

    turns = [F.transform(_blocks(p), drawn(turn)) for turn in range(p.most)]
    return F.filter(F.concat(*turns), lambda d: d["words"] > 0)


def mix_table(docs: DataFrame, p: Mix | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, shard_words`` of every row.

    ``shard_words`` lists the drawn blocks of the row: the shard whose leaf of the splitting tree holds
    the block, and its words; ``taken`` is their sum. A null text has no words and nothing is taken
    from it; a null source is a source of its own, the last. Repeated rows are drawn each. An empty
    table gives no rows. The draw depends on ``doc_id`` and the seed, so reruns agree.
    """
    p = p or Mix()
    rows = measured(docs)
    joined = _with_plan(rows, planned(rows, p)).withColumn("draws", _draws(p))
    total = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    by_shard = F.transform("draws", lambda d: F.struct(d["shard"].alias("shard"), d["words"].alias("words")))
    return joined.select("doc_id", "size", "source_size", "target", total.alias("taken"), F.array_sort(by_shard).alias("shard_words"))


def mixed(docs: DataFrame, p: Mix | None = None) -> DataFrame:
    """The taken blocks as rows with the columns of ``docs``, dealt to shards and shuffled in each.

    ``text`` holds the words taken, with the white space between them; ``n_chars`` follows it. A
    document of several blocks, or taken twice, gives several rows.
    """
    p = p or Mix()
    # the place of a row in its source is drawn by stored ids, so both uses of them agree
    docs = materialize(docs.withColumn(UID, F.monotonically_increasing_id()), "mixed")
    columns = [c for c in docs.columns if c != UID]
    sizes = measured(docs)
    plan = planned(sizes, p)
    discard(sizes)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct(*columns).alias("own"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        text.alias("text"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(UID).alias("uid"),
    )
    every = _with_plan(rows, plan).withColumn("draw", F.explode(_draws(p)))
    # a word with the white space after it; joining them gives back the text
    trimmed = F.regexp_replace("text", "^" + GAP, "")
    pieces = F.split(trimmed, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    some = F.array_join(F.slice(pieces, (F.col("draw.block") * p.block_words + 1).cast("int"), F.col("draw.words").cast("int")), "")
    whole = F.col("draw.words") == F.col("size")
    every = every.withColumn("taken_text", F.when(whole, F.col("text")).otherwise(some))
    every = every.repartition("draw.shard", F.pmod("draw.key", F.lit(16))).sortWithinPartitions("draw.shard", "draw.key")
    changed = {"text": F.col("taken_text"), "n_chars": F.length("taken_text").cast("long")}
    return every.select(*(changed.get(c, F.col("own")[c]).alias(c) for c in columns))
