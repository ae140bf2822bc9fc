"""The trie of conversation prefixes, with subtree totals by time-forward processing.

A prefix is named by its length and the sum, modulo 2^62 and twice over, of a SHA-256 of each of its
turns with the turn's place. Sums run along conversations that are cut over many tasks, so no
conversation is gathered, however long. Equal names make a node; nodes are counted by partial sums.

Subtree totals travel bottom-up. Maximal subtrees of at most a capacity of rows are units, dealt to
shards by the name of their top. A shard sorts its nodes by reverse level order and passes each
node's totals forward to its parent through a priority queue that spills. Totals of the tops go to
the few nodes above all units. Those form paths (nodes of one smallest member); the paths are
processed in the same way, and running sums along them give the totals of their nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sightline.session import discard, materialize

#: names of prefixes are sums modulo 2^62, which wrapped 64-bit sums keep
MODULUS = 1 << 62
MASK = MODULUS - 1
#: fixed values: a conversation takes turns of the first of its five, at most eight of them
FAMILY, MOST_TAKEN = 5, 8
NODE = ["depth", "a", "b"]


@dataclass(frozen=True)
class Trie:
    """``share``: a unit holds at most this part of all rows, but ``least_unit`` at least and
    ``most_unit`` at most. ``queue``: messages a shard holds in memory. ``chunk``: ids of one row
    when the ids that end at a node are put in order."""

    share: int = 64
    least_unit: int = 256
    most_unit: int = 200_000
    queue: int = 100_000
    chunk: int = 4096


def running_sums(rows: DataFrame, key: str, order: list[Column | str], values: list[str], keep: list[str], mask: int = -1) -> DataFrame:
    """``key``, ``keep`` and the running sums of ``values`` per key in the given order.

    Rows are dealt by ranges of (key, order), so a key is cut over tasks as needed. Each task sums
    its own rows; the sum a key brings from the tasks before it comes from one row per task.
    """
    order = [key, *order]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(key, *keep, *values)
    schema = StructType([*dealt.schema.fields]).add("_task", "long").add("_at", "long")
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, last, held = TaskContext.get().partitionId(), 0, None, dict.fromkeys(values, np.int64(0))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy()
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            starts, group = np.flatnonzero(new), np.cumsum(new) - 1
            columns = {name: batch.column(name) for name in (key, *keep)}
            for name in values:
                x = batch.column(name).to_numpy()
                total = np.cumsum(x)
                total -= (total[starts] - x[starts])[group]
                if keys[0] == last:
                    total[group == 0] += held[name]
                total &= mask
                held[name] = total[-1]
                columns[name] = pa.array(total)
            last = keys[-1]
            places = [pa.array(np.full(n, task, np.int64)), pa.array(np.arange(done, done + n))]
            done += n
            yield pa.RecordBatch.from_arrays([*columns.values(), *places], schema=target)

    stored = materialize(dealt.mapInArrow(run, schema), "sums")
    ends = stored.groupBy("_task").agg(
        F.min_by(key, "_at").alias("first"), F.max_by(F.struct(key, *values), "_at").alias("last")
    )
    # sums that reach the end of a task, over all tasks that end in the same key
    so_far = Window.partitionBy(f"last.{key}").orderBy("_task")
    modulus = F.lit(mask + 1).cast("decimal(38,0)")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).over(so_far)
    summed = {f"_{v}": (F.pmod(wide(f"last.{v}"), modulus) if mask > 0 else wide(f"last.{v}")).cast("long") for v in values}
    reached = ends.select("_task", "first", F.col(f"last.{key}").alias("_key"), *[c.alias(n) for n, c in summed.items()])
    before = Window.orderBy("_task")  # one row per task
    carried = reached.select(
        "_task", F.col("first").alias(key), F.lag("_key").over(before).alias("_key"),
        *[F.lag(name).over(before).alias(name) for name in summed],
    ).filter(F.col("_key") == F.col(key)).drop("_key")

    def added(name: str) -> Column:
        value = F.col(name) + F.coalesce(F.col(f"_{name}"), F.lit(0))
        return (value.bitwiseAND(F.lit(mask)) if mask > 0 else value).alias(name)

    return stored.join(carried, ["_task", key], "left").select(key, *keep, *[added(v) for v in values])


class SpillingQueue:
    """Messages ``(level, a, b, leaves, saved)`` to nodes that come later in the order of the first
    three. At most ``most`` stay in memory; sorted runs go to files that vanish with the task."""

    RECORD = struct.Struct("<5q")
    READ = 1024 * RECORD.size

    def __init__(self, most: int):
        self.most = most
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (next record, run number, records after it)
        self.spilled = 0

    def push(self, *message: int) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()  # noqa: SIM115
        self.heap.sort()
        for at in range(0, len(self.heap), 1024):
            run.write(b"".join(self.RECORD.pack(*m) for m in self.heap[at : at + 1024]))
        run.seek(0)
        self.heap.clear()
        self.spilled += 1
        self._advance(self._records(run))

    def _records(self, run) -> Iterator[tuple]:
        with run:
            while block := run.read(self.READ):
                yield from self.RECORD.iter_unpack(block)

    def _advance(self, records: Iterator[tuple]) -> None:
        first = next(records, None)
        if first is not None:
            heapq.heappush(self.runs, (first, id(records), records))

    def take(self, node: tuple[int, int, int]) -> tuple[int, int, int]:
        """How many messages the node got, and their sums."""
        count = leaves = saved = 0
        while self.heap and self.heap[0][:3] == node:
            message = heapq.heappop(self.heap)
            count, leaves, saved = count + 1, leaves + message[3], saved + message[4]
        while self.runs and self.runs[0][0][:3] == node:
            message, _, records = heapq.heappop(self.runs)
            count, leaves, saved = count + 1, leaves + message[3], saved + message[4]
            self._advance(records)
        return count, leaves, saved


def forward_totals(nodes: DataFrame, queue: int) -> DataFrame:
    """``level, a, b, n_children, n_leaves, saved``, totals of subtrees within each partition.

    ``nodes`` are sorted within partitions by (level, a, b), children first: level, a, b, the name of
    the parent (to_level, to_a, to_b; to_level null where totals leave the partition), leaves (null:
    one for a node that gets no message) and saved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(queue)
        for batch in batches:
            out = []
            for level, a, b, to_level, to_a, to_b, leaves, saved in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                children, below, total = waiting.take((level, a, b))
                below += (leaves or 0) if leaves is not None or children else 1
                total += saved
                out.append((level, a, b, children, below, total))
                if to_level is not None:
                    waiting.push(to_level, to_a, to_b, below, total)
            if out:
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["level", "a", "b", "n_children", "n_leaves", "saved"])

    columns = ["level", "a", "b", "to_level", "to_a", "to_b", "leaves", "saved"]
    return nodes.select(*columns).mapInArrow(run, "level long, a long, b long, n_children long, n_leaves long, saved long")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, digest, bytes, turns``: the turns of every rebuilt conversation, and a row of
    depth 0 for each; ``turns`` is how many the conversation has."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.filter("conv_id is not null").select(
        "*", F.octet_length("text").cast("long").alias("bytes"), F.lit(1).cast("long").alias("place"),
        F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = running_sums(rows, "conv_id", ["turn", "role", "text", "row"], ["place"], ["digest", "bytes"])
    heads = placed.filter(F.col("place") <= MOST_TAKEN).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "bytes"))).alias("head")
    )
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MOST_TAKEN + 1)).cast("int")
    own = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first")
    )
    given = F.least("h", F.coalesce(F.size("head"), F.lit(0)))
    plans = own.join(heads.withColumnRenamed("conv_id", "first"), "first", "left").select(
        "conv_id", "h", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("turns"), "head"
    )
    plans = materialize(plans, "plans")
    root = F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("bytes")))
    before = F.concat(root, F.coalesce(F.slice("head", 1, F.col("given")), F.slice(root, 1, 0)))
    heads = plans.select("conv_id", "turns", F.explode(before).alias("x")).select(
        "conv_id", F.col("x.place").alias("depth"), "x.digest", "x.bytes", "turns"
    )
    rest = placed.filter(F.col("place") > taken).join(plans.select("conv_id", "h", "given", "turns"), "conv_id")
    return heads.unionByName(rest.select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("depth"), "digest", "bytes", "turns"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, turns, bytes, a, b, up_a, up_b``: one row for each prefix of each conversation."""
    name = F.sha2(F.concat("depth", F.lit(":"), "digest"), 256)

    def part(start: int) -> Column:  # 15 hexadecimal digits are 60 bits
        return F.when(F.col("depth") > 0, F.conv(F.substring(name, start, 15), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))

    own = turns.select("conv_id", "depth", "turns", "bytes", part(1).alias("a"), part(17).alias("b"), part(1).alias("own_a"), part(17).alias("own_b"))
    summed = running_sums(own, "conv_id", ["depth"], ["a", "b"], ["depth", "turns", "bytes", "own_a", "own_b"], MASK)
    up = lambda c: F.pmod(F.col(c) - F.col(f"own_{c}"), F.lit(MODULUS)).alias(f"up_{c}")
    return summed.select("conv_id", "depth", "turns", "bytes", "a", "b", up("a"), up("b"))


def ends_hashes(rows: DataFrame, chunk: int) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the nodes at which conversations end.

    Ids are put in order by ranges and joined to long strings there; a node's strings are hashed one
    after the other, so the ids of a hot node are never held together.
    """
    order = [*NODE, "conv_id"]
    ordered = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(NODE, node, strict=True)) | {"first": ids[0], "ids": ",".join(map(str, ids))}], schema=parts)

        parts = pa.schema([*((c, pa.int64()) for c in (*NODE, "first")), ("ids", pa.string())])
        for batch in batches:
            found = []
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != node or len(ids) == chunk:
                    if ids:
                        found.append(row())
                    node, ids = own, []
                ids.append(conv)
            if found:
                yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
        if ids:
            yield row()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        made = pa.schema([*((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string())])
        row = lambda: dict(zip(NODE, node, strict=True)) | {"ends_sha256": state.hexdigest()}
        for batch in batches:
            found = []
            for *own, ids in zip(*(c.to_pylist() for c in batch.select([*NODE, "ids"]).columns), strict=True):
                if own != node:
                    if state:
                        found.append(row())
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=made)
        if state:
            yield pa.RecordBatch.from_pylist([row()], schema=made)

    names = ", ".join(f"{c} long" for c in NODE)
    texts = ordered.mapInArrow(joined, f"{names}, first long, ids string")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{names}, ends_sha256 string")


def _top_totals(heavy: DataFrame, tops: DataFrame, p: Trie) -> DataFrame:
    """Totals of the nodes above all units: ``depth, a, b, n_children, n_leaves, saved``."""
    from_units = tops.groupBy("up_depth", "up_a", "up_b").agg(
        F.count(F.lit(1)).alias("units"), F.sum("n_leaves").alias("unit_leaves"), F.sum("saved").alias("unit_saved")
    )
    inner = heavy.groupBy((F.col("depth") - 1).alias("up_depth"), "up_a", "up_b").agg(F.count(F.lit(1)).alias("inner"))
    key = [F.col("depth").alias("up_depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b")]
    up = ["up_depth", "up_a", "up_b"]
    here = heavy.select(*key, F.col("conv_id").alias("path"), F.col("parent_conv_id").alias("on"), "saved_here")
    here = here.join(from_units, up, "left").join(inner, up, "left").na.fill(0, ["units", "unit_leaves", "unit_saved", "inner"])
    children = F.col("units") + F.col("inner")
    here = here.select(
        "path", "on", *up, children.alias("n_children"), (F.col("saved_here") + F.col("unit_saved")).alias("saved"),
        (F.col("unit_leaves") + (children == 0).cast("long")).alias("leaves"),
    )
    here = materialize(here, "above")
    # one row per path: what its nodes hold, and the path its top hangs on
    paths = here.groupBy("path").agg(
        F.min("up_depth").alias("top"), F.min_by("on", "up_depth").alias("on"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    paths = materialize(paths, "paths")
    parents = paths.select(F.col("path").alias("on"), F.col("top").alias("on_top"))
    ordered = paths.join(parents, "on", "left").select(
        (-F.col("top")).alias("level"), F.col("path").alias("a"), F.lit(0).cast("long").alias("b"), (-F.col("on_top")).alias("to_level"),
        F.col("on").alias("to_a"), F.lit(0).cast("long").alias("to_b"), "leaves", "saved",
    )
    # the few roots of shards: paths whose tops are deepest come first
    solved = forward_totals(ordered.repartition(1).sortWithinPartitions("level", "a"), p.queue)
    hanging = solved.select(F.col("a").alias("path"), "n_leaves", F.col("saved").alias("path_saved")).join(paths.select("path", "on", "top"), "path")
    hanging = hanging.filter("on is not null").groupBy(F.col("on").alias("path"), (F.col("top") - 1).alias("up_depth")).agg(
        F.sum("n_leaves").alias("more_leaves"), F.sum("path_saved").alias("more_saved")
    )
    full = here.join(hanging, ["path", "up_depth"], "left").na.fill(0, ["more_leaves", "more_saved"]).select(
        "path", *up, "n_children", (-F.col("up_depth")).alias("upward"),
        (F.col("leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"),
    )
    summed = running_sums(full, "path", ["upward"], ["n_leaves", "saved"], [*up, "n_children"])
    return summed.select(*[F.col(u).alias(c) for u, c in zip(up, NODE, strict=True)], "n_children", "n_leaves", "saved")


def prefix_trie(conversations: DataFrame, p: Trie = Trie()) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.

    Turns with the same number are ordered by role and text, a null number comes first, null role and
    text are empty. Rows without a conv_id belong to no conversation. Repeated rows are turns of their
    own; other columns are ignored; an empty table has no node, not even the root.
    """
    rows = materialize(prefixes(rebuilt(conversations)), "prefixes")
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"),
        F.max("bytes").alias("bytes"), F.sum(F.col("turns") - F.col("depth") + 1).alias("below"),
    )
    nodes = counted = materialize(nodes, "nodes")
    total = rows.filter("depth = 0").agg(F.sum(F.col("turns") + 1)).first()[0] or 0
    unit = max(p.least_unit, min(p.most_unit, total // p.share))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
                           F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["depth", "up_a", "up_b"], "left").withColumn("saved_here", (F.col("n_convs") - 1) * F.col("bytes"))
    is_heavy = F.col("below") > unit
    heavy = materialize(nodes.filter(is_heavy), "heavy")
    # the top of a conversation's unit is its shortest prefix that is not heavy
    tops = rows.select("conv_id", *NODE).join(heavy.select(*NODE), NODE, "left_anti").groupBy("conv_id").agg(
        F.min(F.struct(*NODE)).alias("top")
    )
    light = nodes.filter(~is_heavy).join(tops, "conv_id")
    is_top = F.struct(*NODE) == F.col("top")
    light = light.select(
        "*", (-F.col("depth")).alias("level"), F.when(~is_top, 1 - F.col("depth")).alias("to_level"), F.col("up_a").alias("to_a"),
        F.col("up_b").alias("to_b"), F.lit(None).cast("long").alias("leaves"), F.col("saved_here").alias("saved"), is_top.alias("is_top"),
    )
    shards = light.repartition("top").sortWithinPartitions("level", "a", "b")
    in_units = forward_totals(shards, p.queue).select((-F.col("level")).alias("depth"), "a", "b", "n_children", "n_leaves", "saved")
    in_units = materialize(in_units, "units")
    # tops are the light nodes whose parent is heavy
    above = heavy.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    out = nodes.filter(~is_heavy).join(above, ["depth", "up_a", "up_b"], "left_semi")
    out = out.select(*NODE, (F.col("depth") - 1).alias("up_depth"), "up_a", "up_b").join(in_units, NODE)
    totals = in_units.unionByName(_top_totals(heavy, out, p))
    ends = ends_hashes(rows.filter(F.col("depth") == F.col("turns")), p.chunk)
    none = hashlib.sha256(b"").hexdigest()
    result = nodes.join(totals, NODE).join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
    result = materialize(result, "trie")
    discard(rows, counted, heavy, in_units)
    return result
