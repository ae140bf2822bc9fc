"""Incremental flows: a stream over an append-only table, one checkpoint per consumer.

Every flow runs with ``availableNow``: it processes what is there, in bounded batches, and
stops. Each micro-batch writes its rows into a folder of its own, named by consumer and number, so a
batch that is run again after a failure overwrites what it wrote and is not applied twice. State by
key is in :mod:`sightline.streaming.stateful` and :mod:`sightline.operators.buckets`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import Future
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from sightline.operators.buckets import BucketedState, Step
from sightline.operators.merge import absent_rows, accumulate
from sightline.operators.picks import first_per_key
from sightline.session import configure
from sightline.sources import landing


@dataclass(frozen=True)
class BatchKey:
    """A micro-batch of one consumer.

    ``consumer`` is the id that Spark stores in the checkpoint folder. Batch numbers start at 0
    in every checkpoint, so a number alone does not name a batch of a table.
    """

    consumer: str
    number: int

    def __str__(self) -> str:
        return f"{self.consumer}/{self.number}"


#: a micro-batch and its key
Batch = Callable[[DataFrame, BatchKey], None]


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    format: str = "parquet",
    max_files: int | None = None,
    archive: str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New files of a folder, each exactly once per checkpoint.

    With ``archive`` processed files are moved there, best effort and off the critical path.
    """
    reader = spark.readStream.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for streams that keep keyed state.

    The number of state partitions is fixed for the life of a checkpoint, so it is chosen here
    (by default the cluster's cores) and not taken from the caller's session. State lives in
    RocksDB, off the heap.
    """
    session = configure(spark.newSession())
    count = partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


def run_available(stream: DataFrame, checkpoint: str, handle: Batch, mode: str = "append") -> None:
    """Run a batch function over everything available, then stop.

    In ``mode`` "update" a batch holds the groups that changed.
    """
    consumer: Future[str] = Future()

    def keyed(batch: DataFrame, number: int) -> None:
        handle(batch, BatchKey(consumer.result(), number))

    query = (
        stream.writeStream.foreachBatch(keyed)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    consumer.set_result(str(query.id))
    query.awaitTermination()


def run_timed(
    stream: DataFrame, checkpoint: str, handle: Batch, until: dt.datetime, *, every: str = "1 second", mode: str = "append"
) -> None:
    """Run a stream whose state has timers until it has no input left and all timers due at ``until``
    have fired, then stop. ``availableNow`` does not end such a stream: a timer needs batches without
    input (:func:`sightline.streaming.stateful.with_ticks`). A batch that the stop interrupts is run
    again by the next start.
    """
    consumer: Future[str] = Future()

    def keyed(batch: DataFrame, number: int) -> None:
        handle(batch, BatchKey(consumer.result(), number))

    query = (
        stream.writeStream.foreachBatch(keyed)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
    consumer.set_result(str(query.id))
    goal = until if until.tzinfo else until.replace(tzinfo=dt.timezone.utc)
    first = None
    while not query.awaitTermination(0.1):
        last = query.lastProgress
        if not last:
            continue
        # the first batch of a start may be a stopped one, which keeps the time it had
        first = last["batchId"] if first is None else first
        rows = sum(source["numInputRows"] for source in last["sources"] if not source["description"].startswith("Rate"))
        if last["batchId"] > first and not rows and dt.datetime.fromisoformat(last["timestamp"]) >= goal:
            query.stop()


def write_batch(rows: DataFrame, path: str, key: BatchKey) -> None:
    """The rows of one batch, under its consumer and version; a repeated batch overwrites its own."""
    rows.write.mode("overwrite").parquet(f"{path}/consumer={key.consumer}/version={key.number}")


def rows_so_far(spark: SparkSession, path: str, like: T.StructType, but: BatchKey | None = None) -> DataFrame:
    """Rows of all batches, with ``consumer`` and ``version``, but not what a stopped run of the batch
    ``but`` may have written."""
    schema = T.StructType([*like.fields]).add("consumer", "string").add("version", "long")
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
    if but is None:
        return rows
    return rows.filter((F.col("consumer") != but.consumer) | (F.col("version") != but.number))


def changed_rows(path: str) -> Batch:
    """Write the groups that a batch changed, and nothing else; :func:`newest_rows` reads the state."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        write_batch(batch, path, key)

    return handle


def newest_rows(spark: SparkSession, path: str, like: T.StructType, on: list[str]) -> DataFrame:
    """The row that each group got last; one consumer writes the path."""
    rows = rows_so_far(spark, path, like)
    values = F.struct(*[c for c in like.names if c not in on])
    newest = rows.groupBy(*on).agg(F.max_by(values, "version").alias("_row"))
    return newest.select(*on, "_row.*").select(*like.names)


#: the columns of Spark's file listing; only the path is read
LISTING = "path string, modificationTime timestamp, length long, content binary"


def landed_files(
    spark: SparkSession, path: str, *, max_files: int = 1000, archive: str | None = None
) -> DataFrame:
    """New landed files as a stream of paths; their content is not read.

    Hand the batches to :func:`land_batches`: whether a ``.bz2`` file is packed is only known from
    its first bytes, which a text stream does not look at.
    """
    stream = file_stream(
        spark, path, _parse_datatype_string(LISTING), format="binaryFile", max_files=max_files,
        archive=archive, glob="*.bz2",
    )
    return stream.select("path")


def land_batches(path: str, now: dt.datetime) -> Batch:
    """Append the staging rows of each batch of landed files; at most ``max_files`` files each."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        rows = landing.json_array_rows(landing.land_files(batch))
        write_batch(landing.staging_rows(rows, F.lit(now)), path, key)

    return handle


def copy_available(stream: DataFrame, checkpoint: str, out: str, *, partition_by: str | None = None) -> None:
    """Append everything available to a folder with the exactly-once file sink."""
    writer = stream.writeStream.format("parquet").option("path", out)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def append_once(path: str, on: list[str], order: list[Column]) -> Batch:
    """Append rows whose key is not in the table yet; exact across batches and retries.

    Stored keys are compared only in the range of the batch's keys. The range filter reaches the
    scan, and every batch is written in key order, so row groups of other key ranges are skipped: with
    keys that grow over time a batch reads the same number of row groups however long the table is.
    """

    def handle(batch: DataFrame, key: BatchKey) -> None:
        rows = first_per_key(batch, on, order)
        stored = rows_so_far(batch.sparkSession, path, batch.schema, key)
        lead = on[0]
        low, high = batch.agg(F.min(lead), F.max(lead)).first()
        if low is not None:
            stored = stored.filter(F.col(lead).between(F.lit(low), F.lit(high)))
        new = absent_rows(stored, rows, on).select(batch.columns)
        write_batch(new.repartitionByRange(*on).sortWithinPartitions(*on), path, key)

    return handle


def merge_batches(state: BucketedState, step: Step) -> Batch:
    """Apply ``step`` to the buckets of the state that a batch touches; one consumer writes the state."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        state.apply(batch, step, key.number)

    return handle


def running_summary(on: list[str], *, add: list[str], low: list[str], high: list[str]) -> Step:
    """Step for :func:`merge_batches`: counts added, bounds widened."""

    def step(state: DataFrame, batch: DataFrame) -> DataFrame:
        return accumulate(state, batch, on, add=add, low=low, high=high)

    return step


def drop_near_repeats(stream: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within ``delay`` of each other, with bounded state.

    Rows older than the watermark are dropped without a trace; where they matter, use
    :func:`once_within`.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def once_within(path: str, late: str, on: list[str], ts: str, delay: dt.timedelta) -> Batch:
    """Append rows whose key was not seen within ``delay``; rows older than that go to ``late``.

    The mark is the newest stored time less ``delay``, as before the batch. Only stored rows after
    the mark are compared, by a filter that reaches the scan, so old data is not read.
    """

    def handle(batch: DataFrame, key: BatchKey) -> None:
        stored = rows_so_far(batch.sparkSession, path, batch.schema, key)
        newest = stored.agg(F.max(ts)).first()[0]
        old, recent = F.lit(False), stored
        if newest is not None:
            mark = F.lit(newest - delay)
            old, recent = F.coalesce(F.col(ts) < mark, F.lit(False)), stored.filter(F.col(ts) >= mark)
        rows = first_per_key(batch.filter(~old), on, [F.asc(ts), *[F.asc(c) for c in sorted(batch.columns)]])
        write_batch(batch.filter(old), late, key)
        write_batch(absent_rows(recent, rows, on).select(batch.columns), path, key)

    return handle
