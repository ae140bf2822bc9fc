"""Keyed state of which a batch rewrites only the buckets that it touches.

Rows are laid out by a hash of their key. Every batch writes the buckets of its own keys under its
number and never changes a file; the state is, bucket by bucket, what the newest batch has written.
A batch that is run again reads the state before it and overwrites only its own files, so it is
applied once, whatever a stopped run has left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import discard, materialize, remove_folder

#: (rows of the touched buckets, rows of the batch) -> rows of these buckets after the batch
Step = Callable[[DataFrame, DataFrame], DataFrame]
BATCH, BUCKET = "_batch", "_bucket"


@dataclass(frozen=True)
class BucketedState:
    """State under ``path`` with one row per key, written by one consumer whose batches count up.

    ``schema`` is that of the rows. ``buckets`` is fixed for the life of the state; choose it so that
    a bucket is some hundred megabytes when the state is full grown.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    schema: str
    buckets: int = 256

    def bucket(self) -> Column:
        """NULL keys have a bucket like any other."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _newest(self, before: int | None) -> dict[int, int]:
        """The newest batch of each bucket: at most one entry per bucket, from the file listing."""
        try:
            files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return {}
        if BUCKET not in files.columns:
            return {}
        if before is not None:
            files = files.filter(F.col(BATCH) < before)
        rows = files.groupBy(BUCKET).agg(F.max(BATCH).alias(BATCH)).collect()
        return {r[BUCKET]: r[BATCH] for r in rows}

    def read(self, *, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The state, or some of its buckets, as it was before a batch; empty without any batch."""
        newest = self._newest(before)
        wanted = newest if only is None else {b: newest[b] for b in only if b in newest}
        paths = [f"{self.path}/{BATCH}={n}/{BUCKET}={b}" for b, n in sorted(wanted.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def apply(self, delta: DataFrame, step: Step, batch: int) -> list[int]:
        """Apply ``step`` to the buckets of the keys of ``delta`` and return their numbers.

        ``step`` must keep the keys it is given: a bucket that it leaves without rows would show its
        older rows again. A batch without rows changes nothing.
        """
        stored = materialize(delta.withColumn(BUCKET, self.bucket()), "delta")
        touched = sorted(r[0] for r in stored.select(BUCKET).distinct().collect())
        if touched:
            rows = step(self.read(before=batch, only=touched), stored.drop(BUCKET))
            rows.withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
                f"{self.path}/{BATCH}={batch}"
            )
        discard(stored)
        return touched

    def forget(self, upto: int) -> int:
        """Remove what newer batches have replaced, of batches up to ``upto``; returns the folders removed."""
        newest, kept = self._newest(None), 0
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path)
        old = files.filter(F.col(BATCH) <= upto).select(BUCKET, BATCH).distinct()
        for row in old.toLocalIterator():
            if newest[row[BUCKET]] > row[BATCH]:
                remove_folder(self.spark, f"{self.path}/{BATCH}={row[BATCH]}/{BUCKET}={row[BUCKET]}")
                kept += 1
        return kept
