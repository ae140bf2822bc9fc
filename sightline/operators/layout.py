"""Tables laid out by their merge key, so that repeated merges do not shuffle them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sightline.session import remove_folder


@dataclass(frozen=True)
class BucketedTable:
    """A table in hash buckets of its key, sorted in each, as Spark's own bucketed files under ``path``.

    A join on ``keys`` takes the table as it lies: only the other side is dealt to the ``buckets``. A
    merge of a large source thus moves the source and streams the table. Choose buckets so that one is
    some hundred megabytes. Every load or merge writes a new version.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    buckets: int

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _save(self, rows: DataFrame, version: int) -> None:
        name = f"bucketed_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", self._folder(version)).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    def load(self, rows: DataFrame, version: int = 0) -> None:
        """Lay rows out anew; the one time that they are shuffled."""
        self._save(self.dealt(rows), version)

    def dealt(self, source: DataFrame) -> DataFrame:
        """Rows dealt as the table is, for a join that leaves the table in place."""
        return source.repartition(self.buckets, *self.keys)

    def read(self, version: int) -> DataFrame:
        """The rows of a version; joins and aggregates on the keys need no exchange of them."""
        name = f"bucketed_{uuid.uuid4().hex}"
        schema = self.spark.read.parquet(self._folder(version)).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self._folder(version)}'"
        )
        rows = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the relation knows its files and buckets
        return rows

    def merge(self, source: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame], version: int) -> None:
        """Write version ``version + 1`` from ``version`` by ``step(target, source)``.

        A merge that is repeated overwrites what a stopped one left. ``step`` is any merge of
        :mod:`sightline.operators.merge` on the table's keys.
        """
        self._save(step(self.read(version), self.dealt(source)), version + 1)

    def forget(self, version: int) -> None:
        remove_folder(self.spark, self._folder(version))
