"""Tables on plain Parquet whose rows carry the version they came with.

The version is a partition column. Appended tables are read by filters on it, which prune folders;
tables that each load replaces are read at their newest version. A writer names the version (a
batch number, or the version of the source it has read), so a run that is repeated overwrites what
it wrote before. Readers pass the version their mark has reached.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def sorted_by_month(df: DataFrame, month: str, order: str) -> DataFrame:
    """Layout for a month-partitioned table sorted by id.

    Rows are spread by range of (month, id), so a month that holds most of the data is cut
    into many sorted files instead of one.
    """
    return df.repartitionByRange(month, order).sortWithinPartitions(month, order)


@dataclass(frozen=True)
class Tables:
    """Versioned tables under one root folder; one writer per table."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def newest(self, name: str, *, before: int | None = None, upto: int | None = None) -> int | None:
        """The highest version, also of an empty load; taken from the file listing by an aggregate."""
        try:
            files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path(name))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        if "version" not in files.columns:
            return None
        return files.filter(_between(None, upto, before)).agg(F.max("version").cast("long")).first()[0]

    def write(self, name: str, df: DataFrame, version: int, *, partition_by: list[str] | None = None) -> None:
        """The rows of one version; what a stopped run left under the same number is overwritten."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path(name)}/version={version}")

    def appended(self, name: str, *, after: int | None = None, upto: int | None = None, before: int | None = None) -> DataFrame | None:
        """Rows of the versions in ``(after, upto]``, earlier than ``before``; None without any version."""
        newest = self.newest(name, upto=upto, before=before)
        if newest is None:
            return None
        reader = self.spark.read.option("basePath", self.path(name))
        schema = reader.parquet(f"{self.path(name)}/version={newest}").drop("version").schema
        rows = self.spark.read.schema(schema.add("version", "long")).parquet(self.path(name))
        return rows.filter(_between(after, upto, before))

    def replaced(self, name: str, *, upto: int | None = None, before: int | None = None) -> DataFrame | None:
        """Rows of the newest version alone, without its number; None without any version."""
        newest = self.newest(name, upto=upto, before=before)
        if newest is None:
            return None
        return self.spark.read.parquet(f"{self.path(name)}/version={newest}")


def _between(after: int | None, upto: int | None, before: int | None) -> Column:
    version, wanted = F.col("version"), F.lit(True)
    if after is not None:
        wanted = wanted & (version > after)
    if upto is not None:
        wanted = wanted & (version <= upto)
    if before is not None:
        wanted = wanted & (version < before)
    return wanted


def as_of(df: DataFrame, version: int, column: str = "_version") -> DataFrame:
    return df.filter(F.col(column) <= version)


def version_range(manifest: DataFrame, start_ts: Column) -> DataFrame:
    """(start version, end version, end commit time) for a timestamp mark.

    The start is the newest version committed at or before the mark; equal commit times are
    decided by the higher version.
    """
    order = F.struct("committed_at", "version")
    before = F.col("committed_at") <= start_ts
    return manifest.agg(
        F.max(F.when(before, order))["version"].alias("start_version"),
        F.max(order)["version"].alias("end_version"),
        F.max(order)["committed_at"].alias("end_committed_at"),
    )


def newest_one(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy(F.desc("committed_at"), F.desc("version")).limit(1)
