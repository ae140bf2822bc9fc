"""Full refresh of mirrored reference tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.sources.tables import Tables


def normalize_types(df: DataFrame) -> DataFrame:
    """Binary columns as base64 text, every timestamp as a UTC instant."""

    def norm(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BinaryType):
            # unbase64 ignores line breaks; the text form has none
            return F.regexp_replace(F.base64(col), r"[\r\n]", "").alias(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            return col.cast("timestamp").alias(field.name)
        return col

    return df.select([norm(f) for f in df.schema])


class SchemaDrift(ValueError):
    """A source column was removed or changed its type."""


def evolve_additive(current: T.StructType, incoming: DataFrame) -> DataFrame:
    """Align a new load with the table schema: new columns are added, other drift fails."""
    have = {f.name: f.dataType for f in incoming.schema}
    for field in current:
        if field.name not in have:
            raise SchemaDrift(f"column {field.name} is gone")
        if have[field.name] != field.dataType:
            raise SchemaDrift(
                f"column {field.name}: {field.dataType.simpleString()} "
                f"became {have[field.name].simpleString()}"
            )
    added = [f.name for f in incoming.schema if f.name not in current.names]
    return incoming.select(*current.names, *added)


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows together; columns missing on one side are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def refresh_table(tables: Tables, name: str, source: DataFrame, version: int) -> None:
    """Load a table anew under a version; readers stay at theirs until they are given the new one.

    A load that is repeated under its version overwrites what a stopped one left.
    """
    load = normalize_types(source)
    current = tables.replaced(name, before=version)
    if current is not None:
        load = evolve_additive(current.schema, load)
    tables.write(name, load, version)


def refresh_many(
    tables: Tables,
    sources: dict[str, DataFrame],
    version: int,
    only: Iterable[str] | None = None,
) -> list[str]:
    """Refresh all or the named tables in order and stop at the first failure."""
    names = list(sources if only is None else only)
    unknown = [n for n in names if n not in sources]
    if unknown:
        raise KeyError(f"no such source: {', '.join(unknown)}")
    for name in names:
        refresh_table(tables, name, sources[name], version)
    return names


def split_options(rows: DataFrame, column: str, partitions: int) -> dict[str, str]:
    """Options that let a relational source be read by ranges of a column, in that many tasks.

    The bounds are one aggregate, which relational sources compute themselves. They only cut the ranges:
    rows outside and NULLs are read too. Without a value there is nothing to cut.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return {}
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}


def read_remote_table(
    spark: SparkSession,
    options: dict[str, str],
    changed_column: str | None = None,
    since: dt.datetime | None = None,
    *,
    format: str = "jdbc",
    split: tuple[str, int] | None = None,
) -> DataFrame:
    """A relational table with the change filter pushed to the source.

    ``options`` are those of the data source. ``split`` names a numeric, date or timestamp column and
    the number of tasks: the rows are then read by ranges of the column, between the least and the
    greatest value that the change filter leaves.
    """

    def changed(df: DataFrame) -> DataFrame:
        if changed_column is None or since is None:
            return df
        ntz = isinstance(df.schema[changed_column].dataType, T.TimestampNTZType)
        mark = F.lit(since).cast("timestamp_ntz" if ntz else "timestamp")
        return df.filter(F.col(changed_column) > mark)

    df = changed(spark.read.format(format).options(**options).load())
    if split is not None:
        ranges = split_options(df, *split)
        df = changed(spark.read.format(format).options(**options, **ranges).load())
    return df
