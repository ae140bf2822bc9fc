"""Dense ids in a global order, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import materialize
from sightline.sources.landing import POSITION_MASK


def assign_dense_ids(
    rows: DataFrame, order: Sequence[str], start: int, name: str = "id"
) -> DataFrame:
    """Contiguous ids from ``start`` in the given (unique) order.

    Rows are range-partitioned and sorted, so an id is the partition's offset plus the row's
    position. The sorted rows are written once to the shared folder, because range bounds come
    from sampling and must be the same for counting and numbering. Only one row per partition
    is summed up in order.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_mid", F.monotonically_increasing_id()).select(
        *rows.columns,
        F.shiftright("_mid", 33).alias("_task"),
        F.col("_mid").bitwiseAND(F.lit(POSITION_MASK)).alias("_position"),
    )
    stored = materialize(numbered, "ids")
    counts = stored.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_task", F.expr("sum(_n) over (order by _task) - _n").alias("_offset"))
    return stored.join(offsets, "_task").select(
        (F.lit(start) + F.col("_offset") + F.col("_position")).alias(name), *rows.columns
    )


def remap_ids(rows: DataFrame, own_ids: DataFrame, key: str, assigned: str, source: str) -> DataFrame:
    """Own rows take the assigned id, all others keep the source's id."""
    own = own_ids.select(key, F.col(assigned).alias("_own"))
    return (
        rows.join(own, key, "left")
        .withColumn(source, F.coalesce("_own", source))
        .withColumn("is_own", F.col("_own").isNotNull())
        .drop("_own")
    )
