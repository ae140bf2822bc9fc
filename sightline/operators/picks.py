"""One row per key, by a total order.

``row_number() = 1`` lets Spark keep only the best row per key and task before the shuffle
(window group limit), so a key that holds much of the data does not reach one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. End the order with a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, *ties: Column) -> DataFrame:
    return first_per_key(df, keys, [F.col(ts).desc_nulls_last(), *ties])


def earliest_per_key(df: DataFrame, keys: Sequence[str], ts: str, *ties: Column) -> DataFrame:
    return first_per_key(df, keys, [F.col(ts).asc_nulls_last(), *ties])


def with_collected(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the sorted array of a key's non-NULL values to each of its rows.

    The array is built once per key, with partial aggregation, and joined back; a window would
    send all rows of a key to one task. Rows with a NULL key are a key of their own.
    """
    arrays = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.array_sort(F.collect_list(value)).alias(out)
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(arrays, same).drop(*[f"_k_{k}" for k in keys])
