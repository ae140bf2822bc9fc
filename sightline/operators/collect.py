"""Aggregations that rebuild nested values per entity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def ordered_list(order: Column, value: Column) -> Column:
    """Aggregate: values as an array in the given order."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def all_or_null(value: Column, rebuilt: Column) -> Column:
    """Aggregate: the rebuilt array, or NULL when any element has no value."""
    return F.when(F.count(value) == F.count(F.lit(1)), rebuilt)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def max_where(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def collapse(
    df: DataFrame, keys: Sequence[str], *, tie: Column, lists: Sequence[str] = (),
    maxima: Sequence[str] = (), distinct: bool = False,
) -> DataFrame:
    """One row per entity: arrays for ``lists``, maxima for ``maxima``, else one row's values.

    All single values come from the same row, the smallest by ``tie``, so reruns agree. Arrays
    hold every non-NULL value (or each one once), sorted.
    """
    gather = F.collect_set if distinct else F.collect_list
    single = [c for c in df.columns if c not in {*keys, *lists, *maxima}]
    grouped = df.groupBy(*keys).agg(
        F.min_by(F.struct(*single), tie).alias("_one"),
        *[F.max(c).alias(c) for c in maxima],
        *[F.array_sort(gather(c)).alias(c) for c in lists],
    )
    return grouped.select(*keys, "_one.*", *maxima, *lists)


def run_summary(df: DataFrame, *, id: str, ts: str, held: Column | None = None) -> DataFrame:
    """One-row report of a run."""
    flag = F.lit(False) if held is None else held
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(id).alias("n_ids"),
        F.count_if(~flag).alias("merged"),
        F.count_if(flag).alias("held"),
        F.max(F.when(~flag, F.col(ts))).alias("newest"),
    )


@dataclass(frozen=True)
class Report:
    """What a write has seen of its own rows; ``newest_micros`` counts microseconds since 1970, UTC."""

    n_rows: int
    merged: int
    held: int
    newest_micros: int | None

    @property
    def newest(self) -> Column:
        """The newest timestamp of the rows that were not held, as a literal; NULL without one."""
        return F.timestamp_micros(F.lit(self.newest_micros).cast("long"))


def write_reported(
    df: DataFrame, write: Callable[[DataFrame], None], *, ts: str, held: Column | None = None
) -> Report:
    """Write ``df`` and report on it from the same pass: the plan runs once, and the report is of the
    rows that were written, whatever happens to the sources meanwhile.

    ``write`` must write all rows of the frame it is given, once. Distinct ids cannot be observed;
    count them on what was written.
    """
    flag = F.lit(False) if held is None else F.coalesce(held, F.lit(False))
    seen = Observation()
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    write(
        df.observe(
            seen,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~flag).alias("merged"),
            F.count_if(flag).alias("held"),
            F.max(F.when(~flag, micros)).alias("newest"),
        )
    )
    found = seen.get
    return Report(found["n_rows"], found["merged"], found["held"], found["newest"])
