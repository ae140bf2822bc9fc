"""Change reads and the control table of durable marks.

The control table has one row per process. Functions return its next state; it stays tiny, so
callers may read single marks on the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL = (
    "watermark_name string, start_timestamp timestamp, end_timestamp timestamp, "
    "last_commit_version bigint, current_commit_version bigint, transaction_status string, "
    "created_timestamp timestamp, updated_timestamp timestamp"
)
IN_PROGRESS, SUCCEEDED = "InProgress", "SUCCEEDED"


# ---- reads ---------------------------------------------------------------------------------


def changes_since_version(
    df: DataFrame, start: int | None, end: int, column: str = "_version"
) -> DataFrame:
    """No mark: everything up to the pinned end. Otherwise rows added in ``(start, end]``."""
    version = F.col(column)
    if start is None:
        return df.filter(version <= end)
    return df.filter((version > start) & (version <= end))


def changes_since_ts(df: DataFrame, column: str, start: Column) -> DataFrame:
    return df.filter(F.col(column) > start)


def changes_inclusive(df: DataFrame, column: str, start: Column) -> DataFrame:
    return df.filter(F.col(column) >= start)


def changed_ids(*parts: tuple[DataFrame, str, str, Column]) -> DataFrame:
    """Distinct ids changed in any of several tables, each under its own mark."""
    found = [
        changes_since_ts(df, ts, start).select(F.col(id).alias("creative_id"))
        for df, id, ts, start in parts
    ]
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union.distinct()


def reread_held(all_rows: DataFrame, changed: Column, hold: DataFrame, on: str) -> DataFrame:
    """Changed rows together with parked ones, each once.

    The change condition stands alone on its side, so it reaches the scan and skips files; the
    parked rows that did not change come from a semi join with the hold set.
    """
    parked = all_rows.join(hold.select(on).distinct(), on, "left_semi").select(all_rows.columns)
    return all_rows.filter(changed).unionByName(parked.filter(~F.coalesce(changed, F.lit(False))))


# ---- marks on versions ---------------------------------------------------------------------


def _set(control: DataFrame, name: Column, now: Column, changes: dict[str, Column]) -> DataFrame:
    hit = F.col("watermark_name") == name
    changes = {**changes, "updated_timestamp": now}
    return control.select(
        [
            F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in control.columns
        ]
    )


def begin_version(control: DataFrame, name: str, end_version: Column, now: Column) -> DataFrame:
    """Pin the source's current end and mark the process as running."""
    changes = {"current_commit_version": end_version, "transaction_status": F.lit(IN_PROGRESS)}
    return _set(control, F.lit(name), now, changes)


def finish_version(control: DataFrame, name: str, now: Column) -> DataFrame:
    """Promote the pin to the last version; call it after all writes."""
    changes = {
        "last_commit_version": F.col("current_commit_version"),
        "transaction_status": F.lit(SUCCEEDED),
    }
    return _set(control, F.lit(name), now, changes)


# ---- marks on timestamps -------------------------------------------------------------------


def begin_ts(control: DataFrame, name: str) -> DataFrame:
    """The stored end of the process as ``start_ts``."""
    found = control.filter(F.col("watermark_name") == name)
    return found.select(F.col("end_timestamp").alias("start_ts"))


def finish_ts(
    control: DataFrame, name: str, previous_end: Column, new_end: Column, now: Column
) -> DataFrame:
    """Set the window explicitly."""
    changes = {
        "start_timestamp": previous_end,
        "end_timestamp": new_end,
        "transaction_status": F.lit(SUCCEEDED),
    }
    return _set(control, F.lit(name), now, changes)


def finish_at(control: DataFrame, name: str, newest: Column, now: Column) -> DataFrame:
    """Move the window to ``[old end, newest]``; nothing changes when ``newest`` is NULL.

    ``newest`` is one value for all rows, as the ``newest`` of a :class:`~sightline.operators.collect.Report`.
    """
    joined = control.withColumn("_top", newest.cast("timestamp"))
    hit = (F.col("watermark_name") == name) & F.col("_top").isNotNull()
    changes = {
        "start_timestamp": F.col("end_timestamp"),
        "end_timestamp": F.col("_top"),
        "transaction_status": F.lit(SUCCEEDED),
        "updated_timestamp": now,
    }
    return joined.select(
        [
            F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in control.columns
        ]
    )


def finish_from(control: DataFrame, name: str, newest: DataFrame, now: Column) -> DataFrame:
    """As :func:`finish_at`; ``newest`` has one row and one column: the maximum over the processed rows."""
    return finish_at(control, name, newest.toDF("_top").scalar(), now)


def finish_from_result(
    control: DataFrame, name: str, result: DataFrame, ts: str, now: Column, where: Column | None = None
) -> DataFrame:
    """Advance to the newest timestamp among result rows that pass a filter."""
    rows = result if where is None else result.filter(where)
    return finish_from(control, name, rows.agg(F.max(ts)), now)


def advance_from_source(
    control: DataFrame, name: str, source: DataFrame, ts: str, now: Column
) -> DataFrame:
    """Advance to the newest source timestamp above the process's own stored end."""
    mark = control.filter(F.col("watermark_name") == name).agg(F.max("end_timestamp"))
    newer = source.filter(F.col(ts) > mark.scalar())
    return finish_from(control, name, newer.agg(F.max(ts)), now)


# ---- rows of the control table -------------------------------------------------------------


def seed_missing(control: DataFrame, names: DataFrame, start: Column, now: Column) -> DataFrame:
    """Insert a row for each process that has none, all with the same start values."""
    absent = names.select("watermark_name").distinct().join(control, "watermark_name", "left_anti")
    rows = absent.select(
        "watermark_name",
        start.cast("timestamp").alias("start_timestamp"),
        start.cast("timestamp").alias("end_timestamp"),
        F.lit(SUCCEEDED).alias("transaction_status"),
        now.alias("created_timestamp"),
        now.alias("updated_timestamp"),
    )
    return control.unionByName(rows, allowMissingColumns=True)


def init_at_max(control: DataFrame, name: str, source: DataFrame, ts: str, now: Column) -> DataFrame:
    """Start a mark at the source's newest timestamp, so that the first run reads nothing."""
    top = source.agg(F.max(ts)).scalar()
    return _set(control, F.lit(name), now, {"start_timestamp": top, "end_timestamp": top})


@dataclass(frozen=True)
class Mark:
    """A process's stored mark, read on the driver (one row)."""

    last_version: int | None
    end: dt.datetime | None


def read_mark(control: DataFrame, name: str) -> Mark:
    row = control.filter(F.col("watermark_name") == name).first()
    if row is None:
        return Mark(None, None)
    return Mark(row["last_commit_version"], row["end_timestamp"])


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTROL)
