"""Runs that hold their mark: pin, read, write, promote. A run that broke is simply run again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.increments import (
    IN_PROGRESS, begin_version, empty_control, finish_version, seed_missing,
)
from sightline.session import materialize
from sightline.sources.tables import Tables

#: rows that a step writes, by table
Outputs = dict[str, DataFrame]
BLOCKS = "owner string, first_id long, n long"


@dataclass(frozen=True)
class Marked:
    """A process that reads the changes of one table under its own mark in a control table."""

    tables: Tables
    source: str
    name: str
    control: str = "control"

    def _control(self) -> tuple[int, DataFrame]:
        version = self.tables.newest(self.control) or 0
        found = self.tables.replaced(self.control)
        table = empty_control(self.tables.spark) if found is None else found
        names = self.tables.spark.createDataFrame([(self.name,)], "watermark_name string")
        return version, seed_missing(table, names, F.lit(None), F.current_timestamp())

    def run(self, step: Callable[[DataFrame, int], Outputs], now: dt.datetime) -> int | None:
        """Process what is new and return the version reached, or None when nothing was.

        The end of the source is pinned in the control table first. All outputs are written under the
        pinned version and the mark moves last. ``step`` gets the changes and that version; a table
        that it both reads and writes it reads ``before`` the version. If the run stops anywhere, the
        next one finds the pin, reads the same changes and overwrites the outputs that were already
        written, and so ends as a run that never stopped.
        """
        at, control = self._control()
        control = materialize(control, "control")
        row = control.filter(F.col("watermark_name") == self.name).first()
        last = row["last_commit_version"]
        pinned = row["transaction_status"] == IN_PROGRESS
        upto = row["current_commit_version"] if pinned else self.tables.newest(self.source)
        if upto is None or upto == last:
            return None
        if not pinned:
            control = begin_version(control, self.name, F.lit(upto), F.lit(now))
            at += 1
            self.tables.write(self.control, control, at)
        changes = self.tables.appended(self.source, after=last, upto=upto)
        for table, rows in step(changes, upto).items():
            self.tables.write(table, rows, upto)
        self.tables.write(self.control, finish_version(control, self.name, F.lit(now)), at + 1)
        return upto


def reserve_ids(
    tables: Tables, table: str, owner: str, n: int, start: int
) -> int:
    """First id of a block of ``n``, logged under ``owner`` before any id is used.

    The same owner gets the same block again, so a repeated run gives equal ids and two runs never
    share one. Blocks of runs that were given up leave gaps.
    """
    found = tables.appended(table)
    log = tables.spark.createDataFrame([], BLOCKS) if found is None else found
    mine, end = log.agg(
        F.max(F.when(F.col("owner") == owner, F.col("first_id"))), F.max(F.col("first_id") + F.col("n"))
    ).first()
    if mine is not None:
        return mine
    first = start if end is None else end
    block = tables.spark.createDataFrame([(owner, first, n)], BLOCKS)
    tables.write(table, block, (tables.newest(table) or 0) + 1)
    return first
