"""Streams with keyed state and timers: a batch costs its own rows, not the rows kept.

State lives in the checkpoint (RocksDB), so a query that is stopped goes on where it was. Keys that
may hold a large part of all rows are cut by a salt: a dimension row is sent to every salt of its
key, and parts of a group are put together when they are read. Small keys share a group of state, which is
read and written as lists.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# processors travel with the query: Spark sets them up in a process of the driver's host whose path need
# not hold this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: what a row of :func:`wait_for_dimension` is
OUT, EXPIRED = "out", "expired"
#: names of state variables, as the state of a checkpoint is read by them
WAITING, HELD = "waiting", "held"


def _struct(df: DataFrame, names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, df.schema[n].dataType, True) for n in names])


def _salt(names: Sequence[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int")


def _row(names: Sequence[str], *values: object) -> Row:
    return Row(**dict(zip(names, values, strict=True)))


def with_ticks(stream: DataFrame) -> DataFrame:
    """The same rows; a clock beside them starts a batch every second, so that timers fire although no
    row comes. Without it a query that is started again waits for its first new row."""
    ticks = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().filter("value < 0")
    return stream.unionByName(ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]))


class _Kept:
    """How columns of plain types are kept in state: under names of their own, instants as microseconds,
    so that a worker's time zone does not matter."""

    def __init__(self, df: DataFrame, names: Sequence[str], mark: str):
        self.names, self.types = list(names), [df.schema[n].dataType for n in names]
        nested = [n for n, t in zip(self.names, self.types, strict=True) if isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.VariantType))]
        if nested:
            raise ValueError(f"nested columns cannot be kept in state: {', '.join(nested)}")
        self.keys = [f"{mark}{i}" for i in range(len(self.names))]
        kept = [T.LongType() if isinstance(t, T.TimestampType) else t for t in self.types]
        self.fields = [T.StructField(k, t, True) for k, t in zip(self.keys, kept, strict=True)]

    def stored(self) -> list[Column]:
        instant = lambda n, t: F.unix_micros(n) if isinstance(t, T.TimestampType) else F.col(n)
        return [instant(n, t).alias(k) for n, t, k in zip(self.names, self.types, self.keys, strict=True)]

    def none(self) -> list[Column]:
        return [F.lit(None).cast(f.dataType).alias(f.name) for f in self.fields]

    def read(self, prefix: str = "") -> list[Column]:
        back = lambda k, t: F.timestamp_micros(prefix + k) if isinstance(t, T.TimestampType) else F.col(prefix + k)
        return [back(k, t).alias(n) for n, t, k in zip(self.names, self.types, self.keys, strict=True)]


def _plain(value: object) -> object:
    """A key's value as Python compares it: NaN equals itself, bytes can be looked up."""
    return "NaN" if value != value else bytes(value) if isinstance(value, bytearray) else value


def _group(names: Sequence[str], groups: int) -> Column:
    """Keys share groups of state, as Spark asks a worker for each group apart, which costs far more than a row."""
    return F.pmod(F.xxhash64(*names), F.lit(groups)).cast("int")


def _stored(state) -> Iterator[tuple]:
    return iter(state.get()) if state.exists() else iter(())


def _store(state, rows: list[tuple]) -> None:
    if rows:
        state.put(rows)
    else:
        state.clear()


class _Waiting(StatefulProcessor):
    """State of a group of keys: their dimension rows and the events that wait for one; with ``forget``
    the event keys that left, which else are dropped as repeats before."""

    def __init__(
        self, on: T.DataType, event: list[T.StructField], known: list[T.StructField], place: int, key: list[int],
        patience: int | None, forget: int | None,
    ):
        self.type, self.event, self.known, self.place, self.key, self.patience, self.forget = on, event, known, place, key, patience, forget
        self.out = ["kind", *(f.name for f in (*event, *known))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("dimension", T.StructType([T.StructField("on", self.type), *self.known]))
        self.waiting = handle.getListState(WAITING, T.StructType([*self.event, T.StructField("since", T.LongType())]))
        if self.forget:
            own = T.StructType([self.event[self.place], *(T.StructField(f"k{i}", self.event[i].dataType) for i in self.key)])
            self.gone = handle.getListState("gone", own, self.forget)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        # without patience and forget there are no timers, and no time is asked for
        now = timerValues.getCurrentProcessingTimeInMs() if self.patience or self.forget else 0
        known = {_plain(kept[0]): tuple(kept) for kept in _stored(self.rows)}
        seen = {tuple(map(_plain, own)) for own in _stored(self.gone)} if self.forget else set()
        if self.forget:
            seen.update(tuple(map(_plain, self._own(kept))) for kept in _stored(self.waiting))
        newest: dict[object, tuple] = {}
        ready, late, waits = [], [], False
        for row in rows:
            if row["known"]:
                newest[_plain(row["on"])] = (row["on"], *(row[f.name] for f in self.known))
                continue
            event = tuple(row[f.name] for f in self.event)
            if self.forget:
                own = tuple(map(_plain, self._own(event)))
                if own in seen:
                    continue
                seen.add(own)
            if _plain(event[self.place]) in known:
                ready.append(event)
                continue
            waits = True
            late.append((*event, now))
            if len(late) == 10_000:  # a group may hold a large part of all rows
                self.waiting.appendList(late)
                late = []
        if late:
            self.waiting.appendList(late)
        came = newest.keys() - known.keys()
        known.update(newest)
        if len(came) < len(newest):
            self.rows.put(list(known.values()))
        elif newest:
            self.rows.appendList(list(newest.values()))
        for event in ready:
            yield _row(self.out, OUT, *event, *known[_plain(event[self.place])][1:])
        self._forget(ready)
        if came:
            yield from self._leave(OUT, known, lambda kept: _plain(kept[self.place]) in came)
            if self.patience and not self.waiting.exists():
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
        if waits and self.patience and self.waiting.exists() and not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(now + self.patience)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        yield from self._leave(EXPIRED, {}, lambda kept: kept[-1] <= now - self.patience)
        later = min((kept[-1] for kept in _stored(self.waiting)), default=None)
        if later is not None:
            self.handle.registerTimer(later + self.patience)

    def _own(self, event: tuple) -> tuple:
        return (event[self.place], *(event[i] for i in self.key))

    def _forget(self, events: list[tuple]) -> None:
        if self.forget and events:
            self.gone.appendList([self._own(event) for event in events])

    def _leave(self, kind: str, known: dict, leaves: Callable[[tuple], bool]) -> Iterator[Row]:
        stay, done, none = [], [], (None,) * (len(self.known) + 1)
        for kept in _stored(self.waiting):
            if not leaves(kept):
                stay.append(tuple(kept))
                continue
            done.append(tuple(kept) if self.forget else ())
            yield _row(self.out, kind, *tuple(kept)[:-1], *known.get(_plain(kept[self.place]), none)[1:])
        if done:
            _store(self.waiting, stay)
            self._forget(done)

    def close(self) -> None:
        pass


def wait_for_dimension(
    events: DataFrame,
    dimension: DataFrame,
    on: str,
    event_key: Sequence[str],
    *,
    take: Sequence[str] = (),
    patience: dt.timedelta | None = None,
    forget: dt.timedelta | None = None,
    salts: int = 8,
    groups: int = 8192,
) -> DataFrame:
    """Events, each once, when their dimension row is known; until then they wait in state.

    Both sides are streams of rows that are never changed. The result has ``kind``, the event's
    columns and the columns ``take`` of the newest dimension row of the event's ``on``. With
    ``patience`` an event that has waited so long leaves as ``expired`` with NULLs, by a timer, also
    when no row of its key comes. A copy of an event (same ``event_key`` and ``on``) is left out, for
    ``forget`` after the event has left or for ever. An event without ``on`` waits for nothing and
    stays. Rows that wait are those of :func:`waiting_events`. With ``patience`` or ``forget`` the stream
    is one for ``flows.run_timed``.

    The keys are dealt to ``groups`` of state for each salt. A batch reads the dimension rows of the groups
    it touches, and what waits in them where a new dimension row came (with ``forget`` at every touch).
    """
    event, known = _Kept(events, events.columns, "e"), _Kept(dimension, take, "d")
    if forget is None:  # copies are left out by Spark's own state
        events = events.dropDuplicates(list(dict.fromkeys([on, *event_key])))
    plain = lambda df: F.unix_micros(on) if isinstance(df.schema[on].dataType, T.TimestampType) else F.col(on)
    left = events.select(
        plain(events).alias("on"), _salt(event_key, salts).alias("salt"), F.lit(False).alias("known"), *event.stored(), *known.none()
    )
    right = dimension.filter(F.col(on).isNotNull()).select(
        plain(dimension).alias("on"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(True).alias("known"),
        *event.none(), *known.stored(),
    )
    millis = lambda d: None if d is None else int(d.total_seconds() * 1000)
    places = [events.columns.index(c) for c in event_key]
    timed = "None" if patience is None and forget is None else "ProcessingTime"
    both = left.unionByName(right)
    both = both if timed == "None" else with_ticks(both)
    processor = _Waiting(
        both.schema["on"].dataType, event.fields, known.fields, events.columns.index(on), places, millis(patience), millis(forget)
    )
    out = T.StructType([T.StructField("kind", T.StringType()), *event.fields, *known.fields])
    both = both.withColumn("group", _group(["on"], groups))
    made = both.groupBy("group", "salt").transformWithState(processor, out, "Append", timed)
    return made.select("kind", *event.read(), *known.read())


def waiting_events(spark: SparkSession, checkpoint: str, events: DataFrame) -> DataFrame:
    """The events that wait at the end of the last batch, read from the checkpoint's state; ``events``
    is the stream, or any rows with its columns."""
    state = spark.read.format("statestore").option("stateVarName", WAITING).load(checkpoint)
    return state.select(*_Kept(events, events.columns, "e").read("list_element."))


class _FirstDays(StatefulProcessor):
    """State of one group: how many events, the first day, and the counts of the days from it on."""

    def __init__(self, out: list[str], days: int, settle: int | None):
        self.out, self.days, self.settle = out, days, settle

    def init(self, handle: StatefulProcessorHandle) -> None:
        total = T.StructType().add("n", T.LongType()).add("first_day", T.DateType()).add("settled", T.LongType())
        self.total = handle.getValueState("total", total)
        self.counts = handle.getValueState("counts", T.StructType().add("counts", T.ArrayType(T.LongType())), self.settle)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        per_day: dict[dt.date | None, int] = {}
        for row in rows:
            per_day[row["_day"]] = per_day.get(row["_day"], 0) + row["_n"]
        n = sum(per_day.values())
        dated = {day: count for day, count in per_day.items() if day is not None}
        stored = tuple(self.total.get()) if self.total.exists() else (0, None, None)
        first, settled = stored[1], stored[2]
        open_counts = self.counts.exists()
        counts = list(self.counts.get()[0]) if open_counts else [0] * self.days
        if first is not None and not open_counts:  # the time to change the first days is over
            self.total.update((stored[0] + n, first, settled))
            yield _row(self.out, *key, stored[0] + n, first, None, settled)
            return
        start = min([*dated, *([first] if first else [])], default=None)
        if start is not None:
            moved = (first - start).days if first else 0
            # counts of days beyond the new window can never matter again: the first day only moves back
            counts = ([0] * moved + counts)[: self.days]
            for day, count in dated.items():
                if (day - start).days < self.days:
                    counts[(day - start).days] += count
            self.counts.update((counts,))
        self.total.update((stored[0] + n, start, sum(counts)))
        yield _row(self.out, *key, stored[0] + n, start, counts, sum(counts))

    def close(self) -> None:
        pass


def _combined(batches: Iterator) -> Iterator:
    """Rows with the sum of ``_n`` for those that else are equal, some batches at a time."""
    import pyarrow as pa

    def summed(parts: list) -> list:
        table = pa.Table.from_batches(parts)
        names = table.column_names
        if any(pa.types.is_nested(f.type) for f in table.schema):  # Arrow does not group by these
            return table.to_batches()
        keys = [n for n in names if n != "_n"]
        sums = table.group_by(keys).aggregate([("_n", "sum")]).rename_columns([*keys, "_n"])
        return sums.select(names).cast(table.schema).to_batches()

    parts: list = []
    for batch in batches:
        parts.append(batch)
        if sum(p.num_rows for p in parts) >= 1_000_000:
            parts = summed(parts)
            if sum(p.num_rows for p in parts) >= 500_000:
                yield from parts
                parts = []
    if parts:
        yield from summed(parts)


def first_days(stream: DataFrame, on: Sequence[str], ts: str, *, days: int = 7, settle: dt.timedelta | None = None, salts: int = 1) -> DataFrame:
    """Per group and salt: ``n``, ``first_day``, the counts of the ``days`` days from it on, and their sum.

    The result does not depend on the order in which events arrive: an earlier event moves the window
    back. Rows leave only for groups that a batch changes; put them together with
    :func:`first_days_of`. With ``settle`` the day counts of a group are dropped that long after they
    last changed; from then on only ``n`` grows, and the stream is one for ``flows.run_timed``. Events
    without a time count in ``n`` alone. A task counts the events of a group and day before the shuffle, so
    a hot group needs no ``salts``; each one more makes more groups of state.
    """
    spread = _salt([ts], salts)
    rows = stream.select(*on, spread.alias("_salt"), F.to_date(ts).alias("_day"), F.lit(1).cast("long").alias("_n"))
    rows = rows.mapInArrow(_combined, rows.schema)
    out = _struct(stream, on).add("_salt", "integer").add("n", "long").add("first_day", "date")
    out = out.add("counts", T.ArrayType(T.LongType())).add("early", "long")
    settle_ms = None if settle is None else int(settle.total_seconds() * 1000)
    timed = "None" if settle is None else "ProcessingTime"
    return rows.groupBy(*on, "_salt").transformWithState(_FirstDays(out.names, days, settle_ms), out, "Update", timed)


def first_days_of(parts: DataFrame, on: Sequence[str], days: int = 7) -> DataFrame:
    """``on, n, first_day, early`` from the newest row of every group and salt.

    Every salt keeps the days from its own first day on, which cover its days in the group's window.
    A settled part brings its last sum, which is exact where it started on the group's first day.
    """
    part = F.struct("first_day", "counts", "early")
    groups = parts.groupBy(*on).agg(F.sum("n").alias("n"), F.min("first_day").alias("first_day"), F.collect_list(part).alias("parts"))

    def early(x: Column) -> Column:
        inside = F.greatest(F.lit(0), F.lit(days) - F.datediff(x["first_day"], F.col("first_day")))
        counted = F.aggregate(F.slice(x["counts"], 1, inside), F.lit(0).cast("long"), lambda a, b: a + b)
        return F.when(x["first_day"].isNull(), F.lit(0).cast("long")).otherwise(F.coalesce(counted, x["early"]))

    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + early(x))
    return groups.select(*on, "n", "first_day", total.alias("early"))


class _Holding(StatefulProcessor):
    """State of a group of keys: the rows that are held and when each hold ends. One timer, at the earliest."""

    def __init__(self, fields: list[T.StructField], key: list[int]):
        self.fields, self.key = fields, key
        self.out = ["released_by_timer", *(f.name for f in fields)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState(HELD, T.StructType([T.StructField("until", T.LongType()), *self.fields]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest: dict[tuple, tuple] = {}
        for row in rows:
            values = tuple(row[f.name] for f in self.fields)
            own = self._own(values)
            other = newest.get(own)
            if other is None or (row["_order"], str(values)) > (other[0], str(other[2])):
                newest[own] = (row["_order"], row["_until"], values)
        held = {self._own(kept[1:]): tuple(kept) for kept in _stored(self.held)}
        earliest = min((kept[0] for kept in held.values()), default=None)
        now = timerValues.getCurrentProcessingTimeInMs()
        replaced, added = False, {}
        for own, (_, until, values) in newest.items():
            # the newer row replaces the one that is held
            replaced = held.pop(own, None) is not None or replaced
            if until is None or until <= now:
                yield _row(self.out, False, *values)
            else:
                added[own] = (until, *values)
        held.update(added)
        if replaced:
            _store(self.held, list(held.values()))
        elif added:
            self.held.appendList(list(added.values()))
        self._wake(earliest, held.values())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        stay, due = [], []
        for kept in _stored(self.held):
            (due if kept[0] <= now else stay).append(tuple(kept))
        if due:
            _store(self.held, stay)
        for kept in due:
            yield _row(self.out, True, *kept[1:])
        self._wake(None, stay)

    def _own(self, values: tuple) -> tuple:
        return tuple(_plain(values[i]) for i in self.key)

    def _wake(self, earliest: int | None, held: Iterable[tuple]) -> None:
        first = min((kept[0] for kept in held), default=None)
        if first != earliest:
            if earliest is not None:
                self.handle.deleteTimer(earliest)
            if first is not None:
                self.handle.registerTimer(first)

    def close(self) -> None:
        pass


def hold_until(rows: DataFrame, on: Sequence[str], until: Column, order: Column, *, groups: int = 65536) -> DataFrame:
    """Rows leave at once when ``until`` is NULL or over, and else when that time comes.

    A timer ends the hold, so a row is released although nothing about it changes any more. A newer
    row of the key, by ``order`` (a NULL counts as oldest) within a batch and by arrival across
    batches, takes the place of the one that is held. The result has ``released_by_timer`` and the
    columns of the rows. The keys are dealt to ``groups`` of state; a batch reads what is held in the groups
    that it touches or whose earliest hold ends.
    """
    row = _Kept(rows, rows.columns, "r")
    at = lambda c: F.unix_millis(c.cast("timestamp"))
    stream = rows.select(
        _group(on, groups).alias("_group"), at(until).alias("_until"), F.coalesce(at(order), F.lit(-(2**62))).alias("_order"),
        *row.stored(),
    )
    out = T.StructType([T.StructField("released_by_timer", T.BooleanType()), *row.fields])
    processor = _Holding(row.fields, [rows.columns.index(c) for c in on])
    made = with_ticks(stream).groupBy("_group").transformWithState(processor, out, "Append", "ProcessingTime")
    return made.select("released_by_timer", *row.read())


def held_rows(spark: SparkSession, checkpoint: str, rows: DataFrame) -> DataFrame:
    """Rows that are held at the end of the last batch, and until when; ``rows`` has their columns."""
    state = spark.read.format("statestore").option("stateVarName", HELD).load(checkpoint)
    return state.select(F.timestamp_millis("list_element.until").alias("held_until"), *_Kept(rows, rows.columns, "r").read("list_element."))
