"""Merge semantics as functions ``(target, source) -> DataFrame``.

The target is usually far larger than the source, so the target is only ever on the streamed
side of a left or semi join. With a small source Spark broadcasts the source and the target is
neither shuffled nor sorted; with a large one both sides are sort-merge joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]
#: (target column, source column) -> condition or value
Pair = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def matched_keys(target: DataFrame, source: DataFrame, on: Keys) -> DataFrame:
    """Keys of the target that also occur in the source; reads only the key columns."""
    return target.select(*on).join(source.select(*on), list(on), "left_semi")


def absent_rows(target: DataFrame, source: DataFrame, on: Keys) -> DataFrame:
    """Source rows whose key the target lacks. This is all an insert-only merge must write."""
    return source.join(matched_keys(target, source, on), list(on), "left_anti")


def insert_only(target: DataFrame, source: DataFrame, on: Keys) -> DataFrame:
    """WHEN NOT MATCHED INSERT."""
    return target.unionByName(absent_rows(target, source, on), allowMissingColumns=True)


def insert_do_nothing(
    target: DataFrame, source: DataFrame, on: Keys, order: Sequence[Column]
) -> DataFrame:
    """Insert and ignore conflicts, also between source rows (the first in ``order`` stays)."""
    from sightline.operators.picks import first_per_key

    return insert_only(target, first_per_key(source, on, order), on)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    *,
    update: Iterable[str] | None = None,
    values: dict[str, Pair] | None = None,
    when: Pair | None = None,
    insert: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """General merge of a source with at most one row per key; the job fails on a second one.

    ``update``: columns taken from the source on a match (default: all non-key columns both
    sides share). ``values``: columns computed from both sides. ``when``: extra condition of
    the update. ``insert``: add unmatched source rows.
    """
    source = require_single_match(source, on, null_safe=null_safe)
    values = values or {}
    shared = [c for c in target.columns if c in source.columns and c not in on]
    taken = list(shared if update is None else update)
    renamed = source.select([F.col(c).alias(f"_s_{c}") for c in source.columns]).withColumn(
        "_hit", F.lit(True)
    )

    def t(name: str) -> Column:
        return target[name]

    def s(name: str) -> Column:
        return renamed[f"_s_{name}"]

    def same(key: str) -> Column:
        return t(key).eqNullSafe(s(key)) if null_safe else t(key) == s(key)

    joined = target.join(renamed, reduce(lambda a, b: a & b, [same(k) for k in on]), "left")
    apply = renamed["_hit"].isNotNull()
    if when is not None:
        # an unknown condition does not update
        apply = apply & F.coalesce(when(t, s), F.lit(False))

    def merged(name: str) -> Column:
        if name in values:
            return F.when(apply, values[name](t, s)).otherwise(t(name)).alias(name)
        if name in taken:
            return F.when(apply, s(name)).otherwise(t(name)).alias(name)
        return t(name)

    result = joined.select([merged(c) for c in target.columns])
    if not insert:
        return result
    if null_safe:
        keys = target.select(*on)
        found = source.select(*on).join(
            keys.select([F.col(k).alias(f"_t_{k}") for k in on]),
            reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in on]),
            "left_anti",
        )
        marked = found.select([F.col(k).alias(f"_n_{k}") for k in on])
        new = source.join(
            marked,
            reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in on]),
            "left_semi",
        )
    else:
        new = absent_rows(target, source, on)
    columns = [c for c in target.columns if c in source.columns]
    return result.unionByName(new.select(columns), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, on: Keys) -> DataFrame:
    """Whole-row upsert: kept target rows and all source rows; no column-wise work.

    The job fails when a key occurs more than once in the source.
    """
    source = require_single_match(source, on)
    kept = target.join(source.select(*on), list(on), "left_anti")
    return kept.unionByName(source.select(target.columns))


def keep_old_when_null(name: str) -> Pair:
    """Value rule: the source value unless it is NULL."""
    return lambda t, s: F.coalesce(s(name), t(name))


def differs(name: str, source_name: str | None = None) -> Pair:
    """Update condition ``target <> source``; not true when either side is NULL."""
    return lambda t, s: t(name) != s(source_name or name)


def is_earlier(name: str) -> Pair:
    """Update condition: the source event came before the stored one."""
    return lambda t, s: t(name) > s(name)


def park_release(
    buffer: DataFrame, rows: DataFrame, on: Keys, release: Column, park: Column
) -> DataFrame:
    """New buffer: parked rows that resolved leave, new rows that must wait enter."""
    released = rows.filter(release).select(*on)
    waiting = rows.filter(park)
    kept = buffer.join(released, list(on), "left_anti")
    entering = absent_rows(buffer, waiting, on).dropDuplicates(list(on))
    return kept.unionByName(entering.select(buffer.columns))


def delete_by_keys(target: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    condition = [target[ours] == keys[theirs] for ours, theirs in on.items()]
    return target.join(keys, condition, "left_anti")


def update_by_keys(
    target: DataFrame, keys: DataFrame, on: Keys, changes: dict[str, Column], where: Column
) -> DataFrame:
    """Set columns on target rows whose key is in ``keys`` and that satisfy ``where``."""
    marks = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    hit = F.col("_hit").isNotNull() & F.coalesce(where, F.lit(False))
    columns = [
        F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
        for c in target.columns
    ]
    return target.join(marks, list(on), "left").select(columns)


def replace_scope(target: DataFrame, fresh: DataFrame, scope: DataFrame, on: Keys) -> DataFrame:
    """Delete the rows of the scoped ids and insert fresh ones, so removals carry over."""
    kept = target.join(scope.select(*on).distinct(), list(on), "left_anti")
    return kept.unionByName(fresh.select(target.columns))


def accumulate(
    state: DataFrame,
    delta: DataFrame,
    on: Keys,
    *,
    add: Sequence[str] = (),
    low: Sequence[str] = (),
    high: Sequence[str] = (),
) -> DataFrame:
    """Add counts and widen bounds; new groups are inserted. NULL keys equal each other."""
    columns = [*on, *add, *low, *high]
    both = state.select(columns).unionByName(delta.select(columns))
    return both.groupBy(*on).agg(
        *[F.sum(c).alias(c) for c in add],
        *[F.min(c).alias(c) for c in low],
        *[F.max(c).alias(c) for c in high],
    )


def count_first_days(
    events: DataFrame, first: DataFrame, on: Keys, *, day: str, first_ts: str, days: int, add: str
) -> DataFrame:
    """Sum ``add`` per group over events less than ``days`` days after the group's first."""
    within = F.datediff(F.to_date(F.col(day)), F.to_date(F.col(first_ts))) < days
    starts = first.select(*[F.col(c).alias(f"_f_{c}") for c in on], F.col(first_ts))
    same = [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in on]
    joined = events.join(starts, reduce(lambda a, b: a & b, same))
    return joined.filter(within).groupBy(*on).agg(F.sum(add).alias(add))


def multi_matches(source: DataFrame, on: Keys) -> DataFrame:
    """Keys that more than one source row would update."""
    counts = source.groupBy(*on).agg(F.count(F.lit(1)).alias("matches"))
    return counts.filter(F.col("matches") > 1)


def require_single_match(source: DataFrame, on: Keys, *, null_safe: bool = False) -> DataFrame:
    """The source itself; the job fails when a key occurs more than once.

    NULL keys match no target row and may repeat, unless ``null_safe``. The rows are counted in a
    window on the key, which is the partitioning that a sort-merge join of the source needs next.
    """
    repeated = F.count(F.lit(1)).over(Window.partitionBy(*on)) > 1
    if not null_safe:
        repeated = repeated & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    message = F.concat(F.lit("more than one source row for "), F.to_json(F.struct(*on)))
    checked = F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(True)
    return source.withColumn("_single", checked).filter("_single").drop("_single")


def spread_flag(rows: DataFrame, family: DataFrame, *, id: str, flag: str) -> DataFrame:
    """Children of a flagged parent take the flag; ``family`` has parent and child ids."""
    parents = rows.filter(flag).select(F.col(id).alias("parent_creative_id"))
    children = family.join(parents, "parent_creative_id", "left_semi")
    keys = children.select(F.col("child_creative_id").alias(id))
    return update_by_keys(rows, keys, [id], {flag: F.lit(True)}, F.lit(True))
