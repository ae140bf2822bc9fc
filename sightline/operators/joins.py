"""Join helpers.

No broadcast hint is given anywhere: Spark broadcasts a side only when its size, estimated
or measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def membership(df: DataFrame, members: DataFrame, on: dict[str, str], flag: str) -> DataFrame:
    """Left join to the distinct member keys and add a true/false membership column."""
    marks = members.select(
        *[F.col(theirs).alias(f"_m_{theirs}") for theirs in on.values()]
    ).distinct()
    marks = marks.withColumn("_hit", F.lit(True))
    condition = [df[ours] == marks[f"_m_{theirs}"] for ours, theirs in on.items()]
    return (
        df.join(marks, condition, "left")
        .withColumn(flag, F.col("_hit").isNotNull())
        .drop("_hit", *[f"_m_{c}" for c in on.values()])
    )


def in_any(df: DataFrame, *tests: tuple[DataFrame, dict[str, str], str]) -> DataFrame:
    """Rows that belong to at least one of several key sets, with one flag per set."""
    for members, on, flag in tests:
        df = membership(df, members, on, flag)
    hit = F.lit(False)
    for _, _, flag in tests:
        hit = hit | F.col(flag)
    return df.filter(hit)


def only_needed(lookup: DataFrame, key: str, needed: DataFrame, needed_key: str) -> DataFrame:
    """Shrink a large lookup table to the keys in use before it is joined."""
    keys = needed.select(F.col(needed_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return lookup.join(keys, key, "left_semi")


def near_size_join(
    df: DataFrame,
    sizes: DataFrame,
    *,
    width: str,
    height: str,
    size_width: str,
    size_height: str,
    tolerance: int,
    equal: Sequence[tuple[str, str]] = (),
    pack: int = 1,
) -> DataFrame:
    """Left join to sizes whose width and height are both within ``tolerance``.

    The plane is cut into squares of the tolerance's diameter. A row falls into one square and
    a size into at most four, so this is an equi join and each pair meets at most once.

    ``pack`` above 1 is for results much larger than both sides: sizes near each other are met
    together, that many at most, and pairs are made by many tasks however few the input has
    (:func:`_met_in_packs`). Rows and sizes may not hold maps then.
    """
    if pack > 1:
        return _met_in_packs(
            df, sizes, pack, at=(width, height), size_at=(size_width, size_height),
            tolerance=tolerance, equal=equal,
        )
    cell = 2 * tolerance + 1

    def square(value: Column) -> Column:
        return F.floor(value / F.lit(cell))

    def reach(value: Column) -> Column:
        low, high = square(value - tolerance), square(value + tolerance)
        # both ends may be the same square
        return F.array_distinct(F.array(low, high))

    left = df.withColumn("_wc", square(F.col(width))).withColumn("_hc", square(F.col(height)))
    right = sizes.withColumn("_swc", F.explode(reach(F.col(size_width)))).withColumn(
        "_shc", F.explode(reach(F.col(size_height)))
    )
    condition = [
        left["_wc"] == right["_swc"],
        left["_hc"] == right["_shc"],
        left[width].between(right[size_width] - tolerance, right[size_width] + tolerance),
        left[height].between(right[size_height] - tolerance, right[size_height] + tolerance),
        *[left[a] == right[b] for a, b in equal],
    ]
    return left.join(right, condition, "left").drop("_wc", "_hc", "_swc", "_shc")


# the rows that meet one pack of sizes are dealt into so many parts
PARTS = 16


def _met_in_packs(
    df: DataFrame,
    sizes: DataFrame,
    pack: int,
    *,
    at: tuple[str, str],
    size_at: tuple[str, str],
    tolerance: int,
    equal: Sequence[tuple[str, str]],
) -> DataFrame:
    """The size join for results much larger than both sides.

    Sizes of one square lie in arrays of at most ``pack``, cut in the order of their places and
    values, so that two runs agree. A row meets the packs that hold a place in its reach, is dealt
    to a task by pack and hash, and only there meets the array and its sizes one by one. So rows are
    shuffled once for many sizes, tasks have like shares of the pairs whatever their shares of the
    rows, and write a pack's sizes for one row after another in one order, which files store well.
    """
    spark = df.sparkSession
    theirs = [b for _, b in equal]
    own = [c for c in sizes.columns if c not in theirs]
    # sizes with a NULL here meet no row
    for column in (*size_at, *theirs):
        sizes = sizes.filter(F.col(column).isNotNull())

    def square(value: Column) -> Column:
        return F.floor(value / F.lit(2 * tolerance + 1))

    def near(value: Column, size: Column) -> Column:
        return value.between(size - tolerance, size + tolerance)

    group = [*theirs, "_square_0", "_square_1"]
    key = [*group, "_pack"]
    placed = sizes
    for i, column in enumerate(size_at):
        placed = placed.withColumn(f"_square_{i}", square(F.col(column)))
    rest = [c for c in own if c not in size_at]
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(*size_at, *rest))
    placed = placed.withColumn("_pack", F.floor((turn - 1) / pack))
    # one column per list, as plain values are read faster than rows
    lists = {c: f"_own_{c}" for c in own}
    # one column as key: of several, the optimizer may drop a constant and shuffle once more
    name = F.struct(*key, "_part").alias("_name")
    arrays = (
        placed.groupBy(*key)
        .agg(F.collect_list(F.struct(*own)).alias("_sizes"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        .select(name, *[F.col("_sizes")[c].alias(to) for c, to in lists.items()])
    )

    bounds, left = [], df
    for i, (column, size) in enumerate(zip(at, size_at, strict=True)):
        low, high = F.col(size) - tolerance, F.col(size) + tolerance
        bounds += [F.min(low).alias(f"_low_{i}"), F.max(high).alias(f"_high_{i}")]
        cells = F.sequence(F.min(square(low)), F.max(square(high)))
        bounds.append(cells.alias(f"_cells_{i}"))
        left = left.withColumn(f"_cell_{i}", square(F.col(column)))
    places = F.collect_set(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(size_at)]))
    heads = placed.groupBy(*key).agg(places.alias("_places"), *bounds)
    for i in range(2):
        heads = heads.withColumn(f"_cells_{i}", F.explode(f"_cells_{i}"))
    condition = [left[f"_cell_{i}"] == heads[f"_cells_{i}"] for i in range(2)]
    condition += [left[a] == heads[b] for a, b in equal]
    condition += [left[at[i]].between(heads[f"_low_{i}"], heads[f"_high_{i}"]) for i in range(2)]
    # bounds are enough for one place; of several, one has to be in reach
    condition.append(
        (F.size(heads["_places"]) == 1)
        | F.exists(
            heads["_places"], lambda p: near(left[at[0]], p["_0"]) & near(left[at[1]], p["_1"])
        )
    )

    # a fixed number: by their bytes, few as they are, these rows would be put into few tasks
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        4 * spark.sparkContext.defaultParallelism,
    )
    parts = F.when(F.col("_pack").isNull(), tasks).otherwise(PARTS)
    met = (
        left.join(heads, condition, "left")
        .withColumn("_part", F.pmod(F.xxhash64(*df.columns), parts).cast("int"))
        .select(*df.columns, *theirs, "_pack", name)
        .repartition(tasks, "_name")
    )
    # merged at every size, as that keeps rows of one pack together
    pairs = met.join(arrays.hint("merge"), "_name", "left").select(
        *df.columns, *theirs, "_pack", *lists.values(),
        F.posexplode_outer(lists[own[0]]).alias("_at", "_first"),
    )
    found = {c: F.col(to)[F.col("_at")] for c, to in lists.items()} | {own[0]: F.col("_first")}
    hit = near(F.col(at[0]), found[size_at[0]]) & near(F.col(at[1]), found[size_at[1]])
    return pairs.filter(F.col("_pack").isNull() | hit).select(
        *df.columns, *[found.get(c, F.col(c)).alias(c) for c in sizes.columns]
    )


def constant_lookup(df: DataFrame, table: DataFrame, key: str, value: int, out: str) -> DataFrame:
    """Add the table's row id for one constant key, NULL when the table lacks it."""
    found = table.filter(F.col(key) == value).select(F.max(key))
    return df.withColumn(out, found.scalar())


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    """Equality on all keys where NULL equals NULL."""
    condition = F.lit(True)
    for key in on:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition
