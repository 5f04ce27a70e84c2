"""Global row numbers without a single-partition window.

Sort keys are cut into ranges in two levels. A sample of the keys is range-partitioned by Spark and landed: its
partitions are the coarse ranges, and every few keys of one begin a fine range. A row finds its coarse range among
the square root of all bounds, which are constants of the plan, and its fine range among those of the landed table for
that coarse range. Both are pure functions of the keys, so a task that is run again gives the same rows. Rows per range
are counted, summed up to offsets in two levels as well, and every range is numbered by itself. Neighbouring ranges share
a task where there are many: what a task costs the driver then grows with the rows, not with the ranges. No number
bounds the ranges, and no task or driver holds more than about the square root of their number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import land

ROWS_PER_RANGE = 500_000
# ranges whose bounds and offsets are broadcast; more of them are joined by a shuffle
MOST_BROADCAST = 1_000_000
# ranges are numbered in at most so many tasks, or one for each ROWS_PER_RANGE rows where that is more
MOST_TASKS = 200
_SAMPLES_PER_RANGE = 10


def _sort_key(order_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def _small(df: DataFrame, ranges: int) -> DataFrame:
    return F.broadcast(df) if ranges <= MOST_BROADCAST else df


def _bounds(df: DataFrame, order_cols: Sequence[str], total: int, ranges: int) -> DataFrame:
    """Landed rows (coarse, first, bounds, base): a coarse range's lowest sampled key, the lower bounds of its fine ranges
    but the first, and the number of ranges before it."""
    fraction = min(1.0, ranges * _SAMPLES_PER_RANGE / max(total, 1))
    sample = df.select(*order_cols)
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=7)
    coarse = max(1, math.isqrt(ranges))
    sample = sample.repartitionByRange(coarse, *order_cols).select(
        F.spark_partition_id().alias("coarse"), _sort_key(order_cols).alias("k")
    )
    step = max(1, round(total * fraction / ranges))
    keys = land(sample, "sampled-keys").groupBy("coarse").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    found = keys.select(
        "coarse",
        F.get("ks", F.lit(0)).alias("first"),
        F.array_distinct(F.filter("ks", lambda k, i: (i > 0) & (i % step == 0))).alias("bounds"),
    )
    before = Window.orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum(F.size("bounds") + 1).over(before), F.lit(0)).cast("int")
    return land(found.withColumn("base", base), "range-bounds")


def _place(column: str, bounds: Column, size: Column | int, steps: int, df: DataFrame) -> DataFrame:
    """Add ``column``, the number of sorted ``bounds`` that are not above __key, by halving steps.

    The steps are a fold over their widths, so the expression has one size however many there are. As nested
    projections Spark wrote out each step in both branches of the next, and its generated code doubled with each.
    """
    if steps == 0:
        return df.withColumn(column, F.lit(0))
    bound_count = F.lit(size) if isinstance(size, int) else size

    def halved(place: Column, width: Column) -> Column:
        ahead = place + width
        return F.when((ahead <= bound_count) & (F.get(bounds, ahead - 1) <= F.col("__key")), ahead).otherwise(place)

    widths = F.array(*[F.lit(1 << power) for power in range(steps - 1, -1, -1)])
    # never null, and Spark has to see it: it would filter for it before the joins and search a second time there
    return df.withColumn(column, F.coalesce(F.aggregate(widths, F.lit(0), halved), F.lit(0)))


def _with_range(df: DataFrame, order_cols: Sequence[str], bounds: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """Add __coarse and __range to all rows; returns the number of ranges too."""
    lowest = bounds.select("coarse", "first", F.size("bounds").alias("n"), "base")
    # as many rows as the square root of the ranges
    got = lowest.agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("coarse", "first"))), lambda c: c["first"])).alias("firsts"),
        F.count("*").alias("coarse"),
        F.coalesce(F.max("n"), F.lit(0)).alias("most"),
        F.coalesce(F.max(F.col("base") + F.col("n") + 1), F.lit(1)).alias("ranges"),
    ).first()
    if got.coarse == 0:
        return df.withColumn("__coarse", F.lit(0)).withColumn("__range", F.lit(0)), 1
    key_type = df.select(F.array(_sort_key(order_cols)).alias("ks")).schema["ks"].dataType
    # what JSON rounds off does not matter, as long as the bounds are sorted
    firsts = F.sort_array(F.from_json(F.lit(got.firsts), key_type))
    upper = F.slice(firsts, 2, max(got.coarse - 1, 1)) if got.coarse > 1 else F.slice(firsts, 1, 0)
    keyed = df.withColumn("__key", _sort_key(order_cols))
    keyed = _place("__coarse", upper, got.coarse - 1, (got.coarse - 1).bit_length(), keyed)
    # coarse ranges are numbered without gaps here, whatever partitions were empty
    number = F.row_number().over(Window.orderBy("coarse")) - 1
    fine = bounds.select(number.alias("__coarse"), F.col("bounds").alias("__bounds"), F.col("base").alias("__base"))
    keyed = keyed.join(_small(fine, ranges), "__coarse")
    placed = _place("__fine", F.col("__bounds"), F.size("__bounds"), got.most.bit_length(), keyed)
    placed = placed.withColumn("__range", F.coalesce(F.col("__base") + F.col("__fine"), F.lit(0)))
    return placed.drop("__key", "__bounds", "__base", "__fine"), got.ranges


def _offsets(placed: DataFrame) -> DataFrame:
    """(__range, __rows, __before): rows of a range and of all ranges before it, in two levels."""
    counts = placed.groupBy("__coarse", "__range").agg(F.count("*").alias("__rows"))
    counts = land(counts, "range-counts")
    inside = Window.partitionBy("__coarse").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    whole = counts.groupBy("__coarse").agg(F.sum("__rows").alias("__sum"))
    whole = whole.select("__coarse", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    summed = counts.withColumn("__inner", F.coalesce(F.sum("__rows").over(inside), F.lit(0))).join(whole, "__coarse")
    return summed.select("__range", "__rows", (F.col("__inner") + F.col("__start")).alias("__before"))


def range_row_number(
    df: DataFrame,
    order_cols: Sequence[str],
    out: str = "row_num",
    rows_per_range: int = ROWS_PER_RANGE,
    between: tuple[int, int] | None = None,
    total: int | None = None,
) -> DataFrame:
    """Number all rows 1..n by ``order_cols`` (ascending, nulls first).

    ``order_cols`` must end in a unique key, or the order among equal keys is open. With ``between`` only
    the rows numbered first..last are returned, and rows of ranges outside it are dropped before the
    shuffle; who reads many pages stores them once (``millrace.sources.paging``). A table of one range needs no sample
    and no bounds. The input must be landed data: it is read more than once.
    """
    order_cols = list(order_cols)
    total = df.count() if total is None else total
    ranges = max(1, math.ceil(total / rows_per_range))
    if ranges == 1:
        placed, size = df.withColumn("__coarse", F.lit(0)).withColumn("__range", F.lit(0)), 1
    else:
        placed, size = _with_range(df, order_cols, _bounds(df, order_cols, total, ranges), ranges)
    in_range = Window.partitionBy("__range").orderBy(*order_cols)
    number = F.row_number().over(in_range).cast("bigint")
    if size == 1:
        numbered = placed.withColumn(out, number)
    else:
        offsets = _offsets(placed)
        if between is None:
            tasks = min(size, max(MOST_TASKS, math.ceil(total / ROWS_PER_RANGE)))
            # consecutive ranges to a task, so a task has consecutive numbers
            task = F.floor(F.col("__range") * F.lit(tasks) / F.lit(size)).cast("int")
            dealt = placed.withColumn("__task", task).repartitionById(tasks, "__task")
            in_task = Window.partitionBy("__task", "__range").orderBy(*order_cols)
            numbered = dealt.withColumn(out, F.row_number().over(in_task).cast("bigint")).drop("__task")
        else:
            first, last = between
            offsets = offsets.where((F.col("__before") + F.col("__rows") >= first) & (F.col("__before") < last))
            numbered = placed.join(_small(offsets.select("__range"), size), "__range", "left_semi").withColumn(out, number)
        numbered = numbered.join(_small(offsets.select("__range", "__before"), size), "__range")
        numbered = numbered.withColumn(out, F.col(out) + F.col("__before")).drop("__before")
    numbered = numbered.drop("__range", "__coarse")
    return numbered if between is None else numbered.where(F.col(out).between(*between))
