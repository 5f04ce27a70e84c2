"""Joins against one row per key that stay even when one key holds a large part of the rows.

Spark's adaptive skew join splits an oversized join partition, but only from 256 MB on and only where it
adds no shuffle. Here the hot keys are found first, from a sample: keys that alone have HOT_TASKS times the
rows of a mean task. Their rows never enter the shuffle: they meet a broadcast of the few matching rows. That
broadcast has a proven bound, because the other side holds one row per key and at most tasks / HOT_TASKS
keys can be hot (where a row has several keys, so many times more). What the sample misses takes the normal
join, so the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_TASKS = 2
# a hot key is expected in so many sampled rows: far above what chance gives to half as frequent ones
HOT_SAMPLES = 400
# Spark broadcasts what it takes for small by the size of compressed files, and keeps to that when it sees the rows; from
# so many rows on both sides are shuffled
MOST_ROWS = 200_000

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_HASHABLE = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _hash_kind(data_type: T.DataType) -> str | None:
    if isinstance(data_type, _INTEGRAL):
        return "bigint"
    return data_type.simpleString() if isinstance(data_type, _HASHABLE) else None


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column | None:
    kinds = [_hash_kind(df.schema[k].dataType) for k in keys]
    if None in kinds:
        return None
    return F.xxhash64(*[F.col(k).cast(kind) for k, kind in zip(keys, kinds)])


def sized(df: DataFrame, most: int) -> DataFrame:
    """A side of a join that has ``most`` rows at most: if these are many, it is not broadcast whatever its files' size."""
    return df if most <= MOST_ROWS else df.hint("merge")


def _hot(df: DataFrame, sampled: Callable[[DataFrame], DataFrame], tasks: int | None) -> list:
    """Rows (which, h) of the keys that ``sampled`` finds often enough in a sample of ``df``."""
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    fraction = min(1.0, HOT_SAMPLES * tasks / HOT_TASKS / max(total, 1))
    rows = df.sample(fraction, seed=11) if fraction < 1.0 else df
    # no key can be hot that has a single row
    least = max(2.0, HOT_TASKS * total * fraction / tasks)
    return sampled(rows).groupBy("which", "h").count().where(F.col("count") >= least).collect()


def hot_hashes(
    df: DataFrame,
    keys: Sequence[str],
    expand: Callable[[DataFrame], DataFrame] | None = None,
    tasks: int | None = None,
) -> list[int]:
    """Hashes of the keys that have ``HOT_TASKS`` times the rows of a mean task, or more.

    Runs two small jobs: a row count, and a count per key of some hundred sampled rows per task. ``df`` should
    be landed data. ``tasks`` is the number of shuffle partitions, by default the session's. ``expand`` turns
    rows into the rows that carry the keys, where a row has several.
    """

    def sampled(rows: DataFrame) -> DataFrame:
        rows = expand(rows) if expand is not None else rows
        return rows.select(F.lit(0).alias("which"), _key_hash(rows, keys).alias("h"))

    if _key_hash(expand(df) if expand is not None else df, keys) is None:
        return []
    return [r.h for r in _hot(df, sampled, tasks)]


def hot_hashes_each(df: DataFrame, key_sets: Sequence[Sequence[str]], tasks: int | None = None) -> list[list[int]]:
    """``hot_hashes`` for several sets of key columns of one frame, in one pass."""
    hashes = {n: h for n, keys in enumerate(key_sets) if (h := _key_hash(df, keys)) is not None}
    found: list[list[int]] = [[] for _ in key_sets]
    if hashes:
        pairs = F.array(*[F.struct(F.lit(n).alias("which"), h.alias("h")) for n, h in hashes.items()])
        for row in _hot(df, lambda rows: rows.select(F.inline(pairs)), tasks):
            found[row.which].append(row.h)
    return found


def _one_per_key(right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The greatest row of every key."""
    others = [c for c in right.columns if c not in on]
    if not others:
        return right.distinct()
    return right.groupBy(*on).agg(F.max(F.struct(*others)).alias("__row")).select(*on, "__row.*")


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    hot: Sequence[int] | None = None,
    unique: bool = False,
    most: int | None = None,
) -> DataFrame:
    """Join ``left`` with one row per key of ``right`` on equally named columns.

    ``how`` is inner, left, left_semi or left_anti. Of several right rows of a key the greatest counts; a
    caller whose ``right`` has one row per key by construction says so with ``unique``. ``hot`` may be given
    by a caller that knows it (from ``hot_hashes`` of a cheaper frame with the same keys); an empty list means
    a plain join. ``most`` is a bound of the right side's rows; without it they are counted.
    """
    on = [on] if isinstance(on, str) else list(on)
    most = right.count() if most is None else most
    for key in on:
        right = right.where(F.col(key).isNotNull())
    if not unique:
        right = _one_per_key(right, on)
    same_kind = all(_hash_kind(left.schema[k].dataType) == _hash_kind(right.schema[k].dataType) for k in on)
    if not same_kind:
        hot = []
    elif hot is None:
        hot = hot_hashes(left.select(*on), on)
    if not hot:
        return left.join(sized(right, most), on, how)
    is_hot_left = _key_hash(left, on).isin(list(hot))
    is_hot_right = _key_hash(right, on).isin(list(hot))
    even = left.where(~is_hot_left).join(sized(right, most), on, how)
    few = left.where(is_hot_left).join(F.broadcast(right.where(is_hot_right)), on, how)
    return even.unionByName(few)
