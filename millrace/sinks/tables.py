"""Writers of plain folders, which any reader may read as they are.

``write_run`` puts every new state of a table into a directory of its own, and ``merge_partitions`` rewrites the
partitions that an update touches. What replaces rows is written next to its place first and swapped in by
renames, so a write that fails leaves the old rows; ``millrace.sinks.versions`` has tables that switch in one step and
rewrite only what changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import upsert_by_key
from millrace.session import scratch_path


def _staging(path: str) -> str:
    """A fresh folder beside a path, on the same file system; readers of the path's parent skip it."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}-{uuid.uuid4().hex}"


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished folder in the place of another, which goes."""
    fs, source = file_system(spark, fresh)
    _, target = file_system(spark, path)
    fs.mkdirs(target.getParent())
    old = None
    if fs.exists(target):
        _, old = file_system(spark, _staging(path))
        if not fs.rename(target, old):
            raise OSError(f"{path} could not be moved aside")
    if not fs.rename(source, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"{path} could not be replaced")
    if old is not None:
        fs.delete(old, True)


def replace_table(df: DataFrame, path: str) -> None:
    """Drop and load: the path holds exactly ``df`` afterwards, also when that is empty.

    The rows are written beside the path first, so a failure on the way leaves the old ones.
    """
    fresh = _staging(path)
    df.write.parquet(fresh)
    swap_in(df.sparkSession, fresh, path)


def append_pages(pages: Iterable[DataFrame], path: str) -> int:
    """Write frames one after the other: the first replaces, the others append. Returns their number.

    For loads that arrive in several batches; a table that can be read at once takes ``replace_table``.
    """
    written = 0
    for page in pages:
        page.write.mode("append" if written else "overwrite").parquet(path)
        written += 1
    return written


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path on it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the directory names alone."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    prefix = f"{column}="
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def merge_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition_column: str,
    order_cols: Sequence[str] | None = None,
) -> None:
    """Upsert into a table partitioned by one of its keys, rewriting only the partitions in ``updates``.

    The updates are landed by partition first, and the names of their directories say which partitions they
    touch; only these are read, written beside the table and swapped in one by one. With ``order_cols`` the newest of
    several updates of a key counts.
    """
    if partition_column not in keys:
        raise ValueError("the partition column must be one of the keys")
    updates = updates.withColumn("__held", F.col(partition_column))
    staged = scratch_path(spark, "updates")
    updates.write.partitionBy(partition_column).parquet(staged)
    names = [f"{partition_column}={v}" for v in partition_values(spark, staged, partition_column)]
    if not names:
        if not path_exists(spark, path):
            updates.drop("__held").limit(0).write.partitionBy(partition_column).parquet(path)
        return
    there = set(f"{partition_column}={v}" for v in partition_values(spark, path, partition_column))
    held = T.StructType([f for f in updates.schema.fields if f.name != partition_column])
    new = spark.read.schema(held).parquet(*[f"{staged}/{n}" for n in names])
    new = new.withColumnRenamed("__held", partition_column)
    current = new.limit(0)
    if there & set(names):
        current = spark.read.schema(new.schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names if n in there])
    merged = upsert_by_key(current.select(*new.columns), new, keys, order_cols)
    fresh = _staging(path)
    merged.hint("rebalance", partition_column).write.partitionBy(partition_column).parquet(fresh)
    for name in names:
        swap_in(spark, f"{fresh}/{name}", f"{path}/{name}")
    fs, rest = file_system(spark, fresh)
    fs.delete(rest, True)


def _complete_runs(spark: SparkSession, path: str) -> list[str]:
    return [r for r in partition_values(spark, path, "run") if path_exists(spark, f"{path}/run={r}/_SUCCESS")]


def write_run(df: DataFrame, path: str, run_date: date) -> None:
    """Write the complete table of a business date as a new directory; nothing is overwritten.

    A second write on one date gets the next number, and a reader takes the last finished one.
    """
    day = run_date.isoformat()
    same_day = [int(r[len(day) + 1:]) for r in partition_values(df.sparkSession, path, "run") if r.startswith(day)]
    number = max(same_day, default=0) + 1
    df.write.parquet(f"{path}/run={day}.{number:04d}")


def read_run(spark: SparkSession, path: str, on: date) -> DataFrame | None:
    """The table as of the last finished run up to ``on``; None where there is none."""
    runs = [r for r in _complete_runs(spark, path) if r[:10] <= on.isoformat()]
    return spark.read.parquet(f"{path}/run={runs[-1]}") if runs else None


def drop_runs(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Drop all but the last ``keep`` finished runs of a table; returns what went."""
    if keep < 1:
        raise ValueError("at least one run has to stay")
    old = _complete_runs(spark, path)[:-keep]
    for run in old:
        fs, target = file_system(spark, f"{path}/run={run}")
        fs.delete(target, True)
    return old
