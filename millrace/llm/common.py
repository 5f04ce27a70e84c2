"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import io
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import shared_folder

# fixed values: ASCII white space and what lies between it, as Java and Python patterns
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def byte_count(text: Column) -> Column:
    """UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Give this package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    # the driver hands this file out itself; executors don't read the folder
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace_code.zip")
    Path(path).write_bytes(held.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Return to the system what this process's allocators keep for arrays that are gone."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of batches, after which the worker gives back what it holds no longer.

    Workers outlive stages, and what the allocators keep for them counts beside the executor's heap while it is busy.
    """

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return wrapped


def fresh_path(spark, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/millrace-llm/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and lost executors cost nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_offsets(counts: DataFrame, keys: Sequence[str], bucket: str, value: str, out: str, width: int) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the smaller buckets of the same ``keys``.

    ``counts`` has one row per keys and bucket. Two levels, ``width`` buckets to a block: sums within blocks
    and sums of whole blocks, so no task sees more than the larger of width and buckets / width rows of a key.
    """
    keys = list(keys)
    block = counts.withColumn("__block", F.floor(F.col(bucket) / width).cast("bigint"))
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = block.groupBy(*keys, "__block").agg(F.sum(value).alias("__sum"))
    blocks = blocks.withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(*keys, "__block").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    block = block.withColumn("__inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "__block"]]
    joined = block.alias("a").join(blocks.alias("b"), on)
    kept = [F.col(f"a.{c}") for c in counts.columns]
    return joined.select(*kept, (F.col("a.__inner") + F.col("b.__base")).alias(out))


def square_root_width(rows: int) -> int:
    """Buckets and rows per bucket grow alike with the table."""
    return max(1, math.isqrt(max(rows, 1)))
