"""Global shuffle into shards in two passes: scatter into memory-sized buckets, shuffle each bucket.

Rows are scattered by a seeded hash into buckets that fit a task's memory, one bucket to a partition. Every
bucket is put in a fixed order, shuffled by Spark's Fisher-Yates shuffle and written to its place: buckets
one after the other are the global order, and equal slices of it are the shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bucket_offsets, byte_count, square_root_width

BUCKET_BYTES = 8 << 20
# one row of two numbers for each bucket is broadcast; larger tables get larger buckets
MOST_BUCKETS = 1_000_000


def shard(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text: str = "text",
    seed: int = 29,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0 in each shard).

    Row counts of shards differ by one at most. A column of ``docs`` named shard or slot is replaced. Null
    ids and texts are hashed like values; rows that agree in id and text share a bucket, in any order. An
    empty table gives an empty result, and shards without rows are no rows.
    """
    others = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(
        F.col(id_col).alias("__id"),
        F.crc32(F.col(text).cast("binary")).alias("__crc"),
        byte_count(F.col(text)).alias("__bytes"),
        F.struct(*[F.col(c) for c in others]).alias("__row"),
    )
    got = rows.agg(F.sum(F.col("__bytes") + 8).alias("bytes"), F.count("*").alias("rows")).first()
    total, count = got.bytes or 0, got.rows
    buckets = min(MOST_BUCKETS, max(1, math.ceil(total / bucket_bytes)))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "__id", "__crc"), F.lit(buckets)).cast("int")
    rows = rows.withColumn("__bucket", bucket)
    counts = rows.groupBy("__bucket").agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__all", F.lit(0))
    starts = bucket_offsets(counts, ["__all"], "__bucket", "__n", "__start", square_root_width(buckets))

    scattered = rows.repartitionById(buckets, "__bucket").sortWithinPartitions("__id", "__crc", "__bytes")
    gathered = scattered.groupBy("__bucket").agg(F.collect_list("__row").alias("__rows"))
    mixed = gathered.select("__bucket", F.posexplode(F.shuffle("__rows", seed)).alias("__at", "__row"))
    placed = mixed.join(F.broadcast(starts.select("__bucket", "__start")), "__bucket")
    place = F.col("__start") + F.col("__at")
    number = F.floor(((place + 1) * shards - 1) / F.lit(max(count, 1)))
    first = F.floor(number * F.lit(count) / F.lit(shards))
    return placed.select(
        *[F.col("__row").getField(c).alias(c) for c in others],
        number.cast("int").alias("shard"),
        (place - first).cast("bigint").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a bucket's rows go straight to the one or two shards they belong to."""
    sharded.write.partitionBy("shard").parquet(path)
