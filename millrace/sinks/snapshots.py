"""Dated snapshots with retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import PARTITION_MANAGER
from millrace.sinks import versions
from millrace.sinks.tables import file_system, partition_values, path_exists, replace_table
from millrace.sources.tables import full_scan

LOGGING_DT = "logging_dt"


def _compact(day: date) -> str:
    return day.strftime("%Y%m%d")


def _day(value: str) -> date | None:
    try:
        return datetime.strptime(value, "%Y%m%d").date()
    except ValueError:
        return None


def write_snapshot(df: DataFrame, path: str, day: date) -> None:
    """Replace the partition of ``day`` with a copy of the whole table; other days stay.

    The partition directory is written as a table of its own, so an empty table empties its day as well, and a
    failure leaves the day as it was.
    """
    replace_table(df, f"{path}/{LOGGING_DT}={_compact(day)}")


def replace_day(df: DataFrame, path: str, day: date) -> None:
    """Like ``write_snapshot`` for a table of versions: the day is replaced in one step."""
    dated = df.withColumn(LOGGING_DT, F.lit(int(_compact(day))))
    versions.replace_parts(dated, path, LOGGING_DT, parts=[_compact(day)])


def replace_days(df: DataFrame, path: str) -> None:
    """Like ``write_dated`` for a table of versions: all days that ``df`` has rows of are replaced in one step."""
    versions.replace_parts(df, path, LOGGING_DT)


def partition_days(spark: SparkSession, path: str) -> DataFrame:
    """The inventory of a table of versions by day: logging_date, bytes. Values that are no day are left out."""
    day = F.try_to_date(F.when(F.col("part").rlike("^[0-9]{8}$"), F.col("part")), "yyyyMMdd")
    held = versions.inventory(spark, path).select(day.alias("logging_date"), "bytes")
    return held.where(F.col("logging_date").isNotNull())


def keep_days_of(spark: SparkSession, path: str, schema_nm: str, table_nm: str) -> int | None:
    """How many days the retention table at ``path`` keeps of a table; None where it is not managed."""
    if not path_exists(spark, path):
        return None
    managed = full_scan(spark, path, PARTITION_MANAGER).where("partition_tf")
    managed = managed.where((F.col("schema_nm") == schema_nm) & (F.col("table_nm") == table_nm))
    return managed.agg(F.max("store_d_num").alias("days")).first().days


def drop_expired_days(spark: SparkSession, path: str, today: date, keep_days: int) -> list[date]:
    """Make a version without the days before today - keep_days - 1; returns them. Their number is that of the days
    past retention, a few at each run."""
    limit = F.lit(today - timedelta(days=keep_days + 1))
    expired = [r.logging_date for r in partition_days(spark, path).where(F.col("logging_date") < limit).collect()]
    if expired:
        versions.drop_parts(spark, path, [_compact(d) for d in expired])
    return sorted(expired)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All days, with logging_dt as an integer yyyymmdd; of a plain folder or of a table of versions."""
    df = versions.read(spark, path)
    if df is None:
        df = spark.read.parquet(path)
    return df.withColumn(LOGGING_DT, F.col(LOGGING_DT).cast("int"))


def write_dated(df: DataFrame, path: str) -> None:
    """Write rows that carry logging_dt into their days; only these days are replaced.

    Rebalancing splits a day with many rows over several tasks and packs small days together.
    """
    (
        df.hint("rebalance", LOGGING_DT)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOGGING_DT)
        .parquet(path)
    )


def list_partitions(spark: SparkSession, path: str) -> list[date]:
    """Days that have a partition, from the directory names; names that are no day are left out."""
    days = [_day(v) for v in partition_values(spark, path, LOGGING_DT)]
    return [d for d in days if d is not None]


def drop_expired(spark: SparkSession, path: str, today: date, keep_days: int) -> list[date]:
    """Drop the days before today - keep_days - 1; returns them."""
    limit = today - timedelta(days=keep_days + 1)
    expired = [d for d in list_partitions(spark, path) if d < limit]
    for day in expired:
        fs, target = file_system(spark, f"{path}/{LOGGING_DT}={_compact(day)}")
        fs.delete(target, True)
    return expired
