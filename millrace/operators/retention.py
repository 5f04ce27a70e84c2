"""Plans for dated partitions: which to have and which to drop."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import compact_date, name_suffix_date

AHEAD_DAYS = 7


def partition_plan(managed: DataFrame, today: date, ahead_days: int = AHEAD_DAYS) -> DataFrame:
    """One row per managed table and day from today - store_d_num to the day before today + ahead_days.

    ``managed`` has schema_nm, table_nm, store_d_num, partition_tf.
    """
    first = F.date_sub(F.lit(today), F.col("store_d_num"))
    last = F.date_add(F.lit(today), ahead_days - 1)
    days = managed.where("partition_tf").select(
        "schema_nm", "table_nm", F.explode(F.sequence(first, last)).alias("from_date")
    )
    return days.select(
        "schema_nm",
        "table_nm",
        compact_date("from_date").alias("suffix"),
        "from_date",
        F.date_add("from_date", 1).alias("to_date"),
    )


def expired_partitions(names: DataFrame, column: str, today: date, keep_days: int) -> DataFrame:
    """Dated names (ending in _yyyymmdd) whose day is before today - keep_days - 1, with their suffix."""
    day = name_suffix_date(column)
    return names.where(day < F.date_sub(F.lit(today), keep_days + 1)).withColumn(
        "suffix", F.right(F.col(column), F.lit(8))
    )


def expired_of_managed(names: DataFrame, column: str, managed: DataFrame, today: date) -> DataFrame:
    """Like ``expired_partitions``, with the retention of the managed table each name belongs to.

    ``names`` has schema_nm too, and a managed table is known by schema and name. The part before the suffix
    must equal table_nm, so a table whose name merely begins alike is safe.
    """
    kept = managed.where("partition_tf").select("schema_nm", "table_nm", "store_d_num")
    dated = names.withColumn("table_nm", F.regexp_extract(column, "^(.*)_[0-9]{8}$", 1))
    limit = F.date_sub(F.lit(today), F.col("store_d_num") + 1)
    return (
        dated.join(kept, ["schema_nm", "table_nm"])
        .where(name_suffix_date(column) < limit)
        .select("schema_nm", "table_nm", column, F.right(F.col(column), F.lit(8)).alias("suffix"))
    )
