"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_path(name: str) -> bool:
    return "/" in name


def full_scan(
    spark: SparkSession,
    path_or_table: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A whole parquet path or catalogue table, read with a fixed schema where one is given."""
    if _is_path(path_or_table):
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(path_or_table)
    else:
        df = spark.table(path_or_table)
    return df if columns is None else df.select(*columns)


def column_scan(
    spark: SparkSession, path_or_table: str, columns: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Named columns only; the scan reads nothing else."""
    return full_scan(spark, path_or_table, schema, columns)


def read_table(
    spark: SparkSession, path_or_table: str, columns: Sequence[str] | None = None, condition: Column | str | None = None
) -> DataFrame:
    """Columns of the rows that meet a condition (a column or SQL text)."""
    df = full_scan(spark, path_or_table)
    if condition is not None:
        df = df.where(condition)
    return df if columns is None else df.select(*columns)


def row_count(df: DataFrame, out: str = "cnt") -> DataFrame:
    """One row holding the number of rows."""
    return df.agg(F.count("*").alias(out))


def category_scan(df: DataFrame, category_column: str, categories: Sequence[str]) -> DataFrame:
    """All rows of the given categories in one filtered read."""
    return df.where(F.col(category_column).isin(list(categories)))


def category_union(frames: Mapping[str, DataFrame], category_column: str | None = None) -> DataFrame:
    """Append the frames of several categories; duplicates stay.

    With ``category_column`` every row also carries the name of its category.
    """
    result: DataFrame | None = None
    for category, frame in frames.items():
        if category_column is not None:
            frame = frame.withColumn(category_column, F.lit(category))
        result = frame if result is None else result.unionByName(frame)
    if result is None:
        raise ValueError("no category given")
    return result


def day_predicates(column: str, days: Sequence[date]) -> list[str]:
    """Predicates that cut a date column of a database table into half-open ranges at ``days``.

    Together they cover every row once: the first range is open below and takes the nulls, the last is
    open above.
    """
    cuts = sorted(set(days))
    if not cuts:
        return ["1 = 1"]
    first = f"({column} < '{cuts[0]}' OR {column} IS NULL)"
    middle = [f"({column} >= '{a}' AND {column} < '{b}')" for a, b in zip(cuts, cuts[1:])]
    return [first, *middle, f"({column} >= '{cuts[-1]}')"]


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One partitioned read of a database table in place of a page loop.

    Cut either by the value range of ``partition_column`` or by ``predicates`` (see ``day_predicates``).
    Without both it is a single-connection read, right for small code tables only. Column choice and simple
    filters reach the database.
    """
    if predicates is not None:
        df = spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
    elif partition_column is not None:
        if lower is None or upper is None or num_partitions is None:
            raise ValueError("lower, upper and num_partitions go with partition_column")
        df = (
            spark.read.format("jdbc")
            .options(**dict(properties))
            .option("url", url)
            .option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions))
            .load()
        )
    else:
        df = spark.read.jdbc(url, table, properties=dict(properties))
    return df if columns is None else df.select(*columns)
