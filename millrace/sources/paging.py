"""Numbered pages of a table.

``paged_scan`` answers one page of a table as it is. Who reads page after page stores the numbered rows first
(``store_pages``): one sort puts them into files of consecutive rows, and an index knows the first and last row of each.
A page then reads the files it lies in and nothing else (``read_page``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.numbering import ROWS_PER_RANGE, range_row_number
from millrace.sinks import versions

ROW = "row_num"
# files of a page that are named to the scan
MOST_NAMED = 32
INDEX = "file string, first_row bigint, last_row bigint"


def page_of(row_num: Column | str, page_size: int) -> Column:
    """The page (from 1) that holds a row number (from 1)."""
    column = F.col(row_num) if isinstance(row_num, str) else row_num
    return F.floor((column - 1) / F.lit(page_size)).cast("bigint") + 1


def paged_scan(
    df: DataFrame,
    order_cols: Sequence[str],
    page_size: int,
    page_no: int,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One page of the rows numbered by ``order_cols``; only ranges that touch the page are shuffled."""
    first = (page_no - 1) * page_size + 1
    return range_row_number(
        df, order_cols, rows_per_range=rows_per_range, between=(first, first + page_size - 1)
    )


def page_assignment(
    df: DataFrame, order_cols: Sequence[str], page_size: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Every row with its number and its page."""
    numbered = range_row_number(df, order_cols, rows_per_range=rows_per_range)
    return numbered.withColumn("page_no", page_of("row_num", page_size))


def page_plan(df: DataFrame, page_size: int) -> DataFrame:
    """First row, last row and size of every page. Needs the row count only, no sort."""
    total = df.count()
    pages = -(-total // page_size)
    last_row = F.least((F.col("id") + 1) * page_size, F.lit(total))
    return df.sparkSession.range(pages).select(
        (F.col("id") + 1).alias("page_no"),
        (F.col("id") * page_size + 1).alias("first_row"),
        last_row.alias("last_row"),
        (last_row - F.col("id") * page_size).alias("n_rows"),
    )


def store_pages(
    df: DataFrame, path: str, order_cols: Sequence[str], rows_per_file: int = ROWS_PER_RANGE, label: str = "-"
) -> DataFrame:
    """Number the rows by ``order_cols`` and store them in files of about ``rows_per_file`` consecutive rows.

    Rows get ``row_num``, from 1. The sort is done once; the order among equal keys is open but, once stored, the same
    for all pages, so pages never overlap or miss a row. Returns the index: file, first_row, last_row. Storing
    again replaces rows and index, each in one step.
    """
    spark = df.sparkSession
    numbered = range_row_number(df, order_cols, out=ROW, rows_per_range=rows_per_file).sortWithinPartitions(ROW)
    versions.replace(numbered, f"{path}/rows", label, rows_per_file=rows_per_file)
    stored = versions.read(spark, f"{path}/rows")
    index = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.min(ROW).alias("first_row"), F.max(ROW).alias("last_row")
    )
    versions.replace(index, f"{path}/index", label)
    return page_index(spark, path)


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored file: file, first_row, last_row."""
    found = versions.read(spark, f"{path}/index")
    if found is None:
        raise FileNotFoundError(f"no pages are stored at {path}")
    return found


def read_page(spark: SparkSession, path: str, page_size: int, page_no: int) -> DataFrame:
    """One page of the stored rows, without a shuffle; a page past the last is empty.

    The names of the files it lies in, a few, are looked up first; the scan has no others. A page of more files than
    ``MOST_NAMED`` is read from the whole folder: names of many would be held, checked and listed one by one.
    """
    first = (page_no - 1) * page_size + 1
    last = first + page_size - 1
    touched = page_index(spark, path).where((F.col("first_row") <= last) & (F.col("last_row") >= first))
    files = [r.file for r in touched.select("file").limit(MOST_NAMED + 1).collect()]
    schema: T.StructType = versions.version(spark, f"{path}/rows").schema
    if not files:
        return spark.createDataFrame([], schema)
    if len(files) > MOST_NAMED:
        return versions.read(spark, f"{path}/rows").where(F.col(ROW).between(first, last))
    return spark.read.schema(schema).parquet(*sorted(files)).where(F.col(ROW).between(first, last))
