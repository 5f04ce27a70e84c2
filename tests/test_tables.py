from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.tables import (
    append_pages,
    drop_runs,
    merge_partitions,
    read_run,
    replace_table,
    write_run,
)
from millrace.sources.tables import column_scan, day_predicates, full_scan, jdbc_scan, read_table, row_count


def test_scans(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(5).withColumn("b", F.col("id") * 2), path)
    assert rows(full_scan(spark, path)) == [(i, 2 * i) for i in range(5)]
    assert "ReadSchema: struct<b:bigint>" in column_scan(spark, path, ["b"])._jdf.queryExecution().toString()
    assert rows(read_table(spark, path, ["id"], "b >= 6")) == [(3,), (4,)]
    assert row_count(full_scan(spark, path)).first().cnt == 5
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("gone", T.StringType())])
    assert full_scan(spark, path, schema).first().gone is None
    spark.range(2).createOrReplaceTempView("a_view")
    assert rows(read_table(spark, "a_view", condition=F.col("id") > 0)) == [(1,)]


def test_replace_with_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(5), path)
    replace_table(spark.range(0), path)
    assert spark.read.parquet(path).count() == 0


def test_append_pages(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(100, 105), path)
    assert append_pages((spark.range(i, i + 2) for i in (0, 2, 4)), path) == 3
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(6)]


def test_merge_touches_only_its_partitions(spark, rows, tmp_path):
    path = f"{tmp_path}/ledger"
    schema = "dag_id string, v int, d date"
    first = spark.createDataFrame([("a", 1, date(2024, 1, 1)), ("a", 2, date(2024, 1, 2)), ("b", 3, date(2024, 1, 2))], schema)
    merge_partitions(spark, path, first, ["dag_id", "d"], "d")
    before = {f for f in spark.read.parquet(path).inputFiles() if "2024-01-01" in f}
    update = spark.createDataFrame([("a", 9, date(2024, 1, 2)), ("c", 7, date(2024, 1, 3)), ("a", 8, date(2024, 1, 2))], schema)
    for _ in range(2):  # twice is the same as once
        merge_partitions(spark, path, update, ["dag_id", "d"], "d", ["v"])
        got = rows(spark.read.parquet(path), "dag_id", "v")
        assert got == [("a", 1), ("a", 9), ("b", 3), ("c", 7)]
    assert before == {f for f in spark.read.parquet(path).inputFiles() if "2024-01-01" in f}
    with pytest.raises(ValueError):
        merge_partitions(spark, path, update, ["dag_id"], "d")


def test_runs(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    assert read_run(spark, path, date(2024, 1, 9)) is None
    write_run(spark.range(1), path, date(2024, 1, 1))
    write_run(spark.range(2), path, date(2024, 1, 3))
    write_run(read_run(spark, path, date(2024, 1, 3)).union(spark.range(9, 10)), path, date(2024, 1, 3))
    assert read_run(spark, path, date(2024, 1, 2)).count() == 1
    assert read_run(spark, path, date(2024, 1, 3)).count() == 3
    # an unfinished run is not read
    spark.range(7).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/run=2024-01-04.0001")
    assert read_run(spark, path, date(2024, 1, 5)).count() == 3
    assert drop_runs(spark, path, 1) == ["2024-01-01.0001", "2024-01-03.0001"]
    assert read_run(spark, path, date(2024, 1, 5)).count() == 3
    assert read_run(spark, path, date(2024, 1, 2)) is None


def test_day_predicates_cover_every_row_once(spark):
    days = [date(2024, 1, 1), date(2024, 1, 5), date(2024, 1, 5), date(2023, 6, 1)]
    df = spark.sql("SELECT date'2023-01-01' + make_dt_interval(cast(id AS int)) AS d FROM range(800)").unionByName(
        spark.sql("SELECT cast(null AS timestamp) AS d")
    ).selectExpr("cast(d AS date) AS d")
    predicates = day_predicates("d", days)
    assert len(predicates) == 4
    assert sum(df.where(p).count() for p in predicates) == 801
    assert day_predicates("d", []) == ["1 = 1"]


def test_jdbc_scan_needs_all_bounds(spark):
    with pytest.raises(ValueError):
        jdbc_scan(spark, "jdbc:x", "t", {}, partition_column="id", lower=1)
