import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import numbering
from millrace.operators.numbering import range_row_number
from millrace.sources.paging import page_assignment, page_plan, paged_scan


def plain(df, keys):
    return df.withColumn("row_num", F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


def table(spark, n, seed=3):
    """A third of the rows share one day, some have none."""
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    days = [None if i % 11 == 0 else start if i % 3 == 0 else start + timedelta(days=rnd.randint(-40, 40)) for i in range(n)]
    ids = rnd.sample(range(10 * n), n)
    return spark.createDataFrame(list(zip(days, ids)), "insrt_dt timestamp_ntz, id bigint").repartition(5)


@pytest.mark.parametrize("rows_per_range", [7, 50, 199, 10_000])
def test_equals_plain_window(spark, rows, rows_per_range):
    df = table(spark, 600)
    keys = ["insrt_dt", "id"]
    got = range_row_number(df, keys, rows_per_range=rows_per_range)
    assert got.columns == ["insrt_dt", "id", "row_num"]
    assert rows(got) == rows(plain(df, keys))


def test_string_key(spark, rows):
    df = spark.createDataFrame([(f"{p}{i:03d}", i) for i in range(90) for p in ("02", "HI", "ON", "한")], "order_no string, v int")
    assert rows(range_row_number(df, ["order_no"], rows_per_range=13)) == rows(plain(df, ["order_no"]))


def test_hot_value_is_spread(spark):
    df = table(spark, 900)
    numbered = range_row_number(df, ["insrt_dt", "id"], rows_per_range=30)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    sizes = [s for s in numbered.rdd.glom().map(len).collect()]
    assert sum(sizes) == 900 and max(sizes) < 150


def test_ties_without_unique_key_still_number_densely(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(300)], "k int")
    numbers = sorted(r.row_num for r in range_row_number(df, ["k"], rows_per_range=20).collect())
    assert numbers == list(range(1, 301))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(size=st.integers(1, 130), n=st.integers(0, 120))
def test_pages_give_back_the_table(spark, size, n):
    df = table(spark, 120).where(F.col("id") % 120 < n)
    keys = ["insrt_dt", "id"]
    whole = sorted(r.id for r in df.collect())
    plan = sorted(page_plan(df, size).collect(), key=lambda r: r.page_no)
    assert sum(r.n_rows for r in plan) == len(whole)
    assert [r.page_no for r in plan] == list(range(1, len(plan) + 1))
    assert all(r.last_row - r.first_row + 1 == r.n_rows for r in plan)
    pages = page_assignment(df, keys, size, rows_per_range=25).collect()
    assert sorted(r.id for r in pages) == whole
    by_page = {r.page_no: r.n_rows for r in plan}
    for page in by_page:
        assert sum(r.page_no == page for r in pages) == by_page[page]


@pytest.mark.parametrize("page_no", [1, 3, 6, 7])
def test_one_page(spark, rows, page_no):
    df = table(spark, 100)
    keys = ["insrt_dt", "id"]
    expected = plain(df, keys).where(F.col("row_num").between((page_no - 1) * 17 + 1, page_no * 17))
    assert rows(paged_scan(df, keys, 17, page_no, rows_per_range=9)) == rows(expected)
    assert rows(paged_scan(df, keys, 17, page_no)) == rows(expected)


@pytest.mark.parametrize("n,size,sizes", [(0, 5, []), (1, 5, [1]), (4, 5, [4]), (5, 5, [5]), (6, 5, [5, 1])])
def test_page_plan_edges(spark, n, size, sizes):
    plan = sorted(page_plan(spark.range(n), size).collect(), key=lambda r: r.page_no)
    assert [r.n_rows for r in plan] == sizes


@pytest.mark.parametrize("between", [None, (700, 900)])
def test_many_ranges_cost_few_tasks_and_a_small_plan(spark, rows, between, monkeypatch):
    """Two thousand ranges: neighbours share a task, and the search for a row's range is in the plan once."""
    monkeypatch.setattr(numbering, "MOST_TASKS", 20, raising=False)
    df = spark.range(4000).select((F.col("id") * 37 % 4000).alias("k"), F.lit("x").alias("v"))
    numbered = range_row_number(df, ["k"], rows_per_range=2, between=between)
    planned = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert len(planned) < 20_000
    first, last = between or (1, 4000)
    assert rows(numbered) == rows(df.select("k", "v", (F.col("k") + 1).alias("row_num")).where(F.col("row_num").between(first, last)))
    if between is None:
        parts = numbered.select("row_num", F.spark_partition_id().alias("p")).groupBy("p").agg(F.min("row_num").alias("a"), F.max("row_num").alias("b"))
        held = sorted(parts.collect(), key=lambda r: r.a)
        assert len(held) <= 20 and all(x.b + 1 == y.a for x, y in zip(held, held[1:]))
