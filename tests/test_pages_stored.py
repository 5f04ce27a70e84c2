import pytest
from pyspark.sql import functions as F

from millrace.operators import numbering
from millrace.operators.numbering import range_row_number
from millrace.sinks import versions
from millrace.sources.paging import page_index, read_page, store_pages


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def table(spark):
    # keys tie, a third of the rows has none
    return spark.range(1000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("at"), (F.col("id") * 7 % 1000).alias("v"))


def test_a_hundred_pages_cost_one_sort(spark, rows, tmp_path, table):
    path = f"{tmp_path}/pages"
    index = store_pages(table, path, ["at"], rows_per_file=100).orderBy("first_row").collect()
    assert index[0].first_row == 1 and index[-1].last_row == 1000 and len(index) >= 5
    assert all(a.last_row + 1 == b.first_row for a, b in zip(index, index[1:]))
    seen = []
    for page in range(1, 101):
        df = read_page(spark, path, 10, page)
        plan = plan_of(df)
        assert "Exchange" not in plan and "Sort" not in plan
        assert 1 <= len(df.inputFiles()) <= 3
        seen += [(r.row_num, r.v) for r in df.collect()]
    assert sorted(n for n, _ in seen) == list(range(1, 1001)) and len({v for _, v in seen}) == 1000
    assert read_page(spark, path, 10, 101).count() == 0


def test_explain_lists_the_files_of_the_page(spark, tmp_path, table):
    path = f"{tmp_path}/pages"
    store_pages(table, path, ["at", "v"], rows_per_file=100)
    df = read_page(spark, path, 100, 4)
    touched = [r for r in page_index(spark, path).collect() if r.first_row <= 400 and r.last_row >= 301]
    assert 1 <= len(touched) <= 3 and sorted(df.inputFiles()) == sorted(r.file for r in touched)
    assert f"InMemoryFileIndex({len(touched)} paths)" in plan_of(df)
    assert [r.row_num for r in df.orderBy("row_num").collect()] == list(range(301, 401))


def test_storing_again_replaces(spark, tmp_path, table):
    path = f"{tmp_path}/pages"
    with pytest.raises(FileNotFoundError):
        page_index(spark, path)
    store_pages(table, path, ["at"], rows_per_file=100)
    store_pages(table.limit(25), path, ["at"], rows_per_file=10)
    assert sum(read_page(spark, path, 10, k).count() for k in (1, 2, 3)) == 25
    store_pages(table.limit(0), path, ["at"])
    assert read_page(spark, path, 10, 1).count() == 0 and versions.read(spark, f"{path}/rows").count() == 0


def test_many_ranges_have_no_bound(spark, rows, table, monkeypatch):
    want = rows(range_row_number(table, ["at", "v"]))
    assert not hasattr(numbering, "MAX_RANGES")
    assert rows(range_row_number(table, ["at", "v"], rows_per_range=3)) == want
    # beyond the broadcast bound the small tables are shuffled
    monkeypatch.setattr(numbering, "MOST_BROADCAST", 0)
    assert rows(range_row_number(table, ["at", "v"], rows_per_range=20)) == want
    assert rows(range_row_number(table, ["at", "v"], rows_per_range=20, between=(400, 450))) == [r for r in want if 400 <= r[2] <= 450]


def test_bounds_are_not_constants_of_the_plan(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("k"))
    few, many = (len(plan_of(range_row_number(df, ["k"], rows_per_range=n))) for n in (500, 5))
    # a hundred times as many ranges: constants grow with their square root, times the steps to search them
    assert many < 30 * few


def test_many_files_take_few_tasks_and_a_long_page_reads_the_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbering, "MOST_TASKS", 8, raising=False)
    path = f"{tmp_path}/pages"
    table = spark.range(2000).select((F.col("id") * 37 % 2000).alias("at"))
    index = store_pages(table, path, ["at"], rows_per_file=20).orderBy("first_row").collect()
    assert len(index) >= 100 and all(r.last_row - r.first_row < 20 for r in index)
    assert index[0].first_row == 1 and index[-1].last_row == 2000
    assert all(a.last_row + 1 == b.first_row for a, b in zip(index, index[1:]))
    # one file name per task of the write, up to its number
    assert len({r.file.rpartition("/")[2].split("-")[1] for r in index}) <= 8
    whole = read_page(spark, path, 1 << 40, 1)
    assert sorted(r.row_num for r in whole.collect()) == list(range(1, 2001))
    assert "InMemoryFileIndex(1 paths)" in plan_of(whole)
    assert all(r.at + 1 == r.row_num for r in read_page(spark, path, 20, 3).collect())
