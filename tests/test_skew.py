import pytest
from pyspark.sql import functions as F

from millrace.operators import skew
from millrace.operators.skew import hot_hashes, hot_hashes_each, join_unique


@pytest.fixture()
def small():
    """Hot keys with so many tasks that a twentieth of the rows is hot."""
    return lambda df, on: hot_hashes(df, on, tasks=40)


def left_frame(spark, n=900):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 100)
    return spark.range(n).select("id", key.cast("int").alias("k"), (F.col("id") % 2).cast("string").alias("s"))


def right_frame(spark):
    return spark.range(0, 60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(spark, rows, small, how):
    left, right = left_frame(spark), right_frame(spark)
    hot = small(left, ["k"])
    assert 1 <= len(hot) <= 20
    got = join_unique(left, right, "k", how, hot)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_hot_and_null_keys_are_found(spark, small):
    left = left_frame(spark)
    hot = small(left, ["k"])
    hashed = left.select(skew._key_hash(left, ["k"]).alias("h"), "k").distinct().collect()
    assert {r.k for r in hashed if r.h in hot} == {7, None}


def test_composite_and_string_keys(spark, rows, small):
    left = left_frame(spark)
    right = right_frame(spark).crossJoin(spark.createDataFrame([("0",), ("1",)], "s string"))
    hot = small(left, ["k", "s"])
    assert hot
    assert rows(join_unique(left, right, ["k", "s"], "left", hot)) == rows(left.join(right, ["k", "s"], "left"))


def test_hot_rows_stay_out_of_the_shuffle(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = left_frame(spark), right_frame(spark)
        plan = join_unique(left, right, "k", "left", small(left, ["k"]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Union" in plan


def test_even_keys_take_the_plain_join(spark, small):
    left = spark.range(1000).select((F.col("id") % 500).alias("k"))
    assert small(left, ["k"]) == []


def test_types_that_cannot_be_hashed_alike(spark, rows):
    left = spark.range(100).select((F.col("id") % 5).cast("double").alias("k"))
    right = spark.range(5).select(F.col("id").cast("double").alias("k"), "id")
    assert hot_hashes(left, ["k"]) == []
    assert rows(join_unique(left, right, "k", "left")) == rows(left.join(right, "k", "left"))


def test_expand_counts_rows_not_keys(spark, small):
    df = spark.createDataFrame([(f"a {i}",) for i in range(100)], "t string")
    split = lambda d: d.select(F.explode(F.split("t", " ")).alias("t"))
    assert len(hot_hashes(df, ["t"], expand=split, tasks=40)) == 1


def test_several_key_sets_in_one_pass(spark):
    left = left_frame(spark)
    each = hot_hashes_each(left, [["k"], ["s"], ["id"]], tasks=40)
    assert [set(h) for h in each] == [set(hot_hashes(left, [k], tasks=40)) for k in ("k", "s", "id")]
    assert each[0] and each[1] and not each[2]


def test_sampling_makes_no_even_key_hot(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_SAMPLES", 100)
    df = spark.range(200_000).select((F.col("id") % 1000).alias("k"))
    assert hot_hashes(df, ["k"], tasks=200) == []
    third = df.withColumn("k", F.when(F.rand(3) < 0.33, 5).otherwise(F.col("k")))
    assert len(hot_hashes(third, ["k"], tasks=200)) == 1


def test_right_side_is_made_unique(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (3, "c", 0)], "k int, v string, n int")
    assert rows(join_unique(left, right, "k", "left")) == rows(
        spark.createDataFrame([(1, "b", 0), (1, "b", 0), (2, None, None)], "k int, v string, n int")
    )
    assert join_unique(left, right, "k", "left_semi").count() == 2


@pytest.mark.parametrize("hot", [[], None])
def test_a_side_of_many_rows_is_not_broadcast(spark, tmp_path, rows, hot, monkeypatch):
    """Its file is a few KB, so Spark takes it for small; what counts are its rows."""
    path = f"{tmp_path}/right"
    spark.range(50_000).select(F.col("id").alias("k"), F.lit("a long text that all rows share " * 4).alias("v")).write.parquet(path)
    right = spark.read.parquet(path)
    left = left_frame(spark)
    small = join_unique(left, right, "k", "left", hot, unique=True)
    monkeypatch.setattr(skew, "MOST_ROWS", 1000, raising=False)
    large = join_unique(left, right, "k", "left", hot, unique=True)
    if hot is not None:
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    assert rows(large) == rows(left.join(right, "k", "left"))
