from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import (
    changed_rows,
    daily_refresh,
    delete_unmatched,
    newest_per_key,
    publish_children,
    publish_delta,
    reverse_sync,
    unmatched_rows,
    upsert_by_key,
)

SCHEMA = "k int, v string, n int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    target=st.dictionaries(st.integers(0, 8), st.text("abc", max_size=2), max_size=8),
    updates=st.lists(st.tuples(st.integers(0, 12), st.text("xyz", max_size=2)), max_size=12),
)
def test_upsert_is_a_dictionary_update(spark, target, updates):
    current = frame(spark, [(k, v, 0) for k, v in target.items()])
    incoming = frame(spark, [(k, v, i) for i, (k, v) in enumerate(updates)])
    once = upsert_by_key(current, incoming, ["k"], ["n"])
    twice = upsert_by_key(once, incoming, ["k"], ["n"])
    expected = {**target, **dict(updates)}
    for result in (once, twice):
        assert sorted((r.k, r.v) for r in result.collect()) == sorted(expected.items())


def test_upsert_keeps_target_columns(spark, rows):
    target = spark.createDataFrame([(1, "a", 1.5)], "k int, v string, extra double")
    got = upsert_by_key(target, spark.createDataFrame([("b", 2, 7)], "v string, k bigint, other int"), ["k"])
    assert got.dtypes == target.dtypes
    assert rows(got) == [(1, "a", 1.5), (2, "b", None)]


def test_hot_key_is_reduced_before_the_shuffle(spark, rows):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    newest = newest_per_key(df, ["k"], ["id"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert dict(r for r in rows(newest))[1] == 897


def test_daily_refresh(spark, rows):
    schema = T.StructType(
        [T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("at", T.TimestampNTZType())]
    )
    raw = spark.createDataFrame(
        [("1", "\x00a", "2024-01-01 00:00:00", "x"), ("1", "", "2024-01-02 00:00:00", "x"), ("2", "b", None, "x")],
        "k string, v string, at string, extra string",
    )
    first = daily_refresh(raw, None, schema, ["k"], ["at"])
    assert rows(first) == [(1, None, datetime(2024, 1, 2)), (2, "b", None)]
    current = first.unionByName(spark.createDataFrame([(3, "old", None)], schema))
    assert rows(daily_refresh(raw, current, schema, ["k"], ["at"]), "k") == [(1,), (2,), (3,)]


def test_values_that_do_not_fit(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    raw = spark.createDataFrame([("x",)], "k string")
    with pytest.raises(Exception):
        daily_refresh(raw, None, schema, ["k"], ["k"]).collect()
    assert daily_refresh(raw, None, schema, ["k"], ["k"], strict=False).first().k is None


def test_delta_and_apply(spark, rows):
    source = frame(spark, [(1, "a", 1), (2, "b", 2), (3, None, 3), (4, None, 4), (5, "e", 5)])
    published = frame(spark, [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, None, 4), (9, "gone", 9)])
    delta = publish_delta(source, published, ["k"], ["v", "n"])
    assert rows(delta, "k", "action") == [(1, "same"), (2, "update"), (3, "update"), (4, "same"), (5, "insert")]
    after = upsert_by_key(published, changed_rows(delta), ["k"])
    assert rows(after, "k", "v") == [(1, "a"), (2, "b"), (3, None), (4, None), (5, "e"), (9, "gone")]
    assert changed_rows(publish_delta(source, after, ["k"], ["v", "n"])).count() == 0


def test_children(spark, rows):
    child = frame(spark, [(1, "p", 1), (1, "p", 1), (2, "q", 2), (3, None, None)])
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    on = {"n": "id"}
    assert rows(publish_children(child, parent, on)) == [(1, "p", 1), (1, "p", 1)]
    assert rows(delete_unmatched(child, parent, on)) == [(1, "p", 1), (1, "p", 1)]
    assert rows(unmatched_rows(child, parent, on), "k") == [(2,), (3,)]
    assert publish_children(child, parent, on).columns == child.columns


def test_reverse_sync_takes_the_newest(spark, rows):
    current = frame(spark, [(1, "old", 1), (2, "newer", 9)])
    published = frame(spark, [(1, "new", 2), (2, "older", 3), (3, "only", 1)])
    assert rows(reverse_sync(published, current, ["k"], ["n"]), "k", "v") == [(1, "new"), (2, "newer"), (3, "only")]


def test_null_keys_are_one_key(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    raw = spark.createDataFrame([(None, 1), ("a", 2)], schema)
    current = None
    for _ in range(3):
        current = daily_refresh(raw, current, schema, ["k"], ["v"])
    assert current.count() == 2
    assert {r.action for r in publish_delta(raw, raw, ["k"], ["v"]).collect()} == {"same"}
