from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge
from millrace.operators.merge import ShrunkLoad, missing_parents, publish_children, source_deletes, split_by_parents, with_parents
from millrace.plans.catalog import LOAD, PUBLISH, REFRESH, SNAPSHOT_STEP, TABLES
from millrace.plans.jobs import Hub, Publication, delete_orphans, load_feed, load_raw, publish, raw_page, snapshot_addresses, store_raw_pages, table_chain
from millrace.plans.catalog import FEEDS
from millrace.schemas import DEPENDENCY_MANAGER, PARTITION_MANAGER, PAYLOADS
from millrace.sinks import versions
from millrace.sinks.snapshots import drop_expired_days, partition_days, read_snapshots, replace_day
from millrace.sinks.tables import merge_partitions, replace_table
from millrace.sources.payloads import UnreadablePages


def hub_on(spark, tmp_path, day):
    return Hub(spark, f"{tmp_path}/hub", date(2024, 1, day), datetime(2024, 1, day, 3))


def edges(hub, *pairs):
    replace_table(hub.spark.createDataFrame(pairs, DEPENDENCY_MANAGER), hub.path("control", "dependency_manager"))


def test_source_deletes(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, None), (1, "a")], "k int, v string")
    now = spark.createDataFrame([(2, "z"), (9, "b")], "k int, v string")
    assert rows(source_deletes(before, now, ["k"])) == [(None,), (1,), (4,)]
    assert rows(source_deletes(before, before, ["k", "v"])) == []
    assert rows(source_deletes(before, now, ["v"])) == [(None,), ("a",), ("c",)]


def test_deletes_reach_the_published_tables(spark, tmp_path, rows):
    visit = TABLES["R_EXHIBITION_VISIT_HISTORY"]
    made = {
        "exhibition_visit_customer": Publication(["cust"], [], rows=lambda c: c.where("cust IS NOT NULL").select("cust").distinct()),
        "exhibition_visit_history": Publication(["no"], ["at"], {"exhibition_visit_customer": "cust"}),
    }
    frames = {
        5: [(1, "kim", 1), (2, "lee", 1), (3, "lee", 1)],
        6: [(1, "kim", 1), (3, "lee", 2)],
        7: [(1, "kim", 1), (2, "lee", 7), (3, "lee", 2)],
        8: [(1, "kim", 1)],
    }
    for day in (5, 6, 6, 7):  # a rerun deletes nothing more, and a key that comes back is there again
        hub = hub_on(spark, tmp_path, day)
        edges(hub, (visit.step(LOAD), visit.step(REFRESH)), (visit.step(REFRESH), visit.step(PUBLISH)))
        frame = spark.createDataFrame(frames[day], "no int, cust string, at int")
        tables = table_chain(hub, visit, frame, frame.schema, ["no"], ["at"], made, full_copy=True)
        want = [(n, a) for n, _, a in frames[day]]
        assert rows(tables["exhibition_visit_history"], "no", "at") == want
        assert rows(hub.table("lv1", visit.clean_name), "no", "at") == want
    assert rows(hub.tombstones(visit.raw_name)) == [(2, "2024-01-06")]
    late = hub_on(spark, tmp_path, 8)
    with pytest.raises(ShrunkLoad):
        load_raw(late, visit, spark.createDataFrame(frames[8], frame.schema), keys=["no"])
    # the refused copy is not the raw table
    assert late.raw(visit.raw_name).count() == 3


def test_orphans_in_steady_state(spark, tmp_path, rows):
    hub = hub_on(spark, tmp_path, 5)
    children = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 100).alias("p"))
    publish(hub, "child", children, ["k"], ["p"])
    before = versions.version(spark, hub.path("hc", "child")).parts
    parents = spark.range(100).where("id <> 42").select(F.col("id").alias("key"))
    left = delete_orphans(hub, "child", [(parents, {"p": "key"})])
    assert left.count() == 198 and left.where("p = 42").count() == 0
    after = versions.version(spark, hub.path("hc", "child")).parts
    assert 1 <= sum(before[k] != after.get(k) for k in before) <= 2


@pytest.mark.parametrize("few", [200_000, 0])
def test_several_parents(spark, rows, monkeypatch, few):
    monkeypatch.setattr(merge, "FEW_MISSING", few)
    child = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "a"), (4, None, "a"), (5, 1, None), (1, 1, "a")], "k int, p int, q string")
    one = spark.createDataFrame([(1,), (None,)], "id bigint")
    two = spark.createDataFrame([("a", 1), ("a", 2)], "q string, other int")
    parents = [(one, {"p": "id"}), (two, "q")]
    kept, lacking = split_by_parents(child, parents)
    assert rows(kept) == [(1, 1, "a"), (1, 1, "a")] and lacking.count() == 4
    assert rows(with_parents(child, parents)) == rows(publish_children(publish_children(child, one, {"p": "id"}), two, "q"))
    assert rows(with_parents(child, [(one.join(two), {"p": "id", "q": "q"})])) == [(1, 1, "a"), (1, 1, "a")]
    assert rows(with_parents(child, [])) == rows(child)
    assert with_parents(child.limit(0), parents).count() == 0


def test_three_parents_take_one_shuffle_of_the_keys(spark):
    child = spark.range(3000).select("id", *[(F.col("id") % n).alias(f"k{n}") for n in (3, 5, 7)], F.lit("wide" * 20).alias("wide"))
    parents = [(spark.range(n - 1).select(F.col("id").alias("x")), {f"k{n}": "x"}) for n in (3, 5, 7)]
    found = missing_parents(child, parents)
    assert sorted((r.which, r.key) for r in found.collect()) == [(0, '["2"]'), (1, '["4"]'), (2, '["6"]')]
    assert "wide" not in found._jdf.queryExecution().optimizedPlan().toString()
    # the child itself meets broadcasts only
    plan = with_parents(child, parents)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_retention_of_the_snapshot(spark, tmp_path, rows):
    path = f"{tmp_path}/hub/lv1/address_master_log"
    for day in (1, 2, 3):
        replace_day(spark.range(day), path, date(2024, 1, day))
    replace_day(spark.range(0), path, date(2024, 1, 3))
    assert rows(partition_days(spark, path), "logging_date") == [(date(2024, 1, 1),), (date(2024, 1, 2),)]
    assert rows(read_snapshots(spark, path).groupBy("logging_dt").count()) == [(20240101, 1), (20240102, 2)]
    assert drop_expired_days(spark, path, date(2024, 1, 5), 3) == []
    hub = hub_on(spark, tmp_path, 5)
    edges(hub, ("a", SNAPSHOT_STEP))
    hub.complete("a")
    snapshot_addresses(hub)  # not managed: all days stay
    assert partition_days(spark, path).count() == 2
    rules = [("lv1", "address_master_log", 2, True), ("hc", "address_master_log", 0, True), ("lv1", "other", 0, True)]
    replace_table(spark.createDataFrame(rules, PARTITION_MANAGER), hub.path("control", "partition_manager"))
    snapshot_addresses(hub)
    assert rows(partition_days(spark, path), "logging_date") == [(date(2024, 1, 2),)]


def test_rejects_are_kept_when_the_feed_fails(spark, tmp_path, rows):
    hub, feed = hub_on(spark, tmp_path, 5), FEEDS["care_center"]
    pages = [("care_center", None, 1, "broken"), ("care_center", None, 2, '{"data":[]}'), ("other", None, 1, "broken too")]
    with pytest.raises(UnreadablePages):
        load_feed(hub, feed, spark.createDataFrame(pages, PAYLOADS))
    rejects = versions.read(spark, hub.path("lv0", "care_center_rejects"))
    assert rows(rejects, "feed", "page_no", "payload") == [("care_center", 1, "broken")]
    assert versions.version(spark, hub.path("lv0", "care_center_rejects")).rows == 1
    assert hub.ledger().count() == 0
    good = [("care_center", None, 1, '{"data":[{"주소":"x"}]}'), pages[1]]
    load_feed(hub, feed, spark.createDataFrame(good, PAYLOADS))
    assert versions.read(spark, hub.path("lv0", "care_center_rejects")).count() == 0 and hub.raw("care_center").count() == 1


def test_raw_pages_by_the_catalogues_key(spark, tmp_path):
    paged = next(t for t in TABLES.values() if t.page_key and not t.columns and not t.decrypt)
    hub = hub_on(spark, tmp_path, 5)
    load_raw(hub, paged, spark.range(30).select((F.col("id") % 4).cast("string").alias(paged.page_key), F.col("id").alias("v")))
    assert store_raw_pages(hub, paged).count() == 1
    assert raw_page(hub, paged, 1).count() == 30 and raw_page(hub, paged, 2).count() == 0
    with pytest.raises(ValueError):
        store_raw_pages(hub, TABLES["B_MINOR"])


def test_merge_failure_leaves_the_partitions(spark, rows, tmp_path):
    path = f"{tmp_path}/ledger"
    first = spark.createDataFrame([("a", 1, None), ("b", 2, date(2024, 1, 2))], "k string, v int, d date")
    merge_partitions(spark, path, first, ["k", "d"], "d")
    bad = first.withColumn("v", F.when(F.col("k") == "a", 9).otherwise(F.raise_error(F.lit("half way")).cast("int")))
    with pytest.raises(Exception, match="half way"):
        merge_partitions(spark, path, bad, ["k", "d"], "d")
    assert rows(spark.read.schema(first.schema).parquet(path), "k", "v") == [("a", 1), ("b", 2)]
    merge_partitions(spark, path, first.where("d IS NULL").withColumn("v", F.lit(5)), ["k", "d"], "d")
    assert rows(spark.read.schema(first.schema).parquet(path), "k", "v") == [("a", 5), ("b", 2)]
    merge_partitions(spark, f"{path}2", first.limit(0), ["k", "d"], "d")
    assert spark.read.schema(first.schema).parquet(f"{path}2").count() == 0


def test_replace_failure_leaves_the_table(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="half way"):
        replace_table(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("half way")).cast("bigint")).alias("id")), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]


def test_hot_keys_of_all_parents_are_found_on_the_child(spark, rows, monkeypatch):
    """Many missing keys: the joins before are not run again to look for the hot keys of the next one."""
    from millrace.operators import merge, skew

    asked = []
    found = skew.hot_hashes
    monkeypatch.setattr(skew, "hot_hashes", lambda *args, **kw: asked.append(args) or found(*args, **kw))
    monkeypatch.setattr(merge, "FEW_MISSING", 2)
    number = F.col("id")
    child = spark.range(600).select(
        number.alias("id"),
        F.when(number % 7 != 0, number % 50).alias("a"),
        (number % 30).alias("b"),
        F.when(number % 3 == 0, 1).otherwise(number % 20).alias("c"),
    )
    child = child.unionByName(child.limit(40))
    parents = [(spark.range(0, 50, 2).toDF("a"), "a"), (spark.range(1, 30).toDF("p"), {"b": "p"}), (spark.range(1, 9).toDF("c"), "c")]
    kept, orphans = merge.split_by_parents(child, parents)
    good = "coalesce(a % 2 = 0 AND b > 0 AND c BETWEEN 1 AND 8, false)"
    assert rows(kept) == rows(child.where(good)) and rows(orphans) == rows(child.where(f"NOT {good}"))
    assert asked == []
