from datetime import date, datetime

from millrace.operators.conform import code_master, conform_union, extend_contract
from millrace.operators.ledger import readiness, record_completion
from millrace.operators.retention import expired_of_managed, expired_partitions, partition_plan
from millrace.schemas import DAG_LOG, DEPENDENCY_MANAGER, PARTITION_MANAGER
from millrace.sinks.snapshots import drop_expired, list_partitions, read_snapshots, write_snapshot
from pyspark.sql import functions as F

DAY = date(2024, 1, 5)


def ledger(spark, *entries):
    return spark.createDataFrame([(s, d, datetime(d.year, d.month, d.day, 1)) for s, d in entries], DAG_LOG)


def ready(spark, edges, log, targets=None):
    edges = spark.createDataFrame(edges, DEPENDENCY_MANAGER)
    return {r.tobe_dag: (r.target_cnt, r.check_cnt, r.ready) for r in readiness(edges, log, DAY, targets).collect()}


def test_readiness(spark):
    log = ledger(spark, ("a", DAY), ("b", DAY), ("c", date(2024, 1, 4)))
    edges = [("a", "x"), ("b", "x"), ("a", "y"), ("c", "y"), ("a", "z"), ("a", "z"), ("c", "w")]
    targets = spark.createDataFrame([("x",), ("lone",)], "tobe_dag string")
    got = ready(spark, edges, log)
    assert got == {"x": (2, 2, True), "y": (2, 1, False), "z": (2, 2, True), "w": (1, 0, False)}
    assert ready(spark, edges, log, targets) == {"x": (2, 2, True), "lone": (0, 0, False)}


def test_double_log_entry_counts_once(spark):
    log = ledger(spark, ("a", DAY), ("a", DAY))
    assert ready(spark, [("a", "x"), ("b", "x")], log) == {"x": (2, 1, False)}


def test_completion_twice_is_one_row(spark, rows):
    log = ledger(spark, ("a", DAY), ("b", DAY))
    again = record_completion(log, "a", DAY, datetime(2024, 1, 5, 9))
    assert rows(again) == [("a", DAY, datetime(2024, 1, 5, 9)), ("b", DAY, datetime(2024, 1, 5, 1))]
    assert record_completion(again, "a", date(2024, 1, 6), datetime(2024, 1, 6)).count() == 3


def managed(spark, *tables):
    return spark.createDataFrame([("lv1", t, n, tf) for t, n, tf in tables], PARTITION_MANAGER)


def test_partition_plan(spark):
    got = partition_plan(managed(spark, ("t", 0, True), ("u", 10, True), ("off", 3, False)), date(2024, 3, 1)).collect()
    t = sorted(r.suffix for r in got if r.table_nm == "t")
    assert t == ["20240301", "20240302", "20240303", "20240304", "20240305", "20240306", "20240307"]
    u = sorted((r.from_date, r.to_date) for r in got if r.table_nm == "u")
    assert len(u) == 17 and u[0][0] == date(2024, 2, 20)
    assert (date(2024, 2, 29), date(2024, 3, 1)) in u
    assert len(got) == 24


def test_expired(spark, rows):
    names = spark.createDataFrame([(n,) for n in ("t_20231231", "t_20231230", "t_20240101", "t_x", "t_99999999", "tt_20000101")], "n string")
    assert rows(expired_partitions(names, "n", date(2024, 1, 11), 10)) == [("t_20231230", "20231230"), ("tt_20000101", "20000101")]
    tables = managed(spark, ("t", 10, True), ("tt", 5, False))
    tables = tables.unionByName(spark.createDataFrame([("lv2", "t", 1000, True)], PARTITION_MANAGER))
    both = names.crossJoin(spark.createDataFrame([("lv1",), ("lv2",), ("lv3",)], "schema_nm string"))
    assert rows(expired_of_managed(both, "n", tables, date(2024, 1, 11))) == [("lv1", "t", "t_20231230", "20231230")]


def test_snapshots(spark, rows, tmp_path):
    path = f"{tmp_path}/log"
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)):
        write_snapshot(spark.range(3), path, day)
    write_snapshot(spark.range(1), path, date(2024, 1, 2))
    write_snapshot(spark.range(0), path, date(2024, 1, 3))
    assert rows(read_snapshots(spark, path), "logging_dt", "id") == [(20240101, 0), (20240101, 1), (20240101, 2), (20240102, 0)]
    assert read_snapshots(spark, path).schema["logging_dt"].dataType.simpleString() == "int"
    assert drop_expired(spark, path, date(2024, 1, 4), 1) == [date(2024, 1, 1)]
    assert list_partitions(spark, path) == [date(2024, 1, 2), date(2024, 1, 3)]
    assert drop_expired(spark, path, date(2024, 1, 4), 1) == []
    spark.range(1).write.parquet(f"{path}/logging_dt=__HIVE_DEFAULT_PARTITION__")
    assert list_partitions(spark, path) == [date(2024, 1, 2), date(2024, 1, 3)]


def test_conforming(spark, rows):
    major = spark.createDataFrame([(1, "one"), (2, "two")], "cd int, major string")
    minor = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "cd int, minor string")
    assert rows(code_master(major, minor, "cd"), "cd", "major", "minor") == [(1, "one", "a"), (1, "one", "b")]
    assert rows(extend_contract(major, minor, "cd", ["minor"]), "cd", "minor") == [(1, "b"), (2, None)]
    union = conform_union([(major, {"k": F.lit("m"), "n": "major"}), (minor, {"k": F.lit("s"), "extra": "minor"})])
    assert rows(union, "k", "n", "extra") == sorted(
        [("m", "one", None), ("m", "two", None), ("s", None, "a"), ("s", None, "b"), ("s", None, "c")],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )
