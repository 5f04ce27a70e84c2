import pytest
from pyspark.sql import functions as F

from millrace.sinks import versions


def folders(spark, path, name=None):
    held = versions.version(spark, path, name=name)
    return {k: p.folder for k, p in held.parts.items()}


def failing(df):
    """The same rows, but the write of the last one fails."""
    return df.withColumn("v", F.when(F.col("k") < 90, F.col("v")).otherwise(F.raise_error(F.lit("half way")).cast("string")))


def table(spark, *ks, v="a"):
    return spark.createDataFrame([(k, v) for k in ks], "k bigint, v string")


def test_a_failed_write_leaves_the_table(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    for kind in ({}, {"keys": ["k"]}, {"by": "v"}):
        where = f"{path}{len(kind)}{kind.get('by', '')}"
        versions.replace(table(spark, 1, 2), where, **kind)
        bad = failing(spark.range(100).select(F.col("id").alias("k"), F.lit("b").alias("v")))
        with pytest.raises(Exception, match="half way"):
            versions.replace(bad, where, **kind)
        assert rows(versions.read(spark, where)) == [(1, "a"), (2, "a")] and len(versions.versions(spark, where)) == 1
    with pytest.raises(Exception, match="half way"):
        versions.apply_changes(spark, f"{path}1", bad)
    with pytest.raises(Exception, match="half way"):
        versions.replace_parts(bad, f"{path}1v", "v")
    # what the failed writes left behind goes
    assert versions.vacuum(spark, f"{path}1", 1) == []
    assert len(versions._names(spark, f"{path}1/files")) == 1
    assert rows(versions.read(spark, f"{path}1v")) == [(1, "a"), (2, "a")]


def test_one_change_rewrites_one_bucket(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace(table(spark, *range(1000)), path, keys=["k"], buckets=16)
    before = folders(spark, path)
    assert len(before) == 16
    assert versions.apply_changes(spark, path, table(spark, 7, v="new")) == 1
    after = folders(spark, path)
    assert sum(before[k] != after[k] for k in before) == 1 and set(before) == set(after)
    assert rows(versions.read(spark, path).where("v = 'new'")) == [(7, "new")]
    assert versions.read(spark, path).count() == 1000
    # files of unchanged buckets are the same
    files = [set(versions._names(spark, f"{path}/files/{after[k]}")) for k in after if before[k] == after[k]]
    assert len(files) == 15 and all(files)
    # the older version is still whole
    old = versions.version(spark, path, name=versions.versions(spark, path)[0])
    assert versions._read_parts(spark, path, old, old.parts).where("v = 'a'").count() == 1000


def test_no_change_makes_no_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace(table(spark, 1, 2), path, keys=["k"], buckets=4)
    assert versions.apply_changes(spark, path, table(spark)) == 0
    assert versions.apply_changes(spark, path, None, table(spark)) == 0
    assert versions.apply_changes(spark, path) == 0
    assert len(versions.versions(spark, path)) == 1


def test_changes_and_deletes(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace(table(spark, 1, 2, 3, None), path, keys=["k"], buckets=4)
    # a plain int key hashes like the table's own type
    changes = spark.createDataFrame([(2, "n", "extra"), (9, "n", "extra")], "k int, v string, v2 string")
    deletes = spark.createDataFrame([(1,), (9,), (None,), (50,)], "k int")
    versions.apply_changes(spark, path, changes, deletes)
    assert rows(versions.read(spark, path)) == [(2, "n"), (3, "a"), (9, "n")]
    versions.apply_changes(spark, path, None, table(spark, 2, 3, 9))
    assert versions.read(spark, path).count() == 0 and folders(spark, path) == {}
    versions.apply_changes(spark, path, table(spark, 4))
    assert rows(versions.read(spark, path)) == [(4, "a")]


def test_outgrown_buckets_are_split(spark, rows, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    versions.replace(table(spark, *range(500)), path, keys=["k"], buckets=1)
    monkeypatch.setattr(versions, "BUCKET_BYTES", 300)
    versions.apply_changes(spark, path, table(spark, 3, v="n"), table(spark, 499))
    held = versions.version(spark, path)
    assert held.buckets >= 8 and len(held.parts) == held.buckets
    assert rows(versions.read(spark, path)) == sorted([(k, "n" if k == 3 else "a") for k in range(499)], key=lambda r: (True, str(r[0])))
    monkeypatch.setattr(versions, "MOST_BUCKETS", held.buckets)
    assert versions._buckets_for(10**9, held.buckets) == held.buckets


def test_parts_by_value(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    values = [(1, "x"), (2, "y/1=%"), (3, None), (4, "2024-01-05 03:00")]
    versions.replace(spark.createDataFrame(values, "k int, v string"), path, by="v")
    assert rows(versions.read(spark, path)) == values
    kept = folders(spark, path)["x"]
    versions.replace_parts(spark.createDataFrame([(7, "y/1=%"), (8, "z")], "k int, v string"), path, "v")
    assert rows(versions.read(spark, path), "k") == [(1,), (3,), (4,), (7,), (8,)] and folders(spark, path)["x"] == kept
    versions.replace_parts(spark.createDataFrame([], "k int, v string"), path, "v", parts=["x"])
    versions.drop_parts(spark, path, ["z", "not there"])
    assert rows(versions.read(spark, path), "k") == [(3,), (4,), (7,)]
    assert rows(versions.inventory(spark, path), "part") == [("2024-01-05 03:00",), ("__HIVE_DEFAULT_PARTITION__",), ("y/1=%",)]
    assert rows(versions.read(spark, path, parts=["y/1=%"])) == [(7, "y/1=%")]
    with pytest.raises(ValueError):
        versions.replace_parts(table(spark, 1), path, "k")
    with pytest.raises(ValueError):
        versions.apply_changes(spark, path, table(spark, 1), keys=["k"])


def test_versions_as_of_a_label(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert versions.read(spark, path) is None and versions.inventory(spark, path).count() == 0
    for label, n in (("2024-01-02", 2), ("2024-01-04", 4), ("2024-01-02", 3)):
        versions.replace(table(spark, *range(n)), path, label)
    assert versions.versions(spark, path) == ["2024-01-02.0001", "2024-01-02.0002", "2024-01-04.0001"]
    assert versions.read(spark, path, "2024-01-01") is None
    assert versions.read(spark, path, "2024-01-03").count() == 3
    assert versions.read(spark, path).count() == 4 
    assert versions.vacuum(spark, path, 1) == ["2024-01-02.0001", "2024-01-02.0002"]
    assert versions.read(spark, path).count() == 4 and len(versions._names(spark, f"{path}/files")) == 1
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, 0)


def test_empty_table_and_a_refused_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace(table(spark), path, keys=["k"])
    assert versions.read(spark, path).count() == 0 and versions.read(spark, path).columns == ["k", "v"]

    def refuse(n):
        raise ValueError(f"{n} rows")

    with pytest.raises(ValueError, match="2 rows"):
        versions.replace(table(spark, 1, 2), path, check=refuse)
    assert versions.read(spark, path).count() == 0
    versions.replace(table(spark, 1, 2), path, check=lambda n: None)
    assert versions.version(spark, path).rows == 2


def test_two_writers(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    versions.replace(table(spark, 1), path)
    monkeypatch.setattr(versions, "versions", lambda *a: [])
    with pytest.raises(RuntimeError, match="another writer"):
        versions.replace(table(spark, 2), path)
