"""Tables as versions of parts: a write shows at once or not at all, and what did not change stays where it is.

    <path>/files/<fresh folder>/__part=<part>/...   rows of one part, written once and never touched again
    <path>/versions/<label>.<number>                which folder holds each part of that version

A part is a bucket of key hashes, a value of a partition column or, in a table without either, everything. A write
goes to a fresh folder first; its version exists when its small file of parts gets its name, by one rename.
Readers take the last version, so a write that fails leaves the table as it was. A version names the folders of all
its parts, also of those it did not write, so a change costs the buckets it falls into and nothing else.

The file of a version has one line per part, ``MOST_BUCKETS`` at most for keyed tables; it is all the driver reads.
One writer at a time may work on a table.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace as changed
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import upsert_by_key, without_keys
from millrace.session import scratch_path

PART = "__part"
WHOLE = "all"
# buckets of a new keyed table, the size above which there get more of them, and the most a table has; beyond that
# buckets grow, each of them in as many files as it needs
BUCKETS = 8
BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 65_536
INVENTORY = "part string, folder string, bytes bigint"


@dataclass(frozen=True)
class Part:
    folder: str
    bytes: int


@dataclass(frozen=True)
class Version:
    """What a version file says. ``by`` is a partition column, ``keys`` and ``buckets`` are those of keyed tables;
    ``rows`` is known of tables that were written whole with a check."""

    schema: T.StructType
    keys: tuple[str, ...] = ()
    buckets: int = 0
    by: str | None = None
    rows: int | None = None
    parts: dict[str, Part] = field(default_factory=dict)

    def part_of(self) -> Column:
        """The part a row belongs to. Null keys and null values have parts like any other."""
        if self.by is not None:
            return F.col(self.by).cast("string")
        if self.buckets:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        return F.lit(WHOLE)

    @property
    def bytes(self) -> int:
        return sum(p.bytes for p in self.parts.values())

    def text(self) -> str:
        head = {"schema": self.schema.json(), "keys": list(self.keys), "buckets": self.buckets, "by": self.by, "rows": self.rows}
        lines = [{"part": k, "folder": p.folder, "bytes": p.bytes} for k, p in sorted(self.parts.items())]
        return "\n".join(json.dumps(line, ensure_ascii=False) for line in [head, *lines]) + "\n"

    @staticmethod
    def parse(text: str) -> Version:
        head, *lines = [json.loads(line) for line in text.splitlines()]
        schema = T.StructType.fromJson(json.loads(head["schema"]))
        parts = {line["part"]: Part(line["folder"], line["bytes"]) for line in lines}
        return Version(schema, tuple(head["keys"]), head["buckets"], head["by"], head["rows"], parts)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def versions(spark: SparkSession, path: str, on: str | None = None) -> list[str]:
    """Names of the versions up to label ``on``, oldest first; no table has none."""
    names = [n for n in _names(spark, f"{path}/versions") if not n.startswith((".", "_"))]
    names = [n for n in names if on is None or n.rpartition(".")[0] <= on]
    return sorted(names, key=lambda n: (n.rpartition(".")[0], int(n.rpartition(".")[2])))


def version(spark: SparkSession, path: str, on: str | None = None, name: str | None = None) -> Version | None:
    """The last version up to label ``on``, or the one with this name."""
    if name is None:
        names = versions(spark, path, on)
        if not names:
            return None
        name = names[-1]
    fs, target = _hadoop(spark, f"{path}/versions/{name}")
    stream = fs.open(target)
    try:
        return Version.parse(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, label: str, new: Version) -> str:
    """Make a version the last one of its label: the only step that readers notice."""
    same = [int(n.rpartition(".")[2]) for n in versions(spark, path) if n.rpartition(".")[0] == label]
    name = f"{label}.{max(same, default=0) + 1:04d}"
    fs, fresh = _hadoop(spark, f"{path}/versions/_{uuid.uuid4().hex}")
    stream = fs.create(fresh, False)
    stream.write(bytearray(new.text(), "utf-8"))
    stream.close()
    _, target = _hadoop(spark, f"{path}/versions/{name}")
    if fs.exists(target) or not fs.rename(fresh, target):
        raise RuntimeError(f"another writer has made version {name} of {path}")
    return name


def _part_folders(spark: SparkSession, folder: str) -> dict[str, str]:
    """Part and directory name of what a partitioned write has left in a folder."""
    names = [n for n in _names(spark, folder) if n.startswith(f"{PART}=")]
    return {unquote(n.removeprefix(f"{PART}=")): n for n in names}


def _write_parts(df: DataFrame, path: str, layout: Version, rows_per_file: int | None = None) -> dict[str, Part]:
    """Rows into a fresh folder, by part; returns the parts that got any."""
    spark, folder = df.sparkSession, uuid.uuid4().hex
    if rows_per_file is not None:
        # not by part: that would sort by it and lose the order of the rows
        name = f"{folder}/{PART}={WHOLE}"
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/files/{name}")
        fs, target = _hadoop(spark, f"{path}/files/{name}")
        return {WHOLE: Part(name, fs.getContentSummary(target).getLength())}
    rows = df.withColumn(PART, layout.part_of())
    if layout.by is not None or layout.buckets > 1:
        rows = rows.hint("rebalance", PART)
    rows.write.partitionBy(PART).parquet(f"{path}/files/{folder}")
    parts = {}
    for part, name in _part_folders(spark, f"{path}/files/{folder}").items():
        fs, target = _hadoop(spark, f"{path}/files/{folder}/{name}")
        parts[part] = Part(f"{folder}/{name}", fs.getContentSummary(target).getLength())
    return parts


def _read_parts(spark: SparkSession, path: str, held: Version, parts: Iterable[str]) -> DataFrame:
    folders = [f"{path}/files/{held.parts[p].folder}" for p in sorted(parts) if p in held.parts]
    if not folders:
        return spark.createDataFrame([], held.schema)
    return spark.read.schema(held.schema).parquet(*folders)


def _buckets_for(size: int, now: int) -> int:
    """Buckets of a table of this size: as many as there are until they hold twice what they should."""
    if size <= 2 * now * BUCKET_BYTES:
        return now
    return min(MOST_BUCKETS, max(now, 1 << math.ceil(math.log2(size / BUCKET_BYTES))))


def replace(
    df: DataFrame,
    path: str,
    label: str = "-",
    keys: Sequence[str] = (),
    buckets: int = BUCKETS,
    by: str | None = None,
    check: Callable[[int], None] | None = None,
    rows_per_file: int | None = None,
) -> str:
    """A new version that holds exactly ``df``; returns its name.

    With ``keys`` the table is dealt into ``buckets`` and takes ``apply_changes``; with ``by`` it has a part per
    value of that column. With ``rows_per_file``, for tables without either, every task writes its rows in their order into
    files of so many. ``check`` is given the number of rows before the version is made, and refuses by raising. A
    failure before the end leaves the last version as it is.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    layout = Version(schema, tuple(keys), buckets if keys and by is None else 0, by)
    if rows_per_file is not None and (keys or by is not None):
        raise ValueError("rows_per_file is for tables that are one part")
    new = changed(layout, parts=_write_parts(df, path, layout, rows_per_file))
    if check is not None:
        # from the footers of the new files
        new = changed(new, rows=_read_parts(df.sparkSession, path, new, new.parts).count())
        check(new.rows)
    return _switch(df.sparkSession, path, label, new)


def read(
    spark: SparkSession, path: str, on: str | None = None, parts: Iterable[str] | None = None
) -> DataFrame | None:
    """The table as of the last version up to label ``on``, or these parts of it; None where there is no version."""
    held = version(spark, path, on)
    return None if held is None else _read_parts(spark, path, held, held.parts if parts is None else parts)


def inventory(spark: SparkSession, path: str, on: str | None = None) -> DataFrame:
    """One row per part of the last version up to ``on``: part, folder, bytes. Reads the version's file only."""
    names = versions(spark, path, on)
    if not names:
        return spark.createDataFrame([], INVENTORY)
    return spark.read.schema(INVENTORY).json(f"{path}/versions/{names[-1]}").where(F.col("part").isNotNull())


def replace_parts(df: DataFrame, path: str, by: str, label: str = "-", parts: Sequence[str] = ()) -> str:
    """Replace the parts that ``df`` has rows of, and ``parts`` even if it has none; the others stay."""
    spark = df.sparkSession
    held = version(spark, path)
    if held is None:
        return replace(df, path, label, by=by)
    if held.by != by:
        raise ValueError(f"{path} is parted by {held.by}")
    new = _write_parts(_as(df, held.schema), path, held)
    kept = {k: p for k, p in held.parts.items() if k not in set(parts)}
    return _switch(spark, path, label, changed(held, rows=None, parts=kept | new))


def drop_parts(spark: SparkSession, path: str, parts: Iterable[str], label: str = "-") -> str:
    """A version without some parts; their files go with the versions that name them (``vacuum``)."""
    held = version(spark, path)
    gone = set(parts)
    left = {k: p for k, p in held.parts.items() if k not in gone}
    return _switch(spark, path, label, changed(held, rows=None, parts=left))


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a table, with its types: key hashes depend on them."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _landed_parts(df: DataFrame, layout: Version, name: str) -> tuple[DataFrame, set[str]]:
    """Rows landed by part in the scratch folder, and the parts they fall into, from the directories' names."""
    path = scratch_path(df.sparkSession, name)
    df.withColumn(PART, layout.part_of()).write.partitionBy(PART).parquet(path)
    folders = _part_folders(df.sparkSession, path)
    if not folders:
        return df.sparkSession.createDataFrame([], df.schema), set()
    paths = [f"{path}/{name}" for name in folders.values()]
    return df.sparkSession.read.schema(df.schema).parquet(*paths), set(folders)


def apply_changes(
    spark: SparkSession,
    path: str,
    changes: DataFrame | None = None,
    deletes: DataFrame | None = None,
    label: str = "-",
    on: str | None = None,
    keys: Sequence[str] | None = None,
    order_cols: Sequence[str] | None = None,
) -> int:
    """Upsert ``changes`` and drop the rows with the keys of ``deletes``; returns the number of parts rewritten.

    Only parts that a change or a deleted key falls into are read and written; without any there is no new
    version. The keys are the table's own; a table with a part per value of a column takes ``keys`` here, and that
    column must be one of them. A key that is deleted and changed is there afterwards. A table that has
    outgrown its buckets is dealt into more of them.
    """
    held = version(spark, path, on)
    keys = list(keys or held.keys)
    if not keys or (held.by is not None and held.by not in keys):
        raise ValueError("the part of a row must follow from its keys")
    layout = changed(held, buckets=_buckets_for(held.bytes, held.buckets)) if held.buckets else held
    new, touched = None, set()
    if changes is not None:
        new, touched = _landed_parts(_as(changes, held.schema), layout, "changes")
    gone, dropped = None, set()
    if deletes is not None:
        schema = T.StructType([f for f in held.schema.fields if f.name in keys])
        gone, dropped = _landed_parts(_as(deletes, schema).distinct(), layout, "deletes")
    touched |= {p for p in dropped if layout.buckets != held.buckets or p in held.parts}
    if not touched:
        return 0
    if layout.buckets != held.buckets:
        held = changed(layout, parts=held.parts)
        touched = set(map(str, range(layout.buckets)))
        rows = _read_parts(spark, path, held, held.parts)
        kept: dict[str, Part] = {}
    else:
        rows = _read_parts(spark, path, held, touched)
        kept = {k: p for k, p in held.parts.items() if k not in touched}
    if gone is not None:
        rows = without_keys(rows, gone, keys)
    if new is not None:
        rows = upsert_by_key(rows, new, keys, order_cols)
    written = _write_parts(rows, path, held)
    _switch(spark, path, label, changed(held, rows=None, parts=kept | written))
    return len(touched)


def vacuum(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Drop all but the last ``keep`` versions and the folders that no version names; returns the dropped names.

    Folders of failed writes go too, so no other writer may be at work.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    names = versions(spark, path)
    for name in names[:-keep]:
        fs, target = _hadoop(spark, f"{path}/versions/{name}")
        fs.delete(target, False)
    used = {p.folder for name in names[-keep:] for p in version(spark, path, name=name).parts.values()}
    whole = {f.split("/")[0] for f in used}
    for folder in _names(spark, f"{path}/files"):
        if folder not in whole:
            fs, target = _hadoop(spark, f"{path}/files/{folder}")
            fs.delete(target, True)
            continue
        for name in _part_folders(spark, f"{path}/files/{folder}").values():
            if f"{folder}/{name}" not in used:
                fs, target = _hadoop(spark, f"{path}/files/{folder}/{name}")
                fs.delete(target, True)
    return names[:-keep]
