"""The steps of the daily run on a folder of parquet layers.

A job takes its business date from the caller, reads the last finished state, writes a new one and then
records itself in the ledger; running it again gives the same tables. The only rows that reach the driver are the
readiness answer of one step, partition names and the bounded samples of the operators.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import decrypt_columns, strip_nul
from millrace.operators.address import mark_surrogate, resolve_new_addresses, retry_markers
from millrace.operators.conform import conform_union
from millrace.operators.ledger import readiness
from millrace.operators.merge import (
    changed_rows,
    check_load,
    clean_keys,
    daily_refresh,
    publish_delta,
    reverse_sync,
    source_deletes,
    split_by_parents,
    upsert_by_key,
    with_parents,
    without_keys,
)
from millrace.operators.skew import sized
from millrace.plans.catalog import (
    FEEDS,
    INSTITUTION_MAPPINGS,
    LOAD,
    PARTITION_STEP,
    PUBLISH,
    REFRESH,
    REVERSE_STEPS,
    SNAPSHOT_STEP,
    Feed,
    SourceTable,
)
from millrace.schemas import ADDRESS_MASTER, DAG_LOG, DEPENDENCY_MANAGER, PARTITION_MANAGER, PUBLIC_INSTITUTION
from millrace.session import land
from millrace.sinks import versions
from millrace.sinks.snapshots import drop_expired, drop_expired_days, keep_days_of, replace_day
from millrace.sinks.tables import path_exists, replace_table
from millrace.operators.numbering import ROWS_PER_RANGE
from millrace.sources.paging import read_page, store_pages
from millrace.sources.payloads import json_pages, strict_json_pages, xml_pages


class NotReady(Exception):
    """A step whose predecessors have not finished on the business date."""


@dataclass(frozen=True)
class Hub:
    """One business date of the data hub below ``root``; ``at`` is the completion time to record."""

    spark: SparkSession
    root: str
    run_date: date
    at: datetime
    keep_runs: int = 30

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def label(self) -> str:
        return self.run_date.isoformat()

    # raw layer: replaced every day; the copy before stays, to tell what the source has deleted

    def raw(self, table: str) -> DataFrame:
        """The last copy up to this business date."""
        found = versions.read(self.spark, self.path("lv0", table), self.label)
        if found is None:
            raise NotReady(f"{table} has not been loaded")
        return found

    def tombstones(self, table: str) -> DataFrame | None:
        """Raw keys that the source has deleted, with the date of the copy that lacked them first."""
        return versions.read(self.spark, self.path("lv0", f"{table}_deleted"))

    # other layers: a version per run, which shares with the one before what it did not change

    def table(self, layer: str, table: str) -> DataFrame | None:
        """The table as of this business date."""
        return versions.read(self.spark, self.path(layer, table), self.label)

    def write(self, layer: str, table: str, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        """A whole table; one with ``keys`` takes changes later (``publish``)."""
        versions.replace(df, self.path(layer, table), self.label, keys)
        return self._kept(layer, table)

    def _kept(self, layer: str, table: str) -> DataFrame:
        versions.vacuum(self.spark, self.path(layer, table), self.keep_runs)
        return self.table(layer, table)

    # address table: every run of an owner adds its new rows as one part

    def addresses(self, except_added: str | None = None) -> DataFrame:
        schema = T.StructType([*ADDRESS_MASTER.fields, T.StructField("added", T.StringType())])
        table = versions.read(self.spark, self.path("lv1", "address_master"))
        if table is None:
            return self.spark.createDataFrame([], schema)
        return table if except_added is None else table.where(F.col("added") != except_added)

    # ledger

    def ledger(self) -> DataFrame:
        path = self.path("control", "dag_log")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], DAG_LOG)
        return self.spark.read.schema(DAG_LOG).parquet(path)

    def finished(self) -> DataFrame:
        """The ledger's rows of the business date; no other date is listed."""
        path = self.path("control", "dag_log")
        day = f"{path}/completion_date={self.run_date.isoformat()}"
        if not path_exists(self.spark, day):
            return self.spark.createDataFrame([], DAG_LOG)
        return self.spark.read.schema(DAG_LOG).option("basePath", path).parquet(day)

    def complete(self, step: str) -> None:
        """Record a finished step. Its key is its directory, so writing it again replaces the row."""
        row = self.spark.range(1).select(F.lit(self.at).cast("timestamp_ntz").alias("completion_datetime"))
        key = f"completion_date={self.run_date.isoformat()}/dag_id={step}"
        replace_table(row.coalesce(1), f"{self.path('control', 'dag_log')}/{key}")

    def require(self, step: str) -> None:
        """Fail unless all predecessors of ``step`` have finished on the business date."""
        path = self.path("control", "dependency_manager")
        edges = self.spark.read.schema(DEPENDENCY_MANAGER).parquet(path).where(F.col("tobe_dag") == step)
        answer = readiness(edges, self.finished(), self.run_date, hot=[]).first()
        if answer is None or not answer.ready:
            raise NotReady(step)


def load_raw(
    hub: Hub,
    source: SourceTable,
    frame: DataFrame,
    key: Column | bytes | None = None,
    keys: Sequence[str] = (),
) -> None:
    """A source table into the raw layer, as the catalogue says: columns, decryption, NUL cleaning.

    With ``keys`` the copy is compared with the one of the business date before. Keys that are gone become tombstones
    of this date; a copy of less than half the rows is refused (``ShrunkLoad``) and the last one stays.
    """
    if source.columns is not None:
        frame = frame.select(*source.columns)
    if source.decrypt:
        if key is None:
            raise ValueError(f"{source.name} needs a key")
        frame = decrypt_columns(frame, dict(source.decrypt), key)
    if source.strip_nul:
        frame = strip_nul(frame)
    spark, path = hub.spark, hub.path("lv0", source.raw_name)
    before = (hub.run_date - timedelta(days=1)).isoformat()
    last = versions.version(spark, path, before) if keys else None
    rows_before = last.rows if last is not None else None
    versions.replace(frame, path, hub.label, check=lambda rows: check_load(rows, rows_before))
    if last is not None:
        gone = source_deletes(versions.read(spark, path, before), hub.raw(source.raw_name), keys)
        gone = gone.withColumn("deleted_on", F.lit(hub.label))
        versions.replace_parts(gone, f"{path}_deleted", "deleted_on", parts=[hub.label])
        versions.vacuum(spark, f"{path}_deleted", 1)
    versions.vacuum(spark, path, max(2, hub.keep_runs))
    hub.complete(source.step(LOAD))


def parse_feed(feed: Feed, payloads: DataFrame, rejects_to: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The rows of one feed, which must hold every page up to its end page, in all its categories."""
    payloads = payloads.where(F.col("feed") == feed.name)
    if feed.categories:
        payloads = payloads.where(F.col("category").isin(list(feed.categories)))
    if feed.path is None:
        return xml_pages(payloads, feed.columns, first_page=feed.first_page, rejects_to=rejects_to)
    parse = strict_json_pages if feed.strict else json_pages
    parts = max(1, len(feed.categories))
    return parse(
        payloads, feed.columns, feed.path, feed.status_path, first_page=feed.first_page, parts=parts, rejects_to=rejects_to
    )


def load_feed(hub: Hub, feed: Feed, payloads: DataFrame) -> None:
    """Landed pages of a public feed into the raw layer. Answers that are errors go to ``<feed>_rejects``, also when
    the feed then fails."""
    path = hub.path("lv0", feed.name)

    def keep(rejects: DataFrame) -> None:
        versions.replace(rejects, f"{path}_rejects", hub.label, check=lambda rows: None)
        versions.vacuum(hub.spark, f"{path}_rejects", hub.keep_runs)

    versions.replace(parse_feed(feed, payloads, keep), path, hub.label)
    versions.vacuum(hub.spark, path, hub.keep_runs)
    hub.complete(feed.step)


def store_raw_pages(hub: Hub, source: SourceTable) -> DataFrame:
    """Store the raw table in the order of the catalogue's page key; returns the index of its files.

    Files hold whole pages of the catalogue's size, so ``raw_page`` reads one file or, where keys tie, two.
    """
    if source.page_key is None:
        raise ValueError(f"{source.name} is read whole")
    rows_per_file = source.page_rows * max(1, ROWS_PER_RANGE // source.page_rows)
    path = hub.path("lv0", f"{source.raw_name}_pages")
    return store_pages(hub.raw(source.raw_name), path, [source.page_key], rows_per_file, hub.label)


def raw_page(hub: Hub, source: SourceTable, page_no: int) -> DataFrame:
    """One page, from 1, of a raw table that ``store_raw_pages`` has stored."""
    return read_page(hub.spark, hub.path("lv0", f"{source.raw_name}_pages"), source.page_rows, page_no)


def refresh(
    hub: Hub,
    source: SourceTable,
    schema: T.StructType,
    keys: Sequence[str],
    order_cols: Sequence[str],
    raw: DataFrame | None = None,
) -> DataFrame:
    """Raw to clean layer. ``raw`` replaces the raw table where another operator comes first
    (``code_master``, ``extend_contract``). Rows that the source has deleted go."""
    step = source.step(REFRESH)
    hub.require(step)
    rows = hub.raw(source.raw_name) if raw is None else raw
    gone = hub.tombstones(source.raw_name)
    clean = daily_refresh(rows, hub.table("lv1", source.clean_name), schema, keys, order_cols, tombstones=gone)
    clean = hub.write("lv1", source.clean_name, clean)
    hub.complete(step)
    return clean


def deleted_keys(hub: Hub, source: SourceTable, clean: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys that the source has deleted and the clean table no longer has."""
    gone = hub.tombstones(source.raw_name)
    if gone is None:
        return None
    return without_keys(clean_keys(gone, clean.schema, keys), clean, keys)


def conform_institutions(hub: Hub, step: str) -> DataFrame:
    """The five feeds as one institution table."""
    hub.require(step)
    parts = [
        (hub.raw(name), {"kind": F.lit(name), **mapping}) for name, mapping in INSTITUTION_MAPPINGS.items()
    ]
    union = conform_union(parts).withColumn("addr_seq", F.lit(None).cast("bigint"))
    table = hub.write("lv1", "public_institution", union.select(*PUBLIC_INSTITUTION.fieldNames()))
    hub.complete(step)
    return table


def resolve_addresses(
    hub: Hub, steps: Sequence[str], owners: Sequence[tuple[DataFrame, str]], dictionary: DataFrame
) -> DataFrame:
    """Look up the new addresses of the owner tables of ``steps`` in one go and add them to the address table."""
    for step in steps:
        hub.require(step)
    added = f"{hub.run_date.isoformat()}.{steps[0]}"
    known = hub.addresses(except_added=added).drop("added")
    # published rows refer to the numbers, so a rerun keeps what it has once given
    given = land(hub.addresses().where(F.col("added") == added).drop("added"), "given")
    new = land(resolve_new_addresses(owners, known, dictionary, hub.at, given=given), "new-addresses")
    left_over = given.join(sized(new.select("legacy_address"), new.count()), "legacy_address", "left_anti")
    new = new.unionByName(left_over.select(*new.columns))
    path = hub.path("lv1", "address_master")
    versions.replace_parts(new.withColumn("added", F.lit(added)), path, "added")
    versions.vacuum(hub.spark, path, hub.keep_runs)
    for step in steps:
        hub.complete(step)
    return hub.addresses()


def retry_addresses(hub: Hub, dictionary: DataFrame) -> DataFrame:
    """Look up the stored misses again; rewrites the parts where one is found now."""
    found = retry_markers(hub.addresses(), dictionary, hub.at)
    versions.apply_changes(hub.spark, hub.path("lv1", "address_master"), found, keys=["legacy_address", "added"])
    return hub.addresses()


def publish(
    hub: Hub,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    compare_cols: Sequence[str],
    parents: Sequence[tuple[DataFrame, str | Mapping[str, str]]] = (),
    deleted: DataFrame | None = None,
) -> DataFrame:
    """Bring a published table up to date: rows with published parents, changed rows only.

    Only the buckets that a changed row or one of the keys in ``deleted`` falls into are written; without a change
    nothing is. A table that was written without these keys is laid out by them first.
    """
    if parents:
        source = with_parents(land(source, "source"), parents)
    published = hub.table("hc", name)
    if published is None:
        return hub.write("hc", name, source, keys)
    spark, path = hub.spark, hub.path("hc", name)
    changes = changed_rows(publish_delta(source, published, keys, compare_cols))
    if versions.version(spark, path, hub.label).keys != tuple(keys):
        changes = land(changes, "changes")
        if deleted is not None:
            published = without_keys(published, deleted, keys)
        elif changes.isEmpty():
            return published
        return hub.write("hc", name, upsert_by_key(published, changes, keys), keys)
    if not versions.apply_changes(spark, path, changes, deleted, hub.label, hub.label):
        return published
    return hub._kept("hc", name)


def delete_orphans(
    hub: Hub, name: str, parents: Sequence[tuple[DataFrame, str | Mapping[str, str]]]
) -> DataFrame | None:
    """Drop published rows whose parents are gone. Without such rows nothing is written, with some only the buckets
    they are in; a table without keys is written whole."""
    table = hub.table("hc", name)
    if table is None:
        return None
    kept, orphans = split_by_parents(table, parents)
    held = versions.version(hub.spark, hub.path("hc", name), hub.label)
    if held.keys:
        deletes = orphans.select(*held.keys)
        if not versions.apply_changes(hub.spark, hub.path("hc", name), None, deletes, hub.label, hub.label):
            return table
        return hub._kept("hc", name)
    return table if orphans.isEmpty() else hub.write("hc", name, kept)


def snapshot_addresses(hub: Hub, keep_days: int | None = None) -> None:
    """Yesterday's copy of the address table; days past their retention go.

    The number of days is the retention table's for lv1.address_master_log; without a row there all days stay.
    ``keep_days`` stands in for it.
    """
    hub.require(SNAPSHOT_STEP)
    path = hub.path("lv1", "address_master_log")
    replace_day(hub.addresses().drop("added"), path, hub.run_date - timedelta(days=1))
    hub.complete(SNAPSHOT_STEP)
    if keep_days is None:
        keep_days = keep_days_of(hub.spark, hub.path("control", "partition_manager"), "lv1", "address_master_log")
    if keep_days is not None:
        drop_expired_days(hub.spark, path, hub.run_date, keep_days)
    versions.vacuum(hub.spark, path, 1)
    hub.complete(PARTITION_STEP)


def maintain_partitions(hub: Hub) -> dict[tuple[str, str], list[date]]:
    """Drop the expired days of every table in the retention table, each after its own number of days.

    A table is known by schema (layer) and name; unmanaged ones and those without a directory are left alone.
    Returns the days dropped by schema and table. The retention table has one row per table and is read whole.
    """
    managed = hub.spark.read.schema(PARTITION_MANAGER).parquet(hub.path("control", "partition_manager"))
    kept = managed.where("partition_tf").groupBy("schema_nm", "table_nm").agg(F.max("store_d_num").alias("days"))
    dropped = {}
    for row in kept.collect():
        path = hub.path(row.schema_nm, row.table_nm)
        if versions.versions(hub.spark, path):
            dropped[row.schema_nm, row.table_nm] = drop_expired_days(hub.spark, path, hub.run_date, row.days)
        elif path_exists(hub.spark, path):
            dropped[row.schema_nm, row.table_nm] = drop_expired(hub.spark, path, hub.run_date, row.days)
    hub.complete(PARTITION_STEP)
    return dropped


def sync_back(
    hub: Hub, target: str, published_name: str, clean_name: str, keys: Sequence[str], order_cols: Sequence[str]
) -> DataFrame:
    """Published rows back into the clean layer (``target`` is product or promotion)."""
    published, current = hub.table("hc", published_name), hub.table("lv1", clean_name)
    synced = published if current is None else reverse_sync(published, current, keys, order_cols)
    table = hub.write("lv1", clean_name, synced)
    hub.complete(REVERSE_STEPS[target])
    return table


@dataclass(frozen=True)
class Publication:
    """How a published table comes from its clean table; ``parents`` maps parent tables to join columns."""

    keys: Sequence[str]
    compare_cols: Sequence[str]
    parents: Mapping[str, str | Mapping[str, str]] = field(default_factory=dict)
    rows: Callable[[DataFrame], DataFrame] = lambda clean: clean


def _parent(hub: Hub, name: str) -> DataFrame:
    """A parent table: as published, or the clean one where none is published."""
    for layer in ("hc", "lv1"):
        table = hub.table(layer, name)
        if table is not None:
            return table
    raise NotReady(name)


def table_chain(
    hub: Hub,
    source: SourceTable,
    frame: DataFrame,
    schema: T.StructType | None = None,
    keys: Sequence[str] = (),
    order_cols: Sequence[str] = (),
    publications: Mapping[str, Publication] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    key: Column | bytes | None = None,
    full_copy: bool = False,
) -> dict[str, DataFrame]:
    """One business table from its source to the tables the catalogue says are published from it; returns these.

    On a day of the month without a run nothing is done. ``frame`` is read whole and in parallel, so the
    catalogue's page keys aren't needed here. A table without a clean one ends in the raw layer. ``derive``
    makes the rows to refresh from the raw ones (``code_master``, ``extend_contract``). Published tables are
    written in the catalogue's order, and a row of one needs its row in every parent that the catalogue
    names, so ``publications`` must say how to find these. With ``full_copy`` the frame is all the source has: rows of
    the copy before that it lacks are deleted, from the clean table and from tables published by the same keys.
    """
    if not source.runs_on(hub.run_date.day):
        return {}
    publications = dict(publications or {})
    if set(publications) != set(source.published):
        raise ValueError(f"{source.name} publishes {', '.join(source.published) or 'nothing'}")
    for name, made in publications.items():
        if set(made.parents) != set(source.parents) - {name}:
            raise ValueError(f"{name} needs the parents {', '.join(p for p in source.parents if p != name) or 'none'}")
    load_raw(hub, source, frame, key, keys if full_copy else ())
    if source.clean_name is None:
        return {}
    raw = hub.raw(source.raw_name)
    clean = refresh(hub, source, schema or raw.schema, keys, order_cols, raw if derive is None else derive(raw))
    if not source.published:
        return {}
    step = source.step(PUBLISH)
    hub.require(step)
    tables = {}
    for name in source.published:
        made = publications[name]
        parents = [(_parent(hub, p), on) for p, on in made.parents.items()]
        deleted = deleted_keys(hub, source, clean, keys) if tuple(made.keys) == tuple(keys) else None
        tables[name] = publish(hub, name, made.rows(clean), made.keys, made.compare_cols, parents, deleted)
    hub.complete(step)
    return tables


def institution_chain(hub: Hub, payloads: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Landed feed pages to the published institution table."""
    for feed in FEEDS.values():
        load_feed(hub, feed, payloads)
    institutions = conform_institutions(hub, "lv0_dag_DATAAPI.PUBLIC_INSTITUTION")
    known = resolve_addresses(
        hub, ["lv1ex_dag_DATAAPI.PUBLIC_INSTITUTION"], [(institutions, "addr")], dictionary
    )
    step = "lv1_dag_DATAAPI.PUBLIC_INSTITUTION"
    hub.require(step)
    marked = mark_surrogate(institutions.drop("addr_seq"), "addr", known, "legacy_address", "seq")
    # feeds may repeat a record; a published row is identified by what it says
    marked = marked.distinct().withColumn(
        "institution_id", F.sha2(F.to_json(F.struct("kind", "name", "addr", "tel", "lat", "lon")), 256)
    )
    published = publish(hub, "public_institution", marked, ["institution_id"], ["addr_seq"])
    hub.complete(step)
    return published


def customer_chain(
    hub: Hub,
    customers: SourceTable,
    frame: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    order_cols: Sequence[str],
    address_column: str,
    dictionary: DataFrame,
    children: Mapping[str, str | Mapping[str, str]],
    compare_cols: Sequence[str],
    keep_days: int | None = None,
    full_copy: bool = False,
) -> DataFrame:
    """The customer table from source to published accounts.

    Load, refresh, address resolution, removal of published rows without a customer, account publish,
    ledger, snapshot. ``children`` maps published child tables to their customer column. With ``full_copy`` the frame is
    all the source has: a customer of the copy before that it lacks leaves the clean table and the accounts, and its
    children go as orphans. Days of the snapshot stay as long as the retention table says, or ``keep_days``.
    """
    load_raw(hub, customers, frame, keys=keys if full_copy else ())
    clean = refresh(hub, customers, schema, keys, order_cols)
    resolve_addresses(hub, [customers.step("lv1ex_dag")], [(clean, address_column)], dictionary)
    step = customers.step("lv1_dag")
    hub.require(step)
    for child, on in children.items():
        delete_orphans(hub, child, [(clean, on)])
    known = hub.addresses()
    account = mark_surrogate(clean, address_column, known, "legacy_address", "seq")
    deleted = deleted_keys(hub, customers, clean, keys)
    published = publish(hub, customers.published[0], account, keys, [*compare_cols, "addr_seq"], deleted=deleted)
    hub.complete(step)
    snapshot_addresses(hub, keep_days)
    return published
