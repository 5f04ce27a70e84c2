"""Keyed merges, change detection and parent checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import blank_to_null, strip_nul
from millrace.operators.skew import hot_hashes_each, join_unique
from millrace.session import land

# rows and key characters of missing parents that may be broadcast; more take joins that shuffle
FEW_MISSING = 200_000
FEW_CHARACTERS = 16 << 20


def newest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order_cols``, which should tell all rows of a key apart.

    Spark keeps one row per key in every map task before the shuffle (a window group limit), so a key with
    a large part of the rows sends only a few of them.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    ranked = df.withColumn("__rank", F.row_number().over(newest_first))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def same_key(keys: Sequence[str], prefix: str) -> Column:
    """Equal keys, where null is a key value like any other: the rule of all merges."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def upsert_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None
) -> DataFrame:
    """Insert new keys and replace known ones; of several updates of a key the newest counts.

    The result has the target's columns. Without ``order_cols`` the updates must be unique by key. Updates
    of small measured size are broadcast by the optimizer, and the target is then not shuffled.
    """
    newest = newest_per_key(updates, keys, order_cols) if order_cols else updates
    known = newest.select(*[F.col(k).alias(f"__new_{k}") for k in keys])
    kept = target.join(known, same_key(keys, "__new_"), "left_anti")
    incoming = newest.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in newest.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return kept.select(*target.columns).unionByName(incoming)


class ShrunkLoad(Exception):
    """A full copy that is far smaller than the last one, so what it lacks is no proof of deletion."""


def check_load(rows: int, before: int | None, least_share: float = 0.5) -> None:
    """Refuse a full copy with less than ``least_share`` of the last one's rows."""
    if before and rows < least_share * before:
        raise ShrunkLoad(f"{rows} rows after {before}")


def source_deletes(previous: DataFrame, copy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tombstones: the keys of the last full copy that the new one no longer has, once each.

    Null is a key value like any other. Only key columns are read and shuffled.
    """
    now = copy.select(*[F.col(k).alias(f"__now_{k}") for k in keys]).distinct()
    return previous.select(*keys).distinct().join(now, same_key(keys, "__now_"), "left_anti")


def without_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not in ``gone``; null is a key value like any other."""
    gone = gone.select(*[F.col(k).alias(f"__gone_{k}") for k in keys])
    return df.join(gone, same_key(keys, "__gone_"), "left_anti").select(*df.columns)


def to_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Cast to a fixed schema: missing columns become null, extra ones go.

    A value that does not fit fails the job, or becomes null with ``strict=False``.
    """

    def typed(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = F.col(field.name)
        return (column.cast(field.dataType) if strict else column.try_cast(field.dataType)).alias(field.name)

    return df.select(*[typed(f) for f in schema.fields])


def daily_refresh(
    raw: DataFrame,
    current: DataFrame | None,
    schema: T.StructType,
    keys: Sequence[str],
    order_cols: Sequence[str],
    strict: bool = True,
    tombstones: DataFrame | None = None,
) -> DataFrame:
    """Raw rows to the clean layer: clean text, cast, newest row per key, upsert into the current table.

    ``tombstones`` are raw keys that the source has deleted (``source_deletes``). They are cleaned like the rows, and
    the current table loses them, unless the raw rows have the key again.
    """
    clean = to_schema(blank_to_null(strip_nul(raw)), schema, strict)
    if current is None:
        return newest_per_key(clean, keys, order_cols)
    current = to_schema(current, schema)
    if tombstones is not None:
        current = without_keys(current, clean_keys(tombstones, schema, keys), keys)
    return upsert_by_key(current, clean, keys, order_cols)


def clean_keys(raw_keys: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Raw keys as the clean layer has them."""
    fields = T.StructType([f for f in schema.fields if f.name in keys])
    return to_schema(blank_to_null(strip_nul(raw_keys)), fields, strict=False).distinct()


def reverse_sync(
    published: DataFrame, current: DataFrame, keys: Sequence[str], order_cols: Sequence[str]
) -> DataFrame:
    """Copy published rows back into a clean table; of both sides the newest row of a key stays."""
    both = current.unionByName(published.select(*current.columns))
    return newest_per_key(both, keys, order_cols)


def publish_delta(
    source: DataFrame, published: DataFrame, keys: Sequence[str], compare_cols: Sequence[str]
) -> DataFrame:
    """Source rows with ``action``: insert, update or same. Both sides are unique by key."""
    old = published.select(
        *keys, F.lit(True).alias("__known"), *[F.col(c).alias(f"__old_{c}") for c in compare_cols]
    )
    unchanged = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__old_{c}")) for c in compare_cols], F.lit(True)
    )
    action = (
        F.when(F.col("__known").isNull(), F.lit("insert"))
        .when(unchanged, F.lit("same"))
        .otherwise(F.lit("update"))
    )
    old = old.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    joined = source.join(old, same_key(keys, "__key_"), "left").withColumn("action", action)
    return joined.select(*source.columns, "action")


def changed_rows(delta: DataFrame) -> DataFrame:
    """The rows of a delta that need a write."""
    return delta.where(F.col("action") != "same").drop("action")


def _parent_keys(parent: DataFrame, on: str | Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    pairs = {on: on} if isinstance(on, str) else dict(on)
    keys = parent.select(*[F.col(p).alias(c) for c, p in pairs.items()]).distinct()
    return keys, list(pairs)


def publish_children(
    child: DataFrame, parent: DataFrame, on: str | Mapping[str, str], hot: Sequence[int] | None = None
) -> DataFrame:
    """Children whose parent is there. ``on`` is a shared column or a map child column -> parent column.

    ``hot`` goes to ``join_unique``; who checks several parents finds the hot keys of all in one go.
    """
    keys, columns = _parent_keys(parent, on)
    return join_unique(child, keys, columns, "left_semi", hot, unique=True, most=parent.count()).select(*child.columns)


def delete_unmatched(
    child: DataFrame, parent: DataFrame, on: str | Mapping[str, str], hot: Sequence[int] | None = None
) -> DataFrame:
    """The published table without the rows whose parent is gone."""
    return publish_children(child, parent, on, hot)


def unmatched_rows(
    child: DataFrame, parent: DataFrame, on: str | Mapping[str, str], hot: Sequence[int] | None = None
) -> DataFrame:
    """The rows ``delete_unmatched`` leaves out."""
    keys, columns = _parent_keys(parent, on)
    return join_unique(child, keys, columns, "left_anti", hot, unique=True, most=parent.count()).select(*child.columns)


Parents = Sequence[tuple[DataFrame, str | Mapping[str, str]]]


def _pairs(on: str | Mapping[str, str]) -> dict[str, str]:
    return {on: on} if isinstance(on, str) else dict(on)


def _key_text(df: DataFrame, columns: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """Key columns as one text, the same for equal values; null where one of them is null."""
    texts = [F.col(c).cast(t).cast("string") for c, t in zip(columns, types)]
    return F.when(reduce(lambda a, b: a & b, [t.isNotNull() for t in texts]), F.to_json(F.array(*texts)))


def missing_parents(child: DataFrame, parents: Parents) -> DataFrame:
    """The keys in ``child`` that have no parent, for all parents at once: which (number of the parent), key.

    Keys of all parents are taken from a row together and made distinct before they are shuffled, so the child's
    other columns and its repeated keys stay where they are. Null keys are not listed: they never have a parent.
    """
    texts, tagged = [], None
    for number, (parent, on) in enumerate(parents):
        pairs = _pairs(on)
        types = [child.schema[c].dataType for c in pairs]
        texts.append(F.struct(F.lit(number).alias("which"), _key_text(child, list(pairs), types).alias("key")))
        keys = parent.select(F.lit(number).alias("which"), _key_text(parent, list(pairs.values()), types).alias("key"))
        tagged = keys if tagged is None else tagged.unionByName(keys)
    wanted = child.select(F.inline(F.array(*texts))).where(F.col("key").isNotNull()).distinct()
    return wanted.join(tagged.distinct(), ["which", "key"], "left_anti")


def split_by_parents(child: DataFrame, parents: Parents) -> tuple[DataFrame, DataFrame]:
    """Children that have all their parents, and those that lack one.

    The missing keys are found in one pass (``missing_parents``) and landed. While those of a parent are few, the child is
    filtered by a broadcast of them and not shuffled; many of them take one shuffled join, for which only the rows are
    left that have the parents before.
    """
    parents = list(parents)
    if not parents:
        return child, child.limit(0)
    missing = land(missing_parents(child, parents), "missing")
    got = missing.groupBy("which").agg(F.count("*").alias("n"), F.sum(F.length("key")).alias("size")).collect()
    count = {r.which: r.n for r in got}
    few = {n: count.get(n, 0) <= FEW_MISSING for n in range(len(parents))}
    few |= {r.which: few[r.which] and r.size <= FEW_CHARACTERS for r in got}
    names = [f"__key_{n}" for n in range(len(parents))]
    keyed = child
    for name, (_, on) in zip(names, parents):
        columns = list(_pairs(on))
        keyed = keyed.withColumn(name, _key_text(child, columns, [child.schema[c].dataType for c in columns]))
    # the child's own hot keys, found once; joins of joins would be run again to look for them
    shuffled = [n for n in range(len(parents)) if not few[n]]
    hot = dict(zip(shuffled, hot_hashes_each(keyed, [[names[n]] for n in shuffled]))) if shuffled else {}
    marked, kept, lacking = keyed, keyed, []
    # broadcasts first, then the parents that many rows lack: rows that lack one meet no other
    for number in sorted(few, key=lambda n: (not few[n], -count.get(n, 0))):
        key, gone = names[number], f"__gone_{number}"
        found = missing.where(F.col("which") == number).select(F.col("key").alias(key))
        flagged = found.withColumn(gone, F.lit(True))
        kept = kept.where(F.col(key).isNotNull())
        if few[number]:
            marked = marked.join(F.broadcast(flagged), key, "left")
            kept = kept.join(F.broadcast(found), key, "left_anti")
        else:
            marked = join_unique(marked, flagged, key, "left", hot[number], unique=True, most=count.get(number, 0))
            kept = join_unique(kept, found, key, "left_anti", hot[number], unique=True, most=count.get(number, 0))
        kept = kept.drop(key)
        lacking.append(F.col(gone).isNotNull() | F.col(key).isNull())
    lacks = reduce(lambda a, b: a | b, lacking)
    return kept.select(*child.columns), marked.where(lacks).select(*child.columns)


def with_parents(child: DataFrame, parents: Parents) -> DataFrame:
    """Children that have all their parents."""
    return split_by_parents(child, parents)[0]
