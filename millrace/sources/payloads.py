"""Landed JSON and XML pages of public feeds.

A payload table has one row per fetched page: feed, category, page_no, payload. The rows of a page come out
with a fixed list of columns. A page without rows is the end of a feed and gives none. A page may have been asked
for several times: an unreadable answer counts as an error, and the rows come from the newest good answer
(by ``attempt``, where payloads have that column). No page is lost: a page without a good answer fails the
job, and so do ``max_bad`` errors in one feed. Given ``first_page``, so does a feed without every page from there
to its end page. Pages are parsed once, into the shared folder, a record a row: readers take thousands of rows at a time,
which whole pages are too large for. A payload may be binary; what isn't UTF-8 is unreadable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import blank_to_null
from millrace.session import PAGES_BYTES, land

MAX_BAD = 3


class UnreadablePages(Exception):
    """A page without a good answer, or too many errors in one feed."""


class MissingPages(Exception):
    """A feed that doesn't hold every page from its first to its end page."""


_BAD = "__bad"
_ITEMS = "__items"
# a record and its place in its answer, null for an answer without any
_RECORD = "__record"
_PLACE = "__place"


def _nest(tree: dict, path: str, leaf: T.DataType) -> None:
    *parents, last = path.split(".")
    for part in parents:
        tree = tree.setdefault(part, {})
    tree[last] = leaf


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(k, _struct(v) if isinstance(v, dict) else v) for k, v in tree.items()]
    )


def _string_record(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _text(payloads: DataFrame) -> Column:
    payload = F.col("payload")
    if isinstance(payloads.schema["payload"].dataType, T.BinaryType):
        return F.try_validate_utf8(payload.cast("string"))
    return payload


def _parsed_json(
    payloads: DataFrame, items_type: T.DataType, path: str, status_path: str | None, ok: str, end: str
) -> DataFrame:
    tree: dict = {}
    _nest(tree, path, items_type)
    if status_path is not None:
        _nest(tree, status_path, T.StringType())
    body = payloads.withColumn("__body", F.from_json(_text(payloads), _struct(tree)))
    items = F.col(f"__body.{path}")
    if status_path is None:
        bad, rows = items.isNull(), items
    else:
        status = F.col(f"__body.{status_path}")
        at_end = F.coalesce(status == end, F.lit(False))
        good = F.coalesce(status == ok, F.lit(False)) & items.isNotNull()
        bad, rows = ~(at_end | good), F.when(good, items)
    return body.select(*payloads.columns, rows.alias(_ITEMS), bad.alias(_BAD))


def _parsed_xml(payloads: DataFrame, record_schema: T.StructType) -> DataFrame:
    item = T.StructType([T.StructField("item", T.ArrayType(record_schema))])
    schema = T.StructType([T.StructField("body", T.StructType([T.StructField("items", item)]))])
    body = payloads.withColumn("__body", F.from_xml(_text(payloads), schema.simpleString()))
    return body.select(
        *payloads.columns,
        F.col("__body.body.items.item").alias(_ITEMS),
        # the end of a feed has an empty element of items; an error answer has none
        (F.col("__body.body").isNull() | (F.col("__body.body.items").isNull() & ~_text(payloads).rlike(r"<items\s*/?>"))).alias(_BAD),
    )


Rejects = Callable[[DataFrame], None]


def _guarded(
    parsed: DataFrame,
    max_bad: int,
    keep: Sequence[str],
    first_page: int | None = None,
    parts: int = 1,
    rejects_to: Rejects | None = None,
) -> DataFrame:
    """The records of every page's newest good answer; fail where a page has none, or a feed has too many errors or gaps.

    What reaches the driver is one row of counts. ``rejects_to`` gets the bad answers as they came, from the same parse
    and before anything fails; good ones are not kept as text.
    """
    feed = _feed_columns(parsed)
    page = [*feed, *[c for c in ("page_no",) if c in parsed.columns]]
    if first_page is not None and "page_no" not in page:
        raise ValueError("first_page needs payloads with page_no")
    attempt = [c for c in ("attempt",) if c in parsed.columns and "page_no" in page]
    carried = list(dict.fromkeys([*page, *attempt, *_kept(parsed, keep)]))
    records = F.posexplode_outer(_ITEMS).alias(_PLACE, _RECORD)
    if rejects_to is None:
        parsed = land(parsed.select(*carried, _BAD, records), "pages")
    else:
        came = [c for c in parsed.columns if c not in (*carried, "payload", _ITEMS, _BAD)]
        reason = F.when(F.col(_BAD), F.struct(*came, "payload")).alias("__came")
        parsed = land(parsed.select(*carried, _ITEMS, _BAD, reason).select(*carried, _BAD, "__came", records), "pages", PAGES_BYTES)
        rejects_to(parsed.where(_BAD).select(*carried, "__came.*"))
        parsed = parsed.drop("__came")

    order = F.col("attempt") if attempt else F.lit(0)
    has_rows = F.col(_PLACE).isNotNull()
    # an answer counts once, by its first row
    pages = parsed.where(F.coalesce(_PLACE, F.lit(0)) == 0).groupBy(*page).agg(
        F.count_if(_BAD).alias("bad"),
        F.count_if(~F.col(_BAD)).alias("good"),
        F.max_by(has_rows, F.when(~F.col(_BAD), F.coalesce(order, F.lit(-1)))).alias("has_rows"),
    )
    number = F.col("page_no") if "page_no" in page else F.lit(0)
    end = F.min(F.when(~F.col("has_rows"), number))
    whole = (F.min(number) == F.lit(first_page)) & (F.max(number) - F.min(number) + 1 == F.count("*"))
    whole = whole & (F.coalesce(F.max(F.when(F.col("has_rows"), number)) < end, end.isNotNull()))
    feeds = pages.groupBy(*feed).agg(
        F.sum("bad").alias("bad"),
        F.count_if(F.col("good") == 0).alias("lost"),
        F.coalesce(whole, F.lit(False)).alias("whole"),
    )
    counts = feeds.agg(
        F.coalesce(F.max("bad"), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("lost"), F.lit(0)).alias("lost"),
        F.count_if("whole").alias("whole"),
        F.count("*").alias("feeds"),
    ).first()
    if counts.bad >= max_bad:
        raise UnreadablePages(f"{counts.bad} unreadable pages in one feed")
    if counts.lost:
        raise UnreadablePages(f"{counts.lost} pages without a good answer")
    if first_page is not None and counts.whole < max(counts.feeds, parts):
        raise MissingPages(f"{max(counts.feeds, parts) - counts.whole} feeds without every page up to an end page")
    good = parsed.where(~F.col(_BAD))
    if attempt:
        newest = F.rank().over(Window.partitionBy(*page).orderBy(F.desc("attempt")))
        good = good.withColumn("__newest", newest).where("__newest = 1").drop("__newest")
    return good.where(has_rows)


def _kept(payloads: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in keep if c in payloads.columns]


def _carried(payloads: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in _kept(payloads, keep)]


def _feed_columns(payloads: DataFrame) -> list[str]:
    return [c for c in ("feed", "category") if c in payloads.columns]


def json_pages(
    payloads: DataFrame,
    columns: Sequence[str] | T.StructType,
    path: str,
    status_path: str | None = None,
    ok: str = "00",
    end: str = "03",
    max_bad: int = MAX_BAD,
    keep: Sequence[str] = (),
    first_page: int | None = None,
    parts: int = 1,
    rejects_to: Rejects | None = None,
) -> DataFrame:
    """Rows of the array at ``path`` of every page, as received (text, unless a schema is given).

    A missing key becomes null and an extra key is dropped. With ``status_path`` a page counts only when its
    code is ``ok``; ``end`` marks the last page and any other code is an error. ``keep`` names payload
    columns (feed, category, page_no) to carry along. With ``first_page`` every feed and category must hold
    all pages from there to one without rows, and there must be ``parts`` of them at least. ``rejects_to`` is
    called with the answers that are errors, out of the same parse.
    """
    record = columns if isinstance(columns, T.StructType) else _string_record(columns)
    parsed = _parsed_json(payloads, T.ArrayType(record), path, status_path, ok, end)
    parsed = _guarded(parsed, max_bad, keep, first_page, parts, rejects_to)
    return parsed.select(*_carried(payloads, keep), f"{_RECORD}.*")


def strict_json_pages(
    payloads: DataFrame,
    required: Sequence[str],
    path: str,
    status_path: str | None = None,
    ok: str = "00",
    end: str = "03",
    max_bad: int = MAX_BAD,
    keep: Sequence[str] = (),
    first_page: int | None = None,
    parts: int = 1,
    rejects_to: Rejects | None = None,
) -> DataFrame:
    """Like ``json_pages``, but a record without one of the ``required`` keys fails the job."""
    items = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    parsed = _parsed_json(payloads, items, path, status_path, ok, end)
    parsed = _guarded(parsed, max_bad, keep, first_page, parts, rejects_to)
    return strict_columns(parsed.select(*_carried(payloads, keep), _RECORD), _RECORD, required)


def strict_columns(records: DataFrame, map_column: str, required: Sequence[str]) -> DataFrame:
    """Turn the ``required`` keys of a map column into columns; a row without one of them fails the job."""
    missing = F.array_except(F.lit(list(required)), F.map_keys(map_column))
    message = F.concat(F.lit("missing keys: "), F.array_join(missing, ", "))
    checked = F.when(F.size(missing) > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    others = [c for c in records.columns if c != map_column]
    return records.where(checked).select(*others, *[F.col(map_column)[k].alias(k) for k in required])


def xml_pages(
    payloads: DataFrame,
    columns: Sequence[str] | T.StructType,
    max_bad: int = MAX_BAD,
    keep: Sequence[str] = (),
    first_page: int | None = None,
    parts: int = 1,
    rejects_to: Rejects | None = None,
) -> DataFrame:
    """Rows of response/body/items/item of every page; one item or many, empty elements are null."""
    record = columns if isinstance(columns, T.StructType) else _string_record(columns)
    parsed = _guarded(_parsed_xml(payloads, record), max_bad, keep, first_page, parts, rejects_to)
    rows = parsed.select(*_carried(payloads, keep), f"{_RECORD}.*")
    return blank_to_null(rows, record.fieldNames())


def rejected_json_pages(
    payloads: DataFrame, path: str, status_path: str | None = None, ok: str = "00", end: str = "03"
) -> DataFrame:
    """The payload rows that ``json_pages`` counts as errors."""
    parsed = _parsed_json(payloads, T.ArrayType(T.StructType([])), path, status_path, ok, end)
    return parsed.where(F.col(_BAD)).select(*payloads.columns)


def rejected_xml_pages(payloads: DataFrame) -> DataFrame:
    """The payload rows that ``xml_pages`` counts as errors."""
    anything = T.StructType([T.StructField("any", T.StringType())])
    return _parsed_xml(payloads, anything).where(F.col(_BAD)).select(*payloads.columns)
