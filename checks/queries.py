"""Every operator as a query on the test tables. Each function takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleaning import blank_to_null, decrypt_columns, fixed_columns, strip_nul
from millrace.functions.dates import kst_date, zone_time
from millrace.operators.address import (
    geocoder_answers,
    longest_prefix,
    mark_surrogate,
    negative_markers,
    resolve_new_addresses,
    retry_markers,
    unit_extract,
    unresolved_keys,
)
from millrace.operators.conform import code_master, conform_union, extend_contract
from millrace.operators.ledger import readiness
from millrace.operators.merge import (
    changed_rows,
    daily_refresh,
    delete_unmatched,
    publish_children,
    publish_delta,
    reverse_sync,
    unmatched_rows,
    upsert_by_key,
    with_parents,
)
from millrace.operators.numbering import range_row_number
from millrace.operators.retention import expired_of_managed, expired_partitions, partition_plan
from millrace.schemas import ADDRESS_MASTER
from millrace.session import land, scratch_path
from millrace.sinks import versions
from millrace.sinks.snapshots import drop_expired, partition_days, read_snapshots, replace_days, write_dated, write_snapshot
from millrace.sinks.tables import append_pages, merge_partitions, replace_table
from millrace.sources.paging import page_assignment, page_of, page_plan, paged_scan, read_page, store_pages
from millrace.sources.payloads import json_pages, rejected_json_pages, strict_json_pages, xml_pages
from millrace.sources.tables import category_scan, category_union, column_scan, full_scan, read_table, row_count

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _path(sf_dir: str, table: str) -> str:
    return f"{sf_dir}/{table}.parquet"


def _table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return full_scan(spark, _path(sf_dir, table))


# sources and sinks


@query("full_scan")
def full_scan_replace(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = _table(spark, sf_dir, "orders")
    replace_table(orders, path)
    return full_scan(spark, path, orders.schema)


@query("replace_after_failure")
def replace_after_failure_orders(spark, sf_dir):
    """A second write fails half way; readers still have the first one."""
    path = scratch_path(spark, "orders")
    orders = _table(spark, sf_dir, "orders")
    versions.replace(orders, path)
    half = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    broken = orders.withColumn("o_orderpriority", half.otherwise(F.raise_error(F.lit("half way")).cast("string")))
    try:
        versions.replace(broken, path)
    except Exception as error:  # Spark wraps what a task raises
        if "half way" not in str(error):
            raise
    else:
        raise AssertionError("the write should have failed")
    return versions.read(spark, path)


@query("column_scan")
def column_scan_orders(spark, sf_dir):
    return column_scan(spark, _path(sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderdate"])


@query("read_table")
def read_table_condition(spark, sf_dir):
    return read_table(
        spark,
        _path(sf_dir, "lineitem"),
        ["l_orderkey", "l_partkey", "l_quantity"],
        "l_returnflag = 'R' AND l_quantity >= 25",
    )


@query("row_count")
def row_count_lineitem(spark, sf_dir):
    return row_count(_table(spark, sf_dir, "lineitem"))


ORDER_KEYS = ["o_orderdate", "o_orderkey"]


@query("paged_scan")
def paged_scan_orders(spark, sf_dir):
    """The third page of the stored table; only the files it lies in are read."""
    path = scratch_path(spark, "orders-pages")
    store_pages(_table(spark, sf_dir, "orders"), path, ORDER_KEYS, 2000)
    return read_page(spark, path, 1000, 3)


@query("paged_scan_once")
def paged_scan_orders_once(spark, sf_dir):
    """The same page without a stored table, over ranges of 1,500 rows."""
    return paged_scan(_table(spark, sf_dir, "orders"), ORDER_KEYS, 1000, 3, rows_per_range=1500)


@query("page_index")
def page_index_orders(spark, sf_dir):
    """The files of the stored table follow each other without a gap: rows before, in and after each."""
    path = scratch_path(spark, "orders-pages")
    index = store_pages(_table(spark, sf_dir, "orders"), path, ORDER_KEYS, 2000)
    rows = index.agg(
        F.min("first_row").alias("first_row"),
        F.max("last_row").alias("last_row"),
        F.sum(F.col("last_row") - F.col("first_row") + 1).alias("n_rows"),
    )
    return rows.withColumn("n_stored", F.lit(read_page(spark, path, 1 << 40, 1).count()).cast("bigint"))


@query("page_assignment")
def page_assignment_orders(spark, sf_dir):
    pages = page_assignment(_table(spark, sf_dir, "orders"), ORDER_KEYS, 1000)
    return pages.select("o_orderkey", "row_num", "page_no")


@query("range_row_number")
def range_row_number_lineitem(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    numbered = range_row_number(_table(spark, sf_dir, "lineitem"), keys)
    return numbered.select(*keys, "row_num")


@query("range_row_number_ranges")
def range_row_number_small_ranges(spark, sf_dir):
    """The same numbers through many small ranges."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    numbered = range_row_number(_table(spark, sf_dir, "lineitem"), keys, rows_per_range=1000)
    return numbered.select(*keys, "row_num")


@query("page_plan")
def page_plan_orders(spark, sf_dir):
    return page_plan(_table(spark, sf_dir, "orders"), 1000)


@query("append_pages")
def append_pages_events(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    path = scratch_path(spark, "events")
    days = [date(2024, 1, 11), date(2024, 1, 21)]
    day = F.to_date("ts")
    batches = [day < days[0], (day >= days[0]) & (day < days[1]), (day >= days[1]) | day.isNull()]
    append_pages((events.where(batch) for batch in batches), path)
    return full_scan(spark, path, events.schema)


def _pages(df: DataFrame, order_cols: Sequence[str], page_size: int, record: Column) -> DataFrame:
    """Pack rows into pages of ``page_size`` records: columns page_no, records."""
    numbered = range_row_number(df, order_cols)
    return (
        numbered.select(page_of("row_num", page_size).cast("int").alias("page_no"), record.alias("record"))
        .groupBy("page_no")
        .agg(F.collect_list("record").alias("records"))
    )


def _event_pages(spark, sf_dir) -> DataFrame:
    record = F.struct("event_id", "user_id", "event_type", F.col("value").alias("extra_key"))
    return _pages(_table(spark, sf_dir, "events"), ["event_id"], 500, record)


def _with_end_page(pages: DataFrame, payload: Column, end: Column) -> DataFrame:
    """The landed payload pages and the closing page of a feed."""
    landed = land(pages.select("page_no", payload.alias("payload")), "payloads")
    last = landed.agg((F.coalesce(F.max("page_no"), F.lit(0)) + 1).alias("page_no"))
    return landed.unionByName(last.select("page_no", end.alias("payload")))


EVENT_RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("missing_key", T.StringType()),
    ]
)


@query("json_pages")
def json_pages_events(spark, sf_dir):
    payload = F.to_json(F.struct(F.col("records").alias("data")))
    payloads = _with_end_page(_event_pages(spark, sf_dir), payload, F.lit('{"data":[]}'))
    return json_pages(payloads, EVENT_RECORD, "data")


@query("feed_retries")
def feed_retries_events(spark, sf_dir):
    """Ten pages to a feed and a closing one; the fourth and the eighth page came back broken at first."""
    whole = F.to_json(F.struct(F.col("records").alias("data")))
    pages = _event_pages(spark, sf_dir).select(
        F.concat(F.lit("events_"), F.floor((F.col("page_no") - 1) / 10).cast("string")).alias("feed"),
        ((F.col("page_no") - 1) % 10).alias("page_no"),
        whole.alias("payload"),
    )
    pages = land(pages, "payloads")
    broken = pages.where("page_no IN (3, 7)").withColumn("payload", F.expr("left(payload, length(payload) - 9)"))
    last = pages.groupBy("feed").agg((F.max("page_no") + 1).alias("page_no")).withColumn("payload", F.lit('{"data":[]}'))
    answers = broken.withColumn("attempt", F.lit(1)).unionByName(pages.unionByName(last).withColumn("attempt", F.lit(2)))
    return json_pages(answers, EVENT_RECORD, "data", first_page=0)


def _status_payload(code: Column) -> Column:
    body = F.struct(
        F.struct(code.alias("resultCode")).alias("header"), F.struct(F.col("records").alias("items")).alias("body")
    )
    return F.to_json(F.struct(body.alias("response")))


STATUS_END = '{"response":{"header":{"resultCode":"03"}}}'
STATUS_ARGS = ("response.body.items", "response.header.resultCode")


@query("json_pages_status")
def json_pages_status(spark, sf_dir):
    payloads = _with_end_page(_event_pages(spark, sf_dir), _status_payload(F.lit("00")), F.lit(STATUS_END))
    return json_pages(payloads, EVENT_RECORD, *STATUS_ARGS, keep=["page_no"])


@query("strict_columns")
def strict_json_pages_events(spark, sf_dir):
    payloads = _with_end_page(_event_pages(spark, sf_dir), _status_payload(F.lit("00")), F.lit(STATUS_END))
    return strict_json_pages(payloads, ["event_id", "event_type"], *STATUS_ARGS)


@query("rejected_pages")
def rejected_pages_events(spark, sf_dir):
    # a page that holds an error event at its first place came back broken
    first_type = F.col("records")[0]["event_type"]
    whole = _status_payload(F.when(first_type == "view", "22").otherwise("00"))
    payload = F.when(first_type == "error", F.substring(whole, 1, 40)).otherwise(whole)
    payloads = _with_end_page(_event_pages_sorted(spark, sf_dir), payload, F.lit(STATUS_END))
    return rejected_json_pages(payloads, *STATUS_ARGS).select("page_no")


@query("feed_rejects")
def feed_rejects_events(spark, sf_dir):
    """Every page that came back broken at first is in the reject table, with the rows that a later answer gave."""
    pages = _event_pages_sorted(spark, sf_dir).select("page_no", "records")
    first_type = F.col("records")[0]["event_type"]
    whole = _status_payload(F.lit("00"))
    first = F.when(first_type == "error", F.substring(whole, 1, 40)).when(first_type == "view", _status_payload(F.lit("22")))
    answers = pages.select("page_no", F.inline(F.array(
        F.struct(F.lit(1).alias("attempt"), F.coalesce(first, whole).alias("payload")),
        F.struct(F.lit(2).alias("attempt"), whole.alias("payload")),
    )))
    path = scratch_path(spark, "rejects")
    rows = json_pages(
        land(answers, "payloads"), ["event_id"], *STATUS_ARGS, max_bad=1 << 40, keep=["page_no"],
        rejects_to=lambda rejects: versions.replace(rejects, path),
    )
    rejects = versions.read(spark, path).select("page_no", "attempt", F.length("payload").alias("n_chars"))
    return rejects.join(rows.groupBy("page_no").agg(F.count("*").alias("n_rows")), "page_no").select(
        "page_no", "attempt", (F.col("n_chars") == 40).alias("is_cut"), "n_rows"
    )


def _event_pages_sorted(spark, sf_dir) -> DataFrame:
    record = F.struct("event_id", "user_id", "event_type")
    pages = _pages(_table(spark, sf_dir, "events"), ["event_id"], 100, record)
    return pages.withColumn("records", F.sort_array("records"))


@query("xml_pages")
def xml_pages_part(spark, sf_dir):
    part = _table(spark, sf_dir, "part").withColumn("p_type", F.when(F.col("p_size") > 40, "").otherwise(F.col("p_type")))
    pages = _pages(part, ["p_partkey"], 500, F.struct("p_partkey", "p_name", "p_brand", "p_type"))
    items = F.struct(F.col("records").alias("item"))
    payload = F.to_xml(F.struct(F.struct(items.alias("items")).alias("body")), {"rowTag": "response"})
    end = F.lit("<response><body><items/></body></response>")
    return xml_pages(_with_end_page(pages, payload, end), ["p_partkey", "p_name", "p_brand", "p_type", "p_extra"])


@query("category_union")
def category_union_events(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    frames = {c: events.where(F.col("event_type") == c) for c in ("click", "view")}
    return category_union(frames, "category")


@query("category_scan")
def category_scan_events(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    return category_scan(events, "event_type", ["click", "view", "signup"])


# cleaning


@query("strip_nul")
def strip_nul_customer(spark, sf_dir):
    dirty = F.concat(F.lit("\x00"), "c_name", F.lit("\x00"), "c_mktsegment", F.lit("\x00"))
    return strip_nul(_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", dirty.alias("label")))


@query("blank_to_null")
def blank_to_null_part(spark, sf_dir):
    brand = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand"))
    return blank_to_null(_table(spark, sf_dir, "part").select("p_partkey", brand.alias("p_brand")))


@query("fixed_columns")
def fixed_columns_events(spark, sf_dir):
    return fixed_columns(_table(spark, sf_dir, "events"), ["event_id", "event_type", "no_such_key"])


CIPHER_KEY = b"0123456789abcdef"


def _cipher(column: str) -> Column:
    return F.base64(F.aes_encrypt(F.col(column), F.lit(bytearray(CIPHER_KEY))))


@query("decrypt_columns")
def decrypt_columns_customer(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", _cipher("c_name").alias("tel"), _cipher("c_mktsegment").alias("hand")
    )
    return decrypt_columns(customer, {"tel": "dec_tel", "hand": "dec_hand"}, CIPHER_KEY).drop("tel", "hand")


@query("decrypt_columns_try")
def decrypt_columns_lenient(spark, sf_dir):
    broken = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("AAAA"), _cipher("c_name"))).otherwise(_cipher("c_name"))
    customer = _table(spark, sf_dir, "customer").select("c_custkey", broken.alias("tel"))
    return decrypt_columns(customer, {"tel": "dec_tel"}, CIPHER_KEY, strict=False).drop("tel")


@query("kst_date")
def kst_date_events(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        "event_id", kst_date("ts").alias("kst_date"), zone_time("ts").alias("kst_time")
    )


# addresses


@query("unit_extract")
def unit_extract_part(spark, sf_dir):
    with_unit = F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"), F.lit("동 "), F.col("p_partkey").cast("string"), F.lit("호"))
    part = _table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 4 == 0, F.col("p_name")).otherwise(with_unit).alias("addr"),
        F.when(F.col("p_retailprice") < 950, "").otherwise(F.col("p_brand")).alias("building_name"),
    )
    return unit_extract(part, "addr", "building_name").select("p_partkey", "building_dong", "building_ho")


@query("unresolved_keys")
def unresolved_keys_customer(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_totalprice > 300000")
    return unresolved_keys(_table(spark, sf_dir, "customer"), "c_custkey", orders, "o_custkey")


@query("unresolved_keys_text")
def unresolved_keys_lineitem(spark, sf_dir):
    known = _table(spark, sf_dir, "part").where("p_size > 10").withColumnRenamed("p_name", "known_name")
    named = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    address = F.when(F.col("p_size") == 1, "").otherwise(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    owner = named.select(address.alias("legacy_addr"))
    known = known.select(F.concat_ws(" ", "known_name", "p_type", "p_brand").alias("legacy_address"))
    return unresolved_keys(owner, "legacy_addr", known, "legacy_address")


def _part_addresses(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("legacy_address")
    )


def _part_dictionary(spark, sf_dir) -> DataFrame:
    """Whole names, names with type, and first words; one row per keyword."""
    part = _table(spark, sf_dir, "part")
    named = part.where("p_retailprice >= 950").select(F.concat_ws(" ", "p_name", "p_type").alias("keyword"))
    first = part.where("p_size <= 3").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("keyword"))
    return named.unionByName(first).groupBy("keyword").agg(F.count("*").alias("total_count"))


@query("longest_prefix")
def longest_prefix_part(spark, sf_dir):
    return longest_prefix(
        _part_addresses(spark, sf_dir), "legacy_address", _part_dictionary(spark, sf_dir), "keyword"
    )


@query("longest_prefix_repeated")
def longest_prefix_lineitem(spark, sf_dir):
    """Every line with the address of its part: most addresses are repeated many times."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    owner = land(lines.join(_part_addresses(spark, sf_dir), "p_partkey"), "owner")
    return longest_prefix(owner, "legacy_address", _part_dictionary(spark, sf_dir), "keyword")


@query("negative_markers")
def negative_markers_part(spark, sf_dir):
    part = _table(spark, sf_dir, "part").where("p_size > 30")
    dictionary = part.select(F.concat_ws(" ", "p_name", "p_type").alias("keyword")).distinct()
    matched = longest_prefix(_part_addresses(spark, sf_dir), "legacy_address", dictionary, "keyword")
    return negative_markers(matched, "legacy_address", "keyword", keep=["p_partkey"])


def _unit_addresses(spark, sf_dir) -> DataFrame:
    unit = F.concat(F.col("p_size").cast("string"), F.lit("동"))
    flat = F.concat(F.col("p_partkey").cast("string"), F.lit("호"))
    address = F.concat_ws(" ", "p_name", "p_type", unit, flat)
    return _table(spark, sf_dir, "part").select("*", address.alias("legacy_address"))


def _geocoder(spark, sf_dir) -> DataFrame:
    """Answers per name and type: road form, lot form or neither, by the smallest size."""

    def text(*parts):
        return F.concat(*parts)

    groups = (
        _table(spark, sf_dir, "part")
        .groupBy("p_name", "p_type")
        .agg(F.count("*").alias("n"), F.min("p_size").alias("s"), F.min("p_brand").alias("b"))
    )
    name, kind = F.col("p_name"), F.col("p_type")
    road = F.struct(
        text(F.lit("road "), name).alias("address_name"),
        F.when(F.col("b") == "Brand#1", "").otherwise(F.col("b")).alias("building_name"),
        kind.alias("region_1depth_name"),
        F.lit("").alias("region_2depth_name"),
        F.col("b").alias("region_3depth_name"),
        F.col("s").cast("string").alias("x"),
        F.lit("37.5").alias("y"),
        F.lit("04524").alias("zone_no"),
    )
    lot = F.struct(
        text(F.lit("lot "), name).alias("address_name"),
        kind.alias("region_1depth_name"),
        F.col("b").alias("region_2depth_name"),
        F.lit("").alias("region_3depth_name"),
        F.lit("h").alias("region_3depth_h_name"),
        F.col("s").cast("string").alias("x"),
        F.lit("").alias("y"),
    )
    return groups.select(
        F.concat_ws(" ", name, kind).alias("keyword"),
        F.when(F.col("b") == "Brand#2", 0).otherwise(F.col("n").cast("int")).alias("total_count"),
        F.when(F.col("s") == 1, road).alias("road_address"),
        F.when(F.col("s") <= 2, lot).alias("address"),
    )


REGISTERED = datetime(2024, 1, 5, 3, 0)


def _known_addresses(spark, sf_dir) -> DataFrame:
    """Parts of one size are in the address table already."""
    known = _unit_addresses(spark, sf_dir).where("p_size = 7").select(F.col("p_partkey").alias("seq"), "legacy_address")
    fields = [f for f in ADDRESS_MASTER.fields if f.name not in known.columns]
    return known.select(*known.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).select(
        *ADDRESS_MASTER.fieldNames()
    )


@query("resolve_address")
def resolve_addresses_part(spark, sf_dir):
    owner = _unit_addresses(spark, sf_dir)
    known = _known_addresses(spark, sf_dir)
    return resolve_new_addresses([(owner, "legacy_address")], known, _geocoder(spark, sf_dir), REGISTERED)


@query("geocoder_answers")
def geocoder_answers_part(spark, sf_dir):
    """Addresses looked up in landed answers: hits, misses, and those an error leaves open.

    Names of one brand are answered with an error for name and type, and those of large parts have no place.
    """
    part = _table(spark, sf_dir, "part")
    groups = part.groupBy("p_name", "p_type").agg(F.min("p_brand").alias("b"), F.max("p_size").alias("s"))
    keyword = F.concat_ws(" ", "p_name", "p_type")
    place = F.struct(F.struct(F.concat(F.lit("road "), "p_name").alias("address_name"), F.col("b").alias("building_name")).alias("road_address"))
    found = F.to_json(F.struct(F.struct(F.lit(1).alias("total_count")).alias("meta"), F.array(place).alias("documents")))
    none = F.lit('{"meta":{"total_count":0},"documents":[]}')
    error = F.lit('{"errorType":null,"message":"busy"}')
    answer = F.when(F.col("b") == "Brand#1", error).when(F.col("s") > 40, none).otherwise(found)
    known = spark.createDataFrame([], ADDRESS_MASTER)
    answers = groups.select(keyword.alias("keyword"), answer.alias("answer"))
    owner = part.select(F.concat(keyword, F.lit(" unit")).alias("addr"))
    rows = resolve_new_addresses([(owner, "addr")], known, geocoder_answers(land(answers, "answers")), datetime(2024, 1, 5))
    return rows.select("seq", "legacy_address", "accuracy", "address_name", "building_name")


@query("retry_markers")
def retry_markers_part(spark, sf_dir):
    found = retry_markers(_known_addresses(spark, sf_dir), _geocoder(spark, sf_dir), REGISTERED)
    return found.select("seq", "legacy_address", "accuracy", "road_address_tf", "address_name")


@query("mark_surrogate")
def mark_surrogate_orders(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    marked = mark_surrogate(orders, "o_custkey", customer, "c_custkey", "c_custkey")
    return marked.select("o_orderkey", "addr_seq")


# merges


@query("upsert_by_key")
def address_upsert_customer(spark, sf_dir):
    target = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("state"), F.col("c_acctbal").alias("amount")
    )
    # the keys are shifted, so that some customers get no update and some updates are new
    updates = _table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 100).alias("custkey"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").alias("amount"),
        "o_orderdate",
        "o_orderkey",
    )
    return upsert_by_key(target, updates, ["custkey"], ["o_orderdate", "o_orderkey"])


def _refresh_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame, T.StructType]:
    events = _table(spark, sf_dir, "events")
    schema = T.StructType([events.schema[c] for c in ("user_id", "ts", "event_id", "event_type", "value")])
    views = events.where("event_type = 'view'").select(*schema.fieldNames())
    kind = F.when(F.col("event_type") == "error", "").otherwise(F.concat("event_type", F.lit("\x00")))
    raw = events.where("event_type <> 'view'").select(
        F.col("user_id").cast("string"),
        F.col("ts").cast("string"),
        F.col("event_id").cast("string"),
        kind.alias("event_type"),
        F.col("value").cast("string"),
    )
    return raw, views, schema


@query("daily_refresh")
def daily_refresh_events(spark, sf_dir):
    raw, views, schema = _refresh_inputs(spark, sf_dir)
    current = daily_refresh(views, None, schema, ["user_id"], ["ts", "event_id"])
    return daily_refresh(raw, current, schema, ["user_id"], ["ts", "event_id"])


@query("reverse_sync")
def reverse_sync_orders(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    current = orders.where("o_orderstatus <> 'P'")
    shifted = F.when(F.col("o_orderdate") < F.lit(datetime(1998, 1, 1)), F.expr("o_orderdate - INTERVAL 1 DAY")).otherwise(
        F.expr("o_orderdate + INTERVAL 1 DAY")
    )
    published = orders.where("o_orderstatus <> 'O'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), shifted.alias("o_orderdate")
    )
    return reverse_sync(published, current, ["o_orderkey"], ["o_orderdate"])


def _published_orders(spark, sf_dir) -> DataFrame:
    status = F.when(F.col("o_totalprice") > 250000, F.lit(None)).otherwise(F.col("o_orderstatus"))
    return _table(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'").select(
        "o_orderkey", status.alias("o_orderstatus")
    )


def _orders_delta(spark, sf_dir) -> DataFrame:
    status = F.when(F.col("o_totalprice") > 400000, F.lit(None)).otherwise(F.col("o_orderstatus"))
    source = _table(spark, sf_dir, "orders").select("o_orderkey", status.alias("o_orderstatus"))
    return publish_delta(source, _published_orders(spark, sf_dir), ["o_orderkey"], ["o_orderstatus"])


@query("publish_delta")
def publish_delta_orders(spark, sf_dir):
    return _orders_delta(spark, sf_dir).select("o_orderkey", "action")


@query("publish_apply")
def publish_apply_orders(spark, sf_dir):
    """The published table in buckets; those without a changed row stay as they are."""
    path = scratch_path(spark, "published")
    versions.replace(_published_orders(spark, sf_dir), path, keys=["o_orderkey"])
    versions.apply_changes(spark, path, changed_rows(_orders_delta(spark, sf_dir)))
    return versions.read(spark, path)


@query("publish_children")
def publish_children_orders(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer").where("c_acctbal > 0")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return publish_children(orders, customer, {"o_custkey": "c_custkey"})


def _finished_orders(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")


@query("delete_unmatched")
def delete_unmatched_lineitem(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return delete_unmatched(lines, _finished_orders(spark, sf_dir), {"l_orderkey": "o_orderkey"})


@query("delete_unmatched_parents")
def delete_unmatched_three_parents(spark, sf_dir):
    """Lines that have their order, their part and their supplier, checked in one pass over the lines' keys."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = _table(spark, sf_dir, "part").where("p_size > 5")
    suppliers = _table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    parents = [
        (_finished_orders(spark, sf_dir), {"l_orderkey": "o_orderkey"}),
        (parts, {"l_partkey": "p_partkey"}),
        (suppliers, {"l_suppkey": "s_suppkey"}),
    ]
    return with_parents(lines, parents)


@query("unmatched_rows")
def unmatched_rows_lineitem(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return unmatched_rows(lines, _finished_orders(spark, sf_dir), {"l_orderkey": "o_orderkey"})


# conforming


@query("code_master")
def code_master_supplier(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("major_cd"), F.col("n_name").alias("major_nm"))
    supplier = _table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("major_cd"), F.col("s_suppkey").alias("minor_cd"), F.col("s_name").alias("minor_nm")
    )
    return code_master(nation, supplier, "major_cd")


@query("extend_contract")
def extend_contract_orders(spark, sf_dir):
    extension = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n_lines"), F.max("l_quantity").alias("max_qty"))
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return extend_contract(orders, extension, "o_orderkey")


@query("extend_contract_newest")
def extend_contract_newest(spark, sf_dir):
    """Customers with their newest order: the extension has many rows per key."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_totalprice"
    )
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return extend_contract(customer, orders, "c_custkey", ["o_orderdate", "o_orderkey"])


@query("conform_union")
def conform_union_parties(spark, sf_dir):
    customer = (
        _table(spark, sf_dir, "customer"),
        {"kind": F.lit("customer"), "id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"},
    )
    supplier = (
        _table(spark, sf_dir, "supplier"),
        {"kind": F.lit("supplier"), "id": "s_suppkey", "name": "s_name", "nationkey": "s_nationkey"},
    )
    return conform_union([customer, supplier])


# ledger


def _ledger(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("dag_id"),
        F.to_date("ts").alias("completion_date"),
        F.col("ts").alias("completion_datetime"),
        "event_id",
    )


@query("ledger_upsert")
def ledger_upsert_events(spark, sf_dir):
    path = scratch_path(spark, "ledger")
    events = _ledger(spark, sf_dir)
    keys, order = ["dag_id", "completion_date"], ["completion_datetime", "event_id"]
    merge_partitions(spark, path, events.where("completion_date < DATE '2024-01-20'"), keys, keys[1], order)
    merge_partitions(spark, path, events.where("completion_date >= DATE '2024-01-15' OR completion_date IS NULL"), keys, keys[1], order)
    return spark.read.schema(events.schema).parquet(path)


@query("readiness")
def readiness_events(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    edges = events.select(F.col("user_id").cast("string").alias("asis_dag"), F.col("event_type").alias("tobe_dag"))
    lone = events.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("tobe_dag"))
    targets = edges.select("tobe_dag").unionByName(lone)
    return readiness(edges.distinct(), _ledger(spark, sf_dir), date(2024, 1, 5), targets)


# dated partitions


@query("snapshot")
def snapshot_customer(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    customer = _table(spark, sf_dir, "customer")
    write_snapshot(customer, path, date(2024, 1, 1))
    write_snapshot(customer.where("c_acctbal > 0"), path, date(2024, 1, 2))
    # a rerun replaces its own day only
    write_snapshot(customer.where("c_acctbal > 5000"), path, date(2024, 1, 2))
    return read_snapshots(spark, path)


@query("partition_plan")
def partition_plan_part(spark, sf_dir):
    managed = _table(spark, sf_dir, "part").select(
        F.lit("lv1").alias("schema_nm"),
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("table_nm"),
        F.col("p_size").alias("store_d_num"),
        (F.col("p_type") != "SMALL").alias("partition_tf"),
    )
    return partition_plan(managed, date(2024, 2, 8))


def _order_days(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("part_name")
    ).distinct()


@query("expired_partitions")
def expired_partitions_orders(spark, sf_dir):
    return expired_partitions(_order_days(spark, sf_dir), "part_name", date(2000, 1, 11), 10)


@query("expired_of_managed")
def expired_of_managed_lineitem(spark, sf_dir):
    # every table name stands in two schemas of different retention
    schema = F.when(F.col("l_linenumber") % 2 == 0, "lv2").otherwise("lv1").alias("schema_nm")
    lines = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", schema)
    table = F.concat(F.lit("lines_"), "l_returnflag")
    name = F.concat_ws("_", table, F.date_format("l_shipdate", "yyyyMMdd")).alias("part_name")
    names = lines.select("schema_nm", name).distinct()
    keep = F.when(F.col("l_returnflag") == "A", 100).when(F.col("l_returnflag") == "N", 1000).otherwise(2000)
    keep = F.when(F.col("schema_nm") == "lv2", keep + 500).otherwise(keep)
    managed = lines.select(
        "schema_nm", table.alias("table_nm"), keep.alias("store_d_num"), F.lit(True).alias("partition_tf")
    ).distinct()
    return expired_of_managed(names, "part_name", managed, date(2000, 1, 11))


def _dated_events(spark, sf_dir) -> str:
    path = scratch_path(spark, "dated")
    events = _table(spark, sf_dir, "events")
    write_dated(events.withColumn("logging_dt", F.date_format("ts", "yyyyMMdd").cast("int")), path)
    return path


@query("drop_expired")
def drop_expired_events(spark, sf_dir):
    path = _dated_events(spark, sf_dir)
    drop_expired(spark, path, date(2024, 1, 20), 10)
    return read_snapshots(spark, path).select("event_id", "logging_dt")


@query("list_partitions")
def list_partitions_events(spark, sf_dir):
    """Days of a table of versions, from its inventory."""
    path = scratch_path(spark, "dated")
    events = _table(spark, sf_dir, "events")
    replace_days(events.withColumn("logging_dt", F.date_format("ts", "yyyyMMdd").cast("int")), path)
    return partition_days(spark, path).select("logging_date")
