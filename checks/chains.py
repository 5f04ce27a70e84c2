"""The end-to-end jobs as queries: source tables in, published tables out."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.queries import STATUS_END, _pages, _table, query
from millrace.operators.conform import extend_contract
from millrace.plans.catalog import (
    ADDRESS,
    FEEDS,
    LOAD,
    PUBLISH,
    REFRESH,
    SNAPSHOT_STEP,
    TABLES,
    step_name,
)
from millrace.plans.jobs import (
    Hub,
    Publication,
    customer_chain,
    delete_orphans,
    deleted_keys,
    institution_chain,
    load_raw,
    maintain_partitions,
    publish,
    refresh,
    table_chain,
)
from millrace.schemas import DEPENDENCY_MANAGER, PARTITION_MANAGER
from millrace.session import PAGES_BYTES, land, scratch_path
from millrace.sinks.snapshots import read_snapshots, write_dated
from millrace.sinks.tables import replace_table

CUSTOMER = TABLES["V_CUSTOMER"]


def _edges(hub: Hub, pairs: list[tuple[str, str]]) -> None:
    edges = hub.spark.createDataFrame(pairs, DEPENDENCY_MANAGER)
    replace_table(edges, hub.path("control", "dependency_manager"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an address text that begins with a word many share."""
    address = F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string"), "c_name")
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", address.alias("legacy_addr")
    )


def _places(customers: DataFrame) -> DataFrame:
    """Dictionary: the two leading words of all addresses whose customers are in credit, lot form only."""
    names = "array<string>"
    words = F.split("legacy_addr", " ")
    found = customers.where("c_acctbal > 9000").select(
        F.array_join(F.slice(words, 1, 2), " ").alias("keyword"), words.cast(names)[0].alias("region")
    )
    blank = F.lit(None).cast("string")
    lot = F.struct(
        F.col("keyword").alias("address_name"),
        F.col("region").alias("region_1depth_name"),
        *[blank.alias(c) for c in ("region_2depth_name", "region_3depth_name", "region_3depth_h_name", "x", "y")],
    )
    road_fields = ("address_name", "building_name", "region_1depth_name", "region_2depth_name", "region_3depth_name", "x", "y", "zone_no")
    road_type = "struct<" + ",".join(f"{c}:string" for c in road_fields) + ">"
    return (
        found.groupBy("keyword", "region")
        .agg(F.count("*").cast("int").alias("total_count"))
        .select("keyword", "total_count", F.lit(None).cast(road_type).alias("road_address"), lot.alias("address"))
    )


def _customer_run(spark: SparkSession, sf_dir: str) -> Hub:
    """Two business dates: first the customers in credit, then all; the second also drops orphans."""
    root = scratch_path(spark, "hub")
    first = Hub(spark, root, date(2024, 1, 4), datetime(2024, 1, 4, 3, 0))
    second = Hub(spark, root, date(2024, 1, 5), datetime(2024, 1, 5, 3, 0))
    load, refresh, address = CUSTOMER.step(LOAD), CUSTOMER.step(REFRESH), CUSTOMER.step(ADDRESS)
    _edges(
        first,
        [(load, refresh), (refresh, address), (address, CUSTOMER.step(PUBLISH)), (address, SNAPSHOT_STEP)],
    )
    kept = [("lv1", "address_master_log", 10, True)]
    replace_table(spark.createDataFrame(kept, PARTITION_MANAGER), first.path("control", "partition_manager"))
    customers = _customers(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    first.write("hc", "opportunity", orders, ["o_orderkey"])
    dictionary = _places(customers)
    for hub, rows in ((first, customers.where("c_acctbal > 0")), (second, customers)):
        customer_chain(
            hub, CUSTOMER, rows, customers.schema, ["c_custkey"], ["c_name"], "legacy_addr", dictionary,
            {"opportunity": {"o_custkey": "c_custkey"}}, ["c_name", "c_acctbal", "legacy_addr"],
        )
    return second


@query("customer_chain")
def customer_chain_account(spark, sf_dir):
    """Published accounts, what their address was found to be, and their remaining orders."""
    hub = _customer_run(spark, sf_dir)
    found = hub.addresses().select(F.col("seq").alias("addr_seq"), "address_name")
    orders = hub.table("hc", "opportunity").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    accounts = hub.table("hc", "account")
    return (
        accounts.join(found, "addr_seq", "left")
        .join(orders, "c_custkey", "left")
        .select("c_custkey", "c_name", "c_acctbal", "address_name", "addr_seq", "n_orders")
    )


@query("snapshot_chain")
def customer_chain_snapshots(spark, sf_dir):
    hub = _customer_run(spark, sf_dir)
    log = read_snapshots(spark, hub.path("lv1", "address_master_log"))
    return log.groupBy("logging_dt").agg(
        F.count("*").alias("n_addresses"), F.count("accuracy").alias("n_found"), F.max("seq").alias("top_seq")
    )


@query("refresh_with_deletes")
def refresh_with_deletes(spark, sf_dir):
    """The second full copy lacks the customers in debt: they leave the clean table, the accounts and their orders."""
    first, second = _days(spark)
    load, clean_step = CUSTOMER.step(LOAD), CUSTOMER.step(REFRESH)
    _edges(first, [(load, clean_step)])
    customers = _customers(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    first.write("hc", "opportunity", orders, ["o_orderkey"])
    for hub, rows in ((first, customers), (second, customers.where("c_acctbal >= 0"))):
        load_raw(hub, CUSTOMER, rows, keys=["c_custkey"])
        clean = refresh(hub, CUSTOMER, customers.schema, ["c_custkey"], ["c_name"])
        gone = deleted_keys(hub, CUSTOMER, clean, ["c_custkey"])
        publish(hub, "account", clean, ["c_custkey"], ["c_name", "c_acctbal"], deleted=gone)
        delete_orphans(hub, "opportunity", [(clean, {"o_custkey": "c_custkey"})])
    accounts = second.table("hc", "account").select(F.lit("account").alias("kind"), F.col("c_custkey").alias("id"))
    left = second.table("hc", "opportunity").select(F.lit("opportunity").alias("kind"), F.col("o_orderkey").alias("id"))
    return accounts.unionByName(left)


def _feed(name: str, pages: DataFrame, payload: Column, end: str) -> DataFrame:
    """The pages of a feed, numbered from its first page on, and the page without rows that ends each category.

    All rows are in the first category; the others end at once.
    """
    feed = FEEDS[name]
    first, *others = feed.categories or (None,)
    number = (F.col("page_no") - 1 + feed.first_page).cast("int").alias("page_no")

    def closed(frame: DataFrame, category: str | None) -> DataFrame:
        last = F.coalesce(F.max("page_no") + 1, F.lit(feed.first_page)).alias("page_no")
        return frame.agg(last).select(F.lit(category).cast("string").alias("category"), "page_no", F.lit(end).alias("payload"))

    filled = land(pages.select(F.lit(first).cast("string").alias("category"), number, payload.alias("payload")), name, PAGES_BYTES)
    answers = filled.unionByName(closed(filled, first))
    for category in others:
        answers = answers.unionByName(closed(filled.limit(0), category))
    return answers.select(F.lit(name).alias("feed"), "category", "page_no", "payload")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed pages packed from the test tables."""
    supplier, customer = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "customer")
    part, orders = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "orders")
    nation = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string"))
    data = F.to_json(F.struct(F.col("records").alias("data")))

    care = F.struct(
        F.col("s_suppkey").cast("string").alias("번호"), F.col("s_name").alias("산후조리원"), nation.alias("주소")
    )
    welfare = F.struct(F.col("s_name").alias("기관명"), F.lit("").alias("주소"), F.col("s_nationkey").cast("string").alias("전화번호"))
    school = F.struct(
        F.col("c_custkey").cast("string").alias("seq"),
        F.col("c_name").alias("schoolName"),
        F.col("c_mktsegment").alias("adres"),
    )
    hall_columns = FEEDS["town_hall"].columns
    hall_values = {"flctNm": F.col("o_orderpriority"), "lctnRoadNmAddr": F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))}
    hall = F.struct(*[hall_values.get(c, F.lit("-")).alias(c) for c in hall_columns])
    hospital = F.struct(F.col("p_name").alias("dutyName"), F.concat_ws(" ", "p_name", "p_type").alias("dutyAddr"), F.col("p_partkey").cast("string").alias("hpid"))

    content = F.struct(F.struct(F.col("records").alias("content")).alias("dataSearch"))
    response = F.struct(
        F.struct(
            F.struct(F.lit("00").alias("resultCode")).alias("header"),
            F.struct(F.col("records").alias("items")).alias("body"),
        ).alias("response")
    )
    xml = F.to_xml(
        F.struct(F.struct(F.struct(F.col("records").alias("item")).alias("items")).alias("body")), {"rowTag": "response"}
    )
    feeds = [
        _feed("care_center", _pages(supplier, ["s_suppkey"], 50, care), data, '{"data":[]}'),
        _feed("welfare_center", _pages(supplier, ["s_suppkey"], 50, welfare), data, '{"data":[]}'),
        _feed("school", _pages(customer, ["c_custkey"], 500, school), F.to_json(content), '{"dataSearch":{"content":[]}}'),
        _feed("town_hall", _pages(orders, ["o_orderkey"], 1000, hall), F.to_json(response), STATUS_END),
        _feed("hospital", _pages(part, ["p_partkey"], 500, hospital), xml, "<response><body><items/></body></response>"),
    ]
    landed = feeds[0]
    for feed in feeds[1:]:
        landed = landed.unionByName(feed)
    return land(landed, "payloads", PAGES_BYTES)


@query("institution_chain")
def institution_chain_published(spark, sf_dir):
    hub = Hub(spark, scratch_path(spark, "hub"), date(2024, 1, 5), datetime(2024, 1, 5, 3, 0))
    names = {stage: step_name(stage, "DATAAPI", "PUBLIC_INSTITUTION") for stage in (REFRESH, ADDRESS, PUBLISH)}
    _edges(
        hub,
        [(feed.step, names[REFRESH]) for feed in FEEDS.values()]
        + [(names[REFRESH], names[ADDRESS]), (names[ADDRESS], names[PUBLISH])],
    )
    dictionary = _places(_customers(spark, sf_dir))
    return institution_chain(hub, _payloads(spark, sf_dir), dictionary).drop("institution_id")


def _days(spark: SparkSession) -> tuple[Hub, Hub]:
    root = scratch_path(spark, "hub")
    return tuple(Hub(spark, root, date(2024, 1, d), datetime(2024, 1, d, 3, 0)) for d in (4, 5))


@query("contract_chain")
def contract_chain_opportunity(spark, sf_dir):
    """Orders with a summary of their lines. On the first day the older ones only, all of them still open."""
    first, second = _days(spark)
    contract, extension = TABLES["R_ORDER_CONTRACT"], TABLES["R_ORDER_CONTRACT_ADD"]
    load, refresh = contract.step(LOAD), contract.step(REFRESH)
    _edges(first, [(load, refresh), (extension.step(LOAD), refresh), (refresh, contract.step(PUBLISH))])
    lines = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    lines = lines.agg(F.count("*").alias("n_lines"), F.max("l_quantity").alias("max_qty"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    older = orders.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'").withColumn("o_orderstatus", F.lit("X"))
    compared = [c for c in (*orders.columns, "n_lines", "max_qty") if c != "o_orderkey"]
    schema = orders.join(lines, "o_orderkey", "left").schema
    published = {}
    for hub, rows in ((first, older), (second, orders)):
        table_chain(hub, extension, lines)
        published = table_chain(
            hub, contract, rows, schema, ["o_orderkey"], ["o_orderdate"],
            {"opportunity": Publication(["o_orderkey"], compared)},
            derive=lambda raw, hub=hub: extend_contract(raw, hub.raw(extension.raw_name), "o_orderkey"),
        )
    return published["opportunity"]


@query("lounge_chain")
def lounge_chain_map(spark, sf_dir):
    """Customers as lounges, which need their nation as organisation and a region as group."""
    first, second = _days(spark)
    lounge, org, group = TABLES["V_SALES_LOUNGE"], TABLES["B_SALE_ORG"], TABLES["B_SALES_GRP"]
    edges = [(t.step(LOAD), t.step(REFRESH)) for t in (lounge, org, group)]
    _edges(first, [*edges, *[(t.step(REFRESH), lounge.step(PUBLISH)) for t in (lounge, org, group)]])
    nation = _table(spark, sf_dir, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("org"), "n_name")
    region = _table(spark, sf_dir, "region").where("r_regionkey <> 4").select(F.col("r_regionkey").alias("grp"), "r_name")
    lounges = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").alias("org"), (F.col("c_nationkey") % 5).alias("grp")
    )
    made = Publication(["c_custkey"], ["c_name", "org", "grp"], {"b_sales_org": "org", "b_sales_grp": "grp"})
    published = {}
    for hub, rows in ((first, lounges.where("grp < 2").withColumn("c_name", F.lit("old"))), (second, lounges)):
        table_chain(hub, org, nation, keys=["org"], order_cols=["n_name"])
        table_chain(hub, group, region, keys=["grp"], order_cols=["r_name"])
        published = table_chain(hub, lounge, rows, lounges.schema, ["c_custkey"], ["c_name"], {"bbs_map": made})
    return published["bbs_map"]


@query("maintain_partitions")
def maintain_partitions_events(spark, sf_dir):
    """The days left of one table name in three schemas: kept 5 days, kept 15 days and not managed."""
    hub = Hub(spark, scratch_path(spark, "hub"), date(2024, 1, 25), datetime(2024, 1, 25, 3, 0))
    day = F.date_format("ts", "yyyyMMdd").cast("int").alias("logging_dt")
    events = _table(spark, sf_dir, "events").select("event_id", day)
    rules = [("lv1", "event_log", 5, True), ("lv2", "event_log", 15, True), ("hc", "event_log", 1, False), ("lv1", "none", 1, True)]
    replace_table(spark.createDataFrame(rules, PARTITION_MANAGER), hub.path("control", "partition_manager"))
    for schema in ("lv1", "lv2", "hc"):
        write_dated(events, hub.path(schema, "event_log"))
    maintain_partitions(hub)
    left = [read_snapshots(spark, hub.path(s, "event_log")).withColumn("schema_nm", F.lit(s)) for s in ("lv1", "lv2", "hc")]
    return left[0].unionByName(left[1]).unionByName(left[2])
