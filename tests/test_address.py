from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import address as address_module
from millrace.operators import skew
from millrace.operators.address import (
    longest_prefix,
    mark_surrogate,
    negative_markers,
    resolve_address,
    resolve_new_addresses,
    retry_markers,
    unit_extract,
    unresolved_keys,
)
from millrace.schemas import ADDRESS_DICTIONARY, ADDRESS_MASTER

AT = datetime(2024, 1, 5, 3, 0)


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, addr string")


def dictionary(spark, *keywords):
    return spark.createDataFrame([(k, f"at {k}") for k in keywords], "keyword string, place string")


def brute_force(text, keywords):
    tokens = (text or "").split(" ")
    while text is not None and tokens:
        if " ".join(tokens) in keywords:
            return " ".join(tokens), len(tokens)
        tokens.pop()
    return None, None


CASES = ["a b c", "a b x", "a x y z", "q", "a  b", "a b ", "", None, "a b c", "a b c d e"]
WORDS = ["a", "a b c", "a ", "a  b", "b"]


def test_longest_wins(spark):
    got = longest_prefix(texts(spark, *CASES), "addr", dictionary(spark, *WORDS), "keyword").collect()
    assert len(got) == len(CASES)
    for r in got:
        assert (r.keyword, r.n_tokens) == brute_force(r.addr, WORDS)
        assert r.place == (f"at {r.keyword}" if r.keyword is not None else None)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    cases=st.lists(st.one_of(st.none(), st.text("ab ", max_size=7)), max_size=12),
    words=st.lists(st.text("ab ", max_size=4), max_size=6),
)
def test_any_text(spark, cases, words):
    got = longest_prefix(texts(spark, *cases), "addr", dictionary(spark, *words), "keyword").collect()
    assert {r.id: (r.keyword, r.n_tokens) for r in got} == {i: brute_force(c, words) for i, c in enumerate(cases)}
    assert len(got) == len(cases)


def test_hot_prefix_and_hot_text(spark, monkeypatch):
    """One text and one leading word hold most rows; the split joins give the same answer."""
    seen = []

    def small(df, keys, expand=None):
        seen.append(skew.hot_hashes(df, keys, expand, tasks=40))
        return seen[-1]

    monkeypatch.setattr(address_module, "hot_hashes", small)
    many = ["a b c"] * 40 + [f"a {i} z" for i in range(60)] + [f"q {i}" for i in range(20)] + [None] * 9
    words = ["a", "a b", *[f"a {i}" for i in range(0, 60, 7)], "q 3"]
    got = longest_prefix(texts(spark, *many), "addr", dictionary(spark, *words), "keyword").collect()
    assert seen[0]
    assert sorted((r.id, r.keyword or "", r.n_tokens or 0) for r in got) == [
        (i, *(x or y for x, y in zip(brute_force(t, words), ("", 0)))) for i, t in enumerate(many)
    ]


def test_double_keyword_gives_one_row(spark):
    double = dictionary(spark, "a").unionByName(spark.createDataFrame([("a", "zz")], "keyword string, place string"))
    got = longest_prefix(texts(spark, "a b"), "addr", double, "keyword").collect()
    assert [(r.keyword, r.place) for r in got] == [("a", "zz")]


def test_dictionary_of_keywords_only_and_empty(spark):
    words = dictionary(spark, "a").select("keyword")
    assert longest_prefix(texts(spark, "a b"), "addr", words, "keyword").first().keyword == "a"
    none = longest_prefix(texts(spark, "a b"), "addr", words.where("false"), "keyword").first()
    assert none.keyword is None and none.n_tokens is None


def test_unresolved(spark, rows):
    owner = texts(spark, "x", "x", "y", "", None, "z")
    known = spark.createDataFrame([("y",), ("y",), (None,)], "legacy_address string")
    assert rows(unresolved_keys(owner, "addr", known, "legacy_address")) == [("x",), ("z",)]
    assert rows(unresolved_keys(owner, "addr", known, "legacy_address", skip_blank=False)) == [("",), ("x",), ("z",)]


@pytest.mark.parametrize(
    "address,building,dong,ho",
    [
        ("서울 101동 1203호", "탑", "101", "1203"),
        ("서울 동 7호 8호", "탑", None, "7"),
        ("서울 101동", "탑", "101", None),
        ("서울", "탑", None, None),
        ("서울 101동 1203호", "", None, None),
        ("서울 101동 1203호", None, None, None),
        (None, "탑", None, None),
    ],
)
def test_units(spark, address, building, dong, ho):
    df = spark.createDataFrame([(address, building)], "a string, b string")
    row = unit_extract(df, "a", "b").first()
    assert (row.building_dong, row.building_ho) == (dong, ho)


def geocoder(spark):
    road = dict(address_name="R", building_name="B", region_1depth_name="1", region_2depth_name="", region_3depth_name="3", x="127", y="37", zone_no="04524")
    lot = dict(address_name="L", region_1depth_name="1", region_2depth_name="2", region_3depth_name="", region_3depth_h_name="h", x="", y="37")
    data = [
        ("both", 2, road, lot),
        ("lot", 1, None, lot),
        ("neither", 1, None, None),
        ("nobuilding", 1, {**road, "building_name": ""}, None),
        ("zero", 0, road, None),
    ]
    return spark.createDataFrame(data, ADDRESS_DICTIONARY)


def test_address_forms(spark):
    keys = spark.createDataFrame([(f"{w} 1동 2호",) for w in ("both", "lot", "neither", "nobuilding")], "legacy_address string")
    matched = longest_prefix(keys, "legacy_address", geocoder(spark), "keyword")
    got = {r.legacy_address.split(" ")[0]: r for r in resolve_address(matched).collect()}
    both = got["both"]
    assert (both.accuracy, both.road_address_tf, both.address_name, both.region_2depth_name) == (2, True, "R", None)
    assert (both.building_name, both.building_dong, both.building_ho, both.zone_no) == ("B", "1", "2", "04524")
    assert both.region_3depth_h_name is None
    lot = got["lot"]
    assert (lot.road_address_tf, lot.address_name, lot.region_3depth_h_name, lot.x, lot.y) == (False, "L", "h", None, "37")
    assert (lot.building_name, lot.building_dong, lot.zone_no) == (None, None, None)
    assert got["neither"].road_address_tf is False and got["neither"].address_name is None
    assert (got["nobuilding"].building_name, got["nobuilding"].building_ho) == (None, None)


def test_resolve_all_owners_at_once(spark, rows):
    known = spark.createDataFrame([(5, "both old")], "seq bigint, legacy_address string")
    known = known.select(
        *[F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in ADDRESS_MASTER.fields]
    )
    owners = [(texts(spark, "both 1", "both 1", "both old", ""), "addr"), (texts(spark, "lot 9", "nothing", "zero 1", None).withColumnRenamed("addr", "move"), "move")]
    new = resolve_new_addresses(owners, known, geocoder(spark), AT)
    assert new.columns == ADDRESS_MASTER.fieldNames()
    assert rows(new, "seq", "legacy_address", "accuracy") == [(6, "both 1", 2), (7, "lot 9", 1), (8, "nothing", None), (9, "zero 1", None)]
    assert {r.register_dt for r in new.collect()} == {AT}
    table = known.unionByName(new)
    assert resolve_new_addresses(owners, table, geocoder(spark), AT).count() == 0
    # a miss is looked up again on demand and keeps its number
    wider = geocoder(spark).unionByName(geocoder(spark).where("keyword = 'lot'").withColumn("keyword", F.lit("nothing")))
    again = retry_markers(table, wider, AT)
    assert rows(again, "seq", "legacy_address") == [(5, "both old"), (8, "nothing")]


def test_markers(spark, rows):
    found = longest_prefix(texts(spark, "a b", "q"), "addr", dictionary(spark, "a"), "keyword")
    assert rows(negative_markers(found, "addr", "keyword")) == [("q",)]


def test_mark_surrogate(spark, rows):
    reference = spark.createDataFrame([(1, "x"), (4, "x"), (2, "y")], "seq bigint, legacy_address string")
    got = mark_surrogate(texts(spark, "x", "z", None), "addr", reference, "legacy_address", "seq")
    assert rows(got, "id", "addr_seq") == [(0, 4), (1, None), (2, None)]
