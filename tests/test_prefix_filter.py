import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.addresses import token_count
from millrace.operators.address import (
    _BITMAP,
    geocoder_answers,
    longest_prefix,
    prefix_candidates,
    prefix_filter,
    resolve_new_addresses,
    retry_markers,
)
from millrace.schemas import ADDRESS_MASTER


def test_the_filter_drops_candidates_and_no_match(spark):
    texts = spark.range(2000).select(F.concat(F.lit("city "), F.col("id"), F.lit(" street x 7 unit")).alias("t"))
    words = spark.range(0, 2000, 40).select(F.concat(F.lit("city "), F.col("id")).alias("k"))
    bits = _BITMAP
    held = prefix_filter(words, "k", bits)
    assert held.count() <= bits // _BITMAP and held.where(F.octet_length("bitmap") > 4096).count() == 0
    found = prefix_candidates(texts, "t", "k", 6, held, bits).collect()
    all_of_them = texts.select(F.sum(token_count(F.col("t")))).first()[0]
    assert all_of_them == 12_000
    matches = {r.k for r in words.collect()}
    assert matches <= {r.k for r in found}
    assert len(found) < 100  # 50 matches and a few that share a bit with one


def test_filter_has_no_false_negative_at_any_size(spark):
    words = spark.range(3000).select(F.concat(F.lit("w"), F.col("id")).alias("k"))
    for bits in (_BITMAP, 8 * _BITMAP):
        held = prefix_filter(words, "k", bits)
        assert prefix_candidates(words.withColumnRenamed("k", "t"), "t", "k", 3, held, bits).count() == 3000


def test_empty_dictionary_and_odd_texts(spark, rows):
    keys = spark.createDataFrame([("a  b",), ("",), (None,), (" ",), ("x " * 300,)], "t string")
    none = spark.createDataFrame([], "k string, v int")
    assert [r[1] for r in rows(longest_prefix(keys, "t", none, "k"))] == [None] * 5
    some = spark.createDataFrame([("", 1), ("a ", 2), (None, 3), ("x x", 4)], "k string, v int")
    got = {r.t: (r.k, r.n_tokens, r.v) for r in longest_prefix(keys, "t", some, "k").collect()}
    assert got == {"a  b": ("a ", 2, 2), "": ("", 1, 1), None: (None, None, None), " ": ("", 1, 1), "x " * 300: ("x x", 2, 4)}


PLACE = {"road_address": {"address_name": "R", "building_name": "", "zone_no": "1"}, "address": {"address_name": "L"}}


def answers(spark, *pairs):
    texts = [(k, a if isinstance(a, str) or a is None else json.dumps(a)) for k, a in pairs]
    return spark.createDataFrame(texts, "keyword string, answer string")


def hit(n=1):
    return {"meta": {"total_count": n}, "documents": [PLACE] * min(n, 2)}


def test_geocoder_answers(spark):
    table = answers(
        spark, ("a", hit(3)), ("b", {"meta": {"total_count": 0}, "documents": []}), ("c", {"errorType": "Busy"}), ("d", {"errorType": None}),
        ("e", "no json"), ("f", None), ("g", {"meta": {}}), ("h", {"errorType": "Busy"}), ("h", hit()), (None, hit()),
    )
    got = {r.keyword: (r.total_count, r.is_error, r.road_address and r.road_address.address_name) for r in geocoder_answers(table).collect()}
    assert got == {
        "a": (3, False, "R"), "b": (0, False, None), "c": (None, True, None), "d": (None, True, None), "e": (None, True, None),
        "f": (None, True, None), "g": (None, True, None), "h": (1, False, "R"),
    }


def test_an_error_leaves_the_address_open(spark, rows):
    dictionary = geocoder_answers(answers(spark, ("s 1", hit()), ("s 2", {"errorType": "Busy"}), ("s", hit()), ("t", {"errorType": "Busy"})))
    owner = spark.createDataFrame([("s 1 x",), ("s 2 x",), ("s 3",), ("u 1",), ("t 9",)], "addr string")
    known = spark.createDataFrame([], ADDRESS_MASTER)
    new = resolve_new_addresses([(owner, "addr")], known, dictionary, "2024-01-05 00:00:00")
    # the error at "s 2" stops before the shorter "s" is tried; open addresses have no number either
    assert rows(new, "seq", "legacy_address", "accuracy") == [(1, "s 1 x", 1), (2, "s 3", 1), (3, "u 1", None)]
    # a stored miss that meets an error stays a miss
    markers = new.where("accuracy IS NULL").withColumn("legacy_address", F.lit("t 9"))
    assert retry_markers(markers, dictionary, "2024-01-06 00:00:00").count() == 0


@pytest.mark.parametrize("shared", [True, False])
def test_without_the_error_column_nothing_changes(spark, rows, shared):
    dictionary = geocoder_answers(answers(spark, ("s", hit()))).drop("is_error")
    owner = spark.createDataFrame([("s 1",), ("v 1",)] + [("s 1",)] * 5 * shared, "addr string")
    new = resolve_new_addresses([(owner, "addr")], spark.createDataFrame([], ADDRESS_MASTER), dictionary, "2024-01-05 00:00:00")
    assert rows(new, "seq", "legacy_address", "accuracy") == [(1, "s 1", 1), (2, "v 1", None)]
