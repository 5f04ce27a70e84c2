import json

import pytest
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F

from millrace import session
from millrace.plans.catalog import FEEDS
from millrace.plans.jobs import parse_feed
from millrace.schemas import PAYLOADS
from millrace.sources import payloads as module
from millrace.sources.payloads import (
    MissingPages,
    json_pages,
    rejected_json_pages,
    rejected_xml_pages,
    strict_json_pages,
    xml_pages,
)
from millrace.sources.tables import category_union

STATUS = ("response.body.items", "response.header.resultCode")


def pages(spark, *payloads, feed="f"):
    rows = [(feed, None, i, p if isinstance(p, str) or p is None else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, PAYLOADS)


def status_page(code, items=None):
    body = {"header": {"resultCode": code}}
    if items is not None:
        body["body"] = {"items": items}
    return {"response": body}


def test_rows_of_all_pages(spark, rows):
    df = pages(
        spark,
        '{"data": [{"a": "1", "b": 2.50, "extra": "x"}, {"a": null}]}',
        {"data": [{"b": {"c": 1}}]},
        {"data": [{"a": "1", "b": "2.50"}]},
        {"data": []},
    )
    got = json_pages(df, ["a", "b"], "data", keep=["page_no"])
    # a JSON number has no trailing zeros, a JSON text stays as it is
    assert rows(got) == sorted(
        [(0, "1", "2.5"), (0, None, None), (1, None, '{"c":1}'), (2, "1", "2.50")],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_korean_keys(spark, rows):
    feed = FEEDS["care_center"]
    df = pages(spark, {"data": [{"번호": 1, "주소": "서울 중구"}]}, {"data": []}, feed="care_center")
    df = df.withColumn("page_no", F.col("page_no") + feed.first_page)
    got = parse_feed(feed, df)
    assert got.columns == list(feed.columns)
    assert got.first()["주소"] == "서울 중구" and got.first()["번호"] == "1"


def attempts(spark, *answers, feed="f"):
    """Payloads of (page_no, attempt, payload)."""
    rows = [(feed, None, n, k, p if isinstance(p, str) else json.dumps(p)) for n, k, p in answers]
    return spark.createDataFrame(rows, "feed string, category string, page_no int, attempt int, payload string")


def test_no_unreadable_page_is_dropped(spark, rows):
    one = pages(spark, {"data": [{"a": "1"}]}, "{broken", {"data": []})
    assert rows(rejected_json_pages(one, "data"), "page_no") == [(1,)]
    with pytest.raises(Exception, match="1 pages without a good answer"):
        json_pages(one, ["a"], "data").collect()
    three = pages(spark, {"data": [{"a": "1"}]}, "{broken", {"other": 1}, "")
    with pytest.raises(Exception, match="3 unreadable pages"):
        json_pages(three, ["a"], "data").collect()


def test_a_good_answer_stands_for_its_page(spark, rows):
    df = attempts(
        spark, (1, 1, "{broken"), (1, 2, {"data": [{"a": "1"}]}), (2, 1, {"data": [{"a": "old"}]}), (2, 2, "{"), (2, 3, {"data": [{"a": "2"}]})
    )
    assert rows(json_pages(df, ["a"], "data")) == [("1",), ("2",)]


def test_wrong_shaped_records_are_rejected(spark, rows):
    df = pages(spark, {"data": ["x", "y"]})
    assert rows(rejected_json_pages(df, "data"), "page_no") == [(0,)]


def test_errors_count_per_feed(spark, rows):
    a = attempts(spark, (1, 1, "x"), (1, 2, "y"), (1, 3, {"data": [{"a": "1"}]}), feed="one")
    b = attempts(spark, (1, 1, "x"), (1, 2, {"data": [{"a": "2"}]}), feed="two")
    assert rows(json_pages(a.unionByName(b), ["a"], "data")) == [("1",), ("2",)]


def test_status_codes(spark, rows):
    ok = status_page("00", [{"a": "1"}])
    df = attempts(spark, (1, 1, status_page("22")), (1, 2, ok), (2, 1, status_page("03")))
    assert rows(json_pages(df, ["a"], *STATUS)) == [("1",)]
    bad = pages(spark, ok, status_page("22"), status_page("99", [{"a": "no"}]), status_page("03"))
    assert rows(rejected_json_pages(bad, *STATUS), "page_no") == [(1,), (2,)]
    with pytest.raises(Exception, match="2 pages without a good answer"):
        json_pages(bad, ["a"], *STATUS).collect()


def test_strict_keys(spark, rows):
    df = pages(spark, status_page("00", [{"a": "1", "b": None, "z": 3}]), status_page("03"))
    assert rows(strict_json_pages(df, ["a", "b"], *STATUS)) == [("1", None)]
    with pytest.raises(Exception, match="missing keys: c"):
        strict_json_pages(df, ["a", "c"], *STATUS).collect()


def test_xml_one_item_or_many(spark, rows):
    df = pages(
        spark,
        "<response><header/><body><items><item><a>1</a><b/></item><item><a>2</a><z>q</z></item></items></body></response>",
        "<response><body><items><item><a>3</a><b> x </b></item></items></body></response>",
        "<response><body><items/></body></response>",
    )
    got = rows(xml_pages(df, ["a", "b"]))
    assert [(a, b and b.strip()) for a, b in got] == [("1", None), ("2", None), ("3", "x")]


def test_xml_rejects(spark):
    end = "<response><body><items/></body></response>"
    error = "<response><header><resultCode>99</resultCode></header><body/></response>"
    df = pages(spark, "<oops", "<response><x/></response>", error, end)
    assert sorted(r.page_no for r in rejected_xml_pages(df).collect()) == [0, 1, 2]
    assert xml_pages(pages(spark, end), ["a"]).count() == 0
    with pytest.raises(Exception, match="3 unreadable pages"):
        xml_pages(df, ["a"]).collect()


def test_pages_are_landed_a_record_a_row(spark, rows, monkeypatch):
    landed = []

    def land(df, *args):
        landed.append(module.PAGES_BYTES in args)
        landed.append([f.dataType.typeName() for f in df.schema])
        return session.land(df, *args)

    monkeypatch.setattr(module, "land", land)
    ok = status_page("00", [{"a": "1", "b": "x"}, {"a": "2", "b": None}])
    df = attempts(
        spark, (1, 1, status_page("22")), (1, 2, ok), (1, 2, ok), (2, 1, ok), (2, 2, status_page("00", [])), (3, 1, status_page("03"))
    )
    rejects = []
    got = strict_json_pages(df, ["a", "b"], *STATUS, keep=["page_no"], rejects_to=lambda r: rejects.extend(rows(r, "page_no", "attempt", "payload")))
    assert rows(got) == [(1, "1", "x")] * 2 + [(1, "2", None)] * 2 and rejects == [(1, 1, json.dumps(status_page("22")))]
    xml = "<response><body><items><item><a>1</a></item><item><a>2</a></item></items></body></response>"
    assert rows(xml_pages(pages(spark, xml, "<response><body><items/></body></response>"), ["a"])) == [("1",), ("2",)]
    # an element that is null is a record of nulls
    assert rows(json_pages(pages(spark, {"data": [None, {"a": "1"}]}, {"data": []}), ["a", "b"], "data")) == [(None, None), ("1", None)]
    assert len(landed) == 6 and landed[0] and not any("array" in types for types in landed[1::2])


def test_groups_of_large_rows_are_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_path", lambda *_: str(tmp_path / "pages"))
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(150)), lambda k: F.sha2(F.concat_ws(" ", "id", k), 256)))
    large = spark.range(0, 1000, 1, 1).select("id", text.alias("payload"))
    assert session.land(large, "pages", 1 << 20).count() == 1000
    (file,) = (tmp_path / "pages").glob("*.parquet")
    held = ParquetFile(file).metadata
    assert max(held.row_group(k).num_rows for k in range(held.num_row_groups)) <= 250


def test_school_categories(spark, rows):
    feed = FEEDS["school"]
    page, end = (json.dumps({"dataSearch": {"content": x}}) for x in ([{"seq": "1"}], []))
    answers = [("school", c, n, p) for c in (*feed.categories, "other") for n, p in ((1, page), (2, end))]
    assert parse_feed(feed, spark.createDataFrame(answers, PAYLOADS)).count() == 5
    with pytest.raises(MissingPages, match="1 feeds"):
        parse_feed(feed, spark.createDataFrame(answers[2:], PAYLOADS))


@pytest.mark.parametrize(
    "numbers, sizes, whole",
    [
        ((1, 2, 3), (2, 1, 0), True),
        ((1,), (0,), True),
        ((1, 2, 3, 4), (2, 1, 0, 0), True),
        ((1, 2), (2, 1), False),  # no end page
        ((1, 3), (2, 0), False),  # a hole
        ((2, 3), (2, 0), False),  # the first page is missing
        ((1, 2, 3), (2, 0, 1), False),  # rows after the end page
        ((1, 2, None), (2, 0, 1), False),
        ((), (), False),
    ],
)
def test_every_page_up_to_the_end(spark, numbers, sizes, whole):
    answers = [("f", None, n, json.dumps({"data": [{"a": "1"}] * k})) for n, k in zip(numbers, sizes)]
    df = spark.createDataFrame(answers, PAYLOADS)
    if whole:
        assert json_pages(df, ["a"], "data", first_page=1).count() == sum(sizes)
    else:
        with pytest.raises(MissingPages):
            json_pages(df, ["a"], "data", first_page=1)


def test_the_newest_answer_ends_a_feed(spark):
    df = attempts(spark, (1, 1, {"data": []}), (1, 2, {"data": [{"a": "1"}]}))
    with pytest.raises(MissingPages):
        json_pages(df, ["a"], "data", first_page=1)
    df = attempts(spark, (1, 1, {"data": [{"a": "1"}]}), (1, 2, {"data": []}))
    assert json_pages(df, ["a"], "data", first_page=1).count() == 0


def test_xml_end_page(spark):
    page, end = (f"<response><body><items>{x}</items></body></response>" for x in ("<item><a>1</a></item>", ""))
    assert xml_pages(pages(spark, page, end), ["a"], first_page=0).count() == 1
    with pytest.raises(MissingPages):
        xml_pages(pages(spark, page), ["a"], first_page=0)


def test_binary_payloads(spark, rows):
    answers = [("f", 1, bytearray('{"data":[{"a":"서울"}]}'.encode())), ("f", 2, bytearray(b'{"data":[{"a":"\xff"}]}'))]
    df = spark.createDataFrame(answers, "feed string, page_no int, payload binary")
    assert rows(json_pages(df.where("page_no = 1"), ["a"], "data")) == [("서울",)]
    assert rows(rejected_json_pages(df, "data"), "page_no") == [(2,)]


def test_no_payloads(spark):
    assert json_pages(spark.createDataFrame([], PAYLOADS), ["a"], "data").collect() == []


def test_category_union_keeps_duplicates(spark, rows):
    one = spark.createDataFrame([(1,), (1,)], "a int")
    assert rows(category_union({"x": one, "y": one})) == [(1,)] * 4
    assert rows(category_union({"x": one, "y": one}, "c")) == [(1, "x"), (1, "x"), (1, "y"), (1, "y")]
    with pytest.raises(ValueError):
        category_union({})
