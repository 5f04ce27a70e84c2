from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.cleaning import blank_to_null, decrypt_columns, fixed_columns, strip_nul
from millrace.functions.dates import compact_date, kst_date, name_suffix_date

KEY = b"k" * 16


def test_strip_nul(spark):
    df = spark.createDataFrame([("\x00a", 1), ("a\x00b", 2), ("b\x00", 3), (None, 4), ("\x00", 5)], "s string, n int")
    assert [r.s for r in strip_nul(df).orderBy("n").collect()] == ["a", "ab", "b", None, ""]
    assert strip_nul(df).dtypes == df.dtypes


def test_strip_nul_named_columns_only(spark):
    df = spark.createDataFrame([("\x00a", "\x00b")], "a string, b string")
    assert tuple(strip_nul(df, ["a"]).first()) == ("a", "\x00b")


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", 0), (" ", 1), (None, 2)], "s string, n int")
    assert [r.s for r in blank_to_null(df).orderBy("n").collect()] == [None, " ", None]


def test_fixed_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    assert fixed_columns(df, ["missing", "a"]).first().asDict() == {"missing": None, "a": 1}


@pytest.mark.parametrize("binary", [True, False])
def test_decrypt(spark, binary):
    cipher = F.aes_encrypt("tel", F.lit(bytearray(KEY)))
    df = spark.createDataFrame([("010-1234",), (None,)], "tel string")
    df = df.withColumn("enc", cipher if binary else F.base64(cipher))
    assert all(r.tel == r.dec for r in decrypt_columns(df, {"enc": "dec"}, KEY).collect())


def test_decrypt_key_from_a_column(spark):
    df = spark.createDataFrame([("x", bytearray(KEY))], "tel string, key binary")
    df = df.withColumn("enc", F.aes_encrypt("tel", "key"))
    assert decrypt_columns(df, {"enc": "dec"}, F.col("key")).first().dec == "x"


def test_wrong_cipher_text(spark):
    df = spark.createDataFrame([("AAAA",), ("not base64!",)], "enc string")
    assert [r.dec for r in decrypt_columns(df, {"enc": "dec"}, KEY, strict=False).collect()] == [None, None]
    with pytest.raises(Exception):
        decrypt_columns(df, {"enc": "dec"}, KEY).collect()


def test_business_date(spark):
    rows = [(datetime(2024, 1, 1, 14, 59, 59),), (datetime(2024, 1, 1, 15, 0),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(kst_date("ts").alias("d"))
    assert [r.d for r in df.collect()] == [date(2024, 1, 1), date(2024, 1, 2), None]


def test_dated_names(spark):
    names = ["t_20240229", "t_20230229", "t_2024022", "t20240229", "a_b_20240101", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(name_suffix_date("n").alias("d"))
    assert [r.d for r in df.collect()] == [date(2024, 2, 29), None, None, None, date(2024, 1, 1), None]
    one = spark.range(1).select(compact_date(F.lit(date(2024, 2, 9))).alias("c"))
    assert one.first().c == "20240209"
