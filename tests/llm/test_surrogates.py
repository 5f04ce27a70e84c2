import itertools
import re
import string

import pytest

from millrace.llm.pii import distinct_surrogates, replace_personal_data


def masked(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in replace_personal_data(docs, "k").orderBy("doc_id").collect()]


def mod97(iban):
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


@pytest.mark.parametrize(
    "phone,code",
    [("+82-2-1234-5678", "+82"), ("+44 20 7946 0958", "+44"), ("+1 (212) 555-0100", "+1"), ("+353 1 234 5678", "+353"), ("+7 495 123 45 67", "+7")],
)
def test_phones_keep_country_and_format(spark, phone, code):
    (text,) = masked(spark, f"call {phone} now")
    got = text.removeprefix("call ").removesuffix(" now")
    assert got != phone and got.startswith(code) and re.sub("[0-9]", "0", got) == re.sub("[0-9]", "0", phone)


def test_ibans_stay_valid(spark):
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606"]
    for iban, text in zip(ibans, masked(spark, *[f"to {i}." for i in ibans])):
        got = text.removeprefix("to ").removesuffix(".")
        assert got != iban and got[:2] == iban[:2] and mod97(iban) == mod97(got) == 1
        assert re.sub("[0-9]", "0", re.sub("[A-Z]", "A", got)) == re.sub("[0-9]", "0", re.sub("[A-Z]", "A", iban))


def test_names_after_titles_without_gender(spark):
    one, two = masked(spark, "Dr. Anna Miller and Prof. Miller met", "then Mr Miller left")
    assert "Anna" not in one and "Miller" not in one + two
    last = re.search(r"Dr\. \w+ (\w+)", one).group(1)
    assert f"Prof. {last}" in one and f"Mr {last}" in two


def test_short_addresses_never_run_out(spark):
    names = ["".join(p) for p in itertools.islice(itertools.product(string.ascii_lowercase, repeat=2), 600)]
    entities = spark.createDataFrame([("email", f"{n[0]}@{n[1]}.io") for n in names], "kind string, canonical string")
    got = distinct_surrogates(entities, "k").collect()
    assert len(got) == len({r.surrogate for r in got}) == 600
    assert not {r.surrogate for r in got} & {r.canonical for r in got}
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.io", r.surrogate) for r in got)
    texts = masked(spark, *[f"{n[0].upper()}@{n[1]}.io" for n in names])
    assert len(set(texts)) == 600


def test_names_of_all_kinds_have_surrogates_of_their_own(spark):
    rows = [(kind, f"name{k}") for kind in ("male", "female", "first", "last") for k in range(40)]
    got = distinct_surrogates(spark.createDataFrame(rows, "kind string, canonical string"), "k").collect()
    assert len(got) == len({r.surrogate for r in got}) == 160


def test_long_and_repeated_texts(spark):
    long_ = "plain words " * 20_000 + "mail a.person@site.org end"
    one, two, three = masked(spark, long_, long_, "mail A.Person@site.org")
    assert one == two and "a.person@site.org" not in one and len(one) == len(long_)
    assert three.split(" ")[1].lower() == one.split(" ")[-2]
