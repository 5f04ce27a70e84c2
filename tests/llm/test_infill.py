import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import ODD_ROWS
from millrace.llm.infill import CHAR, LINE, UNITS, WORD, Boundaries, WaveletMatrix, fill_in_middle, restored

WHITE = " \t\n\x0b\x0c\r"


def units_of(text, unit):
    """The pieces a unit cuts a text into; what comes before the first word belongs to it."""
    if unit == "chars":
        return list(text)
    if unit == "lines":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    words = re.findall(rf"[^{WHITE}]+[{WHITE}]*", text)
    if words:
        words[0] = text[: len(text) - len("".join(words))] + words[0]
    return words


def expected(key, text, unit="chars", seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    pieces = units_of(text, unit)
    n = len(pieces)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (n, "plain", None, None, text)
    prefix, middle = "".join(pieces[:a]), "".join(pieces[a:b])
    suffix = text[len(prefix) + len(middle) :]
    if h4 % 100 < 20:
        return (n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def random_rows(count, seed=2):
    rnd = random.Random(seed)
    letters = [*"abc  \n\n\té日　<>PSM", "\U0001f600", "́", "<P>", "\r\n"]
    return [(k, "".join(rnd.choices(letters[:-2] if k % 9 else letters, k=rnd.choice([0, 1, 2, 9, 300])))) for k in range(count)]


@pytest.mark.parametrize("unit", list(UNITS))
def test_against_plain_python(spark, odd_docs, unit):
    rows = random_rows(600)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = docs.unionByName(odd_docs.select("doc_id", "text"))
    got = fill_in_middle(table, unit).withColumn("back", restored(F.col("output"), F.col("form")))
    found = [(r.doc_id, r.text, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.back) for r in got.collect()]
    want = [(r[0], r[1] or "", expected(r[0], r[1], unit), r[1] or "") for r in [*rows, *ODD_ROWS]]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert {f[2][1] for f in found} == {"plain", "psm", "spm"}


def test_empty_table_and_unknown_unit(odd_docs):
    assert fill_in_middle(odd_docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(odd_docs, "pages")


def test_shares_of_the_forms(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    shares = {r.form: r["count"] / 4000 for r in fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(shares["plain"] - 0.1) < 0.02 and abs(shares["spm"] - 0.18) < 0.03
    none = {r.form for r in fill_in_middle(docs, plain_percent=0, spm_percent=0).select("form").distinct().collect()}
    assert none == {"psm"}


def test_wavelet_matrix_counts_symbols():
    rng = np.random.default_rng(4)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for symbol in range(8):
            want = np.concatenate(([0], np.cumsum(symbols == symbol)))
            assert matrix.rank(symbol, at).tolist() == want.tolist()


def test_boundaries_are_found_by_bisection():
    texts = [t for _, t in random_rows(80, 6)] + ["", "  lead", "a\nb\n"]
    held = [t.encode() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in held]))).astype(np.int64)
    found = Boundaries(np.frombuffer(b"".join(held), dtype=np.uint8), bounds)
    for unit, kind in (("chars", CHAR), ("words", WORD), ("lines", LINE)):
        pieces = [units_of(t, unit) for t in texts]
        assert found.counts(kind).tolist() == [len(p) for p in pieces]
        for share in (0.0, 0.3, 1.0):
            units = np.asarray([int(len(p) * share) for p in pieces])
            want = [len("".join(p[:k]).encode()) for p, k in zip(pieces, units.tolist())]
            whole = [k == len(p) for p, k in zip(pieces, units.tolist())]
            got = (found.locate(kind, units) - bounds[:-1]).tolist()
            assert [g for g, w in zip(got, whole) if not w] == [x for x, w in zip(want, whole) if not w]
