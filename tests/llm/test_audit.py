import itertools
import random
import re

import pytest

from odd import ODD_ROWS
from millrace.llm.audit import audit_filters, audit_orders, mask_cells, walk_orders

WORDS = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def failed(rows):
    """Letters that each (id, text) fails, in plain Python."""
    firsts = {}
    for key, text, *_ in rows:
        if key is not None:
            firsts[text or ""] = min(key, firsts.get(text or "", key))
    out = []
    for key, text, *_ in rows:
        text = text or ""
        words = WORDS.findall(text)
        letters = "A" if len(words) < 50 else ""
        letters += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        letters += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        letters += "D" if re.search("[#$%&*|]", text) else ""
        letters += "E" if key is not None and key > firsts[text] else ""
        out.append(letters)
    return out


def brute_force(rows, labels):
    """Every order applied document by document."""
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    out = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], f) for r, f in zip(rows, failed(rows)) if (r[2] or "") == part]
        removed_in_all = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                removed_in_all[letter] += len(gone)
                fails = sum(letter in f for _, f in docs)
                out[part, "".join(order), step] = (
                    len(left),
                    len(gone),
                    fails - len(gone),
                    sum(f == letter for _, f in docs),
                    sum(k in good for k, _ in gone),
                    sum(k in toxic for k, _ in gone),
                    letter,
                )
        for key in [k for k in out if k[0] == part]:
            out[key] = (*out[key][:6], removed_in_all[out[key][6]])
    return out


def as_dict(df):
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in rows
    }


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_odd_rows_against_brute_force(spark, odd_docs):
    # two labels of one document, a null id, null labels, a document that is not there
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (None, 1, 1), (6, None, None), (9, 1, None), (77, 1, 1)]
    got = as_dict(audit_filters(odd_docs, label_frame(spark, labels)))
    assert got == brute_force(ODD_ROWS, [x for x in labels if x[0] is not None])
    assert len(got) == 600 * 5


def test_random_rows_against_brute_force(spark):
    rnd = random.Random(5)
    words = ["Alpha", "beta", "GAMMA", "delta", "eps#", "zeta", "eta"] + [f"word{k}" for k in range(60)]
    texts = [" ".join(rnd.choices(words[: rnd.choice([7, 67])], k=rnd.choice([3, 60, 80]))) for _ in range(40)]
    rows = [(k, rnd.choice(texts), rnd.choice(["x", "y", None, ""])) for k in range(200)]
    rnd.shuffle(rows)
    labels = [(k, rnd.randint(0, 1), rnd.randint(0, 1)) for k in range(0, 200, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert as_dict(audit_filters(docs, label_frame(spark, labels))) == brute_force(rows, labels)


def test_copies_of_one_text_in_many_parts(spark):
    rows = [(k, "same text", f"part {k % 7}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = as_dict(audit_filters(docs, label_frame(spark, [])))
    assert got == brute_force(rows, [])


def test_no_documents_and_no_labels(spark, odd_docs):
    none = label_frame(spark, [])
    assert audit_filters(odd_docs.limit(0), none).count() == 0
    got = as_dict(audit_filters(odd_docs, none))
    assert got == brute_force(ODD_ROWS, [])


def test_parts_without_failures_have_zeros(spark):
    masks = spark.createDataFrame([("a", 0, True, False)], "part string, mask int, good boolean, toxic boolean")
    got = as_dict(audit_orders(mask_cells(masks), "AB"))
    assert got == {("a", o, s): (1, 0, 0, 0, 0, 0, 0) for o in ("AB", "BA") for s in (1, 2)}


def test_the_walk_is_bounded_by_the_filters(spark):
    cells = spark.createDataFrame([(str(p), m) for p in range(50) for m in range(32)], "part string, mask int")
    walk = walk_orders(cells, "ABCDE").collect()
    assert len(walk) == 325 * 32
    assert len({w.prefix for w in walk}) == 325 and all(len(set(w.prefix)) == w.step == len(w.prefix) for w in walk)
    assert all(w.letter == w.prefix[-1] and w.removed + w.redundant == (w.mask >> "ABCDE".index(w.letter) & 1) for w in walk)
    with pytest.raises(ValueError):
        walk_orders(cells, "ABCDEFG")
