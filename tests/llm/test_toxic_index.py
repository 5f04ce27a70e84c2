import math
import pickle
import random

import numpy as np
import pytest

from millrace.llm import toxicity
from millrace.llm.toxicity import BLOCK, FIRST_BLOCKS, NEIGHBOURS, PRIOR, ExampleIndex, TermCounter, _digest, _reduced, _term_hash, score_toxicity, term_counts


def random_texts(rnd, count):
    words = [f"{a}{b}{c}" for a in ("kal", "mor", "tib", "sen", "dro") for b in ("e", "una", "irod", "ast") for c in ("", "s", "ling", "ter")]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [" ".join(rnd.choices(words, weights, k=rnd.randint(2, 40))) for _ in range(count)]


@pytest.fixture(scope="module")
def made():
    rnd = random.Random(11)
    texts = random_texts(rnd, 900)
    texts[10:14] = [texts[9]] * 4
    terms = sorted({t for x in texts for t in term_counts(x)}, key=_term_hash)
    hashes = np.array([_term_hash(t) for t in terms], dtype=np.uint64)
    idf = np.array([1 + rnd.random() * 5 for _ in terms])
    rows = [(k, int(k % 3 == 0), d, t, n) for k, (t, n, d) in enumerate(_reduced(hashes, texts))]
    return texts, terms, ExampleIndex(hashes, idf, rows, (2.0, 1.0)), random_texts(rnd, 150) + [texts[9], "", "unknown words"]


def vector(text, terms, idf):
    found = {t: n for t, n in term_counts(text).items() if t in terms}
    v = {t: (1 + math.log(n)) * idf[terms[t]] for t, n in found.items()}
    norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return {t: x / norm for t, x in v.items()}


def test_neighbours_by_blocks_are_those_of_every_example(made):
    texts, terms, index, queries = made
    number = {t: k for k, t in enumerate(terms)}
    vectors = [vector(x, number, index.idf) for x in texts]
    index = pickle.loads(pickle.dumps(index))
    got = index.nearest(_reduced(index.hashes, queries))
    for query, near in zip(queries, got):
        q = vector(query, number, index.idf)
        every = {k: sum(x * v.get(t, 0.0) for t, x in q.items()) for k, v in enumerate(vectors) if texts[k] != query}
        want = sorted((c for c in every.values() if c > 1e-12), reverse=True)[:NEIGHBOURS]
        assert np.allclose([s for s, _ in near], want, atol=1e-9)
        assert np.allclose([every[index.ids[n]] for _, n in near], want, atol=1e-9)
    assert -(-len(texts) // BLOCK) > FIRST_BLOCKS and got[-1] == [] == got[-2]


def test_blocks_are_skipped(made, monkeypatch):
    texts, _, index, queries = made
    index.nearest(_reduced(index.hashes, queries))
    monkeypatch.setattr(toxicity, "NEIGHBOURS", 1)
    touched = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, (int, np.integer)):
                touched.append(int(at))
            return np.asarray(super().__getitem__(at))

    index.by_block, plain = index.by_block.view(Watched), index.by_block
    try:
        (near,) = index.nearest(_reduced(index.hashes, [texts[50] + " another"]))
    finally:
        index.by_block = plain
    assert near[0][0] > 0.99
    assert FIRST_BLOCKS <= len(touched) < len(plain)


def test_vote_and_score_in_plain_python(made):
    texts, terms, index, queries = made
    index.calibrate(index.votes(_reduced(index.hashes, texts)), [int(k % 3 == 0) for k in range(len(texts))])
    a, b = index.line
    toxic, clean = sum(k % 3 == 0 for k in range(900)), sum(k % 3 != 0 for k in range(900))
    prior = toxic * 1.0 / (toxic * 1.0 + clean * 2.0)
    reduced = _reduced(index.hashes, queries)
    for near, (score, evidence) in zip(index.nearest(reduced), index.score(reduced)):
        assert evidence == [index.ids[n] for _, n in near]
        if not near:
            assert score == index.unknown
            continue
        for_ = PRIOR * prior + sum(s * s * 1.0 for s, n in near if index.ids[n] % 3 == 0)
        all_ = PRIOR + sum(s * s * (1.0 if index.ids[n] % 3 == 0 else 2.0) for s, n in near)
        p = min(max(for_ / all_, 1e-4), 1 - 1e-4)
        assert score == pytest.approx(1 / (1 + math.exp(-(a * math.log(p / (1 - p)) + b))), abs=1e-9)


def test_counter_equals_term_counts(made):
    texts, terms, index, _ = made
    number = {t: k for k, t in enumerate(terms)}
    odd = ["", None, "Mixed-CASE kals;molINGs tib_senast", "kal " * 500, "日本 kale", *texts[:50]]
    counter = TermCounter(index.hashes)
    counter.MEMO = 20
    for _ in range(2):
        got = [dict(zip(terms.tolist(), counts.tolist())) for terms, counts in counter(odd)]
        assert got == [{number[t]: n for t, n in term_counts(x).items() if t in number} for x in odd]
    assert len({_digest(x) for x in odd[2:6]}) == 4


def test_text_ids_are_evidence(spark):
    rows = [(f"d{k}", "vile words here" if k % 4 == 0 else "kind words there", "x", 5) for k in range(80)] + [(None, None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, score string, evidence int")
    labels = spark.createDataFrame([(f"d{k}", int(k % 4 == 0)) for k in range(60)], "doc_id string, toxic int")
    got = score_toxicity(docs, labels).collect()
    assert len(got) == 81 and all(isinstance(e, str) for r in got for e in r.evidence)


def test_terms_by_arrays_are_those_of_the_pattern(monkeypatch):
    """Slices cut between words, letters beyond the basic plane, characters that grow or change in lower case."""
    monkeypatch.setattr(toxicity, "SLICE", 7)
    texts = ["İstanbul STRASSE straße ΟΔΥΣΣΕΥΣ", None, "", "a_b c1d2é ǅ 𝒳𝒴abcdefg 日本語テキスト", "x" * 50 + "\n" + "́word next", "  "]
    found = [{} for _ in texts]
    for owner, hashes in toxicity._hashed(texts):
        for k, h in zip(owner.tolist(), hashes.tolist()):
            found[k][h] = found[k].get(h, 0) + 1
    assert found == [{_term_hash(t): n for t, n in term_counts(x).items()} for x in texts]


def test_a_counter_does_not_grow_with_the_words_it_meets(made):
    """A worker's memory is bounded by the index, not by the words of its texts."""
    counter = TermCounter(made[2].hashes)
    size = len(pickle.dumps(counter))
    rnd = random.Random(5)
    counter([" ".join("".join(rnd.choices("abcdefghij", k=12)) for _ in range(500)) for _ in range(20)])
    assert len(pickle.dumps(counter)) == size


def test_unfolding_in_parts_leaves_a_workers_words_behind(made, monkeypatch):
    """The index is the same whatever the parts; tables of words that packing left in the worker are emptied."""
    from types import SimpleNamespace

    from millrace.llm import wordids

    index = pickle.loads(pickle.dumps(made[2]))
    queries = _reduced(index.hashes, made[3][:40])
    whole = index.nearest(queries)
    encoder = SimpleNamespace(young={b"a": b"1"}, old={b"b": b"2"}, parts={"c": b"3"})
    monkeypatch.setitem(wordids._WORD_IDS, "made", encoder)
    monkeypatch.setattr(toxicity, "POSTINGS", 97)
    index = pickle.loads(pickle.dumps(index))
    assert [[n for _, n in near] for near in index.nearest(queries)] == [[n for _, n in near] for near in whole]
    assert not (encoder.young or encoder.old or encoder.parts)


def test_rows_that_stay_are_scored_without_a_second_text(spark):
    rows = [(k, "vile words here" if k % 4 == 0 else "kind words there", "s") for k in range(60)] + [(60, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(60)], "doc_id bigint, toxic int")
    left = toxicity.without_toxic(docs, labels)
    stay = {r.doc_id for r in score_toxicity(docs, labels).collect() if not r.predicted}
    assert sorted(map(tuple, left.collect())) == sorted(r for r in rows if r[0] in stay)
    assert left.columns == docs.columns and "__text" not in left._jdf.queryExecution().executedPlan().toString()


def test_the_driver_keeps_nothing_of_the_index(spark, monkeypatch):
    """What fitting broadcast is destroyed, not only its copies on executors; memory is given back when the index is gone."""
    import os
    import weakref

    sent, indexes, alive = [], [], []
    context = type(spark.sparkContext)
    broadcast = context.broadcast

    def recorded(self, value):
        sent.append(broadcast(self, value))
        if isinstance(value, ExampleIndex):
            indexes.append(weakref.ref(value))
        return sent[-1]

    monkeypatch.setattr(context, "broadcast", recorded)
    monkeypatch.setattr(toxicity, "give_back", lambda: alive.append([x() is not None for x in indexes]))
    rows = [(k, "vile words here" if k % 4 == 0 else "kind words there", "s") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(60)], "doc_id bigint, toxic int")
    left = toxicity.without_toxic(docs, labels)
    assert [os.path.exists(x._path) for x in sent] == [False, False, True]
    assert alive[-1] == [False, False]
    assert left.count() < 60


def test_an_unfolded_index_holds_each_posting_once(made):
    """The postings of frequent terms stand by block and not in the lists, too."""
    index = pickle.loads(pickle.dumps(made[2]))
    index.nearest(_reduced(index.hashes, made[3][:3]))
    assert len(index.postings) == int(index.sizes[index.place < 0].sum())
    assert np.count_nonzero(index.by_block) + len(index.postings) == len(index.numbers)
    # a worker holds no second copy of a batch's texts
    held = type("Held", (), {"value": index})
    texts = toxicity.pa.RecordBatch.from_pydict({"a": list(range(600)), "t": ["vile words"] * 600})
    got = list(toxicity._scored(held, "t", False, toxicity.pa.int64())(iter([texts])))
    assert [b.num_rows for b in got] == [256, 256, 88] and got[0].schema.names == ["a", "score", "evidence"]


def test_rows_of_any_type_pass_the_scoring(spark):
    rows = [(k, "vile words" if k % 4 == 0 else "kind words", [k], None) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, many array<int>, day date").selectExpr("doc_id", "text", "array(doc_id) AS sure", "many", "day")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(40)], "doc_id bigint, toxic int")
    left = toxicity.without_toxic(docs, labels)
    assert {r.doc_id: (r.sure, r.many, r.day) for r in left.collect()}.items() <= {r[0]: ([r[0]], r[2], None) for r in rows}.items()
    assert left.columns == docs.columns


def test_vectors_put_together_in_parts_are_whole(made, monkeypatch):
    """Each example's terms and weights stand in the order of the terms' numbers, whatever the parts."""
    monkeypatch.setattr(toxicity, "POSTINGS", 61)
    index = pickle.loads(pickle.dumps(made[2]))
    index._unfold()
    term = np.repeat(np.arange(len(index.sizes)), index.sizes.astype(np.int64))
    order = np.argsort(index.numbers, kind="stable")
    assert index.terms.tolist() == index.rank[term[order]].tolist()
    assert np.allclose([np.square(index.weights[a:b]).sum() for a, b in zip(index.begin[:-1], index.begin[1:]) if b > a], 1)


def test_slices_of_packing_do_not_change_pieces():
    from millrace.llm import packing
    from millrace.llm.queries import TOKENIZER

    texts = ["one two three", None, "", "four " * 90, "fiveé six", "seven"]
    batch = toxicity.pa.RecordBatch.from_pydict({"i": list(range(6)), "t": texts})
    cut = [[r for b in packing._cut(TOKENIZER, 1, 64, True, size)(iter([batch])) for r in b.to_pylist()] for size in (1, 40, 1 << 20)]
    assert cut[0] == cut[1] == cut[2] and len(cut[0]) > 6
