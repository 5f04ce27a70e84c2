import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from odd import ODD_ROWS
from millrace.llm.windows import _tail, pack_windows, window_ids
from millrace.llm.wordids import WordIds, byte_slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
OTHER = public_tokenizers.path("word_bpe_49k.json")


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def check_pieces(rows, limit, expected, powers=True):
    """The pieces of each sequence join gapless, documents rebuild, all but the rest is full."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        assert r.length >= 1 and len(r.ids) == 4 * r.length and r.ids_crc32 == zlib.crc32(r.ids)
    assert sorted(sequences) == list(range(len(sequences)))
    lengths = []
    for number in sorted(sequences):
        at = 0
        for r in sorted(sequences[number], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    total = sum(lengths)
    assert lengths[: total // limit] == [limit] * (total // limit)
    rest = lengths[total // limit :]
    if powers:
        assert all(n & (n - 1) == 0 for n in rest) and len(set(rest)) == len(rest)
    else:
        assert rest == ([total % limit] if total % limit else [])
    # pieces of a document follow each other in the concatenation
    found, open_doc = [], None
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        if r.start == 0:
            open_doc = [r.doc_id, r.doc_tokens, b""]
            found.append(open_doc)
        assert open_doc[0] == r.doc_id and len(open_doc[2]) == 4 * r.start
        open_doc[2] += r.ids
    assert all(len(ids) == 4 * n for _, n, ids in found)
    assert sorted(((str(k), ids) for k, _, ids in found)) == sorted((str(k), ids) for k, ids in expected)


@pytest.mark.parametrize("limit", [1, 7, 64, 1024, 1 << 20])
@pytest.mark.parametrize("powers", [True, False])
def test_odd_rows_round_trip(odd_docs, limit, powers):
    expected = [(r[0], np.asarray([*library_ids(PATH, r[1]), 0], dtype="<u4").tobytes()) for r in ODD_ROWS]
    packed = pack_windows(odd_docs, PATH, limit, with_ids=True, powers=powers).collect()
    check_pieces(packed, limit, expected, powers)


def test_many_partitions_with_empty_ones(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(rnd.choices(["alpha", "Beta", "gamma", "x1"], k=rnd.choice([0, 1, 5, 400])))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(40, "doc_id")
    expected = [(k, np.asarray([*library_ids(PATH, t), 0], dtype="<u4").tobytes()) for k, t in rows]
    check_pieces(pack_windows(docs, PATH, 128, with_ids=True).collect(), 128, expected)


def test_without_broadcast(monkeypatch, odd_docs):
    monkeypatch.setattr("millrace.llm.windows.MOST_BROADCAST", 0)
    expected = [(r[0], np.asarray([*library_ids(PATH, r[1]), 0], dtype="<u4").tobytes()) for r in ODD_ROWS]
    check_pieces(pack_windows(odd_docs, PATH, 64, with_ids=True).collect(), 64, expected)


def test_sequences_hold_their_pieces(odd_docs):
    pieces = pack_windows(odd_docs, PATH, 64, with_ids=True)
    sequences = {r.sequence_id: r for r in window_ids(pieces).collect()}
    by_sequence = {}
    for r in pieces.collect():
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(sequences) == set(by_sequence)
    for k, rows in by_sequence.items():
        assert bytes(sequences[k].ids) == b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.offset))
        assert 4 * sequences[k].length == len(sequences[k].ids)


def test_empty_table(odd_docs):
    assert pack_windows(odd_docs.limit(0), PATH).count() == 0


def test_tail():
    assert _tail(0, 1024, True) == [] == _tail(2048, 1024, True)
    assert _tail(1024 + 11, 1024, True) == [1024, 1032, 1034]
    assert _tail(1024 + 11, 1024, False) == [1024]


@pytest.mark.parametrize("path", [PATH, OTHER])
def test_word_ids_equal_the_library(monkeypatch, path):
    monkeypatch.setattr("millrace.llm.wordids.MEMO_WORDS", 200)
    rnd = random.Random(1)
    letters = [*"ab 's\n\t1.　\xa0\x1c\x85 é日<|>\x00", "<|endoftext|>", "<|startoftext|>", "  ", "don't", " "]
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 30))) for _ in range(1500)]
    texts += [None, "", "x" * 5000, "word " * 3000, "<|endoftext|" + "<|endoftext|>"]
    found, library = WordIds(path), Tokenizer.from_file(path)
    for a, b in byte_slices(pa.array(texts), 4000):
        ids, bounds = found.encode(pa.array(texts[a:b]))
        for k, text in enumerate(texts[a:b]):
            own = ids[bounds[k] : bounds[k + 1]].tolist()
            assert own == library.encode(text or "", add_special_tokens=False).ids, text


def test_word_ids_of_a_sliced_array():
    texts = pa.array(["skipped", "some words", None, "more words"])
    ids, bounds = WordIds(PATH).encode(texts.slice(1, 2))
    assert ids[bounds[0] : bounds[1]].tolist() == library_ids(PATH, "some words") and bounds.tolist()[1:] == [len(ids)] * 2
