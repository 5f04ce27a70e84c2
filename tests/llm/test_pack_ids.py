import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.packing import bin_completion, lower_bound, pack_documents
from odd import ODD_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("limit", [5, 4096])
def test_pieces_hold_the_ids_of_the_library(odd_docs, limit):
    library = Tokenizer.from_file(PATH)
    want = []
    for key, text, *_ in ODD_ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), limit)):
            data = np.asarray(ids[at : at + limit], dtype="<u4").tobytes()
            want.append((key, piece, at, len(data) // 4, zlib.crc32(data), data))
    got = pack_documents(odd_docs, PATH, limit, with_ids=True).collect()
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit


def fewest(lengths, capacity):
    """The least number of bins, by trying all ways to put each piece into an open bin or a new one."""
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms) if r >= lengths[k]}.values():
            place(k + 1, [r - lengths[k] if j == i else r for j, r in enumerate(rooms)])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_small_cases_take_the_fewest_sequences():
    rnd = random.Random(9)
    for _ in range(120):
        capacity = rnd.choice([10, 30, 100])
        lengths = sorted((rnd.randint(capacity // 8 + 1, capacity * 2 // 3) for _ in range(rnd.randint(1, 9))), reverse=True)
        bins = bin_completion(lengths, capacity)
        assert sorted(itertools.chain(*bins)) == list(range(len(lengths)))
        assert all(sum(lengths[k] for k in one) <= capacity for one in bins)
        assert len(bins) == fewest(lengths, capacity) >= lower_bound(lengths, capacity)


def test_a_task_returns_its_memory_and_encodes_little_at_a_time(monkeypatch):
    """Pieces are the same whatever the slices; a worker's free memory goes back when a task's rows are through."""
    import pyarrow as pa

    from millrace.llm import common, packing, wordids
    from millrace.llm.queries import TOKENIZER

    rnd = random.Random(9)
    texts = [" ".join(rnd.choices(["one", "Two,", "three's", "日本", "4-5"], k=rnd.choice([0, 1, 300, 9000]))) for _ in range(40)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(41)), pa.array(texts)], ["__id", "__text"])
    seen, taken = [], packing.byte_slices
    monkeypatch.setattr(packing, "byte_slices", lambda *a: seen.append(list(taken(*a))) or seen[-1])
    returned = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: type("Libc", (), {"malloc_trim": staticmethod(returned.append)}))
    got = []
    for size in (packing.SLICE_BYTES, 5000):
        monkeypatch.setattr(packing, "SLICE_BYTES", size)
        tables = list(common.tidied(packing._cut(TOKENIZER, 1, 4096, False))(iter([batch])))
        got.append(pa.Table.from_batches(tables).to_pylist())
    assert got[0] == got[1] and len(seen[0]) == 1 < len(seen[1]) and returned == [0, 0]
    assert TOKENIZER in wordids._WORD_IDS
    wordids.forget_words()
    assert not wordids._WORD_IDS


def test_a_worker_holds_each_word_once():
    """Words that are whole stretches aren't kept as parts too, and the tables of the toxicity stage are dropped."""
    import pyarrow as pa

    from millrace.llm import packing, toxicity, wordids

    wordids.forget_words()
    list(toxicity._hashed(["some words"]))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["plain words, twice-told words"])], ["__id", "__text"])
    list(packing._cut(PATH, 1, 4096, False)(iter([batch])))
    encoder = wordids.word_ids(PATH)
    assert {b"plain", b"words"} <= set(encoder.young) and "plain" not in encoder.parts and "words" in encoder.parts
    assert toxicity._characters.cache_info().currsize == 0 and not toxicity._COUNTERS
