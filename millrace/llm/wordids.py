"""Token ids of many texts at once: every distinct stretch of a batch is looked up or encoded once.

A batch of texts is one array of bytes. White space cuts it into stretches that the tokenizer never joins, Arrow
numbers the distinct ones, a bounded table or the library gives the ids of each, and arrays gather them back.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from millrace.llm.tokens import is_space_free

SLICE_BYTES = 8 << 20
# entries of each of a worker's two tables of encoded stretches, about 200 bytes each, and the longest one kept
MEMO_WORDS = 400_000
MEMO_BYTES = 64
# stretches that go to the library as one text
JOINED = 200
# fixed values: how the two kinds of tokenizers part ASCII text, and texts that try both ways of encoding
BYTE_LEVEL_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
SPACE_FREE_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+"
TRIALS = ["Hello", "don't", "WE'LL", "x=1+22;", "a.b,c!?", "''s", "\x1cq\x00", "~`^_", "Qzx123abc", "(it's)[the]{end}", "\x7f-"]
# fixed values: UTF-8 of the white space beyond ASCII that the pattern of a byte-level tokenizer knows
WIDE_SPACE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f"] + [
    b"\xe3\x80\x80",
    *[bytes((0xE2, 0x80, last)) for last in range(0x80, 0x8B)],
]
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def is_byte_level(path: str) -> bool:
    """Whether a text can be cut before each run of white space with the same ids."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    first = rules.get("pre_tokenizer") or {}
    added = [t["content"] for t in rules.get("added_tokens", [])]
    return (
        first.get("type") == "ByteLevel"
        and first.get("use_regex", True)
        and not first.get("add_prefix_space")
        and not rules.get("normalizer")
        and not any(c.isspace() for content in added for c in content)
        and not any(t.get("lstrip") or t.get("rstrip") for t in rules.get("added_tokens", []))
    )


def _white(data: np.ndarray, wide: bool) -> np.ndarray:
    white = _ASCII_SPACE[data]
    if wide and (data >= 0xC2).any():
        for code in WIDE_SPACE:
            first = np.flatnonzero(data[: len(data) - len(code) + 1] == code[0]) if len(data) >= len(code) else []
            for k in range(1, len(code)):
                first = first[data[first + k] == code[k]] if len(first) else first
            for k in range(len(code)) if len(first) else ():
                white[first + k] = True
    return white


def _byte_characters() -> dict[int, str]:
    """The character that stands for each ASCII byte in a byte-level vocabulary: itself where it is printable, else the
    next one from 256 on."""
    hidden = [b for b in range(128) if not 0x21 <= b <= 0x7E]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}


class WordIds:
    """Ids as the library gives them without added tokens, and where each text's ids end."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.space_free, self.byte_level = is_space_free(path), is_byte_level(path)
        # a stretch that is met moves to the young table; when that is full it becomes the old one
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.mark: tuple[str, int] | None = None
        self.parts: dict[str, bytes] = {}
        self.pattern: re.Pattern | None = None
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            for number, token in self.library.get_added_tokens_decoder().items():
                if token.special and not (token.lstrip or token.rstrip or token.single_word):
                    self.mark = (token.content, number)
        else:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)

        if self.byte_level or self.space_free:
            self._try_parts()

    def _try_parts(self) -> None:
        """Let the library's model encode the parts of ASCII stretches itself, which saves what it does around it, if
        that gives the same ids."""
        self.characters = _byte_characters()
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.lower = self.space_free and self._library_ids(["A"]) == self._library_ids(["a"])
        self.pattern = re.compile(BYTE_LEVEL_PARTS if self.byte_level else SPACE_FREE_PARTS, re.ASCII)
        lead = ["", " ", "\n", "  \t"] if self.byte_level else [""]
        trials = [space + text for space in lead for text in TRIALS]
        own = [self._by_parts(text) for text in trials]
        if own != [np.asarray(ids, dtype="<u4").tobytes() for ids in self._library_ids(trials)]:
            self.pattern = None

    def _by_parts(self, text: str) -> bytes:
        ids = []
        parts = self.pattern.findall(text.lower() if self.lower else text)
        # a stretch of one part stands in the tables of stretches already
        several = len(parts) > 1
        for part in parts:
            known = self.parts.get(part)
            if known is None:
                rest = part[1:]
                if part[0] == " " and rest.isalnum():
                    held = self.characters[0x20] + rest
                else:
                    held = part if part.isalnum() else part.translate(self.characters)
                numbers = [t.id for t in self.library.model.tokenize(held)]
                known = struct.pack(f"<{len(numbers)}I", *numbers)
                if several and len(part) <= MEMO_BYTES:
                    if len(self.parts) >= MEMO_WORDS:
                        self.parts.clear()
                    self.parts[part] = known
            ids.append(known)
        return b"".join(ids)

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        if hasattr(self.library, "encode_batch_fast"):
            return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return self.library.encode(texts, num_threads=1)

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of stretches: by parts where they are ASCII without added tokens, else by the library. There a special
        token between stretches keeps them apart, so one text holds many."""
        texts = [w.decode("utf-8", "replace") for w in words]
        if self.pattern is not None:
            plain = [t.isascii() and not self.added.search(t) for t in texts]
            others = iter(self._by_library([t for t, p in zip(texts, plain) if not p]))
            return [self._by_parts(t) if p else next(others) for t, p in zip(texts, plain)]
        return self._by_library(texts)

    def _by_library(self, texts: list[str]) -> list[bytes]:
        if self.mark is None:
            return [np.asarray(ids, dtype="<u4").tobytes() for ids in self._library_ids(texts)]
        mark, number = self.mark
        out: list[bytes] = []
        for at in range(0, len(texts), JOINED):
            part = texts[at : at + JOINED]
            ids = np.asarray(self._library_ids([mark.join([*part, ""])])[0], dtype="<u4")
            ends = np.flatnonzero(ids == number)
            if len(ends) != len(part):  # a stretch holds the mark itself
                out += [np.asarray(own, dtype="<u4").tobytes() for own in self._library_ids(part)]
                continue
            data, start = ids.tobytes(), 0
            for end in (ends * 4).tolist():
                out.append(data[start:end])
                start = end + 4
        return out

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.young.get, words))
        missing = []
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = ids = self.old.get(words[k])
                if ids is None:
                    missing.append(k)
                else:
                    self._keep(words[k], ids)
        for k, ids in zip(missing, self._encoded([words[k] for k in missing])):
            found[k] = ids
            self._keep(words[k], ids)
        return found

    def _keep(self, word: bytes, ids: bytes) -> None:
        if len(word) <= MEMO_BYTES:
            if len(self.young) >= MEMO_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = ids

    def _stretches(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all stretches, where each begins among them, and the text each belongs to."""
        head = np.zeros(len(data), dtype=bool)
        head[bounds[:-1][np.diff(bounds) > 0]] = True
        if not (self.space_free or self.byte_level):
            begin = np.flatnonzero(head)
            return data, begin, np.searchsorted(bounds, begin, "right") - 1
        white = _white(data, self.byte_level)
        after = np.empty_like(white)
        after[:1], after[1:] = False, white[:-1]
        if self.byte_level:
            begin = np.flatnonzero(head | (white & ~after))
            return data, begin, np.searchsorted(bounds, begin, "right") - 1
        dark = ~white
        begin = np.flatnonzero(dark & (after | head))
        # no text and no slice has as many bytes as 32 bits count
        place = np.cumsum(dark, dtype=np.uint32)[begin] - np.uint32(1)
        return data[dark], place, np.searchsorted(bounds, begin, "right") - 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their bounds: text k has ids[bounds[k]:bounds[k + 1]].

        A null text is an empty one.
        """
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, held = texts.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(held, dtype=np.uint8)[bounds[0] : bounds[-1]] if held else np.empty(0, np.uint8)
        data, begin, owner = self._stretches(data, bounds - bounds[0])
        if not len(begin):
            return np.empty(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        edges = np.append(begin, len(data)).astype(np.int64)
        buffers = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(begin), buffers).dictionary_encode()
        number, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        del data, begin, edges, buffers, coded

        of_word = self._ids_of(words)
        table = np.frombuffer(b"".join(of_word), dtype="<u4")
        sizes = np.fromiter(map(len, of_word), dtype=np.int64, count=len(of_word)) // 4
        del words, of_word
        starts = np.cumsum(sizes) - sizes
        each = sizes[number]
        ends = np.cumsum(each)
        total = int(ends[-1])
        taken = np.repeat(starts[number] - (ends - each), each)
        taken += np.arange(total)
        counts = np.bincount(owner, weights=each, minlength=len(texts)).astype(np.int64)
        return table[taken], np.concatenate(([0], np.cumsum(counts)))


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's encoder of a tokenizer file; it outlives tasks, so its table of words does too."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def forget_words() -> None:
    """Drop the worker's encoders and their tables of words; who needs one again makes it again."""
    for encoder in _WORD_IDS.values():
        encoder.young, encoder.old, encoder.parts = {}, {}, {}
    _WORD_IDS.clear()


def byte_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes, at least one row each."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, k
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
