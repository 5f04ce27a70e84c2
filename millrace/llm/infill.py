"""Fill-in-middle: texts cut at two hashed places and written as prefix, suffix and middle.

A batch of texts is one sequence of bytes. Each byte belongs to a class: whether a character, a word or a line begins
there. A wavelet matrix over the classes counts any of them before any place (rank), and sums of ranks count the
boundaries of a unit. Bisection on these counts finds the byte at which a given number of units ends, for
all documents of the batch at once. Cutting and joining stay with Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship_package
from millrace.llm.wordids import byte_slices

# fixed values: the marks of the parts, and forms
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# bits of a byte's class
CHAR, WORD, LINE = 1, 2, 4
UNITS = {"chars": CHAR, "words": WORD, "lines": LINE}
CUTS = "struct<n:bigint,first_chars:bigint,second_chars:bigint,first_byte:bigint,second_byte:bigint>"


class RankBits:
    """Number of set bits before any place, in 64-bit words with running counts."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of each symbol of a sequence, one ``RankBits`` per bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[RankBits, int]] = []
        for shift in range(bits - 1, -1, -1):
            ones = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((RankBits(ones), len(symbols) - int(np.count_nonzero(ones))))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` comes before each place."""
        low, high = np.zeros_like(at), at
        for level, (bits, zeros) in enumerate(self.levels):
            ones_low, ones_high = bits.rank(low), bits.rank(high)
            if symbol >> (len(self.levels) - 1 - level) & 1:
                low, high = zeros + ones_low, zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low


class Boundaries:
    """Counts and places of the units of many texts, held one after the other as UTF-8."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.bounds = bounds
        char = (data & 0xC0) != 0x80
        white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        heads = bounds[:-1][np.diff(bounds) > 0]
        after_white, after_line = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        after_white[1:], after_line[1:] = white[:-1], data[:-1] == 0x0A
        after_white[heads] = after_line[heads] = True
        char[heads] = True
        classes = char * np.uint8(CHAR) | (char & ~white & after_white) * np.uint8(WORD) | after_line * np.uint8(LINE)
        self.symbols = np.unique(classes).tolist()
        self.matrix = WaveletMatrix(classes.astype(np.uint8), 3)

    def count(self, kind: int, at: np.ndarray) -> np.ndarray:
        """Units of a kind that begin before each place, over all texts."""
        total = np.zeros_like(at)
        for symbol in self.symbols:
            if symbol & kind:
                total += self.matrix.rank(symbol, at)
        return total

    def counts(self, kind: int) -> np.ndarray:
        """Units of each text."""
        return np.diff(self.count(kind, self.bounds))

    def locate(self, kind: int, units: np.ndarray) -> np.ndarray:
        """Where the first ``units`` of each text end: the byte at which the next unit begins, or the text's end.

        No units end at the text's start.
        """
        low, high = self.bounds[:-1].copy(), self.bounds[1:].copy()
        wanted = self.count(kind, self.bounds[:-1]) + units + 1
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            reached = self.count(kind, np.minimum(middle + 1, self.bounds[-1])) >= wanted
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle + 1, low)
        return np.where(units > 0, low, self.bounds[:-1])


def _cut_slice(texts: pa.Array, one: np.ndarray, two: np.ndarray, kind: int) -> list[np.ndarray]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, held = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held, dtype=np.uint8)[bounds[0] : bounds[-1]] if held else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    found = Boundaries(data, bounds)
    n = found.counts(kind)
    first, second = one % (n + 1), two % (n + 1)
    at = [found.locate(kind, units) for units in (np.minimum(first, second), np.maximum(first, second))]
    before = found.count(CHAR, bounds[:-1])
    return [n, *[found.count(CHAR, a) - before for a in at], *[a - bounds[:-1] for a in at]]


def _cutter(unit: str):
    kind = UNITS[unit]

    def cut(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        one, two = one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
        parts = [_cut_slice(texts.slice(a, b - a), one[a:b], two[a:b], kind) for a, b in byte_slices(texts)]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5
        names = ["n", "first_chars", "second_chars", "first_byte", "second_byte"]
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return F.arrow_udf(_batched(cut), CUTS)


def _batched(cut):
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, two in batches:
            yield cut(texts, one, two)

    return run


def fill_in_middle(
    docs: DataFrame,
    unit: str = "chars",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: id, n (units of the text), form, prefix_chars, middle_chars, output, text.

    ``unit`` is chars (code points), words (each with the white space after it; what comes before the first word
    belongs to it) or lines (each with its line feed). The sha256 of ``<seed>:<id>`` gives two cuts, in units, and decides the form: plain
    for ``plain_percent`` of the documents, then suffix first (spm) for ``spm_percent`` of the rest, else prefix
    first (psm). Texts that are empty or null, or hold a mark, stay plain; their cuts are null.

    A null id is hashed as empty text. Rows are handled one by one, so repeated rows give equal results, and an empty
    table gives none. Only id and text are read; names of other columns may clash.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    ship_package(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), digest.alias("__digest"))
    hashes = [F.conv(F.substring("__digest", 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"__h{k + 1}") for k in range(4)]
    rows = rows.select("__id", "__text", *hashes)
    marked = F.contains("__text", F.lit(PREFIX)) | F.contains("__text", F.lit(SUFFIX)) | F.contains("__text", F.lit(MIDDLE))
    plain = (F.col("__text") == "") | marked | (F.col("__h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, PLAIN).when(F.col("__h4") % 100 < spm_percent, SPM).otherwise(PSM)
    rows = rows.select("__id", "__text", form.alias("form"), _cutter(unit)("__text", "__h1", "__h2").alias("__cut"))

    data = F.col("__text").cast("binary")
    first, second = F.col("__cut.first_byte").cast("int"), F.col("__cut.second_byte").cast("int")
    prefix = F.substring(data, F.lit(1), first).cast("string")
    middle = F.substring(data, first + 1, second - first).cast("string")
    suffix = F.substring(data, second + 1, F.octet_length("__text") - second).cast("string")
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    is_plain = F.col("form") == PLAIN
    return rows.select(
        F.col("__id").alias(id_col),
        F.col("__cut.n").alias("n"),
        "form",
        F.when(~is_plain, F.col("__cut.first_chars")).alias("prefix_chars"),
        F.when(~is_plain, F.col("__cut.second_chars") - F.col("__cut.first_chars")).alias("middle_chars"),
        F.when(is_plain, F.col("__text")).when(F.col("form") == SPM, spm).otherwise(psm).alias("output"),
        F.col("__text").alias(text),
    )


def restored(output: Column, form: Column) -> Column:
    """The text of an output. Marks never occur in texts of the two cut forms, so they part it."""
    parts = F.split(output, "<[PSM]>", -1)
    psm, spm = [1, 3, 2], [2, 3, 1]
    joined = {name: F.concat(*[F.get(parts, F.lit(k)) for k in order]) for name, order in ((PSM, psm), (SPM, spm))}
    return F.when(form == PLAIN, output).when(form == PSM, joined[PSM]).otherwise(joined[SPM])
