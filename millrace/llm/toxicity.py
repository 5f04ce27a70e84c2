"""Toxicity by the nearest labelled examples under TF-IDF cosine.

A bounded sample of labelled rows gives the examples, and all of their terms, as 64-bit hashes, are the terms; document
frequencies of the terms are counted over all documents. The examples stand in an inverted index with block maxima:
each frequent term knows its largest weight in every block of examples. These and the exact share of the other
terms bound the cosines in a block, and a query passes over the blocks whose bound does not reach its neighbours
so far, so the neighbours are exact. A term that no example
holds has no part in any product and is left out of a query's norm. The neighbours vote by similarity; the votes
of the examples themselves, none of which sees an example of its own text, calibrate the score.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import give_back, landed, ship_package, tidied
from millrace.llm.wordids import forget_words

# the most labelled rows of either label that become examples; the index is broadcast, and this bounds it
EXAMPLES = 4096
# examples in a block, blocks that are scored before others are skipped, and texts that are looked up at a time
BLOCK = 64
FIRST_BLOCKS = 4
TEXTS = 256
# examples as many places apart of which the largest score stands for all, when the k-th best is asked for; divides BLOCK
APART = 8
# more than twice what single precision can take from a cosine
SLACK = 3e-4
# postings whose weights are found at a time
POSTINGS = 1 << 18
# terms whose postings stand by block, with block maxima; the others have few
FREQUENT = 1024
NEIGHBOURS = 15
# the vote that the share of the label among all labelled rows has
PRIOR = 0.05
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)


def term_counts(text: str | None) -> Counter:
    """Words in lower case, and their first letters as terms of their own, which catch inflected forms."""
    words = Counter(_WORD.findall((text or "").lower()))
    found = Counter(words)
    for size in STEMS:
        for word, n in words.items():
            if len(word) > size:
                found[f"{word[:size]}-"] += n
    return found


# fixed values: a term's hash is a polynomial in the numbers of its characters, modulo 2**64, which arrays sum up
_STEP = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
# characters whose terms are found at a time
SLICE = 1 << 16


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(_MIX)
    return hashes ^ (hashes >> np.uint64(29))


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter of _WORD, and its number in a hash."""
    letters = np.zeros(sys.maxunicode + 1, dtype=bool)
    for run in _WORD.finditer("".join(map(chr, range(sys.maxunicode + 1)))):
        letters[run.start() : run.end()] = True
    return letters, _mixed(np.arange(1, len(letters) + 1, dtype=np.uint64) * np.uint64(_STEP))


@cache
def _powers(bits: int) -> np.ndarray:
    powers = np.full(1 << bits, _STEP, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _term_hash(term: str) -> int:
    codes = _codes(term)
    return int(_mixed((_characters()[1][codes] * _powers(len(term).bit_length())[: len(term)]).sum(keepdims=True))[0])


def _hashed(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The text, as its place, and the hash of each term that ``term_counts`` counts, repeats included; slices are cut between words."""
    letters, numbers = _characters()
    lowered = [(text or "").lower() for text in texts]
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    codes = _codes("\n".join(lowered))
    start = 0
    while start < len(codes):
        stop = min(start + SLICE, len(codes))
        while stop < len(codes) and letters[codes[stop]]:
            stop += 1
        where = np.flatnonzero(letters[codes[start:stop]])
        where, start = where + start, stop
        if not len(where):
            continue
        begin = np.flatnonzero(np.diff(where, prepend=-2) > 1)
        size = np.diff(begin, append=len(where))
        powers = _powers(max(int(size.max()), *STEMS).bit_length())
        sums = np.zeros(len(where) + 1, dtype=np.uint64)
        np.cumsum(numbers[codes[where]] * powers[np.arange(len(where)) - np.repeat(begin, size)], out=sums[1:])
        owner = np.searchsorted(ends, where[begin], "right")
        yield owner, _mixed(sums[begin + size] - sums[begin])
        for stem in STEMS:
            longer = np.flatnonzero(size > stem)
            head = begin[longer]
            yield owner[longer], _mixed(sums[head + stem] - sums[head] + numbers[[ord("-")]] * powers[stem : stem + 1])


class TermCounter:
    """Counts of known terms in texts."""

    def __init__(self, hashes: np.ndarray):
        """``hashes``: those of the terms, sorted; a term's number is its place."""
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))
        bits = len(hashes).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        # where the hashes with the same first bits begin
        self.first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The terms' numbers, -1 for what is no term."""
        place = self.first[hashes >> self.shift].astype(np.int64)
        below = np.flatnonzero(self.hashes[place] < hashes)
        while len(below):
            place[below] += 1
            below = below[self.hashes[place[below]] < hashes[below]]
        return np.where((self.hashes[place] == hashes) & (place < len(self.hashes) - 1), place, -1)

    def pairs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, term) in order, as places and numbers, with counts."""
        every, held = len(self.hashes), [np.empty(0, np.int64)]
        for text, hashes in _hashed(texts):
            terms = self.numbers(hashes)
            known = np.flatnonzero(terms >= 0)
            held.append(text[known] * every + terms[known])
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        return found // every, found % every, counts

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the numbers of its terms, ascending, and their counts."""
        text, terms, counts = self.pairs(texts)
        at = np.searchsorted(text, np.arange(len(texts) + 1))
        terms = terms.astype(np.int32)
        return [(terms[a:b], counts[a:b]) for a, b in zip(at[:-1], at[1:])]


_COUNTERS: dict[int, tuple[np.ndarray, TermCounter]] = {}


def _counter(hashes: np.ndarray) -> TermCounter:
    """The worker's counter for a list of terms, which outlives tasks where the list does."""
    key = id(hashes)
    if key not in _COUNTERS or _COUNTERS[key][0] is not hashes:
        _COUNTERS.clear()
        _COUNTERS[key] = hashes, TermCounter(hashes)
    return _COUNTERS[key][1]


def forget_terms() -> None:
    """Drop what the worker keeps for counting terms; it is made again where it is needed."""
    _COUNTERS.clear()
    _characters.cache_clear()
    _powers.cache_clear()


def _digest(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode("utf-8", "replace"), digest_size=16).digest()


class ExampleIndex:
    """The examples' weights by term and block, and the calibrated vote.

    What is sent to workers are hashes, idf and counts; weights and block maxima are made where they are used.
    """

    def __init__(self, hashes: np.ndarray, idf: np.ndarray, examples: list[tuple], shares: tuple[float, float]):
        """``examples``: (id, label, digest, term numbers, counts); ``shares``: labelled rows per example of label 0, 1."""
        self.hashes, self.idf, self.shares = hashes, idf, shares
        examples = self._ordered(examples)
        self.ids = [e[0] for e in examples]
        self.labels = np.array([e[1] for e in examples], dtype=np.int64)
        self.digests = [e[2] for e in examples]
        sizes = [len(e[3]) for e in examples]
        every = np.concatenate([e[3] for e in examples]) if examples else np.empty(0, np.int32)
        counts = np.concatenate([e[4] for e in examples]) if examples else np.empty(0, np.uint32)
        order = np.argsort(every, kind="stable")
        small = np.min_scalar_type(len(examples))
        self.numbers = np.repeat(np.arange(len(examples), dtype=small), sizes)[order]
        self.counts = counts[order].astype(np.uint32, copy=False)
        self.sizes = np.bincount(every, minlength=len(hashes)).astype(small)
        self.id_type, self.id_arrow = T.LongType(), pa.int64()
        self.prior = self._share(self.labels)
        self.line, self.unknown = (1.0, 0.0), self.prior
        self.weights: np.ndarray | None = None

    def _ordered(self, examples: list[tuple]) -> list[tuple]:
        """Examples of one label that share their weightiest term of several examples stand together, so that
        blocks have low bounds for most queries."""
        held = np.bincount(np.concatenate([e[3] for e in examples]), minlength=len(self.hashes)) if examples else None

        def key(example):
            terms, counts = example[3], example[4]
            common = held[terms] >= 8
            weight = (1 + np.log(counts)) * self.idf[terms] * common
            top = int(terms[weight.argmax()]) if common.any() else -1
            return example[1], top, example[0] is None, example[0], example[2]

        return sorted(examples, key=key)

    def __getstate__(self):
        derived = ("terms", "rank", "weights", "begin", "asked", "same", "at", "postings", "place", "by_block", "most")
        return {k: v for k, v in self.__dict__.items() if k not in derived} | {"weights": None}

    def _unfold(self) -> None:
        """Vectors of the examples; in single precision the postings, those of the frequent terms by block (block, term, example) only, and their largest."""
        self.same: dict[bytes, list[int]] = {}
        for number, digest in enumerate(self.digests):
            self.same.setdefault(digest, []).append(number)
        forget_words()
        give_back()
        sizes = self.sizes.astype(np.int64)
        # the place of a frequent term, or -1
        by_size = np.argsort(-sizes, kind="stable")
        frequent = by_size[:FREQUENT]
        self.place = np.full(len(sizes), -1, dtype=np.int64)
        self.place[frequent] = np.arange(len(frequent))
        # where the postings of the other terms begin
        self.at = np.concatenate(([0], np.cumsum(np.where(self.place < 0, sizes, 0))))
        # some postings at a time, so that nothing beside the results has their length twice
        parts = [slice(k, k + POSTINGS) for k in range(0, len(self.numbers), POSTINGS)]
        term = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        raw, norms, held = np.empty(len(term)), np.zeros(len(self.ids)), np.zeros(len(self.ids), np.int64)
        for part in parts:
            raw[part] = (1 + np.log(self.counts[part])) * self.idf[term[part]]
            norms += np.bincount(self.numbers[part], raw[part] ** 2, len(norms))
            held += np.bincount(self.numbers[part], minlength=len(norms))
        norms = np.sqrt(norms)
        norms[norms == 0] = 1
        # the postings
        self.postings = np.empty(self.at[-1], dtype=[("number", np.uint32), ("weight", np.float32)])
        done = 0
        self.by_block = np.zeros((-(-len(self.ids) // BLOCK), len(frequent), BLOCK), dtype=np.float32)
        for part in parts:
            raw[part] /= norms[self.numbers[part]]
            place = self.place[term[part]]
            many = place >= 0
            few = slice(done, done := done + int((~many).sum()))
            self.postings["number"][few], self.postings["weight"][few] = self.numbers[part][~many], raw[part][~many]
            numbers = self.numbers[part][many].astype(np.int64)
            self.by_block[numbers // BLOCK, place[many], numbers % BLOCK] = raw[part][many]
        self.most = self.by_block.max(axis=2).T.copy()
        # the vectors of the examples; their terms by rank, so that the many mentions of a few lie close together
        self.rank = np.empty(len(sizes), dtype=np.int32)
        self.rank[by_size] = np.arange(len(sizes))
        self.begin = np.concatenate(([0], np.cumsum(held)))
        self.terms, self.weights = np.empty(len(term), np.int32), np.empty(len(raw))
        reached = self.begin[:-1].copy()
        for part in parts:
            order = np.argsort(self.numbers[part], kind="stable")
            owner = self.numbers[part][order]
            here = np.bincount(owner, minlength=len(held))
            to = (reached - (np.cumsum(here) - here))[owner] + np.arange(len(owner))
            self.terms[to], self.weights[to] = self.rank[term[part][order]], raw[part][order]
            reached += here
        del term, raw
        self.asked = np.zeros(len(sizes))
        give_back()

    def _share(self, labels: np.ndarray) -> float:
        weight = np.where(labels == 1, self.shares[1], self.shares[0])
        return float((weight * labels).sum() / weight.sum()) if len(labels) else 0.0

    def _weights(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[terms]
        norm = math.sqrt(float((weights * weights).sum()))
        return weights / norm if norm else weights

    def _nearest(self, queries: list[tuple]) -> list[list[tuple[float, int]]]:
        """For each query the NEIGHBOURS examples of highest cosine above 0, ties by number, none of the same text."""
        blocks = len(self.by_block)
        # the cosines in single precision say which examples can be among the nearest, SLACK allows for what it rounds
        dense = np.zeros((len(queries), len(self.most)), dtype=np.float32)
        scores = np.zeros((len(queries), blocks * BLOCK), dtype=np.float32)
        vectors = [(terms, self._weights(terms, counts)) for terms, counts, _ in queries]
        whole = self.postings.view(np.uint64)
        for row, (terms, weights) in enumerate(vectors):
            place = self.place[terms]
            few = place < 0
            dense[row, place[~few]] = weights[~few]
            starts = self.at[terms[few]]
            sizes = self.at[terms[few] + 1] - starts
            ends = np.cumsum(sizes)
            # as plain numbers, which are taken faster than records
            held = whole.take(np.arange(sizes.sum()) + np.repeat(starts - (ends - sizes), sizes)).view(self.postings.dtype)
            parts = held["weight"] * np.repeat(weights[few].astype(np.float32), sizes)
            scores[row] = np.bincount(held["number"], parts, scores.shape[1])
            scores[row, self.same.get(queries[row][2], [])] = -np.inf
        by_block = scores.reshape(len(queries), blocks, BLOCK)
        bounds = by_block.max(axis=2) + dense @ self.most

        def add(chosen: np.ndarray) -> None:
            """The frequent terms' share of the cosines in the chosen blocks of each query."""
            for block in np.flatnonzero(chosen.any(axis=0)):
                rows = np.flatnonzero(chosen[:, block])
                if len(rows) * 4 < len(queries):
                    by_block[rows, block] += dense[rows] @ self.by_block[block]
                else:  # a product with all is faster than a copy of the rows
                    by_block[:, block] += dense @ self.by_block[block] * chosen[:, block, None]

        def reached() -> np.ndarray:
            """What the k-th best of each query reaches at least."""
            # the largest of a few that stand far apart are scores too, and the k-th best of them is little lower
            spread = scores.reshape(len(queries), APART, -1).max(axis=1)
            some = spread if spread.shape[1] >= NEIGHBOURS else scores
            kth = some.shape[1] - min(NEIGHBOURS, len(self.ids))
            return np.partition(some, kth, axis=1)[:, kth, None] - SLACK

        first = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(first, np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST_BLOCKS], True, axis=1)
        add(first)
        # what stands in the other blocks is a part of their cosines, so the k-th best can only be higher
        add(~first & (bounds >= reached()))
        out = []
        for (terms, weights), could in zip(vectors, scores >= np.maximum(reached(), np.finfo(np.float32).tiny)):
            best = np.flatnonzero(could)
            ranks = self.rank[terms]
            self.asked[ranks] = weights
            spans = zip(self.begin[best].tolist(), self.begin[best + 1].tolist())
            exact = np.array([np.dot(self.asked.take(self.terms[a:b]), self.weights[a:b]) for a, b in spans])
            self.asked[ranks] = 0
            # sums of equal texts may differ in their last digits
            exact = np.round(exact, 12)
            order = np.argsort(-exact, kind="stable")[:NEIGHBOURS]
            out.append(list(zip(exact[order].tolist(), best[order].tolist())))
        return out

    def nearest(self, queries: list[tuple]) -> list[list[tuple[float, int]]]:
        """The neighbours of each (term numbers, counts, digest); equal texts are looked up once."""
        if not self.ids:
            return [[] for _ in queries]
        if self.weights is None:
            self._unfold()
        once = {digest: (terms, counts, digest) for terms, counts, digest in queries}
        asked, known = list(once.values()), {}
        for at in range(0, len(asked), TEXTS):
            some = asked[at : at + TEXTS]
            known.update(zip([d for _, _, d in some], self._nearest(some)))
        return [known[digest] for _, _, digest in queries]

    def _vote(self, near: list[tuple[float, int]]) -> float:
        for_, all_ = PRIOR * self.prior, PRIOR
        for similarity, number in near:
            weight = similarity * similarity * self.shares[self.labels[number]]
            all_ += weight
            for_ += weight * self.labels[number]
        return for_ / all_

    @staticmethod
    def _logit(p: float) -> float:
        p = min(max(p, 1e-4), 1 - 1e-4)
        return math.log(p / (1 - p))

    def votes(self, queries: list[tuple]) -> list[float | None]:
        """The votes before calibration; None where there is no neighbour."""
        return [self._vote(near) if near else None for near in self.nearest(queries)]

    def calibrate(self, votes: list[float | None], labels: list[int]) -> None:
        """A logistic curve over the examples' votes, by Newton steps with a weak pull to the identity."""
        labels = np.array(labels, dtype=np.int64)
        known = np.array([v is not None for v in votes], dtype=bool)
        if (~known).any():
            self.unknown = self._share(labels[~known])
        if not known.any():
            return
        x = np.array([self._logit(v) for v in votes if v is not None])
        y = labels[known]
        weight = np.where(y == 1, self.shares[1], self.shares[0])
        a, b = 1.0, 0.0
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(weight * (p - y) * x).sum() + (a - 1), (weight * (p - y)).sum() + b])
            h = weight * p * (1 - p)
            m = np.array([[(h * x * x).sum() + 1, (h * x).sum()], [(h * x).sum(), h.sum() + 1]])
            step = np.linalg.solve(m, g)
            a, b = a - step[0], b - step[1]
        self.line = (max(float(a), 0.05), float(b))

    def score(self, queries: list[tuple]) -> list[tuple[float, list[int]]]:
        """The calibrated scores and the ids of the examples that voted, nearest first."""
        a, b = self.line
        return [
            (1 / (1 + math.exp(-(a * self._logit(self._vote(near)) + b))), [self.ids[n] for _, n in near])
            if near
            else (self.unknown, [])
            for near in self.nearest(queries)
        ]


def _term_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # what a tokenizer remembers in this worker has had its turn
    forget_words()
    for batch in batches:
        terms = [hashes for _, hashes in _hashed(batch["text"].tolist())]
        yield pd.DataFrame({"term": np.unique(np.concatenate([np.empty(0, np.uint64), *terms])).view(np.int64)})


def _reduced(hashes: np.ndarray, texts: list[str | None]) -> list[tuple]:
    """Texts as (term numbers, counts, digest)."""
    return [(terms, counts, _digest(x)) for (terms, counts), x in zip(_counter(hashes)(texts), texts)]


def _vectors(held):
    """Term numbers, counts and digest of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = _reduced(held.value, batch["text"].tolist())
            batch["terms"] = [t.tobytes() for t, _, _ in rows]
            batch["counts"] = [n.astype(np.uint32).tobytes() for _, n, _ in rows]
            batch["digest"] = [d for _, _, d in rows]
            yield batch.drop(columns="text")

    return run


def _counted(held):
    """How many texts of a task hold each term; at -1 how many there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_words()
        hashes, rows = held.value, 0
        counter, total = _counter(hashes), np.zeros(len(hashes), np.int64)
        for batch in batches:
            rows += len(batch)
            texts = batch["text"].tolist()
            for k in range(0, len(texts), TEXTS):
                some, n = np.unique(counter.pairs(texts[k : k + TEXTS])[1], return_counts=True)
                total[some] += n
        yield pd.DataFrame({"t": [-1, *np.flatnonzero(total)], "n": [rows, *total[total > 0]]})

    return run


def _voted(held):
    """Votes on the examples themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = held.value
        for batch in batches:
            terms = [np.frombuffer(t, np.int32) for t in batch["terms"]]
            counts = [np.frombuffer(n, np.uint32) for n in batch["counts"]]
            votes = index.votes(list(zip(terms, counts, batch["digest"])))
            yield pd.DataFrame({"toxic": batch["toxic"], "vote": votes}, dtype=object)

    return run


def _scored(held, text: str, kept: bool, evidence: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            # as Python strings only some texts at a time
            for k in range(0, batch.num_rows, TEXTS):
                part = batch.slice(k, TEXTS)
                scores = index.score(_reduced(index.hashes, part.column(text).to_pylist()))
                columns = dict(zip(part.schema.names, part.columns))
                if not kept:
                    del columns[text]
                columns["score"] = pa.array([s for s, _ in scores], pa.float64())
                columns["evidence"] = pa.array([e for _, e in scores], pa.list_(evidence))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic"
) -> ExampleIndex:
    """The index of a bounded, hash-ordered sample of the labelled rows outside the held-out quarter.

    Rows whose label isn't 0 or 1 are not used, nor is a label without a document. A document labelled twice
    counts as toxic if one label says so. ``docs`` is read whole for the document frequencies.
    """
    ship_package(docs.sparkSession)
    key = F.crc32(F.col("id").cast("string").cast("binary"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("toxic")).where("toxic IN (0, 1)")
    known = known.where(F.col("id").isNotNull()).where(key % 4 != 2).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = landed(known, "labelled")
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES) for y in (0, 1)]
    chosen = landed(chosen[0].unionByName(chosen[1]), "chosen")
    # EXAMPLES rows of either label at most
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    examples = landed(texts.join(F.broadcast(chosen), "id"), "examples")

    # both labels' examples spread over tasks again, whatever partitions they came from
    examples = landed(examples.repartition(16), "spread-examples")
    sizes = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    # columns of numbers, bounded by the examples
    terms = examples.select("text").mapInPandas(tidied(_term_rows), "term bigint").distinct().toArrow()
    hashes = np.sort(terms.column("term").to_numpy().view(np.uint64))
    del terms
    context = docs.sparkSession.sparkContext
    held = context.broadcast(hashes)
    counted = texts.select("text").mapInPandas(tidied(_counted(held)), "t int, n bigint")
    counts = landed(counted.groupBy("t").agg(F.sum("n").alias("n")), "term-counts").toArrow()
    df = np.zeros(len(hashes) + 1, dtype=np.int64)  # the last place is that of -1
    df[counts.column("t").to_numpy()] = counts.column("n").to_numpy()
    del counts
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    fields = f"id {examples.schema['id'].dataType.simpleString()}, toxic int, terms binary, counts binary, digest binary"
    vectors = landed(examples.select("id", "toxic", "text").mapInPandas(tidied(_vectors(held)), fields), "vectors")
    columns = vectors.toArrow()
    id_arrow, columns = columns.schema.field("id").type, columns.to_pydict()
    rows = [
        (i, y, d, np.frombuffer(t, np.int32), np.frombuffer(n, np.uint32))
        for i, y, t, n, d in zip(*[columns[c] for c in ("id", "toxic", "terms", "counts", "digest")])
    ]
    shares = tuple(totals.get(y, 0) / max(sizes.get(y, 0), 1) for y in (0, 1))
    index = ExampleIndex(hashes, idf, rows, shares)
    index.id_type, index.id_arrow = examples.schema["id"].dataType, id_arrow
    del columns, rows
    held.destroy()
    give_back()
    plain = context.broadcast(index)
    votes = vectors.mapInPandas(tidied(_voted(plain)), "toxic int, vote double").toArrow().to_pydict()
    index.calibrate(votes["vote"], votes["toxic"])
    # all that used them is landed; without this the driver keeps its own copies
    plain.destroy()
    return index


def score_texts(rows: DataFrame, index: ExampleIndex, text: str = "__text", kept: bool = False) -> DataFrame:
    """Scores of rows with ``text``, which goes unless ``kept``: score, predicted (1 from THRESHOLD on), evidence."""
    held = rows.sparkSession.sparkContext.broadcast(index)
    fields = [f for f in rows.schema if kept or f.name != text]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(index.id_type))])
    scored = rows.mapInArrow(tidied(_scored(held, text, kept, index.id_arrow)), schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, score, predicted, evidence), one per row of ``docs``.

    Null and empty texts, and texts without any term, get the share of toxic examples among examples without
    terms, or among all where none is without. ``evidence`` are the ids of the examples that voted, nearest first. Repeated rows get equal
    results, a null id stays null, an empty table gives an empty result. Without labelled rows every score
    is 0. Examples of a document's own text are none of its neighbours. Columns other than id, text and label are not read.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    scored = score_texts(rows, fit(docs, labels, id_col, text))
    # the workers have the index; the driver needs it no longer
    give_back()
    return scored.select(F.col("__id").alias(id_col), "score", "predicted", "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that aren't predicted toxic; scored while they are read."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"))
    names = [F.col("__row").getField(c).alias(f"__{k}") for k, c in enumerate(docs.columns)]
    # the workers get each text once
    own = f"__{docs.columns.index(text)}"
    scored = score_texts(rows.select(*names), fit(docs, labels, id_col, text), own, kept=True).where("predicted = 0")
    # the workers have the index; the driver needs it no longer
    give_back()
    return scored.select(*[F.col(f"__{k}").alias(c) for k, c in enumerate(docs.columns)])
