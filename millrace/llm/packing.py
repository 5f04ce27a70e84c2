"""Best-fit packing of documents into sequences by bin completion.

Documents become token ids and pieces of at most ``limit`` tokens in one pass. The pieces, small rows
without text, are dealt into chunks of about ``CHUNK`` and every chunk is packed in a task. Best fit
decreasing gives the first solution. Where it needs more sequences than the lower bound, a second one fills each
sequence around the largest piece left as far as a spread of the others can, for all pieces and for the shorter
ones apart from the longer, and the best of these stands. Its wasteful
sequences are then gone through in groups of some hundred pieces: a branch and bound search fills the sequence
around the largest piece with undominated sets, pruned by the waste that an improvement may still have. Chunks cost at most one part-filled sequence each against a packing at once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import landed, ship_package, tidied
from millrace.llm.toxicity import forget_terms
from millrace.llm.wordids import byte_slices, word_ids

CHUNK = 16_384
# search steps for one chunk, shared out over its groups by their pieces; when a group has used up its own the
# best packing found so far stands
STEPS = 20_000
# pieces that one sequence is filled from, and that are searched at a time
GROUP = 256
# the most splits into short and long pieces that are tried
SPLITS = 12
# bytes of text that are encoded at a time; what is made of them in a worker takes about thirty times as much
SLICE_BYTES = 2 << 20
PIECES = "__id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes by best fit decreasing; equal room goes to the bin that got it last."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set where a bin has room r
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[k]
        above = rooms >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(k)
        left = room - size
        if left:
            by_room.setdefault(left, []).append(at)
            rooms |= 1 << left
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins: by total length, and by pieces of over half a bin."""
    return max(math.ceil(sum(lengths) / capacity), sum(2 * x > capacity for x in lengths))


class _Search:
    """Depth-first bin completion over counts of lengths."""

    def __init__(self, lengths: list[int], capacity: int, bins: int, steps: int):
        self.capacity, self.steps = capacity, steps
        self.count = [0] * (capacity + 1)
        for x in lengths:
            self.count[x] += 1
        self.present = sum(1 << x for x in set(lengths))
        self.allowed = (bins - 1) * capacity - sum(lengths)

    def _take(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            self.present &= ~(1 << x)

    def _give(self, x: int) -> None:
        self.count[x] += 1
        self.present |= 1 << x

    def _fillings(self, room: int, top: int, allowed: int, chosen: list[int]) -> Iterator[int]:
        """Leave chosen, in turn, at each undominated set for the room; yields its waste.

        A set is dominated if another piece still fits, or if one left piece could stand for two of it.
        """
        self.steps -= 1
        if self.steps <= 0:
            return
        fits = self.present & ((1 << (min(room, top) + 1)) - 1)
        if not self.present & ((1 << (room + 1)) - 1):
            if room <= allowed and not any(
                self.present >> (a + b) & 1 for i, a in enumerate(chosen) for b in chosen[i + 1 :] if a + b <= self.capacity
            ):
                yield room
            return
        while fits:
            x = fits.bit_length() - 1
            fits &= ~(1 << x)
            if x * 64 < room - allowed and self._reach(x) < room - allowed:
                return  # all that is left and no longer than x leaves too much waste
            self._take(x)
            chosen.append(x)
            yield from self._fillings(room - x, x, allowed, chosen)
            chosen.pop()
            self._give(x)

    def _reach(self, top: int) -> int:
        total, bits = 0, self.present & ((1 << (top + 1)) - 1)
        while bits:
            x = bits.bit_length() - 1
            total += x * self.count[x]
            bits &= ~(1 << x)
        return total

    def run(self) -> list[list[int]] | None:
        """Bins of lengths, one fewer than the incumbent, or None where no such packing was found."""
        stack: list[tuple[int, list[int], Iterator[int], int]] = []
        done: list[list[int]] = []
        wasted = 0
        if self.allowed < 0:
            return None
        while self.steps > 0:
            if not self.present:
                return done
            top = self.present.bit_length() - 1
            self._take(top)
            chosen: list[int] = []
            options = self._fillings(self.capacity - top, top, self.allowed - wasted, chosen)
            waste = next(options, None)
            while waste is None:
                self._give(top)
                if not stack:
                    return None
                top, chosen, options, wasted = stack.pop()
                done.pop()
                waste = next(options, None)
            stack.append((top, chosen, options, wasted))
            done.append([top, *chosen])
            wasted += waste
        return None


def least_slack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes: the largest piece left, and of GROUP others spread over all lengths left the set of greatest sum."""
    left = sorted(range(len(lengths)), key=lambda i: (lengths[i], -i))
    bins: list[list[int]] = []
    while left:
        top = left.pop()
        room = capacity - lengths[top]
        mask, n = (1 << (room + 1)) - 1, min(GROUP, len(left))
        places = [k * len(left) // n for k in range(n)][::-1]
        # bit r of sums[k] is set where some of the first k pieces have the sum r
        sums = [1]
        for at in places:
            sums.append((sums[-1] | sums[-1] << lengths[left[at]]) & mask)
            if sums[-1] >> room:
                break
        total, taken = sums[-1].bit_length() - 1, []
        for k in range(len(sums) - 1, 0, -1):
            if not sums[k - 1] >> total & 1:
                taken.append(places[k - 1])
                total -= lengths[left[places[k - 1]]]
        bins.append([top, *[left.pop(at) for at in sorted(taken, reverse=True)]])
    return bins


def split_fit(lengths: list[int], capacity: int, shorter: int) -> list[list[int]]:
    """Bins of indexes: least slack among the shorter pieces alone, so that many go together, best fit for the others."""
    order = sorted(range(len(lengths)), key=lambda i: (lengths[i], i))
    bins: list[list[int]] = []
    for part, pack in ((order[:shorter], least_slack), (order[shorter:], best_fit)):
        bins += [[part[k] for k in one] for one in pack([lengths[i] for i in part], capacity)]
    return bins


def _searched(lengths: list[int], capacity: int, best: list[list[int]], steps: int) -> list[list[int]]:
    """Bins of the same indexes, fewer where the search finds so."""
    members = [k for one in best for k in one]
    sizes = [lengths[k] for k in members]
    least = lower_bound(sizes, capacity)
    while len(best) > least:
        found = _Search(sizes, capacity, len(best), steps).run()
        if found is None:
            break
        by_length: dict[int, list[int]] = {}
        for k in members:
            by_length.setdefault(lengths[k], []).append(k)
        best = [[by_length[x].pop() for x in one] for one in found]
    return best


def bin_completion(lengths: list[int], capacity: int, steps: int = STEPS) -> list[list[int]]:
    """Bins of indexes into ``lengths`` (each 1 to capacity), never more than best fit decreasing needs."""
    best, least = best_fit(lengths, capacity), lower_bound(lengths, capacity)
    if len(best) > least:
        # more splits where there is more to win
        splits = min(SPLITS, len(best) - least)
        shorter = [len(lengths) * (SPLITS - k) // SPLITS for k in range(0, SPLITS, -(-SPLITS // splits))]
        best = min([best, *[split_fit(lengths, capacity, n) for n in shorter]], key=len)
    if len(best) == least or len(lengths) <= GROUP:
        return _searched(lengths, capacity, best, steps)
    # the most wasteful bins first; full ones stay
    best.sort(key=lambda one: sum(lengths[k] for k in one))
    done: list[list[int]] = []
    while best and len(done) + len(best) > least:
        group: list[list[int]] = []
        while best and sum(map(len, group)) + len(best[0]) <= max(GROUP, len(best[0])):
            group.append(best.pop(0))
        if sum(lengths[k] for k in group[0]) == capacity:
            best = group + best
            break
        done += _searched(lengths, capacity, group, max(1, steps * sum(map(len, group)) // len(lengths)))
    return done + best


def _cut(path: str, end_id: int, limit: int, with_ids: bool, slice_bytes: int | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an earlier stage's tables in this worker have had their turn
        forget_terms()
        for batch in batches:
            for a, b in byte_slices(batch.column(1), slice_bytes or SLICE_BYTES):
                ids, bounds = word_ids(path).encode(batch.column(1).slice(a, b - a))
                data = memoryview(np.insert(ids, bounds[1:], end_id).astype("<u4")).cast("B")
                bounds = bounds + np.arange(len(bounds))
                sizes = np.diff(bounds)
                pieces = -(-sizes // limit)
                owner = np.repeat(np.arange(b - a), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * limit
                length = np.minimum(limit, sizes[owner] - start)
                first = (4 * (bounds[owner] + start)).tolist()
                held = [data[at : at + size] for at, size in zip(first, (4 * length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(owner)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array([zlib.crc32(part) for part in held], type=pa.int64()),
                        pa.array([bytes(part) if with_ids else None for part in held], type=pa.binary()),
                    ],
                    ["__id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return run


def token_pieces(
    docs: DataFrame,
    path: str,
    limit: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    slice_bytes: int | None = None,
) -> DataFrame:
    """Pieces of at most ``limit`` ids of each document and its end id: id, piece, start, length, ids_crc32, ids.

    A null text is an empty one: a single piece with the end id. ``ids`` (little-endian unsigned 32-bit) is
    null unless asked for.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    return rows.mapInArrow(tidied(_cut(path, end_id, limit, with_ids, slice_bytes)), PIECES.format(id=kind))


def _pack_chunk(limit: int, steps: int):
    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("__row", kind="stable").reset_index(drop=True)
        lengths = chunk["length"].astype(int).tolist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        base = int(chunk["__chunk"].iloc[0]) << 32
        for number, members in enumerate(bin_completion(lengths, limit, steps)):
            at = 0
            for k in members:
                sequence[k], offset[k] = base + number, at
                at += lengths[k]
        chunk["sequence_id"], chunk["offset"] = sequence, offset
        return chunk.drop(columns=["__row", "__chunk"])

    return run


def pack_pieces(pieces: DataFrame, limit: int = 4096, chunk: int = CHUNK, steps: int = STEPS) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``limit``; ``pieces`` must be landed.

    Chunks are dealt by row, not by key, so repeated rows spread like any others.
    """
    chunks = max(1, math.ceil(pieces.count() / chunk))
    dealt = pieces.withColumn("__row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("__chunk", F.pmod(F.xxhash64("__row"), F.lit(chunks)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("__chunk").applyInPandas(_pack_chunk(limit, steps), f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    path: str,
    limit: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    slice_bytes: int | None = None,
) -> DataFrame:
    """Pieces of all documents with their place: sequence_id and offset, gapless from 0 in each sequence.

    Every row is packed on its own, repeated rows and null ids too; other columns of ``docs`` are not read.
    An empty table gives no pieces. ``slice_bytes`` of text are encoded at a time: fewer take less memory and more time.
    """
    pieces = landed(token_pieces(docs, path, limit, end_id, id_col, text, with_ids, slice_bytes), "pieces")
    return pack_pieces(pieces, limit).withColumnRenamed("__id", id_col)
