"""Concatenate and cut: all documents one after the other, cut into windows of equal size.

The first pass turns texts into ids and lands them with their place in their partition. Totals of the partitions
are summed up to global offsets in two levels; no task sees more than a partition or the square root of their
number. The second pass cuts each document at the windows' boundaries that fall into it: a document that crosses one
gives a boundary record, a piece in each window it reaches into. What is left after the last full window is cut at
powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bucket_offsets, landed, ship_package, square_root_width
from millrace.llm.wordids import byte_slices, word_ids

# rows of 16 bytes, one for each partition, that may be broadcast; more are joined by a shuffle
MOST_BROADCAST = 1_000_000
ENCODED = "__id {id}, __part int, __before bigint, __tokens bigint, __ids binary"


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in byte_slices(batch.column(1)):
                ids, bounds = word_ids(path).encode(batch.column(1).slice(a, b - a))
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                counts = np.diff(bounds)
                edges = pa.py_buffer((bounds * 4).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.full(b - a, part, dtype=np.int32)),
                        pa.array(before + bounds[:-1]),
                        pa.array(counts),
                        pa.Array.from_buffers(pa.binary(), b - a, [None, edges, pa.py_buffer(ids)]),
                    ],
                    ["__id", "__part", "__before", "__tokens", "__ids"],
                )
                before += int(bounds[-1])

    return run


def encoded_documents(docs: DataFrame, path: str, end_id: int, id_col: str, text: str) -> DataFrame:
    """First pass, landed: id, partition, ids before it in its partition, number of ids, the ids themselves.

    What is landed keeps one attempt of each task, so places stay as they are however often later stages run.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    return landed(rows.mapInArrow(_encode(path, end_id), ENCODED.format(id=kind)), "encoded")


def _tail(total: int, limit: int, powers: bool) -> list[int]:
    """Where sequences begin from the last full window on."""
    at = total - total % limit
    starts = []
    while at < total:
        starts.append(at)
        at += 1 << ((total - at).bit_length() - 1) if powers else limit
    return starts


def pack_windows(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text: str = "text",
    powers: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents in windows of ``limit`` ids.

    One row per piece: id, start (ids of its document before it), length, ids_crc32 (of little-endian unsigned
    32-bit ids), doc_tokens, sequence_id (from 0 in the order of the concatenation), offset (in its sequence) and,
    ``with_ids``, the piece's ids as such bytes. Every document is followed by ``end_id``, so a null or empty text is
    one piece of length 1. All sequences are full but those of the last window's rest: with ``powers`` its length is
    split into powers of two, largest first, otherwise it is one short sequence.

    Every row is placed on its own, repeated rows and null ids too. Only the id and the text are read, so other
    columns may have any name. The order of the documents is that of the table's partitions; an empty table gives
    no pieces. A piece never holds ids of two documents, and long documents run through as many windows as they need.
    """
    encoded = encoded_documents(docs, path, end_id, id_col, text)
    totals = landed(encoded.groupBy("__part").agg(F.sum("__tokens").alias("__sum")), "totals")
    got = totals.agg(F.count("*").alias("parts"), F.sum("__sum").alias("ids")).first()
    parts, total = got.parts, got.ids or 0
    sums = totals.withColumn("__all", F.lit(0))
    bases = bucket_offsets(sums, ["__all"], "__part", "__sum", "__base", square_root_width(parts))
    bases = bases.select("__part", "__base")
    if parts <= MOST_BROADCAST:
        bases = F.broadcast(bases)

    full = total - total % limit
    tail = _tail(total, limit, powers)
    starts = F.array(*[F.lit(t).cast("bigint") for t in tail]) if tail else F.array().cast("array<bigint>")
    placed = encoded.join(bases, "__part").select(
        "__id", "__tokens", "__ids", (F.col("__base") + F.col("__before")).alias("__at")
    )
    end = F.col("__at") + F.col("__tokens")
    first, last = F.expr(f"__at div {limit} + 1"), F.least(F.expr(f"(__at + __tokens - 1) div {limit}"), F.lit(full // limit))
    inside = F.when(last >= first, F.transform(F.sequence(first, last), lambda w: w * limit))
    inner = F.concat(F.coalesce(inside, F.array().cast("array<bigint>")), F.filter(starts, lambda t: t > full))
    cuts = F.concat(F.array("__at"), F.filter(inner, lambda t: (t > F.col("__at")) & (t < end)))
    cut = placed.withColumn("__cuts", cuts)

    def piece(at, k):
        until = F.coalesce(F.get("__cuts", k + 1), end)
        passed = F.filter(starts, lambda t: t <= at)
        start, length = at - F.col("__at"), until - at
        bytes_of = F.substring(F.col("__ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        fields = [
            start.alias("start"),
            length.alias("length"),
            F.crc32(bytes_of).alias("ids_crc32"),
            F.when(at < full, F.floor(at / F.lit(limit))).otherwise(F.lit(full // limit - 1) + F.size(passed)).cast("bigint").alias("sequence_id"),
            F.when(at < full, at % limit).otherwise(at - F.element_at(passed, -1)).cast("bigint").alias("offset"),
        ]
        return F.struct(*fields, *([bytes_of.alias("ids")] if with_ids else []))

    pieces = cut.select("__id", "__tokens", F.inline(F.transform("__cuts", piece)))
    return pieces.select(
        F.col("__id").alias(id_col),
        "start",
        "length",
        "ids_crc32",
        F.col("__tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
        *(["ids"] if with_ids else []),
    )


def window_ids(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length and their ids as little-endian unsigned 32-bit bytes.

    ``pieces`` come from ``pack_windows`` with ids. A sequence gathers at most ``limit`` pieces.
    """
    held = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("__held")
    )
    joined = F.aggregate("__held", F.lit(b"").cast("binary"), lambda all_ids, one: F.concat(all_ids, one["ids"]))
    return held.select("sequence_id", "length", joined.alias("ids"))
