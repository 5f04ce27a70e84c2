"""Mixing sources to target weights by random order and prefix sums.

Every document gets a hash-random key and is put in its source's order by it. Distributed prefix sums of the
sizes then say where the source's budget ends: whole passes over the source, a head of the order once more,
and a part of the one document the cut falls in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, bucket_offsets, landed, square_root_width, word_count
from millrace.operators.numbering import range_row_number

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``target`` to one row per source (``__source``, ``source_size``); ``sizes`` must be landed.

    ``__source`` is "=" and the name, or empty for the null source. The sources in code point order, null last, weigh ``weights``, repeating. Together they get ``share``
    times all sizes by weight; a target stops at ``most`` times its source's size and the excess is shared
    by weight among the others, until none is above. Each round is one small aggregate and at least one
    source more stops in it.
    """
    ordered = sizes.withColumn("__last", F.col("__source") == "")
    ranked = range_row_number(ordered, ["__last", "__source"], "__rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = landed(ranked.select("__source", "source_size", weight.alias("__weight")), "weights")
    size = F.col("source_size").cast("double")
    whole = ranked.agg(F.sum("source_size").alias("s")).first().s or 0
    level = stopped = None
    while True:
        full = F.lit(False) if level is None else F.col("__weight") * F.lit(level) >= size * most
        got = ranked.agg(
            F.sum(F.when(full, size * most).otherwise(0.0)).alias("used"),
            F.sum(F.when(full, 0.0).otherwise(F.col("__weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
        ).first()
        if got.n == stopped or not got.open:
            break
        stopped, level = got.n, (share * whole - got.used) / got.open
    target = F.least(F.col("__weight") * F.lit(level or 0.0), size * most)
    return ranked.select("__source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 17,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows (id, size, source_size, target, taken) and the columns in ``keep``, one per row of ``docs``.

    ``taken`` is the number of the row's words in the mix, repeats counted; per source they sum up to the
    target, rounded down. A null text has size 0, and what has size 0 is never taken. A null source is a
    source of its own. Rows that are equal in id and text are told apart by nothing, so their order among
    each other is open; which of them is cut doesn't matter. An empty table gives an empty result.
    """
    kept = [F.col(c).alias(f"__keep_{k}") for k, c in enumerate(keep)]
    rows = docs.select(
        F.col(id_col).alias("__id"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("__source"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")).alias("__key"),
        *kept,
    )
    sizes = rows.groupBy("__source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    sizes = landed(sizes, "source-sizes")
    targets = source_targets(sizes.select("__source", "source_size"), weights, share, most)
    total = sizes.agg(F.sum("__rows").alias("n")).first().n or 0

    # keys are uniform, so equal parts of their range are ranges of about equally many rows
    buckets = square_root_width(total)
    head = F.conv(F.substring("__key", 1, 8), 16, 10).cast("bigint")
    part = F.floor(head * F.lit(buckets) / F.lit(float(1 << 32))).cast("bigint")
    rows = rows.withColumn("__part", part)
    counts = rows.groupBy("__source", "__part").agg(F.sum("size").alias("__sum"))
    starts = bucket_offsets(counts, ["__source"], "__part", "__sum", "__start", square_root_width(buckets))
    plan = starts.join(targets, "__source")

    order = Window.partitionBy("__source", "__part").orderBy("__key", "__id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("__inner", before)
    joined = placed.join(plan, ["__source", "__part"])
    place, budget = F.col("__inner") + F.col("__start"), F.floor("target").cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - passes * F.col("source_size")
    head = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - place))
    return joined.select(
        F.col("__id").alias(id_col),
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + head).cast("bigint").alias("taken"),
        *[F.col(f"__keep_{k}").alias(c) for k, c in enumerate(keep) if c != id_col],
    )


def mixed_rows(taken: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: each row once per whole pass, and once with its first words where the cut falls in it.

    ``taken`` comes from ``mix`` with the text kept. Rows of which nothing is taken go. In a cut row white
    space becomes single blanks.
    """
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    copies = F.filter(F.concat(F.array_repeat(F.lit(0), whole), F.array(rest)), lambda n, i: (i < whole) | (n > 0))
    rows = taken.withColumn("__words", F.explode(copies))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    cut = F.array_join(F.slice(words, 1, F.greatest(F.col("__words"), F.lit(1))), " ")
    body: Column = F.when(F.col("__words") > 0, cut).otherwise(F.col(text))
    return rows.withColumn(text, body).drop("__words", "size", "source_size", "target", "taken")
