"""How filters interact: what each removes, in every order of application.

Every document gets a mask with one bit per filter it fails, and documents are counted per part and mask: that is all
the audit needs of the corpus, and at most 2^n rows a part. A recursive query then walks all orders: it extends each
prefix of filters by each unused letter, joins the mask cells and carries the bits applied so far; each
level of the recursion is one step and says of each cell what the step does with it. The walk knows masks, not parts, so
its size is fixed by the number of filters. Counts of the parts' cells give the metrics.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.common import WORD, landed

# a walk over six filters has 1,956 prefixes of 64 masks; Spark stops recursions at a million rows
MOST_FILTERS = 6
DUPLICATE = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text: few words, repeated words, capital letters, marks. None is null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """One row per document: part, mask (bit k for the k-th letter), good, toxic.

    The last letter fails a document whose whole text a smaller id has too, wherever that is. Texts are known by
    their SHA-256. The smallest id of each text is found with partial sums, then ids and texts are matched together,
    so copies of one text never meet in one task. A null id is neither smaller nor larger than another: it never fails by a
    copy. Null texts are empty texts, null parts the empty string. A document is good or toxic if any of its
    labels says so; without labels it is neither.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("body")
    )
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(text_filters(F.col("body")).values())]
    rows = rows.select("id", "part", F.unhex(F.sha2("body", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("own"))
    rows = landed(rows, "own-masks")
    firsts = rows.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id"))
    rows = rows.join(firsts.withColumn("first", F.lit(True)), ["digest", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()

    told = labels.select(F.col(id_col).alias("id"), F.col("quality") == 1, F.col("toxic") == 1).toDF("id", "good", "toxic")
    told = told.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = rows.join(told.where(F.col("id").isNotNull()), "id", "left")
    return rows.select(
        "part",
        (F.col("own") + F.when(copy, 1 << len(bits)).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def mask_cells(masks: DataFrame) -> DataFrame:
    """Documents, good and toxic ones of each part and mask."""
    return masks.groupBy("part", "mask").agg(
        F.count("*").alias("docs"),
        F.sum(F.col("good").cast("bigint")).alias("good"),
        F.sum(F.col("toxic").cast("bigint")).alias("toxic"),
    )


def walk_orders(cells: DataFrame, letters: str) -> DataFrame:
    """Every prefix of every order of ``letters`` with every mask that occurs in ``cells``.

    Columns: prefix, step, letter, mask, and whether the step's filter keeps, removes or would have removed the cell
    earlier (kept, removed, redundant) or alone (alone).
    """
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters: their orders are walked one by one")
    masks = landed(cells.select("mask").distinct().coalesce(1), "masks")
    filters = F.array(*[F.struct(F.lit(c).alias("letter"), F.lit(1 << k).alias("bit")) for k, c in enumerate(letters)])
    return cells.sparkSession.sql(
        """
        WITH RECURSIVE walk (prefix, step, letter, bit, applied, mask, filters) AS (
          SELECT '', 0, '', 0, 0, mask, filters FROM {masks}
          UNION ALL
          SELECT concat(prefix, next.letter), step + 1, next.letter, next.bit, applied | next.bit, mask, filters
          FROM walk LATERAL VIEW explode(filter(filters, f -> applied & f.bit = 0)) unused AS next
        )
        SELECT prefix, step, letter, mask,
               mask & applied = 0 AS kept,
               mask & bit > 0 AND mask & (applied ^ bit) = 0 AS removed,
               mask & bit > 0 AND mask & (applied ^ bit) > 0 AS redundant,
               mask = bit AS alone
        FROM walk WHERE step > 0
        """,
        masks=masks.select("mask", filters.alias("filters")),
    )


def audit_orders(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, filter_order and step with the counts of ``letters``' k-th filter at that step.

    kept: left after the step; removed: by it; redundant: fail its filter but went before; unique_fails: fail
    it alone; good_lost, toxic_lost: of the removed; shapley: what the filter removes at any step, summed over all
    orders. A part without failures has rows of zeros; without parts there are no rows.
    """
    walk = landed(walk_orders(cells, letters), "walk")
    cells = cells.repartition("part")
    # at most 1,956 * 64 rows whatever the corpus
    steps = cells.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "step", "letter")

    def of(flag: str, value: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col(value)).otherwise(0))

    steps = steps.agg(
        of("kept", "docs").alias("kept"),
        of("removed", "docs").alias("removed"),
        of("redundant", "docs").alias("redundant"),
        of("alone", "docs").alias("unique_fails"),
        of("removed", "good").alias("good_lost"),
        of("removed", "toxic").alias("toxic_lost"),
    )
    n = len(letters)
    orders = F.get(F.array(*[F.lit(factorial(n - k)) for k in range(n + 1)]), F.col("step"))
    of_filter = Window.partitionBy("part", "letter")
    steps = steps.withColumn("shapley", F.sum(F.col("removed") * orders).over(of_filter))

    whole = walk.where(F.col("step") == n).select(F.col("prefix").alias("filter_order")).distinct()
    whole = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("length"))
    whole = whole.select("filter_order", F.substring("filter_order", F.lit(1), F.col("length")).alias("prefix"))
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return steps.join(F.broadcast(whole), "prefix").select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), *[F.col(c).cast("bigint").alias(c) for c in counts]
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """``audit_orders`` of the four text filters and of copies, for each value of ``part``."""
    cells = landed(mask_cells(failure_masks(docs, labels, id_col, text, part)), "cells")
    return audit_orders(cells)
