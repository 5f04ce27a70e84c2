"""Near-duplicate vectors by NN-descent.

Random hyperplanes put vectors into small blocks, whose members' nearest give every vector a first list of
neighbours. NN-descent then refines the lists: vectors that name the same neighbour are compared with each
other. The entries from the threshold on are links, and their components are regions. A list holds a bounded
number of links, so others may lead from region to region: new hyperplanes put vectors into buckets, in which
each vector gets its best link to another region, until no pass joins any; as many tables are asked as a lone
pair at the threshold needs to meet with a chance of ``RECALL``. Regions are then gone through block against
block, which gives exact link counts without pairs. Links are audited against brute force for bounded sets of
vectors with and without links; where some are missing, more passes follow, and below ``RECALL`` after these one
that compares all vectors block against block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import landed, ship_package
from millrace.llm.components import connected_components

NEIGHBOURS = 12
TABLES = 4
BLOCK = 192
CENTRES = 2048
DESCENTS = 2
ROUNDS = 3
# vectors with links, and as many without, whose links are checked by brute force; they are broadcast
AUDITED = 256
# the chance at which a lone pair of vectors at the threshold meets, and the audited share of links that is enough
RECALL = 0.999
LIST = "array<struct<sim: float, id: bigint>>"


def _matrix(values, kind: str) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    rows = np.stack([np.frombuffer(v, kind) for v in values]).astype(np.float64)
    # by the largest component first, so that no square over- or underflows
    rows /= np.abs(rows).max(axis=1)[:, None]
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _usable(kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, bodies = [], []
            for key, vector in zip(batch["id"], batch["vector"]):
                if key is None or key != key or vector is None:
                    continue
                x = np.asarray(vector, dtype=kind)  # a null becomes NaN
                if len(x) and np.isfinite(x).all() and x.any():
                    ids.append(key)
                    bodies.append(x.tobytes())
            digests = [hashlib.blake2b(b, digest_size=16).digest() for b in bodies]
            yield pd.DataFrame({"id": np.array(ids, np.int64), "digest": digests, "body": bodies})

    return run


def _coded(kind: str, bits: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, part in batch.groupby(batch["body"].map(len)):
                x = _matrix(part["body"], kind)
                if length not in planes:
                    planes[length] = np.random.default_rng([seed, length]).standard_normal((x.shape[1], TABLES * bits))
                sides = (x @ planes[length] > 0).reshape(len(x), TABLES, bits).astype(np.int64)
                codes = (sides << np.arange(bits)).sum(axis=2)
                for t in range(TABLES):
                    yield pd.DataFrame(
                        {"id": part["id"], "body": part["body"], "tab": t, "code": codes[:, t], "size": length}
                    )

    return run


def _best(ids: np.ndarray, sims: np.ndarray, most: int) -> list[list[dict]]:
    """For each row of a similarity matrix (own entry -2) the entries of highest similarity."""
    most = min(most, sims.shape[1] - 1)
    if most < 1:
        return [[] for _ in ids]
    top = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    values = np.take_along_axis(sims, top, axis=1)
    return [
        [{"sim": float(s), "id": int(ids[j])} for s, j in zip(row, at) if s > -2] for row, at in zip(values.tolist(), top)
    ]


def _in_block(kind: str):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        ids, x = block["id"].to_numpy(np.int64), _matrix(block["body"], kind)
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        return pd.DataFrame({"id": ids, "near": _best(ids, sims, NEIGHBOURS)})

    return run


def _round_centres(kind: str):
    """Compare with each other the vectors that name the same centre; a group holds many centres."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["centre", "part"], kind="stable")
        names = group[["centre", "part"]].to_numpy(np.int64)
        edges = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        ids, sizes = group["id"].to_numpy(np.int64), group["body"].map(len).to_numpy()
        bodies = group["body"].to_numpy()
        rows: list[tuple[int, list[dict]]] = []
        for part in np.split(np.arange(len(ids)), edges):
            for size in np.unique(sizes[part]):
                some = part[sizes[part] == size]
                if len(some) > 1:
                    x = _matrix(bodies[some], kind)
                    sims = x @ x.T
                    sims[ids[some][:, None] == ids[some][None, :]] = -2
                    rows += zip(ids[some].tolist(), _best(ids[some], sims, NEIGHBOURS // 2))
        return pd.DataFrame(rows, columns=["id", "near"])

    return run


def _merged(lists: DataFrame, threshold: float) -> DataFrame:
    """One list per vector, best first; up to four times as long where all of it are links."""
    every = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    every = every.select("id", F.sort_array("near", asc=False).alias("near"))
    links = F.size(F.filter("near", lambda x: x["sim"] >= threshold))
    keep = F.when(links >= NEIGHBOURS, F.least(links, F.lit(4 * NEIGHBOURS))).otherwise(NEIGHBOURS)
    return every.select("id", F.slice("near", F.lit(1), keep).alias("near"))


def _block_pairs(members: DataFrame) -> DataFrame:
    """Rows of groups of several ``blocks``, once for each pair (low, high) of blocks that their own (side) is part of."""
    dealt = members.withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))


class _Graph:
    def __init__(self, vectors: DataFrame, kind: str, threshold: float):
        self.vectors, self.kind, self.threshold = vectors, kind, threshold
        self.count = vectors.count()
        self.lists: DataFrame | None = None
        self.bridges: DataFrame | None = None
        self.bits = max(1, math.ceil(math.log2(max(self.count, 2) / BLOCK)))
        # one pass has TABLES tables; a pair at the threshold is on the same sides of all planes of one with chance ``meet``
        meet = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** self.bits
        tables = math.log(1 - RECALL) / math.log1p(-meet) if 0 < meet < 1 else 1.0
        self.passes = max(1, math.ceil(tables / TABLES))

    def _add(self, found: DataFrame, name: str) -> None:
        found = landed(found, name)
        both = found if self.lists is None else self.lists.unionByName(found)
        self.lists = landed(_merged(both, self.threshold - 1e-6), "lists")

    def _coded(self, vectors: DataFrame, bits: int, seed: int) -> DataFrame:
        fields = "id bigint, body binary, tab int, code bigint, size int"
        return vectors.mapInPandas(_coded(self.kind, bits, seed), fields)

    def start(self, seed: int) -> None:
        """Neighbours within blocks of vectors on the same sides of random hyperplanes."""
        coded = landed(self._coded(self.vectors.select("id", "body"), self.bits, seed), "coded")
        sizes = coded.groupBy("tab", "code", "size").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        sizes = landed(sizes, "block-counts")
        dealt = coded.join(sizes, ["tab", "code", "size"])
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id", "tab", F.lit(seed)), F.col("blocks")))
        near = dealt.groupBy("tab", "code", "size", "block").applyInPandas(_in_block(self.kind), f"id bigint, near {LIST}")
        self._add(near, "near")

    def descend(self) -> None:
        """One round of NN-descent over the reversed lists."""
        named = self.lists.join(self.vectors.select("id", "body"), "id")
        own = F.array(F.struct(F.lit(1.0).cast("float").alias("sim"), F.col("id").alias("id")))
        named = named.select("id", "body", F.explode(F.concat("near", own)).alias("to"))
        named = named.select(F.col("to.id").alias("centre"), "id", "body")
        degree = self.lists.select(F.explode("near").alias("to")).groupBy(F.col("to.id").alias("centre"))
        degree = landed(degree.agg(F.ceil((F.count("*") + 1) / BLOCK).alias("parts")), "degrees")
        dealt = named.join(degree, "centre").withColumn("part", F.pmod(F.xxhash64("id", "centre"), F.col("parts")))
        groups = max(1, math.ceil(self.count / CENTRES))
        dealt = dealt.withColumn("grp", F.pmod(F.xxhash64("centre", "part"), F.lit(groups)))
        near = dealt.groupBy("grp").applyInPandas(_round_centres(self.kind), f"id bigint, near {LIST}")
        self._add(near.where(F.size("near") > 0), "near")

    def links(self) -> DataFrame:
        edges = self.lists.select("id", F.explode("near").alias("to"))
        edges = edges.where(F.col("to.sim") >= self.threshold - 1e-6)
        edges = edges.select(F.least("id", "to.id").alias("a"), F.greatest("id", "to.id").alias("b"))
        edges = edges if self.bridges is None else edges.unionByName(self.bridges)
        return landed(edges.distinct(), "links")

    def bridge(self, seed: int, whole: bool = False) -> bool:
        """Add each vector's best link to another region within its buckets, or among all vectors; whether there was one."""
        regions = landed(connected_components(self.links()).withColumnRenamed("node", "id"), "regions")
        coded = self._coded(self.vectors.select("id", "body"), 0 if whole else self.bits, seed)
        coded = coded.where("tab = 0") if whole else coded
        coded = coded.join(regions, "id", "left").withColumn("region", F.coalesce("component", "id")).drop("component")
        bucket = ["tab", "code", "size"]
        coded = landed(coded, "coded")
        sizes = coded.groupBy(*bucket).agg(
            F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.min("region").alias("low"), F.max("region").alias("high")
        )
        sizes = landed(sizes.where("low < high").drop("low", "high"), "block-counts")
        dealt = _block_pairs(coded.join(sizes, bucket))
        found = dealt.groupBy(*bucket, "low", "high").applyInPandas(_across(self.kind, self.threshold), "a bigint, b bigint")
        found = landed(found.distinct(), "bridges")
        if found.isEmpty():
            return False
        self.bridges = found if self.bridges is None else landed(self.bridges.unionByName(found), "bridges")
        return True

    def counted(self) -> DataFrame:
        """(id, n_links, component): links in double precision, counted within components of the lists' links."""
        labels = landed(connected_components(self.links()).withColumnRenamed("node", "id"), "regions")
        members = landed(labels.join(self.vectors, "id"), "members")
        sizes = landed(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
        dealt = _block_pairs(members.join(sizes, "component"))
        counts = dealt.groupBy("component", "low", "high").applyInPandas(
            _counts(self.kind, self.threshold), "id bigint, n bigint, least bigint"
        )
        counts = landed(counts, "counts")
        # each pair of blocks gives a spanning forest of its links, so links in double precision, and no others, join
        edges = counts.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
        sure = connected_components(landed(edges, "sure")).withColumnRenamed("node", "id")
        totals = counts.groupBy("id").agg(F.sum("n").alias("n"))
        return landed(totals.join(sure, "id").select("id", "n", "component"), "counted")

    def audit(self, counted: DataFrame) -> tuple[int, int]:
        """Links found and true links of the audited vectors."""
        known = self.vectors.join(counted.select("id", "n"), "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        parts = [known.where(c).orderBy(F.xxhash64("id", F.lit(5)), "id").limit(AUDITED) for c in ("n > 0", "n = 0")]
        sample = [r for part in parts for r in part.select("id", "body", "n").collect()]
        held = self.vectors.sparkSession.sparkContext.broadcast([(r.id, bytes(r.body)) for r in sample])
        true = self.vectors.mapInPandas(_brute(held, self.kind, self.threshold), "id bigint, n bigint")
        true = true.agg(F.sum("n").alias("t")).first().t
        return sum(r.n for r in sample), true or 0


def _across(kind: str, threshold: float):
    """For the vectors of the one block of each of the other, the best link to another region."""

    def run(unit: pd.DataFrame) -> pd.DataFrame:
        ids, region = unit["id"].to_numpy(np.int64), unit["region"].to_numpy(np.int64)
        side, low, high = unit["side"].to_numpy(), unit["low"].iloc[0], unit["high"].iloc[0]
        out = []
        if (region != region[0]).any():
            x = _matrix(unit["body"], kind)
            a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
            for one, other in ((a, b), (b, a)) if len(a) and len(b) else ():
                sims = np.where(region[one][:, None] != region[other][None, :], x[one] @ x[other].T, -2)
                best = sims.argmax(axis=1)
                linked = sims[np.arange(len(one)), best] >= threshold
                p, q = ids[one[linked]], ids[other[best[linked]]]
                out.append(pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)

    return run


def _forest(linked: np.ndarray, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and the columns of a matrix of links the smallest id that links among them lead to."""
    far = np.iinfo(np.int64).max
    while True:
        near = np.minimum(one, np.where(linked, other[None, :], far).min(axis=1))
        back = np.minimum(other, np.where(linked, near[:, None], far).min(axis=0))
        if (near == one).all() and (back == other).all():
            return one, other
        one, other = near, back


def _counts(kind: str, threshold: float):
    """How many vectors of the one block each of the other links with, by copies, and the smallest id that links
    within the two blocks lead to; for vectors with links only."""

    def run(unit: pd.DataFrame) -> pd.DataFrame:
        ids, copies = unit["id"].to_numpy(np.int64), unit["copies"].to_numpy(np.int64)
        side, low, high = unit["side"].to_numpy(), unit["low"].iloc[0], unit["high"].iloc[0]
        a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
        out = []
        if len(a) and len(b):
            x = _matrix(unit["body"], kind)
            linked = (x[a] @ x[b].T >= threshold) & (ids[a][:, None] != ids[b][None, :])
            linked = linked | linked.T if low == high else linked
            least = _forest(linked, ids[a], ids[b])
            sides = [(a, linked, copies[b], least[0])] + ([(b, linked.T, copies[a], least[1])] if low != high else [])
            for members, with_others, theirs, reached in sides:
                some = with_others.any(axis=1)
                out.append(pd.DataFrame({"id": ids[members[some]], "n": with_others[some] @ theirs, "least": reached[some]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "n": [], "least": []}, dtype=np.int64)

    return run


def _brute(held, kind: str, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["body"].map(len)):
                asked = [(k, b) for k, b in held.value if len(b) == length]
                if asked:
                    ids = np.array([k for k, _ in asked])
                    linked = _matrix([b for _, b in asked], kind) @ _matrix(part["body"], kind).T >= threshold
                    linked &= ids[:, None] != part["id"].to_numpy(np.int64)[None, :]
                    yield pd.DataFrame({"id": ids, "n": linked @ part["copies"].to_numpy(np.int64)})

    return run


def near_duplicate_vectors(
    table: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Rows (id, n_links, component_id, kept, recall), one per row of ``table``; ids are whole numbers.

    Two vectors are linked where their cosine in double precision is at least ``threshold``. Vectors that are
    null, empty, zero, or hold a null, NaN or infinity are linked with nothing, nor are vectors of different
    length with each other. Equal vectors are one vector with several ids. Rows that repeat an id count
    once. A null id gives null component_id and kept. ``recall`` is the audited one, null without links. Other columns are not
    read. An empty table gives an empty result.
    """
    spark = table.sparkSession
    ship_package(spark)
    kind = "<f4" if table.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    usable = rows.where("id IS NOT NULL").mapInPandas(_usable(kind), "id bigint, digest binary, body binary").drop_duplicates(["id"])
    usable = landed(usable, "usable")
    copies = usable.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    copies = landed(copies, "copies")
    joined = usable.join(copies, "digest")
    vectors = landed(joined.where("id = first").select("id", "body", "copies"), "vectors")

    graph = _Graph(vectors, kind, threshold)
    graph.start(0)
    for _ in range(DESCENTS):
        graph.descend()
    seed = 0
    for round_ in range(ROUNDS + 1):
        # as many passes in a row as the tables need, none of which found a link between two regions
        quiet = 0
        while quiet < (1 if round_ == ROUNDS else graph.passes):
            seed += 1
            quiet = 0 if graph.bridge(seed, whole=round_ == ROUNDS) else quiet + 1
        counted = graph.counted()
        found, true = graph.audit(counted)
        if found == true or round_ == ROUNDS - 1 and found >= RECALL * true:
            break
    firsts = vectors.select("id", "copies").join(counted, "id", "left").select(
        F.col("id").alias("first"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    firsts = landed(firsts, "firsts")
    ofs = landed(joined.select("id", "first"), "of-first").join(firsts, "first").drop("first")
    result = rows.select("id").join(landed(ofs, "results"), "id", "left")
    return result.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.coalesce("component_id", "id") == F.col("id")).alias("kept"),
        F.lit(found / true if true else None).cast("double").alias("recall"),
    )
