"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Documents with equal sets are one text. A text's 128 minima give 32 band keys, which bring candidates
together, and their low 4 bits, packed into 64 bytes, from which a similarity corrected for chance
agreement is estimated by bit counts. Candidates whose estimate is not far below the threshold are compared
on their full sets, and only confirmed links count.

Groups need components, not pairs. So members of a bucket are first compared with one of them, the hub; what
is then one component needs no further comparison. The buckets that still hold several components are
gathered into clusters, and there all pairs across components are tried, block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import landed, ship_package, tidied
from millrace.llm.components import connected_components
from millrace.llm.hashing import combined, set_digest, shingle_sets
from millrace.llm.tokens import slices

HASHES, BANDS, BITS = 128, 32, 4
# how far an estimate may be below the threshold: almost five of its standard deviations
MARGIN = 0.18
BLOCK = 128

_SEED = np.random.default_rng(7)
_FACTOR = (_SEED.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFT = _SEED.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_NO_MINIMA = np.zeros(HASHES, np.uint32)


def minima(values: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set that isn't empty."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    low = None
    for at in range(0, len(x), 4096):
        part = (x[at : at + 4096] * _FACTOR + _SHIFT).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low


def packed(rows: np.ndarray) -> np.ndarray:
    """The low bits of minima, two of them in a byte."""
    low = (rows & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return low[:, 0::2] << np.uint8(4) | low[:, 1::2]


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of packed signatures (broadcast along the last axis)."""
    differ = (a ^ b).view(np.uint64)
    for shift in (1, 2):
        differ = differ | (differ >> np.uint64(shift))
    same = HASHES - np.bitwise_count(differ & np.uint64(0x1111111111111111)).sum(axis=-1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return (same / HASHES - chance) / (1 - chance)


def _signed(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].fillna("")
            for a, b in slices(texts):
                sets = shingle_sets([t.encode("utf-8", "replace") for t in texts.iloc[a:b]], words)
                rows = np.stack([minima(s) if len(s) else _NO_MINIMA for s in sets])
                bands = combined(rows.reshape(len(sets), BANDS, -1), np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                signs = packed(rows)
                yield pd.DataFrame(
                    {
                        "id": batch["id"].iloc[a:b],
                        "n_shingles": [len(s) for s in sets],
                        "set_key": [set_digest(s) if len(s) else None for s in sets],
                        "bands": list(bands),
                        "sign": [s.tobytes() for s in signs],
                    }
                )

    return run


def _compressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        bodies = [pack.compress(t.encode("utf-8", "replace")) for t in batch["text"].fillna("")]
        yield pd.DataFrame({"id": batch["id"], "body": bodies})


def _estimated(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1) for c in ("sign_a", "sign_b"))
                yield batch.loc[estimates(a, b) >= least, ["a", "b"]]

    return run


def _confirmed(words: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                bodies = {**dict(zip(part["a"], part["body_a"])), **dict(zip(part["b"], part["body_b"]))}
                sets = dict(zip(bodies, shingle_sets([unpack.decompress(x) for x in bodies.values()], words)))
                keep = []
                for a, b in zip(part["a"], part["b"]):
                    x, y = sets[a], sets[b]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield part.loc[keep, ["a", "b"]]

    return run


def _merging(words: int, percent: int, least: float):
    """Links that join components in one unit: between two blocks of a cluster, or within one block.

    Pairs of one component are passed over, also where the unit itself has just joined it.
    """

    def run(unit: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        ids, labels = unit["id"].to_numpy(np.int64), unit["component"].to_numpy(np.int64).copy()
        signs = np.frombuffer(b"".join(unit["sign"]), np.uint8).reshape(len(unit), -1)
        sets = shingle_sets([unpack.decompress(x) for x in unit["body"]], words)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        rows = np.flatnonzero(unit["side"] == unit["low"])
        cols = np.flatnonzero(unit["side"] == unit["high"])
        links = []
        for k in rows:
            to = cols[labels[cols] != labels[k]]
            to = to[100 * np.minimum(sizes[k], sizes[to]) >= percent * np.maximum(sizes[k], sizes[to])]
            to = to[estimates(signs[k][None, :], signs[to]) >= least] if len(to) else to
            if not len(to):
                continue
            every = np.concatenate([sets[t] for t in to])
            place = np.minimum(np.searchsorted(sets[k], every), sizes[k] - 1)
            shared = np.add.reduceat(sets[k][place] == every, np.cumsum(sizes[to]) - sizes[to], dtype=np.int64)
            for t in to[100 * shared >= percent * (sizes[k] + sizes[to] - shared)]:
                if labels[t] != labels[k]:
                    links.append((ids[k], ids[t]))
                    labels[labels == labels[t]] = labels[k]
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return run


def _spanning(links: DataFrame, again: int = 1) -> DataFrame:
    """Fewer links that join the same texts: each member with its smallest hub, and that hub with the member's others.

    A member has at most as many hubs as there are bands, and members of a large group share theirs, so what is left
    is about one link per member, however many hubs confirm it. Hubs are thinned out ``again`` in the same way.
    """
    links = landed(links, "all-links")
    held = links.groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("hubs"))
    own = held.select(F.get("hubs", F.lit(0)).alias("a"), "b")
    others = held.select(F.get("hubs", F.lit(0)).alias("a"), F.explode(F.expr("slice(hubs, 2, size(hubs))")).alias("b"))
    others = others.distinct()
    return own.unionByName(_spanning(others, again - 1) if again else others)


class _Links:
    """Candidate pairs to confirmed links, and the components they make."""

    def __init__(self, signs: DataFrame, bodies: DataFrame, words: int, percent: int):
        self.signs, self.bodies, self.words, self.percent = signs, bodies, words, percent
        self.links: DataFrame | None = None

    def _beside(self, pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("id").alias(side), F.col(column).alias(f"{column}_{side}")), side)
        return pairs

    def confirm(self, pairs: DataFrame) -> None:
        """Add the links among distinct candidate pairs (a, b)."""
        likely = self._beside(pairs, self.signs, "sign")
        likely = likely.mapInPandas(tidied(_estimated(self.percent / 100 - MARGIN)), "a bigint, b bigint")
        likely = landed(likely, "likely")
        full = self._beside(likely, self.bodies, "body")
        self.add(_spanning(full.mapInPandas(tidied(_confirmed(self.words, self.percent)), "a bigint, b bigint")))

    def add(self, links: DataFrame) -> None:
        links = landed(links, "links")
        self.links = links if self.links is None else self.links.unionByName(links)

    def labels(self, members: DataFrame) -> DataFrame:
        """(id, component) of every id of ``members``."""
        found = connected_components(self.links).withColumnRenamed("node", "id")
        return members.select("id").distinct().join(found, "id", "left").select(
            "id", F.coalesce("component", "id").alias("component")
        )


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with components, of the buckets that hold several components."""
    labelled = landed(members.join(labels, "id").select("bucket", "id", "component"), "labelled")
    spread = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = landed(spread.where("x <> y").select("bucket"), "open-buckets")
    return landed(labelled.join(open_, "bucket"), "open")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (id, n_shingles, component_id, kept), one per row of ``docs``; ids are whole numbers.

    Words are runs without ASCII white space, A-Z in lower case. A set holds the distinct runs of ``words``
    words, or the whole sequence of a shorter text. Two texts are linked where 100 * intersection >= percent
    * union. Null, empty and blank texts have an empty set and are linked with nothing. Rows that repeat an
    id and its text get equal results. A row with a null id takes part in no link: its component_id and kept
    are null. Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    signed = rows.where("id IS NOT NULL").mapInPandas(
        tidied(_signed(words)), "id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sign binary"
    )
    signed = landed(signed, "signed")
    one = signed.where("set_key IS NOT NULL").groupBy("set_key")
    texts = landed(one.agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sign").alias("sign")), "texts")

    in_band = texts.select("id", F.explode("bands").alias("bucket"))
    hubs = in_band.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
    hubs = landed(hubs.where("hub <> last").select("bucket", "hub"), "hubs")
    members = landed(in_band.join(hubs, "bucket").select("bucket", "id", "hub"), "members")
    candidates = landed(members.select("id").distinct(), "candidates")
    bodies = rows.where("id IS NOT NULL").mapInPandas(tidied(_compressed), "id bigint, body binary")
    bodies = landed(bodies.join(candidates, "id").drop_duplicates(["id"]), "bodies")

    links = _Links(landed(texts.select("id", "sign").join(candidates, "id"), "signs"), bodies, words, percent)
    first = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links.confirm(first)
    members = members.drop("hub")
    open_ = _open_buckets(members, links.labels(members))
    links.add(_joining_links(open_, links, words, percent))

    labels = landed(links.labels(candidates), "components")
    keyed = texts.select("set_key", "id").join(labels, "id", "left")
    keyed = landed(keyed.select("set_key", F.coalesce("component", "id").alias("component")), "set-components")
    result = signed.select("id", "n_shingles", "set_key").join(keyed, "set_key", "left")
    result = result.select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    nameless = rows.where("id IS NULL").mapInPandas(
        tidied(_signed(words)), "id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sign binary"
    )
    nameless = nameless.select("id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    result = result.unionByName(nameless)
    return result.select(F.col("id").alias(id_col), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _joining_links(open_: DataFrame, links: _Links, words: int, percent: int) -> DataFrame:
    """The links that join components which share a bucket.

    Buckets that share texts make a cluster, in which every text stands once. Its texts are dealt into blocks
    and each pair of blocks is one unit of work, so a large cluster is many small tasks.
    """
    hubs = open_.groupBy("bucket").agg(F.min("id").alias("hub"))
    star = open_.join(landed(hubs, "hubs"), "bucket").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    clusters = connected_components(landed(_spanning(star.distinct()), "stars")).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    clusters = landed(clusters.join(open_.select("id", "component").distinct(), "id"), "clusters")
    sizes = landed(clusters.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    dealt = clusters.join(links.signs, "id").join(links.bodies, "id")
    dealt = dealt.join(sizes, "cluster").withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "cluster", "id", "component", "sign", "body", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    )
    merging = _merging(words, percent, percent / 100 - MARGIN)
    return dealt.groupBy("cluster", "low", "high").applyInPandas(merging, "a bigint, b bigint")
