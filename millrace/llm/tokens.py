"""Token counts through a cache of digests.

A text is known by the SHA-256 of its normalised form, a tokenizer by the SHA-256 of its file, the library's
version and the normalisation. Counts of known pairs come from the stored table by a join; only the distinct
texts that miss are encoded, and their counts are appended to it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, byte_count, fresh_path, landed, ship_package

CACHE_SCHEMA = "version string, digest binary, n_tokens bigint"
# entries of a worker's table of encoded words; it holds bytes, about 200 of them each
MEMO_WORDS = 250_000
MEMO_CHARS = 48
# what Python's split() takes for white space beyond that of ASCII
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")
_ASCII_RUN = re.compile("[^ \t\n\x0b\x0c\r]+")
# fixed values: pre-tokenizer patterns under which no token holds or looks past white space
SPACE_FREE = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def is_space_free(path: str) -> bool:
    """Whether the words of a text can be encoded one by one with the same result."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        steps = (json.load(file).get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    first = steps[0]
    pattern = (first.get("pattern") or {}).get("Regex")
    return first.get("behavior") == "Removed" and bool(first.get("invert")) and pattern in SPACE_FREE


def tokenizer_version(path: str) -> str:
    """Digest of all that decides the tokens of a normalised text."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    rule = "spaces" if is_space_free(path) else "none"
    return hashlib.sha256(f"{content}|{library.__name__} {library.__version__}|{rule}".encode()).hexdigest()


def normalised(text: Column, path: str) -> Column:
    """What the digest is taken of: null is empty; runs of ASCII white space become one blank where the
    tokenizer drops white space anyway."""
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, SPACE, " ")) if is_space_free(path) else text


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, as the library gives them without added tokens.

    For a space-free tokenizer each distinct word is encoded once per batch, frequent ones once per worker:
    the misses go to the library in one text, separated by a token that no other word yields.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.words = is_space_free(path)
        self.memo: dict[str, bytes] = {}
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
        else:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        if self.words:
            (self.mark,) = self._library_ids(["\x00"])[0]

    def _library_ids(self, texts: Sequence[str]) -> list[list[int]]:
        if hasattr(self.library, "encode_batch_fast"):
            return [e.ids for e in self.library.encode_batch_fast(list(texts), add_special_tokens=False)]
        return self.library.encode(list(texts), num_threads=1)

    @staticmethod
    def _packed(ids) -> bytes:
        import numpy as np

        return np.asarray(ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        import numpy as np

        plain = [w for w in words if "\x00" not in w]
        for w in words:
            if "\x00" in w:
                self.memo[w] = self._packed(self._library_ids([w])[0])
        for at in range(0, len(plain), 20_000):
            part = plain[at : at + 20_000]
            ids = np.asarray(self._library_ids([" \x00 ".join([*part, ""])])[0], dtype="<u4")
            ends = np.flatnonzero(ids == self.mark)
            data, start = ids.tobytes(), 0
            assert len(ends) == len(part), "a word of its own lost its separator"
            for w, end in zip(part, (ends * 4).tolist()):
                self.memo[w] = data[start:end]
                start = end + 4

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not self.words:
            return [self._packed(ids) for ids in self._library_ids(texts)]
        split = [_ASCII_RUN.findall(t) if _OTHER_SPACE.search(t) else t.split() for t in texts]
        missing = list(set().union(*split).difference(self.memo)) if split else []
        self._learn(missing)
        memo = self.memo
        out = [b"".join([memo[w] for w in words]) for words in split]
        room = MEMO_WORDS - (len(memo) - len(missing))
        for k, w in enumerate(missing):
            if k >= room or len(w) > MEMO_CHARS:
                del memo[w]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file; it outlives tasks, so its table of words does too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def slices(texts: pd.Series, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` characters, at least one row each."""
    start = chars = 0
    for k, text in enumerate(texts):
        if chars and chars + len(text) > most:
            yield start, k
            start, chars = k, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


def _first_seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set[bytes] = set()
    for batch in batches:
        new = []
        for digest in batch["digest"]:
            new.append(digest not in seen)
            seen.add(digest)
        yield batch[new]


def _encode_misses(path: str, version: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _first_seen(batches):
            counts: list[int] = []
            for a, b in slices(batch["body"]):
                counts += [len(ids) // 4 for ids in encoder(path).encode(batch["body"].iloc[a:b].tolist())]
            yield pd.DataFrame({"version": version, "digest": batch["digest"], "n_tokens": counts})

    return run


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version, one row per digest, whoever appended what."""
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def open_cache(spark: SparkSession, cache: str | None = None) -> str:
    """The folder of a cache; where it has no table yet, an empty one is written. None names a fresh one."""
    cache = cache or fresh_path(spark, "token-cache")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    return cache


def extend_cache(docs: DataFrame, path: str, cache: str, text: str = "text") -> DataFrame:
    """Append the counts of the texts that the cache lacks; returns the counts it then holds.

    Each task drops the copies it has seen before texts are shuffled, so a text that fills a third of the
    table moves once per task. Texts of one digest then meet in one task, which encodes the first.
    """
    spark, version = docs.sparkSession, tokenizer_version(path)
    ship_package(spark)
    body = docs.select(normalised(F.col(text), path).alias("body"))
    body = body.select(F.unhex(F.sha2("body", 256)).alias("digest"), "body")
    once = body.mapInPandas(_first_seen, body.schema).repartition("digest")
    known = stored_counts(spark, cache, version).select("digest")
    misses = once.join(known, "digest", "left_anti")
    misses.mapInPandas(_encode_misses(path, version), CACHE_SCHEMA).write.mode("append").parquet(cache)
    return landed(stored_counts(spark, cache, version), "token-counts")


def count_tokens(
    docs: DataFrame, path: str, cache: str | None = None, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (id, n_bytes, n_tokens), one per row of ``docs``, repeated rows included.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null. Other columns are not read, so
    their names may clash. An empty table gives an empty result. ``cache`` is a folder all executors reach;
    runs that share it must not append at the same time.
    """
    cache = open_cache(docs.sparkSession, cache)
    counts = extend_cache(docs, path, cache, text)
    rows = docs.select(
        F.col(id_col).alias("__id"),
        byte_count(F.col(text)).alias("n_bytes"),
        F.unhex(F.sha2(normalised(F.col(text), path), 256)).alias("digest"),
    )
    return rows.join(counts, "digest").select(F.col("__id").alias(id_col), "n_bytes", "n_tokens")
