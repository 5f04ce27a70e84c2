"""From raw documents to packed sequences, stage by stage.

Each stage is written as Parquet and read again by the next. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import landed
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import mix, mixed_rows
from millrace.llm.packing import SLICE_BYTES, pack_documents
from millrace.llm.pii import replace_personal_data
from millrace.llm.queries import TOKENIZER
from millrace.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic.

    Null and empty texts get the score of texts without terms, null ids and repeated rows are scored like others, and
    labels without a document or with another value than 0 and 1 teach nothing.
    """
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more.

    The smallest id of a group stays, with all rows that repeat it. Null, empty and blank texts are in no group and stay,
    and so do documents with a null id.
    """
    found = near_duplicates(docs, words=5, percent=80)
    gone = landed(found.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by surrogates.

    No row goes. A null text stays null, with a null n_chars; equal entities get equal surrogates in every row.
    """
    masked = replace_personal_data(docs, key="pipeline").drop("n_entities")
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents repeat, stay once, end early or go.

    A null source is one of the sources, the last. Null and empty texts have no words, so nothing is taken of them and they
    go. Equal hash keys are ordered by id and size.
    """
    others = [c for c in docs.columns if c != "doc_id"]
    mixed = mixed_rows(mix(docs, keep=others))
    return mixed.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences.

    A null text is an empty one: a piece with the end id. Repeated rows and null ids are packed like others.
    """
    # executors are filled by the stages before, and the job has more time than memory left
    packed = pack_documents(docs, TOKENIZER, slice_bytes=SLICE_BYTES // 2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity),
    ("deduplication", deduplication),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = landed(docs, name)
    return docs


# packing and shuffling have no SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None
