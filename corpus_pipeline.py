"""From documents to packed sequences of training text.

Each stage gets what its predecessor kept, as a written table. The first four return the
columns of documents, the last the places of the documents' pieces in the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm import near_dups, packing, quality, repeats, secrets
from firmlens.llm.storage import stored

#: Words of a shingle of the fingerprints of near copies.
COPY_WORDS = 3
#: Bytes of a repeated string: fewer than a passage of 50 words has.
REPEATED_BYTES = 200
SEQUENCE_TOKENS, END_ID = 1024, 2
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def recounted(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of characters of its changed texts."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line labels reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(docs, quality.fit_to_labels(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints that differ in two bits or fewer stays."""
    return near_dups.without_simhash_copies(docs, COPY_WORDS)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of long strings go."""
    return recounted(repeats.without_repeats(docs, REPEATED_BYTES))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out."""
    return recounted(secrets.redact(docs, BYTE_RANKS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, BYTE_BPE, SEQUENCE_TOKENS, END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_dedup),
    ("secret scans", secret_scan),
    ("best-fit packing", pack),
]

#: SQL cannot express the stages; the tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + "-".join(name.split()))
    return STAGES[-1][1](spark, docs, sf_dir)
