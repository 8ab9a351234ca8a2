"""Corpus pipeline: five stages over the ``documents`` table, each one operator.

Quality classifier (rejected documents go), SimHash near-dedup (the smallest id of
each group stays), benchmark decontamination (leaking documents go), secret scans
(secret values are replaced), BPE encoding with its decoding as the last table. Every
stage works on all that the one before it kept, read back from Parquet.

Defined cases: a null text is empty to every stage, and all but the last return it as it
is; rows are judged one by one, so a null or repeated id neither saves nor drops another
row; of rows equal in fingerprint the one with the smallest id stays (null last, then the
first stored), also of rows that share id and text; an empty table stays empty through
all stages; the columns of ``documents`` are kept whatever they are called, the last
stage returns ``doc_id`` and the encoding alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import bpe, decontam, quality, secrets, simhash
from vaultline.session import materialize

#: A document stays if its score reaches this.
MIN_QUALITY = 0.3
#: Words a shingle, and differing bits that still link.
SHINGLE, MAX_BITS = 4, 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return quality.accepted(docs, labels, MIN_QUALITY)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.fit(secrets.corpus_counts(docs)))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(docs, path, decoded=True)
    return coded.select(F.col("id").alias("doc_id"), F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", replace_secrets),
    ("bpe encoding and decoding", encode),
]

#: SQL cannot express the classifier or the encoding; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result but the last is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline_{name.replace(' ', '_')}")
    return docs
