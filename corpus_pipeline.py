"""Documents to token ids in stages, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept and all but the last return the columns of
documents. Rows with a null id or text are handled as each operator states; an empty table passes
through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, langid, neardup, quality
from tidemark.llm.common import bounded_batches, is_training, table, without_ids
from tidemark.session import shared_path, via_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KINDS = "text string, lang string, source string, n_chars long"
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition limits."""
    bounded_batches(spark)
    return quality.quality(docs, extra=KINDS).where("kept").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which a language is found; all of them if no label can be learned from."""
    bounded_batches(spark)
    training = is_training("doc_id", 5, 0)
    net = langid.fit(*langid.training_rows(docs, training, langid.PER_LANGUAGE, langid.MAX_LANGUAGES))
    if net is None:
        return docs.select(*COLUMNS)
    return langid.identify(docs, net, KINDS).where(F.col("lang_pred") != langid.UNKNOWN).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every near-duplicate class; a repeated row stays once."""
    bounded_batches(spark)
    others = via_table(neardup.near_duplicates(docs).where("doc_id <> class_id").select("doc_id"), "others")  # read twice
    return without_ids(docs.select(*COLUMNS), others, once=True)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    bounded_batches(spark)
    found = via_table(decontam.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id"), "leaks")  # read twice
    return without_ids(docs.select(*COLUMNS), found)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document left, with the digests that prove the round trip."""
    bounded_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.bpe(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality", quality_rules),
    ("language", language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_leaks),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
