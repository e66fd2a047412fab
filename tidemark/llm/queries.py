"""The registered queries of this folder, with SQL where SQL can state the same rows."""

from __future__ import annotations

import public_tokenizers

from tidemark.llm import bpe, decontam, divergence, hmm, langid, neardup, ngramjoin, quality, resample, tokencount, tokenfiles, toxicity, warc
from tidemark.llm.common import is_remainder, is_training, table

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


@query("op1_warc", warc.SQL)
def op1_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query("op2_repetition")
def op2_repetition(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@query("op3_token_files")
def op3_token_files(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return tokenfiles.token_files(table(spark, sf_dir, "documents"), tokenizer, end_id=2)


@query("op4_language")
def op4_language(spark, sf_dir):
    found = langid.languages(table(spark, sf_dir, "documents"), is_training("doc_id", 5, 0))
    return found.withColumn("held_out", is_remainder("doc_id", 5, 0))


@query("op5_decontamination")
def op5_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer, limit=512)


@query("op7_near_duplicates")
def op7_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_hmm")
def op8_hmm(spark, sf_dir):
    scores = hmm.language_model(table(spark, sf_dir, "documents"), is_training("doc_id", 7, 2))
    return scores.withColumn("held_out", is_remainder("doc_id", 7, 2))


@query("op9_bpe")
def op9_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.bpe(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.fit(docs, labels, is_training("doc_id", 5, 0)))
    return found.withColumn("held_out", is_remainder("doc_id", 5, 0))


@query("op11_ngram_join")
def op11_ngram_join(spark, sf_dir):
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents"))


@query("op12_divergence", divergence.SQL)
def op12_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query("op13_resampling", resample.SQL)
def op13_resampling(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
