"""A training-corpus pipeline: language ID, near duplicates, decontamination,
mixing, token files.

Every stage takes all rows that the stage before it kept and returns the
columns of ``documents``; the last returns a row per tokenised document, read
back from the token files.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import language_id, mixing, near_dup, token_file
from aerolake.llm.common import broadcast_if_small, materialize, shared_dir
from aerolake.llm.decontaminate import benchmark_hits
from aerolake.llm.queries import END_ID, MIX_WEIGHTS, VOCAB_SIZE, domain_of, public_tokenizer, table

# Least posterior of the best language for a document to stay.
LEAST_LANGUAGE = 0.5
# Share of all tokens that the mixture takes, each document at most once.
MIX_SHARE = 0.8


# Bytes of a batch that Python workers get: the stages' workers live on side by side
# with executors that have run all stages, so they hold less at a time than the
# operators alone.
BATCH_BYTES = 1 << 20


def _small_batches(stage):
    """A stage whose Python workers get small batches. The setting is read when the
    result is written, so it stays; operators only ever lower it."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxBytesPerBatch"
        spark.conf.set(key, f"{BATCH_BYTES}b")
        return stage(spark, docs, sf_dir)
    return run


def _packed(docs: DataFrame) -> DataFrame:
    """All columns but the text in place of the id, for operators that return ids and texts."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc_id"), "text")


def _unpacked(judged: DataFrame, docs: DataFrame) -> DataFrame:
    return judged.select("doc_id.*", "text").select(*docs.columns)


@_small_batches
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; texts without a letter or with no
    clear language go. An empty table stays empty."""
    model = language_id.fit(docs, public_tokenizer("piece_bpe_32k.model"))
    judged = language_id.identify(_packed(docs), model, with_text=True)
    kept = judged.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE))
    return _unpacked(kept, docs)


@_small_batches
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near duplicates, one
    row of it. Rows without id are no copies of others and stay."""
    classes = materialize(near_dup.jaccard_classes(docs), "classes").where("doc_id is not null")
    dropped = classes.where("doc_id <> class_id").select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(dropped), "doc_id", "left_anti")
    repeated = classes.where("doc_id = class_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    repeated = broadcast_if_small(repeated)
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(*docs.columns)


@_small_batches
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten consecutive words of a benchmark item."""
    judged = benchmark_hits(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(judged.where("size(items) = 0 and size(spans) = 0"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's share of the tokens, each document once."""
    mixed, _ = mixing.mix(docs, domain_of(F.col("source")), MIX_WEIGHTS, share=MIX_SHARE, epochs=1)
    return mixed.where("copies > 0").select("row.*")


@_small_batches
def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the written files."""
    folder = shared_dir(spark, "corpus-tokens")
    token_file.write_tokens(docs, folder, public_tokenizer("word_bpe_49k.json"), END_ID, VOCAB_SIZE)
    return token_file.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", keep_languages),
    ("jaccard_join", keep_one_of_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("mixing", mix_sources),
    ("token_file", write_token_files),
]

# The language model's scores cannot be expressed in SQL; tests/llm holds the
# pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
