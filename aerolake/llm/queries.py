"""The registered queries of the operators; ``sql`` has the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, divergence, exact_dedup, language_id, mixing, near_dup, periodic,
               quality, substring_dedup, suffix_dedup, token_file, url_filter)
from .common import held_out, shared_dir
from .sql import SQL, mix_sql  # noqa: F401

# Fixed by the queries' contract.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]
END_ID = 1
# The mixture of the test tables: a domain is a group of sources.
DOMAINS = ("web", "news", "books", "forum")
MIX_WEIGHTS = [{"web": 4, "news": 3, "books": 2, "forum": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1}, {}]
VOCAB_SIZE = 49408


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("digest", "text_sha256")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return substring_dedup.repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def domain_of(source: Column) -> Column:
    """The sources' numbers, modulo four, name their domain in the test tables."""
    number = F.regexp_extract(source, "[0-9]+", 0).try_cast("long")
    return F.element_at(F.array(*map(F.lit, DOMAINS)), (F.coalesce(number, F.lit(0)) % 4 + 1).cast("int"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, leaves = mixing.mix(table(spark, sf_dir, "documents"), domain_of(F.col("source")), MIX_WEIGHTS)
    return docs.select("row.doc_id", *mixing.LEAF, "n_tokens", "copies")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair_chats(table(spark, sf_dir, "conversations"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    token_file.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizer("word_bpe_49k.json"),
                            END_ID, VOCAB_SIZE)
    return token_file.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is the label whose ``doc_id`` is its ``page_id``;
    bad is low quality or toxic."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return url_filter.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES).drop("bad_rate")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.jaccard_classes(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, public_tokenizer("piece_bpe_32k.model"))
    return language_id.identify(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run (ties: smallest start, then period) and digests of all."""
    docs = table(spark, sf_dir, "documents")
    found = periodic.periodic_runs(docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.col3")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_audit(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mixing": op3_mixing,
    "op4_chat_format": op4_chat_format,
    "op5_token_file": op5_token_file,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_divergence": op12_divergence,
    "op13_suffix_dedup": op13_suffix_dedup,
}
