"""One query per operator, over its whole table, with the parameters it would run with."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.llm import alignment, bpe, chat, jaccard, language, negatives, oracles, packing, quality, token_counts, topk, toxicity, url_filter, warc
from keyloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL = oracles.ORACLE_SQL
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(f):
    """Register a query under its name; the executors are given the package's code first."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: verdict, host, path
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rules and by the decisions on its aliases."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge_urls(pages, rules)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from labels outside the held-out fifth."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, its posterior, and whether the document is kept."""
    return language.identify(documents(spark, sf_dir))


@query
def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3's operator on raw pages: language of every page by its text, markup language, address suffix and host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return language.identify(language.page_evidence(pages)).withColumnRenamed("doc_id", "page_id")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules on every document."""
    return quality.rule_report(documents(spark, sf_dir))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than 512 tokens)."""
    counts = token_counts.token_counts(documents(spark, sf_dir), TOKENIZER)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), TOKENIZER, capacity=2048)


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their 4-word shingles."""
    return jaccard.jaccard_components(documents(spark, sf_dir), k=4, percent=85)


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe.round_trip_digests(documents(spark, sf_dir), TOKENIZER)


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical turns of every conversation, as recovered from a transcript with a third of the markers missing.

    The model is fitted on the conversations whose crc32 of the id, modulo 5, is not 0.
    """
    turns = chat.transcript(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    model = chat.fit(turns.filter(~toxicity.held_out("conv_id")))
    return chat.parse(turns, model).withColumn("held_out", toxicity.held_out("conv_id"))


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of every document under two tokenizers, and what the corpus' pair counts say of them."""
    aligned = alignment.align(documents(spark, sf_dir), TOKENIZER, PIECES)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives that hold all pages, a gzip member per record, as is customary."""
    found = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"), compress=True).filter("kind = 'record'")
    return found.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector for each of its five nearest vectors of its label, a seventh of the labels moved on by one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)
