"""A corpus in, token digests out: the stages of the text pipeline, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import bm25_leaks, hyper_language, line_chunks, queries, trie_join
from zonalis.sources.session import shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language: those that score as high as some labelled document does without itself.

    Texts without any letter, and null texts, go. If no language was learned, all documents pass unchanged.
    """
    totals = hyper_language.fit_totals(docs)
    profiles = hyper_language.unit(totals)
    if not profiles:
        return docs
    floor = hyper_language.score_floor(docs, totals)
    return hyper_language.in_learned_languages(docs, profiles, floor)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated runs of two or more lines out of all documents but the first; ``n_chars`` follows the text."""
    kept = line_chunks.dedup_line_passages(docs, carry=docs.columns)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*(new.get(c, F.col(f"carried.{c}")).alias(c) for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of linked documents, and one row of those that repeat id and text.

    Documents without an id are in no group: one row of each text stays. Rows of one id with different texts go or stay
    together. Only rows without an id or with a repeated one are compared as texts.
    """
    groups = trie_join.ngram_components(docs)
    kept = docs.join(groups.filter("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    once = kept.filter("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti").select(*docs.columns)
    again = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return once.union(again.union(docs.filter("doc_id IS NULL")).dropDuplicates(["doc_id", "text"]))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a leaked test item go, whatever their id."""
    return bm25_leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return queries.bpe_digests(docs)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark),
          ("tokens", tokens)]

#: The language stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
