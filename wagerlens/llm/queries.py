"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.llm.common import table
from wagerlens.llm import exact_topk, lines, multiindex, phrases
from wagerlens.llm.langid import identify
from wagerlens.llm.packing import pack_documents
from wagerlens.llm.pii import private_digests
from wagerlens.llm.resharding import reshard
from wagerlens.llm.sampling import sampled_digests
from wagerlens.llm.simhash import near_duplicates
from wagerlens.llm.token_files import token_file_digests
from wagerlens.llm.whitening import whiten
from wagerlens.llm.wordpiece import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add


@query("op1_cost_balanced_packing")
def cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op2_elias_fano_token_files")
def elias_fano_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(spark, table(spark, sf_dir, "documents"))


@query("op3_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_site_line_frequency", lines.check_sql())
def site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_site_lines(docs, dropped="n_dropped")


@query("op4_hierarchical_language")
def hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op6_longest_match_counts")
def longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query("op7_minimum_cost_resharding")
def minimum_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From six shards by source, one of them far larger than the others, to eight even ones."""
    docs = table(spark, sf_dir, "documents")
    return reshard(docs, F.pmod(F.xxhash64(F.col("source").cast("string")), F.lit(6)), shards=8)


@query("op8_multi_index_near_vectors", multiindex.check_sql())
def multi_index_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_sampled_segmentation")
def sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_digests(table(spark, sf_dir, "documents"))


@query("op10_exact_top_k", exact_topk.check_sql())
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op11_candidate_boosting")
def candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_digests(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query("op13_phrase_collocations", phrases.check_sql())
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
