"""Registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, bpe, collocations, extraction, iblt, lines, mixing, negatives, quality, shards, simhash, suffixes, wordpiece
from .common import read_table
from .oracles import ORACLES  # noqa: F401  registered beside the queries

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed_chunks", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("row") % 50 == 0, k=5)


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(read_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(read_table(spark, sf_dir, "documents"), 24)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mixing, op2_line_dedup, op3_ann, op4_suffix_array, op5_token_counts, op6_byte_bpe, op7_sharding, op8_quality, op9_simhash, op10_iblt, op11_collocations, op12_hard_negatives, op13_html_extraction)}
