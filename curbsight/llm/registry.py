"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.llm import (
    alignment,
    decontamination,
    fingerprints,
    line_dedup,
    lm_scoring,
    main_text,
    near_dedup,
    packing,
    quality,
    secret_scan,
    spelling,
    token_files,
    url_filters,
)
from curbsight.llm.common import ship
from curbsight.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

CRC32 = "crc32(ids)"


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, word_bpe(), end_id=1)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.expr(CRC32).alias("ids_crc32"))


def n_chars(column: str) -> Column:
    return F.length(column).cast("long")


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, word_bpe(), end_id=0, capacity=2048, with_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                           keep=["doc_id"])
    listed = "concat_ws(',', array_sort(transform(items, x -> string(x))))"
    return decontamination.contaminated(found).selectExpr(
        "doc_id", "n_words", "n_hit", "cast(size(items) as long) as n_items", f"sha2({listed}, 256) as items_sha256",
        "contaminated")


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", n_chars("text"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs).select("doc_id", "class_id", "kept")


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["order"] < len(secret_scan.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(r.kind) for r in secret_scan.BASE),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.cross_entropy_difference(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("quality") == 1)


#: The listed rules of the URL query.
URL_RULES = (
    url_filters.Rule("allow", "org", "/"),
    url_filters.Rule("block", "example.org", "/es/"),
    url_filters.Rule("block", "example.org", "/en/1"),
    url_filters.Rule("allow", "com", "/fr/"),
    url_filters.Rule("block", "com", "/de/"),
)


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), least_chars=7, least_count=2, misspell_every=31)
    return spelling.spelling_variants(words, times=10)


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
