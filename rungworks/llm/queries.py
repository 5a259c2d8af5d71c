"""The corpus operators as registered queries, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rungworks.llm import bpe, conversations, exact, lines, minhash, mixing, mtree, pii, quality, toxicity, urls, variants, warc
from rungworks.llm.sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.mark_near_duplicates(_documents(spark, sf_dir), percent=85)


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = rank_file()
    coded = bpe.encode(_documents(spark, sf_dir).select("doc_id", "text"), ranks).drop("text")
    return bpe.digests(bpe.decode(coded, ranks)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_boilerplate(_documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != pii.TERM)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind, *_ in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact.mark_copies(_documents(spark, sf_dir))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve(warc.archive_and_read(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(quality.metrics(_documents(spark, sf_dir)), known=quality.METRICS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mtree.top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.summary(table, conversations.damaged(table))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = variants.runs(_documents(spark, sf_dir).select("doc_id", "text"))
    return variants.group_variants(variants.vocabulary(variants.misspell(runs))).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mixing,
        op2_toxicity,
        op3_minhash_dedup,
        op4_byte_bpe,
        op5_line_dedup,
        op6_url_filters,
        op7_pii,
        op8_exact_dedup,
        op9_warc,
        op10_quality_rules,
        op11_exact_topk,
        op12_conversation_repair,
        op13_spelling_variants,
    )
}
