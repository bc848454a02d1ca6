"""The registered queries of the subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import bpe, collocations, decontaminate, fingerprint, hard_negatives, language, near_dup, quality, repeats, secrets, toxicity, url_filter, warc
from shelfrank.llm.oracle_sql import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ORACLE", "QUERIES"]


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(spark, table(spark, sf_dir, "documents"))


@register("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


@register("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


@register("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = quality.held_out(folds=3, fold=1)
    model = language.fit(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return language.predict(spark, docs.drop("lang"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: The rules that op5 is asked for.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@register("op5_url_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.decide(spark, table(spark, sf_dir, "pages"), URL_RULES)


@register("url_aliases")
def url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op 5 with redirects, which the pages themselves don't hold: each page but every fourth redirects to the one before."""
    pages = table(spark, sf_dir, "pages")
    before = pages.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("dst"))
    redirects = pages.where("page_id % 4 <> 0").select("page_id", F.col("url").alias("src")).join(before, "page_id").select("src", "dst")
    return url_filter.decide(spark, pages, URL_RULES, redirects)


@register("op6_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(spark, table(spark, sf_dir, "documents"))


@register("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(warc.read(spark, warc.write(spark, table(spark, sf_dir, "pages"))))


@register("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=False, decoded=True)
    return made.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality")
    return quality.score(spark, docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return toxicity.score(spark, docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@register("op11_hard_negatives")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(spark, rows, F.col("vec_id") % 50 == 0)


@register("op12_collocations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(spark, table(spark, sf_dir, "documents").select("text", "lang"))


@register("op13_repeated_passages")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(repeats.without_repeats(spark, table(spark, sf_dir, "documents").select("doc_id", "text")))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
