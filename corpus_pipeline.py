"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Every stage but the last returns the columns of ``documents`` for the rows that it keeps:

1. quality: rows that the classifier (op 9), learnt from the labels, predicts as 0 go;
2. near_duplicates: one row of each component of near copies (op 6, from a similarity of 0.8 on) stays, that with the smallest doc_id;
   rows that share a doc_id are one document, rows without one are no copies of anything;
3. decontaminate: every benchmark span (op 3) is cut out of its text, and documents of which such spans
   cover more than half of the words go;
4. secrets: every span of the secret scan (op 2) is masked;
5. bpe: the text as token ids (op 8), with their number and whether they decode to the text again.

Null and empty texts pass stages 2 to 5 unchanged; stage 1 judges them by the classifier's bias.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm import bpe, decontaminate, near_dup, quality
from shelfrank.llm import secrets as secret_scan
from shelfrank.llm.tables import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents of which more than this share of the words is benchmark text go.
MOST_COVERED = 0.5
#: Near copies share this much of their five-word shingles (percent of the union); op6 itself is asked for 85.
NEAR_PERCENT = 80


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, "quality")
    return quality.score(spark, docs.select(COLUMNS), model).where("predicted = 1").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_dup.near_duplicates(spark, docs, percent=NEAR_PERCENT).where("kept and doc_id is not null").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy("text", "lang", "source", "n_chars")
    rows = docs.select(COLUMNS).where("doc_id is not null").withColumn("row_", F.row_number().over(first)).where("row_ = 1")
    return rows.join(kept, "doc_id", "left_semi").select(COLUMNS).union(docs.where("doc_id is null").select(COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find(spark, docs.select(COLUMNS), items)
    return decontaminate.remove(found, MOST_COVERED, max_span=1).select(COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(secret_scan.find(docs.select(COLUMNS))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = bpe.encode(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.json"), ids=True, decoded=True)
    return made.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "ids_sha256",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality", by_quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", tokens),
]

#: SQL can express neither the classifier nor the tokens; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; every result is a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
