"""Corpus pipeline: from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; all but the last return the columns of documents.
``run`` writes each stage's result as Parquet below the shared folder, and the
next one reads it from there, so a lost executor repeats one stage at most.

1. quality_classifier: documents that the classifier rejects go.
2. near_dedup: one document of each group of near duplicates stays.
3. decontamination: documents that contain a benchmark item go.
4. source_mixing: documents are repeated or left out to meet the sources' target
   weights, in training order.
5. token_files: length-delimited binary shards of token ids, in ascending id
   order; the result is their index as read back, in training order: that of
   the files that stage 4 wrote. It is also kept beside the shards, numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.llm import decontaminate, mixing, near_dedup, quality_crf, token_files
from stargrain.session import scratch_path, tune


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    return quality_crf.good_documents(docs, quality_crf.fit(docs, labels, learn))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return near_dedup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return mixing.mixed(docs)


def binary_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return token_files.token_files(docs, ordered=True).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", binary_output),
]

# Training, minimum hashing and tiling are beyond SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
