"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each result as Parquet in the shared scratch folder and rereads it as the next
stage's input.  All stages but the last return the columns of ``documents``.

1. ``language_id``: rows without a recognisable language go.
2. ``ngram_join``: one row of each group of near duplicates stays.
3. ``decontamination``: rows that hold a benchmark item go.
4. ``pii``: personal data and the terms that disclose it leave the texts.
5. ``sentencepiece``: texts become piece ids, which are decoded as a check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsframe.llm.common import cut
from oddsframe.llm.decontamination import decontaminate
from oddsframe.llm.language_id import identify_languages
from oddsframe.llm.ngram_join import one_of_each_group
from oddsframe.llm.pii import sanitise
from oddsframe.llm.piece_transducer import encode_pieces
from oddsframe.llm.queries import MODEL_PATH
from oddsframe.session import ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return identify_languages(docs, keep=True)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    coded = encode_pieces(docs, MODEL_PATH, decoded_column="decoded")
    return coded.select("doc_id", "lang", "source", F.size("piece_ids").cast("long").alias("n_pieces"),
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"), "piece_ids")


STAGES = [("language_id", language_id), ("ngram_join", ngram_join), ("decontamination", decontamination),
          ("pii", pii), ("sentencepiece", sentencepiece)]

#: SQL can express neither the classifier nor the piece ids; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
