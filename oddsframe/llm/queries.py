"""The registered queries of this package: each applies its operator, with
production parameters, to a whole table; ``ORACLE`` has DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .chat import CHAT_SQL, format_chats
from .decontamination import DECONTAMINATION_SQL, contaminated
from .divergence import DIVERGENCE_SQL, source_divergence
from .embedding_dedup import EMBEDDING_SQL, near_vectors
from .html_wrapper import main_text
from .infill import INFILL_SQL, fill_in_middle
from .language_id import identify_languages
from .ngram_join import NGRAM_SQL, ngram_jaccard_join
from .passages import repeated_passages
from .piece_transducer import encode_pieces
from .pii import span_report
from .url_rules import RULES, URL_SQL, judge_urls
from .warc import WARC_SQL, archive_report

#: The SentencePiece model of the registered query and the pipeline.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_embedding_dedup", EMBEDDING_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


@_query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = encode_pieces(docs, MODEL_PATH, decoded_column="decoded")
    return both.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
                       F.sha2(F.array_join("piece_ids", ","), 256).alias("ids_sha256"),
                       (F.col("decoded") == F.col("text")).alias("round_trip"))


@_query("op3_ngram_join", NGRAM_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query("op4_chat_formatting", CHAT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(_table(spark, sf_dir, "conversations"))


@_query("op5_decontamination", DECONTAMINATION_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return (found.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))
            .agg(F.max("similarity").alias("similarity")))


@_query("op6_url_filter", URL_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


@_query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


@_query("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


@_query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(_table(spark, sf_dir, "documents"))


@_query("op10_passages")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


@_query("op11_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


@_query("op12_infill", INFILL_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(_table(spark, sf_dir, "documents")).drop("output")


@_query("op13_warc", WARC_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(_table(spark, sf_dir, "pages"))
