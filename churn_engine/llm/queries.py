"""The registered queries of the corpus operators; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churn_engine.llm import (
    chunked_bpe,
    exact_dedup,
    lexical_search,
    license_scan,
    near_dedup,
    packing,
    pii,
    quality,
    substring_dedup,
    url_filter,
    vector_codes,
    vector_dedup,
    warc,
)
from churn_engine.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), ids=False)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), texts=False)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_links(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages", "page_id", "url", "html")).drop("url")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.scan_licenses(docs.select("doc_id", path.alias("path"), "text"), id_col="doc_id")


#: The rules of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def queries() -> dict[str, Query]:
    return {
        "op1_near_dedup": op1,
        "op2_quality": op2,
        "op3_chunked_bpe": op3,
        "op4_substring_dedup": op4,
        "op5_vector_dedup": op5,
        "op6_warc": op6,
        "op7_license_scan": op7,
        "op8_url_filter": op8,
        "op9_packing": op9,
        "op10_exact_dedup": op10,
        "op11_pii": op11,
        "op12_ranked_search": op12,
        "op13_vector_codes": op13,
    }
