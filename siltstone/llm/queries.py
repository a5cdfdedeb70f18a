"""The registered queries of this subpackage: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .compression_bands import judge_quality
from .decontamination import contamination
from .hard_negatives import hard_negatives, whole_numbers
from .hard_negatives import oracle as negatives_oracle
from .language_id import identify
from .license_scan import known_digests, oracle, scan_licenses
from .line_dedup import dedup_lines
from .line_dedup import oracle as line_oracle
from .merkle import manifest
from .merkle import oracle as manifest_oracle
from .mixing import mixed
from .ngram_join import jaccard_components
from .page_text import extract_text
from .personal_data import find_personal_data
from .secret_scan import scan_secrets
from .token_files import token_files


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op2_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"), known_digests(spark))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents")).drop("mark", "source")


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    rows = table(spark, folder, "embeddings").select(
        vec_id.alias("id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        whole_numbers(F.col("embedding")).alias("vec"),
        (vec_id % 50 == 0).alias("anchor"),
    )
    return hard_negatives(rows)


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(table(spark, folder, "documents")).drop("path")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_ngram_jaccard_join,
        op2_compression_bands,
        op3_license_scan,
        op4_language_id,
        op5_benchmark_decontamination,
        op6_page_text,
        op7_secret_scan,
        op8_source_mixing,
        op9_token_files,
        op10_personal_data,
        op11_hard_negatives,
        op12_line_dedup,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {
    "op3_license_scan": oracle(),
    "op11_hard_negatives": negatives_oracle(),
    "op12_line_dedup": line_oracle(),
    "op13_merkle_manifest": manifest_oracle(),
}
