"""Documents to training files, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. All but the
last return the columns of ``docs``, whatever they are called; NULLs in them are carried along.

* ``language`` drops NULL and empty texts and those without a letter, as they have no language; repeated rows are judged one by one.
* ``near_copies`` keeps the row with the smallest ``doc_id`` of a group, NULL last; of repeated rows one stays.
* ``benchmark`` drops the rows whose text holds an item, and keeps NULL and empty ones.
* ``mix`` drops texts without a word and repeats others whole; a NULL source is a source of its own.
* ``tokens`` has one row per row, a NULL or empty text only its end; a NULL ``doc_id`` stands before all others.

Without documents every stage is empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.common import table
from siltstone.llm.decontamination import decontaminated
from siltstone.llm.language_id import recognised
from siltstone.llm.mixing import mixture
from siltstone.llm.ngram_join import one_of_each
from siltstone.llm.token_files import token_files
from siltstone.sources.workspace import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return recognised(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what is read back from them."""
    return token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix), ("tokens", tokens)]

#: Compression and hashing into files cannot be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
