"""A training corpus from raw documents, in five stages.

Language ID, near-duplicate removal, benchmark decontamination, mixing, token output.
Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next stage's documents; all but the last keep the columns of
``documents``, further and clashing ones included.  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkmill.llm import decontaminate, langid, mix, ngram_join, store, token_store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    Null, empty and letterless texts go; repeated rows share their fate; without labelled
    rows nothing is recognised.
    """
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies.

    The least doc_id stays, null ids last, ties by the text's hash; of repeated rows one;
    texts without words are in no class and stay.
    """
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null, empty and wordless texts hold none; repeated rows share their fate; an empty
    benchmark drops nothing.
    """
    return decontaminate.clean(docs, store.read(spark, sf_dir, "benchmark"))


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated or left out, each whole.

    A null source is one of its own; texts without words go, as they can't be taken; rows
    that agree in all columns are taken as one row that many times.
    """
    return mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in shard files; what they hold, one row a document.

    A null text has the end id alone; null ids come first; repeated rows repeat.
    """
    return token_store.token_output(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("weights", weights), ("tokens", tokens)]

#: The trained classifier, MinHash and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and reread."""
    docs = store.read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs, path = store.write_table(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            store.remove(spark, before)
        before = path
    return docs
