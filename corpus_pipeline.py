"""The corpus pipeline over ``documents``: rejects toxic ones, keeps one of each near-duplicate group, removes those with
benchmark passages, mixes the sources to their target weights, and writes token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metaloom.llm.common import cut, table
from metaloom.llm.decontaminate import without_contaminated
from metaloom.llm.mixing import mixed
from metaloom.llm.simhash import one_of_each
from metaloom.llm.token_files import round_trip
from metaloom.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read back from the token files."""
    return round_trip(spark, docs).drop("tokens")


#: (name, function); each function takes (spark, docs, sf_dir) and gets what the one before it returned, reread.
STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]

#: No SQL says SimHash or rANS; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, with every stage's result written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
