"""A training-data pipeline of five operators: quality rules, line dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next one's docs. All but the last return the columns of ``documents``; the last gives one row for
each piece of a packed sequence. Near-dedup takes five words and a similarity of 0.8, the others their operators'
parameters. SQL can't express the tokenizer, so there is no oracle; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listing_yield.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from listing_yield.session import materialize, read_table, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failed lines."""
    ship_package(spark)
    return quality_rules.keep_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand, equal or one word apart, at an earlier place; a document of which nothing
    is left goes."""
    ship_package(spark)
    return line_dedup.remove_lines(docs, drop_emptied=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target shares of source, language and layout."""
    ship_package(spark)
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
