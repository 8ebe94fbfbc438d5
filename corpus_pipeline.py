"""A corpus from raw documents: four stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import mixing, queries, simhash, toxicity
from cohortry.llm.common import fresh, prepared, table
from cohortry.sources.results import Workspace


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't rejected as toxic, each row by its own text.

    The model is learnt from the labels.
    """
    prepared(spark)
    return toxicity.clean(docs, queries.toxicity_model(spark, docs, sf_dir))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Of rows with that id the one with the smallest key stays, and of its repeats one. Groups in
    which no row has an id keep one row. Rows are told apart by id and text, so an id with texts in
    several groups may stay several times, as may rows without id.
    """
    work = prepared(spark)
    keepers = work.keep(simhash.keepers(docs, work), "keepers")
    key = fresh("key")
    keyed = docs.withColumn(key, simhash.row_key("doc_id", "text"))
    # The join deals texts out by key, and repeated rows are dropped where they then are.
    kept = keyed.join(keepers, F.col(key) == F.col("keeper"), "left_semi")
    return kept.dropDuplicates([key]).drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, as often as the mixture repeats them."""
    return mixing.mixed_documents(docs, prepared(spark), queries.mixing_plan())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as digests."""
    prepared(spark)
    return queries.encoded_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Neither the trained model nor the tokenizer can be put as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read again.

    What only a stage needed, and what the stages before the last kept, is removed on the way.
    """
    work, before = prepared(spark), None
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with Workspace.scope():
            docs = work.keep(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return docs
