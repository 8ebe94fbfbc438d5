"""The operators with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import (
    alignment,
    bpe,
    mixing,
    mtree,
    multiset,
    resample,
    sharding,
    simhash,
    substring,
    tokencount,
    toxicity,
    urlfilter,
    warc,
)
from cohortry.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]

RANK_FILE = "byte_bpe_50k.tiktoken"
ALIGNED_FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: Labels are learnt from rows whose crc32 of the id leaves another remainder by 3.
HELD_OUT = 1


def rank_file() -> bytes:
    return Path(public_tokenizers.path(RANK_FILE)).read_bytes()


def _is_held_out(id: str):
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == HELD_OUT, F.lit(False))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(~_is_held_out("doc_id"))
    return toxicity.train(docs, labels)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    counted = tokencount.section_tokens(docs, rank_file(), public_tokenizers.PATTERN, rule="first")
    return counted.withColumnRenamed("id", "doc_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        F.col("id").alias("doc_id"),
        _is_held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    found = multiset.fingerprint_documents(table(spark, sf_dir, "documents"))
    found = found.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.expr("int(n_chars div 2)")
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    edited = F.concat(kept, F.substring("next_text", F.lit(1), half))
    found = found.withColumn("edited", edited)
    found = found.withColumn("edited_lanes", multiset.fingerprint(F.col("edited")))
    own, other, following = F.col("fingerprint"), F.col("edited_lanes"), F.col("next_fingerprint")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        multiset.digest(own).alias("fingerprint"),
        multiset.digest(other).alias("edited_fingerprint"),
        multiset.likeness(own, other).alias("near_edited"),
        multiset.likeness(own, following).alias("near_next"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), prepared(spark))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def mixing_plan() -> mixing.Plan:
    """Three domains of sources; English four times as heavy as each other language."""
    domain = "case when source = 'src0' then 'web' when source rlike '[1-5]$' then 'reference' else 'news' end"
    weights = {("web",): 1, ("reference",): 2, ("news",): 1}
    weights |= {(name, "en"): 4 for name in ("web", "reference", "news")}
    return mixing.Plan(
        levels={"domain": domain, "lang": "lang", "source": "source"},
        tokens=r"regexp_count(text, r'[^ \t\r\n]+')",
        budget=Fraction(3, 4),
        weights=weights,
        epochs=2,
        seed=7,
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, prepared(spark), mixing_plan()).withColumnRenamed("id", "doc_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_packages(table(spark, sf_dir, "pages"), prepared(spark))
    return warc.read_packages(written).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = sharding.assign(docs, sharding.Tree.even(16), prepared(spark))
    return placed.withColumnRenamed("id", "doc_id")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), prepared(spark))


def encoded_documents(docs: DataFrame) -> DataFrame:
    """Token count and digests of each document's ids and of the text they decode to."""
    found = bpe.encode(docs, rank_file(), public_tokenizers.PATTERN, decode=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return encoded_documents(table(spark, sf_dir, "documents"))


URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    rules = urlfilter.rule_table(spark, URL_RULES)
    judged = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select(
        "page_id",
        F.col("url_host").alias("host"),
        F.col("url_path").alias("path"),
        F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"),
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.cut_repeats(table(spark, sf_dir, "documents"), prepared(spark))
    return found.withColumnRenamed("id", "doc_id")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target, prepared(spark)).withColumnRenamed("id", "doc_id")


def tokenizer_files() -> tuple[bytes, bytes]:
    return tuple(Path(public_tokenizers.path(name)).read_bytes() for name in ALIGNED_FILES)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, prepared(spark), *tokenizer_files()).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Query]:
    return {
        name: query
        for name, query in globals().items()
        if name.startswith("op") and callable(query)
    }
