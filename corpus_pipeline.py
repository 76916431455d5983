"""From raw documents to packed training windows: language, exact and near duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import exact_dedup, language, near_dedup, packing
from kerbline.llm.common import free_name, settle, table
from kerbline.llm.tokens import tokenizer


#: How far a document's best language has to be above an even share of all, as a part of what is left to 1.
CLEAR_MARGIN = 1 / 8


def least_score(languages: int) -> float:
    """The pooled share that a document's best language must have: 0.34 of four languages, 1 of one."""
    return 1 / languages + CLEAR_MARGIN * (1 - 1 / languages)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. The network is trained on the labelled rows of `docs` and reads every text.
    Rejected are null text, text without a letter, and text of which the network's best language has a share below
    `least_score`, hardly more than an even one. Where lang is null, the prediction is filled in. If no row can be learned
    from, letters alone decide and lang stays as it is."""
    known, network = docs.filter(F.col("text").rlike(r"\p{L}")), language.fit(docs)
    if network is None:
        return known
    label, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    judged = language.predict(spark, known, network, label=label, score=score)
    clear = judged.filter(F.col(score) >= least_score(len(network.languages)))
    return clear.withColumn("lang", F.coalesce("lang", label)).select(*(f"`{c}`" for c in docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal but for white space: the longest, then the smallest doc_id."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component linked by sets of 5-word shingles at a similarity of 0.8 or more."""
    return near_dedup.deduplicated(docs, size=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens, with their ids and checksums."""
    ids = tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, ids, capacity=2048, end_id=1)
    return pieces.withColumns({"length": (F.octet_length("ids") / 4).cast("long"), "ids_crc32": F.crc32("ids")})


STAGES = [("language", language_id), ("exact_dedup", exact), ("near_dedup", near), ("packing", packed)]

#: Training, candidate search and tokenisation have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
