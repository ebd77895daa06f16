"""From documents to token ids: each stage works on all documents its predecessor kept.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns the documents that
stay, with the columns of ``docs``, but for the last, which returns their ids. Between stages the rows
are written as Parquet in the shared folder and read again, so that a lost executor costs one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import byte_bpe, language, mixing, quality, simhash
from postlake.llm.queries import prepare, table
from postlake.session import cut_lineage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def free(docs: DataFrame, name: str) -> str:
    """``name``, or what no column of ``docs`` begins with."""
    while any(column.lower().startswith(name) for column in docs.columns):
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language stays in doubt, go."""
    prepare(spark)
    found = language.identify(docs, language.page_evidence(table(spark, sf_dir, "pages")))
    own_id, own_hash = free(docs, "_id"), free(docs, "_hash")
    doubtful = found.where(~F.col("kept")).select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).distinct()
    doubtful = cut_lineage(doubtful)  # its size is then known: few rows need no shuffle of the texts
    same = docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_hash))
    return docs.join(doubtful, same, "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    prepare(spark)
    verdict = free(docs, "_rejected_by")
    return quality.judge(docs, out=verdict).where(F.col(verdict).isNull()).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return simhash.keep_one(docs, cut_lineage(simhash.near_duplicates(docs)))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn, so that sources, languages and topics near their target weights, stay."""
    prepare(spark)
    prefix = free(docs, "_mix_")
    return mixing.mix(docs, prefix=prefix).where(F.col(f"{prefix}kept")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the digest of the bytes decoded from them."""
    prepare(spark)
    path = public_tokenizers.path(VOCABULARY)
    tokens = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded")
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", token_ids),
]

#: Tries of bits and merges of bytes are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
