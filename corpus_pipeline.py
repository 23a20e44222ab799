"""The corpus pipeline: five stages from raw documents to encoded training text.

Every stage takes all that the one before kept; ``run`` writes each result to the shared folder
and reads it back as the next one's documents. All but the last return the columns of
documents.

In every stage a null text counts as empty, a null id or source is a value like any other, rows that repeat an id are
separate rows, and an empty table gives an empty one with the same columns. Where a stage differs, or breaks ties, it says so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazardlake.llm import bpe_codec, exact_dedup, language_id, mixing, near_dedup
from hazardlake.llm.common import column, settle
from hazardlake.llm.queries import BPE_FILE, tokenizer_file
from hazardlake.session import prepare


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a clear language; texts without letters (null ones too) or between two languages go.

    Equal texts have the same fate. Where no labelled row can be learned from, all texts with a letter stay.
    """
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; of rows that repeat it one. Null and empty texts are equal."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least id, null ids last; of rows that repeat it one."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order; a document that it takes twice is there twice, one that it leaves out is not there.

    Texts without words are taken where their place in their source's order is.
    """
    names = docs.columns
    return mixing.scheduled(docs).select(*[column(c) for c in names])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, verified by decoding them again; none for an empty text."""
    wanted = docs.select("doc_id", "lang", "source", "text")
    encoded = bpe_codec.encoded(wanted, tokenizer_file(BPE_FILE), large=("ids",))
    return encoded.selectExpr("doc_id", "lang", "source", "bpe.n_tokens", "bpe.ids", "bpe.ids_sha256",
                              "bpe.decoded_sha256", "bpe.decoded_sha256 = sha2(coalesce(text, ''), 256) AS round_trip")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language id", identify_languages),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("BPE encoding", encode),
]

# Classifiers and MinHash are not expressible in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
