"""Stages that turn `documents` into ids to train on; each is written and read again by the next.

1. language: documents without a language go; that is those without a letter, or with more bits a byte in the
   language found than texts of that language take.
2. near_duplicates: of documents linked by SimHash fingerprints of three-word shingles, two bits or fewer apart, one stays.
3. secrets: secrets in the texts are replaced by a mask; every document stays.
4. mixing: documents are taken as often as their source's target weight asks for.
5. pieces: the texts become SentencePiece ids; a document has doc_id, n_tokens and ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import langid, mixing, pieces, secrets, simhash
from tidewire.llm.common import table
from tidewire.llm.queries import PIECES
from tidewire.session import cut_lineage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language. Learns from the stage's own rows that aren't held out."""
    trees = langid.learn(docs.filter(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    found = langid.identify(docs, trees, keep=tuple(docs.columns))
    known = langid.limits(docs.filter(langid.held_out("doc_id")), trees)
    return found.filter(langid.in_a_language(known)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, PIECES)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("pieces", encode),
]

# Byte context trees, SimHash components and merge rounds have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
