"""The corpus pipeline: quality, exact and near duplicates, personal data, packing.

Each stage reads the table that its predecessor wrote in the shared folder; that table is deleted when the next one is
written.  The result has one row for each piece of a document: where it goes, and its token ids.

Cases.  Null and empty texts, and texts of white space only, are rejected by the quality stage.  Documents with a null id
are never near duplicates, and are packed like others; rows that repeat id and text come out of the exact stage once, and
rows that repeat only the id are one document for the near-duplicate stage: both or neither stay.  Texts of any length
pass whole.  Without any trusted label the classifier knows nothing and all texts with words stay.  An empty table gives
an empty result.  Extra columns are carried up to the packing, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import dropped, read_table, staged
from tidemark.llm.exact_dedup import drop_exact_duplicates
from tidemark.llm.minhash import drop_near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.pii import redact_pii
from tidemark.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return redact_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become token sequences: one row for each piece, with its ids."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("pii", pii),
    ("packing", packing),
]

#: SQL can't express the classifier or the tokeniser; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on(spark, read_table(spark, sf_dir, "documents"), sf_dir)


def run_on(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stages on a table of documents; sf_dir names the folder of the labels."""
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        dropped(before)
    return docs
