"""A corpus pipeline of five stages over the documents table.

Each stage gets what its predecessor kept, written as Parquet and read again. Learned
parts and statistics come from the stage's own input, all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm import bpe, langid, mixing, ngram_join, secret_scan
from cohortwatch.llm.common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts, learned from the stage's own input.

    Null texts and texts without a letter go; equal texts stay or go together; very long texts are
    read whole; with nothing to learn from no document is accepted; an empty table gives an empty one.
    """
    return langid.keep_identified(docs, langid.fit_languages(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near duplicates.

    Texts without a word are in no group and all stay, null ones too, and so do rows without an
    id; rows of one id stay or go together; an empty table gives an empty one.
    """
    return ngram_join.keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; ``n_chars``, where the table has it, follows the text.

    Null texts stay null (``n_chars`` null); repeated rows get equal texts; an empty table gives an empty one.
    """
    clean = secret_scan.redact_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks.

    Null and empty texts have no words and are left out; a null source is a source of its own;
    repeated rows are drawn each; an empty table gives an empty one.
    """
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and a digest of what they decode to.

    A null or empty text has no tokens; repeated rows get equal ones; ``source`` and ``lang`` are
    null where the table lacks them; an empty table gives an empty one.
    """
    lacking = {c: F.lit(None).cast("string") for c in ("source", "lang") if c not in docs.columns}
    return bpe.bpe_tokens(docs.withColumns(lacking) if lacking else docs, bpe.default_vocab())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("mix_sources", mix),
    ("bpe_codec", tokens),
]
# Language ID and the codec are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
