"""A training-corpus pipeline of five stages, each one of the operators in loomgraph.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``; the last returns packed pieces with token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import language_id, mixing, near_dedup, packing, pii
from loomgraph.llm._shared import Stash, documents

#: Texts that no language's classifier claims with more than this are rejected.
LEAST_SCORE = 0.3


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without text or letters and those that look like no known language."""
    named = language_id.predict(docs, language_id.fit(docs))
    return named.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dedup.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by Poisson counts, to tempered shares of the sources."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and places in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", languages), ("near_dedup", near_copies), ("pii", personal_data), ("mixing", mixture), ("packing", packed)]

#: SQL can express neither the classifiers nor the search; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stash = Stash(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stash.put(docs, name)
    return docs
