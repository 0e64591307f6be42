"""Documents to packed training sequences: quality, near duplicates, pseudonyms, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents the stage before it
kept. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import hosts, packing, pseudonyms, simhash
from earshot.llm.common import table
from earshot.llm.queries import KEY
from earshot.sources import storage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that fail the rules, and those of hosts that mostly fail."""
    return hosts.judge(docs).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by id, of each component."""
    return simhash.first_of_each(docs)


def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values replaced by pseudonyms; ``n_chars`` follows the text."""
    done = pseudonyms.replaced(docs, KEY)
    return done.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else done


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document, with their rewritten text, where they lie in the training sequences."""
    return packing.packed_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("private_values", private_values), ("packing", packed)]
# Fingerprints and bins have no SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = storage.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
