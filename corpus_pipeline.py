"""A training corpus from `documents`: each stage works on all that the one before it kept.

1. toxicity: documents that the labelled neighbours reject go
2. exact dedup: of equal texts the smallest doc_id stays
3. near dedup: of each component of near duplicates the smallest doc_id stays
4. personal data: replaced by surrogates under the session's key; n_chars follows the text
5. packing: the texts as power-of-two pieces of token ids

The first four return the columns of documents. A row without doc_id takes part like any
other in the first, fourth and fifth stage; in the second it goes if its text has a row with an
id, and of texts that have none one row stays; the third leaves it alone. Null and empty texts
are clean and equal to each other. Repeated rows come out of the second stage once. An empty
table gives an empty result. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparlode.llm import toxicity
from sparlode.llm.common import Scratch, clean, crc_remainder, read_table, scratch_count, ship, tokenizer_file
from sparlode.llm.exact_dedup import drop_copies
from sparlode.llm.packing import pack
from sparlode.llm.pii import surrogate_key, with_surrogates
from sparlode.llm.setsketch import drop_near_copies


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3 by the labels that aren't held out (crc32 of doc_id modulo 4 is not 2)."""
    ship(spark)
    labels = read_table(spark, sf_dir, "labels")
    index = toxicity.fit(spark, docs, labels.where(crc_remainder("doc_id", 4) != 2))
    return toxicity.reject_toxic(spark, docs, index)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_copies(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    ship(spark)
    return drop_near_copies(spark, docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced."""
    ship(spark)
    changed = with_surrogates(docs, surrogate_key(spark))
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts as pieces of at most 2048 ids, each a power of two long."""
    ship(spark)
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("toxicity", reject_toxic), ("exact_dedup", exact), ("near_dedup", near), ("pii", surrogates), ("packing", packing)]

#: SQL can't express the toxicity, near-duplicate, surrogate and packing stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    scratch, before = Scratch(spark, "pipeline"), None
    for name, stage in STAGES[:-1]:
        own = scratch_count()
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        clean(own)  # what the stage wrote on its way
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
