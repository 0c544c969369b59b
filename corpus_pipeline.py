"""From raw documents to packed training sequences.

Each stage takes the documents its predecessor kept, written as Parquet and read again; all but
the last return the columns of `documents`. Language identification drops null and letterless texts,
line dedup takes a site's repeated lines out of the texts, SimHash keeps one document of each
group of near-duplicates, and packing returns the pieces with the sequence each lies in.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from wagerlens.llm.common import store, table  # noqa: E402
from wagerlens.llm.langid import keep_identified  # noqa: E402
from wagerlens.llm.lines import drop_site_lines  # noqa: E402
from wagerlens.llm.packing import pack_documents  # noqa: E402
from wagerlens.llm.simhash import one_of_each  # noqa: E402

#: Both steps of the language decision were hardly better than a coin toss; rejects next to nothing.
LEAST_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null or hold no letter.

    A text in a language that was never learned gets a learned one and stays: scores are relative, so
    hardly any falls below the least.
    """
    return keep_identified(docs, least=LEAST_LANGUAGE_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that a large share of a source's documents hold; keeps every document."""
    return drop_site_lines(docs, text="text", host="source")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group."""
    return one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with the sequence it lies in."""
    return pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Language models, fingerprints and token ids have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
