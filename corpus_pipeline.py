"""A training corpus from documents: quality rules, repeated lines, near copies, source mixture, packed sequences.

Each stage takes the documents its predecessor kept and decides over all of them; all but the last return the columns
of documents. Between stages the documents are written and read again, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import Stage, documents
from filingloom.llm.jaccard import one_of_each_group
from filingloom.llm.lines import dedup_lines
from filingloom.llm.mixing import WEIGHTS, mix_sources
from filingloom.llm.packing import pack_documents
from filingloom.llm.rules import kept_by


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule of policy v2 rejects."""
    return kept_by(docs, "v2")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that one with a smaller id has; n_chars counts what is left."""
    columns = docs.columns
    return dedup_lines(docs)[0].withColumn("n_chars", F.length("text").cast("bigint")).select(*columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a similarity of 0.8 of five-word shingles."""
    return one_of_each_group(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for, in a global random order."""
    return mix_sources(docs, WEIGHTS)[0].select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 4096 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

# The similarity join and the packing can't be expressed in SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = documents(spark, sf_dir), Stage(spark)
    for name, step in STAGES[:-1]:
        docs = stage.write(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
