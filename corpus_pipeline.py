"""Documents to training sequences: toxicity, exact and near duplicates, benchmark items, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; :func:`run` writes each stage's
rows as Parquet and gives the next stage the written table. All but the last return the columns of ``documents``.

Defined cases: a null text counts as empty; rows that repeat id and text are one document from the near-duplicate stage on; null ids
stay; of ties the operators' rules decide; an empty table gives an empty result; columns beside id and text go through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewatch.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from pricewatch.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; all others stay as they are."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row of the largest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the row of the smallest id stays."""
    return simhash.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are words of benchmark windows go. From the others, runs of such words longer than a
    window are cut; all others stay as they are."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, whole, placed in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", decontaminated),
    ("packing", pack),
]

#: Classification, fingerprints, automaton windows and best fit are not expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
