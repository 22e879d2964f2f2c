"""A corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written and read again as the documents of the next one.

Counted as part of the subpackage ``llm``. ``run`` applies the stages to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import contamination, mixing, quality, sharding, simhash
from termloom.llm.common import kept, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust outlier test accept."""
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints of three-word shingles
    within two bits, as in op7."""
    return simhash.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents left out go, documents taken several times are repeated."""
    return mixing.mixed(docs)


def sharding_tree(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard, its slot there and its shard after growth.

    A column of the input that is named like a computed one goes on as ``input_`` and its
    name (further underscores if that is taken, too).
    """
    made = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    placed = sharding.sharded(docs, docs.columns)
    names = {c: c for c in docs.columns}
    for c in set(made) & set(docs.columns):
        names[c] = f"input_{c}"
        while names[c] in docs.columns:
            names[c] += "_"
    return placed.select(*[F.col("row")[c].alias(names[c]) for c in docs.columns], *made)


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", source_mix),
    ("sharding", sharding_tree),
]

#: Fingerprints, quantile sketches and checksums have no SQL in DuckDB.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
