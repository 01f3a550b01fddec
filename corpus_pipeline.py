"""From raw documents to sharded training text, in five stages of written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardstar.llm import copies, decontam, langid, mixing, sharding
from wardstar.llm.common import read_table, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a learned language; the others go."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return copies.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


#: Weights of the sources in the mix, by name; by their sizes if none are given.
WEIGHTS: dict[str, float] | None = None


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves the sources by their weights."""
    return mixing.in_order(docs, WEIGHTS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shards, numbered within a shard in the order of the mix.

    A written table keeps no order, so the positions, which follow from the rows and the
    weights alone, are computed again.
    """
    placed, names = mixing.positions(docs, WEIGHTS)
    position = names["position"]
    return sharding.with_shards(stored(placed.select(*docs.columns, position), "mixed"), order=position)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mix_sources", mix),
    ("shard", shard),
]

#: Learned profiles and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each is written and read back before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
