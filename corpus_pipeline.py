"""A corpus pipeline: documents are filtered, deduplicated, scrubbed, mixed and packed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage before it kept. All but
the last return the columns of ``documents``. ``run`` writes every stage as Parquet in the shared
folder and reads it again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sightline.llm import mixing, neardup, packing, pii, quality
from sightline.llm.text import prepared, table
from sightline.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go."""
    prepared(spark)
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    prepared(spark)
    return neardup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by the name of its kind."""
    prepared(spark)
    return pii.scrubbed(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words each source gives by its weight, as shuffled blocks; some documents come twice."""
    prepared(spark)
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: where each lies in its block and in its sequence."""
    prepared(spark)
    # workers of the stages before may still be alive beside this one, so it remembers less
    p = packing.Packing(public_tokenizers.path("word_bpe_49k.json"), pieces=300_000)
    return packing.pack(docs, p)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]

#: SQL cannot express these stages; tests compare each with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
