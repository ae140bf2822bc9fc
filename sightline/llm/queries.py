"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import divergence, mixing, neardup, oracles, packing, permutation, pii, prefixtrie, quality, secretscan, sharding, tagpaths, toxicity, wavelet
from sightline.llm.text import table
from sightline.session import new_scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_quality_divergence": oracles.QUALITY,
    "op9_near_duplicates": oracles.NEAR_DUPLICATES,
    "op12_source_divergence": oracles.DIVERGENCE,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.assess(table(spark, folder, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


@query
def op2_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation.nearest_neighbours(table(spark, folder, "embeddings"))


@query
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


@query
def op4_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_table(table(spark, folder, "documents"))


@query
def op5_bounded_packing(spark: SparkSession, folder: str) -> DataFrame:
    p = packing.Packing(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(table(spark, folder, "documents"), p)


@query
def op6_tag_path_text(spark: SparkSession, folder: str) -> DataFrame:
    return tagpaths.extracted(table(spark, folder, "pages"))


@query
def op7_wavelet_files(spark: SparkSession, folder: str) -> DataFrame:
    p = wavelet.TokenFiles(public_tokenizers.path("byte_bpe_50k.json"))
    files = wavelet.write_files(table(spark, folder, "documents"), new_scratch(spark, "wavelet"), p)
    return wavelet.read_files(files)


@query
def op8_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_components(table(spark, folder, "documents"))


@query
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_table(table(spark, folder, "documents"))


@query
def op11_secret_structures(spark: SparkSession, folder: str) -> DataFrame:
    return secretscan.digest(table(spark, folder, "documents"))


@query
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"))
