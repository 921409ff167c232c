"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. Its
result is written as Parquet to the shared folder and read again as the next one's input,
so a stage never recomputes an earlier one. All stages but the last return the columns of
``documents``. Null texts, empty tables, repeated rows and extra columns are handled as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import best_fit, chunk_recipes, entropy_mix, host_quality, simhash_gray
from keelson.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return host_quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return chunk_recipes.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest doc_id stays."""
    return simhash_gray.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none to three times."""
    return entropy_mix.repeat_to_targets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return best_fit.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("source mix", source_mix), ("packing", packing)]

#: Fingerprints, Newton iterations and token ids have no SQL; tests/llm/test_pipeline.py
#: holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
