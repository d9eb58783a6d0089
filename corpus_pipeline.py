"""From raw documents to token ids: quality rules, near-duplicates, secrets, mixture, encoding.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again before the
next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.common import documents, stored
from shelfcast.llm.mixing import repeated
from shelfcast.llm.near import without_copies
from shelfcast.llm.pieces import default_model, tokens
from shelfcast.llm.quality import good_documents
from shelfcast.llm.secrets import redacted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules and the fixed ones reject go."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; shingles have five words."""
    return without_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kinds."""
    return redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return repeated(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens(docs, default_model())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("secret scan", secret_scan),
    ("mixture", mixture),
    ("encoding", encoding),
]

# The learned rules, the encoding and the seeded draw over what they keep are not SQL; tests hold the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
