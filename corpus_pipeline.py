"""A training-data pipeline: operators of ``ordermill.llm`` one after another.

Documents that are toxic go, then those of low quality; of each group of near
duplicates the one of least id stays; documents that a benchmark passage
contaminates go; what is left is packed into training sequences. Every stage but
the last keeps all columns of its input, whatever they are called.

Rows without an id are scored like others. Of near duplicates a row without an id
stays only where no member of its group has one; of repeated rows one stays, but
documents without words all stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import decontaminate, packing, quality, shingle_join, tokens, toxicity
from ordermill.llm.queries import remainder, table
from ordermill.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose chance of being toxic is a half or more."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0, label="toxic")
    return toxicity.score(docs, model, docs.columns).where("score < 0.5").select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose chance of being good is under 0.7."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(4) != 2, label="quality")
    return quality.score(docs, model, docs.columns).where("score >= 0.7").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that the n-gram Jaccard join links."""
    return shingle_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of which benchmark windows make up a twentieth or more."""
    found = decontaminate.find_benchmark(
        docs, table(spark, sf_dir, "benchmark"), keep=docs.columns
    )
    return decontaminate.judged(found).where("not contaminated").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 1024 tokens."""
    return packing.pack(docs, tokens.vocabulary(), keep_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


# SQL can express neither the trained stages nor the packing; see tests/llm.
ORACLE_SQL: str | None = None
