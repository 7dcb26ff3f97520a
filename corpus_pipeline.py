"""Training text from documents: five stages, each written and read again as the next one's documents.

Defined results: columns beyond those of documents are kept by every stage, whatever their names; a null
text counts as an empty one, and a null id as an id of its own that is never learnt from; of documents
alike in id and text one stays; documents of one id with texts that are not near copies all stay; an empty
table gives an empty result, and so does each stage of one. Without labels of both kinds no document is
toxic and all are of the quality that the lower threshold asks for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm import copies, decontaminate, mixing, quality, toxicity
from kinspark.llm.common import cut, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC, GOOD = 0.5, 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(spark, model, F.col("text")) < TOXIC)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(spark, model, F.col("text")) >= GOOD)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the document of least id."""
    return copies.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"), name="__found")
    return found.where(F.size("__found") == 0).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mixture takes, with its shard, copy and position."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

#: Learnt models and fingerprint components are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), []
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), done=before)
        before = [docs]
    return docs
