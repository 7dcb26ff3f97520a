"""Helpers that the text operators share: input reading, folds, lineage cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.state import cut, release

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def learnable(doc_id: Column) -> Column:
    """True for the four folds of five from which labels may be learnt; a null id is in none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    """True for the fold kept for tests; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


#: Characters of the longest text that a training sample takes; longer documents are not drawn. With the bound on
#: rows it bounds what the driver holds.
SAMPLE_CHARS = 20_000


def least_hashed(rows: DataFrame, group: str, count: int, groups: int) -> DataFrame:
    """The count rows (doc_id and group alone) of least hashed doc_id of each of the groups most frequent groups. Rows are
    cut off by hash first, at twice the share that count is of the group, so the task that ranks a group gets some
    2 x count rows; where ids repeat so much that fewer are left, the sample is smaller."""
    size = rows.groupBy(group).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), group).limit(groups)
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    near = rows.select("doc_id", group).join(F.broadcast(size), group).where(order < F.lit(float(1 << 40)) * (2 * count + 100) / F.col("__n")).drop("__n")
    return near.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(order, "doc_id"))).where(F.col("__r") <= count).drop("__r")


def short_enough(text: str = "text") -> Column:
    return F.coalesce(F.length(text), F.lit(0)) <= SAMPLE_CHARS


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """(text, label) of at most per_class documents of each label value, the ones of least
    hashed id of those up to SAMPLE_CHARS characters, from the folds that may be learnt from. Where labels repeat, the
    greatest counts. Only ids and labels are ranked; whole texts of the chosen rows come to the driver."""
    one = labels.where(learnable(F.col("doc_id")) & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("__y"))
    # only labels of documents that are there count towards the bound
    short = documents.where(short_enough()).select("doc_id", "text")
    there = cut(one.join(short.select("doc_id").distinct(), "doc_id", "left_semi"))
    chosen = least_hashed(there, "__y", per_class, 2).select("doc_id", "__y")
    # two classes of per_class ids each: a size that does not grow with the input; an id's rows count once
    rows = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "__y").agg(F.min("text").alias("text")).collect()
    release(there)
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return [(r["text"] or "", r["__y"]) for r in rows]
