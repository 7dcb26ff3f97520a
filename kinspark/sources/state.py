"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where
    that is unset and everything runs in one process, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="kinspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, done: Iterable[DataFrame] = ()) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and a lost
    executor costs no recomputation. Tables of earlier cuts that nothing reads any more
    (done) are removed once df is written; whoever owns the folder removes the others."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinspark/{uuid.uuid4().hex}"
    df.write.parquet(path)
    for old in done:
        release(old)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def release(table: DataFrame) -> None:
    """Remove what cut wrote for a table. Spark removes the shuffle files of what is not used any more when the
    driver collects its garbage, so that is asked for."""
    if path := getattr(table, "_cut_path", None):
        at, files = _at(table.sparkSession, path)
        files.delete(at, True)
        table.sparkSession._jvm.System.gc()


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)
