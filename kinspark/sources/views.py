"""The driver's tables seen as record sources, and scans and sinks of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
RECORD = "entity_id string, business_name string, business_address string, country string"


def file_order() -> Column:
    """Rises along a file that is read in splits: its path, the place of the split, the row in it."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))


def read_source(spark: SparkSession, path: str, na: bool = True, order: bool = False) -> DataFrame:
    """A tab-separated record file; missing values, and with na what is written for them, are empty. With order, ordinal
    says where a record stands."""
    raw = spark.read.schema(RECORD).option("sep", "\t").option("header", True).option("quote", '"').csv(path)
    clean = lambda c: F.coalesce(F.when(F.col(c).isin(NA_TOKENS), "").otherwise(F.col(c)), F.lit("")) if na else F.coalesce(F.col(c), F.lit(""))
    return raw.select(*[clean(c).alias(c) for c in raw.columns], *[file_order().alias("ordinal")] * order)


def id_lists(df: DataFrame, key: str, ids: str, *keep: str) -> DataFrame:
    """Comma-joined ids as an array, trimmed, empty ones dropped; other columns only as asked for."""
    parts = F.filter(F.transform(F.split(F.coalesce(F.col(ids), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.select(F.trim(key).alias(key), parts.alias(ids), *keep)


def join_ids(found: DataFrame, key: str, value: str, everyone: DataFrame) -> DataFrame:
    """Ids of each key joined by commas in order; keys without any have an empty list."""
    lists = found.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias(value))
    return everyone.select(key).join(lists, key, "left").select(key, F.coalesce(value, F.lit("")).alias(value))


def text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as records of three sources: names are words 1 to 4, addresses a number, words 5 to 8 and a state."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    t = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    country = F.when(F.col("lang") == "en", "US").when(F.col("lang") == "fr", "France").otherwise("India")
    code = lambda codes: F.get(F.array(*map(F.lit, codes)), (F.col("n_chars") % len(codes)).cast("int"))
    state = F.when(F.col("country") == "US", code(["ca", "tx", "ny", "oh", "wa"])).when(F.col("country") == "France", code(["bretagne", "occitanie", "normandie"])).otherwise(code(["mh", "ka", "tn", "dl"]))
    number = F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.concat(F.col("n_chars").cast("string"), F.lit(" ")))
    out = docs.withColumns({"country": country, "__t": t, "source": F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))})
    return out.select(
        F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"), F.array_join(F.slice("__t", 1, 4), " ").alias("business_name"),
        F.concat(number, F.array_join(F.slice("__t", 5, 4), " "), F.lit(", "), state).alias("business_address"), "country", "source", F.col("doc_id").alias("ordinal"), F.md5("text").alias("truth"),
    )


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as records of three sources with few different names, so that buckets are large."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return p.select(
        F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"), F.lit("-"), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("business_name"),
        F.concat_ws(" ", "p_brand", "p_type", F.col("p_size").cast("string")).alias("business_address"), F.lit("US").alias("country"),
        F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string")).alias("source"), F.col("p_partkey").alias("ordinal"),
    )
