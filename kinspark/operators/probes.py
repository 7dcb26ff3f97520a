"""First-come probes, lookalikes, the seven-feature extractor, and why true pairs are missed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import edit as E
from ..functions import text as T
from . import blocking as B


def _first(rows: DataFrame, by: str, order: list[str], most: int) -> DataFrame:
    """The first rows of each value of by."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("__r") <= most).drop("__r")


# --------------------------------------------------------------------- probes
def first_come(pairs: DataFrame, most: int = 10) -> DataFrame:
    """Of each reference record the candidates (s1_id, cid, ordinal) that come first in the vendors' order."""
    return _first(pairs, "s1_id", ["ordinal", "cid"], most).select("s1_id", "cid")


def slice_probe(reference: DataFrame, vendors: DataFrame, bucket: int = 25, most: int = 12) -> DataFrame:
    """Vendors' keys (entity_id, key, ordinal) against the first entries of each key of the reference; of each reference
    record the vendors that come first. A key meets bucket reference records at most."""
    held = _first(reference.select("entity_id", "key", "ordinal").distinct(), "key", ["ordinal", "entity_id"], bucket).select("key", F.col("entity_id").alias("s1_id"))
    met = vendors.select("key", F.col("entity_id").alias("cid"), "ordinal").distinct().join(held, "key").select("s1_id", "cid", "ordinal").distinct()
    return first_come(met, most)


def prefix4(name: Column) -> Column:
    """The first four letters of a name, in lower case, or what there is of them."""
    return F.lower(F.substring(F.coalesce(name, F.lit("")), 1, 4))


def lookalikes(reference: DataFrame, vendors: DataFrame, truth: DataFrame, bucket: int = 8, most: int = 12) -> DataFrame:
    """True pairs, and the first vendors (cid, name, ordinal) that share a reference record's (s1_id, name) first four letters,
    as long as it has under most candidates."""
    listed = _first(vendors.withColumn("pre", prefix4(F.col("name"))), "pre", ["ordinal", "cid"], bucket).select("pre", "cid", "ordinal")
    met = reference.select("s1_id", prefix4(F.col("name")).alias("pre")).join(listed, "pre").select("s1_id", "cid", "ordinal")
    known = truth.select("s1_id", "cid").distinct()
    new = met.join(known, ["s1_id", "cid"], "left_anti").withColumn("__r", F.row_number().over(Window.partitionBy("s1_id").orderBy("ordinal", "cid")))
    has = known.groupBy("s1_id").agg(F.count("*").alias("__n"))
    kept = new.join(has, "s1_id", "left").where(F.coalesce("__n", F.lit(0)) + F.col("__r") <= most)
    return known.unionByName(kept.select("s1_id", "cid"))


# ------------------------------------------------------------- seven features
def address_jaccard(a: Column, b: Column) -> Column:
    """Of distinct words; where neither has any, 1 only for equal texts that are not blank."""
    x, y = T.word_set(a), T.word_set(b)
    same = F.lower(F.trim(a)) == F.lower(F.trim(b))
    none = F.size(F.array_union(x, y)) == 0
    return F.when(none, F.when(same & (F.trim(a) != ""), 1.0).otherwise(0.0)).otherwise(T.jaccard(x, y))


def numbers_shared(a: Column, b: Column) -> Column:
    return F.when(F.arrays_overlap(T.number_set(a), T.number_set(b)), 1.0).otherwise(0.0)


def exact(a: Column, b: Column) -> Column:
    """1 for texts that are equal without regard to case and outer blanks; two empty ones are."""
    return F.when(F.lower(F.trim(a)) == F.lower(F.trim(b)), 1.0).otherwise(0.0)


def native_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs, both names and addresses, and the four of the seven features that need no edit similarity; nulls and what is
    written for a missing value are empty."""
    bare = lambda c: F.when(F.lower(F.trim(c)) == "nan", "").otherwise(F.coalesce(c, F.lit("")))
    own = records.select("entity_id", bare("business_name").alias("name"), bare("business_address").alias("address"))
    side = lambda p: own.select(*[F.col(c).alias(f"{p}_{c}") for c in own.columns])
    j = pairs.join(side("l"), F.col("s1_id") == F.col("l_entity_id")).join(side("r"), F.col("cid") == F.col("r_entity_id")).drop("l_entity_id", "r_entity_id")
    two = lambda f, c: f(F.col(f"l_{c}"), F.col(f"r_{c}"))
    return j.withColumns({
        "address_token_jaccard": F.round(two(address_jaccard, "address"), 6), "numerical_overlap": two(numbers_shared, "address"),
        "name_exact_match": two(exact, "name"), "address_exact_match": two(exact, "address"),
    })


def seven_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """The seven features of pairs (s1_id, cid)."""
    j = native_features(pairs, records)
    a, b = F.col("l_name"), F.col("r_name")
    jw = F.when((a == "") & (b == ""), 1.0).otherwise(E.pairwise(E.jaro_winkler, a, b, compatible=True))
    return j.select(
        "s1_id", "cid", F.round(E.pairwise(E.token_sort, a, b), 6).alias("name_token_sort_ratio"), F.round(E.pairwise(E.token_set, a, b), 6).alias("name_token_set_ratio"),
        F.round(jw, 6).alias("name_jaro_winkler_similarity"), "address_token_jaccard", "numerical_overlap", "name_exact_match", "address_exact_match",
    )


# -------------------------------------------------------------- missed pairs
INDIC = r"[\x{0900}-\x{0D7F}]"


def causes(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs and cause, a row for each reason why blocking may miss a pair: records whose countries differ have that one
    alone, those without another one have met a bucket's cap; a pair with an unknown record is a look-up error."""
    p = B.prepared(records).select("entity_id", "country", "business_name", "business_address", "st", "pin", F.col("name_toks").alias("n"), F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("business_address", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))).alias("a"))
    side = lambda name: p.select(*[F.col(c).alias(f"{name}_{c}") for c in p.columns])
    j = pairs.join(side("l"), F.col("s1_id") == F.col("l_entity_id"), "left").join(side("r"), F.col("cid") == F.col("r_entity_id"), "left")
    left, right = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))

    def code(c: str, what: str) -> Column:
        x, y = left(c), right(c)
        return F.when((x == "") & (y == ""), f"both_missing_{what}").when((x == "") | (y == ""), f"one_missing_{what}").when(x != y, f"{what}_mismatch")

    none = (F.size(left("n")) == 0) | (F.size(right("n")) == 0)
    first, second = F.get(left("n"), F.lit(0)), F.get(right("n"), F.lit(0))
    indic = [side_("business_name").rlike(INDIC) for side_ in (left, right)]
    other = F.when(indic[0] != indic[1], "transliteration_variation").when(indic[0] & indic[1], "indic_script_variation").when(F.size(F.array_intersect(left("n"), right("n"))) == 0, "name_completely_different").otherwise("name_first_token_mismatch")
    prefix = ~none & (F.substring(first, 1, 3) != F.substring(second, 1, 3))
    blank = (F.coalesce(left("business_address"), F.lit("")) == "") | (F.coalesce(right("business_address"), F.lit("")) == "")
    address = F.when(blank, "missing_address").when(F.size(F.array_intersect(left("a"), right("a"))) < 2, "address_completely_different")
    found = F.array_compact(F.array(code("st", "state"), code("pin", "postal"), F.when(none, "missing_name_tokens").when(first != second, other), F.when(prefix, "name_prefix3_mismatch"), address))
    lost = left("entity_id").isNull() | right("entity_id").isNull()
    said = F.when(lost, F.array(F.lit("lookup_error"))).when(left("country") != right("country"), F.array(F.lit("country_mismatch"))).when(F.size(found) == 0, F.array(F.lit("bucket_cap"))).otherwise(found)
    return j.select("s1_id", "cid", F.explode(said).alias("cause"))
