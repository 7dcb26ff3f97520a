"""The scoring cascade of candidate pairs: what needs no model is decided first, a forest scores the rest.

Tier 1 rejects pairs whose names are too unlike, unless they share a number. Tier 2 accepts pairs of
equal names that share a number and whose addresses are alike. Tier 3 is scored by a random forest on
ten features. Edit similarities are computed on pairs that can still need them only: a name ratio is
bounded by the lengths before it is computed, and Jaro-Winkler follows tier 1.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import edit as E
from ..functions import text as T
from .matching import pair_features

#: The model's columns, in their order (fixed values).
FEATURES = ["name_jw", "name_jaccard", "name_overlap", "name_exact", "name_len_ratio", "addr_jw", "addr_jaccard", "state_match", "postal_match", "country_match"]
#: Below this ratio of names a pair is rejected; from this similarity of addresses on, equal names are accepted; of so many letters at least.
REJECT, ALIKE, LEAST_NAME = 45.0, 0.80, 6


def name_ratio(a: Column, b: Column, least: float = REJECT) -> Column:
    """The Indel ratio of two names; where their lengths alone keep it below least, that bound. An empty name has 0."""
    la, lb = F.length(a), F.length(b)
    bound = F.when((la == 0) | (lb == 0), 0.0).otherwise(200.0 * F.least(la, lb) / (la + lb))
    open_ = bound >= least
    return F.when(open_, E.pairwise(E.indel, F.when(open_, a), F.when(open_, b))).otherwise(bound)


def ten_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs, the ten features, name_ratio, digit_status, country and the strings; pairs that tier 1 rejects are left out."""
    native = pair_features(pairs, records, texts=True)
    held = native.withColumn("name_ratio", name_ratio(F.col("l_name"), F.col("r_name"))).where((F.col("name_ratio") >= REJECT) | (F.col("digit_status") == "confirm"))
    jw = lambda c: F.round(E.pairwise(E.jaro_winkler, F.col(f"l_{c}"), F.col(f"r_{c}")), 6)
    return held.withColumns({"name_jw": jw("name"), "addr_jw": jw("address")})


def tiers(features: DataFrame) -> DataFrame:
    """features and tier: 2 where no model is needed, else 3."""
    name = F.col("l_name")
    alike = (name == F.col("r_name")) & (F.length(name) >= LEAST_NAME) & (F.col("digit_status") == "confirm")
    side = lambda c: F.when(alike, F.col(c))  # noqa: E731  others are not compared
    jw = E.pairwise(E.jaro_winkler, side("l_address"), side("r_address"), compatible=True)
    return features.withColumn("tier", F.when(alike & (jw >= ALIKE), 2).otherwise(3))


def fit(features: DataFrame, truth: DataFrame, trees: int = 100, depth: int = 10, leaf: int = 4) -> Model | None:
    """A forest on the ten features, classes weighted alike, fitted on three quarters of the reference records by hash;
    None where they hold one class only."""
    from pyspark.ml.classification import RandomForestClassifier

    marked = features.join(truth.withColumn("__y", F.lit(1.0)), ["s1_id", "cid"], "left").withColumn("label", F.coalesce("__y", F.lit(0.0)))
    data = vectors(marked.where(F.pmod(F.xxhash64("s1_id"), F.lit(4)) != 0))
    n, true = data.agg(F.count("*"), F.sum("label")).first()
    if not true or true == n:
        return None
    weighted = data.withColumn("w", F.when(F.col("label") == 1, n / (2 * true)).otherwise(n / (2 * (n - true))))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, weightCol="w", seed=42).fit(weighted)


def vectors(features: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)


def score(features: DataFrame, model: Model | None) -> DataFrame:
    """s1_id, cid, tier, prob, digit_status and country of every pair that tier 1 leaves; without a model tier 3 has 0."""
    from pyspark.ml.functions import vector_to_array

    split = tiers(features)
    scored = model.transform(vectors(split)).withColumn("__p", F.get(vector_to_array("probability"), F.lit(1))) if model else split.withColumn("__p", F.lit(0.0))
    prob = F.when(F.col("tier") == 2, 1.0).otherwise(F.round("__p", 6))
    return scored.select("s1_id", "cid", "tier", prob.alias("prob"), "digit_status", "country")


def decide(scored: DataFrame, confirm: float = 0.83, absent: float = 0.90) -> DataFrame:
    """The pairs that pass the thresholds of their digit status and country."""
    return scored.where(T.passes(F.col("prob"), F.col("digit_status"), F.col("country"), confirm, absent))
