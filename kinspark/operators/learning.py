"""Learning on labelled pairs: negatives, class weights, forests, boosting and reports."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FEATURES = ["name_jaccard", "name_overlap", "name_len_ratio", "name_exact", "addr_jaccard", "state_match", "postal_match", "country_match"]


def order_of(*columns: str, seed: int = 42) -> Column:
    """A fixed random order of rows."""
    return F.xxhash64(*columns, F.lit(seed))


def hard_negatives(reference_keys: DataFrame, vendor_keys: DataFrame, truth: DataFrame, bucket: int = 100, of_each: int = 100_000, first: int = 4_000) -> DataFrame:
    """Pairs (s1_id, cid) that share a key of at most `bucket` reference entries but are not true. Keys are (entity_id, ordinal, key);
    of each `of_each` vendors by ordinal the first ones are used."""
    small = reference_keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= bucket).select("key")
    ref = reference_keys.join(small, "key", "left_semi").select("key", F.col("entity_id").alias("s1_id"))
    some = vendor_keys.where(F.pmod("ordinal", F.lit(of_each)) < first).select("key", F.col("entity_id").alias("cid"))
    return some.join(ref, "key").select("s1_id", "cid").distinct().join(truth, ["s1_id", "cid"], "left_anti")


def sample_negatives(pairs: DataFrame, ratio: float = 5.0, seed: int = 42) -> DataFrame:
    """All rows of label 1, and of label 0 about `ratio` times as many: the share is taken by hash, with no sort."""
    n = pairs.agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).first()
    share = min(1.0, ratio * n.pos / n.neg) if n.neg else 1.0
    unit = F.pmod(order_of("s1_id", "cid", seed=seed), F.lit(1_000_000)) / 1_000_000
    return pairs.where((F.col("label") == 1) | (unit < share))


def random_negatives(reference: DataFrame, pool: DataFrame, truth: DataFrame, each: int = 3, parts: int = 64, seed: int = 42) -> DataFrame:
    """For each reference id (s1_id) `each` ids (cid) of the pool at random that are not true; rows meet by numbers, not in a
    cross join. The pool is numbered in `parts` tasks, which should grow with it."""
    numbered = pool.withColumn("part", F.pmod(F.xxhash64("cid"), F.lit(parts))).withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("cid")))
    sizes = numbered.groupBy("part").agg(F.max("at").alias("size"))
    drawn = reference.select("s1_id", F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("i")).withColumn("part", F.pmod(order_of("s1_id", "i", seed=seed), F.lit(parts)))
    drawn = drawn.join(sizes, "part").withColumn("at", F.pmod(order_of("s1_id", "i", seed=seed + 1), F.col("size")) + 1)
    return drawn.join(numbered, ["part", "at"]).select("s1_id", "cid").distinct().join(truth, ["s1_id", "cid"], "left_anti")


def prepared(pairs: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Pairs with a feature vector and balanced weights: each class weighs half of all rows."""
    n = pairs.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).first()
    pos = n.pos or 0.0
    weight = F.when(F.col("label") == 1, n.n / (2 * pos) if pos else 1.0).otherwise(n.n / (2 * (n.n - pos)) if n.n > pos else 1.0)
    # both labels are named, as a fold may hold one alone
    label = F.col("label").alias("label", metadata={"ml_attr": {"type": "nominal", "name": "label", "vals": ["0", "1"]}})
    return VectorAssembler(inputCols=features, outputCol="features").transform(pairs.withColumn("label", label).withColumn("weight", weight))


def forest(trees: int = 100, depth: int = 10, leaf: int = 4, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, weightCol="weight", seed=seed)


def boosted(rounds: int = 120, step: float = 0.05, depth: int = 5, share: float = 0.8, seed: int = 42) -> GBTClassifier:
    """Gradient-boosted trees; their splits are by level, so they only approximate trees that grow leaf by leaf."""
    return GBTClassifier(maxIter=rounds, stepSize=step, maxDepth=depth, subsamplingRate=share, weightCol="weight", seed=seed)


def cross_validated(data: DataFrame, estimator: RandomForestClassifier, trees: list[int], folds: int = 3, seed: int = 42):
    """The estimator with the best number of trees by folds that each hold the same share of either label."""
    fold = F.row_number().over(Window.partitionBy("label", "salt").orderBy(order_of("s1_id", "cid", seed=seed))) + F.col("salt")
    salted = data.withColumn("salt", F.pmod(order_of("s1_id", "cid", seed=seed + 1), F.lit(64))).withColumn("fold", F.pmod(fold, F.lit(folds)).cast("int")).drop("salt")
    grid = ParamGridBuilder().addGrid(estimator.numTrees, trees).build()
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(weightCol="weight"), numFolds=folds, foldCol="fold").fit(salted)


def scored(model, data: DataFrame) -> DataFrame:
    return model.transform(data).withColumn("prob", F.round(F.get(vector_to_array("probability"), F.lit(1)), 6))


def importances(model, features: list[str] = FEATURES) -> dict[str, float]:
    return dict(sorted(zip(features, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1]))


def confusion(rows: DataFrame, cut: float = 0.5) -> DataFrame:
    """(label, predicted, n)."""
    return rows.groupBy("label", (F.col("prob") >= cut).cast("double").alias("predicted")).agg(F.count("*").alias("n"))


def report(rows: DataFrame, cut: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and rows of either label."""
    p = (F.col("prob") >= cut).cast("double")
    each = lambda y: F.struct(F.lit(y).alias("label"), F.count_if((F.col("label") == y) & (p == y)).alias("tp"), F.count_if(p == y).alias("found"), F.count_if(F.col("label") == y).alias("n"))
    s = rows.agg(F.array(each(0.0), each(1.0)).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    s = s.withColumns({"precision": ratio("tp", "found"), "recall": ratio("tp", "n")})
    both = F.col("precision") + F.col("recall")
    return s.select("label", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round(F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0), 6).alias("f1"), "n")
