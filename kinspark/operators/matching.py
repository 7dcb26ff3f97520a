"""Scored pairs: features, decisions, assignment, evaluation and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import text as T


def pair_features(pairs: DataFrame, records: DataFrame, texts: bool = False) -> DataFrame:
    """The native features of (s1_id, cid), with texts also both names and addresses; what a record adds is made before the join."""
    own = records.select(
        "entity_id", "country", F.col("business_name").alias("name"), F.col("business_address").alias("address"), F.array_distinct(T.sig_tokens(N.transliterate(F.col("business_name")))).alias("n"), F.array_distinct(T.pair_addr_tokens(F.col("business_address"))).alias("a"),
        T.sig_digits(F.col("business_address")).alias("d"), T.state_code(F.col("business_address"), F.col("country")).alias("st"), T.postal_code(F.col("business_address"), F.col("country")).alias("pin"),
    )
    side = lambda name: own.select(*[F.col(c).alias(f"{name}_{c}") for c in own.columns])
    j = pairs.join(side("l"), F.col("s1_id") == F.col("l_entity_id")).join(side("r"), F.col("cid") == F.col("r_entity_id"))
    two = lambda f, c, **k: f(F.col(f"l_{c}"), F.col(f"r_{c}"), **k)
    return j.select(
        *pairs.columns, F.round(two(T.jaccard, "n"), 6).alias("name_jaccard"), F.round(two(T.overlap, "n"), 6).alias("name_overlap"), F.round(two(T.length_ratio, "name"), 6).alias("name_len_ratio"),
        two(T.both_equal, "name").alias("name_exact"), F.round(two(T.jaccard, "a"), 6).alias("addr_jaccard"), two(T.both_equal, "st").alias("state_match"),
        two(T.both_equal, "pin").alias("postal_match"), two(T.both_equal, "country").alias("country_match"), two(T.digit_status, "d").alias("digit_status"), F.col("l_country").alias("country"),
        *([f"{side_}_{c}" for side_ in "lr" for c in ("name", "address")] if texts else []),
    )


def blended(features: DataFrame) -> DataFrame:
    """A score in [0, 1] from the features alone, for what needs no model."""
    return features.withColumn("prob", F.round(0.55 * F.col("name_jaccard") + 0.25 * F.col("name_len_ratio") + 0.1 * F.col("addr_jaccard") + 0.1 * F.col("state_match"), 6))


def assign_greedy(scored: DataFrame) -> DataFrame:
    """Each vendor to its best reference record. Taking pairs by falling score, a vendor once and a
    reference any number of times, accepts just the first pair of each vendor."""
    first = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("prob"), "s1_id"))
    return scored.withColumn("__r", first).where("__r = 1").drop("__r")


def rank_decay(scored: DataFrame, gap: float | None = 0.1, tail: int | None = 5, confirm_tail: bool = True) -> DataFrame:
    """Of each reference record, the pairs that the rank ladder keeps."""
    by = Window.partitionBy("s1_id").orderBy(F.desc("prob"), "cid")
    r = scored.withColumns({"rank": F.row_number().over(by), "top": F.first("prob").over(by)})
    if gap is None:
        middle = late = F.lit(True)
    else:
        near = lambda g: F.round(F.col("top") - F.col("prob"), 9) <= g
        middle = (F.col("prob") >= 0.88) & near(gap)
        late = (F.col("prob") >= 0.92) & near(min(gap, 0.05)) & ((F.col("digit_status") == "confirm") if confirm_tail else F.lit(True))
    inside = F.col("rank") <= tail if tail is not None else F.lit(True)
    keep = F.when(F.col("rank") == 1, True).when(F.col("rank") <= 3, middle).when(F.col("rank") <= 5, late & inside).otherwise(inside)
    return r.where(keep).drop("top")


# ----------------------------------------------------------------- evaluation
def entity_scores(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(s1_id, p, r, f05) from id arrays (truth: s1_id, ids; found: s1_id, got); a missing prediction is empty."""
    j = truth.join(found, "s1_id", "left").withColumn("got", F.coalesce("got", F.array().cast("array<string>")))
    tp = F.size(F.array_intersect("ids", "got"))
    j = j.withColumns({"tp": tp, "n_true": F.size(F.array_distinct("ids")), "n_found": F.size(F.array_distinct("got"))})
    empty = (F.col("n_true") == 0) & (F.col("n_found") == 0)
    p, r = F.col("tp") / F.col("n_found"), F.col("tp") / F.col("n_true")
    zero = F.col("tp") == 0
    score = lambda c: F.when(empty, 1.0).when(zero, 0.0).otherwise(c)
    return j.select("s1_id", "tp", "n_true", "n_found", score(p).alias("p"), score(r).alias("r"), score(1.25 * p * r / (0.25 * p + r)).alias("f05"))


def macro_micro(scores: DataFrame) -> DataFrame:
    some = F.col("n_true") > 0
    tp, nt, nf = (F.sum(F.when(some, F.col(c))) for c in ("tp", "n_true", "n_found"))
    p, r = tp / nf, tp / nt
    return scores.agg(
        F.count("*").alias("entities"), F.round(F.avg("f05"), 6).alias("macro_f05"), F.round(F.avg("p"), 6).alias("macro_p"), F.round(F.avg("r"), 6).alias("macro_r"),
        F.count_if(~some).alias("singletons"), F.count_if(~some & (F.col("n_found") == 0)).alias("singletons_right"),
        F.round(p, 6).alias("micro_p"), F.round(r, 6).alias("micro_r"), F.round(1.25 * p * r / (0.25 * p + r), 6).alias("micro_f05"),
    )


def report(truth: DataFrame, found: DataFrame) -> DataFrame:
    """All figures of an evaluation, one row: truth (s1_id, ids; rows that come twice count twice) against found (s1_id, got,
    ordinal; of rows that come twice the last counts). A missing prediction is empty; micro figures are over records with matches."""
    none = F.array().cast("array<string>")
    last = found.groupBy("s1_id").agg(F.max_by("got", "ordinal").alias("got"), F.lit(True).alias("__p"))
    j = truth.withColumn("__t", F.lit(True)).join(last, "s1_id", "full_outer").withColumns({"ids": F.coalesce("ids", none), "got": F.coalesce("got", none)})
    j = j.withColumns({"tp": F.size(F.array_intersect("ids", "got")), "nt": F.size(F.array_distinct("ids")), "nf": F.size(F.array_distinct("got")), "t": F.coalesce("__t", F.lit(False)), "seen": F.coalesce("__p", F.lit(False))})
    right, zero = (F.col("nt") == 0) & (F.col("nf") == 0), F.col("tp") == 0
    score = lambda c: F.when(right, 1.0).when(zero, 0.0).otherwise(c)
    p, r = F.col("tp") / F.col("nf"), F.col("tp") / F.col("nt")
    j = j.withColumns({"p": score(p), "r": score(r), "f": score(1.25 * p * r / (0.25 * p + r)), "one": F.col("t") & (F.col("nt") == 0), "many": F.col("t") & (F.col("nt") > 0)})
    mean = lambda c, of: F.coalesce(F.avg(F.when(F.col(of), F.col(c))), F.lit(0.0))
    total = lambda c: F.coalesce(F.sum(F.when(F.col("many"), c)), F.lit(0))
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    sums = j.agg(
        mean("f", "t").alias("macro_f05"), mean("p", "t").alias("macro_precision"), mean("r", "t").alias("macro_recall"),
        F.count_if("t").alias("total_ground_truth_entities"), F.countDistinct(F.when(F.col("seen"), F.col("s1_id"))).alias("total_predicted_entities"),
        F.count_if("one").alias("singletons_count"), F.count_if(F.col("one") & (F.col("nf") == 0)).alias("singletons_correct"), F.count_if("many").alias("non_singletons_count"),
        mean("f", "many").alias("non_singleton_macro_f05"), mean("p", "many").alias("non_singleton_macro_precision"), mean("r", "many").alias("non_singleton_macro_recall"),
        total(F.col("tp")).alias("micro_tp"), total(F.col("nf") - F.col("tp")).alias("micro_fp"), total(F.col("nt") - F.col("tp")).alias("micro_fn"),
        F.count_if(F.col("t") & ~F.col("seen")).alias("gt_missing_in_predictions"), F.count_if(~F.col("t")).alias("extra_predicted_entities"),
    )
    tp, fp, fn = (F.col(f"micro_{c}") for c in ("tp", "fp", "fn"))
    mp, mr = over(tp, tp + fp), over(tp, tp + fn)
    return sums.select("*", over(F.col("singletons_correct"), F.col("singletons_count")).alias("singleton_accuracy"), mp.alias("micro_precision"), mr.alias("micro_recall"), over(1.25 * mp * mr, 0.25 * mp + mr).alias("micro_f05"))


def threshold_sweep(scored: DataFrame, truth_pairs: DataFrame, cuts: list[float]) -> DataFrame:
    """P, R and F0.5 of the pairs at each cut: each pair counts for the cuts that it passes."""
    marked = scored.join(truth_pairs.withColumn("y", F.lit(1)), ["s1_id", "cid"], "left").withColumn("y", F.coalesce("y", F.lit(0)))
    sums = marked.agg(F.array(*[F.struct(F.lit(c).alias("cut"), F.sum(F.when(F.col("prob") >= c, F.col("y")).otherwise(0)).alias("tp"), F.count_if(F.col("prob") >= c).alias("found")) for c in cuts]).alias("s"), F.sum("y").alias("true"))
    s = sums.select(F.explode("s").alias("s"), "true").select("s.*", "true")
    p = F.when(F.col("found") > 0, F.col("tp") / F.col("found")).otherwise(0.0)
    r = F.when(F.col("true") > 0, F.col("tp") / F.col("true")).otherwise(0.0)
    f = F.when(F.col("tp") > 0, 1.25 * p * r / (0.25 * p + r)).otherwise(0.0)
    return s.select("cut", "tp", "found", F.round(p, 6).alias("p"), F.round(r, 6).alias("r"), F.round(f, 6).alias("f05"))


def validate(lists: DataFrame, reference: DataFrame) -> DataFrame:
    """(severity, rule, offender) of an id-list table (s1_id, ids as text) against the reference ids."""
    exploded = lists.select("s1_id", F.explode(F.split("ids", ",")).alias("id")).where("id <> ''")
    rule = lambda df, name, offender, severity="error": df.select(F.lit(severity).alias("severity"), F.lit(name).alias("rule"), offender.alias("offender"))
    parts: list[DataFrame] = [
        rule(lists.groupBy("s1_id").count().where("count > 1"), "duplicate_s1", F.col("s1_id")),
        rule(exploded.groupBy("s1_id", "id").count().where("count > 1"), "duplicate_in_list", F.concat_ws("|", "s1_id", "id")),
        rule(exploded.where(F.startswith("id", F.lit("S1-"))), "self_match", F.concat_ws("|", "s1_id", "id")),
        rule(exploded.where(~F.col("id").rlike("^S[123]-")), "wrong_prefix", F.concat_ws("|", "s1_id", "id")),
        rule(reference.join(lists, "s1_id", "left_anti"), "missing_s1", F.col("s1_id")),
        rule(lists.join(reference, "s1_id", "left_anti"), "extra_s1", F.col("s1_id")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def truth_pairs(records: DataFrame) -> DataFrame:
    """Pairs of equal texts and country."""
    ref = records.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "truth", "country")
    return ref.join(records.where("source <> 'S1'").select(F.col("entity_id").alias("cid"), "truth", "country"), ["truth", "country"]).select("s1_id", "cid")

