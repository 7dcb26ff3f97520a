"""Quality rules whose cutoffs are risk-controlled.

Every document is measured, and base rules fail the worst. Beyond them stand five rules,
each with a published value as its unit; a document's severity is the greatest multiple
of a unit that any of its measures has. A cutoff on severity tightens all rules together.
Cutoffs are chosen by stratum (language) on labelled documents: going from the loosest of
FACTORS to the strictest, a cutoff is certified as long as an exact binomial test rejects,
at level DELTA / strata, that it rejects more than ALPHA of the good documents of the
stratum. Testing in a fixed order and stopping at the first failure needs no correction
within a stratum, as every cutoff is one joint rule; the division by strata is
Bonferroni's. So with probability 1 - DELTA, no certified cutoff of any stratum loses more
than ALPHA of its good documents, and of those certified the one is taken that parts bad
from good labels best (the loosest of equal ones), whichever that is. 72 good labels
without a false rejection certify a cutoff in one of four strata; a stratum with fewer
certifies nothing and keeps its documents.

Only DataFrame functions. Repeated 8-word windows are found within the row: windows are
hashed by doubling (2, 4, 8 words), and only texts in which a hash repeats are sorted.

Defined results: a null text has no word and fails the base rules, as an empty one
does; repeated rows are judged alike; a null language is a stratum of its own; an empty
table gives an empty result; columns named like those added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, learnable

BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
ALPHA = 0.05
DELTA = 0.1
#: The unit of each rule's measure: limits that published corpora were filtered with (fixed values), and a fifth of all letters for capitals.
UNITS = {"symbols_per_word": 0.1, "dup_line_share": 0.3, "repeat_share": 0.12, "upper_share": 0.2, "mean_word": 10.0}
#: Cutoffs on severity, in the order of the tests.
FACTORS = (8.0, 6.0, 5.0, 4.0, 3.0, 2.5, 2.0, 1.5, 1.25, 1.0, 0.75, 0.5)


def let(value: Column, body) -> Column:
    """body(x) with x evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _joined(h: Column, step: int) -> Column:
    """The hash of each element with the one step further on."""
    n = F.size(h) - step
    return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def repeated_words(words: Column) -> Column:
    """Words that lie in a WINDOW-word window which the text has twice or more."""

    def covered(h: Column) -> Column:
        ranked = F.array_sort(F.zip_with(h, F.sequence(F.lit(0), F.size(h) - 1), lambda x, p: F.struct(x.alias("h"), p.alias("p"))))
        twice = let(ranked, lambda s: F.filter(s, lambda x, i: F.coalesce(F.when(i > 0, F.get(s, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
        places = F.array_sort(F.transform(twice, lambda x: x["p"]))
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(places, zero, lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), p - a["last"])).alias("sum")), lambda a: a["sum"])

    one = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(
        let(_joined_all(one), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    )


def _joined_all(one: Column) -> Column:
    return let(one, lambda a: let(_joined(a, 1), lambda b: let(_joined(b, 2), lambda c: _joined(c, 4))))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the counts that the rules go by."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines})
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long"),
        "n_upper": (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("__words")).cast("long"),
    })
    return out.drop("__words", "__lines")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """Measures by rule; higher is worse."""
    n = F.greatest(F.lit(1), F.col("n_words")).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / n, "dup_line_share": F.col("n_dup_lines") / F.greatest(F.lit(1), F.col("n_lines")).cast("double"), "repeat_share": F.col("n_repeat_words") / n,
        "upper_share": F.col("n_upper") / F.greatest(F.lit(1), F.col("word_chars")).cast("double"), "mean_word": F.col("word_chars") / n,
    }


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), term by term; 1 where k > n p, which no test needs."""
    ratio = F.lit(p / (1 - p))
    first = n * F.log(F.lit(1 - p))
    zero = F.struct(first.cast("double").alias("term"), F.exp(first).cast("double").alias("sum"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i * ratio)
        return F.struct(term.alias("term"), (a["sum"] + F.exp(term)).alias("sum"))

    places = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(places, zero, step, lambda a: a["sum"]))


def severity() -> Column:
    return F.greatest(*[v / F.lit(UNITS[r]) for r, v in rule_values().items()])


def _stratum(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("\x00"))


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """__stratum and __cut (null: none certified), a row for each stratum with labels."""
    known = labels.where(learnable(F.col("doc_id")) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("__q")).select(F.col("doc_id").alias("__id"), "__q")
    rows = measured.where(~base_failed()).select("doc_id", _stratum(stratum).alias("__stratum"), severity().alias("__sev")).join(known, F.col("doc_id") == F.col("__id"))
    good, bad = F.col("__q") == 1, F.col("__q") != 1
    # how many good and bad documents each cutoff would reject
    counts = cut(rows.groupBy("__stratum").agg(
        F.count_if(good).alias("n"), F.count_if(bad).alias("m"),
        *[F.array(*[F.count_if(y & (F.col("__sev") > f)) for f in FACTORS]).alias(name) for name, y in (("good", good), ("bad", bad))],
    ))
    level = delta / max(1, counts.count())

    # in order; what is left at the first failure stays out
    zero = F.struct(F.lit(True).alias("on"), F.lit(None).cast("double").alias("best"), F.lit(None).cast("double").alias("cut"))
    steps = F.array(*[F.struct(F.lit(f).alias("f"), F.get("good", F.lit(i)).alias("k"), F.get("bad", F.lit(i)).alias("b")) for i, f in enumerate(FACTORS)])

    def step(a: Column, g: Column) -> Column:
        parted = g["b"] / F.greatest(F.col("m"), F.lit(1)) - g["k"] / F.greatest(F.col("n"), F.lit(1))

        def next_(ok: Column) -> Column:
            better = ok & (a["best"].isNull() | (parted > a["best"]))
            return F.struct(ok.alias("on"), F.when(better, parted).otherwise(a["best"]).alias("best"), F.when(better, g["f"]).otherwise(a["cut"]).alias("cut"))

        return let(a["on"] & (binomial_cdf(g["k"], F.col("n"), alpha) <= level), next_)

    return counts.select("__stratum", F.aggregate(steps, zero, step, lambda a: a["cut"]).alias("__cut"))


def judge(measured: DataFrame, chosen: DataFrame, stratum: str = "lang") -> DataFrame:
    """measured with base_failed and kept."""
    keyed = measured.withColumn("__key", _stratum(stratum))
    joined = keyed.join(chosen, F.col("__key") == F.col("__stratum"), "left")
    rejected = F.coalesce(severity() > F.col("__cut"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected).drop("__key", "__stratum", "__cut")


def op3_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    measured = cut(measures(documents.select("doc_id", "text", "lang")).drop("text"))
    judged = judge(measured, cutoffs(measured, labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
