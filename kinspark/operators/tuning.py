"""Assignment by rounds, the rule matcher, and grids of thresholds."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import edit as E
from ..functions import text as T
from ..sources.state import cut

#: Thresholds of the calibrated assignment: the first vendor of a catalogue with and without a shared number, and the second.
FIRST_SURE, FIRST, SECOND = 0.85, 0.90, 0.92


def assign_calibrated(scored: DataFrame) -> DataFrame:
    """Greedy by calibrated priority, at most two vendors of a catalogue for a reference record, each vendor once.

    A pair that comes first among the open pairs of its vendor and among those of its record and catalogue is taken as it
    would be in sequence, so all such pairs of a round are taken at once; pairs that they rule out leave. Rounds end when
    none is open; each writes what is left to the shared folder. The number of rounds is the longest chain of pairs that
    wait for each other, not the number of pairs."""
    sure = F.col("digit_status") == "confirm"
    bonus = F.when(sure, 0.05).when(F.col("digit_status") == "conflict", -0.5).otherwise(0.0)
    rows = scored.select("s1_id", "cid", "prob", "digit_status", "country", F.round(F.col("prob") + bonus, 9).alias("priority"))
    # the second vendor's threshold is above the first's, so what passes neither at first never does
    able = rows.where((F.col("prob") >= FIRST) | (sure & (F.col("prob") >= FIRST_SURE)))
    left = cut(able.withColumns({"catalogue": F.substring("cid", 1, 2), "taken": F.lit(0)}))
    order = [F.desc("priority"), F.col("s1_id"), F.col("cid")]
    of_vendor, of_record = Window.partitionBy("cid"), Window.partitionBy("s1_id", "catalogue")
    done = []
    while not left.isEmpty():
        first = (F.row_number().over(of_vendor.orderBy(*order)) == 1) & (F.row_number().over(of_record.orderBy(*order)) == 1)
        marked = left.withColumn("won", first.cast("int"))
        marked = cut(marked.withColumns({"used": F.max("won").over(of_vendor), "more": F.max("won").over(of_record)}))
        done.append(marked.where("won = 1").select(*rows.columns))
        second = (F.col("taken") == 0) & sure & (F.col("prob") >= SECOND)
        left = marked.where((F.col("used") == 0) & ((F.col("more") == 0) | second)).withColumn("taken", F.col("taken") + F.col("more")).drop("won", "used", "more")
    return functools.reduce(DataFrame.unionByName, done) if done else able


def rule_match(candidates: DataFrame, records: DataFrame, keep: int = 2, with_number: float = 82.0, alone: float = 92.0) -> DataFrame:
    """The rule matcher's pairs (s1_id, cid, rank of the candidate): names alike enough, the better of token sets and
    Jaro-Winkler, unless the numbers of the addresses conflict; of each record the best, ties in order of candidates."""
    numbers = F.array_distinct(F.transform(F.filter(F.regexp_extract_all("business_address", F.lit(r"\p{Nd}+"), F.lit(0)), lambda x: F.length(x) <= 6), lambda x: F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), F.lit("0"))))
    own = records.select("entity_id", F.lower("business_name").alias("name"), numbers.alias("nums"))
    side = lambda p: own.select(*[F.col(c).alias(f"{p}_{c}") for c in own.columns])
    j = candidates.join(side("l"), F.col("s1_id") == F.col("l_entity_id")).join(side("r"), F.col("cid") == F.col("r_entity_id"))
    # a conflict decides alone, so it goes before names are compared
    j = j.withColumn("status", T.digit_status(F.col("l_nums"), F.col("r_nums"))).where("status <> 'conflict'")
    alike = F.greatest(E.pairwise(E.token_set, F.col("l_name"), F.col("r_name")), 100 * E.pairwise(E.jaro_winkler, F.col("l_name"), F.col("r_name"), compatible=True))
    j = j.select("s1_id", "cid", "rank", "status", F.round(alike, 6).alias("sim"))
    ok = (F.col("sim") >= alone) | ((F.col("status") == "confirm") & (F.col("sim") >= with_number))
    first = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("sim"), "rank"))
    return j.where(ok).withColumn("place", first).where(F.col("place") <= keep)


# ---------------------------------------------------------------------- grids
def _f05(tp: Column, n_true: Column, n_found: Column) -> tuple[Column, Column, Column]:
    p, r = tp / n_found, tp / n_true
    return F.when(tp > 0, 1.25 * p * r / (0.25 * p + r)).otherwise(0.0), F.when(tp > 0, p).otherwise(0.0), F.when(tp > 0, r).otherwise(0.0)


def grid(scored: DataFrame, truth: DataFrame, confirm: list[float], absent: list[float], tight_confirm: list[float], tight_absent: list[float], base: tuple[float, float, float, float]) -> DataFrame:
    """Macro scores, singletons and vendors of every combination of the four thresholds, with greedy assignment, and the gain over base.

    truth is (s1_id, ids); both ends of a pair are of one country, as blocking sees to. Of a vendor only its best pair of each number status can ever win, so two rows of it are left
    before thresholds are met; a pair meets the combinations of its own kind of country alone, and the two kinds are
    joined at the end, when each is a few rows."""
    tight = T.tight_country(F.col("country"))
    best = (
        scored.where("digit_status <> 'conflict'").groupBy("cid", "digit_status", tight.alias("tight"), "prob").agg(F.min("s1_id").alias("s1_id"))
        .groupBy("cid", "digit_status", "tight").agg(F.max_by("s1_id", "prob").alias("s1_id"), F.max("prob").alias("prob"))
    )
    combos = lambda c, a: [(x, y) for x in sorted(set(c)) for y in sorted(set(a))]
    loose, strict = combos([*confirm, base[0]], [*absent, base[1]]), combos([*tight_confirm, base[2]], [*tight_absent, base[3]])

    def met(listed: list[tuple[float, float]]) -> Column:
        need = lambda c, a: F.when(F.col("digit_status") == "confirm", c).otherwise(a)
        each = F.array(*[F.when(F.col("prob") >= need(c, a), F.struct(F.lit(c).alias("c"), F.lit(a).alias("a"))) for c, a in listed])
        return F.filter(each, lambda x: x.isNotNull())

    passed = best.select("cid", "s1_id", "prob", "tight", F.explode(F.when(F.col("tight"), met(strict)).otherwise(met(loose))).alias("at"))
    won = passed.groupBy("at", "tight", "cid").agg(F.min(F.struct((-F.col("prob")).alias("p"), F.col("s1_id").alias("s1_id"))).alias("w")).select("at", "tight", "cid", F.col("w.s1_id").alias("s1_id"))
    known = truth.select("s1_id", F.array_distinct("ids").alias("ids"))
    counted = won.join(known, "s1_id").groupBy("at", "tight", "s1_id").agg(F.sum(F.array_contains("ids", F.col("cid")).cast("long")).alias("tp"), F.count("*").alias("found"), F.first(F.size("ids")).alias("n_true"))
    f, p, r = _f05(F.col("tp"), F.col("n_true"), F.col("found"))
    # a record without true ids scores 1 until something is found for it
    less = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    sums = counted.groupBy("at", "tight").agg(F.sum(f - less).alias("f"), F.sum(p - less).alias("p"), F.sum(r - less).alias("r"), F.count("*").alias("matched"), F.sum("found").alias("vendors"))

    def half(listed: list[tuple[float, float]], is_tight: bool, name: str) -> DataFrame:
        made = scored.sparkSession.createDataFrame(listed, f"{name}_confirm double, {name}_absent double")
        s = sums.where(F.col("tight") == is_tight).select(F.col("at.c").alias(f"{name}_confirm"), F.col("at.a").alias(f"{name}_absent"), *[F.col(x).alias(f"{name}_{x}") for x in ("f", "p", "r", "matched", "vendors")])
        return made.join(s, [f"{name}_confirm", f"{name}_absent"], "left").na.fill(0)

    whole = truth.agg(F.count("*").alias("n"), F.count_if(F.size("ids") == 0).alias("empty"))
    # both halves are lists of thresholds and the totals one row, whatever the data's size
    m = half(loose, False, "loose").crossJoin(half(strict, True, "tight")).crossJoin(whole)
    score = lambda x: F.round((F.col("empty") + F.col(f"loose_{x}") + F.col(f"tight_{x}")) / F.col("n"), 9)
    out = m.select(
        F.col("loose_confirm").alias("confirm"), F.col("loose_absent").alias("absent"), "tight_confirm", "tight_absent", score("f").alias("macro_f05"), score("p").alias("macro_p"), score("r").alias("macro_r"),
        (F.col("n") - F.col("loose_matched") - F.col("tight_matched")).cast("long").alias("singletons"), (F.col("loose_vendors") + F.col("tight_vendors")).cast("long").alias("vendors"),
    )
    is_base = functools.reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(("confirm", "absent", "tight_confirm", "tight_absent"), base, strict=True)])
    out = out.withColumn("gain", F.round(F.col("macro_f05") - F.max(F.when(is_base, F.col("macro_f05"))).over(Window.partitionBy(F.lit(1))), 9))
    return out.where(F.col("confirm").isin(confirm) & F.col("absent").isin(absent) & F.col("tight_confirm").isin(tight_confirm) & F.col("tight_absent").isin(tight_absent))


def tripwire(results: DataFrame, least: int, most: int, tried: int = 15) -> DataFrame:
    """The best `tried` combinations that gain on base, each with whether its singletons lie in the range."""
    rank = F.row_number().over(Window.orderBy(F.desc("macro_f05"), "confirm", "absent", "tight_confirm", "tight_absent"))
    return results.where("gain > 0").withColumn("place", rank).where(F.col("place") <= tried).withColumn("safe", F.col("singletons").between(least, most))
