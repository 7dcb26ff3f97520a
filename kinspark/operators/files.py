"""Record and id-list files as tables: look-ups, lists in file order, completion, and the faults of a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDS = "array<string>"


def last_of_each(records: DataFrame, key: str = "entity_id", order: str = "ordinal") -> DataFrame:
    """One row of each key, the last in order; combined before the shuffle, so a repeated key is no hot one."""
    rest = [c for c in records.columns if c != key]
    return records.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def ids_of(lines: DataFrame, column: str = "entity_id") -> DataFrame:
    """The distinct ids of a file's first column, trimmed, blank ones and the header's name left out."""
    one = F.trim(F.coalesce(F.col(column), F.lit("")))
    return lines.select(one.alias("id")).where((F.col("id") != "") & ~F.lower("id").isin("entity_id", "source1_entity_id")).distinct()


def ranked_lists(candidates: DataFrame, reference: DataFrame) -> DataFrame:
    """(s1_id, ids) for each reference record (s1_id, ordinal), in its file's order, ids by rank; empty where it has none."""
    by_rank = F.transform(F.array_sort(F.collect_list(F.struct("rank", "cid"))), lambda x: x["cid"])
    lists = candidates.groupBy("s1_id").agg(F.array_join(by_rank, ",").alias("ids"))
    return reference.join(lists, "s1_id", "left").select("s1_id", F.coalesce("ids", F.lit("")).alias("ids"), "ordinal").orderBy("ordinal", "s1_id")


def _split(ids: Column) -> Column:
    return F.filter(F.split(F.coalesce(ids, F.lit("")), ","), lambda x: x != "")


def with_matches(candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """Candidate lists (s1_id, ids) that hold their matches as well, by code point."""
    own = matches.select("s1_id", F.col("ids").alias("__m"))
    both = F.array_sort(F.array_union(_split(F.col("ids")), _split(F.col("__m"))))
    return candidates.join(own, "s1_id", "full_outer").select("s1_id", F.array_join(both, ",").alias("ids"))


def completed(everyone: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1_id, matches, candidates) for every reference record; missing candidates are the matches."""
    m, c = matches.select("s1_id", F.col("ids").alias("__m")), candidates.select("s1_id", F.col("ids").alias("__c"))
    joined = everyone.select("s1_id").join(m, "s1_id", "left").join(c, "s1_id", "left")
    found = F.coalesce("__m", F.lit(""))
    return joined.select("s1_id", found.alias("matches"), F.coalesce(F.nullif("__c", F.lit("")), found).alias("candidates"))


# ------------------------------------------------------------------- faults
def _issue(rows: DataFrame, rule: str, offender: Column, severity: str = "error") -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), offender.cast("string").alias("offender"))


def line_faults(lines: DataFrame, header: tuple[str, str]) -> DataFrame:
    """Faults of a file's lines (n from 0, value): no line, commas for tabs, another header, lines without a tab."""
    first = lines.where("n = 0")
    said = F.lower(F.trim("value"))
    want = "\t".join(header).lower()
    empty = lines.agg(F.count_if(F.trim("value") != "").alias("c")).where("c = 0")
    wrong = first.where((F.trim("value") != "") & (said != want))
    commas = wrong.where(~F.contains("value", F.lit("\t")) & F.contains("value", F.lit(",")))
    tabless = lines.where((F.col("n") > 0) & (F.trim("value") != "") & ~F.contains("value", F.lit("\t")))
    parts = [_issue(empty, "empty_file", F.lit("")), _issue(commas, "comma_separated", F.col("value")), _issue(wrong, "wrong_header", F.col("value")), _issue(tabless, "no_tab", F.col("value"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def unknown_ids(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Ids in lists (s1_id, ids) that no source has (known: id)."""
    each = lists.select("s1_id", F.explode(_split(F.col("ids"))).alias("id"))
    return _issue(each.join(known, "id", "left_anti"), "unknown_id", F.concat_ws("|", "s1_id", "id")).distinct()


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Matches that are not among their record's candidates: a warning."""
    each = lambda d: d.select("s1_id", F.explode(_split(F.col("ids"))).alias("id"))
    return _issue(each(matches).join(each(candidates), ["s1_id", "id"], "left_anti"), "not_a_candidate", F.concat_ws("|", "s1_id", "id"), "warning").distinct()


def examples(issues: DataFrame, most: int = 5) -> DataFrame:
    """Of each rule its severity, how often it is broken, and the first offenders."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("rule").orderBy("offender"))
    first = issues.withColumn("__r", rank).where(F.col("__r") <= most).groupBy("rule").agg(F.array_sort(F.collect_list("offender")).alias("examples"))
    return issues.groupBy("severity", "rule").agg(F.count("*").alias("n")).join(first, "rule").select("severity", "rule", "n", F.array_join("examples", " ").alias("examples"))
