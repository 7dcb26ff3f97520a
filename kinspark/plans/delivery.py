"""Registered queries of the scoring cascade, of files and lists, and of the evaluation report, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import edit as E
from ..functions import normalize as N
from ..operators import blocking as B
from ..operators import cascade as C
from ..operators import files as X
from ..operators import matching as M
from ..sources.state import cut
from .registry import CANDIDATES, ENTITY, FEATURES, GREEDY, KEYS, REC, TRUTH, records, scored

HEADER = ("source1_entity_id", "matched_entity_ids")


def reference(s: SparkSession, d: str) -> DataFrame:
    return records(s, d).where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "ordinal")


# -------------------------------------------------------------------- cascade
def pairs(s: SparkSession, d: str) -> DataFrame:
    return B.generate(records(s, d)).select("s1_id", "cid")


def folded(t: Column) -> Column:
    """Without accents and ß, so that bytes and characters are the same."""
    return N.strip_accents(F.replace(t, F.lit("ß"), F.lit("ss")))


def jw_compat(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d).select("entity_id", folded(F.col("business_name")).alias("n"))
    j = pairs(s, d).join(r.withColumnsRenamed({"entity_id": "s1_id", "n": "a"}), "s1_id").join(r.withColumnsRenamed({"entity_id": "cid", "n": "b"}), "cid")
    return j.select("s1_id", "cid", F.round(E.pairwise(E.jaro_winkler, F.col("a"), F.col("b"), compatible=True), 6).alias("jw"))


def bypass(s: SparkSession, d: str) -> DataFrame:
    features = M.pair_features(pairs(s, d), records(s, d), texts=True)
    alike = features.withColumns({c: folded(F.col(c)) for c in ("l_address", "r_address")})
    return C.tiers(alike).where("tier = 2").select("s1_id", "cid")


def score_cascade(s: SparkSession, d: str) -> DataFrame:
    """Every pair that tier 1 leaves, with its tier, its score and whether it passes."""
    r = records(s, d)
    features = cut(C.ten_features(pairs(s, d), r))
    out = C.score(features, C.fit(features, M.truth_pairs(r)))
    accepted = C.decide(out).select("s1_id", "cid", F.lit(True).alias("accepted"))
    return out.join(accepted, ["s1_id", "cid"], "left").select("s1_id", "cid", "tier", "prob", F.coalesce("accepted", F.lit(False)).alias("accepted"))


_JW = "CASE WHEN {0} = {1} AND {0} <> '' THEN 1 WHEN {0} = '' OR {1} = '' THEN 0 ELSE jaro_winkler_similarity({0}, {1}) END"
_fold = lambda c: f"strip_accents(replace({c}, 'ß', 'ss'))"


# ----------------------------------------------------------------- files, lists
def lists(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(s1_id, ids) of matches and candidates; every fifth record has no candidates, every seventh none listed at all."""
    r, ref = records(s, d), reference(s, d)
    found = M.truth_pairs(r).groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cid")), ",").alias("ids"))
    made = X.ranked_lists(B.generate(r), ref).where("ordinal % 7 <> 0")
    return found, made.select("s1_id", F.when(F.col("ordinal") % 5 == 0, "").otherwise(F.col("ids")).alias("ids"))


LISTS = """, mt AS (SELECT s1_id, string_agg(DISTINCT cid, ',' ORDER BY cid) AS ids FROM truth GROUP BY 1),
  ref AS (SELECT entity_id AS s1_id, ordinal FROM rec WHERE source = 'S1'),
  cl AS (SELECT r.s1_id, r.ordinal, coalesce((SELECT string_agg(cid, ',' ORDER BY rank) FROM cand c WHERE c.s1_id = r.s1_id), '') AS ids FROM ref r),
  ca AS (SELECT s1_id, CASE WHEN ordinal % 5 = 0 THEN '' ELSE ids END AS ids FROM cl WHERE ordinal % 7 <> 0)"""


def repeated(s: SparkSession, d: str) -> DataFrame:
    """Records of which every third comes again under another name, and every ninth a third time."""
    r = records(s, d).select("entity_id", "business_name", "business_address", "ordinal")
    again = lambda n, by: r.where(F.col("ordinal") % by == 0).withColumns({"business_name": F.concat("business_name", F.lit(f" {n}")), "ordinal": F.col("ordinal") + n * 10**9})
    return r.unionByName(again(1, 3)).unionByName(again(2, 9))


def made_lines(s: SparkSession, d: str) -> DataFrame:
    """Lines of an id-list file: a header in commas, some lines without a tab, some blank."""
    body = reference(s, d).select((F.col("ordinal") + 1).alias("n"), F.when(F.col("ordinal") % 9 == 0, F.col("s1_id")).when(F.col("ordinal") % 10 == 1, " ").otherwise(F.concat("s1_id", F.lit("\t"))).alias("value"))
    return body.unionByName(s.range(1).select(F.lit(0).cast("long").alias("n"), F.lit(",".join(HEADER)).alias("value")))


def scan_ids(s: SparkSession, d: str) -> DataFrame:
    """First columns with blanks around them, repeats, blank ones and the header."""
    r = records(s, d)
    lines = r.select(F.concat(F.lit(" "), "entity_id", F.lit("  ")).alias("entity_id")).unionByName(r.where("ordinal % 4 = 0").select("entity_id"))
    odd = s.createDataFrame([("entity_id",), ("",), ("   ",), (None,)], "entity_id string")
    return X.ids_of(lines.unionByName(odd))


def unknown(s: SparkSession, d: str) -> DataFrame:
    """Candidate ids that are no record of the second source."""
    _, made = lists(s, d)
    return X.unknown_ids(made, records(s, d).where("source = 'S2'").select(F.col("entity_id").alias("id")))


# ------------------------------------------------------------------ evaluation
def report(s: SparkSession, d: str) -> DataFrame:
    """The report on greedy matches, with records that truth has not and earlier rows of records that come twice."""
    r, ref = records(s, d), reference(s, d)
    ids = M.truth_pairs(r).groupBy("s1_id").agg(F.collect_set("cid").alias("ids"))
    truth = ref.join(ids, "s1_id", "left").select("s1_id", F.coalesce("ids", F.array().cast(X.IDS)).alias("ids"))
    got = M.assign_greedy(scored(s, d)).where("prob >= 0.7").groupBy("s1_id").agg(F.collect_set("cid").alias("got")).withColumn("ordinal", F.lit(1))
    early = got.select("s1_id", F.array(F.lit("S2-none")).alias("got"), F.lit(0).alias("ordinal"))
    extra = ref.where("ordinal % 17 = 0").select(F.concat(F.lit("S1-x"), "s1_id").alias("s1_id"), F.array().cast(X.IDS).alias("got"), F.lit(1).alias("ordinal"))
    out = M.report(truth, got.unionByName(early).unionByName(extra))
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c).cast("long").alias(c) for c, k in out.dtypes])


PARTS = {
    "jw_compat": (jw_compat, f"{REC}{KEYS}{CANDIDATES}, x AS (SELECT s1_id, cid, {_fold('l.business_name')} AS a, {_fold('r.business_name')} AS b FROM cand JOIN rec l ON s1_id = l.entity_id JOIN rec r ON cid = r.entity_id) SELECT s1_id, cid, round({_JW.format('a', 'b')}, 6) AS jw FROM x"),
    "cascade_bypass": (bypass, f"""{REC}{KEYS}{CANDIDATES}{FEATURES}, x AS (SELECT f.s1_id, f.cid, {_fold('l.business_address')} AS a, {_fold('r.business_address')} AS b FROM feat f JOIN rec l ON f.s1_id = l.entity_id JOIN rec r ON f.cid = r.entity_id
        WHERE l.business_name = r.business_name AND length(l.business_name) >= {C.LEAST_NAME} AND digit_status = 'confirm') SELECT s1_id, cid FROM x WHERE {_JW.format('a', 'b')} >= {C.ALIKE}"""),
    "score_cascade": (score_cascade, None),
    "records_last_wins": (lambda s, d: X.last_of_each(repeated(s, d)).select("entity_id", "business_name", "business_address"),
        f"{REC} SELECT entity_id, business_name || CASE WHEN ordinal % 9 = 0 THEN ' 2' WHEN ordinal % 3 = 0 THEN ' 1' ELSE '' END AS business_name, business_address FROM rec"),
    "id_scan": (scan_ids, f"{REC} SELECT entity_id AS id FROM rec"),
    "candidate_lists": (lambda s, d: X.ranked_lists(B.generate(records(s, d)), reference(s, d)).select("s1_id", "ids"), f"{REC}{KEYS}{CANDIDATES}{TRUTH}{LISTS} SELECT s1_id, ids FROM cl"),
    "lists_with_matches": (lambda s, d: X.with_matches(*reversed(lists(s, d))), f"""{REC}{KEYS}{CANDIDATES}{TRUTH}{LISTS}, e AS (SELECT s1_id, unnest(string_split(ids, ',')) AS id FROM (SELECT * FROM ca UNION ALL SELECT * FROM mt)), k AS (SELECT s1_id FROM ca UNION SELECT s1_id FROM mt)
        SELECT k.s1_id, coalesce((SELECT string_agg(DISTINCT id, ',' ORDER BY id) FROM e WHERE e.s1_id = k.s1_id AND id <> ''), '') AS ids FROM k"""),
    "lists_completed": (lambda s, d: X.completed(reference(s, d), *lists(s, d)), f"{REC}{KEYS}{CANDIDATES}{TRUTH}{LISTS} SELECT r.s1_id, coalesce(mt.ids, '') AS matches, coalesce(nullif(ca.ids, ''), mt.ids, '') AS candidates FROM ref r LEFT JOIN mt USING (s1_id) LEFT JOIN ca USING (s1_id)"),
    "file_line_faults": (lambda s, d: X.line_faults(made_lines(s, d), HEADER), f"""{REC}{TRUTH}, ref AS (SELECT entity_id AS s1_id, ordinal FROM rec WHERE source = 'S1')
        SELECT 'error' AS severity, 'no_tab' AS rule, s1_id AS offender FROM ref WHERE ordinal % 9 = 0 UNION ALL SELECT 'error', 'comma_separated', '{",".join(HEADER)}' UNION ALL SELECT 'error', 'wrong_header', '{",".join(HEADER)}'"""),
    "unknown_ids": (unknown, f"{REC}{KEYS}{CANDIDATES}{TRUTH}{LISTS}, e AS (SELECT DISTINCT s1_id, unnest(string_split(ids, ',')) AS id FROM ca) SELECT 'error' AS severity, 'unknown_id' AS rule, s1_id || '|' || id AS offender FROM e WHERE id <> '' AND id NOT LIKE 'S2-%'"),
    "matches_outside": (lambda s, d: X.outside_candidates(*lists(s, d)), f"""{REC}{KEYS}{CANDIDATES}{TRUTH}{LISTS}, e AS (SELECT s1_id, unnest(string_split(ids, ',')) AS id FROM ca), m AS (SELECT s1_id, unnest(string_split(ids, ',')) AS id FROM mt)
        SELECT 'warning' AS severity, 'not_a_candidate' AS rule, s1_id || '|' || id AS offender FROM m ANTI JOIN e USING (s1_id, id)"""),
    "eval_report": (report, f"""{REC}{KEYS}{CANDIDATES}{FEATURES}{GREEDY}{TRUTH}{ENTITY}, mi AS (SELECT sum(tp) AS tp, sum(n_found - tp) AS fp, sum(n_true - tp) AS fn FROM es WHERE n_true > 0),
        pd AS (SELECT count(DISTINCT s1_id) AS n FROM asg WHERE prob >= 0.7), ex AS (SELECT count(*) AS n FROM rec WHERE source = 'S1' AND ordinal % 17 = 0), pr AS (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM mi)
        SELECT round(avg(f05), 6) AS macro_f05, round(avg(es.p), 6) AS macro_precision, round(avg(es.r), 6) AS macro_recall, count(*) AS total_ground_truth_entities, (SELECT pd.n + ex.n FROM pd, ex) AS total_predicted_entities,
          count(*) FILTER (n_true = 0) AS singletons_count, count(*) FILTER (n_true = 0 AND n_found = 0) AS singletons_correct, round(coalesce(count(*) FILTER (n_true = 0 AND n_found = 0) / nullif(count(*) FILTER (n_true = 0), 0), 0), 6) AS singleton_accuracy,
          count(*) FILTER (n_true > 0) AS non_singletons_count, round(coalesce(avg(f05) FILTER (n_true > 0), 0), 6) AS non_singleton_macro_f05, round(coalesce(avg(es.p) FILTER (n_true > 0), 0), 6) AS non_singleton_macro_precision, round(coalesce(avg(es.r) FILTER (n_true > 0), 0), 6) AS non_singleton_macro_recall,
          (SELECT tp::BIGINT FROM mi) AS micro_tp, (SELECT fp::BIGINT FROM mi) AS micro_fp, (SELECT fn::BIGINT FROM mi) AS micro_fn, (SELECT round(p, 6) FROM pr) AS micro_precision, (SELECT round(r, 6) FROM pr) AS micro_recall,
          (SELECT round(CASE WHEN 0.25 * p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0 END, 6) FROM pr) AS micro_f05, count(*) FILTER (n_found = 0) AS gt_missing_in_predictions, (SELECT n FROM ex) AS extra_predicted_entities FROM es"""),
}
