"""All registered queries of the record-linkage operators, with the SQL they are checked against.

The SQL is written from the operators' rules, not from the Spark plans. Views of records
are common table expressions that each statement begins with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import edit as E
from ..functions import text as T
from ..functions import words as W
from ..operators import blocking as B
from ..operators import matching as M
from ..sources import views as V

CUTS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9]
CONFIGS = [(0.5, 0.6), (0.6, 0.7), (0.65, 0.75), (0.7, 0.8), (0.75, 0.85), (0.8, 0.9), (0.83, 0.9)]


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _regions() -> str:
    cases = " ".join(f"WHEN contains(lower(business_address), '{r.replace(chr(39), chr(39) * 2)}') THEN '{W.FR_CODES.get(r, r).replace(chr(39), chr(39) * 2)}'" for r in sorted(W.FR_REGIONS, key=lambda r: -len(r)))
    return f"CASE {cases} ELSE '' END"


#: Records of documents, with tokens, digits and codes.
REC = rf"""WITH t AS (SELECT *, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS tk,
  CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'France' ELSE 'India' END AS country FROM documents),
rec AS (SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, 'S' || (doc_id % 3 + 1) AS source, doc_id AS ordinal, md5(text) AS truth, country,
  array_to_string(tk[1:4], ' ') AS business_name,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE n_chars || ' ' END || array_to_string(tk[5:8], ' ') || ', ' ||
  CASE country WHEN 'US' THEN (['ca','tx','ny','oh','wa'])[n_chars % 5 + 1] WHEN 'France' THEN (['bretagne','occitanie','normandie'])[n_chars % 3 + 1]
    ELSE (['mh','ka','tn','dl'])[n_chars % 4 + 1] END AS business_address FROM t),
p AS (SELECT *,
  list_filter(regexp_extract_all(lower(business_name), '[\p{{L}}\p{{N}}_]+'), lambda x: length(x) > 1 AND x NOT IN {_in(W.NAME_STOPWORDS)}) AS nt,
  list_filter(regexp_extract_all(lower(business_address), '[a-z0-9]+'), lambda x: length(x) >= 4 AND x NOT IN {_in(W.KEY_ADDR_STOPWORDS)}) AS adt,
  list_filter(list_distinct(regexp_extract_all(business_address, '\p{{Nd}}+')), lambda x: x NOT IN ('0', '1', '2')) AS dg,
  CASE country WHEN 'US' THEN coalesce(list_filter(list_reverse(string_split_regex(replace(lower(business_address), ',', ' '), '\s+')), lambda x: x IN {_in(W.US_CODES)})[1], '')
    WHEN 'India' THEN coalesce(list_filter(list_reverse(string_split_regex(replace(lower(business_address), ',', ' '), '\s+')), lambda x: x IN {_in(W.IN_CODES)})[1], '')
    ELSE {_regions()} END AS st,
  CASE country WHEN 'US' THEN coalesce(nullif(regexp_extract(trim(business_address), '(?:,\s*[A-Za-z]{{2}}\s+|\b[A-Za-z]{{2}}\s+)(\d{{5}})(?:-\d{{4}})?\b', 1), ''), regexp_extract(trim(business_address), '\b(\d{{5}})(?:-\d{{4}})?\s*$', 1))
    WHEN 'India' THEN coalesce(list_reverse(regexp_extract_all(business_address, '\b([1-9]\d{{5}})\b'))[1], '')
    ELSE regexp_extract(business_address, '\b(0[1-9]\d{{3}}|[1-8]\d{{4}}|9[0-8]\d{{3}})\b', 1) END AS pin FROM rec)
"""
PART = r"""WITH rec AS (SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS entity_id, 'S' || (p_partkey % 3 + 1) AS source, p_partkey AS ordinal, 'US' AS country,
  p_name AS business_name, p_brand || ' ' || p_type || ' ' || p_size AS business_address FROM part)""" + REC[REC.index(",\np AS (") :]
KEYS = """, k0 AS (SELECT entity_id, source, ordinal, unnest([
  CASE WHEN st <> '' AND nt[1] IS NOT NULL THEN {'pass': 1, 'branch': 'state+token', 'key': country || '_ST_' || st || '_' || nt[1]} END,
  CASE WHEN st <> '' AND length(nt[2]) >= 3 THEN {'pass': 2, 'branch': 'state+token', 'key': country || '_ST_' || st || '_' || nt[2]} END,
  CASE WHEN nt[2] IS NOT NULL THEN {'pass': 3, 'branch': '2tok_conjunction', 'key': country || '_2TOK_' || least(nt[1], nt[2]) || '_' || greatest(nt[1], nt[2])} END,
  CASE WHEN st <> '' AND length(nt[1]) >= 3 THEN {'pass': 4, 'branch': 'state+prefix3', 'key': country || '_ST_PRE3_' || st || '_' || nt[1][1:3]} END,
  CASE WHEN st <> '' AND a5[1] IS NOT NULL THEN {'pass': 5, 'branch': 'state+addr_token', 'key': country || '_ADDR_' || st || '_' || a5[1]} END,
  CASE WHEN st <> '' AND a5[2] IS NOT NULL THEN {'pass': 5, 'branch': 'state+addr_token', 'key': country || '_ADDR_' || st || '_' || a5[2]} END,
  CASE WHEN pin <> '' AND nt[1] IS NOT NULL THEN {'pass': 6, 'branch': 'pin+prefix', 'key': country || '_PIN_' || pin || '_' || nt[1][1:3]} END,
  CASE WHEN st = '' AND length(nt[1]) >= 4 THEN {'pass': 7, 'branch': 'country+token_fallback', 'key': country || '_TOK_' || nt[1]} END]) AS k,
  generate_subscripts([1,2,3,4,5,6,7,8], 1) AS slot FROM (SELECT *, list_filter(adt, lambda x: length(x) >= 5) AS a5 FROM p)),
keys AS (SELECT entity_id, source, ordinal, slot, k.pass AS pass, k.branch AS branch, k.key AS key FROM k0 WHERE k IS NOT NULL),
bucket AS (SELECT key, count(*) AS n FROM keys WHERE source <> 'S1' GROUP BY key)
"""
HITS = """, probe AS (SELECT k.entity_id AS s1_id, k.slot, k.branch, k.key, b.n, CASE k.branch WHEN 'state+prefix3' THEN 8 ELSE 25 END AS cap,
  CASE k.branch WHEN 'state+prefix3' THEN 100 ELSE 200 END AS large, CASE k.branch WHEN 'state+prefix3' THEN 1 ELSE 2 END AS take FROM keys k JOIN bucket b USING (key) WHERE k.source = 'S1'),
met AS (SELECT probe.*, v.entity_id AS cid FROM probe JOIN keys v USING (key) WHERE v.source <> 'S1' AND probe.n <= probe.large),
small AS (SELECT s1_id, cid, branch, 1 / sqrt(n) AS spec FROM met WHERE n <= cap),
big AS (SELECT m.s1_id, m.slot, m.cid, m.branch, m.take, len(list_intersect(a.nt, b.nt)) AS ov, len(list_intersect(a.adt, b.adt)) AS av FROM met m JOIN p a ON m.s1_id = a.entity_id JOIN p b ON m.cid = b.entity_id WHERE m.n > m.cap),
chosen AS (SELECT s1_id, cid, branch, 0.1 AS spec FROM (SELECT * FROM big WHERE ov >= 1 OR av >= 2) QUALIFY row_number() OVER (PARTITION BY s1_id, slot ORDER BY 2 * ov + av DESC, cid DESC) <= take),
hit AS (SELECT * FROM small UNION ALL SELECT s1_id, cid, branch, CAST(spec AS DOUBLE) FROM chosen)
"""
CANDIDATES = f"""{HITS}, merged AS (SELECT s1_id, cid, list(DISTINCT branch) AS br, sum(spec) AS spec FROM hit GROUP BY s1_id, cid),
scored0 AS (SELECT m.s1_id, m.cid, round(list_sum(list_transform(br, lambda x: CASE x {" ".join(f"WHEN '{k}' THEN {v}" for k, v in W.BRANCH_WEIGHTS.items())} END)) + 3.0 * (len(br) - 1) + least(3.0, spec)
  + 4.0 * len(list_intersect(a.nt, b.nt)) / greatest(1, len(list_distinct(list_concat(a.nt, b.nt)))) + 1.5 * len(list_intersect(a.nt, b.nt))
  + 2.5 * len(list_intersect(a.adt, b.adt)) / greatest(1, len(list_distinct(list_concat(a.adt, b.adt)))) + 0.8 * len(list_intersect(a.adt, b.adt)), 9) AS score
  FROM merged m JOIN p a ON m.s1_id = a.entity_id JOIN p b ON m.cid = b.entity_id),
cand AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cid DESC) AS rank FROM scored0 QUALIFY rank <= 12)
"""
_PAIR_TOKENS = rf"list_distinct(list_filter(regexp_extract_all(lower(business_address), '[a-z0-9\x{{0900}}-\x{{09FF}}]+'), lambda x: length(x) >= 2 AND x NOT IN {_in(W.PAIR_ADDR_STOPWORDS)}))"
FEATURES = f""", own AS (SELECT *, list_distinct(nt) AS n1, {_PAIR_TOKENS} AS a1 FROM p),
feat0 AS (SELECT c.s1_id, c.cid, l.country, len(list_intersect(l.n1, r.n1)) AS ni, len(list_distinct(list_concat(l.n1, r.n1))) AS nu, least(len(l.n1), len(r.n1)) AS nl,
  length(l.business_name) AS ll, length(r.business_name) AS lr, l.business_name AS ln, r.business_name AS rn, len(list_intersect(l.a1, r.a1)) AS ai, len(list_distinct(list_concat(l.a1, r.a1))) AS au,
  l.st AS ls, r.st AS rs, l.pin AS lp, r.pin AS rp, l.country AS lc, r.country AS rc, l.dg AS ld, r.dg AS rd
  FROM cand c JOIN own l ON c.s1_id = l.entity_id JOIN own r ON c.cid = r.entity_id),
feat AS (SELECT s1_id, cid, round(CASE WHEN nu = 0 THEN 1 ELSE ni / nu END, 6) AS name_jaccard, round(CASE WHEN nl = 0 THEN 0 ELSE ni / nl END, 6) AS name_overlap,
  round(CASE WHEN ll = 0 AND lr = 0 THEN 1 WHEN ll = 0 OR lr = 0 THEN 0 ELSE least(ll, lr) / greatest(ll, lr) END, 6) AS name_len_ratio, CASE WHEN ln = rn AND ln <> '' THEN 1.0::DOUBLE ELSE 0 END AS name_exact,
  round(CASE WHEN au = 0 THEN 1 ELSE ai / au END, 6) AS addr_jaccard, CASE WHEN ls = rs AND ls <> '' THEN 1.0::DOUBLE ELSE 0 END AS state_match, CASE WHEN lp = rp AND lp <> '' THEN 1.0::DOUBLE ELSE 0 END AS postal_match,
  CASE WHEN lc = rc AND lc <> '' THEN 1.0::DOUBLE ELSE 0 END AS country_match, CASE WHEN len(ld) = 0 OR len(rd) = 0 THEN 'absent' WHEN len(list_intersect(ld, rd)) > 0 THEN 'confirm' ELSE 'conflict' END AS digit_status, country FROM feat0),
sc AS (SELECT *, round(0.55::DOUBLE * name_jaccard + 0.25::DOUBLE * name_len_ratio + 0.1::DOUBLE * addr_jaccard + 0.1::DOUBLE * state_match, 6) AS prob FROM feat)
"""
GREEDY = ", asg AS (SELECT s.s1_id, s.cid, s.prob FROM sc s WHERE NOT EXISTS (SELECT 1 FROM sc o WHERE o.cid = s.cid AND (o.prob > s.prob OR (o.prob = s.prob AND o.s1_id < s.s1_id))))"
TRUTH = ", truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS cid FROM rec a JOIN rec b ON a.truth = b.truth AND a.country = b.country WHERE a.source = 'S1' AND b.source <> 'S1')"
ENTITY = """, ids AS (SELECT r.entity_id AS s1_id, (SELECT list(DISTINCT cid) FROM truth t WHERE t.s1_id = r.entity_id) AS want, (SELECT list(DISTINCT cid) FROM asg WHERE asg.s1_id = r.entity_id AND prob >= 0.7) AS got FROM rec r WHERE source = 'S1'),
cnt AS (SELECT s1_id, len(coalesce(list_intersect(want, got), [])) AS tp, len(coalesce(want, [])) AS n_true, len(coalesce(got, [])) AS n_found FROM ids),
es AS (SELECT s1_id, tp, n_true, n_found, CASE WHEN n_true = 0 AND n_found = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE tp / n_found END AS p,
  CASE WHEN n_true = 0 AND n_found = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE tp / n_true END AS r, CASE WHEN n_true = 0 AND n_found = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE 1.25 * (tp / n_found) * (tp / n_true) / (0.25 * (tp / n_found) + tp / n_true) END AS f05 FROM cnt)"""


# -------------------------------------------------------------------- queries
def records(s: SparkSession, d: str) -> DataFrame:
    return V.text_records(s, d)


def scored(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    return M.blended(M.pair_features(B.generate(r).select("s1_id", "cid"), r))


def noisy(s: SparkSession, d: str) -> DataFrame:
    """Names with the suffix noise that normalisation meets."""
    ends = [" Inc", " L.L.C.", " Pvt. Ltd.", " & Co", " SARL", " [Limited]", " group group", ""]
    r = records(s, d)
    return r.withColumn("raw", F.concat("business_name", F.get(F.array(*map(F.lit, ends)), (F.col("ordinal") % 8).cast("int"))))


NOISY = ", noisy AS (SELECT entity_id, business_name || ([' Inc', ' L.L.C.', ' Pvt. Ltd.', ' & Co', ' SARL', ' [Limited]', ' group group', ''])[ordinal % 8 + 1] AS raw FROM rec)"


def mini_match(s: SparkSession, d: str) -> DataFrame:
    """Best vendor of each reference record among its candidates, by the overlap of their names."""
    pairs = B.generate(records(s, d)).select("s1_id", "cid")
    scores = M.pair_features(pairs, records(s, d)).select("s1_id", "cid", "name_jaccard")
    best = scores.groupBy("s1_id").agg(F.max(F.struct("name_jaccard", "cid")).alias("b"))
    return best.select("s1_id", F.col("b.cid").alias("cid"), F.col("b.name_jaccard").alias("name_jaccard"))


def lists(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    ref = r.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"))
    return V.join_ids(M.truth_pairs(r), "s1_id", "cid", ref)


def _entity(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    truth = r.where("source = 'S1'").select(F.col("entity_id").alias("s1_id")).join(M.truth_pairs(r).groupBy("s1_id").agg(F.collect_set("cid").alias("ids")), "s1_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    found = M.assign_greedy(scored(s, d)).where("prob >= 0.7").groupBy("s1_id").agg(F.collect_set("cid").alias("got"))
    return M.entity_scores(truth, found)


def broken_lists(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Id lists with planted faults, and the reference ids."""
    r = records(s, d)
    ref = r.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "ordinal")
    ids = F.when(F.col("ordinal") % 5 == 0, F.concat_ws(",", F.lit("S2-1"), F.lit("S2-1"))).when(F.col("ordinal") % 7 == 0, F.col("s1_id")).when(F.col("ordinal") % 11 == 0, "X9-1").otherwise("")
    made = ref.where("ordinal % 13 <> 0").select("s1_id", ids.alias("ids"))
    extra = ref.where("ordinal % 17 = 0").select(F.concat(F.lit("S1-x"), F.col("ordinal").cast("string")).alias("s1_id"), F.lit("").alias("ids"))
    again = ref.where("ordinal % 19 = 0 and ordinal % 13 <> 0").select("s1_id", F.lit("").alias("ids"))
    return made.unionByName(extra).unionByName(again), ref.select("s1_id")


def config_grid(s: SparkSession, d: str) -> DataFrame:
    """Accepted pairs, true among them, and vendors for each pair of thresholds, in one pass."""
    sc = scored(s, d).join(M.truth_pairs(records(s, d)).withColumn("y", F.lit(1)), ["s1_id", "cid"], "left")
    ok = lambda c, a: T.passes(F.col("prob"), F.col("digit_status"), F.col("country"), c, a, 0.7, 0.75)
    each = F.array(*[F.when(ok(c, a), F.struct(F.lit(i).alias("config"), F.lit(c).alias("confirm"), F.lit(a).alias("absent"))) for i, (c, a) in enumerate(CONFIGS)])
    rows = sc.select("cid", "y", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("c"))
    return rows.groupBy("c.config", "c.confirm", "c.absent").agg(F.count("*").alias("pairs"), F.count("y").alias("true_pairs"), F.countDistinct("cid").alias("vendors"))


def missed_causes(s: SparkSession, d: str) -> DataFrame:
    """Why blocking misses true pairs: each missed pair may have several causes."""
    r = records(s, d)
    p = B.prepared(r)
    missed = M.truth_pairs(r).join(B.generate(r).select("s1_id", "cid"), ["s1_id", "cid"], "left_anti")
    own = lambda n: p.select(F.col("entity_id").alias(n), F.col("st").alias(f"st_{n}"), F.col("pin").alias(f"pin_{n}"), F.col("name_toks").alias(f"n_{n}"))
    j = missed.join(own("s1_id"), "s1_id").join(own("cid"), "cid")
    pair = lambda c, what: [F.when((F.col(f"{c}_s1_id") == "") & (F.col(f"{c}_cid") == ""), f"both_missing_{what}"), F.when((F.col(f"{c}_s1_id") == "") != (F.col(f"{c}_cid") == ""), f"one_missing_{what}"), F.when((F.col(f"{c}_s1_id") != "") & (F.col(f"{c}_cid") != "") & (F.col(f"{c}_s1_id") != F.col(f"{c}_cid")), f"{what}_mismatch")]
    none = (F.size("n_s1_id") == 0) | (F.size("n_cid") == 0)
    first = F.get("n_s1_id", F.lit(0)) != F.get("n_cid", F.lit(0))
    causes = F.array_compact(F.array(*pair("st", "state"), *pair("pin", "postal"), F.when(none, "missing_name_tokens"), F.when(~none & first, "name_first_token_mismatch")))
    causes = F.when(F.size(causes) == 0, F.array(F.lit("bucket_cap"))).otherwise(causes)
    return j.select(F.explode(causes).alias("cause")).groupBy("cause").agg(F.count("*").alias("pairs"))


def branch_attribution(s: SparkSession, d: str) -> DataFrame:
    """How many true pairs each branch finds, and how many it alone finds."""
    r = records(s, d)
    p = B.prepared(r)
    hits = B.hits(B.keys(p.where("source = 'S1'")), B.keys(p.where("source <> 'S1'")), p.select("entity_id", "name_toks", "addr_toks"))
    found = hits.join(M.truth_pairs(r), ["s1_id", "cid"], "left_semi").groupBy("s1_id", "cid").agg(F.collect_set("branch").alias("b"))
    return found.select(F.explode("b").alias("branch"), (F.size("b") == 1).cast("long").alias("sole")).groupBy("branch").agg(F.count("*").alias("pairs"), F.sum("sole").alias("sole_pairs"))


def candidate_stats(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    n = r.where("source = 'S1'").select("country", F.col("entity_id").alias("s1_id")).join(B.generate(r).groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    adt = lambda q: F.round(F.percentile("n", F.lit(q)), 6)
    return n.groupBy("country").agg(F.count("*").alias("records"), F.sum("n").alias("pairs"), F.round(F.avg("n"), 6).alias("mean"), adt(0.5).alias("median"), adt(0.95).alias("p95"), adt(0.99).alias("p99"), F.max("n").alias("most"), F.count_if(F.col("n") == 0).alias("without"))


def rf_train_score(s: SparkSession, d: str) -> DataFrame:
    """A random forest on candidate pairs, fitted on three quarters by hash, scoring all."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    r = records(s, d)
    names = ["name_jaccard", "name_overlap", "name_len_ratio", "name_exact", "addr_jaccard", "state_match", "postal_match", "country_match"]
    pairs = M.pair_features(B.generate(r).select("s1_id", "cid"), r).join(M.truth_pairs(r).withColumn("y", F.lit(1.0)), ["s1_id", "cid"], "left").withColumn("label", F.coalesce("y", F.lit(0.0)))
    data = VectorAssembler(inputCols=names, outputCol="features").transform(pairs)
    train = data.where(F.pmod(F.xxhash64("s1_id"), F.lit(4)) != 0)
    n, pos = train.agg(F.count("*"), F.sum("label")).first()
    if not pos or pos == n:
        return data.select("s1_id", "cid", F.lit(float(bool(pos))).alias("prob"))
    weighted = train.withColumn("w", F.when(F.col("label") == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos))))
    model = RandomForestClassifier(numTrees=100, maxDepth=10, minInstancesPerNode=4, weightCol="w", seed=42).fit(weighted)
    return model.transform(data).select("s1_id", "cid", F.round(F.get(vector_to_array("probability"), F.lit(1)), 6).alias("prob"))


def _jw(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d).select("entity_id", "business_name")
    pairs = B.generate(records(s, d)).select("s1_id", "cid")
    j = pairs.join(r.withColumnsRenamed({"entity_id": "s1_id", "business_name": "a"}), "s1_id").join(r.withColumnsRenamed({"entity_id": "cid", "business_name": "b"}), "cid")
    out = {"jw": E.jaro_winkler, "ratio": E.indel, "token_sort": E.token_sort, "token_set": E.token_set}
    return j.select("s1_id", "cid", *[F.round(E.pairwise(f, F.col("a"), F.col("b")), 6).alias(k) for k, f in out.items()])


def _of_records(**columns):
    return lambda s, d: records(s, d).select("entity_id", *[c().alias(k) for k, c in columns.items()])


_name, _addr, _country = (lambda: F.col("business_name")), (lambda: F.col("business_address")), (lambda: F.col("country"))
_text = lambda c: F.array_join(c, " ")
PARTS = {
    "mini_match": (mini_match, f"""{REC}{KEYS}{CANDIDATES}, j AS (SELECT s1_id, cid, round(CASE WHEN len(list_concat(l.nt, r.nt)) = 0 THEN 1 ELSE len(list_intersect(l.nt, r.nt)) / len(list_distinct(list_concat(l.nt, r.nt))) END, 6) AS name_jaccard FROM cand JOIN p l ON s1_id = l.entity_id JOIN p r ON cid = r.entity_id)
        SELECT s1_id, cid, name_jaccard FROM j QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY name_jaccard DESC, cid DESC) = 1"""),
    "scan_source_profile": (
        lambda s, d: records(s, d).groupBy("source", "country").agg(F.count("*").alias("records"), F.countDistinct("business_name").alias("names"), F.count_if(F.col("business_name") == "").alias("empty_names"), F.count_if(F.upper("business_name") == F.col("business_name")).alias("upper_names")),
        f"{REC} SELECT source, country, count(*) AS records, count(DISTINCT business_name) AS names, count(*) FILTER (business_name = '') AS empty_names, count(*) FILTER (upper(business_name) = business_name) AS upper_names FROM rec GROUP BY source, country"),
    "idlist_emit": (lists, f"{REC}{TRUTH} SELECT r.entity_id AS s1_id, coalesce((SELECT string_agg(DISTINCT cid, ',' ORDER BY cid) FROM truth t WHERE t.s1_id = r.entity_id), '') AS cid FROM rec r WHERE source = 'S1'"),
    "idlist_explode": (lambda s, d: V.id_lists(lists(s, d), "s1_id", "cid").select("s1_id", F.explode("cid").alias("cid")), f"{REC}{TRUTH} SELECT DISTINCT s1_id, cid FROM truth"),
    "safe_baseline": (lambda s, d: records(s, d).where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), F.lit("").alias("cid")), f"{REC} SELECT entity_id AS s1_id, '' AS cid FROM rec WHERE source = 'S1'"),
    "prefix_scan": (lambda s, d: records(s, d).where("ordinal >= 100 and ordinal < 300").select("entity_id", "business_name"), f"{REC} SELECT entity_id, business_name FROM rec WHERE ordinal BETWEEN 100 AND 299"),
    "semi_join_scan": (lambda s, d: records(s, d).where("source <> 'S1'").join(M.truth_pairs(records(s, d)).select(F.col("cid").alias("entity_id")), "entity_id", "left_semi").select("entity_id", "business_name"), f"{REC}{TRUTH} SELECT entity_id, business_name FROM rec WHERE entity_id IN (SELECT cid FROM truth)"),
    "country_discovery": (lambda s, d: records(s, d).where("source = 'S1'").select("country").distinct(), f"{REC} SELECT DISTINCT country FROM rec WHERE source = 'S1'"),
    "clean_punct": (lambda s, d: noisy(s, d).select("entity_id", T.clean_punct(F.col("raw")).alias("name")), f"{REC}{NOISY} SELECT entity_id, trim(regexp_replace(translate(replace(raw, '&', ' and '), '[]', '  '), '\\s+', ' ', 'g')) AS name FROM noisy"),
    "clean_dots": (lambda s, d: noisy(s, d).select("entity_id", T.clean_dots(F.lower("raw")).alias("name")), f"{REC}{NOISY} SELECT entity_id, trim(regexp_replace(replace(regexp_replace(lower(raw), '\\.(\\S)', '. \\1', 'g'), '.', ''), '\\s+', ' ', 'g')) AS name FROM noisy"),
    "collapse_dupes": (lambda s, d: noisy(s, d).select("entity_id", T.collapse_doubled(F.lower("raw")).alias("name")), f"{REC}{NOISY} SELECT entity_id, regexp_replace(lower(raw), '\\bgroup( group)+\\b', 'group', 'g') AS name FROM noisy"),
    "sig_tokens": (_of_records(tokens=lambda: _text(T.sig_tokens(_name()))), f"{REC} SELECT entity_id, array_to_string(nt, ' ') AS tokens FROM p"),
    "addr_tokens": (_of_records(tokens=lambda: _text(T.key_addr_tokens(_addr()))), f"{REC} SELECT entity_id, array_to_string(adt, ' ') AS tokens FROM p"),
    "pair_addr_tokens": (_of_records(tokens=lambda: _text(F.array_sort(F.array_distinct(T.pair_addr_tokens(_addr()))))), f"{REC} SELECT entity_id, array_to_string(list_sort({_PAIR_TOKENS}), ' ') AS tokens FROM p"),
    "sig_digits": (_of_records(digits=lambda: _text(F.array_sort(T.sig_digits(_addr())))), f"{REC} SELECT entity_id, array_to_string(list_sort(dg), ' ') AS digits FROM p"),
    "number_set": (_of_records(numbers=lambda: _text(F.array_sort(T.number_set(_addr())))), f"{REC} SELECT entity_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(business_address, '\\d+'), lambda x: coalesce(nullif(ltrim(x, '0'), ''), '0')))), ' ') AS numbers FROM p"),
    "word_set": (_of_records(words=lambda: _text(F.array_sort(T.word_set(_name())))), f"{REC} SELECT entity_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(business_name), '[\\p{{L}}\\p{{N}}_]+'))), ' ') AS words FROM p"),
    "blocking_word": (_of_records(word=lambda: T.blocking_word(_name()), prefix=lambda: T.prefix3(_name())), f"""{REC} SELECT entity_id, coalesce(list_filter(w, lambda x: length(x) >= 3 AND x NOT IN {_in(W.RULE_STOPWORDS)})[1], array_to_string(w, '')[1:4]) AS word, array_to_string(w, '')[1:3] AS prefix
        FROM (SELECT entity_id, regexp_extract_all(lower(business_name), '[\\p{{L}}\\p{{N}}]+') AS w FROM p)"""),
    "state_code": (_of_records(state=lambda: T.state_code(_addr(), _country())), f"{REC} SELECT entity_id, st AS state FROM p"),
    "postal_code": (_of_records(postal=lambda: T.postal_code(_addr(), _country()), all_codes=lambda: _text(T.postal_codes(_addr(), _country()))), f"""{REC} SELECT entity_id, pin AS postal, array_to_string(regexp_extract_all(business_address, CASE country WHEN 'India' THEN '\\b\\d{{6}}\\b' ELSE '\\b\\d{{5}}\\b' END), ' ') AS all_codes FROM p"""),
    "blocking_keys": (lambda s, d: B.keys(B.prepared(records(s, d))).select("entity_id", F.col("pass").cast("long").alias("pass"), "branch", "key"), f"{REC}{KEYS} SELECT entity_id, CAST(pass AS BIGINT) AS pass, branch, key FROM keys"),
    "bucket_sizes": (lambda s, d: B.buckets(B.keys(B.prepared(records(s, d).where("source <> 'S1'")))), f"{REC}{KEYS} SELECT key, n FROM bucket"),
    "oversize_buckets": (lambda s, d: B.buckets(B.keys(B.prepared(V.part_records(s, d).where("source <> 'S1'")))).where("n > 25"), f"{PART}{KEYS} SELECT key, n FROM bucket WHERE n > 25"),
    "candidates_small_bucket": (lambda s, d: (lambda p: B.hits(B.keys(p.where("source = 'S1'")), B.keys(p.where("source <> 'S1'")), p.select("entity_id", "name_toks", "addr_toks")).groupBy("s1_id", "cid", "branch").agg(F.round(F.sum("spec"), 6).alias("spec")))(B.prepared(records(s, d))),
        f"{REC}{KEYS}{HITS} SELECT s1_id, cid, branch, round(sum(spec), 6) AS spec FROM hit GROUP BY s1_id, cid, branch"),
    "candidates_large_bucket": (lambda s, d: (lambda p: B.hits(B.keys(p.where("source = 'S1'")), B.keys(p.where("source <> 'S1'")), p.select("entity_id", "name_toks", "addr_toks")).groupBy("s1_id", "cid", "branch").agg(F.round(F.sum("spec"), 6).alias("spec")))(B.prepared(V.part_records(s, d))),
        f"{PART}{KEYS}{HITS} SELECT s1_id, cid, branch, round(sum(spec), 6) AS spec FROM hit GROUP BY s1_id, cid, branch"),
    "candidate_topk": (lambda s, d: B.generate(records(s, d)).select("s1_id", "cid", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")), f"{REC}{KEYS}{CANDIDATES} SELECT s1_id, cid, round(score, 6) AS score, rank FROM cand"),
    "candidate_topk_parts": (lambda s, d: B.generate(V.part_records(s, d)).select("s1_id", "cid", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")), f"{PART}{KEYS}{CANDIDATES} SELECT s1_id, cid, round(score, 6) AS score, rank FROM cand"),
    "candidate_stats": (candidate_stats, f"""{REC}{KEYS}{CANDIDATES}, n AS (SELECT r.country, (SELECT count(*) FROM cand c WHERE c.s1_id = r.entity_id) AS n FROM rec r WHERE source = 'S1')
        SELECT country, count(*) AS records, sum(n)::BIGINT AS pairs, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS most, count(*) FILTER (n = 0) AS without FROM n GROUP BY country"""),
    "index_intersect_capped": (lambda s, d: B.intersect_capped(records(s, d)), f"""{REC}{KEYS}, one AS (SELECT DISTINCT entity_id, source, ordinal, key FROM keys),
        held AS (SELECT *, row_number() OVER (PARTITION BY key, source = 'S1' ORDER BY ordinal) AS r FROM one QUALIFY r <= 100) SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cid FROM held a JOIN held b USING (key) WHERE a.source = 'S1' AND b.source <> 'S1'"""),
    "three_index_block": (lambda s, d: B.three_index(records(s, d)).select("s1_id", "cid", F.col("rank").cast("long").alias("rank")), f"""{REC}, w AS (SELECT *, regexp_extract_all(lower(business_name), '[\\p{{L}}\\p{{N}}]+') AS w FROM p),
        x AS (SELECT *, coalesce(list_filter(w, lambda x: length(x) >= 3 AND x NOT IN {_in(W.RULE_STOPWORDS)})[1], array_to_string(w, '')[1:4]) AS word, array_to_string(w, '')[1:3] AS pre,
          list_filter(list_transform(regexp_extract_all(business_address, '\\d+'), lambda x: coalesce(nullif(ltrim(x, '0'), ''), '0')), lambda x: length(x) BETWEEN 2 AND 6) AS nums,
          regexp_extract_all(business_address, CASE country WHEN 'India' THEN '\\b\\d{{6}}\\b' ELSE '\\b\\d{{5}}\\b' END) AS posts FROM w),
        m AS (SELECT entity_id, source, country, ordinal, 0 AS kind, 1 AS pos, word AS k FROM x WHERE word <> ''
          UNION ALL SELECT entity_id, source, country, ordinal, 1, pos, k FROM (SELECT *, unnest(nums) AS k, generate_subscripts(nums, 1) AS pos FROM x)
          UNION ALL SELECT entity_id, source, country, ordinal, 2, pos, k || '_' || pre FROM (SELECT *, unnest(posts) AS k, generate_subscripts(posts, 1) AS pos FROM x)),
        ix AS (SELECT country, kind, k, entity_id AS cid, row_number() OVER (PARTITION BY country, kind, k ORDER BY ordinal) AS adt FROM (SELECT DISTINCT country, kind, k, entity_id, ordinal FROM m WHERE source <> 'S1') QUALIFY adt <= 30),
        o AS (SELECT m.entity_id AS s1_id, cid, min((m.kind, m.pos, ix.adt)) AS o FROM m JOIN ix USING (country, kind, k) WHERE m.source = 'S1' GROUP BY m.entity_id, cid)
        SELECT s1_id, cid, row_number() OVER (PARTITION BY s1_id ORDER BY o) AS rank FROM o QUALIFY rank <= 8"""),
    "pair_features_native": (lambda s, d: M.pair_features(B.generate(records(s, d)).select("s1_id", "cid"), records(s, d)), f"{REC}{KEYS}{CANDIDATES}{FEATURES} SELECT * FROM feat"),
    # of these, DuckDB has no Indel similarity
    "edit_similarities": (lambda s, d: _jw(s, d), None),
    "threshold_decision": (lambda s, d: scored(s, d).select("s1_id", "cid", "digit_status", "prob", T.passes(F.col("prob"), F.col("digit_status"), F.col("country"), 0.6, 0.7, 0.7, 0.75).alias("accepted")),
        f"""{REC}{KEYS}{CANDIDATES}{FEATURES} SELECT s1_id, cid, digit_status, prob, CASE digit_status WHEN 'conflict' THEN false WHEN 'confirm' THEN prob >= CASE WHEN contains(upper(country), 'FR') THEN 0.7 ELSE 0.6 END ELSE prob >= CASE WHEN contains(upper(country), 'FR') THEN 0.75 ELSE 0.7 END END AS accepted FROM sc"""),
    "assign_greedy": (lambda s, d: M.assign_greedy(scored(s, d)).select("s1_id", "cid", "prob"), f"{REC}{KEYS}{CANDIDATES}{FEATURES}{GREEDY} SELECT s1_id, cid, prob FROM asg"),
    "assign_rank_decay": (lambda s, d: M.assign_greedy(M.rank_decay(scored(s, d))).select("s1_id", "cid", "prob"), f"""{REC}{KEYS}{CANDIDATES}{FEATURES}, rk AS (SELECT *, row_number() OVER w AS rank, max(prob) OVER (PARTITION BY s1_id) AS top FROM sc WINDOW w AS (PARTITION BY s1_id ORDER BY prob DESC, cid)),
        kp AS (SELECT * FROM rk WHERE rank = 1 OR (rank <= 3 AND prob >= 0.88 AND round(top - prob, 9) <= 0.1) OR (rank IN (4, 5) AND digit_status = 'confirm' AND prob >= 0.92 AND round(top - prob, 9) <= 0.05))
        SELECT s1_id, cid, prob FROM kp k WHERE NOT EXISTS (SELECT 1 FROM kp o WHERE o.cid = k.cid AND (o.prob > k.prob OR (o.prob = k.prob AND o.s1_id < k.s1_id)))"""),
    "eval_entity": (lambda s, d: _entity(s, d).select("s1_id", *[F.col(c).cast("long").alias(c) for c in ("tp", "n_true", "n_found")], *[F.round(c, 6).alias(c) for c in ("p", "r", "f05")]), f"{REC}{KEYS}{CANDIDATES}{FEATURES}{GREEDY}{TRUTH}{ENTITY} SELECT s1_id, tp, n_true, n_found, round(p, 6) AS p, round(r, 6) AS r, round(f05, 6) AS f05 FROM es"),
    "eval_macro_micro": (lambda s, d: M.macro_micro(_entity(s, d)), f"""{REC}{KEYS}{CANDIDATES}{FEATURES}{GREEDY}{TRUTH}{ENTITY}, mi AS (SELECT sum(tp) / sum(n_found) AS p, sum(tp) / sum(n_true) AS r FROM es WHERE n_true > 0)
        SELECT count(*) AS entities, round(avg(f05), 6) AS macro_f05, round(avg(es.p), 6) AS macro_p, round(avg(es.r), 6) AS macro_r, count(*) FILTER (n_true = 0) AS singletons, count(*) FILTER (n_true = 0 AND n_found = 0) AS singletons_right,
          round(any_value(mi.p), 6) AS micro_p, round(any_value(mi.r), 6) AS micro_r, round(any_value(1.25 * mi.p * mi.r / (0.25 * mi.p + mi.r)), 6) AS micro_f05 FROM es, mi"""),
    "blocking_recall": (lambda s, d: (lambda r: M.truth_pairs(r).join(B.generate(r).select("s1_id", "cid", F.lit(1).alias("hit")), ["s1_id", "cid"], "left").groupBy(F.substring("cid", 1, 2).alias("catalogue")).agg(F.count("*").alias("true_pairs"), F.count("hit").alias("found"), F.round(F.count("hit") / F.count("*"), 6).alias("recall")))(records(s, d)),
        f"{REC}{KEYS}{CANDIDATES}{TRUTH} SELECT t.cid[1:2] AS catalogue, count(*) AS true_pairs, count(c.cid) AS found, round(count(c.cid) / count(*), 6) AS recall FROM truth t LEFT JOIN cand c ON t.s1_id = c.s1_id AND t.cid = c.cid GROUP BY 1"),
    "branch_attribution": (branch_attribution, f"{REC}{KEYS}{HITS}{TRUTH}, f AS (SELECT s1_id, cid, list(DISTINCT branch) AS b FROM hit SEMI JOIN truth USING (s1_id, cid) GROUP BY s1_id, cid) SELECT branch, count(*) AS pairs, count(*) FILTER (len(b) = 1) AS sole_pairs FROM (SELECT b, unnest(b) AS branch FROM f) GROUP BY branch"),
    "missed_causes": (missed_causes, f"""{REC}{KEYS}{CANDIDATES}{TRUTH}, ms AS (SELECT a.st AS sa, b.st AS sb, a.pin AS pa, b.pin AS pb, a.nt AS na, b.nt AS nb FROM truth t ANTI JOIN cand c ON t.s1_id = c.s1_id AND t.cid = c.cid JOIN p a ON t.s1_id = a.entity_id JOIN p b ON t.cid = b.entity_id),
        c AS (SELECT list_filter([CASE WHEN sa = '' AND sb = '' THEN 'both_missing_state' WHEN sa = '' OR sb = '' THEN 'one_missing_state' WHEN sa <> sb THEN 'state_mismatch' END,
          CASE WHEN pa = '' AND pb = '' THEN 'both_missing_postal' WHEN pa = '' OR pb = '' THEN 'one_missing_postal' WHEN pa <> pb THEN 'postal_mismatch' END,
          CASE WHEN len(na) = 0 OR len(nb) = 0 THEN 'missing_name_tokens' WHEN na[1] <> nb[1] THEN 'name_first_token_mismatch' END], lambda x: x IS NOT NULL) AS c FROM ms)
        SELECT cause, count(*) AS pairs FROM (SELECT unnest(CASE WHEN len(c) = 0 THEN ['bucket_cap'] ELSE c END) AS cause FROM c) GROUP BY cause"""),
    "threshold_sweep": (lambda s, d: M.threshold_sweep(scored(s, d), M.truth_pairs(records(s, d)), CUTS), f"""{REC}{KEYS}{CANDIDATES}{FEATURES}{TRUTH}, m AS (SELECT sc.prob, CASE WHEN t.cid IS NULL THEN 0 ELSE 1 END AS y FROM sc LEFT JOIN truth t ON sc.s1_id = t.s1_id AND sc.cid = t.cid),
        cuts AS (SELECT unnest({CUTS})::DOUBLE AS cut), g AS (SELECT cut, coalesce(sum(y) FILTER (prob >= cut), 0)::BIGINT AS tp, count(*) FILTER (prob >= cut) AS found, sum(y) AS tot FROM m, cuts GROUP BY cut),
        pr AS (SELECT *, CASE WHEN found > 0 THEN tp / found ELSE 0 END AS p0, CASE WHEN tot > 0 THEN tp / tot ELSE 0 END AS r0 FROM g)
        SELECT cut, tp, found, round(p0, 6) AS p, round(r0, 6) AS r, round(CASE WHEN tp > 0 THEN 1.25 * p0 * r0 / (0.25 * p0 + r0) ELSE 0 END, 6) AS f05 FROM pr"""),
    "config_grid": (lambda s, d: config_grid(s, d), f"""{REC}{KEYS}{CANDIDATES}{FEATURES}{TRUTH}, cfg(config, confirm, absent) AS (VALUES {", ".join(f"({i}, {c}::DOUBLE, {a}::DOUBLE)" for i, (c, a) in enumerate(CONFIGS))}),
        ok AS (SELECT cfg.*, sc.cid, t.cid IS NOT NULL AS y FROM sc LEFT JOIN truth t ON sc.s1_id = t.s1_id AND sc.cid = t.cid, cfg WHERE digit_status <> 'conflict' AND prob >= CASE WHEN digit_status = 'confirm' THEN greatest(confirm, CASE WHEN country = 'France' THEN 0.7 ELSE 0 END) ELSE greatest(absent, CASE WHEN country = 'France' THEN 0.75 ELSE 0 END) END)
        SELECT config, confirm, absent, count(*) AS pairs, count(*) FILTER (y) AS true_pairs, count(DISTINCT cid) AS vendors FROM ok GROUP BY ALL"""),
    "validate_output": (lambda s, d: M.validate(*broken_lists(s, d)), f"""{REC}, ref AS (SELECT entity_id AS s1_id, ordinal FROM rec WHERE source = 'S1'),
        li AS (SELECT s1_id, CASE WHEN ordinal % 5 = 0 THEN 'S2-1,S2-1' WHEN ordinal % 7 = 0 THEN s1_id WHEN ordinal % 11 = 0 THEN 'X9-1' ELSE '' END AS ids FROM ref WHERE ordinal % 13 <> 0
          UNION ALL SELECT 'S1-x' || ordinal, '' FROM ref WHERE ordinal % 17 = 0 UNION ALL SELECT s1_id, '' FROM ref WHERE ordinal % 19 = 0 AND ordinal % 13 <> 0),
        ex AS (SELECT s1_id, id FROM (SELECT s1_id, unnest(string_split(ids, ',')) AS id FROM li) WHERE id <> '')
        SELECT DISTINCT 'error' AS severity, rule, offender FROM (SELECT 'duplicate_s1' AS rule, s1_id AS offender FROM li GROUP BY s1_id HAVING count(*) > 1
          UNION ALL SELECT 'duplicate_in_list', s1_id || '|' || id FROM ex GROUP BY s1_id, id HAVING count(*) > 1 UNION ALL SELECT 'self_match', s1_id || '|' || id FROM ex WHERE starts_with(id, 'S1-')
          UNION ALL SELECT 'wrong_prefix', s1_id || '|' || id FROM ex WHERE NOT regexp_matches(id, '^S[123]-') UNION ALL SELECT 'missing_s1', s1_id FROM ref WHERE s1_id NOT IN (SELECT s1_id FROM li) UNION ALL SELECT 'extra_s1', s1_id FROM li WHERE s1_id NOT IN (SELECT s1_id FROM ref))"""),
    "rf_train_score": (rf_train_score, None),
}


def _all() -> dict:
    from . import cleaning, delivery, learned, probing

    return PARTS | cleaning.PARTS | learned.PARTS | delivery.PARTS | probing.PARTS


def queries() -> dict:
    return {k: q for k, (q, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _all().items() if sql}
