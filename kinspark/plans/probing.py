"""Registered queries of first-come probes, lookalikes, the seven features and the causes of missed pairs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking as B
from ..operators import matching as M
from ..operators import probes as P
from .registry import CANDIDATES, HITS, KEYS, REC, TRUTH, records


def keyed(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(entity_id, key, ordinal) of the reference and of the vendors."""
    r = records(s, d)
    keys = B.keys(B.prepared(r)).select("entity_id", "key").join(r.select("entity_id", "ordinal", "source"), "entity_id")
    return keys.where("source = 'S1'"), keys.where("source <> 'S1'")


def first_hits(s: SparkSession, d: str) -> DataFrame:
    """Of all that blocking admits, each record's first ten."""
    r = records(s, d)
    p = B.prepared(r)
    hits = B.hits(B.keys(p.where("source = 'S1'")), B.keys(p.where("source <> 'S1'")), p.select("entity_id", "name_toks", "addr_toks"))
    return P.first_come(hits.select("s1_id", "cid").distinct().join(r.select(F.col("entity_id").alias("cid"), "ordinal"), "cid"))


def lookalikes(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    side = lambda keep, name: r.where(keep).select(F.col("entity_id").alias(name), F.col("business_name").alias("name"), "ordinal")
    return P.lookalikes(side("source = 'S1'", "s1_id"), side("source <> 'S1'", "cid"), M.truth_pairs(r))


def pairs(s: SparkSession, d: str) -> DataFrame:
    return B.generate(records(s, d)).select("s1_id", "cid")


def altered(s: SparkSession, d: str) -> DataFrame:
    """Records of which four in five vendors are changed so that blocking may miss them."""
    k = F.when(F.col("source") != "S1", F.col("ordinal") % 5).otherwise(0)
    return records(s, d).withColumns({
        "business_name": F.when(k == 1, F.reverse("business_name")).when(k == 4, "").otherwise(F.col("business_name")),
        "business_address": F.when(k == 2, "").otherwise(F.col("business_address")), "country": F.when(k == 3, "Spain").otherwise(F.col("country")),
    })


def planted_causes(s: SparkSession, d: str) -> DataFrame:
    """Why true pairs would be missed in altered records, counted."""
    return P.causes(M.truth_pairs(records(s, d)), altered(s, d)).groupBy("cause").agg(F.count("*").alias("pairs"))


_AT = REC.index(",\np AS (")
ALTERED = f"""{REC[:_AT]},
alt AS (SELECT * REPLACE (CASE WHEN source = 'S1' THEN business_name WHEN ordinal % 5 = 1 THEN reverse(business_name) WHEN ordinal % 5 = 4 THEN '' ELSE business_name END AS business_name,
  CASE WHEN source <> 'S1' AND ordinal % 5 = 2 THEN '' ELSE business_address END AS business_address, CASE WHEN source <> 'S1' AND ordinal % 5 = 3 THEN 'Spain' ELSE country END AS country) FROM rec){REC[_AT:].replace("AS pin FROM rec)", "AS pin FROM alt)")}"""
_words = lambda c: f"list_distinct(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+'))"
_numbers = lambda c: f"list_distinct(list_transform(regexp_extract_all({c}, '\\d+'), lambda x: coalesce(nullif(ltrim(x, '0'), ''), '0')))"
_code = lambda c, what: f"CASE WHEN a.{c} = '' AND b.{c} = '' THEN 'both_missing_{what}' WHEN a.{c} = '' OR b.{c} = '' THEN 'one_missing_{what}' WHEN a.{c} <> b.{c} THEN '{what}_mismatch' END"

PARTS = {
    "slice_probe": (lambda s, d: P.slice_probe(*keyed(s, d)), f"""{REC}{KEYS}, ks AS (SELECT DISTINCT entity_id, source, ordinal, key FROM keys), ix AS (SELECT key, entity_id AS s1_id FROM ks WHERE source = 'S1' QUALIFY row_number() OVER (PARTITION BY key ORDER BY ordinal, entity_id) <= 25),
        m AS (SELECT DISTINCT s1_id, v.entity_id AS cid, v.ordinal FROM ks v JOIN ix USING (key) WHERE v.source <> 'S1') SELECT s1_id, cid FROM m QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY ordinal, cid) <= 12"""),
    "first_hits": (first_hits, f"""{REC}{KEYS}{HITS}, m AS (SELECT DISTINCT h.s1_id, h.cid, r.ordinal FROM hit h JOIN rec r ON h.cid = r.entity_id) SELECT s1_id, cid FROM m QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY ordinal, cid) <= 10"""),
    "prefix_lookalikes": (lookalikes, f"""{REC}{TRUTH}, tp AS (SELECT DISTINCT s1_id, cid FROM truth), pf AS (SELECT *, lower(business_name[1:4]) AS pre FROM rec), ix AS (SELECT pre, entity_id AS cid, ordinal FROM pf WHERE source <> 'S1' QUALIFY row_number() OVER (PARTITION BY pre ORDER BY ordinal, entity_id) <= 8),
        nw AS (SELECT f.entity_id AS s1_id, ix.cid, row_number() OVER (PARTITION BY f.entity_id ORDER BY ix.ordinal, ix.cid) AS r FROM pf f JOIN ix USING (pre) WHERE f.source = 'S1' AND NOT EXISTS (SELECT 1 FROM tp WHERE tp.s1_id = f.entity_id AND tp.cid = ix.cid)),
        n AS (SELECT s1_id, count(*) AS n FROM tp GROUP BY 1) SELECT s1_id, cid FROM tp UNION ALL SELECT nw.s1_id, nw.cid FROM nw LEFT JOIN n USING (s1_id) WHERE coalesce(n, 0) + r <= 12"""),
    "seven_features": (lambda s, d: P.seven_features(pairs(s, d), records(s, d)), None),
    "seven_features_native": (lambda s, d: P.native_features(pairs(s, d), records(s, d)).select("s1_id", "cid", "address_token_jaccard", "numerical_overlap", "name_exact_match", "address_exact_match"),
        f"""{REC}{KEYS}{CANDIDATES}, x AS (SELECT s1_id, cid, {_words("l.business_address")} AS wa, {_words("r.business_address")} AS wb, {_numbers("l.business_address")} AS na, {_numbers("r.business_address")} AS nb, lower(trim(l.business_name)) AS la, lower(trim(r.business_name)) AS lb,
          lower(trim(l.business_address)) AS aa, lower(trim(r.business_address)) AS ab FROM cand JOIN rec l ON s1_id = l.entity_id JOIN rec r ON cid = r.entity_id)
        SELECT s1_id, cid, round(CASE WHEN len(list_concat(wa, wb)) = 0 THEN CASE WHEN aa = ab AND aa <> '' THEN 1 ELSE 0 END ELSE len(list_intersect(wa, wb)) / len(list_distinct(list_concat(wa, wb))) END, 6) AS address_token_jaccard,
          CASE WHEN len(list_intersect(na, nb)) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS numerical_overlap, CASE WHEN la = lb THEN 1.0 ELSE 0.0 END::DOUBLE AS name_exact_match, CASE WHEN aa = ab THEN 1.0 ELSE 0.0 END::DOUBLE AS address_exact_match FROM x"""),
    "missed_causes_planted": (planted_causes, f"""{ALTERED}{TRUTH}, c AS (SELECT CASE WHEN a.country <> b.country THEN ['country_mismatch'] ELSE list_filter([{_code("st", "state")}, {_code("pin", "postal")},
          CASE WHEN len(a.nt) = 0 OR len(b.nt) = 0 THEN 'missing_name_tokens' WHEN a.nt[1] <> b.nt[1] THEN CASE WHEN len(list_intersect(a.nt, b.nt)) = 0 THEN 'name_completely_different' ELSE 'name_first_token_mismatch' END END,
          CASE WHEN len(a.nt) > 0 AND len(b.nt) > 0 AND a.nt[1][1:3] <> b.nt[1][1:3] THEN 'name_prefix3_mismatch' END,
          CASE WHEN a.business_address = '' OR b.business_address = '' THEN 'missing_address' WHEN len(list_intersect(list_distinct(regexp_extract_all(lower(a.business_address), '[a-z0-9]+')), list_distinct(regexp_extract_all(lower(b.business_address), '[a-z0-9]+')))) < 2 THEN 'address_completely_different' END], lambda x: x IS NOT NULL) END AS c
          FROM truth t JOIN p a ON t.s1_id = a.entity_id JOIN p b ON t.cid = b.entity_id)
        SELECT cause, count(*) AS pairs FROM (SELECT unnest(CASE WHEN len(c) = 0 THEN ['bucket_cap'] ELSE c END) AS cause FROM c) GROUP BY cause"""),
}
