"""Registered queries of the normalisers and profiles, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import forms
from ..functions import normalize as N
from ..functions import tables as R
from ..functions import text as T
from ..functions import words as W
from ..operators import matching as M
from ..operators import profile as P
from ..sources import views as V
from .registry import NOISY, REC, TRUTH, noisy, records


def _rx(pattern: str, ignore_case: bool = True) -> str:
    """A profile's pattern for RE2, whose edges are of ASCII: they are written out, as only occurrence counts."""
    word = r"\p{L}\p{N}_"
    p = pattern.replace(r"\.?\b", r"\b")
    if p.startswith(r"\b"):
        p = f"(^|[^{word}])" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + f"([^{word}]|$)"
    return "'" + ("(?i)" if ignore_case else "") + p.replace("'", "''") + "'"


def _counts_sql(columns: list[str], patterns: dict, upper_short: bool = False, ignore_case: bool = True) -> str:
    total = lambda p, ignore: " + ".join(f"count(*) FILTER (regexp_matches({c}, {_rx(p, ignore)}))" for c in columns)
    one = []
    for label, p in patterns.items():
        full, short = p if isinstance(p, tuple) else (p, None)
        one.append(f"SELECT '{label}' AS label, ({total(full, ignore_case)})::BIGINT AS n_full, {f'({total(short, not upper_short)})::BIGINT' if short else 'NULL::BIGINT'} AS n_short FROM rec")
    return f"{REC} " + " UNION ALL ".join(one)


def _profile(columns: list[str], patterns: dict, **options):
    return (lambda s, d: P.pattern_counts(records(s, d), columns, patterns, **options), _counts_sql(columns, patterns, **options))


def _sql_rules(column: str, listed: list[tuple[str, str]]) -> str:
    """Rewriting rules for RE2."""
    out = column
    for pattern, by in forms.re2(listed):
        out = f"regexp_replace({out}, '{pattern}', '{by}', 'g')"
    return out


_ascii = lambda c: f"strip_accents(replace(replace(lower({c}), 'œ', 'oe'), 'æ', 'ae'))"
_punct = lambda c: f"trim(regexp_replace(regexp_replace(translate(replace({c}, '&', ' and '), '[](){{}}:;#|', '            '), '--+', '-', 'g'), '\\s+', ' ', 'g'))".replace("{{}}", "{}")
_dots = lambda c: f"trim(regexp_replace(replace(regexp_replace({c}, '\\.(\\S)', '. \\1', 'g'), '.', ''), '\\s+', ' ', 'g'))"

_DOUBLED = [(rf"\b{w}\s+{w}\b", w) for w in R.DOUBLED_NAME]  # RE2 has no back references
NAME_SQL = f"""{REC}{NOISY}, c1 AS (SELECT n.entity_id, r.country, {_sql_rules(_punct(_ascii("n.raw")), [*R.legal(), *_DOUBLED])} AS x FROM noisy n JOIN rec r USING (entity_id))
  SELECT entity_id, {_dots("CASE country WHEN 'India' THEN regexp_replace(x, '" + chr(92) + "bprivate$', 'private limited') ELSE x END")} AS name FROM c1"""

# what looks ahead for a number, and doubled words, do not occur in these addresses
_ADDRESS_RULES = [(r"\b(\d+(?:st|nd|rd|th))\s+saint\b", "$1 street"), *[r for r in R.address_words() if r"(?=\s*\d" not in r[0] and r"\1" not in r[0]]]
# edges of RE2 know no ß, so it is written as letters on the way
ADDRESS_SQL = f"""{REC}, c1 AS (SELECT entity_id, country, {_dots(_punct(f"regexp_replace(replace({_ascii('business_address')}, 'ß', 'zqz'), '{chr(92)}b{forms.one_of(R.NO_VALUE)}{chr(92)}b', '', 'g')"))} AS x FROM rec),
  c2 AS (SELECT entity_id, CASE country WHEN 'France' THEN {_sql_rules("x", R.french_letters())} ELSE x END AS x FROM c1)
  SELECT entity_id, replace(trim(regexp_replace({_sql_rules("x", _ADDRESS_RULES)}, '\\s+', ' ', 'g')), 'zqz', 'ß') AS address FROM c2"""


def with_landmarks(s: SparkSession, d: str) -> DataFrame:
    """Addresses that stand near their third word and opposite their fourth."""
    w = lambda i: F.coalesce(F.get(F.split("business_name", " "), F.lit(i)), F.lit(""))
    r = records(s, d).select("entity_id", F.concat(F.lit("5, Near "), w(0), F.lit(" "), w(1), F.lit(", Opp. "), w(2), F.lit(", x")).alias("a"))
    return r.select("entity_id", F.array_join(N.landmarks(F.col("a")), "|").alias("landmarks"))


LANDMARK_SQL = f"""{REC}, w AS (SELECT entity_id, string_split(business_name, ' ') AS w FROM rec), v AS (SELECT entity_id, trim(coalesce(w[1], '') || ' ' || coalesce(w[2], '')) AS a, coalesce(w[3], '') AS b,
    length(coalesce(w[1], '') || ' ' || coalesce(w[2], '')) AS la FROM w)
  SELECT entity_id, concat_ws('|', CASE WHEN a <> '' AND la BETWEEN 3 AND 40 THEN 'near ' || a END, CASE WHEN b <> '' AND length(b) BETWEEN 3 AND 40 THEN 'opposite ' || b END) AS landmarks FROM v"""


def in_script(s: SparkSession, d: str) -> DataFrame:
    """Names with letters a, k, m of Latin written in Devanagari, transliterated."""
    return records(s, d).select("entity_id", N.transliterate(F.translate("business_name", "akmKs", "ाकमखस")).alias("name"))


def cleaned(s: SparkSession, d: str) -> DataFrame:
    return P.normalized_quality(N.with_clean(records(s, d)))


def truth_lists(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    found = M.truth_pairs(r).groupBy("s1_id").agg(F.collect_set("cid").alias("ids"))
    return r.where("source = 'S1'").select(F.col("entity_id").alias("s1_id")).join(found, "s1_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


PARTS = {
    "normalize_name": (lambda s, d: noisy(s, d).select("entity_id", N.normalize_name(F.col("raw"), F.col("country")).alias("name")), NAME_SQL),
    "normalize_address": (lambda s, d: records(s, d).select("entity_id", N.normalize_address(F.col("business_address"), F.col("country")).alias("address")), ADDRESS_SQL),
    "normalize_part_address": (lambda s, d: V.part_records(s, d).select("entity_id", N.normalize_address(F.col("business_address"), F.col("country")).alias("address")), None),
    "strip_accents": (lambda s, d: records(s, d).select("entity_id", N.strip_accents(F.col("business_name")).alias("name")), f"{REC} SELECT entity_id, strip_accents(business_name) AS name FROM rec"),
    "fold_accents": (lambda s, d: records(s, d).select("entity_id", N.fold(F.col("business_name")).alias("name")), f"{REC} SELECT entity_id, trim(regexp_replace(regexp_replace(strip_accents(business_name), '{chr(92)}b{forms.one_of(R.FOLDED_AWAY)}{chr(92)}b', '', 'g'), '\\s+', ' ', 'g')) AS name FROM rec"),
    "transliterate": (in_script, f"{REC} SELECT entity_id, replace(translate(translate(business_name, 'akmKs', 'ाकमखस'), 'ाकमस', 'akms'), 'ख', 'kh') AS name FROM rec"),
    "landmarks": (with_landmarks, LANDMARK_SQL),
    "profile_suffixes": _profile(["business_name"], P.SUFFIXES),
    "profile_address_forms": _profile(["business_address"], P.ADDRESS_FORMS),
    "profile_signs": _profile(["business_name", "business_address"], P.SIGNS, ignore_case=False),
    "profile_landmarks": _profile(["business_address"], P.LANDMARKS),
    "profile_in_states": _profile(["business_address"], P.IN_STATES, upper_short=True),
    "profile_us_states": _profile(["business_address"], P.US_STATES, upper_short=True),
    "profile_french": _profile(["business_name", "business_address"], P.FRENCH),
    "profile_case": (lambda s, d: P.case_counts(noisy(s, d), "raw"), None),
    "profile_mixed_scripts": (lambda s, d: P.mixed_scripts(records(s, d).withColumn("n", F.translate("business_name", "ak", "ाक")), "n").select("entity_id"), f"{REC} SELECT entity_id FROM rec WHERE regexp_matches(business_name, '[b-jl-zA-Z]') AND regexp_matches(business_name, '[ak]')"),
    "profile_address_order": (
        lambda s, d: P.address_order(records(s, d).withColumn("business_address", F.when(F.col("ordinal") % 3 == 0, F.concat(F.lit("OH, Columbus, "), F.col("business_address"))).when(F.col("ordinal") % 3 == 1, F.concat(F.lit("Mumbai, x, "), F.col("business_address"))).otherwise(F.col("business_address")))).select("entity_id", "kind"),
        f"{REC} SELECT entity_id, CASE ordinal % 3 WHEN 0 THEN 'state-first' ELSE 'city-first' END AS kind FROM rec WHERE (ordinal % 3 = 0 AND country = 'US') OR (ordinal % 3 = 1 AND country = 'India')"),
    "profile_truth": (lambda s, d: P.truth_profile(truth_lists(s, d)), f"""{REC}{TRUTH}, l AS (SELECT r.entity_id, count(t.cid) AS n, count(*) FILTER (t.cid LIKE 'S2-%') AS s2, count(*) FILTER (t.cid LIKE 'S3-%') AS s3 FROM rec r LEFT JOIN truth t ON t.s1_id = r.entity_id WHERE r.source = 'S1' GROUP BY 1)
        SELECT count(*) AS entities, count(*) FILTER (n = 0) AS singletons, count(*) FILTER (s2 > 0) AS with_s2, count(*) FILTER (s3 > 0) AS with_s3, count(*) FILTER (s2 > 0 AND s3 > 0) AS with_both, round(avg(n), 6) AS mean_ids, max(n) AS most_ids FROM l"""),
    "profile_normalized": (cleaned, None),
    "clean_saints": (lambda s, d: records(s, d).select("entity_id", T.expand_saints(F.concat(F.lit("st. john "), F.col("business_name"))).alias("name")), f"{REC} SELECT entity_id, regexp_replace('st. john ' || business_name, '\\bst\\.?\\s+({'|'.join(W.SAINTS)})\\b', 'saint \\1', 'g') AS name FROM rec"),
}
