"""Registered queries of assignment by rounds, the rule matcher, grids of thresholds and learning, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking as B
from ..operators import learning as L
from ..operators import matching as M
from ..operators import tuning as U
from ..sources.state import cut
from .cleaning import truth_lists
from .registry import CANDIDATES, FEATURES, KEYS, REC, TRUTH, records, scored

# The ranges of the grid and the thresholds that it is held against.
CONFIRM = [0.78, 0.80, 0.81, 0.82, 0.83, 0.84, 0.85]
ABSENT = [0.86, 0.88, 0.89, 0.90, 0.91, 0.92]
TIGHT_CONFIRM = [0.86, 0.88, 0.90]
TIGHT_ABSENT = [0.90, 0.91, 0.92, 0.93]
BASE = (0.83, 0.90, 0.88, 0.92)


def grid(s: SparkSession, d: str) -> DataFrame:
    return U.grid(scored(s, d), truth_lists(s, d), CONFIRM, ABSENT, TIGHT_CONFIRM, TIGHT_ABSENT, BASE)


def tripwire(s: SparkSession, d: str) -> DataFrame:
    """The grid's winners whose singletons stay within a twentieth of all records around those of truth."""
    n = truth_lists(s, d).agg(F.count("*").alias("n"), F.count_if(F.size("ids") == 0).alias("empty")).first()
    return U.tripwire(grid(s, d), n.empty - n.n // 20, n.empty + n.n // 20)


_list = lambda x: "[" + ", ".join(f"{v}::DOUBLE" for v in x) + "]"
GRID_SQL = f"""{REC}{KEYS}{CANDIDATES}{FEATURES}{TRUTH}, cfg AS (SELECT * FROM (SELECT unnest({_list(CONFIRM)}) AS confirm), (SELECT unnest({_list(ABSENT)}) AS absent), (SELECT unnest({_list(TIGHT_CONFIRM)}) AS tight_confirm), (SELECT unnest({_list(TIGHT_ABSENT)}) AS tight_absent)),
  ok AS (SELECT cfg.*, sc.s1_id, sc.cid, sc.prob FROM sc, cfg WHERE (digit_status = 'confirm' AND prob >= CASE WHEN country = 'France' THEN tight_confirm ELSE confirm END) OR (digit_status = 'absent' AND prob >= CASE WHEN country = 'France' THEN tight_absent ELSE absent END)),
  wn AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY confirm, absent, tight_confirm, tight_absent, cid ORDER BY prob DESC, s1_id) = 1),
  fd AS (SELECT confirm, absent, tight_confirm, tight_absent, wn.s1_id, count(*) AS n_found, count(t.cid) AS tp FROM wn LEFT JOIN truth t ON wn.s1_id = t.s1_id AND wn.cid = t.cid GROUP BY ALL),
  tr AS (SELECT r.entity_id AS s1_id, count(t.cid) AS n_true FROM rec r LEFT JOIN truth t ON t.s1_id = r.entity_id WHERE r.source = 'S1' GROUP BY 1),
  al AS (SELECT cfg.*, tr.n_true, coalesce(fd.n_found, 0) AS n_found, coalesce(fd.tp, 0) AS tp FROM cfg CROSS JOIN tr LEFT JOIN fd USING (confirm, absent, tight_confirm, tight_absent, s1_id)),
  en AS (SELECT *, CASE WHEN n_true = 0 AND n_found = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE tp / n_found END AS p, CASE WHEN n_true = 0 AND n_found = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE tp / n_true END AS r FROM al),
  ag AS (SELECT confirm, absent, tight_confirm, tight_absent, round(avg(CASE WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END), 6) AS macro_f05, round(avg(p), 6) AS macro_p, round(avg(r), 6) AS macro_r, count(*) FILTER (n_found = 0) AS singletons, sum(n_found)::BIGINT AS vendors FROM en GROUP BY ALL)
  SELECT * FROM ag"""


def grid_rounded(s: SparkSession, d: str) -> DataFrame:
    return grid(s, d).select("confirm", "absent", "tight_confirm", "tight_absent", *[F.round(c, 6).alias(c) for c in ("macro_f05", "macro_p", "macro_r")], "singletons", "vendors")


def labelled(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    pairs = M.pair_features(B.generate(r).select("s1_id", "cid"), r)
    return pairs.join(M.truth_pairs(r).withColumn("y", F.lit(1.0)), ["s1_id", "cid"], "left").withColumn("label", F.coalesce("y", F.lit(0.0))).drop("y")


def forest_cv(s: SparkSession, d: str) -> DataFrame:
    """Each feature's weight in a forest of 300 trees, and the mean area under ROC of 200 trees on the folds."""
    data = L.prepared(cut(L.sample_negatives(cut(labelled(s, d)))))
    area = float(max(L.cross_validated(data, L.forest(depth=12, leaf=5), [200]).avgMetrics))  # a numpy number, which no row takes
    model = L.forest(trees=300, depth=12, leaf=5).fit(data)
    return s.createDataFrame([(k, round(v, 6), round(area, 6)) for k, v in L.importances(model).items()], "feature string, importance double, cv_area double")


def boosted_report(s: SparkSession, d: str) -> DataFrame:
    """Precision and recall of boosted trees by label."""
    data = L.prepared(cut(L.sample_negatives(cut(labelled(s, d)))))
    return L.report(L.scored(L.boosted(rounds=120, depth=6).fit(data), data))


def hard_negatives(s: SparkSession, d: str) -> DataFrame:
    keys = B.keys(B.prepared(records(s, d))).join(records(s, d).select("entity_id", F.col("ordinal").alias("o")), "entity_id")
    side = lambda keep: keys.where(keep).select("entity_id", F.col("o").alias("ordinal"), "key").distinct()
    return L.hard_negatives(side("entity_id like 'S1-%'"), side("entity_id not like 'S1-%'"), M.truth_pairs(records(s, d)))


def random_negatives(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d)
    side = lambda keep, name: r.where(keep).select(F.col("entity_id").alias(name))
    return L.random_negatives(side("source = 'S1'", "s1_id"), side("source <> 'S1'", "cid"), M.truth_pairs(r))


PARTS = {
    "assign_calibrated": (lambda s, d: U.assign_calibrated(scored(s, d)).select("s1_id", "cid", "prob"), None),
    "rule_match": (lambda s, d: U.rule_match(B.three_index(records(s, d)), records(s, d)).select("s1_id", "cid", "sim", "place"), None),
    "grid_thresholds": (grid_rounded, GRID_SQL),
    "grid_tripwire": (tripwire, None),
    "hard_negatives": (hard_negatives, f"""{REC}{KEYS}{TRUTH}, dk AS (SELECT DISTINCT entity_id, source, ordinal, key FROM keys), sm AS (SELECT key FROM dk WHERE source = 'S1' GROUP BY key HAVING count(*) <= 100)
        SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS cid FROM dk a JOIN sm USING (key) JOIN dk b USING (key) WHERE a.source = 'S1' AND b.source <> 'S1' AND b.ordinal % 100000 < 4000
        AND NOT EXISTS (SELECT 1 FROM truth t WHERE t.s1_id = a.entity_id AND t.cid = b.entity_id)"""),
    "random_negatives": (random_negatives, None),
    "forest_importances": (forest_cv, None),
    "boosted_report": (boosted_report, None),
}
