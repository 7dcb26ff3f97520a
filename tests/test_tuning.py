import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinspark.operators import learning as L
from kinspark.operators import profile as P
from kinspark.operators import tuning as U

SCORED = "s1_id string, cid string, prob double, digit_status string, country string"


def pairs(seed, n=160, refs=12, vendors=25):
    r = random.Random(seed)
    # both ends of a pair are of one country, by their number
    made = {(f"S1-{a}", f"S{r.choice([2, 3])}-{3 * r.randrange(vendors // 3) + a % 3}") for a in (r.randrange(refs) for _ in range(n))}
    # few values, so that priorities tie
    return [(a, b, r.choice([0.8, 0.85, 0.9, 0.91, 0.92, 0.95, 1.0]), r.choice(["confirm", "confirm", "absent", "conflict"]), "US" if int(a[3:]) % 3 else "France") for a, b in sorted(made)]


def in_sequence(rows):
    used, taken, out = set(), {}, set()
    extra = {"confirm": 0.05, "absent": 0.0, "conflict": -0.5}
    for a, b, p, d, _ in sorted(rows, key=lambda x: (-round(x[2] + extra[x[3]], 9), x[0], x[1])):
        n = taken.get((a, b[:2]), 0)
        need = (0.85 if d == "confirm" else 0.9) if n == 0 else (0.92 if n == 1 and d == "confirm" else 9)
        if b not in used and p >= need:
            used.add(b)
            taken[a, b[:2]] = n + 1
            out.add((a, b))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rounds_take_what_the_sequence_takes(spark, seed):
    rows = pairs(seed)
    got = U.assign_calibrated(spark.createDataFrame(rows, SCORED)).collect()
    assert len(got) == len({(r.s1_id, r.cid) for r in got})
    assert {(r.s1_id, r.cid) for r in got} == in_sequence(rows)


def test_rounds_of_nothing(spark):
    assert U.assign_calibrated(spark.createDataFrame([], SCORED)).count() == 0
    assert U.assign_calibrated(spark.createDataFrame([("S1-1", "S2-1", 0.5, "absent", None), (None, None, None, None, None)], SCORED)).count() == 0


def test_grid_is_the_plain_grid(spark):
    rows = pairs(7)
    r = random.Random(3)
    truth = {f"S1-{i}": {b for a, b, *_ in rows if a == f"S1-{i}" and r.random() < 0.3} for i in range(14)}
    axes = [[0.8, 0.9], [0.85, 0.95], [0.9], [0.91, 1.0]]
    base = (0.9, 0.95, 0.9, 1.0)

    def plain(c, a, tc, ta):
        ok = [x for x in rows if x[3] != "conflict" and x[2] >= ((tc if x[3] == "confirm" else ta) if x[4] == "France" else (c if x[3] == "confirm" else a))]
        used, found = set(), {}
        for x in sorted(ok, key=lambda x: (-x[2], x[0])):
            if x[1] not in used:
                used.add(x[1])
                found.setdefault(x[0], set()).add(x[1])
        total = 0.0
        for s, want in truth.items():
            got = found.get(s, set())
            tp = len(want & got)
            total += 1.0 if not want and not got else 0.0 if not tp else 1.25 * (tp / len(got)) * (tp / len(want)) / (0.25 * tp / len(got) + tp / len(want))
        return round(total / len(truth), 6), len(truth) - len(found), len(used)

    ids = spark.createDataFrame([(s, sorted(w)) for s, w in truth.items()], "s1_id string, ids array<string>")
    out = U.grid(spark.createDataFrame(rows, SCORED), ids, *axes, base)
    got = {(x.confirm, x.absent, x.tight_confirm, x.tight_absent): x for x in out.collect()}
    assert set(got) == set(itertools.product(*axes))
    for k, x in got.items():
        assert (round(x.macro_f05, 6), x.singletons, x.vendors) == plain(*k)
        assert round(x.gain, 6) == pytest.approx(plain(*k)[0] - plain(*base)[0], abs=2e-6)
    fired = U.tripwire(out, 0, 100).collect()
    assert all(x.safe and x.gain > 0 for x in fired) and len(fired) == sum(x.gain > 0 for x in got.values())


def test_rule_matcher(spark):
    rows = [("S1-1", "Alpha Beta", "12 x"), ("S2-1", "beta alpha", "12 y"), ("S2-2", "alpha beta", "13 y"), ("S2-3", "alpha beta gamma", "no"), ("S2-4", "alpha betb", "0012"), ("S2-5", "zeta", "12")]
    rec = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string")
    cands = spark.createDataFrame([("S1-1", f"S2-{i}", i) for i in range(1, 6)], "s1_id string, cid string, rank int")
    got = U.rule_match(cands, rec).orderBy("place").collect()
    assert [(x.cid, x.place) for x in got] == [("S2-1", 1), ("S2-3", 2)]  # S2-2 conflicts, S2-4 is third


def test_learning(spark):
    r = random.Random(5)
    data = [(f"S1-{i}", f"S2-{i}", float(y), *[min(1.0, max(0.0, r.gauss(0.3 + 0.4 * y, 0.15))) for _ in range(2)]) for i in range(400) for y in [int(i % 8 == 0)]]
    df = spark.createDataFrame(data, "s1_id string, cid string, label double, a double, b double")
    some = L.sample_negatives(df, ratio=3.0)
    n = {x.label: x["count"] for x in some.groupBy("label").count().collect()}
    assert n[1.0] == 50 and 100 <= n[0.0] <= 200
    ready = L.prepared(df, ["a", "b"])
    model = L.cross_validated(ready, L.forest(depth=4), [5, 10]).bestModel
    assert set(L.importances(model, ["a", "b"])) == {"a", "b"}
    out = L.scored(model, ready)
    assert sum(x.n for x in L.confusion(out).collect()) == 400
    assert {x.label: x.recall > 0.8 for x in L.report(out).collect()} == {0.0: True, 1.0: True}
    keys = spark.createDataFrame([("S1-1", 1, "k"), ("S1-2", 2, "k"), ("S1-3", 3, "big"), ("S1-4", 4, "big"), ("S1-5", 5, "big")], "entity_id string, ordinal long, key string")
    vendors = spark.createDataFrame([("S2-1", 1, "k"), ("S2-2", 9, "k"), ("S2-3", 1, "big")], "entity_id string, ordinal long, key string")
    true = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cid string")
    assert [tuple(x) for x in L.hard_negatives(keys, vendors, true, bucket=2, of_each=10, first=5).collect()] == [("S1-2", "S2-1")]
    drawn = L.random_negatives(keys.select(F.col("entity_id").alias("s1_id")), vendors.select(F.col("entity_id").alias("cid")), true, each=4, parts=2)
    assert 0 < drawn.count() <= 20 and drawn.join(true, ["s1_id", "cid"]).count() == 0


def test_profiles(spark):
    df = spark.createDataFrame([("Acme LTD.", "OH, x"), ("acme ltd", None), (None, "5 st. x"), ("ABCD", "Street 1"), ("O'Neil", "")], "business_name string, business_address string").withColumn("country", F.lit("US"))
    got = {x.label: (x.n_full, x.n_short) for x in P.pattern_counts(df, ["business_name"], P.SUFFIXES).collect()}
    assert got["Ltd"] == (2, None) and got["Limited"] == (0, None)
    assert {x.label: (x.n_full, x.n_short) for x in P.pattern_counts(df, ["business_address"], P.ADDRESS_FORMS).collect()}["Street"] == (1, 1)
    assert P.case_counts(df, "business_name").first().asDict() == {"upper": 1, "lower": 1, "title": 1, "n": 5, "mixed": 2}
    assert [x.kind for x in P.address_order(df).collect()] == ["state-first"]
    assert P.pattern_counts(df.limit(0), ["business_name"], P.SUFFIXES).agg(F.sum("n_full")).first()[0] == 0


def test_registered_models_have_the_sizes_of_the_survey(spark, monkeypatch):
    from kinspark.plans import learned as P

    forests, boosts, trees = [], [], []

    class Stop(Exception):
        pass

    def boosted(**k):
        boosts.append(k)
        raise Stop

    def forest(**k):
        forests.append(L_forest(**k))
        if len(forests) == 2:
            raise Stop
        return forests[0]

    L_forest = L.forest
    monkeypatch.setattr(P, "labelled", lambda s, d: None)
    monkeypatch.setattr(P, "cut", lambda x: x)
    monkeypatch.setattr(L, "sample_negatives", lambda x: x)
    monkeypatch.setattr(L, "prepared", lambda x: x)
    monkeypatch.setattr(L, "forest", forest)
    monkeypatch.setattr(L, "boosted", boosted)
    monkeypatch.setattr(L, "cross_validated", lambda data, estimator, n: trees.extend(n) or type("M", (), {"avgMetrics": [0.5], "bestModel": None}))
    for query in (P.forest_cv, P.boosted_report):
        with pytest.raises(Stop):
            query(None, "")
    assert trees == [200] and forests[1].getNumTrees() == 300 and boosts == [{"rounds": 120, "depth": 6}]
    assert all(f.getMaxDepth() == 12 and f.getMinInstancesPerNode() == 5 for f in forests)


def test_importances_are_a_table(spark, monkeypatch):
    from kinspark.plans import learned as P

    r = random.Random(6)
    rows = [(f"S1-{i}", f"S2-{i}", float(i % 4 == 0), *[r.random() + (i % 4 == 0) for _ in L.FEATURES]) for i in range(120)]
    pairs = spark.createDataFrame(rows, f"s1_id string, cid string, label double, {', '.join(f'{f} double' for f in L.FEATURES)}")
    small = L.forest
    monkeypatch.setattr(P, "labelled", lambda s, d: pairs)
    monkeypatch.setattr(P, "cut", lambda x: x)
    monkeypatch.setattr(L, "forest", lambda **k: small(**k | {"trees": 5, "depth": 3}))
    monkeypatch.setattr(L, "cross_validated", lambda data, estimator, n, f=L.cross_validated: f(data, estimator, [5]))
    got = P.forest_cv(spark, "").collect()
    assert {x.feature for x in got} == set(L.FEATURES) and abs(sum(x.importance for x in got) - 1) < 1e-4
    assert {x.cv_area for x in got} == {got[0].cv_area} and 0.5 < got[0].cv_area <= 1
