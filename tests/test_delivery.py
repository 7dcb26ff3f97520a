"""The cascade, files and lists, and the evaluation report against plain versions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinspark.functions import edit as E
from kinspark.operators import cascade as C
from kinspark.operators import files as X
from kinspark.operators import matching as M

RECORD = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(2)
    names = ["quorlex tovin", "quorlex tovim", "zzz", "", "quorlex", "tovin hall quorlex"]
    rows = [(f"S{i % 3 + 1}-{i}", rng.choice(names), f"{rng.choice(['12', '40', ''])} tovin lane, {rng.choice(['ca', 'tx'])}", rng.choice(["US", "India"])) for i in range(60)]
    records = spark.createDataFrame(rows, RECORD)
    ids = [r[0] for r in rows]
    pairs = spark.createDataFrame([(a, b) for a, b in itertools.product([i for i in ids if i[1] == "1"], [i for i in ids if i[1] != "1"])], "s1_id string, cid string")
    return {r[0]: r for r in rows}, pairs, records


def test_tiers_are_the_plain_ones(features):
    rows, pairs, records = features
    made = C.ten_features(pairs, records)
    got = {(r.s1_id, r.cid): r for r in C.tiers(made).collect()}
    status = {(r.s1_id, r.cid): r.digit_status for r in M.pair_features(pairs, records).collect()}
    for (a, b), s in status.items():
        x, y = rows[a], rows[b]
        ratio = E.indel(x[1], y[1]) if x[1] and y[1] else 0.0
        if ratio < C.REJECT and s != "confirm":
            assert (a, b) not in got
            continue
        sure = x[1] == y[1] and len(x[1]) >= C.LEAST_NAME and s == "confirm" and E.jaro_winkler(x[2], y[2], compatible=True) >= C.ALIKE
        r = got[a, b]
        assert r.tier == (2 if sure else 3) and r.name_jw == pytest.approx(E.jaro_winkler(x[1], y[1]), abs=1e-6) and r.addr_jw == pytest.approx(E.jaro_winkler(x[2], y[2]), abs=1e-6)
    assert {r.tier for r in got.values()} == {2, 3} and len(got) < len(status)


def test_scores(features):
    _, pairs, records = features
    made = C.ten_features(pairs, records).cache()
    truth = made.where("name_jaccard = 1 and addr_jaccard = 1").select("s1_id", "cid")
    scored = C.score(made, C.fit(made, truth, trees=10, depth=4, leaf=1)).collect()
    assert len(scored) == made.count() and all(r.prob == 1.0 for r in scored if r.tier == 2) and len({r.prob for r in scored}) > 2
    assert C.fit(made, truth.limit(0)) is None and {r.prob for r in C.score(made, None).collect()} <= {0.0, 1.0}
    kept = C.decide(C.score(made, None)).collect()
    assert kept and all(r.tier == 2 for r in kept)


def test_lists(spark):
    ref = spark.createDataFrame([("S1-b", 0), ("S1-a", 1), ("S1-c", 2)], "s1_id string, ordinal long").repartition(3)
    cand = spark.createDataFrame([("S1-a", "S2-9", 1), ("S1-a", "S2-10", 2), ("S1-b", "S3-1", 1)], "s1_id string, cid string, rank int")
    made = X.ranked_lists(cand, ref)
    assert [(r.s1_id, r.ids) for r in made.collect()] == [("S1-b", "S3-1"), ("S1-a", "S2-9,S2-10"), ("S1-c", "")]
    matches = spark.createDataFrame([("S1-a", "S2-10,S2-11"), ("S1-d", "S3-3"), ("S1-b", None)], "s1_id string, ids string")
    assert {r.s1_id: r.ids for r in X.with_matches(made.drop("ordinal"), matches).collect()} == {"S1-a": "S2-10,S2-11,S2-9", "S1-b": "S3-1", "S1-c": "", "S1-d": "S3-3"}
    done = X.completed(ref, matches, made.where("s1_id <> 'S1-a'"))
    assert {r.s1_id: (r.matches, r.candidates) for r in done.collect()} == {"S1-a": ("S2-10,S2-11", "S2-10,S2-11"), "S1-b": ("", "S3-1"), "S1-c": ("", "")}
    assert [(r.rule, r.offender, r.severity) for r in X.outside_candidates(matches.where("s1_id = 'S1-a'"), made).collect()] == [("not_a_candidate", "S1-a|S2-11", "warning")]
    assert [r.offender for r in X.unknown_ids(made, spark.createDataFrame([("S2-9",), ("S3-1",)], "id string")).collect()] == ["S1-a|S2-10"]
    again = spark.createDataFrame([("a", "x", 1), ("a", "y", 5), ("b", None, 2), ("a", "z", 3)], "entity_id string, v string, ordinal long").repartition(4)
    assert {r.entity_id: r.v for r in X.last_of_each(again).collect()} == {"a": "y", "b": None}


@pytest.mark.parametrize(
    "lines, want",
    [
        ([], ["empty_file"]),
        (["", " "], ["empty_file"]),
        (["A\tb", "x\ty"], []),
        (["a,b", "x"], ["comma_separated", "no_tab", "wrong_header"]),
        (["a\tc", "x\ty", "", "z"], ["no_tab", "wrong_header"]),
    ],
)
def test_line_faults(spark, lines, want):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n long, value string")
    found = X.line_faults(df, ("a", "b"))
    assert sorted({r.rule for r in found.collect()}) == want
    assert sorted(r.rule for r in X.examples(found).collect()) == want


def test_report(spark):
    truth = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", []), ("d", ["z"]), ("d", ["z"])], "s1_id string, ids array<string>")
    found = spark.createDataFrame([("a", ["q"], 0), ("a", ["x", "w"], 1), ("c", ["x"], 0), ("e", ["x"], 0)], "s1_id string, got array<string>, ordinal int")
    r = M.report(truth, found).first()
    assert (r.total_ground_truth_entities, r.total_predicted_entities, r.singletons_count, r.singletons_correct, r.non_singletons_count) == (5, 3, 2, 1, 3)
    assert (r.micro_tp, r.micro_fp, r.micro_fn, r.gt_missing_in_predictions, r.extra_predicted_entities) == (1, 1, 3, 3, 1)
    f = 1.25 * 0.5 * 0.5 / (0.25 * 0.5 + 0.5)
    assert r.macro_f05 == pytest.approx((f + 1) / 5) and r.macro_precision == pytest.approx(1.5 / 5) and r.non_singleton_macro_f05 == pytest.approx(f / 3)
    assert r.singleton_accuracy == 0.5 and r.micro_precision == 0.5 and r.micro_recall == 0.25
    empty = M.report(truth.limit(0), found.limit(0)).first()
    assert empty.total_ground_truth_entities == 0 and empty.micro_f05 == 0 and empty.macro_f05 == 0
