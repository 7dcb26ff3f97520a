"""Probes, the seven features and causes on made-up records."""

import pytest

from kinspark.functions import edit as E
from kinspark.operators import probes as P

RECORD = "entity_id string, business_name string, business_address string, country string"


def test_lookalikes_and_first_come(spark):
    ref = spark.createDataFrame([("S1-a", "Quorlex"), ("S1-b", "tov"), ("S1-c", None)], "s1_id string, name string")
    vendors = spark.createDataFrame([(f"S2-{i}", "QUORum" if i % 2 else "tov", i) for i in range(30)] + [("S3-0", "", 90)], "cid string, name string, ordinal long").repartition(3)
    truth = spark.createDataFrame([("S1-a", f"S2-{i}") for i in (0, 2, 4, 6, 8, 1)] + [("S1-a", "S2-0")], "s1_id string, cid string")
    got = {(r.s1_id, r.cid) for r in P.lookalikes(ref, vendors, truth).collect()}
    # six true ones, and of the first eight of its prefix those that are left, up to twelve in all
    assert got == {("S1-a", f"S2-{i}") for i in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9, 11, 13)} | {("S1-b", f"S2-{i}") for i in range(0, 16, 2)} | {("S1-c", "S3-0")}
    first = P.first_come(vendors.selectExpr("'x' AS s1_id", "cid", "ordinal"), 3).collect()
    assert {r.cid for r in first} == {"S2-0", "S2-1", "S2-2"}


def test_slice_probe(spark):
    side = lambda n, source: spark.createDataFrame([(f"{source}-{i}", k, i) for i in range(n) for k in ("k", "k", f"k{i}")], "entity_id string, key string, ordinal long")
    got = {(r.s1_id, r.cid) for r in P.slice_probe(side(6, "S1"), side(5, "S2"), bucket=4, most=3).collect()}
    assert {(s, c) for s, c in got if s in ("S1-0", "S1-3")} == {(f"S1-{a}", f"S2-{b}") for a in (0, 3) for b in range(3)}
    assert {c for s, c in got if s == "S1-4"} == {"S2-4"} and not [1 for s, _ in got if s == "S1-5"]


@pytest.mark.parametrize(
    "left, right, want",
    [
        (("Ab Cd", "4 Hill"), ("cd ab", "04 hill"), (100.0, 100.0, None, 1 / 3, 1.0, 0.0, 0.0)),
        (("", ""), (None, "nan"), (100.0, None, 1.0, 0.0, 0.0, 1.0, 1.0)),
        (("x", "--"), ("X ", " -- "), (None, None, None, 1.0, 0.0, 1.0, 1.0)),
        (("abc", "12 a b"), ("abd", "13 a b"), (None, None, None, 0.5, 0.0, 0.0, 0.0)),
    ],
)
def test_seven_features(spark, left, right, want):
    records = spark.createDataFrame([("S1-1", *left, "US"), ("S2-1", *right, "US")], RECORD)
    pairs = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cid string")
    r = P.seven_features(pairs, records).first()
    got = (r.name_token_sort_ratio, r.name_token_set_ratio, r.name_jaro_winkler_similarity, r.address_token_jaccard, r.numerical_overlap, r.name_exact_match, r.address_exact_match)
    if left[0] == "Ab Cd":  # words differ by case here
        want = (E.token_sort(left[0], right[0]), E.token_set(left[0], right[0]), *want[2:])
    assert all(w is None or g == pytest.approx(w, abs=1e-6) for g, w in zip(got, want, strict=True))


def test_causes(spark):
    rows = [
        ("S1-1", "quorlex tovin", "4 hill, austin, tx 12345", "US"), ("S2-1", "quorlex tovin", "4 hill, austin, tx 12345", "US"), ("S2-2", "quorlex", "4 hill, 700001", "India"),
        ("S2-3", "tovin quorlex", "9 hill, x, ca", "US"), ("S2-4", "", "", "US"), ("S2-5", "तोविन", "4 hill, austin, tx 54321", "US"), ("S2-6", "zed", "q", "US"),
    ]
    pairs = spark.createDataFrame([("S1-1", f"S2-{i}") for i in range(1, 8)], "s1_id string, cid string")
    got = {}
    for r in P.causes(pairs, spark.createDataFrame(rows, RECORD)).collect():
        got.setdefault(r.cid, set()).add(r.cause)
    assert got == {
        "S2-1": {"bucket_cap"}, "S2-2": {"country_mismatch"}, "S2-3": {"state_mismatch", "one_missing_postal", "name_first_token_mismatch", "name_prefix3_mismatch", "address_completely_different"},
        "S2-4": {"one_missing_state", "one_missing_postal", "missing_name_tokens", "missing_address"}, "S2-5": {"postal_mismatch", "transliteration_variation", "name_prefix3_mismatch"},
        "S2-6": {"one_missing_state", "one_missing_postal", "name_completely_different", "name_prefix3_mismatch", "address_completely_different"}, "S2-7": {"lookup_error"},
    }
