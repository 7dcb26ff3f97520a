import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from kinspark.llm import simhash as S


def plain_print(text):
    words = (text or "").encode().lower().split()
    sh = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """(id, fingerprint) -> id -> least id of its component."""
    prints = sorted({f for _, f in rows})
    up = {f: f for f in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                up[root(a)] = root(b)
    low = {}
    for d, f in rows:
        low[root(f)] = min(low.get(root(f), d), d)
    return {d: low[root(f)] for d, f in rows}


def test_hash_is_the_one_of_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_every_fingerprint_has_one_home_and_meets_all_near_ones():
    rng = random.Random(1)
    for _ in range(40):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 2)):
            y ^= 1 << b
        who, anchor, home = S.anchors_of(np.array([x, y], np.uint64))
        assert home[who == 0].sum() == home[who == 1].sum() == 1
        assert anchor[(who == 0) & home][0] in anchor[who == 1]


def test_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in S.op1_simhash(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {d: plain_print(t) for d, t in texts.items()}
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == prints
    assert {d: r.component_id for d, r in got.items()} == brute(list(prints.items()))


@pytest.mark.parametrize("cut", [2, 3, 5])
def test_pairs_of_one_home_meet_over_blocks_and_batches(monkeypatch, cut):
    monkeypatch.setattr(S, "BLOCK", 2)
    home = np.array([x | top << 63 for x in (0, 1 << 50 | 7 << 55, 5 << 47 | 3 << 59) for top in (0, 1)], np.uint64)
    fps = np.sort(home.view(np.int64))  # the greater of each pair comes first
    column = lambda x: pa.array(np.full(len(x), 0))
    batches = [pa.RecordBatch.from_arrays([column(x), pa.array(x), column(x)], ["spot", "fp", "block"]) for x in (fps[:cut], fps[cut:])]
    found = {frozenset(x % 2**64 for x in r.values()) for b in S._links(iter(batches)) for r in b.to_pylist()}
    assert found == {frozenset((int(x), int(x) ^ 1 << 63)) for x in home}


def test_chains_and_a_large_group(spark):
    rng = random.Random(5)
    rows, x = [], rng.getrandbits(64)
    for i in range(400):  # a chain, and many within two bits of one another
        rows.append((i, x))
        x ^= 1 << rng.randrange(64 if i < 200 else 6)
    rows += [(1000 + i, rng.getrandbits(64)) for i in range(200)] + [(2000, rows[3][1])]
    signed = [(d, f - 2**64 if f >= 2**63 else f) for d, f in rows]
    df = spark.createDataFrame(signed, "doc_id long, simhash long").repartition(3)
    assert {r.doc_id: r.component_id for r in S.near_duplicates(df).collect()} == brute(rows)


def test_a_split_anchor_and_a_hot_fingerprint_give_the_same_components(spark, monkeypatch):
    rng = random.Random(6)
    x = rng.getrandbits(63)
    prints = sorted({x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)} | {x})
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in prints]
    links = [(r.a % 2**64, r.b % 2**64) for r in S.links_of(spark.createDataFrame(signed, "fp long"), most=5).collect()]
    assert links and all(a != b for a, b in links)
    rows = [(i, f) for i, f in enumerate(prints)] + [(1000 + i, x) for i in range(50)]
    monkeypatch.setattr(S, "HOT_SHARE", 5)
    real = S.links_of
    monkeypatch.setattr(S, "links_of", lambda d: real(d, most=5))
    df = spark.createDataFrame([(d, f - 2**64 if f >= 2**63 else f) for d, f in rows], "doc_id long, simhash long")
    assert {r.doc_id: r.component_id for r in S.near_duplicates(df).collect()} == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, " \t", "z"), (4, "A b", "q"), (4, "a B", "q"), (None, "w " * 20000, "r"), (6, "one", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, simhash string")
    got = S.near_duplicates(S.with_simhash(df)).collect()
    assert len(got) == 7
    by = {(r.doc_id, r.text): r.component_id for r in got}
    assert by[1, None] == by[2, ""] == by[3, " \t"] == 1 and by[4, "A b"] == by[4, "a B"] == 4
    assert S.op1_simhash(df.limit(0)).count() == 0
