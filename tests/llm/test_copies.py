import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinspark.llm import copies as C


def components(ids, linked):
    """id -> least id of its component; linked(a, b) of any two."""
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(a, b):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def plain_groups(rows):
    """(id, text) -> id -> least id of its component, by the cosines of all pairs."""
    sets = {d: plain_set(t) for d, t in rows}
    return components(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * (len(sets[a]) * len(sets[b])) ** 0.5)


def flipped(rng, sketch, bits):
    out = sketch.copy()
    for b in rng.sample(range(256), bits):
        out[b // 64] ^= np.uint64(1 << (b % 64))
    return out


def changed(rng, words, share):
    return [f"z{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_sketch_is_the_majority_of_distinct_shingles():
    text = "a B c d e f g " * 3
    words = text.lower().split()
    h = np.array([C.xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    rolled = set()
    for i in range(len(words) - 4):
        x = 0
        for v in h[i : i + 5]:
            x = (x * int(C._STEP) + int(v)) % 2**64
        rolled.add(x)
    for k in range(C.WIDE):
        mixed = [int(C._mixed(np.array([x], np.uint64), k)[0]) for x in rolled]
        want = sum(1 << b for b in range(64) if 2 * sum(m >> b & 1 for m in mixed) > len(mixed))
        assert int(C.sketch(text)[k]) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_a_cell_joins_what_all_pairs_join(seed):
    rng = random.Random(seed)
    centre = np.array([rng.getrandbits(64) for _ in range(C.WIDE)], np.uint64)
    rows = [flipped(rng, centre, rng.choice([5, 20, 40, 90])) for _ in range(150)]
    for _ in range(60):  # a chain that leaves the centre
        centre = flipped(rng, centre, 55)
        rows.append(centre)
    rng.shuffle(rows)
    cell = C.Cell()
    found = [(a.tobytes(), b.tobytes()) for lo in range(0, len(rows), 50) for a, b in cell.add(np.stack(rows[lo : lo + 50]), np.ones(50, bool)[: len(rows) - lo])]
    far = lambda a, b: (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()
    assert all(far(a, b) <= C.LIMIT for a, b in found)
    assert len(found) < 12 * len(rows)
    keys = sorted(r.tobytes() for r in rows)
    pairs = {frozenset(x) for x in found}
    assert components(keys, lambda a, b: frozenset((a, b)) in pairs) == components(keys, lambda a, b: far(a, b) <= C.LIMIT)


@pytest.mark.parametrize("homes", [2, 30])
def test_a_cell_joins_visitors_of_its_first_block(homes):
    rng = random.Random(homes)
    word = lambda: np.array([rng.getrandbits(64) for _ in range(C.WIDE)], np.uint64)
    at_home = [word() for _ in range(homes)]
    visitors = [flipped(rng, x, 20) for x in at_home] + [word() for _ in range(20)]
    rows, home = np.stack(at_home + visitors), np.arange(homes + len(visitors)) < homes
    want = {frozenset((v.tobytes(), x.tobytes())) for v, x in zip(visitors[:homes], at_home, strict=True)}
    assert {frozenset((a.tobytes(), b.tobytes())) for a, b in C.Cell().add(rows, home)} == want
    spot = pa.array(np.where(home, 14, 15))  # as batches of their own, which may run on
    for cut in (1, homes, homes + 3):
        batch = pa.RecordBatch.from_arrays([spot, *(pa.array(rows[:, k].view(np.int64)) for k in range(C.WIDE)), pa.array(np.zeros(len(rows), np.int32))], ["spot", "s0", "s1", "s2", "s3", "block"])
        assert {frozenset(r.values()) for b in C._candidates(iter([batch[:cut], batch[cut:]])) for r in b.to_pylist()} == want


def test_a_split_anchor_gives_the_same_components(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = [(i, " ".join(changed(rng, base, 0.01))) for i in range(120)]
    docs = C.with_sketch(spark.createDataFrame(rows, "doc_id long, text string")).select(F.substring("sketch", 1, 32).alias("fp"), F.col("sketch").alias("views")).dropDuplicates(["fp"]).cache()
    ids = sorted(bytes(r.fp) for r in docs.collect())
    whole, split = ({frozenset((bytes(r.a), bytes(r.b))) for r in C.candidates_of(docs, most=m).collect()} for m in (10**6, 7))
    far = lambda a, b: (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()
    assert all(far(*x) <= C.LIMIT for x in split)
    assert components(ids, lambda a, b: frozenset((a, b)) in split) == components(ids, lambda a, b: frozenset((a, b)) in whole)


def test_finds_near_copies_and_leaves_others(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(120, 600))]
        rows += [(g * 10, " ".join(words)), (g * 10 + 1, " ".join(changed(rng, words, 0.012))), (g * 10 + 2, " ".join(words).upper()), (g * 10 + 3, " ".join(changed(rng, words, 0.3)))]
    got = {r.doc_id: r.component_id for r in C.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == plain_groups(rows)
    assert all(got[g * 10 + 3] == g * 10 + 3 for g in range(60))


def test_all_pairs_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.component_id for r in C.near_copies(docs).collect()}
    want = plain_groups(rows)
    joined = [d for d in want if want[d] != d]
    assert sum(got[d] != want[d] for d in joined) <= 0.05 * len(joined)
    assert all(got[d] == d for d in want if want[d] == d)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, " \t", "z"), (4, "A b", "q"), (4, "a B", "q"), (None, "w " * 20000, "r"), (6, "one", None), (4, "something else", "q"), (6, "one", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = C.near_copies(df).collect()
    assert len(got) == 9
    by = {(r.doc_id, r.text): r.component_id for r in got}
    assert by[1, None] == by[2, ""] == by[3, " \t"] == 1 and by[4, "A b"] == by[4, "a B"] == 4 and by[6, "one"] == 6
    assert C.near_copies(df.limit(0)).count() == C.first_of_each(df.limit(0)).count() == 0
    # one of each group; two texts of one id that differ both stay, a repeated row does not
    first = [(r.doc_id, r.text) for r in C.first_of_each(df).collect()]
    assert len(first) == 5 and (1, None) in first and (4, "something else") in first and (6, "one") in first
    assert C.first_of_each(df).columns == df.columns
