"""Near-duplicate documents by SimHash and anchor-point covering.

Fingerprints that differ in at most two of 64 bits are linked; documents take the
component of their fingerprint. The search is by anchors: the first 46 bits are read as
two words of 23 bits, and the anchors are all pairs of codewords of the binary Golay
code, 2^24 points. That code is perfect with covering radius 3, so a fingerprint lies
within (3, 3) of exactly one anchor, its home. A fingerprint that differs from it in t1
and t2 bits of the two words lies within (3 + t1, 3 + t2) of the same anchor. Each
fingerprint is therefore copied to every anchor within (3 + t1, 3 + t2) for t1 + t2 <= 2
(61 on average, whatever the corpus) and compared there with those at home; no link
within the threshold can be missed. Equal fingerprints are merged before, and an anchor
yields at most two links for each of its rows, so large groups of copies do not multiply.

Defined results: a null or blank text has fingerprint zero and is linked like any other;
repeated rows are kept, each with its component; an empty table gives an empty result;
columns of the input named like those added (simhash, component_id) are replaced; a
component's id is the least non-null doc_id in it, null if all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Generator polynomial of the Golay code of length 23, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
WORD_BITS = 23
RADIUS = 3
THRESHOLD = 2
SHINGLE = 3
#: Rows of one anchor that are compared at a time.
BLOCK = 1024
#: Rows at home at one anchor that a task compares others with; an anchor with more is split.
MOST_HOME = 16_384
#: A fingerprint is hot if more than one of HOT_SHARE rows has it.
HOT_SHARE = 1000
#: Rows of a small table that may be broadcast.
MOST_BROADCAST = 100_000


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the XXH64 values (seed 42) of the word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(width)), strict=False) if len(words) >= width else [words]
    ones, total, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    values: list[int] = []
    for s in shingles:
        values.append(digest(b" ".join(s), 42))
        if len(values) == 1 << 15:
            ones, total, values = ones + _bit_counts(values), total + len(values), []
    if values:
        ones, total = ones + _bit_counts(values), total + len(values)
    return int(((2 * ones > total).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def _bit_counts(values: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        out = np.fromiter((fingerprint(t.as_py()) for t in batch), np.uint64, len(batch))
        yield pa.array(out.view(np.int64))


def with_simhash(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and simhash (bigint, the 64 bits)."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import LongType

    return docs.withColumn("simhash", arrow_udf(_typed(_fingerprints), LongType())(F.col(text)))


def _typed(f):
    """f with the signature by which Spark knows an iterator of arrays."""
    f.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return f


# --------------------------------------------------------------------- anchors
def _syndrome(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint32).copy()
    for bit in range(WORD_BITS - 1, 10, -1):
        v = np.where((v >> np.uint32(bit)) & np.uint32(1), v ^ np.uint32(GOLAY << (bit - 11)), v)
    return v


@lru_cache(maxsize=4)
def _errors(beyond: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the 2048 syndromes, the error patterns of weight up to RADIUS + beyond:
    starts, patterns, and how far each lies beyond the covering radius."""
    from itertools import combinations

    patterns = np.array([sum(1 << b for b in c) for w in range(RADIUS + beyond + 1) for c in combinations(range(WORD_BITS), w)], np.uint32)
    weight = np.array([int(p).bit_count() for p in patterns])
    s = _syndrome(patterns)
    order = np.lexsort((patterns, weight, s))
    return np.searchsorted(s[order], np.arange(2049)), patterns[order], np.maximum(0, weight[order] - RADIUS)


@lru_cache(maxsize=1)
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits; they are linear, so those of a word are their XOR."""
    return _syndrome(np.arange(1 << 12, dtype=np.uint32)), _syndrome(np.arange(1 << 11, dtype=np.uint32) << np.uint32(12))


def _words(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The two code words of each fingerprint, and their syndromes."""
    low, high = _syndromes()
    both = (fps >> np.uint64(k * WORD_BITS) & np.uint64((1 << WORD_BITS) - 1) for k in (0, 1))
    return [(v.astype(np.uint32), low[v & np.uint64(0xFFF)] ^ high[v >> np.uint64(12)]) for v in both]


def anchors_of(fps: np.ndarray, beyond: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor, at home) for every anchor each must visit, at most beyond the covering radius."""
    starts, patterns, extra = _errors(beyond)
    (v1, s1), (v2, s2) = _words(fps)
    n1, n2 = starts[s1 + 1] - starts[s1], starts[s2 + 1] - starts[s2]
    who = np.repeat(np.arange(len(fps)), n1 * n2)
    k = np.arange(len(who)) - np.repeat(np.cumsum(n1 * n2) - n1 * n2, n1 * n2)
    i1, i2 = starts[s1][who] + k // n2[who], starts[s2][who] + k % n2[who]
    near = extra[i1] + extra[i2] <= beyond
    who, i1, i2 = who[near], i1[near], i2[near]
    anchor = ((v1[who] ^ patterns[i1]).astype(np.int64) << WORD_BITS) | (v2[who] ^ patterns[i2]).astype(np.int64)
    return who, anchor, extra[i1] + extra[i2] == 0


def homes_of(fps: np.ndarray) -> np.ndarray:
    """The one anchor within the covering radius of each fingerprint."""
    return anchors_of(fps, 0)[1]


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """spot is the anchor and, as its last bit, 0 at home: home rows come first at their anchor."""
    for b in batches:
        fps = b.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(fps), 256):
            who, anchor, home = anchors_of(part := fps[at : at + 256])
            yield pa.RecordBatch.from_arrays([pa.array(anchor * 2 + ~home), pa.array(part[who].view(np.int64))], ["spot", "fp"])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(homes_of(b.column(0).to_numpy().view(np.uint64)))], ["anchor"])


def dealt(visits: DataFrame, homes: DataFrame, most: int = MOST_HOME) -> DataFrame:
    """visits (spot, ...) and block. An anchor at which more than most rows are at home is
    split into blocks of about most; a row at home stays in the block of its hash and visits
    the others, as every visitor does. No task holds more than a block, and no pair is lost."""
    counted = homes.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most)
    hot = cut(counted.select("anchor", F.ceil(F.col("n") / most).cast("int").alias("blocks")))
    known = hot.count()
    if not known:
        return visits.withColumn("block", F.lit(0))
    keys = [c for c in visits.columns if c != "spot"]
    split = visits.withColumn("anchor", F.shiftright("spot", 1)).join(F.broadcast(hot) if known < MOST_BROADCAST else hot, "anchor", "left")
    n = F.coalesce("blocks", F.lit(1))
    each = split.withColumns({"own": F.pmod(F.xxhash64(*keys), n), "block": F.explode(F.sequence(F.lit(0), n - 1))})
    return each.select(F.when(F.col("block") == F.col("own"), F.col("spot")).otherwise(F.col("spot").bitwiseOR(F.lit(1))).alias("spot"), *keys, "block")


class _Anchor:
    """Who is at home in the cell (block and anchor) being read, joined by a union-find."""

    def __init__(self, cell: tuple):
        self.cell, self.fps, self.up = cell, np.zeros(0, np.uint64), []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def visit(self, fps: np.ndarray, home: np.ndarray) -> list[tuple[int, int]]:
        """Links of the rows fps, in order; those at home stay. Each row yields a link at most."""
        links = []
        for at in range(0, len(fps), BLOCK):
            part, stays = fps[at : at + BLOCK], home[at : at + BLOCK]
            base = len(self.fps)
            self.fps = np.concatenate([self.fps, part[stays]])
            self.up += range(base, len(self.fps))
            first = np.full(len(part), -1)
            own = np.where(stays, base + np.cumsum(stays) - 1, -1)
            for lo in range(0, len(self.fps), BLOCK):
                known = self.fps[lo : lo + BLOCK]
                # a pair counts once: of one home, as its second row arrives; else at the home of its lesser fingerprint
                once = np.where(stays[:, None], lo + np.arange(len(known))[None, :] < own[:, None], known[None, :] < part[:, None])
                hit = (np.bitwise_count(part[:, None] ^ known[None, :]) <= THRESHOLD) & once
                for r in np.flatnonzero(hit.any(axis=1)):
                    found = np.flatnonzero(hit[r]) + lo
                    if first[r] < 0:
                        first[r] = found[0]
                    top = self.root(int(first[r]))
                    for x in found:
                        if (y := self.root(int(x))) != top:
                            self.up[y] = top
            linked = np.flatnonzero(first >= 0)
            links += zip(part[linked].tolist(), self.fps[first[linked]].tolist(), strict=True)
        return links

    def close(self) -> list[tuple[int, int]]:
        """What joins those at home that a row linked."""
        return [(int(self.fps[i]), int(self.fps[r])) for i in range(len(self.up)) if (r := self.root(i)) != i]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and spot; cells may run on over batches. Most hold few rows,
    which are compared at once for a whole batch; the others one by one, in blocks."""

    def packed(links):
        ab = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

    last: _Anchor | None = None
    for b in batches:
        spot, fps, block = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy()
        home, cell = spot % 2 == 0, np.stack([block.astype(np.int64), spot >> 1], axis=1)
        if not len(cell):
            continue
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(cell)]
        homes = np.add.reduceat(home.astype(np.int64), starts)
        links: list[tuple[int, int]] = []
        edge = np.zeros(len(starts), bool)
        edge[-1] = True  # may run on
        edge[0] |= last is not None and last.cell == tuple(cell[0])
        if last is not None and last.cell != tuple(cell[0]):
            links += last.close()
            last = None
        easy = ~edge & (homes == 1) & (ends - starts > 1)
        # one at home: its row against the rest
        if easy.any():
            sizes = (ends - starts)[easy]
            own = np.repeat(fps[starts[easy]], sizes)
            rows = np.arange(len(own)) + np.repeat(starts[easy] - (np.cumsum(sizes) - sizes), sizes)
            hit = (np.bitwise_count(fps[rows] ^ own) <= THRESHOLD) & (own < fps[rows])
            links += zip(fps[rows[hit]].tolist(), own[hit].tolist(), strict=True)
        for g in np.flatnonzero((homes > 1) | edge):
            if last is None or last.cell != tuple(cell[starts[g]]):
                if last is not None:
                    links += last.close()
                last = _Anchor(tuple(cell[starts[g]]))
            if len(last.fps) or homes[g]:
                links += last.visit(fps[starts[g] : ends[g]], home[starts[g] : ends[g]])
        if links:
            yield packed(links)
    if last is not None and (links := last.close()):
        yield packed(links)


def links_of(distinct: DataFrame, most: int = MOST_HOME) -> DataFrame:
    """(a, b) links that span every component of the distinct fingerprints (column fp)."""
    visits = distinct.select("fp").mapInArrow(_visits, "spot long, fp long")
    cells = dealt(visits, distinct.select("fp").mapInArrow(_homes, "anchor long"), most).select("spot", "fp", "block")
    return cells.repartition(F.shiftright("spot", 1), "block").sortWithinPartitions("block", "spot", "fp").mapInArrow(_links, "a long, b long")


# ------------------------------------------------------------------ components
def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (a, b), by alternating large and small stars;
    root is the least node of the component. Stars are min-aggregations and joins, no
    neighbourhood is ever held, and each round is written to the shared folder."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every greater neighbour is tied to the least one
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: lesser neighbours and the node itself are tied to the least one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(small, done=[edges])
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", simhash: str = "simhash") -> DataFrame:
    """docs and component_id, the least doc_id that can be reached by links."""
    per_fp = cut(docs.groupBy(F.col(simhash).alias("fp")).agg(F.min(doc_id).alias("first_id"), F.count("*").alias("n")))
    return with_components(docs, per_fp, components(links_of(per_fp)), simhash)


def with_components(docs: DataFrame, per_fp: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """docs and component_id, from the root of each linked fingerprint. Of the rows (fp, first_id, n) those that stand for
    more than 1 / HOT_SHARE of docs, at most HOT_SHARE, are broadcast: no task gets more rows of one fingerprint."""
    joined = per_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = cut(joined.join(least, "root").select(F.col("fp").alias("__fp"), "component_id", "n"))
    bound = (by_fp.agg(F.sum("n")).first()[0] or 0) / HOT_SHARE
    hot, others = by_fp.where(F.col("n") > bound).drop("n"), by_fp.where(F.col("n") <= bound).drop("n")
    bare = docs.drop("component_id")
    on = F.col(name) == F.col("__fp")
    found = bare.join(F.broadcast(hot), on)
    rest = bare.join(F.broadcast(hot.select("__fp")), on, "left_anti").join(others, on)
    return found.unionByName(rest).drop("__fp")


def op1_simhash(docs: DataFrame) -> DataFrame:
    prints = cut(with_simhash(docs.select("doc_id", "text")).select("doc_id", "simhash"))
    hexed = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return near_duplicates(prints).select("doc_id", hexed.alias("fingerprint"), "component_id")
