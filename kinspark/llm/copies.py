"""Near copies by SimHash anchors, confirmed on their texts: five-word shingles at a similarity of 0.8.

simhash.py links narrow fingerprints that differ in at most two bits. What a SimHash bit
estimates is the angle of two shingle sets, so the similarity of two texts is here the
cosine of their sets of distinct five-word shingles, shared / sqrt(size x size), and they
are linked if it is SIMILAR or more. Such texts differ in some ten bits of 64, which no
such threshold finds. A document therefore has

* a sketch, the SimHash of its distinct five-word shingles in 256 bits: 52 are expected to
  differ at a cosine of 0.8, and pairs that differ in at most LIMIT are candidates;
* VIEWS fingerprints of its distinct words, which differ in few bits between such
  documents. Each is searched by the anchors of simhash.py on its first 46 bits, one step
  beyond the covering radius (ten anchors each), and those that meet compare sketches.

Every candidate is then held against the shingle sets of both texts, so that nothing is
linked by estimate. The search has no guarantee, as ten bits are too many to cover, but a
measured recall (README); a pair has VIEWS chances in either direction. Equal sketches,
which no two texts below the limit share, are merged before. At an anchor a row is paired
with the nearest row of each cluster there, where clusters are what differs in at most
SURE bits, so that large groups of near copies are not paired up one with all.

Anchors with many rows at home are split by simhash.dealt. Sets hold 32 bits a shingle: in
two texts of 20,000 words, 0.1 shingles agree by chance.

Defined results are those of simhash.py: null and blank texts are copies of one another;
a text of fewer than five words is one shingle; repeated rows are kept, each with its
component; an empty table gives an empty result; columns named sketch and component_id
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release
from .simhash import MOST_HOME, WORD_BITS, _typed, anchors_of, components, dealt, homes_of, with_components

SHINGLE = 5
SIMILAR = 0.8
LIMIT = 66
SURE = 58
VIEWS = 10
BEYOND = 1
#: 64-bit words of a sketch.
WIDE = 4
#: Rows that are compared at a time, and the most comparisons at a time.
BLOCK = 512
COMPARED = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -------------------------------------------------------------------- sketches
def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash derived from hashes h: the finaliser of SplitMix64."""
    with np.errstate(over="ignore"):
        z = h + np.uint64(k + 1) * _STEP
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _majority(h: np.ndarray, words: int) -> np.ndarray:
    """The bits, 64 x words, that are set in over half of what is derived from h."""
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, len(h), 8192):
        part = np.stack([_mixed(h[at : at + 8192], k) for k in range(words)], axis=1)
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)


def _hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(h: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of width words in a row, of all words if there are fewer."""
    n = min(width, len(h))
    rolled = np.zeros(len(h) - n + 1 if n else 0, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            rolled = rolled * _STEP + h[k : len(h) - n + 1 + k]
    return np.unique(rolled)


def sketch(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sketch and the views of a text, as WIDE + VIEWS words of 64 bits."""
    h = _hashes(text)
    if not len(h):
        return np.zeros(WIDE + VIEWS, np.uint64)
    return np.concatenate([_majority(shingles(h, width), WIDE), _majority(np.unique(h), VIEWS)])


def _sketches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([sketch(t.as_py()).tobytes() for t in batch], pa.binary())


def with_sketch(docs: DataFrame, text: str = "text", name: str = "sketch") -> DataFrame:
    """docs and sketch, the sketch's 32 bytes and the views' 80."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import BinaryType

    return docs.withColumn(name, arrow_udf(_typed(_sketches), BinaryType())(F.col(text)))


# ---------------------------------------------------------------------- search
def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        raw = b.column(0).to_pylist()
        for at in range(0, len(raw), BLOCK):
            yield np.frombuffer(b"".join(raw[at : at + BLOCK]), np.uint64).reshape(-1, WIDE + VIEWS)


def _place(view: int, anchor: np.ndarray) -> np.ndarray:
    return np.int64(view) << np.int64(2 * WORD_BITS) | anchor


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(spot, s0 to s3): a row for each anchor that a sketch visits in any view. spot is the
    view, the anchor, and 0 at home, where rows come first."""
    for rows in _views(batches):
        for v in range(VIEWS):
            who, anchor, home = anchors_of(np.ascontiguousarray(rows[:, WIDE + v]), BEYOND)
            yield pa.RecordBatch.from_arrays([pa.array(_place(v, anchor) << 1 | ~home), *(pa.array(rows[who, k].view(np.int64)) for k in range(WIDE))], ["spot", *(f"s{k}" for k in range(WIDE))])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _views(batches):
        for v in range(VIEWS):
            yield pa.RecordBatch.from_arrays([pa.array(_place(v, homes_of(np.ascontiguousarray(rows[:, WIDE + v]))))], ["anchor"])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each row of a and each of b."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for k in range(a.shape[1]):
        out += np.bitwise_count(a[:, None, k] ^ b[None, :, k])
    return out


class Cell:
    """What is at home in one cell, and the clusters that rows within SURE bits make. add() yields
    the candidates: of each row, the nearest one of every cluster that it comes within LIMIT of."""

    def __init__(self, limit: int = LIMIT, sure: int = SURE):
        self.limit, self.sure = limit, sure
        self.rows, self.root = np.zeros((0, WIDE), np.uint64), np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at = 0
        while at < len(rows):
            step = max(16, min(BLOCK, COMPARED // max(1, len(self.rows))))
            part, stays = rows[at : at + step], home[at : at + step]
            at += step
            known = len(self.rows)
            own = np.where(stays, known + np.cumsum(stays) - 1, -1)
            self.rows = np.concatenate([self.rows, part[stays]])
            self.root = np.concatenate([self.root, np.arange(known, len(self.rows))])
            hits = []
            for lo in range(0, len(self.rows), BLOCK):
                d = distances(part, self.rows[lo : lo + BLOCK])
                r, c = np.nonzero(d <= self.limit)
                hits.append((r, c + lo, d[r, c]))
            r, c, d = (np.concatenate(x) for x in zip(*hits, strict=True)) if hits else (np.zeros(0, np.int64),) * 3
            first = (own[r] < 0) | (c < own[r])  # of a pair at home, the row that came later
            order = np.flatnonzero(first)
            order = order[np.lexsort((c[order], d[order], r[order]))]
            r, c, d = r[order], c[order], d[order]
            bounds = np.searchsorted(r, np.arange(len(part) + 1))
            for i in np.flatnonzero(np.diff(bounds)):
                there, far = c[bounds[i] : bounds[i + 1]], d[bounds[i] : bounds[i + 1]]
                cluster, nearest = np.unique(self.root[there], return_index=True)
                for k in nearest:
                    yield part[i], self.rows[there[k]]
                near = cluster[far[nearest] <= self.sure]
                if own[i] >= 0:
                    near = np.append(near, self.root[own[i]])
                if len(near) == 2 and own[i] >= 0:
                    self.root[own[i]] = near[0]  # a row alone joins a cluster
                elif len(near) > 1:
                    self.root[np.isin(self.root, near)] = near[0]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) from rows sorted by block and spot. A cell may run on over batches; those with one
    row at home, the most, are compared at once for a whole batch."""
    kind = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    cell, at_cell = Cell(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        spot, block = batch.column(0).to_numpy(), batch.column(WIDE + 1).to_numpy().astype(np.int64)
        place, home = np.stack([block, spot >> 1], axis=1), (spot & 1) == 0
        rows = np.stack([batch.column(k + 1).to_numpy().view(np.uint64) for k in range(WIDE)], axis=1)
        starts = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(place)])
        homes = np.add.reduceat(home.astype(np.int64), starts)
        edge = np.zeros(len(starts), bool)
        edge[-1] = True  # may run on
        edge[0] |= at_cell == tuple(place[0])
        easy = ~edge & (homes == 1) & (sizes > 1)
        found: set[tuple[bytes, bytes]] = set()  # views repeat candidates

        def take(x: np.ndarray, y: np.ndarray) -> None:
            pair = x.tobytes(), y.tobytes()
            if pair[0] != pair[1]:
                found.add((min(pair), max(pair)))

        if easy.any():
            n = sizes[easy]
            first = np.repeat(starts[easy], n)
            other = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            d = np.bitwise_count(rows[first] ^ rows[other]).sum(axis=1, dtype=np.int64)
            for i, j in zip(first[d <= LIMIT], other[d <= LIMIT], strict=True):
                take(rows[i], rows[j])
        for g in np.flatnonzero((homes > 1) | edge):
            if tuple(place[starts[g]]) != at_cell:
                cell, at_cell = Cell(), tuple(place[starts[g]])
            span = slice(starts[g], starts[g] + sizes[g])
            if homes[g] or len(cell.rows):
                for x, y in cell.add(rows[span], home[span]):
                    take(x, y)
                    if len(found) == 1 << 16:
                        yield _pairs(found, kind)
                        found.clear()
        if found:
            yield _pairs(found, kind)


def _pairs(found: set[tuple[bytes, bytes]], kind: pa.Schema) -> pa.RecordBatch:
    a, b = zip(*sorted(found), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=kind)


def candidates_of(distinct: DataFrame, most: int = MOST_HOME) -> DataFrame:
    """(a, b) sketches that the views bring together and that differ in at most LIMIT bits."""
    names = [f"s{k}" for k in range(WIDE)]
    visits = distinct.select("views").mapInArrow(_visits, "spot long, " + ", ".join(f"{n} long" for n in names))
    cells = dealt(visits, distinct.select("views").mapInArrow(_homes, "anchor long"), most).select("spot", *names, "block")
    return cells.repartition(F.shiftright("spot", 1), "block").sortWithinPartitions("block", "spot", *names).mapInArrow(_candidates, "a binary, b binary").distinct()


# --------------------------------------------------------------- confirmation
def _sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([np.unique((shingles(_hashes(t.as_py())) >> np.uint64(32)).astype(np.uint32)).tobytes() for t in batch], pa.binary())


def cosine(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    return float(len(np.intersect1d(x, y, assume_unique=True)) / max(1, len(x) * len(y)) ** 0.5)


def _cosines(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in columns:
        yield pa.array([cosine(a.as_py(), b.as_py()) for a, b in zip(left, right, strict=True)], pa.float64())


_cosines.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts (fp, text: a row for each sketch) are similar. A sketch in very many
    pairs makes a skewed join, which Spark splits as it runs (spark.sql.adaptive.skewJoin)."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import BinaryType, DoubleType

    sets = cut(texts.select("fp", arrow_udf(_typed(_sets), BinaryType())(F.col("text")).alias("set")))
    side = lambda name: sets.select(F.col("fp").alias(name), F.col("set").alias(f"set_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return cut(both.where(arrow_udf(_cosines, DoubleType())("set_a", "set_b") >= SIMILAR).select("a", "b"), done=[sets])


def _key(doc_id: str, text: str) -> Column:
    """Tells rows apart by id and text: copies under other ids have keys of their own, so that none is hot."""
    return F.xxhash64(doc_id, text)


def _apart(docs: DataFrame, doc_id: str, text: str, *left_out: str) -> DataFrame:
    """__doc, the columns of docs in one, so that no name clashes, and __key."""
    return docs.select(F.struct(*[c for c in docs.columns if c not in left_out]).alias("__doc"), _key(doc_id, text).alias("__key"))


def _grouped(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (id, key, bits of the sketch), a row for each sketch (fp, first, first_id, n), and the roots of linked sketches."""
    keyed = docs.select(F.col(doc_id).alias("id"), _key(doc_id, text).alias("key"), F.col(text).alias("text"))
    rows = cut(with_sketch(keyed, "text").select("id", "key", F.substring("sketch", 1, 8 * WIDE).alias("bits"), "sketch"))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    per_sketch = cut(rows.groupBy(F.col("bits").alias("fp")).agg(F.min(first).alias("first"), F.min("id").alias("first_id"), F.min("sketch").alias("views"), F.count("*").alias("n")))
    pairs = cut(candidates_of(per_sketch))
    linked = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    # the text of each sketch in a pair is that of its first row
    stands = cut(per_sketch.join(linked, "fp", "left_semi").select("fp", F.col("first.key").alias("key")))
    # texts go by key at every size: what is small here is not at scale
    texts = keyed.select("key", "text").join(stands.hint("merge"), "key").dropDuplicates(["fp"])
    links = confirmed(pairs, texts)
    release(pairs)
    release(stands)
    return rows, per_sketch, components(links)


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs and component_id, the least doc_id that can be reached by links."""
    rows, per_sketch, roots = _grouped(docs, doc_id, text)
    found = with_components(rows.select("key", "bits").distinct(), per_sketch, roots, "bits").select(F.col("key").alias("__key"), "component_id")
    return _apart(docs, doc_id, text, "component_id").join(found, "__key").select("__doc.*", "component_id")


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: the one of least id (null last), of rows with that id the one of least key, and of rows
    alike in id and text the one whose columns hash least. Rows of one id whose texts are not near copies all stay."""
    rows, per_sketch, roots = _grouped(docs, doc_id, text)
    rooted = per_sketch.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    often = rows.groupBy("key").agg(F.count("*").alias("__n"))
    kept = cut(rooted.select(F.col("first.key").alias("key")).join(often, "key").withColumnRenamed("key", "__key"))
    keyed = _apart(docs, doc_id, text)
    if not kept.where("__n > 1").head(1):
        return keyed.join(kept.select("__key").hint("merge"), "__key", "left_semi").select("__doc.*")
    both = cut(keyed.join(kept.hint("merge"), "__key"))
    alike = both.where("__n > 1").withColumn("__all", F.xxhash64(F.to_json("__doc")))
    least = alike.groupBy("__key").agg(F.min("__all").alias("__all"))
    one = alike.join(least, ["__key", "__all"], "left_semi").dropDuplicates(["__key"])
    return both.where("__n = 1").select("__doc.*").unionByName(one.select("__doc.*"))
