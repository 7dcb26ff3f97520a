"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are sequences of lower-cased words. Windows of SEED words are
hashed with the Karp-Rabin rolling hash; an item is a candidate for a document if the
windows that both have could cover enough of it. A candidate is tiled: the longest match
whose words are all unmarked is marked in both texts, again and again. Matches are found by
running Karp-Rabin: windows of the item's length are joined first, then of half of it, and
so on down to SEED words, each time among what is still unmarked only, so that all matches
of a length are marked before shorter ones are looked for. A match is listed once, where it
begins, and its length is found by prefix hashes, so texts that repeat themselves do not
multiply. An item whose marked words are at least COVERAGE of it contaminates the document,
in whatever order its passages come.

Items are sent to tasks in blocks of at most about BLOCK_CHARS characters, each of which
is held against all documents; with more than one block the result is written after each,
so that driver and workers hold one at a time, for any benchmark. Whole texts are read, in
one pass for each block, without a shuffle.

Defined results: null and blank texts have no match; an item without words is never
found; one of fewer than SEED words only as a whole; repeated rows of either table are
treated alike (an item's rows of one id are items of their own); an empty benchmark
contaminates nothing; the added column replaces one of its name.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import cut

SEED = 5
COVERAGE = 0.5
BLOCK_CHARS = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
_WORDS = re.compile(r"\w+")
_BITS = 22
#: Characters of documents that are tokenised at a time; a longer text is taken alone, whole.
SPAN = 1 << 20


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """The Karp-Rabin hash of every window of n ids."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        h = h * BASE + ids[k : len(ids) - n + 1 + k]
    return h


@dataclass(frozen=True)
class Tile:
    doc_at: int
    item_at: int
    length: int


class _Hashes:
    """Hashes of any stretch of a sequence, from those of its prefixes. Those of two sequences compare if size is the same."""

    def __init__(self, ids: np.ndarray, size: int):
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, BASE)])
            self.sums = np.r_[np.uint64(0), np.cumsum(ids * self.power[: len(ids)])]

    def of(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[at + length] - self.sums[at]) * self.power[len(self.power) - 1 - at]


def _free_runs(free: np.ndarray) -> np.ndarray:
    """How many unmarked words there are from each place on."""
    taken = np.flatnonzero(np.r_[~free, True])
    return taken[np.searchsorted(taken, np.arange(len(free)))] - np.arange(len(free))


def _matches(doc: np.ndarray, item: np.ndarray, free: tuple[np.ndarray, np.ndarray], hashes: tuple[_Hashes, _Hashes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal matches of at least width among unmarked words: document places, item places, lengths."""
    runs = [_free_runs(f) for f in free]
    at, there = (np.flatnonzero(r >= width) for r in runs)
    none = np.zeros(0, np.int64)
    if not len(at) or not len(there):
        return none, none, none
    # what stands before a window, if unmarked: a match begins where that differs
    before = [np.r_[np.uint64(0), np.where(f[:-1], x[:-1] + np.uint64(1), np.uint64(0))] for x, f in ((doc, free[0]), (item, free[1]))]
    found, rank = np.unique(hashes[1].of(there, width), return_inverse=True)
    own = hashes[0].of(at, width)
    mine = np.minimum(np.searchsorted(found, own), len(found) - 1)
    hit = found[mine] == own
    at, mine = at[hit], mine[hit]
    span = int(max(before[0].max(initial=0), before[1].max(initial=0))) + 1
    key = rank.astype(np.int64) * span + before[1][there].astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, there = key[order], there[order]
    prior = before[0][at].astype(np.int64)
    lo, hi = np.searchsorted(key, mine * span), np.searchsorted(key, (mine + 1) * span)
    # equal words before both: the match began earlier
    skip, upto = np.searchsorted(key, mine * span + prior), np.searchsorted(key, mine * span + prior, side="right")
    skip, upto = np.where(prior > 0, skip, hi), np.where(prior > 0, upto, hi)
    first, last = skip - lo, hi - upto
    n = first + last
    i = np.repeat(at, n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    j = there[np.where(k < np.repeat(first, n), np.repeat(lo, n) + k, np.repeat(upto, n) + k - np.repeat(first, n))]
    # the length, by bisection: at least width, at most the unmarked words
    least, most = np.full(len(i), width), np.minimum(runs[0][i], runs[1][j])
    while (open_ := least < most).any():
        middle = (least + most + 1) // 2
        same = hashes[0].of(i, middle) == hashes[1].of(j, middle)
        least, most = np.where(open_ & same, middle, least), np.where(open_ & ~same, middle - 1, most)
    return i, j, least


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[Tile]:
    """Greedy tiling of the words (as numbers above 0) of an item with those of a document."""
    doc, item = doc.astype(np.uint64), item.astype(np.uint64)
    size = max(len(doc), len(item))
    free, hashes = (np.ones(len(doc), bool), np.ones(len(item), bool)), (_Hashes(doc, size), _Hashes(item, size))
    tiles: list[Tile] = []
    width = max(least, min(len(item), len(doc)))
    while True:
        i, j, n = _matches(doc, item, free, hashes, width)
        heap = list(zip((-n).tolist(), j.tolist(), i.tolist(), strict=True))
        heapq.heapify(heap)
        while heap:
            n, j, i = heapq.heappop(heap)
            ok = free[0][i : i - n] & free[1][j : j - n]
            if ok.all():
                if (doc[i : i - n] == item[j : j - n]).all():
                    tiles.append(Tile(i, j, -n))
                    free[0][i : i - n] = free[1][j : j - n] = False
                    if _free_runs(free[1]).max(initial=0) < width:
                        break
            elif ok.any():
                edges = np.flatnonzero(np.diff(np.r_[False, ok, False]))
                for a, b in edges.reshape(-1, 2).tolist():
                    if b - a >= width:
                        heapq.heappush(heap, (a - b, j + a, i + a))
        if width == least:
            return tiles
        width = max(least, width // 2)


class Benchmark:
    """The seeds of a block of items."""

    def __init__(self, items: list[tuple[int, str | None]], seed: int = SEED, coverage: float = COVERAGE):
        self.coverage, self.seed = coverage, seed
        texts = [(i, words_of(t)) for i, t in items]
        self.ids = [i for i, w in texts if w]
        texts = [w for _, w in texts if w]
        self.vocabulary = {w: n + 1 for n, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        self.items = [np.array([self.vocabulary[w] for w in t], np.uint64) for t in texts]
        #: By window width (SEED, or the whole of a shorter item): distinct hashes, where the items and places of each begin, and these.
        self.seeds = {}
        for width in sorted({min(seed, len(t)) for t in self.items}):
            own = [(h, k) for k, t in enumerate(self.items) if min(seed, len(t)) == width for h in [rolling(t, width)]]
            hashes = np.concatenate([h for h, _ in own])
            owner = np.concatenate([np.full(len(h), k) for h, k in own])
            place = np.concatenate([np.arange(len(h)) for h, _ in own])
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << _BITS, bool)
            seen[hashes >> np.uint64(64 - _BITS)] = True
            distinct, starts = np.unique(hashes[order], return_index=True)
            self.seeds[width] = distinct, np.r_[starts, len(hashes)], owner[order], place[order], seen

    def find(self, texts: list[str | None]) -> list[list[dict]]:
        out, run, size = [], [], 0
        for t in texts:
            t = t or ""
            if run and size + len(t) > SPAN:
                out += self._run(run)
                run, size = [], 0
            run.append(t)
            size += len(t)
        return out + (self._run(run) if run else [])

    def _run(self, texts: list[str]) -> list[list[dict]]:
        if not self.items:
            return [[] for _ in texts]
        get, flat, starts = self.vocabulary.get, [], [0]
        for t in texts:
            flat += [get(w, 0) for w in _WORDS.findall(t.lower())]
            flat.append(0)  # in no item, so no window of two texts is a seed
            starts.append(len(flat))
        ids, starts = np.array(flat, np.uint64), np.array(starts)
        out: list[list[dict]] = [[] for _ in texts]
        for d, k in sorted(x for width in self.seeds for x in self._candidates(ids, starts, width)):
            item, doc = self.items[k], ids[starts[d] : starts[d + 1] - 1]
            found = tile(np.where(doc == 0, np.uint64(len(self.vocabulary) + 1), doc), item, min(self.seed, len(item)))
            share = sum(t.length for t in found) / len(item)
            if share >= self.coverage:
                tiles = [{"doc_at": t.doc_at, "item_at": t.item_at, "length": t.length} for t in sorted(found, key=lambda t: t.doc_at)]
                out[d].append({"item_id": self.ids[k], "coverage": share, "tiles": tiles})
        return out

    def _candidates(self, ids: np.ndarray, starts: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
        """(document, item) where the item's windows that the document has could cover enough of it.
        Each distinct window of a document counts once, however often it is there."""
        distinct, first, owner, place, seen = self.seeds[width]
        h = rolling(ids, width)
        at = np.flatnonzero(seen[h >> np.uint64(64 - _BITS)])
        rank = np.minimum(np.searchsorted(distinct, h[at]), len(distinct) - 1)
        at, rank = at[distinct[rank] == h[at]], rank[distinct[rank] == h[at]]
        doc, rank = np.divmod(np.unique((np.searchsorted(starts, at, side="right") - 1) * len(distinct) + rank), len(distinct))
        n = first[rank + 1] - first[rank]
        entry = np.repeat(first[rank], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        doc, item, at = np.repeat(doc, n), owner[entry], place[entry]
        order = np.lexsort((at, item, doc))
        doc, item, at = doc[order], item[order], at[order]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])] if len(doc) else np.zeros(0, bool)
        # words that the windows cover: each adds those beyond the window before it
        add = np.where(new, width, np.minimum(width, np.diff(at, prepend=0)))
        begin = np.flatnonzero(new)
        for b, covered in zip(begin.tolist(), np.add.reduceat(add, begin).tolist() if len(begin) else [], strict=True):
            if covered >= self.coverage * len(self.items[item[b]]):
                yield int(doc[b]), int(item[b])


_TILE = StructType([StructField("doc_at", IntegerType()), StructField("item_at", IntegerType()), StructField("length", IntegerType())])
FOUND = ArrayType(StructType([StructField("item_id", LongType()), StructField("coverage", DoubleType()), StructField("tiles", ArrayType(_TILE))]))
_TILE_ARROW = pa.struct([("doc_at", pa.int32()), ("item_at", pa.int32()), ("length", pa.int32())])
_FOUND_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(_TILE_ARROW))]))


def _column(shared, text: Column) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf

    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(shared.value.find(batch.to_pylist()), _FOUND_ARROW)

    find.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(find, FOUND)(text)


def blocks(benchmark: DataFrame, most: int = BLOCK_CHARS) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """The number of blocks, and the items of each, of about most characters in all."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-2 * total // most) if total > most else 1

    def block(k: int) -> list[tuple[int, str]]:
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        return [(r["item_id"], r["text"]) for r in part.select("item_id", "text").orderBy("item_id", "text").collect()]

    return n, (block(k) for k in range(n))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "contamination", most: int = BLOCK_CHARS) -> DataFrame:
    """docs and contamination: an array of item_id, coverage and tiles, empty for clean documents."""
    n, each = blocks(benchmark, most)
    out, so_far = docs.drop(name), None
    for items in each:
        shared = docs.sparkSession.sparkContext.broadcast(Benchmark(items))  # at most about BLOCK_CHARS of items
        found = _column(shared, F.col(text))
        out = out.withColumn(name, F.concat(name, found) if so_far else found)
        if n > 1:
            out = so_far = cut(out, done=[so_far] if so_far else [])
            shared.destroy()
    return out


def op9_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that contaminates it."""
    found = contaminated(documents.select("doc_id", "text"), benchmark)
    rows = found.select("doc_id", F.explode("contamination").alias("c"))
    return rows.select("doc_id", "c.item_id", F.col("c.coverage").alias("coverage"), F.size("c.tiles").alias("n_tiles"))
