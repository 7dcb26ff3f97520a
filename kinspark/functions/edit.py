"""Edit similarities of pairs of strings, computed in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column


def jaro(a: str, b: str, whole: bool = False) -> float:
    """Jaro similarity; half transpositions count as such unless whole."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, u in zip(b, used, strict=True) if u]
    moved = sum(x != y for x, y in zip(mine, theirs, strict=True)) / 2
    m = len(mine)
    return (m / len(a) + m / len(b) + (m - (moved // 1 if whole else moved)) / m) / 3


def jaro_winkler(a: str, b: str, compatible: bool = False) -> float:
    """Up to four equal letters at the start raise the similarity: always, or (compatible) above 0.7 only,
    with whole transpositions and 0 for an empty string."""
    if compatible and (not a or not b):
        return 1.0 if a == b and a else 0.0
    j = jaro(a, b, whole=compatible)
    if compatible and j <= 0.7:
        return j
    same = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        same += 1
    return j + same * 0.1 * (1 - j)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = row & place.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """200 x common subsequence / both lengths; two empty strings are alike."""
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both, own, other = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not own or not other):
        return 100.0
    joined = [" ".join(filter(None, (both, s))) for s in (own, other)]
    best = indel(*joined)
    return max(best, indel(both, joined[0]), indel(both, joined[1])) if both else best


def pairwise(f, a: Column, b: Column, **options) -> Column:
    """f of two string columns (nulls are empty)."""
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import DoubleType

    def run(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y in pairs:
            yield pa.array([f(s or "", t or "", **options) for s, t in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.float64())

    run.__annotations__ = {"pairs": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return arrow_udf(run, DoubleType())(a, b)
