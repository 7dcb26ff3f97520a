"""Hashed n-grams of many texts at once, as numpy arrays over code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

P = np.uint64(0x9E3779B97F4A7C15)
#: Code points that are laid out in arrays at a time; a longer text is taken alone, whole.
SPAN = 1 << 19


def groups(texts: list[str]) -> Iterator[list[str]]:
    """Lower-cased texts in runs of about SPAN characters, in order."""
    run, size = [], 0
    for t in texts:
        t = t.lower()
        if run and size + len(t) > SPAN:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


class Layout:
    """Code points of a run of texts, where each text lies, and where its words lie."""

    def __init__(self, texts: list[str]):
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.r_[0, self.ends[:-1]].astype(np.int64)
        c = self.codes
        blank = (c == 32) | ((c >= 9) & (c <= 13))
        inner = ~blank
        begins = np.zeros(len(c) + 1, bool)
        begins[self.starts] = True
        first, last = inner.copy(), inner.copy()
        first[1:] &= blank[:-1] | begins[1:-1]
        last[:-1] &= blank[1:] | begins[1:-1]
        self.word_starts, self.word_ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: The words of text i are those from words[i] up to words[i + 1].
        self.words = np.searchsorted(self.word_starts, np.r_[self.starts, self.ends[-1] if len(texts) else 0])

    def grams(self, n: int) -> np.ndarray:
        """A hash at each position of the n code points from there on (across ends too: see totals)."""
        h = self.codes.copy()
        for k in range(1, n):
            h = h[:-1] * P + self.codes[k:]
        return h

    def word_hashes(self) -> np.ndarray:
        c = self.codes
        power = np.full(len(c) + 1, P)
        power[0] = 1
        power = np.multiply.accumulate(power)
        back = np.full(len(c) + 1, np.uint64(pow(int(P), -1, 1 << 64)))
        back[0] = 1
        back = np.multiply.accumulate(back)
        sums = np.r_[np.uint64(0), np.cumsum((c + np.uint64(1)) * power[:-1])]
        return (sums[self.word_ends] - sums[self.word_starts]) * back[self.word_starts]

    def spans(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the positions at which its n-grams begin: from, up to."""
        return self.starts, np.maximum(self.starts, self.ends - n + 1)


def bucket(hashes: np.ndarray, bits: int, kind: int) -> np.ndarray:
    """The hash bucket of each; kind keeps sorts of n-grams apart."""
    with np.errstate(over="ignore"):
        return ((hashes + np.uint64(kind)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int64)


def totals(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of values[lo[i]:hi[i]]."""
    sums = np.r_[np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)]
    return sums[np.minimum(hi, len(values))] - sums[np.minimum(lo, len(values))]
