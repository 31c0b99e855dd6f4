"""Words and rolling word hashes of whole Arrow batches, in numpy.

Texts stay the UTF-8 bytes that Arrow holds; nothing here is done word by word in Python.
A null text has no words. Hashes are 64-bit and the same on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

#: Byte classes: ASCII white space separates words; digits, letters and all non-ASCII bytes make words.
SPACE_SEPARATED = np.ones(256, bool)
SPACE_SEPARATED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler, so that any bits of a hash can be used."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[int(base)] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch in order. first[d] .. first[d+1] are the words of document d."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """One hash per word, of its bytes."""
        n = len(self.data)
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        terms = self.data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers(_BASE, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        own = sums[self.end] - sums[self.begin]
        own *= powers(_inverse(_BASE), n)[self.begin]
        return mix(own + (self.end - self.begin).astype(np.uint64))


def split(texts: pa.Array, word: np.ndarray = SPACE_SEPARATED, lower: bool = False) -> Words:
    """Maximal runs of word bytes in each text; lower folds A-Z only."""
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, begin, end, np.searchsorted(begin, offsets))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k consecutive words, over the whole batch.

    Entry i covers words i .. i+k-1; the caller drops those that cross a document's end.
    """
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(_STEP, n), out=sums[1:])
    own = sums[k:] - sums[:-k]
    own *= powers(_inverse(_STEP), n)[: n - k + 1]
    return mix(own + np.uint64(k))


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Word numbers at which k words of one document begin."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, np.int64)
    fits = np.ones(n, bool)
    for back in range(1, k):
        at = first[1:] - back
        fits[at[at >= first[:-1]]] = False
    return np.flatnonzero(fits)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n words lie in a span that begins at one of starts."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[d]:first[d+1]]."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[first])


def slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) pieces of about size bytes, so that the work arrays stay small.

    A text is never divided: a longer one makes a piece of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to
