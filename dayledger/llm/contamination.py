"""Benchmark decontamination with a generalised suffix automaton.

All test items, as word numbers, go into one suffix automaton. Training words are streamed
through it; its state always stands for the longest run of words up to here that occurs in
some item. Where that run reaches the window length, the window's words are hit, and the
state tells which items hold it.

Runs that cannot reach the shortest window are skipped in numpy before streaming: a match of
two or more words needs each of its word pairs to be a pair of some item.

Items are taken in blocks of at most `block_words` words (or one item), each with an automaton
of its own that is broadcast; a larger benchmark makes more blocks, not larger broadcasts.

Defined results: null or empty texts have no words and are not contaminated; items without
words occur nowhere; an item shorter than the window is one window; items that share an id
count once; an empty benchmark hits nothing.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W

WINDOW = 10
BLOCK_WORDS = 50_000
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_HITS = {"n_words": pa.int64(), "longest": pa.int64(), "items": pa.list_(pa.string()), "spans": _SPANS}
_HITS_DDL = "struct<n_words:bigint,longest:bigint,items:array<string>,spans:array<struct<start:int,stop:int>>>"
_TABLE_BITS = 20


def split(texts: pa.Array) -> W.Words:
    return W.split(texts, W.ALPHANUMERIC, lower=True)


class Automaton:
    """Suffix automaton of word sequences; state 0 is the empty run."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            last = self._append(last, word)

    def _append(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._exact(last, word)
        new = self._state({}, 0, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        self.link[new] = self._exact(at, word) if at >= 0 else 0
        return new

    def _exact(self, at: int, word: int) -> int:
        """The state for exactly one word more than `at`; splits a state that also stands for longer runs."""
        target = self.step[at][word]
        if self.length[target] == self.length[at] + 1:
            return target
        short = self._state(dict(self.step[target]), self.link[target], self.length[at] + 1)
        self.link[target] = short
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = short
            at = self.link[at]
        return short

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def stream(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest run that ends here and occurs in an item), word by word."""
        at = length = 0
        for word in sequence:
            while at and word not in self.step[at]:
                at = self.link[at]
                length = self.length[at]
            if word in self.step[at]:
                at = self.step[at][word]
                length += 1
            yield at, length


@dataclass
class Index:
    """An automaton with the items of each window and the tables for skipping."""

    window: int = WINDOW
    automaton: Automaton = field(default_factory=Automaton)
    numbers: dict[int, int] = field(default_factory=dict)
    items: dict[int, set[str]] = field(default_factory=lambda: defaultdict(set))
    whole: dict[int, dict[int, set[str]]] = field(default_factory=dict)
    least: int = WINDOW
    pairs: np.ndarray | None = None
    singles: np.ndarray | None = None

    @classmethod
    def build(cls, ids: list[str], texts: list[str | None], window: int = WINDOW) -> Index:
        index = cls(window)
        words = split(pa.array(texts, pa.large_string()))
        hashes = words.hashes()
        sequences = []
        for item, a, b in zip(ids, words.first[:-1], words.first[1:], strict=True):
            if b > a:
                numbers = [index.numbers.setdefault(h, len(index.numbers)) for h in hashes[a:b].tolist()]
                sequences.append((item, numbers))
                index.automaton.add(numbers)
        for item, numbers in sequences:
            for at, length in index.automaton.stream(numbers):
                if length >= window:
                    index.items[index._cut(at)].add(item)
            if len(numbers) < window:
                index.whole.setdefault(at, {}).setdefault(length, set()).add(item)
        index.least = min([window, *(len(numbers) for _, numbers in sequences)])
        inside = words.doc[:-1] == words.doc[1:] if len(hashes) else np.zeros(0, bool)
        index.pairs = np.unique(W.rolling(hashes, 2)[inside])
        alone = np.flatnonzero(words.counts == 1)
        index.singles = np.unique(hashes[words.first[alone]])
        return index

    def _cut(self, at: int) -> int:
        """The state that stands for the last `window` words of at's runs."""
        link, length = self.automaton.link, self.automaton.length
        while length[link[at]] >= self.window:
            at = link[at]
        return at

    def hits(self, sequence: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, words, items) of each window that ends somewhere in a run of word numbers."""
        for last, (at, length) in enumerate(self.automaton.stream(sequence)):
            if length >= self.window:
                yield last + 1 - self.window, self.window, self.items[self._cut(at)]
            while self.whole and at > 0:
                for n, items in self.whole.get(at, {}).items():
                    if n <= length:
                        yield last + 1 - n, n, items
                at = self.automaton.link[at]

    def runs(self, words: W.Words, hashes: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges that can hold a window: every neighbouring pair is a pair of some item."""
        n = len(hashes)
        if not n or not self.numbers:
            return []
        joined = np.zeros(n + 1, bool)  # word i goes on from word i - 1
        joined[1:n] = _among(W.rolling(hashes, 2), self.pairs) if n > 1 else False
        joined[words.first] = False
        inside = joined[:-1] | joined[1:]
        if self.least == 1:
            inside |= _among(hashes, self.singles)
        begin = np.flatnonzero(inside & ~joined[:-1])
        end = np.flatnonzero(inside & ~joined[1:]) + 1
        long = end - begin >= self.least
        return list(zip(begin[long].tolist(), end[long].tolist(), strict=True))


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are known: a small table on some of the bits first, then exactly."""
    table = np.zeros(1 << _TABLE_BITS, bool)
    shift = np.uint64(64 - _TABLE_BITS)
    table[known >> shift] = True
    found = table[keys >> shift]
    at = np.flatnonzero(found)
    found[at] = np.isin(keys[at], known)
    return found


@dataclass
class Hit:
    """What one document shares with the items; spans are word ranges that do not touch."""

    items: set[str] = field(default_factory=set)
    ranges: list[tuple[int, int]] = field(default_factory=list)

    def spans(self) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for a, b in sorted(self.ranges):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out


def find(indexes: Iterable[Index], texts: pa.Array) -> tuple[W.Words, dict[int, Hit]]:
    """The words of texts, and the hits of all indexes together by row."""
    words = split(texts)
    hashes = words.hashes()
    found: dict[int, Hit] = {}
    for index in indexes:
        for a, b in index.runs(words, hashes):
            numbers = [index.numbers[h] for h in hashes[a:b].tolist()]
            d = int(np.searchsorted(words.first, a, "right")) - 1
            base = a - int(words.first[d])
            for start, n, items in index.hits(numbers):
                hit = found.setdefault(d, Hit())
                hit.items |= items
                hit.ranges.append((base + start, base + start + n))
    return words, found


def build_indexes(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Index]:
    """One index for each block of items, read from the cluster a part at a time."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        n = int(split(pa.array([row[1]], pa.large_string())).first[-1])
        if ids and size + n > block_words:
            yield Index.build(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += n
    yield Index.build(ids, texts, window)


def _hits_udf(index: Broadcast):
    @F.arrow_udf(_HITS_DDL)
    def hits(texts: pa.Array) -> pa.Array:
        columns: dict[str, list] = {name: [] for name in _HITS}
        for _, part in W.slices(texts):
            words, found = find([index.value], part)
            spans = [found[d].spans() if d in found else [] for d in range(len(part))]
            columns["n_words"] += words.counts.tolist()
            columns["items"] += [sorted(found[d].items - {None}) if d in found else [] for d in range(len(part))]
            columns["longest"] += [max((b - a for a, b in x), default=0) for x in spans]
            columns["spans"] += [[{"start": a, "stop": b} for a, b in x] for x in spans]
        return pa.StructArray.from_arrays([pa.array(columns[n], t) for n, t in _HITS.items()], names=list(_HITS))

    return hits


def _merged(spans: Column) -> Column:
    """Ranges that overlap or touch made one, in order."""
    none = F.lit([]).cast("array<struct<start:int,stop:int>>")
    last = lambda done: F.element_at(done, -1)
    return F.aggregate(
        F.array_sort(spans),
        none,
        lambda done, x: F.when((F.size(done) == 0) | (x["start"] > F.try_element_at(done, F.lit(-1))["stop"]), F.concat(done, F.array(x))).otherwise(
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["stop"], x["stop"]).alias("stop"))),
            )
        ),
    )


def find_contamination(docs: DataFrame, items: DataFrame, text: str = "text", out: str = "hits", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Append a struct column `out`: n_words, n_hit, items (ids in order), longest hit span, spans of words."""
    spark = docs.sparkSession
    parts = []
    for k, index in enumerate(build_indexes(items, text=text, window=window, block_words=block_words)):
        parts.append(f"__hits_{k}")
        docs = docs.withColumn(parts[-1], _hits_udf(spark.sparkContext.broadcast(index))(F.col(text)))
    each = [F.col(p) for p in parts]
    spans = each[0]["spans"] if len(each) == 1 else _merged(F.concat(*(c["spans"] for c in each)))
    names = each[0]["items"] if len(each) == 1 else F.array_sort(F.array_distinct(F.concat(*(c["items"] for c in each))))
    size = lambda x: (x["stop"] - x["start"]).cast("long")
    found = F.struct(
        each[0]["n_words"].alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + size(x)).alias("n_hit"),
        F.coalesce(F.array_max(F.transform(spans, size)), F.lit(0).cast("long")).alias("longest"),
        names.alias("items"),
        spans.alias("spans"),
    )
    return docs.withColumn(out, found).drop(*parts)


def _cut_udf(indexes: list[Broadcast], max_words: int):
    """The share of hit words, and the text without its hit spans longer than max_words, until none is left."""

    @F.arrow_udf("struct<share:double,text:string>")
    def cut(texts: pa.Array) -> pa.Array:
        out, shares = [], np.zeros(len(texts))
        blocks = [index.value for index in indexes]
        for at, part in W.slices(texts):
            own = part.to_pylist()
            words, hits = find(blocks, part)
            for d, hit in hits.items():
                shares[at + d] = sum(b - a for a, b in hit.spans()) / words.counts[d]
                while True:
                    words_now, found = find(blocks, pa.array([own[d]], pa.large_string()))
                    long = [(a, b) for a, b in found[0].spans() if b - a > max_words] if found else []
                    if not long:
                        break
                    raw, start, kept = own[d].encode(), 0, []
                    for a, b in long:
                        kept.append(raw[start : words_now.begin[a]])
                        start = words_now.end[b - 1]
                    own[d] = b" ".join([*kept, raw[start:]]).decode()
            out += own
        return pa.StructArray.from_arrays([pa.array(shares), pa.array(out, pa.string())], names=["share", "text"])

    return cut


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", max_words: int = 0, max_share: float = 0.5, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Documents without their benchmark passages, columns as they are.

    Hit spans of more than max_words words are removed from the text. A document of which more
    than max_share is hit goes altogether. The removal is repeated, since words that a removal
    brings together can form a window again. Each time the hits of all blocks are taken together,
    so the result does not depend on how the items are dealt into blocks.
    """
    share = docs.sparkSession.sparkContext.broadcast
    indexes = [share(index) for index in build_indexes(items, text=text, window=window, block_words=block_words)]
    columns = docs.columns
    docs = docs.withColumn("__cut", _cut_udf(indexes, max_words)(F.col(text))).where(F.col("__cut.share") <= max_share)
    return docs.withColumn(text, F.col("__cut.text")).select(*columns)
