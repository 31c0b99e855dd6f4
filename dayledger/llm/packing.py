"""Vector best-fit packing of tokenised documents into sequences.

Every piece is a vector: tokens, one document, and attention cost (tokens squared). A sequence
has a capacity in each of the three. An open sequence takes, among the pieces that fit under
every constraint, the one whose vector has the largest weighted dot product with its residual
capacities, or leaves the smallest residual norm, until none fits.

A piece's vector depends on its length only, so the choice needs the number of pieces of each
length and nothing else: at most `capacity` counts, however many documents there are. The plan
is a list of sequence patterns, each used many times; it runs dry one length after the other
and so has at most a few thousand patterns. The pieces then find their place by their rank
among the pieces of their length. Ranks are counted within hash shards and shifted by the
earlier shards' counts, so no task sees all pieces of a frequent length.

Defined results: a null or empty text is the separator alone; repeated documents are packed
each; a null id is packed like any other; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayledger.llm import words as W
from dayledger.session import scratch_path

SEPARATOR = 0
#: Fixed value: how a byte-level pre-tokeniser splits text.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CHUNK = r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+"
#: White space beyond the above that some pre-tokeniser may join with it: such texts are encoded whole.
_ODD_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]"
#: Text where words are apart by more than one space or one line end is cut into chunks more slowly.
_UNEVEN = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings by id where a vocabulary is plain byte-level BPE whose ids follow the merges; else None.

    Merging by smallest id is then the same as merging in the listed order.
    """
    model = spec["model"]
    level = spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or level.get("type") != "ByteLevel" or level.get("add_prefix_space") or spec.get("normalizer"):
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
    joined = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if joined != sorted(joined):
        return None
    added = {token["content"] for token in spec.get("added_tokens", ())}
    return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in added}


class ChunkEncoder:
    """Token ids as little-endian uint32 bytes, by white-space delimited chunks.

    A byte-level vocabulary's pre-tokeniser never joins a word to the white space after it, so
    white space with the word that follows is encoded the same alone as in its text. Chunks
    repeat, and each is given to the tokeniser once while it stays in the tables. Where the file
    allows it, chunks are merged by ranks, which gives the file's own ids in a third of the time.
    """

    def __init__(self, path: str, limit: int = 60_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.chunks: dict[str, bytes | None] = {}
        self.spaced: dict[str, bytes | None] = {}  # by the word after one space, or by "\n" and the word
        self.split = re.compile(_CHUNK).findall
        self.odd = re.compile(_ODD_SPACE).search
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # The tokeniser finds its added tokens in a text before anything else.
        self.added = [token["content"] for token in spec.get("added_tokens", ()) if token["content"]]
        ranks = merge_ranks(spec)
        self.ranked = ranks and tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        if ranks:
            self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            self.sizes[list(ranks.values())] = [len(token) for token in ranks]

    def forget(self) -> None:
        self.chunks.clear()
        self.spaced.clear()

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _packed_chunks(self, chunks: list[str]) -> list[bytes]:
        if not self.ranked:
            return self._packed(chunks)
        encode = self.ranked.encode_ordinary
        return [array("I", encode(chunk)).tobytes() for chunk in chunks]

    def _packed_words(self, words: list[str]) -> list[bytes]:
        """Ids of words, each after one space or its own line end: encoded as one text, whose ids are cut where words begin."""
        if not self.ranked:
            return self._packed([x if x[:1] == "\n" else " " + x for x in words])
        text = (" " + " ".join(words)).replace(" \n", "\n")
        ids = np.array(self.ranked.encode_ordinary(text), "<u4")
        data = np.frombuffer(text.encode(), np.uint8)
        begin = np.flatnonzero((data == 0x20) | (data == 0x0A))
        ends = np.cumsum(self.sizes[ids])
        cuts = (4 * np.searchsorted(ends, [*begin[1:], len(data)]) + 4).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _learn(self, table: dict[str, bytes | None], used: list[list[str]], packed: Callable[[list[str]], list[bytes]]) -> None:
        needed = set().union(*used)
        if len(table) > self.limit:  # what these texts need again stays
            again = {x: table[x] for x in needed.intersection(table)}
            table.clear()
            table.update(again)
        new = list(needed.difference(table))
        if self.odd("".join(new)):
            table.update((x, None) for x in new if self.odd(x))
            new = [x for x in new if x not in table]
        if new:
            table.update(zip(new, packed(new), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        even, other, whole = {}, {}, []
        for d, text in enumerate(texts):
            if not text:
                continue
            if any(x in text for x in self.added):
                whole.append(d)
            elif any(x in text for x in _UNEVEN) or text[0] in " \n" or text[-1] in " \n":
                other[d] = self.split(text)
            else:
                even[d] = text.replace("\n", " \n").split(" ")
        self._learn(self.chunks, [*other.values(), *(own[:1] for own in even.values())], self._packed_chunks)
        self._learn(self.spaced, list(even.values()), self._packed_words)
        out = [b""] * len(texts)
        for d in range(len(texts)):
            try:
                if d in even:
                    own = [self.spaced[x] for x in even[d]]
                    own[0] = self.chunks[even[d][0]]
                    out[d] = b"".join(own)
                elif d in other:
                    out[d] = b"".join([self.chunks[x] for x in other[d]])
            except TypeError:  # a chunk with odd white space has no ids of its own
                whole.append(d)
        for d, ids in zip(whole, self._packed([texts[d] for d in whole]), strict=True):
            out[d] = ids
        return out


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents cut only where longer than capacity, the first piece shorter."""
    item = "struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>"

    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())

    @F.arrow_udf(f"array<{item}>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(tokenizer)
        try:
            for texts in batches:
                columns: list[list[int]] = [[], [], [], []]
                ends = [0]
                for _, part in W.slices(texts):
                    for ids in own.encode(part.to_pylist()):
                        ids += SEPARATOR.to_bytes(4, "little")
                        n = len(ids) // 4
                        edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                            for column, value in zip(columns, (k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                                column.append(value)
                        ends.append(len(columns[0]))
                values = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, names=["piece", "start", "length", "ids_crc32"]))
        finally:  # the worker process lives on for other tasks
            own.forget()

    cuts = docs.select(F.col(doc).alias("doc_id"), F.explode(cut(F.col(text))).alias("p"))
    return cuts.select("doc_id", "p.*")


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence, and the weights of the three dimensions in the choice."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    by: str = "dot"

    def vectors(self, lengths: np.ndarray) -> np.ndarray:
        return np.stack([lengths, np.ones_like(lengths), lengths.astype(np.int64) ** 2], axis=1).astype(np.int64)

    @property
    def capacity(self) -> np.ndarray:
        no_limit = np.iinfo(np.int64).max // 4
        return np.array([self.tokens, self.documents or no_limit, self.attention or no_limit], np.int64)


#: What the query and the pipeline pack by. A piece of 2048 tokens alone costs 2048 ** 2, so attention has no smaller capacity;
#: the capacity of documents is doubled as long as it costs a sequence.
SEQUENCE = Limits(documents=64, attention=2048**2, weights=(1.0, 0.5, 0.5))


@dataclass(frozen=True)
class Plan:
    """Slots: pieces of `length` with rank in [rank, rank + times) go to sequence + (their rank - rank), at offset."""

    length: np.ndarray
    rank: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fit(counts: dict[int, int], limits: Limits = Limits()) -> Plan:
    """Fill sequence after sequence by vector best fit; equal sequences are made together."""
    lengths = np.array(sorted(counts, reverse=True), np.int64)
    left = np.array([counts[int(n)] for n in lengths], np.int64)
    used = np.zeros(len(lengths), np.int64)
    vectors = limits.vectors(lengths)
    capacity = limits.capacity
    scale = np.where(np.array(limits.weights) > 0, capacity, 1).astype(float)
    if len(lengths) and (vectors > capacity).any():
        raise ValueError("a piece alone exceeds a capacity")
    slots: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    while (left > 0).any():
        residual, taken, chosen = capacity.copy(), np.zeros(len(lengths), np.int64), []
        while True:
            fits = (vectors <= residual).all(1) & (left > taken)
            if not fits.any():
                break
            if limits.by == "dot":
                score = ((vectors / scale) * (residual / scale) * limits.weights).sum(1)
            else:
                score = -((((residual - vectors) / scale) ** 2) * limits.weights).sum(1)
            pick = int(np.argmax(np.where(fits, score, -np.inf)))
            chosen.append(pick)
            taken[pick] += 1
            residual = residual - vectors[pick]
        need = taken > 0
        times = int((left[need] // taken[need]).min())
        offset = 0
        for pick in chosen:
            slots.append((int(lengths[pick]), int(used[pick]), times, sequences, offset))
            used[pick] += times
            left[pick] -= times
            offset += int(lengths[pick])
        sequences += times
    columns = np.array(sorted(slots), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def fewest_sequences(counts: dict[int, int], limits: Limits) -> Plan:
    """The plan with the smallest document capacity, from `limits.documents` on by doubling, that needs no more sequences than none."""
    plan = best_fit(counts, replace(limits, documents=None))
    documents = limits.documents
    while documents and documents < limits.tokens:
        bounded = best_fit(counts, replace(limits, documents=documents))
        if bounded.sequences <= plan.sequences:
            return bounded
        documents *= 2
    return plan


def with_rank(cut: DataFrame, shards: int) -> DataFrame:
    """Append `rank`: the piece's number among the pieces of its length, from 0."""
    shard = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shards)).cast("int")
    sharded = cut.withColumn("shard", shard)
    sizes = sharded.groupBy("length", "shard").count()
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    ranked = sharded.withColumn("own", F.row_number().over(own) - 1).join(base, ["length", "shard"])
    return ranked.withColumn("rank", (F.col("own") + F.col("base")).cast("long")).drop("own", "base", "shard")


def pack(docs: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", limits: Limits = Limits(), shards: int | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    pieces(docs, tokenizer, doc, text, limits.tokens).write.parquet(path)
    cut = spark.read.parquet(path)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `tokens` rows
    plan = spark.sparkContext.broadcast(fewest_sequences(counts, limits))
    shards = shards or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        p = plan.value
        order = np.int64(1) << 40
        rank = ranks.to_numpy(zero_copy_only=False)
        slot = np.searchsorted(p.length * order + p.rank, lengths.to_numpy(zero_copy_only=False) * order + rank, "right") - 1
        return pa.StructArray.from_arrays([pa.array(p.sequence[slot] + rank - p.rank[slot]), pa.array(p.offset[slot])], names=["sequence_id", "offset"])

    placed = with_rank(cut, shards).withColumn("__place", place(F.col("length"), F.col("rank")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "__place.sequence_id", "__place.offset")
