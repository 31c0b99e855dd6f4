"""Substring dedup by fixed-block anchors.

A window is 50 consecutive words of one document. A word goes where a window that covers it
also starts in a document with a smaller id.

1. Index and probe. Every document gives its non-overlapping 25-word blocks to an index, and
   every 25-word rolling window of every document probes it. A window of 50 words holds at
   least one whole block of any document it occurs in, so no repeat is missed. Probes are made
   unique within a batch, dealt to hash shards and answered there: which block occurs again.
   What goes to a shard is at most one entry for each batch and key, however often a passage
   occurs.
2. Extension. Around each answered probe the 50-word windows that contain it are followed word
   by word, which grows a hit to the maximal repeat. Windows are compared across all documents
   at once: for each, the smallest id that holds it. This is a plain aggregation with partial
   sums, and a join that may be split, never a list of document pairs.
3. Removal. Each document drops the words of its windows that start in an earlier document.

Whole copies of an earlier document are found first, by a hash of all words, and need no
windows. A row is known as a copy by its id and that hash, as rows may share an id.

Defined results: null and empty texts have no words; texts under 50 words have no windows and
lose nothing; a null id neither loses words nor counts as earlier; rows that share an id do not
count as earlier than each other; an empty table gives an empty table.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W
from dayledger.llm.scratch import Scratch

WINDOW = 50
BLOCK = 25
BATCH_BYTES = 8 << 20
SHARD_WORDS = 1 << 21

_SALT = np.uint64(0xE7037ED1A0B428DB)
_PROBES = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("at", pa.binary()), ("block", pa.binary()), ("twice", pa.binary())])
_ANSWERS = pa.schema([("batch", pa.int64()), ("at", pa.binary()), ("keys", pa.binary()), ("block", pa.binary()), ("twice", pa.binary())])


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a word sequence, as two signed numbers."""
    if not len(hashes):
        return 0, 0
    both = [W.rolling(h, len(h))[0] for h in (hashes, W.mix(hashes ^ _SALT))]
    return int(both[0].astype(np.int64)), int(both[1].astype(np.int64))


def manifest(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, whole_a, whole_b): a hash of each document's words in order."""

    @F.arrow_udf("struct<n_words:bigint,whole_a:bigint,whole_b:bigint>")
    def sign(texts: pa.Array) -> pa.Array:
        out: list[tuple[int, int, int]] = []
        for _, part in W.slices(texts):
            words = W.split(part)
            hashes = words.hashes()
            out += [(int(b - a), *digest(hashes[a:b])) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n_words", "whole_a", "whole_b"])

    return docs.select(F.col(doc).alias("doc_id"), sign(F.col(text)).alias("s")).select("doc_id", "s.*")


def copies(signed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, whole_a) of the documents of at least a window whose words are those of an earlier document."""
    key = ["n_words", "whole_a", "whole_b"]
    long = signed.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    first = long.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return long.join(first, key).where("doc_id > first").select("doc_id", "whole_a").distinct()


def _probe_batch(texts: pa.Array, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, word numbers, is a block, first word of each document) of a batch's rolling windows."""
    keys, at, aligned, firsts, base = [], [], [], [], 0
    for _, part in W.slices(texts):
        words = W.split(part)
        starts = W.window_starts(words.first, block)
        keys.append(W.rolling(words.hashes(), block)[starts] if len(starts) else np.zeros(0, np.uint64))
        at.append(starts + base)
        aligned.append((starts - words.first[words.doc[starts]]) % block == 0)
        firsts.append(words.first[:-1] + base)
        base += int(words.first[-1])
    return np.concatenate(keys), np.concatenate(at).astype(np.uint32), np.concatenate(aligned), np.concatenate(firsts).astype(np.uint32)


def probes(docs: DataFrame, shards: int, doc: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Rows for each batch and shard: unique keys, a word number for each, whether it is a block, whether it occurs twice.

    One more row for each batch, in a shard that is only passed on, holds the batch's ids, the
    first words of its documents, and the further places of repeated keys.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in batches:
            for start, part in W.slices(rows["text"], BATCH_BYTES):
                keys, at, aligned, firsts = _probe_batch(part, block)
                number += 1
                if not len(keys):
                    continue
                order = np.argsort(keys)
                keys = keys[order]
                head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                times = np.diff(np.r_[head, len(keys)])
                lead = np.repeat(order[head], times)
                again = np.ones(len(keys), bool)
                again[head] = False
                blocks = np.logical_or.reduceat(aligned[order], head)
                keys, places, twice = keys[head], at[order[head]], times > 1
                shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                edges = np.searchsorted(shard, np.arange(shards + 1))
                low = keys.astype(np.uint32)
                out = {name: [] for name in _PROBES.names}
                for s in np.flatnonzero(np.diff(edges)):
                    a, b = edges[s], edges[s + 1]
                    values = (s, number, low[a:b].tobytes(), places[a:b].tobytes(), np.packbits(blocks[a:b]).tobytes(), np.packbits(twice[a:b]).tobytes())
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
                ids = rows["doc_id"].slice(start, len(part)).to_numpy(zero_copy_only=False)
                extra = (shards + number % shards, number, None, firsts.tobytes(), ids.tobytes(), np.stack([at[order[again]], at[lead[again]]]).tobytes())
                for name, value in zip(out, extra, strict=True):
                    out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=_PROBES)

    wanted = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return wanted.mapInArrow(go, "shard int, batch bigint, keys binary, at binary, block binary, twice binary")


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _answer(table: pa.Table) -> pa.Table:
    """For one shard: the word numbers, by batch, of the keys that are a block and occur again."""
    rows = table.to_pylist()
    if rows[0]["keys"] is None:
        return table.select(_ANSWERS.names)
    keys = [np.frombuffer(r["keys"], np.uint32) for r in rows]
    every = np.concatenate(keys)
    order = np.argsort(every)
    ordered = every[order]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    blocks = np.concatenate([_bits(r["block"], len(k)) for r, k in zip(rows, keys, strict=True)])[order]
    twice = np.concatenate([_bits(r["twice"], len(k)) for r, k in zip(rows, keys, strict=True)])[order]
    times = np.diff(np.r_[head, len(ordered)])
    hit = np.logical_or.reduceat(blocks, head) & (np.logical_or.reduceat(twice, head) | (times > 1))
    found = np.zeros(len(every), bool)
    found[order] = np.repeat(hit, times)
    out, base = [], 0
    for r, k in zip(rows, keys, strict=True):
        own = found[base : base + len(k)]
        base += len(k)
        if own.any():
            out.append({"batch": r["batch"], "at": np.frombuffer(r["at"], np.uint32)[own].tobytes(), "keys": None, "block": None, "twice": None})
    return pa.Table.from_pylist(out, schema=_ANSWERS)


def _to_documents(table: pa.Table) -> pa.Table:
    """For one batch: the anchors of each document, as word numbers in it."""
    ids = firsts = places = leads = np.zeros(0, np.uint32)
    answers = []
    for r in table.to_pylist():
        if r["block"] is None:
            answers.append(np.frombuffer(r["at"], np.uint32))
        else:
            ids, firsts = np.frombuffer(r["block"], np.int64), np.frombuffer(r["at"], np.uint32)
            places, leads = np.frombuffer(r["twice"], np.uint32).reshape(2, -1)
    at = np.concatenate([*answers, np.zeros(0, np.uint32)])
    at = np.sort(np.concatenate([at, places[np.isin(leads, at)]])).astype(np.int64)
    of = np.searchsorted(firsts, at, "right") - 1  # of documents without words, the last begins where the next does
    docs = np.unique(of)
    edges = np.r_[np.searchsorted(of, docs), len(of)]
    anchors = [(at[a:b] - int(firsts[d])).astype(np.uint32).tobytes() for d, a, b in zip(docs, edges[:-1], edges[1:], strict=True)]
    return pa.table({"doc_id": pa.array(ids[docs], pa.int64()), "anchors": pa.array(anchors, pa.binary())})


def shard_count(signed: DataFrame) -> int:
    """Hash shards for the probes of all words: at least four for each shuffle partition, and few enough words in each for one task."""
    n_words = signed.agg(F.sum("n_words")).first()[0] or 0
    return max(4 * int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_words // SHARD_WORDS)


def find_anchors(docs: DataFrame, doc: str = "doc_id", text: str = "text", block: int = BLOCK, shards: int | None = None) -> DataFrame:
    """(doc_id, anchors): where a document has a block that occurs again anywhere."""
    shards = shards or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = probes(docs, shards, doc, text, block)
    answered = asked.groupBy("shard").applyInArrow(_answer, "batch bigint, at binary, keys binary, block binary, twice binary")
    return answered.groupBy("batch").applyInArrow(_to_documents, "doc_id bigint, anchors binary")


def anchored_windows(docs: DataFrame, anchors: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(key, doc_id): the distinct windows of each document that contain one of its `anchors`.

    A text whose hash is among the `wholes` of its id is a whole copy and gives none.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start, part in W.slices(rows["text"]):
                words = W.split(part)
                hashes = words.hashes()
                keys, owners = [], []
                for d in range(len(part)):
                    own = hashes[words.first[d] : words.first[d + 1]]
                    known = rows["wholes"][start + d].as_py()
                    if len(own) < window or (known and digest(own)[0] in known):
                        continue
                    at = np.frombuffer(rows["anchors"][start + d].as_py(), np.uint32)
                    blocks = W.rolling(own, block)
                    hit = np.flatnonzero(np.isin(blocks, blocks[at[at < len(blocks)]]))
                    last = len(own) - window
                    from_ = np.maximum(hit - (window - block), 0)
                    upto = np.minimum(hit, last)
                    fits = from_ <= upto
                    wanted = W.covered(from_[fits], upto[fits] - from_[fits] + 1, last + 1)
                    found = np.unique(W.rolling(own, window)[wanted])
                    keys.append(found)
                    owners.append(np.full(len(found), rows["doc_id"][start + d].as_py(), np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], names=["key", "doc_id"])

    both = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).join(anchors, "doc_id")
    return both.mapInArrow(go, "key bigint, doc_id bigint")


def repeated_windows(docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, keys, wholes): the window hashes of a document that start in an earlier one, and hashes of whole copies."""
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block wherever it begins")
    keep = Scratch(docs)
    signed = keep(manifest(docs, doc, text), "manifest")
    copied = keep(copies(signed, window), "copies")
    whole = copied.groupBy("doc_id").agg(F.collect_set("whole_a").alias("wholes"))
    found = keep(find_anchors(docs, doc, text, block, shard_count(signed)), "anchors")
    # An id with one text is a copy or is none; of an id with several, each text is looked at.
    several = signed.groupBy("doc_id").agg(F.min("whole_a").alias("least"), F.max("whole_a").alias("most")).where("least < most").select("doc_id")
    alone = whole.join(several, "doc_id", "left_anti").select("doc_id")
    anchors = found.join(alone, "doc_id", "left_anti").join(whole, "doc_id", "left")
    windows = keep(anchored_windows(docs, anchors, doc, text, window, block), "windows")
    first = windows.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    later = windows.join(first, "key").where("doc_id > first")
    repeated = later.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    return keep(repeated.join(whole, "doc_id", "full_outer"), "repeated")


def removed_words(text_words: np.ndarray, keys: np.ndarray | None, wholes: list[int] | None, window: int = WINDOW) -> np.ndarray:
    """Which words of one document, given by their hashes, go."""
    n = len(text_words)
    gone = np.zeros(n, bool)
    if n < window:
        return gone
    if wholes and digest(text_words)[0] in wholes:
        return ~gone
    if keys is not None and len(keys):
        starts = np.flatnonzero(np.isin(W.rolling(text_words, window), keys.view(np.uint64)))
        gone = W.covered(starts, window, n)
    return gone


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, block: int = BLOCK, out: str = "repeats") -> DataFrame:
    """Append a struct column `out`: n_words, n_removed, the kept words joined by one space, and their SHA-256."""

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string,kept_sha256:string>")
    def strip(texts: pa.Array, keys: pa.Array, wholes: pa.Array) -> pa.Array:
        n_words, n_removed, kept, shas = [], [], [], []
        for start, part in W.slices(texts):
            words = W.split(part)
            hashes = words.hashes()
            raw = words.data.tobytes()
            for d in range(len(part)):
                a, b = words.first[d], words.first[d + 1]
                known, whole = keys[start + d], wholes[start + d].as_py()
                gone = removed_words(hashes[a:b], known.values.to_numpy() if known.is_valid else None, whole, window)
                stay = np.flatnonzero(~gone) + a
                left = b" ".join([raw[x:y] for x, y in zip(words.begin[stay].tolist(), words.end[stay].tolist(), strict=True)])
                n_words.append(b - a)
                n_removed.append(int(gone.sum()))
                kept.append(left.decode())
                shas.append(hashlib.sha256(left).hexdigest())
        arrays = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(shas, pa.string())]
        return pa.StructArray.from_arrays(arrays, names=["n_words", "n_removed", "kept", "kept_sha256"])

    found = repeated_windows(docs, doc, text, window, block).select(F.col("doc_id").alias("__id"), F.col("keys").alias("__keys"), F.col("wholes").alias("__wholes"))
    joined = docs.drop(*found.columns).join(found, F.col(doc) == F.col("__id"), "left")
    return joined.withColumn(out, strip(F.col(text), F.col("__keys"), F.col("__wholes"))).drop("__id", "__keys", "__wholes")
