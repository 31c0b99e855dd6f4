"""Quality classifier: a factorisation machine.

A text is a sparse vector: hashed words, weighted by their share of the text, and one feature
for the range that each of some structure statistics falls into (the text's own metadata:
length, line shape, share of letters, symbols, capitals and repeats). The machine scores

    w0 + sum_j w_j x_j + 1/2 sum_f [ (sum_j v_jf x_j)^2 - sum_j (v_jf x_j)^2 ]

so every pair of features interacts through low-rank factors at a cost linear in the text.
Labels, language, source and id are never features.

The fit takes at most `sample` labelled rows, those whose hashed id is smallest, so the driver
holds a bounded matrix; scoring covers every row where it lies.

Defined results: null and empty texts have only their structure features and get a score;
rows without a label, or with a null one, are not learnt from; of repeated labels the largest
counts; without any usable label the score is 0.5.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W
from dayledger.llm.quality import COUNTS, text_counts

WORD_BITS = 14
RANGES = 12
SAMPLE = 8_000
_RATIOS = (
    ("word_chars", "n_words", 1.0),
    ("n_symbols", "n_words", 0.02),
    ("n_dup_lines", "n_lines", 0.05),
    ("n_repeat_words", "n_words", 0.03),
    ("n_letters", "word_chars", 0.6),
    ("n_upper", "n_letters", 0.02),
    ("n_loud", "n_words", 0.02),
    ("n_echoes", "n_words", 0.02),
    ("n_words", "n_lines", 2.0),
)
N_FEATURES = (1 << WORD_BITS) + RANGES * (len(_RATIOS) + 1)


def _ranges(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The structure features of each text, one column for each statistic."""
    size = np.minimum(np.log2(counts["n_words"] + 1).astype(np.int64), RANGES - 1)
    columns = [size]
    for over, under, unit in _RATIOS:
        ratio = counts[over] / np.maximum(counts[under], 1)
        if over == "n_letters":
            ratio = np.maximum(0, ratio - unit) * 25
        else:
            ratio = np.where(ratio > 0, 1 + np.log2(1 + ratio / unit), 0)
        columns.append(np.minimum(ratio.astype(np.int64), RANGES - 1))
    return np.stack(columns, axis=1) + np.arange(len(columns)) * RANGES + (1 << WORD_BITS)


def sparse_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, features, values): text i has entries first[i] .. first[i + 1]."""
    words = W.split(texts, W.ALPHANUMERIC, lower=True)
    n = len(texts)
    key = (words.doc << WORD_BITS) | (words.hashes() >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, times = np.unique(key, return_counts=True)
    doc, feature = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)
    norm = np.sqrt(np.bincount(doc, weights=times.astype(float) ** 2, minlength=n))
    shape = _ranges(dict(zip(COUNTS, text_counts(texts), strict=True)))
    doc = np.concatenate([doc, np.repeat(np.arange(n), shape.shape[1])])
    feature = np.concatenate([feature, shape.reshape(-1)])
    value = np.concatenate([times / norm[doc[: len(times)]], np.ones(shape.size)])
    order = np.argsort(doc, kind="stable")
    first = np.searchsorted(doc[order], np.arange(n + 1))
    return first, feature[order], value[order]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def _sums(self, first: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = self.factors[feature] * value[:, None]
        total = np.add.reduceat(parts, first[:-1], axis=0)
        square = np.add.reduceat(parts * parts, first[:-1], axis=0)
        line = np.add.reduceat(self.linear[feature] * value, first[:-1])
        return self.bias + line + 0.5 * (total * total - square).sum(1), total

    def score(self, first: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Probability of label 1; every text has entries, its structure features."""
        if len(first) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self._sums(first, feature, value)[0], -30, 30)))


def fit_machine(
    first: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, rank: int = 8, epochs: int = 8, batch: int = 256, rate: float = 0.08, decay: float = 1e-5
) -> Machine:
    """Logistic loss, adaptive gradient steps over batches in a fixed order."""
    dice = np.random.default_rng(11)
    share = np.clip(label.mean(), 0.01, 0.99) if len(label) else 0.5
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), dice.normal(0, 0.01, (N_FEATURES, rank)))
    if len(label) == 0 or share in (0.01, 0.99):
        return machine
    seen_line, seen_factors = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, rank), 1e-6)
    for _ in range(epochs):
        order = dice.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            size = first[rows + 1] - first[rows]
            begin = np.r_[0, np.cumsum(size)]
            entry = np.repeat(first[rows] - begin[:-1], size) + np.arange(begin[-1])
            f, x = feature[entry], value[entry]
            raw, total = machine._sums(begin, f, x)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[rows]) / len(rows)
            e = np.repeat(error, size) * x
            used, place = np.unique(f, return_inverse=True)
            line = np.bincount(place, weights=e) + decay * machine.linear[used]
            step = e[:, None] * (np.repeat(total, size, axis=0) - machine.factors[f] * x[:, None])
            grad = np.stack([np.bincount(place, weights=step[:, k]) for k in range(rank)], axis=1) + decay * machine.factors[used]
            seen_line[used] += line**2
            seen_factors[used] += grad**2
            machine.linear[used] -= rate * line / np.sqrt(seen_line[used])
            machine.factors[used] -= 0.25 * rate * grad / np.sqrt(seen_factors[used])
            machine.bias -= rate * float(error.sum())
    return machine


def held_out(doc: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, n: int, doc: str = "doc_id", text: str = "text", usable: Column | None = None) -> DataFrame:
    """(text, label) of at most n labelled documents, those with the smallest hashed ids.

    The ids are at most n, so they are broadcast and the texts stay where they are. Of rows that
    share an id the smallest text counts, so that no more than n rows come of them.
    """
    rows = labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull())
    if usable is not None:
        rows = rows.where(usable)
    rows = rows.groupBy(doc).agg(F.max(label).cast("double").alias("label"))
    chosen = rows.orderBy(F.xxhash64(doc), doc).limit(n).withColumnRenamed(doc, "id")
    texts = docs.select(F.col(doc).alias("id"), F.col(text).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, doc: str = "doc_id", text: str = "text") -> Machine:
    """Fit on at most `sample` labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, label, sample, doc, text, ~held_out(F.col(doc)))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in W.slices(batch["text"]):
                first, feature, value = sparse_rows(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([feature[a:b].astype(np.int16).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                        pa.array([value[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                        batch["label"].slice(at, len(part)),
                    ],
                    names=["feature", "value", "label"],
                )

    found = rows.mapInArrow(vectors, "feature binary, value binary, label double").toArrow()  # at most `sample` rows
    order = np.argsort([hash_ for hash_ in map(bytes, found["feature"].to_pylist())], kind="stable") if len(found) else []
    found = found.take(pa.array(order, pa.int64()))
    feature = [np.frombuffer(x, np.int16) for x in found["feature"].to_pylist()]
    value = [np.frombuffer(x, np.float32) for x in found["value"].to_pylist()]
    first = np.r_[0, np.cumsum([len(x) for x in feature])].astype(np.int64)
    join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)])
    return fit_machine(first, join(feature, np.int16).astype(np.int64), join(value, np.float32).astype(float), found["label"].to_numpy())


def score_texts(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of label 1 for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # N_FEATURES x (rank + 1) numbers, whatever the data

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.score(*sparse_rows(part)) for _, part in W.slices(texts)]
        return pa.array(np.concatenate([*parts, np.zeros(0)]))

    return docs.withColumn(out, score(F.col(text)))
