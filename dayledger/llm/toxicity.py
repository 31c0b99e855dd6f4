"""Toxicity by cumulative-link ordinal regression.

Severity has grades 0 to 3. One weight for each text feature is shared by all grades, and
ordered thresholds cut the same score into them:

    P(grade > k) = sigmoid(score - threshold_k),     score = sum_j w_j log(1 + count_j)

The output is the expected severity, the sum of P(grade > k), with the likeliest grade.

Features are words and the first 4, 5 and 6 bytes of longer words, by exact hash. Candidates
stand out in toxic texts (log odds over their standard error); of these each next one kept
explains most toxic texts that the ones before it do not, so that the other words of a text
with many copies are not mistaken for signs of toxicity. Labels say only toxic or
not; a toxic text's grade comes from how many of the standing-out words it holds, cut at the
thirds of the toxic sample.

The fit takes at most `sample` labelled rows, those whose hashed id is smallest; scoring
covers every row.

Defined results: null and empty texts have no features and the severity of a text without any;
rows without a label are not learnt from; of repeated labels the largest counts; without toxic
labels every severity is 0.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W
from dayledger.llm.classifier import labelled_sample

SAMPLE = 20_000
CANDIDATES = 6_000
KEPT = 600
STANDS_OUT = 3.0
GRADES = 4
_PREFIXES = (4, 5, 6)


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and every prefix of a longer word."""
    words = W.split(texts, W.ALPHANUMERIC, lower=True)
    doc, rows, found = words.doc, [words.doc], [words.hashes()]
    for n in _PREFIXES:
        long = np.flatnonzero(words.end - words.begin > n)
        prefix = W.Words(words.data, words.begin[long], words.begin[long] + n, words.first)
        rows.append(doc[long])
        found.append(W.mix(prefix.hashes() ^ np.uint64(n)))
    return np.concatenate(rows), np.concatenate(found)


@dataclass
class Severity:
    """The kept features in order of hash, their weights, and the thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature number, times) of the kept features."""
        none = np.zeros(0, np.int64)
        if not len(self.features):
            return none, none, none
        rows, hashes = text_features(texts)
        table = np.zeros(1 << 16, bool)
        table[self.features >> np.uint64(48)] = True
        maybe = np.flatnonzero(table[hashes >> np.uint64(48)])
        place = np.minimum(np.searchsorted(self.features, hashes[maybe]), len(self.features) - 1)
        known = self.features[place] == hashes[maybe]
        key, times = np.unique(rows[maybe][known] * len(self.features) + place[known], return_counts=True)
        return key // len(self.features), key % len(self.features), times

    def tails(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) for each text and k = 0 .. GRADES - 2."""
        rows, feature, times = self.counts(texts)
        score = np.bincount(rows, weights=self.weights[feature] * np.log1p(times), minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -40, 40)))


def candidate_features(rows: DataFrame, kept: int = CANDIDATES, least: float = STANDS_OUT) -> np.ndarray:
    """Hashes of the features that stand out in toxic texts of (text, label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in W.slices(batch["text"], 8 << 20):
                doc, hashes = text_features(part)
                label = batch["label"].slice(at, len(part)).to_numpy(zero_copy_only=False) > 0
                order = np.lexsort((doc, hashes))
                doc, hashes = doc[order], hashes[order]
                once = np.r_[True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])] if len(doc) else np.zeros(0, bool)
                known, place = np.unique(hashes[once], return_inverse=True)
                toxic = np.bincount(place, weights=label[doc[once]], minlength=len(known)).astype(np.int64)
                every = np.bincount(place, minlength=len(known))
                yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], names=["feature", "toxic", "clean"])

    n = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)).alias("toxic"), F.count("*").alias("every")).first()
    sums = rows.mapInArrow(count, "feature bigint, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n["toxic"] + 1)) - F.log((F.col("b") + 0.5) / (n["every"] - n["toxic"] + 1))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    top = sums.where("a > 2").select("feature", z.alias("z")).where(F.col("z") >= least).orderBy(F.desc("z"), "feature").limit(kept)
    return np.sort(np.array([r["feature"] for r in top.collect()], np.int64).view(np.uint64))


def pursue(row: np.ndarray, feature: np.ndarray, toxic: np.ndarray, n_features: int, kept: int = KEPT, fade: float = 0.25, least: float = 1.0) -> np.ndarray:
    """Features chosen one after the other by the toxic weight they explain, less twice the clean texts they are in.

    Each toxic text weighs 1, and `fade` times as much after each chosen feature that it holds.
    """
    order = np.argsort(feature, kind="stable")
    edges = np.searchsorted(feature[order], np.arange(n_features + 1))
    by_feature = row[order]
    weight = toxic.astype(float)
    clean = np.bincount(feature, weights=~toxic[row], minlength=n_features)
    gain = np.bincount(feature, weights=weight[row], minlength=n_features) - 2 * clean
    of_row = np.argsort(row, kind="stable")
    first = np.searchsorted(row[of_row], np.arange(len(toxic) + 1))
    chosen: list[int] = []
    while len(chosen) < kept and n_features:
        best = int(np.argmax(gain))
        if gain[best] < least:
            break
        chosen.append(best)
        held = by_feature[edges[best] : edges[best + 1]]
        lost = weight[held] * (1 - fade)
        weight[held] *= fade
        for r, x in zip(held[lost > 1e-3], lost[lost > 1e-3], strict=True):
            np.subtract.at(gain, feature[of_row[first[r] : first[r + 1]]], x)
        gain[best] = -np.inf
    return np.sort(np.array(chosen, np.int64))


def fit_ordinal(rows: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 1_500, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds) by Adam on the cumulative-link log-likelihood.

    Thresholds are the first one and the logarithms of the gaps, so they stay in order.
    """
    n = max(1, len(grade))
    params = np.r_[np.zeros(n_features), 2.0, np.zeros(GRADES - 2)]
    mean, square = np.zeros_like(params), np.zeros_like(params)
    one = np.arange(len(grade))
    for t in range(1, steps + 1):
        weights, gaps = params[:n_features], np.exp(params[n_features + 1 :])
        cuts = params[n_features] + np.r_[0, np.cumsum(gaps)]
        score = np.bincount(rows, weights=weights[feature] * value, minlength=len(grade))
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -40, 40)))
        slope = tail * (1 - tail)
        upper = np.c_[np.ones(len(grade)), tail][one, grade]  # P(grade >= own)
        lower = np.c_[tail, np.zeros(len(grade))][one, grade]  # P(grade > own)
        chance = np.maximum(upper - lower, 1e-12)
        d_upper = np.c_[np.zeros(len(grade)), slope][one, grade] / chance
        d_lower = np.c_[slope, np.zeros(len(grade))][one, grade] / chance
        d_score = (d_upper - d_lower) / n
        d_cuts = np.zeros(GRADES - 1)
        np.add.at(d_cuts, np.maximum(grade - 1, 0), -np.where(grade > 0, d_upper, 0) / n)
        np.add.at(d_cuts, np.minimum(grade, GRADES - 2), np.where(grade < GRADES - 1, d_lower, 0) / n)
        tails = np.cumsum(d_cuts[::-1])[::-1]
        grad = np.r_[np.bincount(feature, weights=d_score[rows] * value, minlength=n_features) - decay * weights, tails[0], tails[1:] * gaps]
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        params = params + rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.r_[0, np.cumsum(gaps)]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, doc: str = "doc_id", text: str = "text", usable=None) -> Severity:
    """Fit on at most `sample` labelled rows."""
    rows = labelled_sample(docs, labels, label, sample, doc, text, usable)
    features = candidate_features(rows)
    if not len(features):
        return Severity(features, np.zeros(0), np.full(GRADES - 1, 40.0))
    counter = Severity(features, np.zeros(len(features)), np.zeros(GRADES - 1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in W.slices(batch["text"]):
                row, feature, times = counter.counts(part)
                edges = np.searchsorted(row, np.arange(len(part) + 1))
                cut = lambda x: pa.array([x[a:b].astype(np.int32).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([cut(feature), cut(times), batch["label"].slice(at, len(part))], names=["feature", "times", "label"])

    found = rows.mapInArrow(vectors, "feature binary, times binary, label double").orderBy("feature", "times", "label").toArrow()  # at most `sample` rows
    feature = [np.frombuffer(x, np.int32) for x in found["feature"].to_pylist()]
    row = np.repeat(np.arange(len(feature)), [len(x) for x in feature])
    feature, times = np.concatenate(feature).astype(np.int64), np.concatenate([np.frombuffer(x, np.int32) for x in found["times"].to_pylist()])
    toxic = found["label"].to_numpy() > 0
    chosen = pursue(row, feature, toxic, len(features))
    stays = np.isin(feature, chosen)
    row, feature, times = row[stays], np.searchsorted(chosen, feature[stays]), times[stays]
    held = np.bincount(row, weights=times, minlength=len(toxic))
    thirds = np.quantile(held[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (held > thirds[0]) + (held > thirds[1]), 0)
    weights, thresholds = fit_ordinal(row, feature, np.log1p(times), grade, len(chosen))
    return Severity(features[chosen], weights, thresholds)


def score_toxicity(docs: DataFrame, model: Severity, text: str = "text", least: float = 0.5, out: str = "toxicity") -> DataFrame:
    """Append a struct column `out`: expected severity, likeliest grade, and toxic where P(grade > 0) >= least."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most KEPT features

    @F.arrow_udf("struct<severity:double,grade:int,toxic:boolean>")
    def score(texts: pa.Array) -> pa.Array:
        parts = [shared.value.tails(part) for _, part in W.slices(texts)]
        tails = np.concatenate([*parts, np.zeros((0, GRADES - 1))])
        chance = -np.diff(np.c_[np.ones(len(tails)), tails, np.zeros(len(tails))], axis=1)
        columns = [pa.array(tails.sum(1)), pa.array(chance.argmax(1).astype(np.int32)), pa.array(tails[:, 0] >= least)]
        return pa.StructArray.from_arrays(columns, names=["severity", "grade", "toxic"])

    return docs.withColumn(out, score(F.col(text)))
