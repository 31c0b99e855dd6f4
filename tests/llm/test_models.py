"""The two classifiers and the packing plan against plain Python: scores, gradients, likelihood, choices."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

from dayledger.llm import classifier, packing, toxicity  # noqa: E402
from dayledger.llm import words as W  # noqa: E402
from dayledger.llm.quality import COUNTS, text_counts  # noqa: E402
from dayledger.session import ship_package  # noqa: E402

TEXTS = [
    None, "", "One two two THREE é é x1 x-1", "a " * 400, "line one\nline one\nLOUD LOUD words ### $$ here", " ".join(f"word{i} foulest" for i in range(300)), "vile vilest wormy worm worm",
]


def hash_of(word: str) -> int:
    return int(W.split(pa.array([word]), W.ALPHANUMERIC, lower=True).hashes()[0])


def plain_vector(text):
    """Feature -> value of one text, word by word."""
    words = plain.ALNUM.findall(plain.lower(text or ""))
    times = Counter(hash_of(w) >> (64 - classifier.WORD_BITS) for w in words)
    norm = sum(n * n for n in times.values()) ** 0.5
    out = {f: n / norm for f, n in times.items()}
    counts = dict(zip(COUNTS, text_counts(pa.array([text], pa.large_string())), strict=True))
    return out | {int(f): 1.0 for f in classifier._ranges(counts)[0]}


def plain_raw(machine, vector):
    """The machine's sum over every pair of features."""
    total = machine.bias + sum(machine.linear[f] * x for f, x in vector.items())
    items = list(vector.items())
    for i, (f, x) in enumerate(items):
        for g, y in items[i + 1 :]:
            total += float(machine.factors[f] @ machine.factors[g]) * x * y
    return total


def test_machine_scores_equal_the_sum_over_pairs(spark):
    ship_package(spark)
    dice = np.random.default_rng(1)
    machine = classifier.Machine(-0.2, dice.normal(0, 0.3, classifier.N_FEATURES), dice.normal(0, 0.2, (classifier.N_FEATURES, 3)))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id INT, text STRING").repartition(2)
    got = {r["doc_id"]: r["score"] for r in classifier.score_texts(docs, machine).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(plain_raw(machine, plain_vector(text)), -30, 30))), abs=1e-9)


def test_machine_steps_along_the_gradient_of_the_loss():
    texts = [f"good plain words number {i} here" if i % 2 else f"buy now cheap {i} offer buy" for i in range(24)]
    label = np.array([float(i % 2) for i in range(24)])
    first, feature, value = classifier.sparse_rows(pa.array(texts))
    rate, decay, rank = 0.08, 1e-5, 2
    fitted = classifier.fit_machine(first, feature, value, label, rank=rank, epochs=1, batch=100, rate=rate, decay=decay)
    start = np.random.default_rng(11).normal(0, 0.01, (classifier.N_FEATURES, rank))
    vectors = [plain_vector(t) for t in texts]

    def loss(linear, factors):
        machine = classifier.Machine(0.0, linear, factors)
        raw = np.array([plain_raw(machine, v) for v in vectors])
        return float(np.mean(np.log1p(np.exp(raw)) - label * raw))

    used = sorted(Counter(f for v in vectors for f in v).items(), key=lambda x: -x[1])
    for f in [f for f, _ in used][:3] + [f for f, _ in used][-2:]:
        for k in (None, 1):
            values = []
            for sign in (1, -1):
                linear, factors = np.zeros(classifier.N_FEATURES), start.copy()
                target = linear if k is None else factors
                target[f if k is None else (f, k)] += sign * 1e-5
                values.append(loss(linear, factors))
            slope = (values[0] - values[1]) / 2e-5 + decay * (0.0 if k is None else start[f, k])
            step = (rate if k is None else 0.25 * rate) * slope / np.sqrt(1e-6 + slope**2)
            moved = fitted.linear[f] if k is None else fitted.factors[f, k] - start[f, k]
            assert moved == pytest.approx(-step, rel=2e-3, abs=2e-5)


def plain_severity(model, text):
    words = plain.ALNUM.findall(plain.lower(text or ""))
    found = [hash_of(w) for w in words]
    for n in toxicity._PREFIXES:
        cut = [w.encode()[:n] for w in words if len(w.encode()) > n]
        found += [int(W.mix(np.array([raw_hash(c)], np.uint64) ^ np.uint64(n))[0]) for c in cut]
    times = Counter(found)
    score = sum(w * np.log1p(times[int(f)]) for f, w in zip(model.features, model.weights, strict=True))
    tails = [1 / (1 + np.exp(-(score - t))) for t in model.thresholds]
    chances = [1 - tails[0], *(a - b for a, b in zip(tails, [*tails[1:], 0.0], strict=True))]
    return sum(tails), int(np.argmax(chances)), tails[0] >= 0.5


def raw_hash(data: bytes) -> int:
    """Hash of bytes that need not be whole characters."""
    return int(W.Words(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]), np.array([0, 1])).hashes()[0])


def test_severity_equals_the_cumulative_link_by_hand(spark):
    ship_package(spark)
    mild, foul = ["calm day by the river"] * 90, ["you vilest wormy thing vilest" if i % 2 else "what a vilest thing wörmchen" for i in range(60)]
    docs = spark.createDataFrame([(i, f"{t} n{i}") for i, t in enumerate(mild + foul)], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, int(i >= 90)) for i in range(150)], "doc_id BIGINT, toxic INT")
    model = toxicity.train(docs, labels)
    assert len(model.features) and (np.diff(model.thresholds) > 0).all()
    more = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + foul[:2] + mild[:1])], "doc_id INT, text STRING")
    for r in toxicity.score_toxicity(more, model).select("text", "toxicity.*").collect():
        severity, grade, toxic = plain_severity(model, r["text"])
        assert r["severity"] == pytest.approx(severity, abs=1e-9) and (r["grade"], r["toxic"]) == (grade, toxic)


def test_ordinal_fit_is_at_the_top_of_the_likelihood():
    dice = np.random.default_rng(4)
    n, k = 300, 4
    x = dice.integers(0, 3, (n, k)).astype(float)
    score = x @ np.array([1.0, -0.5, 0.8, 0.0]) + dice.logistic(size=n)
    grade = (score[:, None] > np.array([0.5, 1.5, 2.5])).sum(1)
    row, feature = np.nonzero(x)
    decay = 1e-3
    weights, cuts = toxicity.fit_ordinal(row, feature, x[row, feature], grade, k, steps=3_000, rate=0.02, decay=decay)

    def objective(params):
        w, t = params[:k], params[k:]
        total = 0.0
        for own, g in zip(x, grade, strict=True):
            tails = [1.0, *(1 / (1 + np.exp(-(own @ w - c))) for c in t), 0.0]
            total += np.log(tails[g] - tails[g + 1])
        return total / n - decay / 2 * float(w @ w)

    best = np.r_[weights, cuts]
    for j in range(len(best)):
        step = np.zeros(len(best))
        step[j] = 1e-4
        assert abs(objective(best + step) - objective(best - step)) / 2e-4 < 2e-3
        for far in (0.2, -0.2):
            assert objective(best + far / 1e-4 * step) < objective(best)


@pytest.mark.parametrize("by", ["dot", "norm"])
def test_every_bin_takes_the_best_piece_that_fits(by):
    counts = {900: 5, 700: 3, 420: 9, 130: 11, 33: 20, 1: 40}
    limits = packing.Limits(2048, documents=12, attention=1_700_000, weights=(1.0, 0.3, 0.5), by=by)
    plan = packing.best_fit(counts, limits)
    got: dict[int, list[tuple[int, int]]] = {}
    for length, times, sequence, offset in zip(plan.length, plan.times, plan.sequence, plan.offset, strict=True):
        for k in range(times):
            got.setdefault(int(sequence + k), []).append((int(offset), int(length)))
    capacity = np.array([2048, 12, 1_700_000], float)
    left, want = Counter(counts), []
    while +left:
        residual, filled = capacity.copy(), []
        while True:
            fit = [n for n in sorted(left, reverse=True) if left[n] and (np.array([n, 1, n * n]) <= residual).all()]
            if not fit:
                break

            def value(n):
                vector = np.array([n, 1, n * n]) / capacity
                if by == "dot":
                    return float((vector * (residual / capacity) * limits.weights).sum())
                return -float((((residual / capacity) - vector) ** 2 * limits.weights).sum())

            pick = max(fit, key=value)
            left[pick] -= 1
            residual -= [pick, 1, pick * pick]
            filled.append(pick)
        want.append(filled)
    assert Counter(tuple(n for _, n in sorted(own)) for own in got.values()) == Counter(map(tuple, want))


def test_a_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(50)] + [(i, None) for i in range(2, 30)], "doc_id INT, text STRING").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1)], "doc_id INT, quality INT")
    for n in (5, 100):
        rows = classifier.labelled_sample(docs, labels, "quality", n).collect()
        assert len(rows) <= n
    assert sorted(map(tuple, rows), key=str) == sorted([("copy 0", 1.0), *((None, float(i % 2)) for i in range(2, 30))], key=str)
