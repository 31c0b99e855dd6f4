"""Quality rules by weak supervision.

Each rule looks at the counts of one text and votes good, votes bad or abstains. How far each
rule can be trusted is not set by hand: expectation-maximisation fits, for good texts and for
texts with each family of faults, how often each rule votes each way, from nothing but how the
rules' votes fall together over all documents. The verdict is the posterior probability of
"good", not "all rules must pass". Faults come in families because junk of one kind passes the
rules for the other kinds; a single class of bad texts would take that for disagreement.

The fit needs only how often each combination of votes occurs. There are at most
3 ** len(RULES) combinations whatever the number of documents, so that table, and no
document, goes to the driver.

Defined results: a null or empty text has zero counts and fails the base rule; a null id is
kept as it is; repeated rows are scored each; an empty table gives an empty table.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT = 0.3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_loud", "n_echoes")
COUNTS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in (*COUNTS, "pattern")) + ",posterior:double>"

_CONTINUATION = (np.arange(256) & 0xC0) == 0x80
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER | np.roll(_UPPER, 32) | (np.arange(256) >= 0xC0)
_LETTER[0x30:0x3A] = True
_LOUD = np.zeros(256, bool)
_LOUD[[0x21, 0x3F]] = True


def text_counts(texts: pa.Array) -> list[np.ndarray]:
    """The COUNTS of each text."""
    w = W.split(texts)
    hashes = w.hashes()
    data, offsets = w.data, W.text_bytes(texts)[1]
    n = int(w.first[-1])
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_CONTINUATION[data], out=chars[1:])
    starts = W.window_starts(w.first, WINDOW)
    keys = W.rolling(hashes, WINDOW)[starts] if len(starts) else np.zeros(0, np.uint64)
    keys = W.mix(keys ^ w.doc[starts].astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    echo = np.zeros(n, bool)
    echo[1:] = hashes[1:] == hashes[:-1]
    echo[w.first[:-1][w.counts > 0]] = False
    raw, repeats, lines = data.tobytes(), np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    for d in range(len(lines)):
        own = [x for x in raw[offsets[d] : offsets[d + 1]].split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
        lines[d] = len(own)
        repeats[d] = len(own) - len(set(own))
    return [
        w.counts,
        W.per_doc(chars[w.end] - chars[w.begin], w.first),
        W.per_doc(SYMBOLS[data], offsets),
        repeats,
        W.per_doc(W.covered(starts[twice], WINDOW, n), w.first),
        lines,
        W.per_doc(_LETTER[data], offsets),
        W.per_doc(_UPPER[data], offsets),
        W.per_doc(_LOUD[data], offsets),
        W.per_doc(echo, w.first),
    ]


@dataclass(frozen=True)
class Rule:
    """Looks at one count, or at its ratio to another.

    Votes bad outside `fair`; votes good inside `good`, if it can speak for a text at all; else
    abstains, as it does where the ratio is over nothing.
    """

    name: str
    family: str
    over: str
    under: str | None
    fair: tuple[float, float]
    good: tuple[float, float] | None = None

    def votes(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        """0 bad, 1 abstain, 2 good."""
        x = counts[self.over].astype(float)
        known = np.ones(len(x), bool)
        if self.under:
            known = counts[self.under] > 0
            x = x / np.maximum(counts[self.under], 1)
        out = np.ones(len(x), np.int64)
        if self.good:
            out[known & (x >= self.good[0]) & (x <= self.good[1])] = 2
        out[known & ((x < self.fair[0]) | (x > self.fair[1]))] = 0
        return out


MOST = float(1 << 60)
RULES = (
    Rule("length", "size", "n_words", None, (MIN_WORDS, MOST), (50, MOST)),
    Rule("word_length", "size", "word_chars", "n_words", (2, 12), (3, 9)),
    Rule("letters", "form", "n_letters", "word_chars", (0.9, 1)),
    Rule("symbols", "form", "n_symbols", "n_words", (0, 0.25)),
    Rule("repeats", "repetition", "n_repeat_words", "n_words", (0, MAX_REPEAT)),
    Rule("echoes", "repetition", "n_echoes", "n_words", (0, 0.15)),
    Rule("dup_lines", "repetition", "n_dup_lines", "n_lines", (0, 0.3)),
    Rule("upper_case", "shouting", "n_upper", "n_letters", (0, 0.4)),
    Rule("loud", "shouting", "n_loud", "n_words", (0, 0.3)),
)


def pattern(counts: dict[str, np.ndarray], rules: tuple[Rule, ...] = RULES) -> np.ndarray:
    """All votes as one number in base 3."""
    code = np.zeros(len(counts["n_words"]), np.int64)
    for rule in rules:
        code = code * 3 + rule.votes(counts)
    return code


def counts_udf(rules: tuple[Rule, ...], chances: np.ndarray | None = None) -> Callable[[Column], Column]:
    """The COUNTS of a text column with the pattern of votes and, from a table by pattern, P(good)."""

    @F.arrow_udf(COUNTS_TYPE)
    def counts(texts: pa.Array) -> pa.Array:
        parts = [np.stack(text_counts(part)) for _, part in W.slices(texts)]
        found = np.concatenate(parts, axis=1) if parts else np.zeros((len(COUNTS), 0), np.int64)
        code = pattern(dict(zip(COUNTS, found, strict=True)), rules)
        good = chances[code] if chances is not None else np.zeros(len(code))
        arrays = [*(pa.array(x.astype(np.int64)) for x in found), pa.array(code), pa.array(good)]
        return pa.StructArray.from_arrays(arrays, names=[*COUNTS, "pattern", "posterior"])

    return counts


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < MIN_WORDS) | (counts["n_repeat_words"] * 100 > counts["n_words"] * 30)


@dataclass(frozen=True)
class Votes:
    """What the fit found: the share of each class, and P(vote | class) by rule.

    Class 0 is good, the others are the families of faults. rates[j, c, v] is how often rule j
    votes v (bad, abstain, good) on texts of class c.
    """

    shares: np.ndarray
    rates: np.ndarray

    @property
    def accuracy(self) -> np.ndarray:
        """By rule: how often it is right when it does not abstain."""
        joint = self.rates * self.shares[None, :, None]
        return (joint[:, 0, 2] + joint[:, 1:, 0].sum(1)) / joint[:, :, [0, 2]].sum((1, 2))

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """P(class | votes), a row for each row of votes."""
        rules = np.arange(votes.shape[1])
        like = np.log(self.rates[rules, :, votes]).sum(1) + np.log(self.shares)
        like = np.exp(like - like.max(1, keepdims=True))
        return like / like.sum(1, keepdims=True)


def unpack(codes: np.ndarray, n_rules: int) -> np.ndarray:
    return np.stack([codes // 3**k % 3 for k in reversed(range(n_rules))], axis=1)


#: Where the fit starts, as P(bad, abstain, good): rules that can also vote good, and rules that
#: only find faults; each on good texts, on texts with its own family's faults, and on others'.
JUDGE = np.array([[0.02, 0.28, 0.70], [0.50, 0.40, 0.10], [0.02, 0.38, 0.60]])
DETECTOR = np.array([[0.01, 0.989, 0.001], [0.70, 0.299, 0.001], [0.05, 0.949, 0.001]])


def fit_votes(
    votes: np.ndarray, times: np.ndarray, rules: tuple[Rule, ...] = RULES, rounds: int = 300, weight: float = 20.0
) -> Votes:
    """Expectation-maximisation over vote combinations and how often each occurs.

    The start, held by `weight` pseudo-texts of each class, keeps the classes from changing
    places. Without any text the result is that start.
    """
    families = sorted({rule.family for rule in rules})
    own = np.array([[0] + [1 if rule.family == f else 2 for f in families] for rule in rules])
    start = np.stack([(JUDGE if rule.good else DETECTOR)[own[j]] for j, rule in enumerate(rules)])
    shares = np.array([0.7] + [0.3 / len(families)] * len(families))
    model = Votes(shares, start)
    onehot = (votes[:, :, None] == np.arange(3)).astype(float)
    for _ in range(rounds):
        share = model.classes(votes) * times[:, None] if len(votes) else np.zeros((0, len(shares)))
        seen = np.einsum("pc,pjv->jcv", share, onehot) + weight * start
        fitted = Votes((share.sum(0) + weight * shares) / (share.sum() + weight), seen / seen.sum(2, keepdims=True))
        done = abs(fitted.rates - model.rates).max() < 1e-9
        model = fitted
        if done:
            break
    return model


def fit_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> Votes:
    """Fit the rules' reliabilities on all documents."""
    counted = docs.select(counts_udf(rules)(F.col(text)).alias("c"))
    seen = counted.groupBy(F.col("c.pattern").alias("p")).count().collect()  # at most 3 ** len(rules) rows
    codes = np.array([r["p"] for r in seen], np.int64)
    return fit_votes(unpack(codes, len(rules)), np.array([r["count"] for r in seen], float), rules)


def score_rules(
    docs: DataFrame, model: Votes, text: str = "text", least: float = 0.5, rules: tuple[Rule, ...] = RULES, out: str = "quality"
) -> DataFrame:
    """Append a struct column `out`: the counts, base_failed, posterior and kept."""
    chances = model.classes(unpack(np.arange(3 ** len(rules)), len(rules)))[:, 0]
    c = F.col("__counts")
    verdict = F.struct(
        *(c[name].alias(name) for name in COUNTS),
        base_failed(c).alias("base_failed"),
        c["posterior"].alias("posterior"),
        (~base_failed(c) & (c["posterior"] >= least)).alias("kept"),
    )
    return docs.withColumn("__counts", counts_udf(rules, chances)(F.col(text))).withColumn(out, verdict).drop("__counts")


def filter_quality(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that the fitted rules keep, with their columns as they are."""
    scored = score_rules(docs, fit_rules(docs, text), text, least, out="__quality")
    return scored.where(F.col("__quality.kept")).drop("__quality")
