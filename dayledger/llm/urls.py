"""URL filters by a bit-parallel wildcard automaton.

Every glob rule becomes a run of bits in one long state word. Reading a byte moves all rules on
at once: shift by one, and with the byte's mask, and keep the bits whose wildcard takes the
byte (Shift-And with self-loops). The state spans as many 64-bit words as the rules need, and
all URLs of a batch step together.

Globs: `?` one byte but `/`, `*` any run without `/`, `**` any run. A canonical URL is the host,
A-Z lower-cased, with the path, without query and fragment. A site rule (host, path) stands for
two globs: the host itself, and anything before a dot and the host; then the path and any rest.

Defined results: a null URL or one without `://` has an empty host and path; no site rule fits
it and the globs judge the empty string; repeated rows are judged each.

Columns: an input column named like the result is replaced; names that begin with two underscores are the
operator's own and may be replaced or dropped; all others come back unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm import words as W

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class SiteRule:
    """A verdict for a host with all its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.name}**", f"*.{self.name}**"


#: What the method itself blocks, where no site rule speaks: no host, mobile mirrors, logins,
#: shops' baskets, downloads, calendars and feeds.
BLOCKED = (
    "",
    "/**",
    "m.*/**",
    "mobile.*/**",
    "**/login**",
    "**/signin**",
    "**/cart/**",
    "**/basket/**",
    "**/wp-admin/**",
    "**/calendar/????/??/**",
    "**/feed",
    "**/feed/",
    "**.exe",
    "**.zip",
    "**.apk",
)


class Globs:
    """Glob patterns as one bit-parallel automaton over bytes."""

    def __init__(self, patterns: list[str]):
        steps: list[tuple[int, np.ndarray | None]] = []  # (pattern, bytes that lead into this bit; none for a first bit)
        loops: dict[int, np.ndarray] = {}
        self.finals: list[int] = []
        for p, pattern in enumerate(patterns):
            steps.append((p, None))
            raw, i = pattern.encode(), 0
            while i < len(raw):
                byte = raw[i : i + 1]
                if byte == b"*":
                    every = raw[i : i + 2] == b"**"
                    taken = np.ones(256, bool)
                    taken[0x2F] = every
                    loops[len(steps) - 1] = loops.get(len(steps) - 1, np.zeros(256, bool)) | taken
                    i += 2 if every else 1
                    continue
                into = np.zeros(256, bool)
                if byte == b"?":
                    into[:] = True
                    into[0x2F] = False
                else:
                    into[raw[i]] = True
                steps.append((p, into))
                i += 1
            self.finals.append(len(steps) - 1)
        width = max(1, -(-len(steps) // 64))
        self.into, self.stay = np.zeros((256, width), np.uint64), np.zeros((256, width), np.uint64)
        self.start = np.zeros(width, np.uint64)
        for bit, (_, into) in enumerate(steps):
            one = np.uint64(1) << np.uint64(bit % 64)
            if into is None:
                self.start[bit // 64] |= one
            else:
                self.into[into, bit // 64] |= one
            if bit in loops:
                self.stay[loops[bit], bit // 64] |= one

    def matches(self, texts: pa.Array) -> np.ndarray:
        """matches[i, p]: does pattern p fit the whole of text i?"""
        data, offsets = W.text_bytes(texts)
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        begin, still = offsets[:-1][order], -length[order]
        state = np.repeat(self.start[None], len(length), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(length.max(initial=0))):
            n = int(np.searchsorted(still, -at, "left"))  # texts longer than `at` come first
            now = state[:n]
            byte = data[begin[:n] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:n] = (moved & self.into[byte]) | (now & self.stay[byte])
        out = np.empty((len(length), len(self.finals)), bool)
        for p, bit in enumerate(self.finals):
            out[order, p] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one != 0
        return out


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: list[SiteRule], blocked: tuple[str, ...] = BLOCKED, url: str = "url", out: str = "filter") -> DataFrame:
    """Append a struct column `out`: host, path, rule and verdict.

    The longest fitting site rule wins; of equally long ones a block, then the first in order.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    globs = Globs([glob for rule in ranked for glob in rule.globs] + list(blocked))
    names = np.array([rule.name for rule in ranked] + [None], object)
    verdicts = np.array([rule.verdict for rule in ranked], object)

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def judge(canonical: pa.Array) -> pa.Array:
        fits = globs.matches(canonical)
        site = fits[:, : 2 * len(ranked)].reshape(len(fits), len(ranked), 2).any(2)
        best = np.where(site.any(1), site.argmax(1) if len(ranked) else 0, len(ranked))
        own = np.where(fits[:, 2 * len(ranked) :].any(1), "block", "allow").astype(object)
        verdict = np.append(verdicts, None)[best]
        verdict = np.where(best == len(ranked), own, verdict)
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(verdict, pa.string())], names=["rule", "verdict"])

    both = pages.withColumn("__host", host_of(F.col(url))).withColumn("__path", path_of(F.col(url)))
    found = both.withColumn("__judged", judge(F.concat("__host", "__path")))
    whole = F.struct(F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__judged.rule").alias("rule"), F.col("__judged.verdict").alias("verdict"))
    return found.withColumn(out, whole).drop("__host", "__path", "__judged")
