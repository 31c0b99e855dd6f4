"""The operators' results in plain Python, row by row, to hold the queries against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = SPACED.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_groups(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """id -> (set size, smallest id reachable); pairs that share no shingle are not looked at."""
    sets = {i: shingles(t) for i, t in docs}
    owner = {i: i for i in sets}

    def root(i: int) -> int:
        while owner[i] != i:
            i = owner[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                owner[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def without_repeats(docs: list[tuple[int, str | None]], window: int = 50) -> dict[int, tuple[int, int, str]]:
    words = {i: SPACED.findall(t or "") for i, t in docs}
    first: dict[tuple[str, ...], int] = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, own in words.items():
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(own), sum(gone), sha(" ".join(w for w, g in zip(own, gone, strict=True) if not g)))
    return out


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            repeat[i : i + 8] = [True] * 8
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(repeat)


def base_secrets(text: str | None) -> list[tuple[int, int, str]]:
    text, out = text or "", []
    for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), m.end(), "assign"))
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return out


def contaminated(text: str | None, items: list[tuple[object, str | None]], window: int = 10) -> tuple[int, int, list[str]]:
    """(words, hit words, ids of occurring items, as text in order)."""
    words = ALNUM.findall(lower(text or ""))
    hit, found = [False] * len(words), set()
    grams = defaultdict(set)
    for item, body in items:
        own = ALNUM.findall(lower(body or ""))
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            grams[tuple(own[k : k + n])].add(str(item))
    for n in {len(g) for g in grams}:
        for k in range(len(words) - n + 1):
            if (ids := grams.get(tuple(words[k : k + n]))) is not None:
                found |= ids
                hit[k : k + n] = [True] * n
    return len(words), sum(hit), sorted(found)


def token_pieces(ids: list[int], capacity: int = 2048) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids with the separator."""
    ids = [*ids, 0]
    edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
    crc = lambda part: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    return [(k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
