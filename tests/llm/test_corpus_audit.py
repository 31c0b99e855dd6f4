"""Source divergence, WARC archives and importance resampling against plain Python."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

from dayledger.llm import divergence, resample, warc  # noqa: E402
from dayledger.session import ship_package  # noqa: E402

LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(30_000))
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# Source divergence


def plain_divergence(rows, least_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        group = (lang or "", source or "")
        groups.add(group)
        found = Counter(TERM.findall(plain.lower(text or "")))
        counts[group] += found
        docs[group[0]] += Counter(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        named = sorted(s for g, s in groups if g == lang)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in named}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in named}
        whole = {t: sum(counts[lang, s][t] for s in named) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in named:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in named if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, values, limit in (("pair", pairs, None), ("term", terms, top)):
                values.sort(key=lambda v: (-v[1], v[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(values[:limit], 1)}
    return out


def odd_corpus():
    dice = np.random.default_rng(11)
    vocabulary = [f"{stem}{end}" for stem in "abcdé" for end in "vwxyzü"] + ["İ", "ß", "　", "K"]
    rows = [("en", "s0", None), ("en", "quiet", ""), ("en", None, "A1b a_B"), (None, None, "x"), ("lone", "only", LONG), ("none", "a", "1 2"), ("none", "b", None)]
    for i in range(90):
        words = dice.choice(vocabulary, int(dice.integers(1, 40)))
        rows.append((("en", "fr", None)[i % 3], f"s{0 if i % 2 else i % 5}", " ".join(words).upper() if i % 7 == 0 else "-".join(words)))
    return rows + rows[-3:] * 4


@pytest.mark.parametrize("cells", [(1 << 18, 1 << 22), (8, 16)])
def test_divergence(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = odd_corpus()
    docs = spark.createDataFrame([(t, s, g, 1, "x") for g, s, t in rows], "text STRING, source STRING, lang STRING, n INT, term STRING").repartition(5)
    got = divergence.source_divergence(docs, least_docs=3, top_terms=4).collect()
    want = plain_divergence(rows, 3, 4)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert divergence.source_divergence(docs.where("1 = 0")).count() == 0
    far = divergence.source_divergence(docs, least_docs=10_000).collect()
    assert far and all(r["part"] == "pair" and r["value"] == 0 for r in far)


def test_joint_price_by_products():
    dice = np.random.default_rng(2)
    levels = dice.poisson(2.0, size=(50, 9)).astype(np.int64)
    levels[:, 4] = 7
    rate = dice.integers(1, 10**9, size=(9, levels.max() + 1))
    prices = rate[np.arange(9), levels]
    want = np.abs(prices[:, :, None] - prices[:, None, :]).sum(0)
    for columns in (1, 7, 1000):
        assert (divergence.joint_price(levels, prices, columns) == want).all()


def test_share_has_no_overflow(spark):
    n, total = 4_000_000_000_000_000_000, 9_000_000_000_000_000_000
    found = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(3)).alias("p")).first()["p"]
    assert found == 1 + 10**9 * (n + 5) // (total + 15)


# WARC


def page_record(i, payload=None, **change):
    payload = payload if payload is not None else f"<p>page {i} {'x' * (i * 37 % 500)}</p>".encode()
    return warc.build_record(f"urn:page:{i}", f"http://a.example/{i}", payload, change.get("refers_to"), warc.base32_sha1(payload))


def ids(found):
    return [f.headers["warc-record-id"] for f in found if f.reason is None]


def covered(found, size):
    """Bytes of the file in records and gaps, which must not overlap."""
    at = 0
    for f in sorted((f for f in found if f.length), key=lambda f: f.offset):
        assert f.offset >= at
        at = f.offset + f.length
    assert at <= size
    return sum(f.length for f in found)


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_loses_only_what_is_damaged(packed):
    dice = np.random.default_rng(4)
    units = [warc.gzip_member(page_record(i)) if packed else page_record(i) for i in range(40)]
    starts = np.cumsum([0, *map(len, units)])
    whole = b"".join(units)
    assert ids(warc.salvage(whole)) == [f"<urn:page:{i}>" for i in range(40)] and not any(f.reason for f in warc.salvage(whole))
    for _ in range(60):
        data, hurt = bytearray(whole), set()
        for at in dice.integers(0, len(whole), 3):
            data[at] ^= int(dice.integers(1, 256))
            hurt.add(int(np.searchsorted(starts, at, "right")) - 1)
        found = list(warc.salvage(bytes(data)))
        missing = {i for i in range(40) if f"<urn:page:{i}>" not in ids(found)}
        assert missing <= hurt
        assert covered(found, len(data)) == len(data)
        if packed:  # a checksum covers all of a member but a few header bytes
            assert all(f.reason or f.headers["warc-payload-digest"] == "sha1:" + warc.base32_sha1(warc.split_http(f.block)[1]) for f in found)
            gaps = [(f.offset, f.offset + f.length) for f in found if f.reason]
            assert all(any(a <= starts[i] and starts[i + 1] <= b for a, b in gaps) for i in missing)


def test_salvage_of_cuts_junk_and_mixed_layouts():
    one, two, three = (page_record(i) for i in (1, 2, 3))
    packed = [warc.gzip_member(r) for r in (one, two, three)]
    names = ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    found = list(warc.salvage(b"junk" + packed[0] + b"\0\0" + two + b"\r\n" + b"more junk" + packed[2]))
    assert ids(found) == names and [(f.offset, f.length) for f in found if f.reason] == [(0, 4), (4 + len(packed[0]) + 2 + len(two) + 2, 9)]
    found = list(warc.salvage(packed[0] + packed[1][:-9] + packed[2]))
    assert ids(found) == [names[0], names[2]] and [f.length for f in found if f.reason] == [len(packed[1]) - 9]
    cut = list(warc.salvage(packed[0] + packed[1][: len(packed[1]) // 2]))
    assert ids(cut) == names[:1] and cut[-1].reason == "member is cut short"
    # One member that holds three records: all when sound, the whole ones of its head when cut.
    assert ids(warc.salvage(warc.gzip_member(one + two + three))) == names
    big = [page_record(i, hashlib.sha256(bytes([i])).hexdigest().encode() * 900) for i in range(6)]
    member = warc.gzip_member(b"".join(big))
    found = list(warc.salvage(member[: int(len(member) * 0.8)] + packed[0]))
    assert 3 <= len(ids(found)) - 1 < 6 and ids(found)[-1] == names[0] and sum(f.reason is not None for f in found) == 1
    wrong = one.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    found = list(warc.salvage(wrong + two))
    assert ids(found) == names[1:2] and found[0].offset == 0 and found[0].length == len(wrong)
    for text in (b"", b"\0\0\r\n", gzip.compress(b"")):
        assert list(warc.salvage(text)) == []
    for text in (b"no archive", gzip.compress(b"no record"), b"WARC/1.0\r\n", b"WARC/1.1\r\nno colon\r\n\r\n\r\n\r\n", b"\x1f\x8b\x08"):
        assert [f.reason is not None and (f.offset, f.length) == (0, len(text)) for f in warc.salvage(text)] == [True]
    # A payload that looks like a record stays inside its own.
    nested = page_record(7, two + packed[2])
    assert ids(warc.salvage(nested)) == ["<urn:page:7>"]


PAGES = [
    (1, "http://a/\r\nx: y", "same"), (2, None, "same"), (3, "http://b/", "same"), (4, "http://c/", None), (5, "http://d/", ""),
    (6, "http://é/", "é　\n" * 5), (7, "http://e/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (8, "http://f/", "x" * 20_000_000),
    (9, "http://g/", LONG), (9, "http://g/", LONG), (2, "http://twice/", "other"), (None, "http://n/", "same"), (None, "http://n/", "alone"), (10, "u", "\0\x1f"),
]


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    pages = spark.createDataFrame([(*p, "clash", "x") for p in PAGES], "page_id BIGINT, url STRING, html STRING, sha STRING, holder STRING").repartition(3)
    path = str(tmp_path_factory.mktemp("warc") / "archives")
    warc.write_archives(pages, path, records=3)
    return path


def test_archives_round_trip(spark, archived):
    read = warc.read_archives(spark, archived)
    assert warc.gaps(read).count() == 0
    rows = warc.records(read).withColumns({"page": warc.page_key("record_id").cast("bigint"), "of": warc.page_key("refers_to").cast("bigint")}).collect()
    assert len(rows) == len(PAGES)
    held = {}
    for i, _, html in PAGES:
        held[html or ""] = max(held.get(html or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, html in PAGES:
        payload, holder = (html or "").encode(), held[html or ""]
        refers = holder if holder >= 0 and i != holder else None
        want[i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if refers is None else "revisit", refers, None if refers is not None else payload] += 1
    assert Counter((r["page"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["of"], bytes(r["payload"]) if r["payload"] is not None else None) for r in rows) == want
    assert {r["target_uri"] for r in rows if r["page"] == 1} == {"http://a/ x: y"}
    # Any gzip reader can read an archive.
    files = glob.glob(f"{archived}/part-*")
    assert len(files) >= 5
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\nWARC-Type: re") for f in files) == len(PAGES) + 1


def test_damaged_archives_are_read_on(spark, archived, tmp_path):
    data = bytearray(b"".join(Path(f).read_bytes() for f in sorted(glob.glob(f"{archived}/part-*"))))
    members = [f.offset for f in warc.salvage(bytes(data))]
    data[members[2] + 40 : members[2] + 60] = b"\0" * 20
    (tmp_path / "broken.warc.gz").write_bytes(data)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    read = warc.read_archives(spark, str(tmp_path), with_payload=False)
    assert warc.records(read).count() == len(PAGES) - 1 and warc.records(read).where("payload is not null").count() == 0
    gap = warc.gaps(read).collect()
    assert [(g["offset"], g["length"]) for g in gap] == [(members[2], members[3] - members[2] - (data[members[3] - 1] == 0 and 0))]
    assert gap[0]["path"].endswith("broken.warc.gz") and gap[0]["gap_reason"]


def test_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id INT, url STRING, html STRING"), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


# Importance resampling


def plain_resampling(docs, target, max_words, buckets, percent, least):
    def features(text):
        words = plain.ALNUM.findall(plain.lower(text or ""))
        grams = [" ".join(words[i : i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]
        return len(words), Counter(zlib.crc32(g.encode()) % buckets for g in grams)

    s, t = Counter(), Counter()
    own = [(i, *features(text)) for i, text in docs]
    for _, _, f in own:
        s += f
    for text in target:
        t += features(text)[1]
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in range(buckets)]
    out = []
    for i, n, f in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * k for b, k in f.items())
        out.append([i, n, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(fit[: len(fit) * percent // 100], 1):
        r[5] = rank
    return Counter(map(tuple, out))


CORPUS = [
    (1, None), (2, ""), (3, " \t-_"), (4, "Word"), (5, "é ü 　"), (6, LONG), (7, LONG), (8, "a" * 200_000), (9, "a b " * 30), (9, "a b " * 30),
    (None, "c d " * 30), (None, None), *((20 + i, f"a b{i % 4}_c " * 12) for i in range(40)),
]


@pytest.mark.parametrize("max_words", [1, 3])
def test_resampling(spark, max_words):
    docs = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in CORPUS], "doc_id BIGINT, text STRING, _by STRING, score INT, Resampled INT").repartition(4)
    target = ["A B1 c", None, "", "word é", "b1 c a"]
    tests = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text STRING, item_id INT")
    found = resample.resample(docs, tests, max_words=max_words, buckets=97, percent=30, least_words=12)
    assert found.columns == ["doc_id", "text", "_by", "score", "resampled"]
    rows = found.select("doc_id", "resampled.*").collect()
    assert Counter(map(tuple, rows)) == plain_resampling(CORPUS, target, max_words, 97, 30, 12)
    drawn = resample.draw(docs, tests, max_words=max_words, buckets=97, percent=30, least_words=12)
    assert drawn.columns == ["doc_id", "text", "_by", "score"]
    assert drawn.count() == sum(r["rank"] is not None for r in rows) and set(drawn.select("doc_id", "text").collect()) <= set(docs.select("doc_id", "text").collect())
    narrow = resample.resample(docs, tests, max_words=max_words, keep_text=False)
    assert narrow.columns == ["doc_id", "_by", "score", "resampled"]
    assert resample.resample(docs.where("1 = 0"), tests).count() == 0
    nothing = resample.resample(docs, tests.where("1 = 0"), max_words=max_words, buckets=97, percent=30, least_words=12)
    assert Counter(map(tuple, nothing.select("doc_id", "resampled.*").collect())) == plain_resampling(CORPUS, [], max_words, 97, 30, 12)


def test_overlapped_spans_are_every_run_of_words():
    text = "A-b_c  dé E1"
    words = resample.collapsed(text)
    assert words == "a b c dé e1".encode()
    for n, want in ((1, 5), (2, 4), (5, 1), (6, 0)):
        own = words.decode().split()
        spans = [m.group().decode() for m in resample.ngram_pattern(n).finditer(words, overlapped=True)]
        assert spans == [" ".join(own[i : i + n]) for i in range(want)]
