"""The ten operators against plain Python, on the given tables and on awkward rows."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import plain  # noqa: E402

from dayledger.llm import chat, classifier, contamination, neardup, packing, quality, repeats, secrets, toxicity, urls  # noqa: E402
from dayledger.llm.queries import QUERIES, SITE_RULES, TOKENIZER  # noqa: E402
from dayledger.session import ship_package  # noqa: E402

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(80))
AWKWARD = [
    (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (9, "one two"), (10, "ONE two"), (11, LONG), (12, LONG), (13, LONG + " tail"),
    (14, "a b c " + PASSAGE), (15, PASSAGE + " z y"), (16, "q " * 300), (17, "q " * 300), (18, "x\u00a0y \u3000 z"), (8, "one two"), (None, PASSAGE), (None, None),
]


@pytest.fixture(scope="module")
def awkward(spark):
    ship_package(spark)
    rows = [(i, t, "clash", 1) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, keys STRING, n_words INT").repartition(3)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.where("1 = 0")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    ship_package(spark)
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


KNOWN = [(i, t) for i, t in AWKWARD if i is not None]


def test_near_duplicates(spark, sf_dir, docs, awkward, empty):
    got = by_id(QUERIES["op1_minhash_dedup"](spark, sf_dir).collect())
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == plain.near_groups(docs)
    rows = neardup.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    want = plain.near_groups(KNOWN)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None} == want
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert neardup.near_duplicates(empty).count() == 0
    left = neardup.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == sorted(i for i, _ in KNOWN if want[i][1] == i)


def test_a_dense_group_beyond_every_block(spark, awkward):
    dice = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(140):
        own = list(base)
        for at in dice.choice(120, int(dice.integers(0, 12)), replace=False):
            own[at] = f"e{i}_{at}"
        texts.append((i, " ".join(own)))
    rows = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    got = neardup.near_duplicates(rows, small=16, block=8).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_groups(texts)


def family(n, words, common, seed):
    """Texts that have a share of their words in common, at the same places."""
    dice = np.random.default_rng(seed)
    same = dice.random(words) < common
    return [(i, " ".join(f"b{k}" if same[k] else f"e{i}_{k}" for k in range(words))) for i in range(n)]


def spied_tasks(monkeypatch):
    """Rows of the table of comparisons, by call."""
    seen = []
    write = neardup.Scratch.__call__

    def spy(self, rows, name):
        kept = write(self, rows, name)
        if name == "tasks":
            seen.append(kept.count())
        return kept

    monkeypatch.setattr(neardup.Scratch, "__call__", spy)
    return seen


def test_a_family_of_unlike_texts_is_not_compared(spark, awkward, monkeypatch):
    seen = spied_tasks(monkeypatch)
    made = []
    for n in (150, 300):
        texts = family(n, 150, 0.93, 5)  # shingle similarity about 0.5
        texts += [(1000 + i, f"{t} tail") for i, t in texts[:20]]  # each of these links with one
        rows = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
        seen.clear()
        got = neardup.near_duplicates(rows, small=16, block=8).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_groups(texts)
        made.append(sum(seen))
    assert made[1] <= 2 * made[0] + 300


@pytest.mark.parametrize("common", [0.3, 0.9, 0.965])
def test_links_among_boilerplate(spark, awkward, common):
    dice = np.random.default_rng(9)
    texts = family(120, 160, common, 6)
    for i in range(60):  # copies of some with more and more changes, around the border
        words = texts[i][1].split()
        for k, at in enumerate(dice.choice(160, 1 + i // 8, replace=False)):
            words[at] = f"z{i}_{k}"
        texts.append((500 + i, " ".join(words)))
    rows = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    got = neardup.near_duplicates(rows, small=16, block=8).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.near_groups(texts)


def test_repeats(spark, sf_dir, docs, awkward, empty):
    got = by_id(QUERIES["op2_substring_dedup"](spark, sf_dir).collect())
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == plain.without_repeats(docs)
    rows = repeats.remove_repeats(awkward).select("doc_id", "repeats.*").collect()
    assert len(rows) == len(AWKWARD)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows if r["doc_id"] is not None} == plain.without_repeats(KNOWN)
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] is None)
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_of_ids_with_several_texts(spark, awkward):
    p, q = (" ".join(f"{stem}{i}" for i in range(60)) for stem in "pq")
    rows = [(1, p), (2, q), (5, p), (5, f"{q} tail"), (9, f"x {q} tail y"), (9, f"x {q} tail y"), (10, f"a {p}"), (10, p), (12, f"{p} b"), (12, q)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    got = repeats.remove_repeats(docs).select("doc_id", "text", "repeats.n_removed").collect()
    want = {(1, p): 0, (2, q): 0, (5, p): 60, (5, f"{q} tail"): 60, (9, f"x {q} tail y"): 61, (10, f"a {p}"): 60, (10, p): 60, (12, f"{p} b"): 60, (12, q): 60}
    assert len(got) == len(rows) and {(r["doc_id"], r["text"]): r["n_removed"] for r in got} == want


def test_quality(spark, sf_dir, docs, awkward, empty):
    rows = by_id(QUERIES["op3_quality_rules"](spark, sf_dir).collect())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {i: tuple(r[n] for n in names) for i, r in rows.items()} == {i: plain.base_counts(t) for i, t in docs}
    more = str(Path(sf_dir).parent / "sf0.01")  # 11 texts labelled junk are too few to judge by
    rows = by_id(QUERIES["op3_quality_rules"](spark, more).collect())
    labels = spark.read.parquet(f"{more}/labels.parquet").collect()
    sound = [rows[r["doc_id"]] for r in labels if r["quality"] == 1 and not rows[r["doc_id"]]["base_failed"]]
    junk = [rows[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert np.mean([r["kept"] for r in sound]) > 0.97 and np.mean([r["kept"] for r in junk]) < 0.1
    scored = quality.score_rules(awkward, quality.fit_rules(awkward)).collect()
    assert sorted((r["doc_id"] or -1, *(r["quality"][n] for n in names)) for r in scored) == sorted((i or -1, *plain.base_counts(t)) for i, t in AWKWARD)
    assert quality.filter_quality(empty).collect() == []


def test_url_filter(spark, sf_dir):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://ORG"), (5, "http://a.Example.ORG/en/12?x"), (6, "x://example.org/es/a/b#c"), (7, "http://xorg/"), (8, "http://notexample.org/es/"), (9, "http://a.net/" + "y" * 5000 + ".exe"), (10, "http://a.com/calendar/2024/05/x"), (11, "http://é.com/fr/é")]
    pages = spark.createDataFrame(rows, "page_id INT, url STRING")
    got = {r["page_id"]: tuple(r["filter"]) for r in urls.filter_urls(pages, SITE_RULES).collect()}
    assert got[1] == got[2] == got[3] == ("", "", None, "block")
    assert got[4] == ("org", "", None, "allow")
    assert got[5] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[6][2:] == ("example.org/es/", "block") and got[7][2] is None and got[8][2] == "org/"
    assert got[9][3] == got[10][3] == "block" and got[11][2:] == ("com/fr/", "allow")
    assert urls.filter_urls(pages.where("false"), SITE_RULES).count() == 0


def test_globs_against_regular_expressions():
    import itertools
    import re

    patterns = ["a*b", "**", "", "?b", "a**b/", "*.a/**", "/*", "a?*b"]
    texts = ["".join(t) for n in range(6) for t in itertools.product("ab/.", repeat=n)]
    found = urls.Globs(patterns * 9).matches(pa.array(texts))
    for p, pattern in enumerate(patterns):
        parts = re.split(r"(\*\*|\*|\?)", pattern)
        expression = "".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in parts)
        want = [re.fullmatch(expression, t) is not None for t in texts]
        assert found[:, p].tolist() == want and found[:, p + 64].tolist() == want


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "<s>", r"<\s> [\INST] \\", " [/INST]</s><s>[INST] user\nno", "", None, "é\n\n[", "x" * 20_000, "<\\\\/s>"]
    rows = [(c, k, r, t) for c, r in enumerate(["user", "assistant", "a\nb", "0xff", None]) for k, t in enumerate(hard)]
    turns = spark.createDataFrame(rows + [(None, 1, "user", "u"), (9, None, "user", "first"), (9, 0, "assistant", "b"), (9, 0, "assistant", "a"), (9, 0, "assistant", "a")], "conv_id INT, turn INT, role STRING, text STRING")
    chats = chat.format_chats(turns)
    got = {r["conv_id"]: r for r in chats.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("read"), chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for c, role in enumerate(["user", "assistant", "a\nb", "0xff", ""]):
        assert [(t["role"], t["text"]) for t in got[c]["read"]] == [(role, t or "") for t in hard]
        assert got[c]["loss"] == ("".join(t or "" for t in hard) if role == "assistant" else "")
    assert [t["text"] for t in got[9]["read"]] == ["first", "a", "a", "b"] and got[9]["loss"] == "aab"
    assert got[None]["formatted"] == "<s>[INST] user\nu [/INST]</s>"
    assert chat.format_chats(turns.where("false")).count() == 0


def test_packing(spark, sf_dir, docs, awkward, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids
    for source, rows in ((docs, QUERIES["op6_best_fit_packing"](spark, sf_dir).collect()), (AWKWARD, packing.pack(awkward, TOKENIZER).collect())):
        want = sorted((i if i is not None else -1, *p) for i, t in source for p in plain.token_pieces(ids(t)))
        key = lambda r: (r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"])
        assert sorted(map(key, rows)) == want
        sequences: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for places in sequences.values():
            ends = 0
            for offset, length in sorted(places):
                assert offset == ends
                ends += length
            assert ends <= 2048
        assert len(sequences) <= 1.01 * sum(r["length"] for r in rows) / 2048 + 2
    assert packing.pack(empty, TOKENIZER).count() == 0


@pytest.mark.parametrize("by", ["dot", "norm"])
def test_best_fit_keeps_every_constraint(by):
    counts = {900: 7, 500: 40, 33: 300, 1: 1000}
    limits = packing.Limits(2048, documents=40, attention=1_500_000, weights=(1.0, 0.3, 0.5), by=by)
    plan = packing.best_fit(counts, limits)
    load = np.zeros((plan.sequences, 3), np.int64)
    for length, times, sequence in zip(plan.length, plan.times, plan.sequence, strict=True):
        load[sequence : sequence + times] += [length, 1, length**2]
    assert load[:, 1].sum() == sum(counts.values()) and (load <= [2048, 40, 1_500_000]).all()


def test_production_packs_by_every_dimension(spark, awkward, tmp_path):
    import corpus_pipeline as p

    texts = spark.createDataFrame([(i, "a" if i % 30 else "b " * 400) for i in range(600)], "doc_id BIGINT, text STRING")
    texts.write.parquet(str(tmp_path / "documents.parquet"))
    for rows in (QUERIES["op6_best_fit_packing"](spark, str(tmp_path)).collect(), p.best_fit_packing(spark, texts, "").collect()):
        load: dict[int, np.ndarray] = {}
        for r in rows:
            load[r["sequence_id"]] = load.get(r["sequence_id"], 0) + np.array([r["length"], 1, r["length"] ** 2])
        loads = np.array(list(load.values()))
        assert sorted(r["doc_id"] for r in rows) == list(range(600)) and (loads[:, [0, 2]] <= packing.SEQUENCE.capacity[[0, 2]]).all()
        # Ten sequences of at most 64 documents hold these texts, five do without that bound.
        assert len(loads) == 5 and loads[:, 1].max() <= 512
    assert all(packing.SEQUENCE.weights)


def test_document_capacity_costs_no_sequence():
    short = {1: 20_000, 2000: 10}
    assert packing.best_fit(short, packing.SEQUENCE).sequences > 300
    plan = packing.fewest_sequences(short, packing.SEQUENCE)
    assert plan.sequences == packing.best_fit(short, packing.Limits()).sequences == 20
    roomy = {2048: 5, 700: 90}
    assert packing.fewest_sequences(roomy, packing.SEQUENCE).sequences == packing.best_fit(roomy, packing.SEQUENCE).sequences


def test_added_tokens_are_encoded_as_the_tokeniser_does(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["<|endoftext|>", "a b<|endoftext|> c\n\n<|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|>\u00a0x", "plain words"]
    assert 50256 in tokenizer.encode(texts[0], add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    rows = packing.pack(docs, TOKENIZER).collect()
    want = {(i, *p) for i, t in enumerate(texts) for p in plain.token_pieces(tokenizer.encode(t, add_special_tokens=False).ids)}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want


def test_classifier(spark, sf_dir, docs, awkward, empty):
    rows = by_id(QUERIES["op7_quality_classifier"](spark, sf_dir).collect())
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    labels = spark.createDataFrame([(11, 1), (14, 1), (16, 0), (17, 0), (8, None), (None, 1), (11, 0)], "doc_id BIGINT, quality INT")
    scored = classifier.score_texts(awkward, classifier.train(awkward, labels)).collect()
    assert len(scored) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in scored)
    nothing = classifier.train(empty, labels.where("false"))
    assert {r["score"] for r in classifier.score_texts(awkward, nothing).collect()} != set() and classifier.score_texts(empty, nothing).count() == 0


def test_machine_interaction_identity():
    dice = np.random.default_rng(5)
    machine = classifier.Machine(0.3, dice.normal(size=classifier.N_FEATURES), dice.normal(size=(classifier.N_FEATURES, 3)))
    feature, value = np.array([4, 9, 700]), np.array([0.5, -1.0, 2.0])
    raw = machine.bias + machine.linear[feature] @ value
    raw += sum(machine.factors[feature[i]] @ machine.factors[feature[j]] * value[i] * value[j] for i in range(3) for j in range(i + 1, 3))
    assert machine._sums(np.array([0, 3]), feature, value)[0][0] == pytest.approx(raw)


def test_toxicity(spark, awkward, empty):
    mild, foul = ["calm day by the river"] * 120, ["you vile worm again vile" if i % 2 else "what a vile thing" for i in range(60)]
    docs = spark.createDataFrame([(i, f"{t} n{i}") for i, t in enumerate(mild + foul)], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, int(i >= 120)) for i in range(180)], "doc_id BIGINT, toxic INT")
    model = toxicity.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.score_toxicity(docs, model).select("doc_id", "toxicity.*").collect()
    assert all(r["toxic"] == (r["doc_id"] >= 120) for r in rows)
    assert toxicity.score_toxicity(awkward, model).count() == len(AWKWARD) and toxicity.score_toxicity(empty, model).count() == 0
    never = toxicity.train(docs, labels.where("toxic = 0"))
    assert not any(r["toxicity"]["toxic"] for r in toxicity.score_toxicity(docs, never).collect())


def test_secrets(spark, sf_dir, docs, awkward, empty):
    rows = by_id(QUERIES["op9_secret_scan"](spark, sf_dir).collect())
    for i, t in docs:
        assert rows[i]["base_sha256"] == plain.sha(secrets.joined(plain.base_secrets(t)))
    assert secrets.find_secrets(awkward).where("secrets.spans <> ''").count() == 0 and secrets.redact_secrets(empty).count() == 0
    clean = secrets.redact_secrets(awkward)
    assert sorted(map(str, clean.collect())) == sorted(map(str, awkward.collect()))


def test_structural_confirmation():
    import base64
    import json

    tlv = lambda tag, body: bytes([tag, len(body)]) + body if len(body) < 128 else bytes([tag, 0x82]) + len(body).to_bytes(2, "big") + body
    key = tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes([1 + i] * 60)) for i in range(8)))
    text = base64.b64encode(key).decode()
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")
    kinds = lambda t: [k for _, _, k in secrets.method_spans(t)]
    assert kinds(f"x {text} y") == ["der"] and kinds(f"x {key.hex()} y") == ["der"]
    assert kinds(text[:-8]) == [] and kinds("QUJD" * 20) == []
    assert kinds(f"see {head}.eyJhIjoxfQ.c2ln ok") == ["token"] and kinds("version.number.three long.words.here") == []
    assert "pem" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{text}\n-----END RSA PRIVATE KEY-----")
    locked = base64.b64encode(bytes(range(100, 220))).decode()
    for end in ("\n", "\r\n", "\\n", "\\r\\n"):
        rsa = ["-----BEGIN RSA PRIVATE KEY-----", "Proc-Type: 4,ENCRYPTED", "DEK-Info: DES-EDE3-CBC,0123456789ABCDEF", "", locked[:64], locked[64:], "-----END RSA PRIVATE KEY-----"]
        pgp = ["-----BEGIN PGP PRIVATE KEY BLOCK-----", "Version: GnuPG v1.4.9 (GNU/Linux)", "Comment: two lines:", "  of it", "", locked[:64], locked[64:], "=aB3/", "-----END PGP PRIVATE KEY BLOCK-----"]
        for lines in (rsa, pgp, [pgp[0], *pgp[4:]]):
            t = f"see {end.join(lines)} there"
            assert [x for x in secrets.method_spans(t) if x[2] == "pem"] == [(4, len(t) - 6, "pem")]
            assert secrets.redact(t, secrets.method_spans(t), "#") == "see # there"
    assert kinds("-----BEGIN PGP MESSAGE-----\nVersion: 1\n\n" + locked[:64] + "\n=aB3/\n-----END PGP MESSAGE-----") == []
    assert kinds("-----BEGIN RSA PRIVATE KEY-----\nnot a header\n\n" + locked[:60] + "!\n-----END RSA PRIVATE KEY-----") == []
    spans = lambda t: [(t[a:b], k) for a, b, k in secrets.method_spans(t)]
    assert spans(f"see https://a.example/keys/v1/{text} there") == [(text, "der")]
    assert spans(f"see https://a.example/keys/M/{text[:-8]} there") == [] == spans("https://a.example/" + "Mab/" * 200)
    for end in ("\n", "\r\n", "\\n"):
        wrapped = end.join(text[i : i + 64] for i in range(0, len(text), 64))
        assert spans(f"key: {wrapped} and") == [(wrapped, "der")]
        assert spans(f"key={wrapped}{end}andmoretextfollowshere on") == [(wrapped, "der")]
        assert spans(f"{wrapped[:-70]}{end}") == []
    block = f"-----BEGIN RSA PRIVATE KEY-----\n{text}\n-----END RSA PRIVATE KEY-----\n"
    twice = base64.b64encode(block.encode()).decode()
    assert spans(f"data: {twice};") == [(twice, "pem")] and spans(base64.b64encode(b"-----BEGIN RSA PRIVATE KEY-----\nno").decode()) == []
    colons = ":".join(key.hex()[i : i + 2] for i in range(0, 2 * len(key), 2))
    assert spans(f"raw {colons} end") == [(colons, "der")] and spans(colons[:-6]) == []
    lines = ":\n    ".join(colons[i : i + 44] for i in range(0, len(colons), 45))
    assert spans(f"raw\n    {lines}\n") == [(lines, "der")]
    long = "A1b/" * 250_000
    assert spans(long) == [] == spans("aa:" * 100_000) and spans("MIIE" * 100_000) == []
    ssh = base64.b64encode(b"\0\0\0\x0bssh-ed25519\0\0\0\x20" + bytes(range(32))).decode()
    assert kinds(f"ssh-ed25519 {ssh} me") == ["openssh"]
    assert kinds(f"https://a.example/{ssh}") == ["openssh"]


def test_contamination(spark, sf_dir, docs, awkward, empty):
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = by_id(QUERIES["op10_decontamination"](spark, sf_dir).collect())
    for i, t in docs:
        n, hit, found = plain.contaminated(t, items)
        assert (rows[i]["n_words"], rows[i]["n_hit"], rows[i]["n_items"], rows[i]["items_sha256"]) == (n, hit, len(found), plain.sha(",".join(found)))
    odd = [(1, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 other"), (2, "one"), (3, None), (4, ""), (5, "q q q"), (2, "one"), (6, "p30 P31 p32"), (7, " ".join(f"p{i}" for i in range(40, 75)))]
    tests = spark.createDataFrame(odd, "item_id INT, text STRING")
    for block in (50_000, 1):
        found = contamination.find_contamination(awkward, tests, block_words=block).collect()
        got = sorted((r["doc_id"] or -1, r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"]) for r in found)
        assert got == sorted((i or -1, *plain.contaminated(t, odd)) for i, t in AWKWARD)
    left = contamination.decontaminate(awkward, tests, max_share=1.0)
    assert left.columns == awkward.columns and left.count() == len(AWKWARD)
    assert all(plain.contaminated(r["text"], odd)[1] == 0 for r in left.collect())
    assert contamination.find_contamination(empty, tests).count() == 0
    assert contamination.find_contamination(awkward, tests.where("false")).where("hits.n_hit > 0").count() == 0


def test_decontaminate_does_not_depend_on_blocks(spark, awkward):
    run = lambda stem, a, b: " ".join(f"{stem}{i}" for i in range(a, b))
    items = [(1, run("a", 1, 21)), (2, f"{run('a', 1, 21)} {run('b', 1, 10)}"), (3, f"{run('u', 0, 6)} {run('v', 0, 6)}"), (4, run("c", 0, 12)), (5, "one two")]
    texts = [
        (1, f"{run('x', 0, 60)} {run('a', 1, 21)} {run('b', 1, 10)} {run('y', 0, 60)}"),
        (2, f"{run('x', 0, 60)} {run('u', 0, 6)} {run('c', 0, 12)} {run('v', 0, 6)}"),  # the removal of item 4 makes item 3
        (3, f"{run('x', 0, 30)} {run('a', 1, 21)} {run('c', 0, 12)}"),  # more than half over two items, less in each
        (4, None),
        (5, "one one two two"),
    ]
    tests = spark.createDataFrame(items, "item_id INT, text STRING").coalesce(1)
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    left = lambda block, **more: sorted(map(tuple, contamination.decontaminate(docs, tests, block_words=block, **more).collect()))
    for more in ({}, {"max_share": 1.0}, {"max_words": 2}, {"max_words": 15, "max_share": 1.0}):
        assert left(1, **more) == left(50_000, **more)
    whole = dict(left(1))
    assert 3 not in whole and whole[1].split() == f"{run('x', 0, 60)} {run('y', 0, 60)}".split() and whole[2].split() == run("x", 0, 60).split()


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = p.quality_rules(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    whole = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert {i for i, _ in whole} <= {i for i, t in ((r["doc_id"], r["text"]) for r in docs.collect()) if plain.base_counts(t)[0] >= 20}
    groups = plain.near_groups(whole)
    single = p.minhash_dedup(spark, kept, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    assert set(texts) == {i for i, (_, c) in groups.items() if i == c}
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = p.decontamination(spark, single, sf_dir)
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == docs.columns
    for i, t in texts.items():
        n, hit, _ = plain.contaminated(t, items)
        assert after.get(i) == t if not hit else (i not in after) == (hit > 0.5 * n) and (i not in after or plain.contaminated(after[i], items)[1] == 0)
    masked = {r["doc_id"]: r["text"] for r in p.secret_scan(spark, clean, sf_dir).collect()}
    assert all(masked[i] == t if not plain.base_secrets(t) else "[secret]" in masked[i] and not plain.base_secrets(masked[i]) for i, t in after.items())
    assert {r["doc_id"] for r in p.run(spark, sf_dir).select("doc_id").collect()} == set(after)


def test_clashing_columns_have_a_defined_result(spark, awkward):
    """The result replaces a column of its name; every other column is as it was."""
    docs = awkward.select("doc_id", "text", *(F.lit("mine").alias(n) for n in ("quality", "hits", "secrets", "filter", "repeats", "score", "toxicity", "keys", "kept", "label", "__id")), F.lit(7).alias("n_words"))
    tests = spark.createDataFrame([(1, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11", "x")], "item_id INT, text STRING, hits STRING")
    labels = spark.createDataFrame([(11, 1, 0, "x"), (14, 1, 1, "y"), (16, 0, 0, "z")], "doc_id BIGINT, quality INT, toxic INT, label STRING")
    found = {
        "quality": quality.score_rules(docs, quality.fit_rules(docs)),
        "hits": contamination.find_contamination(docs, tests),
        "secrets": secrets.find_secrets(docs),
        "repeats": repeats.remove_repeats(docs),
        "score": classifier.score_texts(docs, classifier.train(docs, labels)),
        "toxicity": toxicity.score_toxicity(docs, toxicity.train(docs, labels)),
    }
    for name, rows in found.items():
        others = [c for c in docs.columns if c not in (name, "__id")]
        assert rows.count() == len(AWKWARD) and dict(rows.dtypes)[name] != "string", name
        assert sorted(map(str, rows.select(others).collect())) == sorted(map(str, docs.select(others).collect())), name
    pages = docs.withColumn("url", F.lit("http://a.org/x")).withColumn("__host", F.lit("mine"))
    assert urls.filter_urls(pages, SITE_RULES).where("filter.verdict = 'allow' and quality = 'mine'").count() == len(AWKWARD)
    others = [c for c in docs.columns if c != "__id"]
    for stage in (quality.filter_quality(docs), neardup.drop_near_duplicates(docs), contamination.decontaminate(docs, tests), secrets.redact_secrets(docs)):
        assert [c for c in stage.columns if c != "__id"] == others and stage.where("quality <> 'mine' or n_words <> 7").count() == 0


def test_unknown_words_are_encoded_together():
    words = [f"{a}{b}é" for a in ("ab", "Ou", "x1", "don't", "日本", "a,b", "!?") for b in range(40)]
    texts = [" ".join(words[k::7]) + "\n" + "\n".join(words[k::11]) for k in range(7)] + ["odd  space  here it is", "one\ntwo three"]
    encoder = packing.ChunkEncoder(TOKENIZER, limit=50)
    plain, calls = encoder.ranked.encode_ordinary, []
    encoder.ranked.encode_ordinary = lambda text: calls.append(text) or plain(text)
    expected = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == expected
    # One call for all the words, and one for each word that begins a text.
    assert len(calls) <= 1 + len(texts)
    # The full table makes room and keeps what the next texts need.
    calls.clear()
    assert encoder.encode(texts[:3]) == expected[:3] and not calls
    assert encoder.encode(["new words only", *texts[-1:]]) == [*encoder._packed(["new words only"]), expected[-1]]
