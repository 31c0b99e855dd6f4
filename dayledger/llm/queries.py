"""The operators as queries over the given tables, and their SQL forms where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import (
    chat,
    classifier,
    contamination,
    divergence,
    neardup,
    packing,
    quality,
    repeats,
    resample,
    secrets,
    toxicity,
    urls,
    warc,
)
from dayledger.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SITE_RULES = [
    urls.SiteRule("org", "/", "allow"),
    urls.SiteRule("example.org", "/es/", "block"),
    urls.SiteRule("example.org", "/en/1", "block"),
    urls.SiteRule("com", "/fr/", "allow"),
    urls.SiteRule("com", "/de/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select("doc_id", "repeats.n_words", "repeats.n_removed", "repeats.kept_sha256")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality.score_rules(docs, quality.fit_rules(docs))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "posterior", "kept"]
    return q.select("doc_id", *(f"quality.{name}" for name in names))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, SITE_RULES).select("page_id", "filter.*")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    chats = chat.format_chats(turns.unionByName(extra))
    read = chat.parse(F.col("formatted"))
    said = F.array_join(F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    chats = chats.withColumn("loss", chat.learned_text(F.col("formatted"), F.col("loss_spans")))
    return chats.select(
        "conv_id",
        F.size(read).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER, limits=packing.SEQUENCE)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = classifier.score_texts(docs, machine)
    kept_out = classifier.held_out(F.col("doc_id")).alias("held_out")
    return scored.select("doc_id", kept_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "toxicity.*")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sha = F.sha2(F.col("secrets.base").cast("binary"), 256).alias("base_sha256")
    found = secrets.find_secrets(docs)
    return found.select("doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex", sha, "secrets.spans")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.col("hits.items")
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "archives")
    warc.write_archives(pages, path)
    found = warc.records(warc.read_archives(spark, path, with_payload=False))
    key = lambda name: warc.page_key(name).cast(pages.schema["page_id"].dataType)
    return found.select(
        key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key("refers_to").alias("refers_to")
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample.resample(docs, table(spark, sf_dir, "benchmark"), max_words=1, keep_text=False)
    return found.select("doc_id", *(f"resampled.{name}" for name in ("n_features", "weight", "score", "rank")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_substring_dedup,
        op3_quality_rules,
        op4_url_filter,
        op5_chat_format,
        op6_best_fit_packing,
        op7_quality_classifier,
        op8_toxicity,
        op9_secret_scan,
        op10_decontamination,
        op11_source_divergence,
        op12_warc,
        op13_importance_resampling,
    )
}

ORACLES: dict[str, str] = {
    "op4_url_filter": r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, '.' || host AS h,
    CASE WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN host = '' OR (path <> '' AND (starts_with(host, 'm.') OR starts_with(host, 'mobile.')))
         OR regexp_matches(path, '(?s)/login|/signin|/cart/|/basket/|/wp-admin/|/calendar/[^/]{4}/[^/]{2}/|/feed/?\z')
         OR regexp_matches(host || path, '(?s)\.(exe|zip|apk)\z') THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
""",
    "op5_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *,
    CASE WHEN regexp_matches(role, '^[A-Za-z0-9_ -]*$') AND NOT starts_with(role, '0x') THEN length(role) ELSE 2 + 2 * octet_length(encode(role)) END AS role_chars,
    length(regexp_replace(text, '([<\[]\\*)(/?s>|/?INST\])', '\1\\\2', 'g')) AS escaped
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(10 + role_chars + 1 + escaped + 12) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT i) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n_lang FROM counts GROUP BY ALL HAVING sum(docs) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n_lang)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT counts.* FROM counts JOIN kept USING (lang, term)) c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n_lang + 5)) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE count > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
  FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
    "op12_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
held AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS holder FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5))::BIGINT >> CAST(15 - i % 4 * 5 AS INT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < holder THEN holder END AS refers_to
FROM held
""",
    "op13_importance_resampling": r"""
WITH steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b))),
d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
b AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark),
dw AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM b),
spelt AS (
  SELECT w, list_transform(range(CAST(octet_length(encode(w)) AS BIGINT)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS bytes
  FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
hashed AS (
  SELECT w, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, steps.t[xor(c & 255, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM spelt, steps),
f AS (SELECT doc_id, bucket, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY ALL),
s AS (SELECT bucket, sum(n) AS s FROM f GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000::DOUBLE * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s::DOUBLE + 10000) / ((s::DOUBLE + 1) * (all_t::DOUBLE + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight FROM f JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS position, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN position <= n * 10 // 100 THEN position END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
""",
}
