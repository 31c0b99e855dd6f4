"""Target-distribution importance resampling: draw documents that look like a target table.

A text is cut into words, separators are collapsed to single spaces, and one scan per n-gram
length with overlapped matches and boundary lookarounds gives the n-gram spans themselves,
whose bytes are hashed by CRC-32 into buckets. A bucket's gain is the log ratio of its smoothed
shares in the target and in the documents; a document's weight is the sum of the gains of its
features; weight plus Gumbel noise from the document's id is its score, and the highest scores
are a draw without replacement by importance.

Texts are scanned once: the bucket counts of each document are stored, then counted over all
documents, then priced. What is shared between tasks has one row a bucket. Ranks are dealt by
sorted ranges, so no task sorts more than its share.

Defined results: a null or empty text, or one without words, has no feature and weight 0. Rows
that repeat an id are drawn each on its own; equal scores go by id, null ids last, and rows equal
in both are interchangeable. An empty target or table gives gains that are all smoothing. An input column named like
the result (in any case of letters) is replaced; every other column comes back unchanged.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from dayledger.llm.scratch import Scratch, small_batches
from dayledger.llm.words import ALPHANUMERIC, LOWER
from dayledger.operators.positions import rows_before

BUCKETS = 10_000
SEED = "2024"
#: Documents of fewer words are scored but never drawn.
LEAST_WORDS = 20
PERCENT = 10

#: Every byte that belongs to no word becomes a space, A-Z become a-z.
_TO_WORDS = bytes(int(LOWER[b]) if ALPHANUMERIC[b] else 0x20 for b in range(256))
_FEATURES = ArrayType(StructType([StructField("bucket", IntegerType()), StructField("n", LongType())]))


def collapsed(text: str) -> bytes:
    """The words of a text with one space between them."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split())


def ngram_pattern(n: int) -> regex.Pattern:
    """Matches n whole words; overlapped scanning finds the run that starts at every word."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def ngram_counts(words: bytes, patterns: list[regex.Pattern]) -> Counter[bytes]:
    """Runs of words and how often each occurs, over the spans that the scans give."""
    found: Counter[bytes] = Counter()
    for pattern in patterns:
        found.update(map(methodcaller("group"), pattern.finditer(words, overlapped=True)))
    return found


def hashed_ngrams(docs: DataFrame, text: str, max_words: int, buckets: int, keep_text: bool) -> DataFrame:
    """(row, n_words, features): the other columns of each document, and its bucket counts."""
    kept = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text]
    row = F.struct(*kept) if kept else F.struct(F.lit(None).cast("int").alias("_"))
    framed = docs.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = framed.select("row").schema.add("n_words", "long").add("features", _FEATURES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [ngram_pattern(n) for n in range(1, max_words + 1)]
        pair = pa.struct([pa.field("bucket", pa.int32()), pa.field("n", pa.int64())])
        for batch in batches:
            n_words, sizes, keys, counts = [], [0], [], []
            for value in batch.column("text"):
                words = collapsed(value.as_py() or "")
                summed: Counter[int] = Counter()
                for gram, n in ngram_counts(words, patterns).items():
                    summed[zlib.crc32(gram) % buckets] += n
                n_words.append(words.count(b" ") + 1 if words else 0)
                keys.extend(summed.keys())
                counts.extend(summed.values())
                sizes.append(len(keys))
            pairs = pa.StructArray.from_arrays([pa.array(keys, pa.int32()), pa.array(counts, pa.int64())], fields=list(pair))
            features = pa.ListArray.from_arrays(pa.array(np.array(sizes, np.int32)), pairs)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n_words, pa.int64()), features], ["row", "n_words", "features"])

    return framed.mapInArrow(scan, schema)


def bucket_counts(hashed: DataFrame, name: str) -> DataFrame:
    """Occurrences of each bucket; at most one row a bucket leaves a task."""
    return hashed.select(F.inline("features")).groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int, keep: Scratch) -> Column:
    """The gain of every bucket as one array of `buckets` numbers."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    found = every.join(bucket_counts(source, "s"), "bucket", "left").join(bucket_counts(target, "t"), "bucket", "left")
    counted = keep(found.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "buckets")
    total = lambda name: counted.agg(F.sum(name)).scalar().cast("double") + buckets
    one_more = lambda name: F.col(name).cast("double") + 1
    ratio = one_more("t") * total("s") / (one_more("s") * total("t"))
    gain = F.floor(F.lit(1000.0) * F.ln(ratio)).cast("bigint").alias("gain")
    # `buckets` numbers, whatever the size of the tables; as text they become one literal array.
    listed = counted.select("bucket", gain).agg(F.array_sort(F.collect_list(F.struct("bucket", "gain"))).alias("all"))
    numbers = listed.select(F.array_join(F.transform("all", lambda x: x["gain"].cast("string")), ",")).first()[0]
    return F.split(F.lit(numbers), ",").cast("array<bigint>")


def gumbel(key: Column, seed: str = SEED) -> Column:
    """Noise in thousandths from the first 32 bits of the SHA-256 of seed and key."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    max_words: int = 2,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
    keep_text: bool = True,
    out: str = "resampled",
) -> DataFrame:
    """Every document with the struct `out`: n_words, n_features, weight, score, rank.

    Features are the runs of 1 to `max_words` words. Of the N documents with `least_words` words
    the floor(percent * N / 100) highest scores have a rank from 1 on; the rank of others is null.
    Without `keep_text` the text column is left out of the result and of everything stored.
    """
    keep = Scratch(docs)
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if (keep_text or c != text) and c.lower() != out.lower()]
    hashed = keep(hashed_ngrams(docs, text, max_words, buckets, keep_text), "ngrams")
    wanted = keep(hashed_ngrams(target.select(target_text), target_text, max_words, buckets, False), "target_ngrams")
    gains = bucket_gains(hashed, wanted, buckets, keep)
    weight = F.aggregate("features", F.lit(0).cast("bigint"), lambda sum_, f: sum_ + f["n"] * F.get(gains, f["bucket"]))
    n_features = F.aggregate("features", F.lit(0).cast("bigint"), lambda sum_, f: sum_ + f["n"])
    scored = hashed.select("row", "n_words", n_features.alias("n_features"), weight.alias("weight"))
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col(f"row.`{key}`"), seed))
    ranked = with_rank(scored, F.col("n_words") >= least_words, F.col(f"row.`{key}`"), percent, keep)
    result = F.struct("n_words", "n_features", "weight", "score", "rank").alias(out)
    return ranked.select(*(F.col(f"row.`{c}`") for c in names), result)


def with_rank(scored: DataFrame, eligible: Column, key: Column, percent: int, keep: Scratch) -> DataFrame:
    """Ranks by score, highest first, of the first `percent` per cent of the eligible rows.

    Rows are dealt to ranges of (score, key), numbered inside their range, and shifted by the
    sizes of the ranges before, of which there are as many as tasks.
    """
    # A score of null stands for a row that cannot be drawn and goes behind all others.
    by = F.when(eligible, F.col("score"))
    order = [F.desc_nulls_last("_by"), F.asc_nulls_last("_key")]
    dealt = scored.withColumns({"_by": by, "_key": key}).repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts the rows of a task above the task's own number.
    placed = keep(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("_at", 33)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_size"))
    offsets = sizes.select("_task", rows_before("_task", "_size").alias("_before"))
    limit = F.floor(placed.agg(F.count("_by")).scalar() * percent / 100)
    position = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    drawn = F.col("_by").isNotNull() & (position <= limit)
    # One row for each task of the sort, whatever the size of the data.
    numbered = placed.withColumn("_task", task).join(F.broadcast(offsets), "_task", "left")
    return numbered.withColumn("rank", F.when(drawn, position).cast("bigint")).drop("_by", "_key", "_at", "_task", "_before")


def draw(docs: DataFrame, target: DataFrame, out: str = "resampled", **options) -> DataFrame:
    """The drawn documents only, with the columns they came with."""
    drawn = resample(docs, target, out=out, keep_text=True, **options)
    return drawn.where(F.col(out)["rank"].isNotNull()).drop(out)
