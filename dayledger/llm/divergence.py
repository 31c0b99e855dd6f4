"""How a source's word use differs from that of other sources of its language, exactly.

Each language keeps the terms that enough of its documents use. A group, which is one source in
one language, gives every kept term a smoothed share in billionths that depends only on the
term's count in the group, its *count level*. So the distance of two groups needs no more than
their joint table: how many terms have level a in one group and level b in the other.

Joint tables come from products. The kept terms of a language are dealt into chunks by hash; in a
chunk a term is a row of indicators, one column for every (group, level) that occurs, and the
product of the transposed indicators with themselves holds the joint tables of all pairs of groups
at once. Products go block by block, some terms and some columns at a time, in 32-bit floats that
stay exact because no sum exceeds the number of terms in a block. Each block is priced by the
difference of the two shares in 64-bit integers, and the prices of all blocks are added up.

What a task holds is one chunk, whose size is set by `CELLS`, and one block. Counting is summed
before each shuffle, a frequent term is one row per batch and group, and no pair of documents or
terms is ever formed. Pairs of groups are the result itself.

Defined results: null text, language and source are empty strings. A group without terms gives
every kept term its smoothed share of nothing; a language without kept terms has distance 0 for all
its pairs and no term rows. A lone source has no pair. Equal values go by name. Repeated rows count
as often as they occur. Columns other than the three named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.scratch import Scratch, small_batches
from dayledger.llm.words import LOWER, slices, split

LEAST_DOCS = 30
ALPHA = 5
SCALE = 1_000_000_000
TOP_TERMS = 50

#: Cells (terms by groups) of a chunk: at least the first, at most the second, and in between enough
#: that a chunk's pairs of groups stay fewer than its cells.
CELLS = (1 << 18, 1 << 22)
#: Terms and indicator columns of one product.
BLOCK_TERMS = 64
BLOCK_COLUMNS = 2_048

#: Copies of a group's row that its terms are joined with.
COPIES = 32

#: Fixed: a term is a run of ASCII letters and of anything beyond ASCII.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[0x41:0x5B] = TERM_BYTES[0x61:0x7B] = TERM_BYTES[0x80:] = True

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def group_codes(*columns: pa.Array) -> tuple[np.ndarray, list[int]]:
    """A number for each distinct combination of the columns, and a row that has it."""
    codes = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        encoded = column.dictionary_encode()
        codes = codes * max(len(encoded.dictionary), 1) + encoded.indices.to_numpy(zero_copy_only=False)
    _, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
    return inverse.astype(np.int64), first.tolist()


def batch_counts(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Occurrences and documents of each term in each group of some documents."""
    words = split(texts, TERM_BYTES)
    inside = TERM_BYTES[words.data]
    ends = np.concatenate([[0], np.cumsum(words.end - words.begin)]).astype(np.int64)
    joined = LOWER[words.data[inside]]
    listed = pa.LargeStringArray.from_buffers(len(words.begin), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(joined)))
    encoded = listed.dictionary_encode()
    n_terms = max(len(encoded.dictionary), 1)
    code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    in_doc, n = np.unique(words.doc * n_terms + code, return_counts=True)
    group, first = group_codes(lang, source)
    keys, inverse = np.unique(group[in_doc // n_terms] * n_terms + in_doc % n_terms, return_inverse=True)
    at = pa.array(np.asarray(first, np.int64)[keys // n_terms])
    return pa.RecordBatch.from_arrays(
        [
            lang.take(at),
            source.take(at),
            encoded.dictionary.take(pa.array(keys % n_terms)).cast(pa.string()),
            pa.array(np.bincount(inverse, n, len(keys)).astype(np.int64)),
            pa.array(np.bincount(inverse, minlength=len(keys)).astype(np.int64)),
        ],
        ["lang", "source", "term", "n", "docs"],
    )


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all documents; `docs` has the three columns, none null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text"), 1 << 22):
                lang, source = (batch.column(c).slice(at, len(texts)) for c in ("lang", "source"))
                yield batch_counts(lang, source, texts)

    found = docs.select("lang", "source", "text").mapInArrow(count, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + ALPHA) / (total + ALPHA * terms)), in decimals that cannot overflow."""
    below = (total + ALPHA * terms).cast("decimal(38,0)")
    above = (F.lit(SCALE).cast("decimal(10,0)") * (n + ALPHA).cast("decimal(20,0)")).cast("decimal(38,0)")
    return 1 + F.call_function("div", above, below).cast("bigint")


def joint_price(levels: np.ndarray, prices: np.ndarray, columns: int = BLOCK_COLUMNS) -> np.ndarray:
    """Sum over terms of |price in g - price in h| for all pairs of groups g, h.

    `levels` and `prices` are terms by groups; a group's price depends on its level only. Columns
    of indicators are the levels that occur, group after group.
    """
    n_terms, n_groups = levels.shape
    total = np.zeros((n_groups, n_groups), np.int64)
    if not n_terms or not n_groups:
        return total
    # Number the levels of each group from 0 on by sorting each column.
    order = np.argsort(levels, axis=0, kind="stable")
    placed = np.take_along_axis(levels, order, 0)
    steps = np.zeros_like(placed)
    steps[1:] = np.cumsum(placed[1:] != placed[:-1], axis=0)
    local = np.empty_like(steps)
    np.put_along_axis(local, order, steps, 0)
    first = np.concatenate([[0], np.cumsum(steps[-1] + 1)])
    at = local + first[:-1]
    price = np.zeros(first[-1], np.int64)
    price[at.ravel()] = prices.ravel()
    one_hot = np.zeros((n_terms, first[-1]), np.float32)
    one_hot[np.arange(n_terms)[:, None], at] = 1
    # A block of columns holds whole groups; one group has at most n_terms levels.
    cuts, start = [0], 0
    for g in range(n_groups):
        if first[g + 1] - first[start] > columns and g > start:
            cuts.append(g)
            start = g
    cuts.append(n_groups)
    blocks = list(zip(cuts[:-1], cuts[1:], strict=True))
    for i, (a, b) in enumerate(blocks):
        left = one_hot[:, first[a] : first[b]]
        for c, d in blocks[i:]:
            joint = left.T @ one_hot[:, first[c] : first[d]]
            gap = np.abs(price[first[a] : first[b], None] - price[None, first[c] : first[d]])
            gap *= joint.astype(np.int64)
            rows = np.add.reduceat(gap, first[a:b] - first[a], axis=0)
            found = np.add.reduceat(rows, first[c:d] - first[c], axis=1)
            total[a:b, c:d] += found
            if c != a:
                total[c:d, a:b] += found.T
    return total


def price_chunk(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Prices of all ordered pairs of the groups over the terms of one chunk."""
    groups = groups.sort_by("source")
    names = groups.column("source").combine_chunks()
    lang = groups.column("lang").combine_chunks()
    g = pc.index_in(cells.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = cells.column("term").combine_chunks().dictionary_encode()
    t = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    levels = np.zeros((len(encoded.dictionary), len(names)), np.int64)
    prices = np.broadcast_to(groups.column("p_none").to_numpy(), levels.shape).copy()
    levels[t, g] = cells.column("n").to_numpy()
    prices[t, g] = cells.column("p").to_numpy()
    # Terms of like frequency share levels, so neighbours in this order need few columns.
    order = np.argsort(levels.sum(1), kind="stable")
    total = np.zeros((len(names), len(names)), np.int64)
    for at in range(0, len(order), BLOCK_TERMS):
        block = order[at : at + BLOCK_TERMS]
        total += joint_price(levels[block], prices[block])
    one, other = np.nonzero(~np.eye(len(names), dtype=bool))
    return pa.table({
        "lang": lang.take(pa.array(one)),
        "source": names.take(pa.array(one)),
        "item": names.take(pa.array(other)),
        "value": pa.array(total[one, other], pa.int64()),
    })


def chunk_count(terms: Column, groups: Column) -> Column:
    """Chunks of a language, at least one."""
    cells = F.least(F.greatest(F.lit(CELLS[0]), 4 * groups * groups), F.lit(CELLS[1]))
    return F.greatest(F.ceil(terms * groups / cells), F.lit(1)).cast("int")


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part `pair`: each other source of the language with the summed distance of the shares of all
    kept terms. Part `term`: the `top_terms` kept terms that the group uses more than its language.
    """
    keep = Scratch(docs)
    small_batches(docs.sparkSession)
    read = lambda name, as_: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(as_)
    rows = docs.select(read(lang, "lang"), read(source, "source"), read(text, "text"))
    # Groups without a single term are groups too.
    named = rows.select("lang", "source").distinct()
    counts = keep(count_terms(rows), "term_counts")
    frequent = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"))
    frequent = keep(frequent.where(F.col("docs") >= least_docs).select("lang", "term", "n_lang"), "frequent_terms")
    kept = keep(counts.join(frequent, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "kept_terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = named.join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    of_terms = frequent.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    of_groups = groups.groupBy("lang").agg(F.count("*").alias("groups"))
    langs = of_groups.join(of_terms, "lang", "left").na.fill(0, ["terms", "total_lang"])
    langs = langs.withColumn("chunks", chunk_count(F.col("terms"), F.col("groups")))
    priced = groups.join(langs, "lang")
    # Without kept terms a share is never used; its denominator only must not be zero.
    some = F.greatest("terms", F.lit(1))
    priced = keep(priced.withColumn("p_none", share(F.lit(0), F.col("total"), some)), "groups")
    # A hot group's terms are spread over the copies of its row.
    copies = priced.drop("p_none").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    spread = kept.withColumn("copy", F.pmod(F.xxhash64("term"), F.lit(COPIES)).cast("int"))
    cells = spread.join(copies, ["lang", "source", "copy"]).select(
        "lang", "source", "term", "n",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("n_lang"), F.col("total_lang"), F.col("terms")).alias("q"),
        F.pmod(F.hash("term"), "chunks").alias("chunk"),
    )
    cells = keep(cells, "cells")
    dealt = priced.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    chunks = cells.groupBy("lang", "chunk").cogroup(dealt.select("lang", "chunk", "source", "p_none").groupBy("lang", "chunk"))
    values = chunks.applyInArrow(price_chunk, "lang string, source string, item string, value bigint")
    pairs = values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    within = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda found, part: found.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(within).alias("rank")
    )
    more = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    top = ranked(more, "term").where(F.col("rank") <= top_terms)
    return ranked(pairs, "pair").unionByName(top)
