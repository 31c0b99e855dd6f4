"""MinHash near-dedup as a chosen-path set similarity join.

A document is the set of its distinct 5-word shingles. Documents link where 100 * intersection
>= 75 * union, and a group is what links connect.

1. Documents with the same set are one class; only the class goes on, under its smallest id.
2. Each class has a row of minwise tokens. In each of several independent trees a class goes
   from the root to one child for each of a few chosen tokens, and from there again, so two
   classes of similarity s take a given branch together with probability s at each step. A node
   with one class is dropped.
3. A node proposes a maximum spanning forest of its classes' estimated similarity, down to
   `floor` equal tokens: linear in the node, whatever its density. A node of more than `small`
   classes does so in blocks, which a forest over one class of each block ties together; it also
   branches on by tokens that depend on the path, until its nodes are small, hardly shrink any
   more (a dense group) or the last level is reached.
4. Every proposed pair is confirmed on the two full sets; links give groups.
5. Groups that proposed pairs tie together without a link form a cluster, in which the forests may
   have passed over links. A cluster of more than `MANY` blocks of classes is thinned out first: its shingles
   are put in the order of how many of its classes hold them, those of one group only in front, and
   two classes of different groups can only link if they share one of their first
   |x| - ceil(0.75 |x|) + 1. Classes that share none with another group are done, which is all of a
   family of like templates with unlike contents; sharing divides the others into parts.
   In each part the classes outside the largest group are compared exhaustively with all others, on
   the full sets, block against block. So a dense group costs no more than its forests, and a link
   that the forests passed over is still found.

Two classes of similarity 0.75 stay together in no node of a tree (3 branches, then 2) with
probability 0.026, in none of 4 trees with 5e-7. The estimate keeps pairs from `floor` equal
tokens on; a pair of 0.75 falls below with probability 4e-5. Both shrink fast above 0.75.

Defined results: null and empty texts have an empty set, link with nothing and are kept; a
text of fewer words is one shingle; a null id links with nothing and is kept, with a null
component; repeated rows are each returned; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm import words as W
from dayledger.llm.scratch import Scratch

SHINGLE = 5
TOKENS = 48
FLOOR = 24
TREES = 4
BRANCHES = (3, 2)
FURTHER = 3
SMALL = 512
LEVELS = 6
#: A node that keeps a larger share of its parent's classes is dense, and branching on does not divide it.
SHRINKING = 0.7
BLOCK = 256
#: Blocks of a cluster from which on it is thinned out; in a smaller one a set is sent to no more tasks than this.
MANY = 16
#: Copies of the one row of a shingle that its holders are joined with.
COPIES = 8
LEAST = 75

_SEEDS = W.mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def split(texts: pa.Array) -> W.Words:
    return W.split(texts, lower=True)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, part in W.slices(texts):
        words = split(part)
        hashes = words.hashes()
        rolled = W.rolling(hashes, SHINGLE)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(rolled[a : b - SHINGLE + 1])
            elif b > a:
                yield W.rolling(hashes[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """TOKENS minwise tokens of a set, 32 bits each."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        np.minimum(least, (part[None, :] * _SEEDS[:, None]).min(1), out=least)
    return (W.mix(least) >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, tokens): the set's size, 128 bits that stand for it, its minwise tokens."""

    @F.arrow_udf("struct<n_shingles:bigint,set_a:bigint,set_b:bigint,tokens:binary>")
    def sign(texts: pa.Array) -> pa.Array:
        sizes, first, second, tokens = [], [], [], []
        for s in shingle_sets(texts):
            sizes.append(len(s))
            first.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
            second.append(int(W.mix(s ^ _SEEDS[0]).sum(dtype=np.uint64).astype(np.int64)))
            tokens.append(minwise(s).tobytes() if len(s) else None)
        arrays = [pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(tokens, pa.binary())]
        return pa.StructArray.from_arrays(arrays, names=["n_shingles", "set_a", "set_b", "tokens"])

    return docs.select(F.col(doc).alias("doc_id"), sign(F.col(text)).alias("s")).select("doc_id", "s.*")


def _token_matrix(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint32)
    return flat.reshape(-1, TOKENS)


def _chosen(path: np.ndarray, branch: int) -> np.ndarray:
    """Which token a path's branch goes by."""
    return (W.mix(path ^ (_SEEDS[branch])) % np.uint64(TOKENS)).astype(np.int64)


def tree_paths(trees: int = TREES, branches: tuple[int, int] = BRANCHES) -> np.ndarray:
    """The two tokens that each path from a root goes by; first steps differ in all trees."""
    dice = np.random.default_rng(7)
    first = dice.permutation(TOKENS)[: trees * branches[0]]
    paths = []
    for token in first:
        others = np.setdiff1d(np.arange(TOKENS), [token])
        paths += [(token, other) for other in dice.permutation(others)[: branches[1]]]
    return np.array(paths)


def root_paths(classes: DataFrame, paths: np.ndarray) -> DataFrame:
    """(node, path, rep): the nodes of every class two steps below the roots."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(len(paths), dtype=np.uint64)
        for batch in batches:
            if not len(batch):
                continue
            tokens = _token_matrix(batch["tokens"]).astype(np.uint64)
            both = (tokens[:, paths[:, 0]] << np.uint64(32)) | tokens[:, paths[:, 1]]
            nodes = W.mix(both ^ W.mix(number + _SEEDS[0])).reshape(-1).view(np.int64)
            reps = np.repeat(batch["rep"].to_numpy(zero_copy_only=False), len(paths))
            path = np.tile(number.astype(np.int32), len(batch))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(path), pa.array(reps)], names=["node", "path", "rep"])

    return classes.select("rep", "tokens").mapInArrow(go, "node bigint, path int, rep bigint")


def branch_paths(members: DataFrame, branches: int = FURTHER) -> DataFrame:
    """(node, rep, was) one level below (node, rep, tokens, n); `was` is the parent's n."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            tokens = _token_matrix(batch["tokens"])
            path = batch["node"].to_numpy(zero_copy_only=False).view(np.uint64)
            rows = np.arange(len(path))
            below = []
            for b in range(branches):
                at = _chosen(path, b)
                below.append(W.mix(path ^ W.mix((at.astype(np.uint64) << np.uint64(32)) | tokens[rows, at].astype(np.uint64))))
            nodes = np.stack(below, axis=1).reshape(-1).view(np.int64)
            reps, was = (np.repeat(batch[c].to_numpy(zero_copy_only=False), branches) for c in ("rep", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(reps), pa.array(was)], names=["node", "rep", "was"])

    return members.select("node", "rep", "tokens", "n").mapInArrow(go, "node bigint, rep bigint, was bigint").distinct()


def _alike(tokens: np.ndarray, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
    return (tokens[a] == tokens[b]).sum(-1)


def _forest(tokens: np.ndarray, floor: int) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over estimated similarity, as far as it reaches floor."""
    n = len(tokens)
    best = np.full(n, -1)
    parent = np.zeros(n, np.int64)
    out = np.ones(n, bool)
    edges = []
    for _ in range(n):
        v = int(np.argmax(np.where(out, best, -2)))
        if best[v] >= floor:
            edges.append((int(parent[v]), v))
        out[v] = False
        best[v] = -1
        same = _alike(tokens, v, np.arange(n))
        closer = out & (same > best)
        best[closer] = same[closer]
        parent[closer] = v
    return edges


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal key, from batches sorted by it."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if rest and rest[-1][key][-1] == batch[key][0] and cut == 0:
            rest.append(batch)
            continue
        if rest or cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def _pairs_of(reps: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(reps[a], reps[b]), np.maximum(reps[a], reps[b])
    both = np.unique(np.stack([low, high], axis=1).reshape(-1, 2), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _proposed(floor: int):
    """Spanning forests of the nodes of (node, rep, tokens) sorted by node."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "node"):
            table = table.combine_chunks()
            node, reps = table["node"].to_numpy(), table["rep"].to_numpy()
            tokens = _token_matrix(table["tokens"])
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            size = np.diff(np.r_[first, len(node)])
            two = first[size == 2]
            two = two[_alike(tokens, two, two + 1) >= floor]
            found = [np.stack([two, two + 1], axis=1)]
            for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                found.append(np.array(_forest(tokens[at : at + n], floor), np.int64).reshape(-1, 2) + at)
            edges = np.concatenate(found)
            edges = edges[reps[edges[:, 0]] != reps[edges[:, 1]]]
            if len(edges):
                yield _pairs_of(reps, edges[:, 0], edges[:, 1])

    return go


def proposed_pairs(nodes: DataFrame, reps: DataFrame, floor: int) -> DataFrame:
    """(a, b), a < b, proposed by the nodes of (node, rep)."""
    rows = nodes.select("node", "rep").join(reps.select("rep", "tokens"), "rep")
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(_proposed(floor), "a bigint, b bigint")


def confirm(pairs: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """(a, b, linked) by the full sets."""

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right, strict=True):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            out.append(100 * common >= least * (len(both) - common))
        return pa.array(out, pa.bool_())

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right"))
    found = pairs.join(right, "b").join(left, "a")
    return found.select("a", "b", linked(F.col("left"), F.col("right")).alias("linked"))


def full_sets(docs: DataFrame, reps: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(rep, shingles) of the documents named in reps.

    A sort-merge join at every size, as the ids grow with the documents.
    """

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([s.tobytes() for s in shingle_sets(texts)], pa.binary())

    wanted = docs.select(F.col(doc).alias("rep"), F.col(text).alias("text")).join(reps.hint("merge"), "rep", "left_semi")
    return wanted.select("rep", pack(F.col("text")).alias("shingles"))


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars for the edges of one batch: what they connect, tied to its smallest member."""
    for batch in batches:
        if not len(batch):
            continue
        ids, ends = np.unique(np.concatenate([batch["a"].to_numpy(), batch["b"].to_numpy()]), return_inverse=True)
        owner = list(range(len(ids)))
        for x, y in zip(ends[: len(batch)].tolist(), ends[len(batch) :].tolist(), strict=True):
            while owner[x] != x:
                owner[x] = x = owner[owner[x]]
            while owner[y] != y:
                owner[y] = y = owner[owner[y]]
            owner[max(x, y)] = min(x, y)
        for x in range(len(ids)):
            owner[x] = owner[owner[x]]
        root = np.array(owner)
        tied = root != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[root[tied]])], names=["u", "v"])


def components(links: DataFrame, keep: Scratch) -> DataFrame:
    """(rep, component): the smallest id that links (a, b) connect to; ids without links are not in it.

    The links of each batch are contracted first. Then large-star and small-star steps take
    turns; a node's neighbours meet only in a minimum, which is aggregated before the shuffle,
    and in a join that can be split.
    """
    edges = keep(links.select("a", "b").mapInArrow(_contracted, "u bigint, v bigint"), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(own, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(own.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "edges")
        if edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty():
            break
    stars = edges.select(F.col("u").alias("rep"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("rep"), F.col("v").alias("component")).distinct())


def _sized(paths: DataFrame) -> DataFrame:
    """(node, rep, n) of the nodes with at least two classes."""
    return paths.join(paths.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "node")


def _blocks(members: DataFrame, small: int) -> DataFrame:
    """Nodes of more than `small` classes dealt into blocks of about that many."""
    if members.where(F.col("n") > small).isEmpty():
        return members.select("node", "rep")
    block = F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("n") / small))
    dealt = members.withColumn("block", F.when(F.col("n") > small, F.xxhash64("node", block)))
    blocks = dealt.select(F.coalesce("block", "node").alias("node"), "rep")
    # One class of each block stands for it; where these are many they are dealt into blocks themselves.
    heads = dealt.where(F.col("block").isNotNull()).groupBy("node", "n", "block").agg(F.min("rep").alias("rep"))
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / small / small))
    return blocks.unionByName(heads.select(F.xxhash64("node", F.lit(-1), part).alias("node"), "rep"))


def _all_proposed(reps: DataFrame, keep: Scratch, paths: np.ndarray, floor: int, small: int, levels: int) -> DataFrame:
    """Distinct pairs from the nodes of every level, which are proposed from in one pass."""
    nodes = keep(_sized(root_paths(reps, paths)), "nodes")
    every = [_blocks(nodes, small)]
    for _ in range(3, levels + 1):
        large = nodes.where(F.col("n") > small)
        if "was" in nodes.columns:
            large = large.where(F.col("n") < SHRINKING * F.col("was"))
        if large.isEmpty():
            break
        nodes = keep(_sized(branch_paths(large.join(reps.select("rep", "tokens"), "rep"))), "nodes")
        every.append(_blocks(nodes, small))
    return proposed_pairs(functools.reduce(DataFrame.unionByName, every), reps, floor).distinct()


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[token] > 1
    _, token = np.unique(token[shared], return_inverse=True)
    owner = owner[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    edges = np.searchsorted(token, np.arange(0, (token[-1] + 1 if len(token) else 0) + 4096, 4096))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], token[a:b] - 4096 * k] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def _linked_groups(least: int):
    """Groups that a link ties, in each task of (task, component, shingles) sorted by task."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "task"):
            table = table.combine_chunks()
            task, group = table["task"].to_numpy(), table["component"].to_numpy()
            first = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
            found = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(task)], strict=True):
                own = group[a:b]
                sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].slice(a, b - a).to_pylist()]
                common = _common(sets)
                size = np.array([len(s) for s in sets])
                links = (100 * common >= least * (size[:, None] + size[None, :] - common)) & (own[:, None] > own[None, :])
                x, y = np.nonzero(links)
                found.append(np.unique(np.stack([own[x], own[y]], axis=1), axis=0))
            every = np.concatenate(found)
            if len(every):
                yield pa.RecordBatch.from_arrays([pa.array(every[:, 0]), pa.array(every[:, 1])], names=["a", "b"])

    return go


def _held(members: DataFrame) -> DataFrame:
    """(cluster, component, rep, n, token) for each of the n shingles of each class."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                sets = [np.frombuffer(x, np.int64) for x in part["shingles"].to_pylist()]
                n = np.array([len(s) for s in sets])
                columns = [np.repeat(part[c].to_numpy(zero_copy_only=False), n) for c in ("cluster", "component", "rep")]
                columns += [np.repeat(n, n), np.concatenate(sets)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "component", "rep", "n", "token"])

    schema = "cluster bigint, component bigint, rep bigint, n bigint, token bigint"
    return members.select("cluster", "component", "rep", "shingles").mapInArrow(go, schema)


def _divided(clusters: DataFrame, sets: DataFrame, keep: Scratch, least: int, block: int) -> DataFrame:
    """(cluster, component, rep) without the classes that can have no link to another component.

    Clusters of at most `MANY` blocks stay as they are. In others what is left is divided by who
    shares a shingle among the first of both.
    """
    block = MANY * block
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n_all"))
    large = keep(clusters.join(sizes.where(F.col("n_all") > block).select("cluster"), "cluster", "left_semi"), "large")
    as_they_are = clusters.join(sizes.where(F.col("n_all") <= block).select("cluster"), "cluster", "left_semi")
    if large.isEmpty():
        return as_they_are
    held = _held(large.join(sets, "rep")).withColumn("copy", F.pmod(F.hash("rep"), F.lit(COPIES)))
    several = F.min("component") != F.max("component")
    common = held.groupBy("cluster", "token").agg(several.alias("several"), F.count("*").alias("holders")).where("several")
    common = common.drop("several").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    shared = held.join(common, ["cluster", "token", "copy"]).drop("copy")
    own = Window.partitionBy("rep")
    # Of the first shingles in the order, those of one component alone come before and can be no link's.
    first = F.col("n") - F.ceil(F.col("n") * least / 100) + 1 - (F.col("n") - F.count("*").over(own))
    ranked = shared.withColumns({"first": first, "place": F.row_number().over(own.orderBy("holders", "token"))})
    prefix = keep(ranked.where("place <= first").select("cluster", "component", "rep", "token"), "prefixes")
    met = prefix.groupBy("cluster", "token").agg(several.alias("several"), F.min("rep").alias("a")).where("several").drop("several")
    copies = met.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    ends = prefix.withColumn("copy", F.pmod(F.hash("rep"), F.lit(COPIES))).join(copies, ["cluster", "token", "copy"])
    parts = components(ends.where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), keep).toDF("rep", "part")
    return as_they_are.unionByName(large.drop("cluster").join(parts, "rep").select(F.col("part").alias("cluster"), "component", "rep"))


def _between(clusters: DataFrame, sets: DataFrame, keep: Scratch, least: int, block: int) -> DataFrame:
    """(a, b): linked components of each cluster, from (cluster, component, rep).

    All classes but those of a cluster's largest component are dealt into blocks, and each of
    these is compared with every block; the largest component is not compared with itself.
    """
    sizes = clusters.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.max("n").alias("n_most"), F.sum("n").alias("n_all"))
    rows = clusters.join(most, "cluster")
    outer = F.col("component") != F.col("most")
    one = F.col("n_all") <= block
    n_outer = F.when(one, 1).otherwise(F.ceil((F.col("n_all") - F.col("n_most")) / block)).cast("int")
    n_most = F.when(one, 0).otherwise(F.ceil(F.col("n_most") / block)).cast("int")
    rows = rows.select("cluster", "component", "rep", n_outer.alias("n_outer"), n_most.alias("n_most"), outer.alias("outer"), one.alias("one"))
    deal = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    own = F.when(F.col("one"), 0).when(F.col("outer"), deal(F.col("n_outer"))).otherwise(F.col("n_outer") + deal(F.greatest("n_most", F.lit(1))))
    rows = rows.withColumn("own", own)
    facing = F.when(F.col("outer") | F.col("one"), F.sequence(F.lit(0), F.col("n_outer") + F.col("n_most") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_outer") - 1))
    rows = rows.withColumn("other", F.explode(facing))
    task = F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other")).alias("task")
    dealt = keep(rows.select(task, "component", "rep"), "tasks")
    given = dealt.join(sets, "rep").repartition("task").sortWithinPartitions("task")
    return given.select("task", "component", "shingles").mapInArrow(_linked_groups(least), "a bigint, b bigint")


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()


def near_duplicates(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    floor: int = FLOOR,
    trees: int = TREES,
    branches: tuple[int, int] = BRANCHES,
    small: int = SMALL,
    levels: int = LEVELS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs."""
    keep = Scratch(docs)
    signed = keep(signatures(docs, doc, text), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    key = ["set_a", "set_b", "n_shingles"]
    classes = full.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    tokens = full.withColumnRenamed("doc_id", "rep").join(classes, [*key, "rep"], "left_semi").select("rep", "tokens")
    reps = keep(tokens, "classes")

    pairs = keep(_all_proposed(reps, keep, tree_paths(trees, branches), floor, small, levels), "pairs")
    sets = keep(full_sets(docs, _named(pairs), doc, text), "sets")
    judged = keep(confirm(pairs, sets, least), "judged")
    groups = components(judged.where("linked"), keep)
    members = keep(sets.select("rep").distinct().join(groups, "rep", "left").select("rep", F.coalesce("component", "rep").alias("component")), "groups")

    ends = judged.where("not linked").join(members.toDF("a", "u"), "a").join(members.toDF("b", "v"), "b")
    open_pairs = keep(ends.where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b")).distinct(), "open")
    if not open_pairs.isEmpty():
        clusters = components(open_pairs, keep).toDF("component", "cluster")
        tied = keep(members.join(clusters, "component"), "clusters")
        divided = keep(_divided(tied, sets, keep, least, block), "divided")
        between = keep(_between(divided, sets, keep, least, block), "links")
        if not between.isEmpty():
            merged = components(between, keep).toDF("component", "merged")
            members = members.join(merged, "component", "left").select("rep", F.coalesce("merged", "component").alias("component"))

    owner = classes.join(members.distinct(), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    alone = F.col("n_shingles") == 0
    component = F.when(alone, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component"))
    found = signed.select("doc_id", *key).join(owner, key, "left").select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with its columns as they are; rows that share an id are one document."""
    gone = near_duplicates(docs, doc, text).where(~F.col("kept")).select(F.col("doc_id").alias(doc)).distinct()
    return docs.join(gone, doc, "left_anti").select(*docs.columns)
