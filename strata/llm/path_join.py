"""Near-duplicate search by a chosen-path set similarity join.

Documents with equal shingle sets become one class first. Trees then branch the classes by a selected minwise token, and
every tree node that still holds many of them again by another one, down to ``depth``. Nodes that have become small
are compared exhaustively: sketches of further minwise tokens drop the documents without a possible partner there, the
others are compared by their full sets. Independent trees are repeated until a pair at the threshold is missed in all
of them, or by its sketch, with a chance of at most twice ``miss``.

Two rounds keep large groups of near copies cheap. The first takes two trees. The second takes all, but only nodes
whose documents are not all connected yet. What comes out of a node is a spanning forest of its links, never its pairs.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import roots, settle, small_batches
from strata.llm.jaccard_join import shingle_sets

FUNCTIONS = 128  # minwise functions; the first ones choose paths, the last byte of each makes the sketch
NODE = 256  # nodes of a tree with at most so many documents are compared exhaustively
NODE_SHINGLES = 1 << 21  # and with at most so many shingles (16 MB)
HOSTS, VISITORS = 4096, 512  # of a larger node, so many documents and unconnected documents are held against each other at once
COLUMNS = 2048  # shingles that are intersected at once
FIRST_TREES = 2
FILTER_BITS = 23
SLICE = 4096  # shingles that go through all functions at once

_MASK = (1 << 64) - 1


def _factor(i: int) -> int:
    """A fixed odd 64-bit number for ``i`` (one step of splitmix64)."""
    n = (i + 5_000_001) * 0x9E3779B97F4A7C15 & _MASK
    n = (n ^ n >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    n = (n ^ n >> 27) * 0x94D049BB133111EB & _MASK
    return (n ^ n >> 31) | 1


_FACTORS = np.array([_factor(i) for i in range(FUNCTIONS)], np.uint64)


def tree_count(percent: int, depth: int, miss: float) -> int:
    """Trees after which a pair of similarity ``percent`` has met with a chance of 1 - ``miss`` at least: at every
    depth of a tree it keeps to one path with the chance of its similarity."""
    meets = (percent / 100) ** depth
    return max(FIRST_TREES, math.ceil(math.log(miss) / math.log(1 - meets))) if meets < 1 else FIRST_TREES


def least_agreement(percent: int, miss: float) -> int:
    """Equal sketch bytes that a pair of similarity ``percent`` falls short of with a chance of at most ``miss``."""
    j, below, k = percent / 100, 0.0, 0
    while k < FUNCTIONS:
        below += math.comb(FUNCTIONS, k) * j**k * (1 - j) ** (FUNCTIONS - k)
        if below > miss:
            break
        k += 1
    return k


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least value of each function over the shingles."""
    least = np.full(FUNCTIONS, _MASK, np.uint64)
    for at in range(0, len(shingles), SLICE):
        np.minimum(least, (shingles[at: at + SLICE, None] * _FACTORS).min(axis=0), out=least)
    return least


def _describe(k: int, chosen: int):
    """Rows (id, row_hash, text) -> (id, row_hash, n, set_a, set_b, tokens, sketch)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([(t or "").encode() for t in batch.column("text").to_pylist()], k)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            values = [minwise(s) if len(s) else None for s in sets]
            as_long = lambda part: pa.array(np.array([int.from_bytes(d[part], "little", signed=True) for d in digests], np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("row_hash"), pa.array([len(s) for s in sets], pa.int64()), as_long(slice(0, 8)), as_long(slice(8, 16)),
                pa.array([None if v is None else v[:chosen].view(np.int64) for v in values], pa.list_(pa.int64())),
                pa.array([None if v is None else v.astype(np.uint8).tobytes() for v in values], pa.binary())],
                ["id", "row_hash", "n", "set_a", "set_b", "tokens", "sketch"])

    return run


def _tree_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One tree node after the other, from rows sorted by ``block``."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            if held and blocks[a] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = blocks[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sides(node: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are held against each other: visitors against hosts, without visitors all against all."""
    visitor = node.column("visitor").to_numpy()
    every = np.arange(len(visitor))
    return (every[visitor], every[~visitor]) if visitor.any() else (every, every)


def _prune(percent: int, agreement: int):
    """Rows (block, visitor, nid, label, n, sketch) sorted by block -> (block, visitor, nid, label) of those that may have a link
    to a document of another label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in _tree_nodes(batches):
            rows, columns = _sides(node)
            n, label = node.column("n").to_numpy(), node.column("label").to_numpy()
            sketch = np.frombuffer(b"".join(node.column("sketch").to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
            may = np.zeros(len(n), bool)
            for i in rows:
                fits = columns[(100 * np.minimum(n[columns], n[i]) >= percent * np.maximum(n[columns], n[i])) & (label[columns] != label[i])]
                near = fits[(sketch[fits] == sketch[i]).sum(axis=1) >= agreement] if len(fits) else fits
                may[near] = True
                may[i] |= len(near) > 0
            if may.any():
                yield from node.select(["block", "visitor", "nid", "label"]).filter(pa.array(may)).combine_chunks().to_batches()

    return run


def intersections(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """How many shingles the sets of ``rows`` share with those of ``columns``."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    size = np.diff(np.append(first, len(every)))
    shared = np.repeat(size > 1, size)  # shingles of one set alone count for nothing
    owner, column = owner[shared], np.repeat(np.cumsum(size > 1) - 1, size)[shared]
    total = np.zeros((len(rows), len(columns)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        total += (held[rows] @ held[columns].T).astype(np.int64)
    return total


def _forest(labels: list[int], pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those of the pairs that connect what neither the labels nor earlier ones do."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for i, j in pairs:
        a, b = top(labels[i]), top(labels[j])
        if a != b:
            up[a] = b
            yield i, j


def _links(percent: int):
    """Rows (block, visitor, nid, label, shingles) sorted by block -> links (a, b), a forest of each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in _tree_nodes(batches):
            rows, columns = _sides(node)
            sets = [np.frombuffer(x, np.uint64) for x in node.column("shingles").to_pylist()]
            n = np.array([len(x) for x in sets])
            both = intersections(sets, rows, columns)
            i, j = np.nonzero(100 * both >= percent * (n[rows][:, None] + n[columns] - both))
            nids = node.column("nid").to_pylist()
            found = list(_forest(node.column("label").to_pylist(), zip(rows[i].tolist(), columns[j].tolist())))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([nids[x] for x, _ in found], pa.int64()), pa.array([nids[y] for _, y in found], pa.int64())], ["a", "b"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([t.encode() for t in batch.column("text").to_pylist()], k)
            yield pa.RecordBatch.from_arrays([batch.column("nid"), pa.array([s.tobytes() for s in sets], pa.binary())], ["nid", "shingles"])

    return run


def _part(nid: str, parts: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), nid), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def path_join(
    docs: DataFrame, k: int = 5, percent: int = 85, depth: int = 3, miss: float = 1e-7, node_size: int = NODE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Returns ``id, row_hash, n_shingles, component_id, component`` for every row; ``row_hash`` is xxhash64 of the text,
    ``component`` a key that also tells components of null ids apart (null without shingles).

    Two documents link when 100 * |intersection| >= ``percent`` * |union| of their sets of distinct ``k``-word
    shingles; fewer words are one shingle. ``component_id`` is the smallest id reachable over links. A link at
    the threshold is missed with a chance of at most 2 * ``miss``, a closer one with less; none is reported that isn't one.

    Defined cases: a text without words, or null, has 0 shingles and is its own component; repeated rows and copies are one
    component; a null id is smaller than none; an empty table gives no rows; other columns are ignored. Shingles are
    compared by 64-bit, sets by 128-bit hashes.

    Copies meet by fingerprint only. A tree node that stays larger than ``node_size`` (or NODE_SHINGLES) at the last depth is
    a group of near copies; it is cut into parts that each also hold its first document. In the second round only
    documents that are not yet connected with the first one visit all parts, so a group costs in proportion to its size and
    to the number of its documents that are in no common component, and no pair is left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    trees, agreement = tree_count(percent, depth, miss), least_agreement(percent, miss)
    if trees * depth > FUNCTIONS:
        raise ValueError("depth and miss ask for more minwise tokens than there are")
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    described = settle(base.mapInArrow(_describe(k, trees * depth), (
        f"id {id_type}, row_hash long, n long, set_a long, set_b long, tokens array<long>, sketch binary")), "minwise")
    rows = described.select("id", "row_hash", "n", "set_a", "set_b")
    nodes = settle(described.where(F.col("n") > 0).groupBy("set_a", "set_b").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_hash")).alias("first"), F.max("n").alias("n"),
        F.max("tokens").alias("tokens"), F.max("sketch").alias("sketch")).withColumn("nid", F.monotonically_increasing_id()), "set-nodes")

    # the trees: paths that at least two documents share
    def shared(placed: DataFrame, name: str) -> DataFrame:
        sizes = placed.groupBy("path").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("nid").alias("leader")).where(F.col("size") > 1)
        return settle(placed.join(sizes, "path").select("path", "tree", "nid", "n", "leader", "size", "weight"), name)

    is_small = (F.col("size") <= node_size) & (F.col("weight") <= NODE_SHINGLES)
    first = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), F.xxhash64(t, F.get("tokens", t * depth)).alias("path")))
    level = shared(nodes.select("nid", "n", F.explode(first).alias("at")).select("nid", "n", "at.tree", "at.path"), "paths-1")
    leaves = level.where(is_small)
    for d in range(1, depth):
        large = level.where(~is_small).select("path", "tree", "nid", "n").join(nodes.select("nid", "tokens"), "nid")
        level = shared(large.withColumn("path", F.xxhash64("path", F.get("tokens", F.col("tree") * depth + d))).drop("tokens"), f"paths-{d + 1}")
        leaves = leaves.unionByName(level.where(is_small))
    groups = level.where(~is_small)

    def pieces(rows: Column, shingles: Column, most: int) -> Column:
        return F.ceil(F.greatest(rows / most, shingles / NODE_SHINGLES)).cast("int")

    def search(blocks: DataFrame) -> DataFrame:
        """``blocks``: (block, visitor, nid, label) -> links. Full sets are made of the texts of documents with a possible
        partner only; a bitmap of fixed size keeps most other texts from being sent."""
        sent = blocks.join(nodes.select("nid", "n", "sketch"), "nid").select("block", "visitor", "nid", "label", "n", "sketch")
        sent = sent.repartition("block").sortWithinPartitions("block")
        placed = settle(sent.mapInArrow(_prune(percent, agreement), "block long, visitor boolean, nid long, label long"), "likely")
        key = [F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id_key"), F.col("id").isNull().alias("no_id"), "row_hash"]
        wanted = settle(placed.select("nid").distinct().join(nodes.select("nid", "first.id", "first.row_hash"), "nid").select("nid", *key), "wanted")
        bit = F.pmod(F.xxhash64("id_key", "row_hash"), F.lit(1 << FILTER_BITS)).alias("bit")
        bits = wanted.select(bit).groupBy((F.col("bit") / 64).cast("long").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
        asked = base.where("text is not null").select(*key, "text").withColumn("bit", bit).join(
            F.broadcast(bits), (F.col("bit") / 64).cast("long") == F.col("word")).where(
            F.expr("shiftrightunsigned(bits, cast(bit % 64 as int)) & 1 = 1"))
        texts = asked.groupBy("id_key", "no_id", "row_hash").agg(F.max("text").alias("text")).join(wanted, ["id_key", "no_id", "row_hash"])
        sets = settle(texts.select("nid", "text").mapInArrow(_sets(k), "nid long, shingles binary"), "sets")
        full = placed.join(sets, "nid").select("block", "visitor", "nid", "label", "shingles")
        return settle(full.repartition("block").sortWithinPartitions("block").mapInArrow(_links(percent), "a long, b long"), "links")

    def blocks_of(frame: DataFrame, *key: str) -> DataFrame:
        return frame.select(F.xxhash64(*key).alias("block"), "visitor", "nid", "label")

    # round one: two trees
    own = {"visitor": F.lit(False), "label": F.col("nid")}
    cut = groups.where(F.col("tree") < FIRST_TREES).withColumn("parts", pieces(F.col("size"), F.col("weight"), node_size))
    leaders = cut.where(F.col("nid") == F.col("leader")).select("path", "nid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    in_parts = cut.select("path", "nid", _part("nid", F.col("parts")).alias("part")).unionByName(leaders).distinct()
    links = search(blocks_of(leaves.where(F.col("tree") < FIRST_TREES).withColumns(own), "path").unionByName(
        blocks_of(in_parts.withColumns(own), "path", "part")))
    root = roots(links)

    # round two: all trees, what isn't connected yet
    def labelled(frame: DataFrame) -> DataFrame:
        if root is None:
            return frame.withColumn("label", F.col("nid"))
        return frame.join(root, "nid", "left").withColumn("label", F.coalesce("root", "nid")).drop("root")

    marked = labelled(leaves.select("path", "nid", F.lit(False).alias("visitor")))
    unsettled = marked.groupBy("path").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") != F.col("high"))
    marked = marked.join(unsettled.select("path"), "path")
    grouped = labelled(groups.select("path", "nid", "n", "leader", pieces(F.col("size"), F.col("weight"), HOSTS).alias("parts")))
    core = grouped.where(F.col("nid") == F.col("leader")).select("path", F.col("label").alias("core"))
    grouped = settle(grouped.join(core, "path").withColumn("loose", F.col("label") != F.col("core")), "groups")
    guests = grouped.where("loose").groupBy("path").agg(pieces(F.count(F.lit(1)), F.sum("n"), VISITORS).alias("guests"))
    grouped = grouped.join(guests, "path")
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)
    hosts = grouped.select("path", _part("nid", F.col("parts")).alias("part"), every("guests", "guest"), F.lit(False).alias("visitor"), "nid", "label")
    visitors = grouped.where("loose").select(
        "path", every("parts", "part"), _part("nid", F.col("guests")).alias("guest"), F.lit(True).alias("visitor"), "nid", "label")
    root = roots(links.unionByName(search(blocks_of(marked, "path").unionByName(blocks_of(hosts.unionByName(visitors), "path", "part", "guest")))))

    known = nodes.select("nid", "set_a", "set_b", "first")
    named = labelled(known)
    smallest = named.groupBy("label").agg(F.min(F.struct("first.no_id", "first.id")).alias("least"))
    component = settle(named.join(smallest, "label").select(
        "set_a", "set_b", F.col("least.id").alias("component_id"), F.col("label").alias("component")), "components")
    return rows.join(component, ["set_a", "set_b"], "left").select(
        "id", "row_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "component")
