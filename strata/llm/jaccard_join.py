"""N-gram Jaccard self-join with signature trees.

Documents with equal shingle sets become one node first. Two linked nodes
share a shingle of their prefixes (the rarest fifth of each set in one global
order; of the smaller one the rarest ninth), so every shingle sends its nodes to the
block of its smallest node of about their size, and linked nodes meet in a block. In a block the nodes are the leaves of a
signature tree: inner nodes hold the OR of the token bitmaps, the range of
set sizes and the largest bitmap excess. A dual traversal of the tree drops pairs of
subtrees whose largest possible overlap is too small. It runs over short bitmaps first, and
only nodes that keep a possible partner send their texts; then over longer bitmaps,
which also drops pairs that are connected already and verifies the leaf pairs that remain exactly.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import roots, settle, small_batches

SKETCH_BITS = 21
PIECES = 32
TREE_BITS = 2048
SIGNATURE_BITS = 1024
FILTER_BITS = 23
FANOUT = 8
BLOCK_NODES, BLOCK_BYTES = 512, 16 << 20

CHUNK = 2 << 20  # bytes whose words are hashed together

_MASK = (1 << 64) - 1


def _mixed(n: int) -> int:
    """A fixed 64-bit number for ``n`` (the finaliser of splitmix64)."""
    n = (n + 1) * 0x9E3779B97F4A7C15 & _MASK
    n = (n ^ n >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    n = (n ^ n >> 27) * 0x94D049BB133111EB & _MASK
    return n ^ n >> 31


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_BYTE = np.array([_mixed(b) for b in range(256)], dtype=np.uint64)[_LOWERED]  # A-Z count as a-z
_STEP = _mixed(1000) | 1
_PLACE = np.array([_mixed(2000 + i) | 1 for i in range(64)], dtype=np.uint64)  # factor of a shingle's i-th word


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, base, dtype=np.uint64))


class _Powers:
    """Powers of the step and of its inverse modulo 2**64, as many as were needed so far."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, CHUNK + 4096)
            cls.up, cls.down = _powers(_STEP, n), _powers(pow(_STEP, -1, 1 << 64), n)
        return cls.up[:n], cls.down[:n]


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of each word: runs of other bytes than ASCII blanks. A word's hash is the
    polynomial of its bytes, had for all words at once from one running sum."""
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    up, down = _Powers.of(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])
    return starts, _finish((total[ends] - total[starts]) * down[starts])


def _long_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, chunk by chunk; a chunk ends at a blank."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and not _BLANK[data[end]]:
            gap = np.flatnonzero(_BLANK[data[end: end + CHUNK]])
            end = end + int(gap[0]) if len(gap) else min(len(data), end + CHUNK)
        out.append(_words(data[at:end])[1])
        at = end
    return np.concatenate(out)


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(words) - k + 1, np.uint64(_mixed(3000 + k)))
    for i in range(k):
        h += words[i: len(words) - k + 1 + i] * _PLACE[i % 64]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
    return _finish(h)


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    if len(h) > 1:
        new = np.concatenate([[True], h[1:] != h[:-1]])
        h = h if new.all() else h[new]
    return h


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Distinct k-word shingles of every text as sorted 64-bit hashes; A-Z are lower-cased, and a
    text of fewer words is one shingle. Short texts are hashed together."""
    out: list = [None] * len(texts)
    held, size = [], 0

    def one(words: np.ndarray) -> np.ndarray:
        return _distinct(_shingles(words, min(k, len(words)))) if len(words) else np.zeros(0, np.uint64)

    def flush():
        data = np.frombuffer(b" ".join(texts[i] for i in held), np.uint8)
        starts, words = _words(data)
        begins = np.cumsum([0] + [len(texts[i]) + 1 for i in held])
        cuts = np.searchsorted(starts, begins)
        every = _shingles(words, k) if len(words) >= k else None
        for i, a, b in zip(held, cuts, cuts[1:]):
            out[i] = _distinct(every[a: b - k + 1]) if b - a >= k else one(words[a:b])

    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            out[i] = one(_long_words(np.frombuffer(text, np.uint8)))
            continue
        held.append(i)
        size += len(text) + 1
        if size > CHUNK:
            flush()
            held, size = [], 0
    if held:
        flush()
    return out


def prefix_length(n: int, percent: int) -> int:
    """Two linked sets share a shingle of their prefixes of this length (in any common order)."""
    return n - -(-percent * n // 100) + 1


def index_length(n: int, percent: int) -> int:
    """The smaller of two linked sets has the first common shingle in a prefix of this length:
    the shingles from there on must hold the whole overlap, 2 * percent / (100 + percent) of it or more."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _bitmap(hashes: np.ndarray, bits: int) -> bytes:
    """A token sets the bit that its low digits name."""
    on = np.zeros(bits, dtype=bool)
    on[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(on, bitorder="little").tobytes()


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _describe(k: int):
    """(id, row_hash, n, node, size, signature) of every row, and the task's share of the document frequency sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        id_type = pa.null()
        names = ["id", "row_hash", "n", "node", "size", "signature", "piece", "counts"]
        for batch in batches:
            id_type = batch.schema.field(0).type
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            sets = shingle_sets(texts, k)
            n = [len(s) for s in sets]
            node = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            size = [len(t) + 8 * len(s) for t, s in zip(texts, sets)]
            rows = batch.num_rows
            if any(n):
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=1 << SKETCH_BITS).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(size, pa.int64()),
                pa.array([_bitmap(s, SIGNATURE_BITS) for s in sets], pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        if counts.any():
            packed = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, PIECES)]
            yield pa.RecordBatch.from_arrays([
                pa.nulls(PIECES, id_type), pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.binary()),
                pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.binary()), pa.array(range(PIECES), pa.int32()), pa.array(packed, pa.binary())], names)

    return run


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sums.setdefault(piece, np.zeros((1 << SKETCH_BITS) // PIECES, np.uint64))
            own += np.frombuffer(zlib.decompress(counts), np.uint32)
    level = [np.minimum(255, np.round(8 * np.log2(s + 1.0))).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(level, pa.binary())], ["piece", "level"])


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zstd = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([zstd.compress((t or "").encode()) for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["id", "row_hash", "packed"])


def _prefixes(k: int, percent: int, levels):
    """(token, nid, n): the prefix of every node in the global order (frequency level, then hash).
    ``n`` is twice the set's size, plus 1 for shingles of the shorter index prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, last = zstandard.ZstdDecompressor(), None
        level = levels.value
        for batch in batches:
            tokens, nodes, sizes = [], [], []
            every = shingle_sets([unzip.decompress(p) for p in batch.column(1).to_pylist()], k)
            for node, s in zip(batch.column(0).to_pylist(), every):
                if node == last:
                    continue
                last = node
                order = np.lexsort((s, level[_bucket(s)]))
                tokens.append(s[order[: prefix_length(len(s), percent)]].view(np.int64))
                nodes.append(node)
                flags = np.full(len(tokens[-1]), 2 * len(s), np.int32)
                flags[: index_length(len(s), percent)] += 1
                sizes.append(flags)
            if tokens:
                times = [len(t) for t in tokens]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tokens)), pa.array(np.repeat(np.array(nodes, np.int64), times)), pa.array(np.concatenate(sizes))],
                    ["token", "nid", "n"])

    return run


class Tree:
    """A signature tree: levels[0] are the leaves, each further level joins FANOUT nodes."""

    def __init__(self, bitmaps: list[bytes], sizes: list[int]):
        self.n = len(sizes)
        bits = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(self.n, -1)
        size = np.array(sizes, np.int64)
        excess = size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, size, size, excess)]
        while len(bits) > 1:
            starts = np.arange(0, len(bits), FANOUT)
            low, high = self.levels[-1][1], self.levels[-1][2]
            bits = np.bitwise_or.reduceat(bits, starts, axis=0)
            excess = np.maximum.reduceat(excess, starts)
            self.levels.append((bits, np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), excess))

    @classmethod
    def of_sets(cls, sets: list[np.ndarray]) -> Tree:
        return cls([_bitmap(s, TREE_BITS) for s in sets], [len(s) for s in sets])

    def children(self, level: int, i: int) -> np.ndarray:
        return np.arange(i * FANOUT, min((i + 1) * FANOUT, len(self.levels[level - 1][0])))

    def span(self, level: int, i: int) -> slice:
        return slice(i * FANOUT**level, (i + 1) * FANOUT**level)


def _may_link(a, rows, b, columns, percent: int) -> np.ndarray:
    """rows x columns: whether some leaf below the one can link with some leaf below the other."""
    bits_a, low_a, high_a, excess_a = (x[rows] for x in a)
    bits_b, low_b, high_b, excess_b = (x[columns] for x in b)
    common = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2).astype(np.int64)
    # tokens in both sets fall on common bits; beyond one per bit they are part of either's excess
    most = common + np.minimum(excess_a[:, None], excess_b[None, :])
    most = np.minimum(most, np.minimum(high_a[:, None], high_b[None, :]))
    least_sum = low_a[:, None] + low_b[None, :]
    return ((100 + percent) * most >= percent * least_sum) & (
        100 * high_a[:, None] >= percent * low_b[None, :]) & (100 * high_b[None, :] >= percent * low_a[:, None])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


class Classes:
    """Union-find over leaves."""

    def __init__(self, start: list):
        self.up = np.arange(len(start))
        first: dict = {}
        for i, c in enumerate(start):
            if c is not None:
                self.up[i] = first.setdefault(c, i)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)

    def one(self, members) -> int:
        """The members' class, -1 if they have several."""
        roots = {self.find(int(i)) for i in members}
        return roots.pop() if len(roots) == 1 else -1


def traverse(x: Tree, y: Tree, offset: int, percent: int, done, visit) -> None:
    """Dual traversal from both roots. ``done(mine, theirs)``: two subtrees' leaves need no further look;
    ``visit(a, b)``: a pair of leaves that may link. Leaf j of ``y`` goes by the number offset + j."""
    stack = [(len(x.levels) - 1, 0, len(y.levels) - 1, 0)]
    while stack:
        p, i, q, j = stack.pop()
        if x is y and p == q and i > j:
            continue
        if done(range(x.n)[x.span(p, i)], range(offset, offset + y.n)[y.span(q, j)]):
            continue
        rows = x.children(p, i) if p else np.array([i])
        columns = y.children(q, j) if q else np.array([j])
        may = _may_link(x.levels[max(p - 1, 0)], rows, y.levels[max(q - 1, 0)], columns, percent)
        for r, c in zip(*np.nonzero(may)):
            a, b = int(rows[r]), int(columns[c])
            if p > 1 or q > 1:
                stack.append((max(p - 1, 0), a, max(q - 1, 0), b))
            elif not (x is y and a >= b):
                visit(a, offset + b)


def _both_sides(sides: list, tree, percent: int, done, visit) -> None:
    """All pairs within side 0, and between side 0 and side 1; ``tree(a, b)`` grows one over a range of leaves."""
    cut = sides.index(1) if 1 in sides else len(sides)
    if cut:
        left = tree(0, cut)
        traverse(left, left, 0, percent, done, visit)
        if cut < len(sides):
            traverse(left, tree(cut, len(sides)), cut, percent, done, visit)


def _hopeful(sides: list, classes: list, sizes: list, signatures: list, percent: int) -> np.ndarray:
    """Flags of the nodes that may link with another one, by their signatures alone."""
    order = sorted(range(len(sides)), key=lambda i: (sides[i], signatures[i], sizes[i]))
    marked = np.zeros(len(order), dtype=bool)
    known = [classes[i] for i in order]

    def done(mine, theirs) -> bool:
        return marked[mine.start: mine.stop].all() and marked[theirs.start: theirs.stop].all()

    def visit(a, b) -> None:
        if known[a] is None or known[a] != known[b]:
            marked[a] = marked[b] = True

    def tree(a: int, b: int) -> Tree:
        return Tree([signatures[i] for i in order[a:b]], [sizes[i] for i in order[a:b]])

    _both_sides([sides[i] for i in order], tree, percent, done, visit)
    out = np.zeros(len(order), dtype=bool)
    out[order] = marked
    return out


def _block_links(nodes: list, classes: list, sides: list, sets: list, percent: int) -> list[tuple[int, int]]:
    """New connections of a block: each node with the first node of its class, without those known before.
    ``sides``: 0 and 1 for a pair of blocks (only pairs with a member of side 0 are asked for)."""
    order = sorted(range(len(nodes)), key=lambda i: (sides[i], int(sets[i][0]), len(sets[i])))
    nodes, classes, sides, sets = ([v[i] for i in order] for v in (nodes, classes, sides, sets))
    found = Classes(classes)
    before = [found.find(i) for i in range(len(nodes))]

    def done(mine, theirs) -> bool:
        own = found.one(mine)
        return own >= 0 and own == found.one(theirs)

    def visit(a, b) -> None:
        if found.find(a) != found.find(b) and linked(sets[a], sets[b], percent):
            found.join(a, b)

    _both_sides(sides, lambda a, b: Tree.of_sets(sets[a:b]), percent, done, visit)
    out = set()
    for i in range(len(nodes)):
        if (root := found.find(i)) != before[i] and nodes[i] != nodes[root]:
            out.add((nodes[i], nodes[root]))
    return list(out)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one block after the other, from rows sorted by block (the first column, then a node id
    at place 3); a node counts once."""
    block, rows, seen = None, [], set()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != block:
                if len(rows) > 1:
                    yield rows
                block, rows, seen = row[0], [], set()
            if row[3] not in seen:
                seen.add(row[3])
                rows.append(row)
    if len(rows) > 1:
        yield rows


def _in_batches(rows: Iterator[tuple], names: list[str], types: list) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, t in enumerate(types)], names)

    for row in rows:
        held.append(row)
        if len(held) >= 10_000:
            yield batch()
            held = []
    yield batch()


def _prune(percent: int):
    """Rows (block, side, class, nid, n, signature) sorted by block -> (block, side, class, nid) of those that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for block in _blocks(batches):
                _, sides, classes, _, sizes, signatures = map(list, zip(*block))
                for row, keep in zip(block, _hopeful(sides, classes, sizes, signatures, percent)):
                    if keep:
                        yield row[:4]

        yield from _in_batches(rows(), ["block", "side", "class", "nid"], [pa.string(), pa.int32(), pa.int64(), pa.int64()])

    return run


def _links(k: int, percent: int):
    """Rows (block, side, class, nid, packed) sorted by block -> links; one block is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()

        def rows():
            for block in _blocks(batches):
                _, sides, classes, nodes, packed = map(list, zip(*block))
                sets = shingle_sets([unzip.decompress(p) for p in packed], k)
                yield from _block_links(nodes, classes, sides, sets, percent)

        yield from _in_batches(rows(), ["a", "b"], [pa.int64(), pa.int64()])

    return run


def components(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(nid, label) of every end of ``edges`` (a, b): the smallest label that can be reached. ``start``: (nid, label), a label
    is a struct that ends in a nid."""
    root = roots(edges)
    if root is None:
        return start.limit(0)
    labels = root.join(start, "nid")
    least = labels.groupBy("root").agg(F.min("label").alias("label"))
    return settle(root.join(least, "root").select("nid", "label"), "labels")


def jaccard_join(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    block_nodes: int = BLOCK_NODES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Returns ``id, row_hash, n_shingles, component_id, component`` for every row; ``row_hash`` is xxhash64 of the
    text, ``component`` a key that also tells components of null ids apart (null without shingles).

    Two documents link when 100 * |intersection| >= ``percent`` * |union| of their sets of
    distinct ``k``-word shingles; fewer words are one shingle. ``component_id`` is
    the smallest id reachable over links.

    Defined cases: a text without words, or null, has 0 shingles and is its own
    component; repeated rows and copies are one component; a null id is
    smaller than none (a component of null ids only has a null id); an empty
    table gives no rows; extra columns are ignored. Shingles are compared by
    64-bit, sets by 128-bit hashes.

    Copies meet by fingerprint only. A block over ``block_nodes`` nodes or
    ``block_bytes`` is cut by a hash into parts that each also hold the block's
    first node; across parts only nodes that are not yet connected with the
    first node are compared with all others. So a large group of near copies costs
    in proportion to its size. The frequency sketch that orders shingles has a
    fixed size (2 MB); it changes the work, never the result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    described = settle(base.mapInArrow(_describe(k), (
        f"id {id_type}, row_hash long, n long, node binary, size long, signature binary, piece int, counts binary")), "shingle-sets")
    rows = described.where(F.col("piece").isNull()).select("id", "row_hash", "n", "node", "size", "signature")
    sketch = described.where(F.col("piece").isNotNull()).select("piece", "counts").repartition(PIECES, "piece")
    level = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in sketch.mapInArrow(_sum_pieces, "piece int, level binary").collect():  # 2 MB in all
        level.reshape(PIECES, -1)[r["piece"]] = np.frombuffer(r["level"], np.uint8)
    levels = spark.sparkContext.broadcast(level)

    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_hash")).alias("first")
    nodes = settle(rows.where(F.col("n") > 0).groupBy("node").agg(
        first, F.max("size").alias("size"), F.max("n").cast("int").alias("n"), F.max("signature").alias("signature")).select(
        "node", "size", "n", "signature", "first", F.monotonically_increasing_id().alias("nid")), "nodes")
    start = nodes.select("nid", F.struct(F.col("first.no_id").alias("no_id"), F.col("first.id").alias("id"), "nid").alias("label"))
    packed = base.mapInArrow(_pack_texts, f"id {id_type}, row_hash long, packed binary")
    texts = settle(packed.join(nodes.select("nid", "first"), packed["id"].eqNullSafe(F.col("first.id")) & (
        packed["row_hash"] == F.col("first.row_hash"))).select("nid", "packed"), "node-texts")

    tokens = texts.mapInArrow(_prefixes(k, percent, levels), "token long, nid long, n int").select(
        "token", "nid", F.shiftright("n", 1).alias("n"), (F.col("n") % 2 == 1).alias("indexed"))
    order = Window.partitionBy("token").orderBy("n", "nid")
    last = F.last(F.when(F.col("indexed"), F.col("n")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.last(F.when(F.col("indexed") & ~F.col("joined"), F.col("nid")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    # along the sizes, a node belongs to the block that is open, or opens one; a gap in the sizes closes it
    runs = tokens.withColumn("joined", F.coalesce(100 * last >= percent * F.col("n"), F.lit(False))).withColumn("leader", opens)
    members = settle(runs.where("joined").select("leader", "nid").distinct(), "blocks")
    members = members.unionByName(members.select("leader", F.col("leader").alias("nid"))).distinct()
    sized = members.join(nodes.select("nid", "size"), "nid")

    def parts(frame: DataFrame, keys: list[str]) -> DataFrame:
        """The number of parts of each block."""
        return frame.groupBy(*keys).agg(F.ceil(F.greatest(
            F.count(F.lit(1)) / block_nodes, F.sum("size") / block_bytes)).cast("int").alias("parts"))

    def with_parts(frame: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
        """Each node with its part; settled counts, so that Spark can split a frequent block in the join."""
        return frame.join(settle(counted, "parts"), keys).withColumn("part", F.pmod(F.xxhash64("nid"), F.col("parts")).cast("int"))

    def search(placed: DataFrame) -> DataFrame:
        """``placed``: (block, side, class, nid) -> links. Texts of nodes that have no possible partner are
        mostly left out before the join, by a bitmap of fixed size (at most 2**FILTER_BITS / 64 rows)."""
        signed = placed.join(nodes.select("nid", "n", "signature"), "nid").select("block", "side", "class", "nid", "n", "signature")
        signed = signed.repartition("block").sortWithinPartitions("block")
        placed = settle(signed.mapInArrow(_prune(percent), "block string, side int, class long, nid long"), "placed")
        bit = F.pmod(F.xxhash64("nid"), F.lit(1 << FILTER_BITS)).alias("bit")
        wanted = placed.select(bit).groupBy((F.col("bit") / 64).cast("long").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
        asked = texts.select("nid", "packed", bit).join(F.broadcast(wanted), (F.col("bit") / 64).cast("long") == F.col("word")).where(
            F.expr("shiftrightunsigned(bits, cast(bit % 64 as int)) & 1 = 1"))
        sent = placed.join(asked.select("nid", "packed"), "nid").select("block", "side", "class", "nid", "packed")
        sent = sent.repartition("block").sortWithinPartitions("block")
        return settle(sent.mapInArrow(_links(k, percent), "a long, b long"), "links")

    in_parts = settle(with_parts(sized, parts(sized, ["leader"]), ["leader"]).select("leader", "nid", "size", "parts", "part"), "parts")
    every_part = in_parts.where((F.col("parts") > 1) & (F.col("nid") == F.col("leader"))).select(
        "leader", "nid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    placed = in_parts.select("leader", "nid", "part").unionByName(every_part)
    links = search(placed.select(
        F.concat_ws(":", "leader", "part").alias("block"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("class"), "nid"))
    labels = components(links, start)

    # blocks of several parts: what isn't connected with the leader meets all other nodes of the block
    large = in_parts.where(F.col("parts") > 1).select("leader", "nid", "size")
    class_of = start.join(labels.select("nid", F.col("label").alias("new")), "nid", "left").select(
        "nid", F.coalesce("new", "label")["nid"].alias("class"))
    classed = large.join(class_of, "nid").join(
        class_of.select(F.col("nid").alias("leader"), F.col("class").alias("core")), "leader")
    loose = settle(classed.withColumn("loose", F.col("class") != F.col("core")).select("leader", "nid", "size", "class", "loose"), "classed")
    open_blocks = loose.where("loose").select("leader").distinct()
    loose = loose.join(open_blocks, "leader")
    if not loose.isEmpty():
        cut = settle(with_parts(loose, parts(loose, ["leader", "loose"]), ["leader", "loose"]), "parts")
        heads = cut.where("loose").select("leader", F.col("part").alias("p")).distinct()
        tails = cut.select("leader", "loose", F.col("part").alias("q")).distinct()
        pairs = settle(heads.join(tails, "leader").where(~F.col("loose") | (F.col("q") >= F.col("p"))).select(
            "leader", "p", "loose", "q"), "part-pairs")
        key = F.concat_ws(":", "leader", "p", F.col("loose").cast("string"), "q").alias("block")
        near = pairs.join(cut.where("loose").select("leader", F.col("part").alias("p"), "nid", "class"), ["leader", "p"]).select(
            key, F.lit(0).alias("side"), "class", "nid")
        far = pairs.where(~F.col("loose") | (F.col("q") != F.col("p"))).join(
            cut.select("leader", "loose", F.col("part").alias("q"), "nid", "class"), ["leader", "loose", "q"]).select(
            key, F.lit(1).alias("side"), "class", "nid")
        more = search(near.unionByName(far))
        labels = components(labels.select(F.col("nid").alias("a"), F.col("label.nid").alias("b")).unionByName(more), start)

    top = start.join(labels.select("nid", F.col("label").alias("new")), "nid", "left").select("nid", F.coalesce("new", "label").alias("top"))
    component = settle(nodes.select("node", "nid").join(top, "nid").select(
        "node", F.col("top.id").alias("component_id"), F.col("top.nid").alias("component")), "components")
    return rows.join(component, "node", "left").select(
        "id", "row_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "component")
