"""Exact top-k inner-product search with a bit-sliced index.

Every attribute (vector component) of a block of rows is stored as bit
slices: one bitmap over the rows for each bit of the quantised attribute. For a
query the slices are added with bitmap arithmetic (carry-save adders on
machine words, all queries of a block at once), which gives the slices of a
coarse score. The k-th largest coarse score is found from the most significant
slice downward; rows that can still reach it within the quantisation bound
are the boundary rows, and only these are resolved by exact integer products.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import settle

SLICES = 6  # bits kept of every attribute
INDEX_BLOCK = 4096  # rows of an index block
QUERY_BLOCK = 4096  # queries sent together to an index block, more once there are PAIRS pairs of blocks
PAIRS = 256
COMPONENTS = 1 << 21  # of the queries in such a larger block, at most
ADDED_TOGETHER = 512  # queries of a block whose slices are added at once
GROUP = 8  # attributes of which all subsets are summed beforehand


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows on the last axis to bitmaps of 64-bit words."""
    n = bits.shape[-1]
    pad = -n % 64
    if pad:
        bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), dtype=bool)], axis=-1)
    # packbits keeps the layout of transposed bits (of 64 rows, 128, ..., which need no padding); words need a contiguous last axis
    return np.packbits(np.ascontiguousarray(bits), axis=-1, bitorder="little").view(np.uint64)


def _unpack(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def _matrix(vectors: list, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest integer type that holds them all."""
    least, most = (values.min(), values.max()) if values.size else (0, 0)
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max))


def build_block(rows: pd.DataFrame) -> pd.DataFrame:
    """One index block: row ids, exact attributes, and the attribute slices."""
    dims = max(map(len, rows["v"]))
    exact = _matrix(rows["v"], dims)
    low = exact.min(axis=0) if dims else np.zeros(0, np.int64)
    span = int((exact.max(axis=0) - low).max()) if dims else 0
    shift = max(0, span.bit_length() - SLICES)
    level = (exact - low) >> shift
    slices = np.stack([_pack(((level >> b) & 1).T.astype(bool)) for b in range(SLICES)], axis=1) if dims else np.zeros((0, SLICES, 0), np.uint64)
    exact = _narrow(exact)
    return pd.DataFrame({
        "index_block": [rows["index_block"].iloc[0]], "n": [len(rows)], "dims": [dims], "shift": [shift],
        "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "exact": [exact.tobytes()], "exact_type": [exact.dtype.str],
        "slices": [slices.tobytes()],
    })


def _add(columns: list[list[np.ndarray]], at: int, bitmap: np.ndarray, spare: list[np.ndarray]) -> None:
    """Add ``bitmap`` at weight 2**at, modulo 2**len(columns); three bitmaps of a weight become
    a sum and a carry. Bitmaps are overwritten, and those no longer needed go to ``spare``."""
    while at < len(columns):
        columns[at].append(bitmap)
        if len(columns[at]) < 3:
            return
        a, b, c = columns[at]
        half = np.bitwise_xor(a, b, out=_take(spare, a.shape))
        np.bitwise_and(a, b, out=a)
        np.bitwise_and(c, half, out=b)
        np.bitwise_xor(c, half, out=c)
        columns[at], bitmap = [c], np.bitwise_or(a, b, out=a)
        spare += [b, half]
        at += 1
    spare.append(bitmap)


def _take(spare: list[np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    return spare.pop() if spare else np.empty(shape, np.uint64)


def subset_sums(slices: np.ndarray) -> np.ndarray:
    """Slices (first axis) of the sum of each subset of some attributes; subset s holds attribute i if bit i of s is set."""
    most = len(slices) * ((1 << slices.shape[1]) - 1)
    sums = np.zeros((most.bit_length(), 1, slices.shape[2]), np.uint64)
    for attribute in slices:
        more, carry = np.empty_like(sums), np.zeros_like(sums[0])
        for b, bits in enumerate(sums):
            other = attribute[b] if b < len(attribute) else np.uint64(0)
            half = bits ^ other
            np.bitwise_xor(half, carry, out=more[b])
            carry = (bits & other) | (carry & half)
        sums = np.concatenate([sums, more], axis=1)
    return sums


def coarse_scores(queries: np.ndarray, slices: np.ndarray) -> list[np.ndarray]:
    """Slices (least significant first) of sum(|q_d| * level_d), where the level
    is complemented for negative q_d; each an array queries x words.

    Attributes go in groups, whose subsets are summed first: bit c of the queries'
    components (two's complement) then chooses one sum for each group. What that
    differs from the complemented levels by is the same for all rows of a query.
    """
    (n, dims), words = queries.shape, slices.shape[2]
    size, top = np.abs(queries), (1 << slices.shape[1]) - 1
    sign_bit = int(size.max()).bit_length()
    columns: list[list[np.ndarray]] = [[] for _ in range((int(size.sum(axis=1).max()) * top).bit_length())]
    spare: list[np.ndarray] = []
    constant = top * np.where(queries < 0, size, 0).sum(axis=1).astype(object)  # integers of any length
    together = min(GROUP, max(1, n.bit_length() - 1))  # not many more subsets than queries
    for first in range(0, dims, together):
        sums, part = subset_sums(slices[first : first + together]), queries[:, first : first + together]
        for c in range(sign_bit + 1):
            subset = ((part >> c) & 1) @ (1 << np.arange(part.shape[1]))
            for b, bits in enumerate(sums):
                chosen = np.take(bits, subset, axis=0, out=_take(spare, (n, words)), mode="clip")
                if c == sign_bit:  # counts below zero: the complement, and a constant less
                    np.invert(chosen, out=chosen)
                _add(columns, b + c, chosen, spare)
        constant -= ((1 << len(sums)) - 1) << sign_bit
    for at in range(len(columns)):
        chosen = _take(spare, (n, words))
        chosen[:] = np.where(((constant >> at) & 1).astype(bool), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
        _add(columns, at, chosen, spare)
    out, carry = [], []
    for parts in columns:
        parts, carry = parts + carry, []
        while len(parts) > 1:
            a, b = parts.pop(), parts.pop()
            carry.append(a & b)
            parts.append(a ^ b)
        out.append(parts[0])
    return out


def boundary_rows(score: list[np.ndarray], k: np.ndarray, slack: np.ndarray, n: int) -> np.ndarray:
    """Boolean queries x rows: rows whose coarse score is at least (k-th largest) - slack."""
    q, words = len(k), -(-n // 64)
    valid = _pack(np.ones((1, n), dtype=bool))
    above, level = np.zeros((q, words), np.uint64), np.repeat(valid, q, axis=0)
    kth = [0] * q
    for i in range(len(score) - 1, -1, -1):  # from the most significant slice downward
        here = above | (level & score[i])
        enough = np.bitwise_count(here).sum(axis=1) >= k
        level = np.where(enough[:, None], level & score[i], level & ~score[i])
        above = np.where(enough[:, None], above, here)
        for j in np.flatnonzero(enough):
            kth[j] += 1 << i
    least = [max(0, int(t) - int(s)) for t, s in zip(kth, slack)]
    more, same = np.zeros((q, words), np.uint64), np.repeat(valid, q, axis=0)
    for i in range(len(score) - 1, -1, -1):
        bit = np.array([np.uint64(0xFFFFFFFFFFFFFFFF) if (t >> i) & 1 else np.uint64(0) for t in least])[:, None]
        more |= same & score[i] & ~bit
        same &= ~(score[i] ^ bit)
    return _unpack(more | same, n)


def search_block(block: pd.Series, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query position, vec_id, score) of each query's best ``k`` rows of one block."""
    n, dims = int(block["n"]), int(block["dims"])
    width = max(dims, queries.shape[1])
    ids = np.frombuffer(block["ids"], np.int64)
    exact = np.frombuffer(block["exact"], np.dtype(block["exact_type"])).reshape(n, dims)
    slices = np.frombuffer(block["slices"], np.uint64).reshape(dims, SLICES, -1)
    asked = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    shared = asked[:, :dims]
    own = (query_ids[:, None] == ids[None, :])
    if dims:
        # |q| * level <= exact part < |q| * (level + 1 step): the bound on what the low bits can add
        slack = np.abs(shared).sum(axis=1) * ((1 << int(block["shift"])) - 1) / (1 << int(block["shift"]))
        picked = boundary_rows(coarse_scores(shared, slices), np.minimum(k + own.sum(axis=1), n), np.ceil(slack).astype(np.int64) + 1, n)
    else:
        picked = np.ones((len(asked), n), dtype=bool)
    picked &= ~own
    out = []
    for j in range(len(asked)):
        rows = np.flatnonzero(picked[j])
        if not len(rows):
            continue
        score = exact[rows].astype(np.int64) @ shared[j]
        best = np.lexsort((ids[rows], -score))[:k]
        out.extend((j, int(ids[rows[b]]), int(score[b])) for b in best)
    return out


def blocks(n_rows: int, n_asked: int, dims: int, index_block: int, query_block: int) -> tuple[int, int]:
    """Blocks of rows and blocks of queries: each of the latter copies the index, so there are
    no more than ``PAIRS`` pairs of blocks ask for, or queries of ``COMPONENTS`` in all."""
    n_index, most = max(1, -(-n_rows // index_block)), max(query_block, COMPONENTS // max(1, dims))
    return n_index, max(1, -(-n_asked // most), min(-(-n_asked // query_block), -(-PAIRS // n_index)))


def quantised(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component; rows that can't be scored are left out."""
    x = F.col(vec_col)
    usable = x.isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull()).where(usable).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))


def topk(
    vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 10, scale: int = 1024, id_col: str = "vec_id",
    vec_col: str = "embedding", index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Returns ``query_id, rank, vec_id, score`` for the rows whose id satisfies ``is_query`` (k rows per query, fewer if there are fewer candidates).

    The score is the integer inner product of floor(scale * x); ties go to the
    smaller id. A row never answers a query with its own id.

    Defined cases: null vectors, vectors with a null, NaN or infinite component
    and rows without id take no part; a shorter vector counts as padded with
    zeros, an empty one scores 0; of repeated rows each is a candidate, and
    each repeated query is answered; no usable row or no query: empty result;
    extra columns are ignored. Components must keep scores within a long
    (|scale * x| < 2**28).

    All blocks of queries meet all blocks of rows, two blocks per task at a
    time; a block pair needs some MB whatever the table's size, and sends on k
    rows per query. The blocks are about equally large, so that neither side
    travels much more than the other; with many index blocks the queries' grow
    up to ``COMPONENTS``, so that the index is copied less often.
    """
    rows = settle(quantised(vectors, scale, id_col, vec_col).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(is_query(F.col("vec_id")))
    n_rows, n_asked, dims = rows.agg(F.count(F.lit(1)), F.count_if(is_query(F.col("vec_id"))), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_index, n_query = blocks(n_rows, n_asked, dims, index_block, query_block)
    index = settle(
        rows.withColumn("index_block", F.pmod(F.xxhash64("uid"), F.lit(n_index)).cast("int"))
        .groupBy("index_block").applyInPandas(
            build_block,
            "index_block int, n int, dims int, shift int, ids binary, exact binary, exact_type string, slices binary"),
        "bit-slices")
    queries = asked.withColumn("query_block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(n_query)).cast("int"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("uid", "query_id", "vec_id", "score")})
        uids, own = right["uid"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        matrix = _matrix(right["v"], max(map(len, right["v"])))
        found = [np.zeros((0, 4), np.int64)]
        for _, block in left.iterrows():
            for at in range(0, len(own), ADDED_TOGETHER):
                some = slice(at, at + ADDED_TOGETHER)
                j, vec, score = np.array(search_block(block, matrix[some], own[some], k), dtype=np.int64).reshape(-1, 3).T
                found.append(np.stack([uids[some][j], own[some][j], vec, score], axis=1))
        return pd.DataFrame(np.concatenate(found), columns=["uid", "query_id", "vec_id", "score"])

    spread_index = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    spread_query = queries.withColumn("index_block", F.explode(F.sequence(F.lit(0), F.lit(n_index - 1))))
    found = (
        spread_index.groupBy("query_block", "index_block")
        .cogroup(spread_query.groupBy("query_block", "index_block"))
        .applyInPandas(meet, "uid long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
