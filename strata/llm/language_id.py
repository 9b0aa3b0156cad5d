"""Language identification by prediction by partial matching (PPM).

One byte context tree per language, up to three bytes deep, gives each byte
the frozen probability of its longest known context (escape method C: a
context seen n times with d different successors keeps d / (n + d) for the
escape to the next shorter context, down to 1/256). A text belongs to the
language whose tree gives it the shortest exact code length.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches

START = b"\n\n\n"  # what stands before a text
CHUNK = 2 << 20  # bytes scored together


@dataclass
class Trees:
    """Frozen statistics of all languages, compiled to tables: bits[...] has a column per language."""

    langs: list[str]
    tri: np.ndarray  # known 3-byte strings, sorted; their place + 1 is their number
    tri_bits: np.ndarray  # number -> bits of the last byte after the first two
    pair_bits: np.ndarray  # 2-byte string -> bits of the last byte after the first
    pair_escape: np.ndarray  # 2-byte context -> bits of its escape
    node: np.ndarray  # number of a 3-byte context -> its node, 0 if it has none
    node_escape: np.ndarray  # node -> bits of its escape
    quad: np.ndarray  # node * 256 + byte, sorted
    quad_bits: np.ndarray  # number -> bits of the byte after the node
    key: str = field(default_factory=lambda: uuid.uuid4().hex)  # tells models apart in a worker that outlives them


def _bits(count, total, distinct, lower):
    """Code length of a successor: in the context itself, after its escape, or without the context."""
    with np.errstate(divide="ignore", invalid="ignore"):
        known = np.log2(total + distinct) - np.log2(count)
        after = np.log2(total + distinct) - np.log2(distinct) + lower
    return np.where(count > 0, known, np.where(total > 0, after, lower))


def _escape(total, distinct):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(total > 0, np.log2(total + distinct) - np.log2(distinct), 0.0)


def compile_trees(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], min_node: int, max_nodes: int) -> Trees:
    """``counts``: language -> (4-byte strings as integers, how often)."""
    n = len(langs)
    keys = np.unique(np.concatenate([counts[x][0] for x in langs] or [np.zeros(0, np.int64)]))
    table = np.zeros((len(keys), n))
    for j, x in enumerate(langs):
        np.add.at(table[:, j], np.searchsorted(keys, counts[x][0]), counts[x][1])

    def shorter(keys, table, mask):
        out, at = np.unique(keys & mask, return_inverse=True)
        sums = np.zeros((len(out), n))
        np.add.at(sums, at, table)
        return out, sums

    last, last_counts = shorter(keys, table, 0xFFFFFF)
    tri = np.union1d(last, keys >> 8)  # contexts too, though the start of a text ends no string
    tri_counts = np.zeros((len(tri), n))
    tri_counts[np.searchsorted(tri, last)] = last_counts
    pair_keys, pair_sums = shorter(tri, tri_counts, 0xFFFF)
    pair_counts = np.zeros((65536, n))
    pair_counts[pair_keys] = pair_sums
    one_counts = pair_counts.reshape(256, 256, n).sum(axis=0)

    def contexts(keys, table, size):
        total, distinct = np.zeros((size, n)), np.zeros((size, n))
        np.add.at(total, keys, table)
        np.add.at(distinct, keys, table > 0)
        return total, distinct

    zero = _bits(one_counts, one_counts.sum(axis=0), (one_counts > 0).sum(axis=0), np.full((256, n), 8.0))
    total, distinct = contexts(np.arange(65536) >> 8, pair_counts, 256)
    first = np.arange(65536) >> 8
    pair_bits = _bits(pair_counts, total[first], distinct[first], np.tile(zero, (256, 1)))
    total, distinct = contexts(tri >> 8, tri_counts, 65536)
    tri_bits = _bits(tri_counts, total[tri >> 8], distinct[tri >> 8], pair_bits[tri & 0xFFFF])
    pair_escape = _escape(total, distinct)
    # contexts of three bytes: kept where seen often enough in a language
    ctx, at = np.unique(keys >> 8, return_inverse=True)
    total, distinct = contexts(at, table, len(ctx))
    most = total.max(axis=1) if len(ctx) else np.zeros(0)
    kept = np.flatnonzero(most >= min_node)
    if len(kept) > max_nodes:
        kept = np.sort(kept[np.lexsort((kept, -most[kept]))[:max_nodes]])
    number = np.zeros(len(ctx), np.int64)
    number[kept] = np.arange(1, len(kept) + 1)
    node = np.zeros(len(tri) + 1, np.int32)
    node[np.searchsorted(tri, ctx[kept]) + 1] = number[kept]
    rows = number[at] > 0
    quad_bits = _bits(table[rows], total[at[rows]], distinct[at[rows]], tri_bits[np.searchsorted(tri, keys[rows] & 0xFFFFFF)])
    pad = lambda a: np.concatenate([np.zeros((1, n)), a]).astype(np.float32)
    return Trees(langs, tri, pad(tri_bits), pair_bits.astype(np.float32), pair_escape.astype(np.float32), node,
                 pad(_escape(total[kept], distinct[kept])), number[at[rows]] * 256 + (keys[rows] & 0xFF), pad(quad_bits))


class Scorer:
    """Code lengths of texts; look-up tables are opened out once per Python worker."""

    _ready: dict = {}

    def __init__(self, trees: Trees):
        self.t = trees
        self.tri = np.zeros(1 << 24, np.int32)
        self.tri[trees.tri] = np.arange(1, len(trees.tri) + 1)
        self.quad = np.zeros(len(trees.node_escape) * 256, np.int32)
        self.quad[trees.quad] = np.arange(1, len(trees.quad) + 1)

    @classmethod
    def of(cls, broadcast) -> Scorer:
        key = broadcast.value.key
        if key not in cls._ready:
            cls._ready.clear()
            cls._ready[key] = cls(broadcast.value)
        return cls._ready[key]

    def bits(self, data: np.ndarray) -> np.ndarray:
        """Bits of each byte from the fourth on, given the three before it: bytes x languages."""
        t, b = self.t, data.astype(np.int32)
        pair = (b[:-1] << 8) | b[1:]
        tri = self.tri[(pair[:-1] << 8) | b[2:]]
        node, byte = t.node[tri[:-1]], b[3:]
        quad = self.quad[(node << 8) | byte]
        quad[node == 0] = 0
        out = t.quad_bits[quad]
        short = np.flatnonzero(quad == 0)
        if len(short):
            last = tri[1:][short]
            less = t.node_escape[node[short]] + t.tri_bits[last]
            bare = np.flatnonzero(last == 0)
            if len(bare):
                at = short[bare]
                less[bare] += t.pair_escape[pair[1:-1][at]] + t.pair_bits[pair[2:][at]]
            out[short] = less
        return out

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Code length of every text in every language."""
        out = np.zeros((len(texts), len(self.t.langs)))
        pieces: list[tuple[int, bytes]] = []
        held = 0

        def flush():
            data = np.frombuffer(b"".join(p for _, p in pieces), np.uint8)
            bits = self.bits(data)
            ends = np.cumsum([len(p) for _, p in pieces])
            starts = np.concatenate([[0], ends[:-1]])
            # a piece's own bytes follow its three bytes of context; row r scores byte r + 3
            marks = np.stack([starts, np.minimum(ends - 3, len(bits))], axis=1).ravel()
            padded = np.concatenate([bits, np.zeros((1, bits.shape[1]), np.float32)])
            sums = np.add.reduceat(padded, marks, axis=0, dtype=np.float64)[::2]
            for (j, _), s in zip(pieces, sums):
                out[j] += s

        for j, text in enumerate(texts):
            whole = START + text
            for at in range(3, len(whole), CHUNK):
                pieces.append((j, whole[at - 3: at + CHUNK]))
                held += len(pieces[-1][1])
                if held >= CHUNK:
                    flush()
                    pieces, held = [], 0
        if pieces:
            flush()
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, 4-byte string, count) over the batch's texts."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text.encode())
        for lang, texts in by_lang.items():
            grams = []
            for text in texts:
                b = np.frombuffer(START + text, np.uint8).astype(np.int64)
                grams.append((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
            keys, counts = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents is never learned from (null ids neither)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_limit(docs_per_lang: int, rows: int) -> int:
    """The largest 64-bit hash of a document that is learned from, of a language of ``rows`` documents: its share of the whole range."""
    return max(-(1 << 63), min((1 << 63) - 1, (docs_per_lang << 64) // max(1, rows) - (1 << 63)))


def train(
    docs: DataFrame, docs_per_lang: int = 1500, min_node: int = 4, max_nodes: int = 65535,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Trees:
    """Fits the trees on a bounded sample: about ``docs_per_lang`` whole documents of each
    language, chosen by a hash of the id among those not held out.

    The counts are made by Spark; the driver gets those of the sample's 4-byte
    strings. Of a language's three-byte contexts those seen ``min_node`` times
    or more in some language become nodes, ``max_nodes`` at most. Held-out
    rows and rows without id, text or language are not used.
    """
    small_batches(docs.sparkSession)
    used = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["count"] for r in used.groupBy("lang").count().collect()}
    if not sizes:
        return compile_trees([], {}, min_node, max_nodes)
    limit = F.create_map(*(x for k, v in sizes.items() for x in (F.lit(k), F.lit(sample_limit(docs_per_lang, v)))))
    sample = used.where(F.xxhash64(F.col("id").cast("string"), F.lit(5)) <= F.element_at(limit, F.col("lang")))
    grams = sample.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    rows = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(sizes)
    lang = np.array(rows.column("lang").to_pylist())
    gram, n = rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    return compile_trees(langs, {x: (gram[lang == x], n[lang == x]) for x in langs}, min_node, max_nodes)


def predict(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Returns ``kept`` (a struct of the columns ``keep``, default: the id), ``lang_pred, score, bits_per_byte``.

    ``score`` is the best language's share of the probability that all
    languages' models together give the whole text (equal priors).

    Defined cases: a null text and a text without letters are ``und`` with
    score 0 and no bits; so is every text when nothing could be learned; equal
    code lengths go to the language that sorts first; repeated rows are
    predicted each; an empty table gives no rows; extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by max_nodes and the sample
    keep = keep or [id_col]
    ready = docs.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
        F.when(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)), F.col(text_col)).alias("scored_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.of(shared)
        langs = scorer.t.langs
        for batch in batches:
            texts = [(i, t.encode()) for i, t in enumerate(batch.column(len(keep)).to_pylist()) if t is not None]
            pred, score, rate = ["und"] * batch.num_rows, [0.0] * batch.num_rows, [None] * batch.num_rows
            if langs and texts:
                totals = scorer.totals([t for _, t in texts])
                best = totals.argmin(axis=1)
                least = totals.min(axis=1)
                share = 1 / np.exp2(np.maximum(least[:, None] - totals, -1000)).sum(axis=1)
                for (i, t), b, s, bits in zip(texts, best, share, least):
                    pred[i], score[i], rate[i] = langs[b], float(s), float(bits) / len(t)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
                [*(f"k{i}" for i in range(len(keep))), "lang_pred", "score", "bits_per_byte"])

    schema = ", ".join(f"k{i} {ready.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    out = ready.mapInArrow(run, f"{schema}, lang_pred string, score double, bits_per_byte double")
    return out.select(F.struct(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]).alias("kept"), "lang_pred", "score", "bits_per_byte")
