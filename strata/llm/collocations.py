"""Phrase collocations: frequent phrases of 2 to 4 words, scored against their parts, per language.

Method: direct-address tiling. The most frequent words of a language are ranked, and a pair of ranks falls into a
square tile of the rank plane. Tiles with many pairs are counted by one dense ``bincount``, sparse ones and pairs with an
unranked word by sorting coordinates. Frequent pairs are ranked in their turn and paired with the word behind
them for phrases of three words, and those again for four.

Words go by 64-bit hash, so no dictionary has to be sent to the tasks, whatever its size. Only bounded tables
are sent: the ranks of at most ``HEAD`` symbols a level, and a bitmap of fixed size that holds every frequent symbol
(and, by chance, others, which cost work but are dropped by their exact counts).
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import settle, small_batches

TILE = 256  # ranks along a tile's side
RANKS = 2048  # ranked symbols of a language
HEAD = 1 << 16  # ranked symbols in all
DENSE = TILE * TILE // 16  # pairs from which a tile is counted densely
BITS = 24  # the bitmap of frequent symbols has 2**BITS bits
GROUP = 4 << 20  # bytes of text that are counted together
CHUNK = 2 << 20  # bytes that are hashed together
TURN = 23  # bits that a phrase's key is turned by before the next word's key comes in

_MASK = (1 << 64) - 1
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _number(n: int) -> int:
    """A fixed 64-bit number for ``n`` (one step of splitmix64)."""
    n = (n + 1) * 0x9E3779B97F4A7C15 & _MASK
    n = (n ^ n >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    n = (n ^ n >> 27) * 0x94D049BB133111EB & _MASK
    return n ^ n >> 31


def _stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Splits lower-cased bytes into pieces and words; a word's key is a polynomial of its bytes."""

    def __init__(self, seed: int):
        self.byte = np.array([_number(seed * 1000 + b) for b in range(256)], np.uint64)
        step = _number(seed * 1000 + 500) | 1
        powers = lambda x, n: np.multiply.accumulate(np.full(n, x, np.uint64))
        self.powers = lambda n: (powers(step, n), powers(pow(step, -1, 1 << 64), n))
        self.up, self.down = self.powers(CHUNK)

    def part(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, key, piece) of each word of ``data``."""
        gap = np.concatenate([[True], _GAP[data], [True]])
        edges = np.flatnonzero(gap[1:] != gap[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(data) > len(self.up):
            self.up, self.down = self.powers(len(data))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.byte[data] * self.up[: len(data)], dtype=np.uint64)])
        keys = _stir((total[ends] - total[starts]) * self.down[starts] if len(starts) else np.zeros(0, np.uint64))
        return starts, ends, keys, np.cumsum(_BREAK[data])[starts] if len(starts) else starts

    def of(self, data: np.ndarray) -> Iterator[tuple[int, int, tuple]]:
        """(start, end, part) of chunks that end at a gap."""
        at = 0
        while at < len(data):
            end = min(len(data), at + CHUNK)
            while end < len(data) and not _GAP[data[end]]:
                gaps = np.flatnonzero(_GAP[data[end: end + CHUNK]])
                end = end + int(gaps[0]) if len(gaps) else min(len(data), end + CHUNK)
            yield at, end, self.part(data[at:end])
            at = end

    def keys(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and piece of every word."""
        keys, pieces, before = [], [], 0
        for at, end, (_, _, key, piece) in self.of(data):
            keys.append(key)
            pieces.append(piece + before)
            before += int(_BREAK[data[at:end]].sum())
        return (np.concatenate(keys), np.concatenate(pieces)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """(lang, bytes): texts of a language, lower-cased, with a break between two of them."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        size = 0

        def out():
            for lang, texts in held.items():
                yield lang, np.frombuffer(b"\n".join(texts), np.uint8)

        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode().translate(_LOWER)
            held.setdefault(lang, []).append(data)
            size += len(data)
            if size >= GROUP:
                yield from out()
                held, size = {}, 0
        yield from out()


def _word_counts(seed: int):
    """Rows (lang, text) -> (lang, key, word, n), summed over a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(seed)
        for lang, data in _groups(batches):
            for at, _, (starts, ends, keys, _) in words.of(data):
                distinct, where, n = np.unique(keys, return_index=True, return_counts=True)
                names = [data[at + a: at + b].tobytes().decode() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(n), pa.string()), pa.array(distinct.view(np.int64)), pa.array(names, pa.string()), pa.array(n, pa.int64())],
                    ["lang", "key", "word", "n"])

    return run


def _turned(key: np.ndarray) -> np.ndarray:
    return (key << np.uint64(TURN)) | (key >> np.uint64(64 - TURN))


def turned(key: Column) -> Column:
    return F.shiftleft(key, TURN).bitwiseOR(F.shiftrightunsigned(key, 64 - TURN))


def phrase_key(keys: Column) -> Column:
    """The key of a phrase from the keys of its words: turned and joined by exclusive or, word by word."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda key, word: turned(key).bitwiseXOR(word))


def tiles(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank, rank, n) of the distinct pairs of ranks: dense tiles by bincount, sparse ones by sorted coordinates."""
    side = RANKS // TILE
    tile = (first // TILE) * side + second // TILE
    cell = (first % TILE) * TILE + second % TILE
    order = np.argsort(tile.astype(np.uint16), kind="stable")
    size = np.bincount(tile, minlength=side * side)
    ends = np.cumsum(size)
    found, counts, sparse = [], [], []
    for t in np.flatnonzero(size):
        inside = cell[order[ends[t] - size[t]: ends[t]]]
        if size[t] >= DENSE:
            n = np.bincount(inside, minlength=TILE * TILE)
            hit = np.flatnonzero(n)
            found.append(t * TILE * TILE + hit)
            counts.append(n[hit])
        else:
            sparse.append(t * TILE * TILE + inside)
    if sparse:
        at, n = np.unique(np.concatenate(sparse), return_counts=True)
        found.append(at)
        counts.append(n)
    if not found:
        return first[:0], second[:0], first[:0]
    at, n = np.concatenate(found), np.concatenate(counts)
    tile, cell = at // (TILE * TILE), at % (TILE * TILE)
    return tile // side * TILE + cell // TILE, tile % side * TILE + cell % TILE, n


class Symbols:
    """What the tasks know of the frequent phrases of one length: ranked keys by language, and the bitmap."""

    def __init__(self, ranked: dict[str, np.ndarray], bitmap: np.ndarray):
        self.ranked, self.bitmap = ranked, bitmap
        self.sorted = {lang: (np.sort(keys), np.argsort(keys)) for lang, keys in ranked.items()}

    def may_be(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - BITS)
        return (self.bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def rank(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """Rank of each key, -1 for the others."""
        if lang not in self.sorted:
            return np.full(len(keys), -1)
        known, order = self.sorted[lang]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, order[at], -1)


def _phrase_counts(seed: int, levels):
    """Rows (lang, text) -> (lang, prefix, word, n) of phrases one word longer than those of the last of ``levels``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, symbols = Words(seed), levels.value
        for lang, data in _groups(batches):
            key, piece = words.keys(data)
            prefix, may = key, symbols[0].may_be(key)
            for length, known in enumerate(symbols[1:], 2):
                # both shorter phrases are frequent, and no break lies inside
                both = may[:-1] & may[1:] & (piece[: len(may) - 1] == piece[length - 1:])
                prefix = _turned(prefix[:-1]) ^ key[length - 1:]
                both[both] = known.may_be(prefix[both])
                may = both
            length = len(symbols) + 1
            at = np.flatnonzero(may[:-1] & may[1:] & (piece[: max(0, len(may) - 1)] == piece[length - 1:]))
            if not len(at):
                continue
            first, second = prefix[at], key[at + length - 1]
            a, b = symbols[-1].rank(lang, first), symbols[0].rank(lang, second)
            inside = (a >= 0) & (b >= 0)
            x, y, n = tiles(a[inside], b[inside])
            # pairs without two ranks: sorted coordinates
            p, w = first[~inside], second[~inside]
            order = np.lexsort((w, p))
            p, w = p[order], w[order]
            new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (w[1:] != w[:-1])])) if len(p) else np.zeros(0, np.int64)
            ranked = lambda known, r: known.ranked[lang][r] if len(r) else np.zeros(0, np.uint64)
            columns = [np.concatenate([ranked(symbols[-1], x), p[new]]), np.concatenate([ranked(symbols[0], y), w[new]])]
            sums = np.concatenate([n, np.diff(np.append(new, len(p)))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(sums), pa.string()), *(pa.array(c.view(np.int64)) for c in columns), pa.array(sums)],
                ["lang", "prefix", "word", "n"])

    return run


def _symbols(frequent: DataFrame) -> Symbols:
    """Of ``frequent`` (lang, key, n) at most HEAD keys and the bitmap come to the driver: a fixed size. The keys are those
    over a count that a histogram of the counts (16 classes for each power of two) gives."""
    sizes = frequent.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("size")).count().collect()
    least, held = 1 << 30, 0
    for r in sorted(sizes, key=lambda r: -r["size"]):
        held += r["count"]
        if held > HEAD:
            break
        least = r["size"]
    top = frequent.where(F.floor(F.log2("n") * 16) >= least).select("lang", "key", "n").collect()
    top.sort(key=lambda r: (-r["n"], r["lang"], r["key"]))
    ranked: dict[str, list[int]] = {}
    for r in top:
        if len(own := ranked.setdefault(r["lang"], [])) < RANKS:
            own.append(r["key"])
    at = F.shiftrightunsigned("key", 64 - BITS)
    slots = frequent.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    bitmap[slots.column("slot").to_numpy().astype(np.int64)] = slots.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return Symbols({lang: np.array(keys, np.int64).view(np.uint64) for lang, keys in ranked.items()}, bitmap)


def phrases(docs: DataFrame, min_count: int, longest: int, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """((lang, m, key, keys, phrase, n) of all words and phrases with n >= ``min_count``, (lang, n) of all words).

    Keys that two words or phrases of a language share are counted with another seed, until none are.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seed = 0
    while True:
        seed += 1
        counted = settle(rows.mapInArrow(_word_counts(seed), "lang string, key long, word string, n long").groupBy("lang", "key", "word").agg(
            F.sum("n").alias("n")), "words")
        shared = counted.groupBy("lang", "key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
        if not shared.where((F.col("words") > 1) & (F.col("n") >= min_count)).isEmpty():
            continue
        single = counted.where(F.col("n") >= min_count).select(
            "lang", F.lit(1).alias("m"), "key", F.array("key").alias("keys"), F.col("word").alias("phrase"), "n")
        found = [settle(single, "phrases-1")]
        known = [_symbols(found[0])]
        for m in range(2, longest + 1):
            levels = spark.sparkContext.broadcast(known)
            pairs = rows.mapInArrow(_phrase_counts(seed, levels), "lang string, prefix long, word long, n long")
            pairs = pairs.groupBy("lang", "prefix", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
            head = found[-1].select("lang", F.col("key").alias("prefix"), F.col("keys").alias("head"), F.col("phrase").alias("start"))
            tail = found[0].select("lang", F.col("key").alias("word"), F.col("phrase").alias("last"))
            found.append(settle(pairs.join(head, ["lang", "prefix"]).join(tail, ["lang", "word"]).select(
                "lang", F.lit(m).alias("m"), turned(F.col("prefix")).bitwiseXOR(F.col("word")).alias("key"),
                F.concat("head", F.array("word")).alias("keys"), F.concat_ws(" ", "start", "last").alias("phrase"), "n"), f"phrases-{m}"))
            if m < longest:
                known.append(_symbols(found[-1]))
        everything = reduce(DataFrame.unionByName, found)
        if everything.groupBy("lang", "m", "key").count().where("count > 1").isEmpty():
            return everything, counted.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame, min_count: int = 30, longest: int = 4, scale: int = 2_000_000, cover_percent: int = 80, top: int = 2000,
    lang_col: str = "lang", text_col: str = "text", salts: int = 32,
) -> DataFrame:
    """Returns ``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases.

    Texts, A-Z lower-cased, are cut at ``. , ; : ! ?`` and the ASCII line ends into pieces, and those at blanks and
    tabs into words. Candidates are phrases of 2 to ``longest`` words inside a piece that occur ``a`` >= ``min_count``
    times (overlaps count). A cut after the first words gives ``l`` and ``r``, how often the first part and the
    rest occur, and floor(scale * a / (l + r)); the lowest cut counts, of equal ones the first. A candidate is
    dropped if a longer one holds its words in a row and 100 * a of the longer >= ``cover_percent`` * a. Order:
    score and ``a`` descending, then the phrase by its UTF-8 bytes. ``n`` counts all words of the language.

    Defined cases: a null language is ``und`` and counts together with rows that say so; a null or empty text, or one without
    words, adds nothing; a language without candidates has no rows; an empty table gives none; repeated rows
    count each; other columns are ignored. Counts are exact; scores are worked out in decimals of 38 digits.

    Tasks count chunks and Spark sums them, twice (in the task and behind the shuffle), so a language or a phrase may
    hold any share of the rows. To the driver come at most HEAD keys and 2 MB of bits a length.
    """
    small_batches(docs.sparkSession)
    everything, totals = phrases(docs, min_count, longest, lang_col, text_col)
    candidates = everything.where(F.col("m") > 1)
    count_of = everything.select("lang", F.col("m").alias("of_m"), F.col("key").alias("of_key"), F.col("n").alias("of_n"))
    k, m = F.col("k"), F.col("m")
    cuts = candidates.select("lang", "m", "key", "keys", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), m - 1)).alias("k")).select(
        "lang", "m", "key", "a", "k", phrase_key(F.slice("keys", F.lit(1), k)).alias("left"), phrase_key(F.slice("keys", k + 1, m - k)).alias("right"))
    with_left = cuts.join(count_of.withColumnsRenamed({"of_m": "k", "of_key": "left", "of_n": "l"}), ["lang", "k", "left"]).withColumn("rest", m - k)
    with_both = with_left.join(count_of.withColumnsRenamed({"of_m": "rest", "of_key": "right", "of_n": "r"}), ["lang", "rest", "right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.call_function("div", wide("a") * F.lit(scale).cast("decimal(10,0)"), wide("l") + wide("r")).cast("long")
    scored = with_both.groupBy("lang", "m", "key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = candidates.where(m > 2).select("lang", "n", "keys", F.explode(F.sequence(F.lit(2), m - 1)).alias("m"), F.size("keys").alias("of")).select(
        "lang", "n", "m", F.explode(F.transform(F.sequence(F.lit(1), F.col("of") - m + 1), lambda i: phrase_key(F.slice("keys", i, m)))).alias("key"))
    longer = inner.groupBy("lang", "m", "key").agg(F.max("n").alias("cover"))
    kept = candidates.join(longer, ["lang", "m", "key"], "left").where(
        F.col("cover").isNull() | (wide("cover") * F.lit(100).cast("decimal(10,0)") < wide("n") * F.lit(cover_percent).cast("decimal(10,0)")))
    full = kept.join(scored, ["lang", "m", "key"]).select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = full.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
