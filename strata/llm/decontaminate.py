"""Benchmark decontamination by winnowed fingerprints.

Method: hash every k-gram of words, keep the smallest hash of each sliding
window of ``w`` k-grams, join the fingerprints of documents and benchmark items,
and extend the hits word by word. Any span of ``k + w - 1`` shared words has
a common fingerprint, so with k = w = 7 no shared 13-word window is missed.
"""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, let, settle

# Fixed value: words are runs of digits, letters a-z and characters beyond ASCII; this is what lies between them.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z (null: none)."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, -1), lambda x: x != "")


def _grams(hashes: Column, k: int) -> Column:
    """Hashes of all k-grams of word hashes, in order. (Elements are read one by
    one: ``slice`` inside a lambda would copy the whole array each time.)"""
    return F.when(F.size(hashes) < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k)))))


def _word_hashes(word_list: Column) -> Column:
    return F.transform(word_list, lambda x: F.xxhash64(x))


def _smallest(grams: Column, w: int) -> Column:
    """array<struct<pos, h>>: the k-grams that are the smallest of some window of ``w`` k-grams.

    A k-gram is the smallest of a window that holds it iff the largest of its
    windows' minima equals it. Ties are all kept. Fewer than ``w`` k-grams are one window.
    """
    def pick(h: Column) -> Column:
        last = F.greatest(F.size(h) - w, F.lit(0))  # start of the last window
        minima = F.transform(F.sequence(F.lit(0), last), lambda i: F.least(*(F.get(h, i + j) for j in range(w))))
        return let(minima, lambda m: F.filter(
            F.transform(h, lambda x, i: F.when(
                F.greatest(*(F.get(m, i - j) for j in range(w))) == x, F.struct(i.alias("pos"), x.alias("h")))),
            lambda s: s.isNotNull()))

    return let(grams, lambda h: F.when(F.size(h) == 0, F.array().cast("array<struct<pos:int,h:bigint>>")).otherwise(pick(h)))


def _winnow(word_list: Column, k: int, w: int) -> Column:
    return let(_word_hashes(word_list), lambda hs: _smallest(_grams(hs, k), w))


def _prints(word_list: Column, k: int, w: int, lengths: list[int]) -> Column:
    """array<struct<of, pos, h>>: the winnowed k-grams (``of`` 0), and all grams of every one of ``lengths`` (``of``)."""
    def tagged(found: Column, of: int) -> Column:
        return F.transform(found, lambda s: F.struct(F.lit(of).alias("of"), s["pos"].alias("pos"), s["h"].alias("h")))

    def every(hs: Column, m: int) -> Column:
        return F.transform(_grams(hs, m), lambda x, i: F.struct(i.alias("pos"), x.alias("h")))

    return let(_word_hashes(word_list), lambda hs: F.flatten(F.array(
        tagged(_smallest(_grams(hs, k), w), 0), *(tagged(every(hs, m), m) for m in lengths))))


def _ranges(ws: Column, item: Column, shift: Column, window: int) -> Column:
    """The document positions (``start, end``) that the item's windows cover where its first word is laid at ``shift``:
    runs of equal words that are as long as a window."""
    need = F.least(F.lit(window), F.size(item))
    same = F.concat(F.transform(item, lambda x, i: F.get(ws, i + shift).eqNullSafe(x)), F.array(F.lit(False)))

    def step(acc: Column, equal: Column) -> Column:
        span = F.struct((acc["at"] - acc["run"]).alias("start"), acc["at"].alias("end"))
        done = ~equal & (acc["run"] >= need)
        return F.struct((acc["at"] + 1).alias("at"), F.when(equal, acc["run"] + 1).otherwise(0).alias("run"),
                        F.when(done, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    begin = F.struct(shift.alias("at"), F.lit(0).alias("run"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(same, begin, step, lambda acc: acc["spans"])


def _covered(spans: Column) -> Column:
    """How many positions lie in at least one span."""
    step = lambda acc, s: F.struct(
        F.greatest(acc["reach"], s["end"]).alias("reach"),
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["reach"], s["start"]))).alias("n"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n")), step, lambda acc: acc["n"])


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, k: int = 7, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """Returns ``id, kept, n_words, n_hit, items`` for every document row; ``kept`` is a struct of the text and
    the columns ``keep``.

    A window is ``window`` consecutive item words; an item of fewer words, but
    not none, is one window. ``n_hit`` counts the document's words inside any
    occurrence of a window, ``items`` lists the ids of the items with occurring windows.

    Defined cases: a null or wordless text has no words and no hit; a null or
    wordless item has no window; repeated documents are judged separately,
    repeated item rows count once in ``items``; null ids are kept (a null item
    id hits but is not listed); empty tables give no rows or no hits; extra
    columns are ignored.

    Documents are joined by their fingerprints only (12 bytes per kept
    k-gram). Benchmark fingerprints are written first, so Spark broadcasts them
    only when their size on disk allows and else shuffles both sides; AQE then
    splits a frequent fingerprint.
    """
    w = window - k + 1
    keep = [c for c in keep or [] if c != text_col]
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row_hash"), F.struct(text_col, *keep).alias("kept"))
    text = F.col("kept")[text_col]
    items = settle(
        benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("item_words"))
        .where(F.size("item_words") > 0)
        .withColumn("item_key", F.xxhash64("item_id", "item_words")).dropDuplicates(["item_id", "item_key", "item_words"]),
        "items")
    short = [r[0] for r in items.where(F.size("item_words") < window).select(F.size("item_words")).distinct().collect()]  # at most window - 1 lengths

    lengths = sorted(short)
    own = F.filter(_prints(F.col("item_words"), k, w, lengths), lambda s: s["of"] == F.when(
        F.size("item_words") >= window, 0).otherwise(F.size("item_words")))
    prints = settle(items.select("item_key", F.inline(own)).withColumnRenamed("pos", "item_pos"), "item-prints")
    # the texts are read and split once for the items of all lengths
    hits = settle(
        base.select("id", "row_hash", F.inline(_prints(words(text), k, w, lengths))).join(prints, ["of", "h"])
        .select("id", "row_hash", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct(), "hits")  # alignments
    per_item = hits.groupBy("id", "row_hash", "item_key").agg(F.collect_list("shift").alias("shifts"))
    per_doc = per_item.join(items, "item_key").groupBy(F.col("id").alias("hit_id"), F.col("row_hash").alias("hit_hash")).agg(
        F.collect_list(F.struct("item_id", "shifts", "item_words")).alias("hits"))
    joined = base.join(
        per_doc, base["id"].eqNullSafe(per_doc["hit_id"]) & (base["row_hash"] == per_doc["hit_hash"]), "left")

    def extend(ws: Column, hit: Column) -> Column:
        """The hit's item and the document positions that its occurring windows cover."""
        return F.struct(hit["item_id"].alias("item_id"), F.flatten(F.transform(
            hit["shifts"], lambda shift: _ranges(ws, hit["item_words"], shift, window))).alias("spans"))

    none = F.array().cast("array<struct<item_id:%s,spans:array<struct<start:int,end:int>>>>" % items.schema["item_id"].dataType.simpleString())
    found = let(words(text), lambda ws: F.struct(
        F.size(ws).alias("n"),
        F.when(F.col("hits").isNull(), none).otherwise(F.filter(
            F.transform(F.col("hits"), lambda h: extend(ws, h)), lambda f: F.size(f["spans"]) > 0)).alias("found")))
    judged = let(found, lambda j: F.struct(
        j["n"].cast("long").alias("n_words"),
        _covered(F.flatten(F.transform(j["found"], lambda f: f["spans"]))).cast("long").alias("n_hit"),
        F.array_sort(F.array_compact(F.array_distinct(
            F.transform(j["found"], lambda f: f["item_id"].cast("string"))))).alias("items")))
    # inline, a generator, keeps Spark from copying the expression into every column that uses it
    return joined.select("id", "kept", F.inline(F.array(judged)))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A document is contaminated if a twentieth of its words or more is covered."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
