"""Mixing sources to target weights by Pfair scheduling.

A source with weight a / period owes its j-th block (from 0) a place between
its release floor(j * period / a) and its deadline ceil((j + 1) * period / a).
Earliest deadline first among the released blocks meets every window, so at any
slot each source is less than one block away from its exact share. After
``period`` slots all shares are exact; so the plan of one period, made once,
places the blocks of any number of periods.

Sources too small for a weight share one class. In its sequence the j-th of a
source's n documents has the window from j / n to (j + 1) / n of the sequence, and a
time inside it; sources of equal n spread their times evenly over the window.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, running_total, settle


def plan(weights: list[int]) -> Column:
    """array<array<int>>: for each source the slots of its blocks within a period of sum(weights) slots."""
    period = sum(weights)
    ticks = F.array(*(F.lit(a) for a in weights))
    none = F.lit(None).cast("struct<deadline:int,source:int>")

    def step(state: Column, t: Column) -> Column:
        due = F.transform(state["done"], lambda d, i: let(F.get(ticks, i), lambda a: F.when(
            (d < a) & (d * period <= t * a),
            F.struct(F.ceil((d + 1) * period / a).cast("int").alias("deadline"), i.cast("int").alias("source"))).otherwise(none)))
        return let(F.array_min(F.filter(due, lambda x: x.isNotNull()))["source"], lambda pick: F.struct(
            F.transform(state["done"], lambda d, i: d + F.when(i == pick, 1).otherwise(0)).alias("done"),
            F.concat(state["order"], F.array(pick)).alias("order")))

    start = F.struct(F.transform(ticks, lambda a: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda s: s["order"])
    return let(order, lambda o: F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda i: F.filter(
        F.sequence(F.lit(0), F.lit(period - 1)), lambda t: F.get(o, t) == i)))


def capped_weights(counts: dict[str | None, int], period: int, max_share: float) -> dict[str | None, int]:
    """Whole weights that add up to ``period``: natural shares, none over ``max_share`` (if that can be), none 0."""
    total, names = sum(counts.values()), sorted(counts, key=lambda s: (-counts[s], s is None, s or ""))
    cap = max(max_share, 1 / len(names))
    share, left, rows = {}, 1.0, total
    for s in names:  # from the largest: those over the cap get it, the others share what is left
        share[s] = min(cap, left * counts[s] / max(1, rows))
        left -= share[s]
        rows -= counts[s]
    whole = {s: max(1, math.floor(share[s] * period)) for s in names}
    order = sorted(names, key=lambda s: (whole[s] - share[s] * period, names.index(s)))
    at = 0
    while (gap := period - sum(whole.values())) != 0:
        s = order[at % len(order)] if gap > 0 else max(names, key=lambda x: whole[x])
        whole[s] += 1 if gap > 0 else -1
        at += 1
    return whole


def _in_turn(rest: DataFrame, sizes: DataFrame, big: int) -> DataFrame:
    """``rest`` (kept, h, source, class) with ``rank``: the document's place in the order of the times.

    ``sizes`` (source, n): the class's sources, any number of them. Only those of ``big`` rows or more are broadcast.
    Times of sources of equal size take turns; so a source is at any place less than
    1 + its share of the class * the number of different sizes documents away from its share.
    """
    tagged = settle(sizes.withColumns({"sh": F.xxhash64("source"), "tag": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))}), "small-sources")
    peers = tagged.groupBy(F.col("n").alias("of_n")).agg(F.count(F.lit(1)).alias("peers"))
    phases = settle(
        running_total(tagged, "n", ["sh", "tag"], F.lit(1), "turn").join(peers, F.col("n") == F.col("of_n"))
        .select("tag", F.struct("n", ((F.col("turn") + 0.5) / F.col("peers")).alias("phase")).alias("own")), "source-phases")
    many = phases.where(F.col("own.n") >= big).select(F.col("tag").alias("many_tag"), F.col("own").alias("many"))
    few = phases.where(F.col("own.n") < big).select(F.col("tag").alias("few_tag"), F.col("own").alias("few"))
    ranked = running_total(rest, "source", ["h"], F.lit(1), "j").withColumn(
        "tag", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    known = ranked.join(F.broadcast(many), F.col("tag") == F.col("many_tag"), "left")
    # rows of large sources look for nothing, each under a key of its own
    known = known.withColumn("look", F.when(F.col("many").isNull(), F.col("tag")).otherwise(F.concat(F.lit("#"), F.col("h").cast("string"))))
    own = F.coalesce("many", "few")
    time = (F.col("j") + own["phase"]) / own["n"]  # from 0 to 1, as evenly as the documents lie
    timed = settle(known.join(few, F.col("look") == F.col("few_tag"), "left").select(
        "kept", "h", "source", "class", ((F.floor(time * 2.0**53) - (1 << 52)) * 2048).alias("time")), "timed")
    return running_total(timed, "class", ["time", "h"], F.lit(1), "rank").drop("time")


def mix(
    docs: DataFrame, weights: dict[str, int] | None = None, block: int = 8, period: int = 200, max_share: float = 0.2,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """The mixture: a struct ``kept`` of the columns ``keep`` (default: the id) and a struct ``mix`` of
    ``slot, place, source, block, epoch, release, deadline``.

    Blocks are ``block`` documents of one class: of a source in the order of a hash of id
    and text, of several sources as ``_in_turn`` orders them (the last may have fewer). ``slot`` is the block's place in the mixture and
    ``place`` the document's in the block. Every document is in the mixture at
    least once: the mixture ends with the period in which the last source has
    been read whole, and a source that ends before starts over (``epoch``).

    ``weights``: whole weights by source, all other sources together under
    None. If there are others and no weight for None, they get the whole weight that is nearest to their natural share beside
    the named ones (1 at least); only a source that is named with weight 0 is left out. Default: natural shares with no source over ``max_share``, which
    bounds the mixture by the input / max_share; sources with less than one
    ``period``-th of the rows, and null sources, form one class. In a class of several
    sources each keeps its share of the class: its documents are spread evenly over the class's sequence.

    Defined cases: a null id or text is a row like any other; repeated rows
    are documents of their own; a weighted source without rows is left out;
    an empty table gives an empty mixture; extra columns are ignored unless kept.

    Only the classes (at most ``period``) come to the driver and are broadcast; the
    sources inside a class stay in Spark.
    Documents are numbered within hash ranges, so a source may hold any share of the rows.
    """
    keep = keep or [id_col]
    base = docs.select(F.struct(*keep).alias("kept"), F.xxhash64(id_col, text_col).alias("h"), F.col(source_col).alias("source"))
    unwanted = [s for s, w in (weights or {}).items() if s is not None and w == 0]
    if unwanted:
        base = base.where(F.col("source").isNull() | ~F.col("source").isin(unwanted))
    sizes = base.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    total = base.count()
    if weights is None:
        own = [(r["source"], r["n"]) for r in sizes.where(F.col("source").isNotNull() & (F.col("n") * period >= total)).collect()]
    else:
        named = [s for s in weights if s is not None]
        own = [(r["source"], r["n"]) for r in sizes.where(F.col("source").isin(named)).collect()]
    counts = dict(own)
    if total > sum(counts.values()):
        counts[None] = total - sum(counts.values())
    spark = docs.sparkSession
    if weights is None:
        weights = capped_weights(counts, period, max_share) if counts else {}
    elif None in counts and None not in weights:
        named_rows = sum(n for s, n in counts.items() if s is not None and weights[s])
        beside = sum(weights[s] for s in counts if s is not None)
        weights = {**weights, None: max(1, round(counts[None] / named_rows * beside)) if named_rows else 1}
    classes = [s for s in sorted(counts, key=lambda s: (s is None, s or "")) if weights.get(s)]
    ticks = [weights[s] for s in classes]
    blocks = [-(-counts[s] // block) for s in classes]
    cycle = sum(ticks)
    periods = max((-(-b // a) for a, b in zip(ticks, blocks)), default=0)
    schema = "class_name string, ticks long, blocks long, at int"
    table = spark.createDataFrame([(s, a, b, i) for i, (s, a, b) in enumerate(zip(classes, ticks, blocks))], schema)
    if classes:
        slots = settle(spark.range(1).select(F.posexplode(plan(ticks)).alias("at", "slots")), "period-plan")
    else:
        slots = spark.createDataFrame([], "at int, slots array<int>")
    table = table.join(slots, "at")

    names = [s for s in classes if s is not None]
    classed = base.withColumn("class", F.when(F.col("source").isin(names), F.col("source")))
    numbered = running_total(classed.where(F.col("class").isNotNull()), "class", ["h"], F.lit(1), "rank")
    if None in classes:
        others = sizes.where(F.col("source").isNull() | ~F.col("source").isin(names))
        numbered = numbered.unionByName(_in_turn(classed.where(F.col("class").isNull()), others, -(-total // period)))
    placed = numbered.join(F.broadcast(table), F.col("class").eqNullSafe(F.col("class_name")))
    first = F.floor(F.col("rank") / block).cast("long")
    turns = placed.select(
        "kept", "source", "ticks", "blocks", "slots", first.alias("block"), (F.col("rank") % block).cast("int").alias("place"),
        F.explode(F.sequence(first, F.col("ticks") * periods - 1, F.col("blocks"))).alias("j"))
    j, a = F.col("j"), F.col("ticks")
    return turns.select("kept", F.struct(
        (F.floor(j / a) * cycle + F.get("slots", (j % a).cast("int"))).cast("long").alias("slot"), "place",
        F.col("source"), "block", F.floor(j / F.col("blocks")).cast("long").alias("epoch"),
        F.floor(j * cycle / a).cast("long").alias("release"), F.ceil((j + 1) * cycle / a).cast("long").alias("deadline")).alias("mix"))
