"""Sharding by balanced label propagation.

Documents with equal texts are linked. Each round joins every group's pieces
with the shard where most of the group lies: shards exchange rows, and take more
than they give as far as their quota goes. Groups that are split after that are
taken out and laid one after the other into what is open; fewer groups than there
are shards meet a border there. Documents without links then fill the shards up, so that
row counts differ by one at most.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import running_total, settle


def _of(values: list[int], shard: Column) -> Column:
    return F.get(F.array(*(F.lit(int(v)).cast("long") for v in values)), shard)


def _clamp(x: Column, most: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(x, most))


def _loads(state: DataFrame, shards: int) -> list[int]:
    """Linked documents of each shard: one row per shard comes to the driver."""
    got = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def exchange(wishes: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Rows granted of the rows that wish to go from one shard to another: along rings of shards,
    and along paths that end where there is room, until there is neither. No shard takes more than its room and what leaves it."""
    left, room, granted = dict(wishes), list(room), {}

    def push(path: list[int], most: int | None = None) -> None:
        arcs = list(zip(path, path[1:]))
        moved = min([left[arc] for arc in arcs] + ([] if most is None else [most]))
        for arc in arcs:
            left[arc] -= moved
            granted[arc] = granted.get(arc, 0) + moved
        room[path[0]] += moved
        room[path[-1]] -= moved

    pushed = True
    while pushed:
        pushed = False
        for start in range(len(room)):
            path, dead = [start], set()
            while path:
                at = path[-1]
                step = next((b for b in range(len(room)) if b not in dead and left.get((at, b), 0) > 0), None)
                if len(path) > 1 and room[at] > 0:
                    push(path, room[at])
                elif step in path:
                    push(path[path.index(step):] + [step])
                elif step is None:
                    dead.add(path.pop())
                    continue
                else:
                    path.append(step)
                    continue
                path, dead, pushed = [start], set(), True
    return granted


def propagate(state: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """``state``: rows (group, shard, n). Moves pieces of groups to the shard that holds most of
    the group, until no move is granted or for ``rounds`` rounds; ``gather`` does what is left."""
    shards = len(quota)
    for turn_no in range(rounds):
        room = [q - x for q, x in zip(quota, _loads(state, shards))]
        turn = F.xxhash64("group", "shard", F.lit(turn_no))  # equal pieces: another one in each round
        goal = state.groupBy(F.col("group").alias("g")).agg(
            F.max(F.struct("n", turn.alias("turn"), "shard")).alias("goal")).select("g", F.col("goal.shard").alias("goal"))
        wish = settle(
            state.join(goal, F.col("group") == F.col("g")).where(F.col("shard") != F.col("goal"))
            .select("group", "shard", "n", "goal", (F.col("shard") * shards + F.col("goal")).alias("pair"),
                    F.xxhash64("group", "shard", F.lit(1)).alias("h")), "moves-wished")
        wishes = {(r["shard"], r["goal"]): r["n"] for r in wish.groupBy("shard", "goal").agg(F.sum("n").alias("n")).collect()}
        granted = exchange(wishes, room)
        if not any(granted.values()):
            break
        most = _of([granted.get((a, b), 0) for a in range(shards) for b in range(shards)], F.col("pair"))
        moved = settle(
            running_total(wish, "pair", ["h", "group"], F.col("n"), "before")
            .select("group", "shard", "goal", _clamp(most - F.col("before"), F.col("n")).alias("moved"))
            .where(F.col("moved") > 0), "moves")
        moves = moved.select("group", "shard", (-F.col("moved")).alias("n")).unionByName(
            moved.select("group", F.col("goal").alias("shard"), F.col("moved").alias("n")))
        state = settle(
            state.unionByName(moves).groupBy("group", "shard").agg(F.sum("n").alias("n")).where(F.col("n") > 0), "labels")
    return state


def _place(groups: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int]]:
    """(group, shard, n): every group into the tightest shard that takes it whole, else into those with most room."""
    room, out = list(room), []
    for group, n in sorted(groups, key=lambda g: (-g[1], g[0])):
        fits = [s for s in range(len(room)) if room[s] >= n]
        for s in [min(fits, key=lambda s: room[s])] if fits else sorted(range(len(room)), key=lambda s: -room[s]):
            if (moved := min(n, room[s])) > 0:
                out.append((group, s, moved))
                room[s] -= moved
                n -= moved
    return out


def gather(state: DataFrame, quota: list[int]) -> DataFrame:
    """Takes out the split groups, and whole ones from shards over their quota, and lays them one after the other
    into what the shards have open. Only groups that meet the border of two shards (fewer than shards)
    come to the driver and are placed where they fit; those that fit nowhere stay split. No shard is over its quota then."""
    shards = len(quota)
    groups = settle(state.groupBy("group").agg(
        F.sum("n").alias("n"), F.min("shard").alias("shard"), (F.count(F.lit(1)) > 1).alias("split"), F.xxhash64("group", F.lit(2)).alias("h")), "groups")
    over = [max(0, x - q) for q, x in zip(quota, _loads(groups.where(~F.col("split")), shards))]
    whole = groups.where(~F.col("split"))
    if any(over):
        queue = settle(running_total(whole, "shard", ["h", "group"], F.col("n"), "before").withColumn(
            "leaves", F.col("before") < _of(over, F.col("shard"))), "queue")
        whole = queue.where(~F.col("leaves")).select(*groups.columns)
        taken = groups.where("split").unionByName(queue.where("leaves").select(*groups.columns))
    else:
        taken = groups.where("split")
    if taken.isEmpty():
        return state
    room = [q - x for q, x in zip(quota, _loads(whole, shards))]
    ends = [sum(room[: s + 1]) for s in range(shards)]
    shard_at = lambda place: F.coalesce(*(F.when(place < F.lit(e), F.lit(s)) for s, e in enumerate(ends)))
    line = running_total(taken.withColumn("all", F.lit(0)), "all", ["h", "group"], F.col("n"), "at")
    laid = settle(line.select("group", "n", shard_at(F.col("at")).alias("shard"), shard_at(F.col("at") + F.col("n") - 1).alias("last")), "laid")
    inside = laid.where(F.col("shard") == F.col("last"))
    border = [(r["group"], r["n"]) for r in laid.where(F.col("shard") != F.col("last")).collect()]
    rest = _place(border, [x - y for x, y in zip(room, _loads(inside, shards))])
    placed = state.sparkSession.createDataFrame(rest, "group long, shard int, n long")
    return settle(whole.select("group", "shard", "n").unionByName(inside.select("group", "shard", "n")).unionByName(placed), "labels")


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns ``id, size, text_crc32, shard, slot`` for every row, under the law ``rows``:
    the shards' row counts differ by one at most. ``slot`` counts from 0 in each shard.

    Defined cases: a null text has size 1 and checksum 0 and links with
    nothing; an empty text is a text; repeated rows are documents of their own
    (and linked); null ids are kept; a group larger than a shard is spread; an empty table gives no rows; extra
    columns are ignored. Fewer groups than shards are split in the end, however many texts have copies.

    Rounds work on (group, shard, count) rows, however large a group is; only
    the shards' loads, the rows wished from shard to shard and fewer groups than
    shards come to the driver. Texts are read once and not shuffled.
    """
    text = F.col(text_col)
    base = settle(docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(text)).alias("group"), F.xxhash64(id_col, text_col, F.lit(11)).alias("h")), "shard-base")
    total = base.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = base.where(F.col("group").isNotNull()).groupBy(
        "group", F.pmod("h", F.lit(shards)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    linked = pieces.groupBy(F.col("group").alias("g")).agg(F.sum("n").alias("rows")).where(F.col("rows") > 1)
    state = settle(pieces.join(linked, F.col("group") == F.col("g"), "left_semi"), "labels")
    state = gather(propagate(state, quota, rounds), quota)

    # the unlinked documents fill what is open
    opened = [q - x for q, x in zip(quota, _loads(state, shards))]
    ends = [sum(opened[: s + 1]) for s in range(shards)]

    # a group's documents, numbered by hash, take its pieces' places in the order of the shards
    bounds = settle(state.groupBy(F.col("group").alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("pieces")), "pieces")  # at most one piece per shard
    known = base.join(bounds.select("g", F.lit(True).alias("is_linked")), F.col("group") == F.col("g"), "left")
    numbered = settle(
        running_total(known.withColumn("key", F.when(F.col("is_linked"), F.col("group"))).drop("g", "is_linked"),
                      "key", ["h", "id"], F.lit(1), "rank"), "ranks")
    begin = F.struct(F.col("rank").alias("left"), F.lit(None).cast("int").alias("shard"))
    own = F.aggregate("pieces", begin, lambda acc, p: F.struct(
        (acc["left"] - p["n"]).alias("left"),
        F.when(acc["shard"].isNull() & (acc["left"] < p["n"]), p["shard"]).otherwise(acc["shard"]).alias("shard")), lambda acc: acc["shard"])
    filled = F.coalesce(*(F.when(F.col("rank") < F.lit(e), F.lit(s)) for s, e in enumerate(ends)))
    placed = numbered.join(bounds, F.col("key") == F.col("g"), "left").withColumn(
        "shard", F.when(F.col("key").isNull(), filled).otherwise(own))
    slots = running_total(placed.select("id", "size", "text_crc32", "shard", "h"), "shard", ["h", "id"], F.lit(1), "slot")
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
