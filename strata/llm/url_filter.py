"""URL filter: host and path rules, and link-graph propagation where no rule fits.

Method: personalised PageRank over host edges. Trust starts from pages that the rules
allow and follows links; distrust starts from pages that they block and
follows links backwards (who links to bad hosts is suspect). A host is
blocked where distrust is above trust and above the host's plain rank.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, settle

ROWS_PER_TASK = 250_000  # of the rank tables
BROADCAST_ROWS = 200_000  # ranks, counted, that may be broadcast (some 10 MB); more are joined by a shuffle
WRITTEN_ROUNDS = 4  # rounds whose ranks are written together

HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
    ``?``, ``#`` or the end. Both empty for null and where there is no ``://``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def domains(host: Column, most: int) -> Column:
    """The host's last label, its last two labels, and so on: ``most`` labels at most, or the whole host."""
    labels = F.least(F.size(F.split(host, r"\.", -1)), F.lit(most))
    return F.transform(F.sequence(F.lit(1), labels), lambda i: F.call_function("substring_index", host, F.lit("."), -i))


def apply_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (uid, host, path, ...) with ``rule`` and ``action`` of the longest rule that fits, else null."""
    wanted = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action", F.concat("host", "path").alias("rule"))
    most = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1  # labels of the longest rule
    fits = (
        rows.where(F.col("host") != "").select("uid", "path", F.explode(domains(F.col("host"), most)).alias("rule_host"))
        .join(wanted, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("uid").agg(F.max(F.struct(F.char_length("rule").alias("size"), "rule", "action")).alias("best")))
    return rows.join(fits.select("uid", "best.rule", "best.action"), "uid", "left")


def host_edges(rows: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, and between a host and the domain above it.

    A link without host is one to the own host and doesn't count.
    """
    target = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), F.col("href"))).otherwise(F.col("href"))
    links = rows.where(F.col("host") != "").select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href")).select(
        "src", host_and_path(target)[0].alias("dst"))
    found = links.where((F.col("dst") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    named = rows.select("host").where(F.col("host") != "").distinct()
    above = named.where(F.instr("host", ".") > 0).select(
        F.col("host").alias("src"), F.expr("substring(host, instr(host, '.') + 1)").alias("dst")).where(F.instr("dst", ".") > 0)
    both = above.unionByName(above.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return found.unionByName(both.withColumn("n", F.lit(1).cast("long"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, kinds: int, tolerance: float, follow: float) -> DataFrame:
    """Personalised PageRank: ``seeds`` (kind, host, seed), ``edges`` (kind, src, dst, n) -> (kind, host, rank).

    What a host without links holds is not passed on. Rounds go on until the ranks, of which each of the
    ``kinds`` sums to 1 at most, change by ``tolerance`` in all; they are then no farther than
    ``tolerance * follow / (1 - follow)`` in all from the fixed point. The change is at most
    ``2 * kinds * follow ** k`` after k more rounds, which bounds them.
    """
    hosts = edges.select("src").unionByName(edges.select(F.col("dst").alias("src"))).unionByName(seeds.select(F.col("host").alias("src"))).distinct().count()
    few = max(1, math.ceil(hosts * kinds / ROWS_PER_TASK))  # small tables in few files, so that a round leaves few behind
    held = F.broadcast if hosts * kinds <= BROADCAST_ROWS else (lambda frame: frame)
    degree = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    share = settle(edges.join(degree, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("n") / F.col("all")).alias("share")).coalesce(few), "edge-shares")
    start = settle(seeds.select("kind", "host", F.col("seed").alias("rank")).coalesce(few), "seeds")
    given = start.select("kind", "host", (F.col("rank") * (1 - follow)).alias("rank"))
    old = F.lit(0.0).alias("old")

    def passed_on(rank: DataFrame) -> DataFrame:
        return share.join(held(rank.withColumnRenamed("host", "src")), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("share") * F.col("rank") * follow).alias("rank")).unionByName(given)

    rank, rounds = start, math.ceil(math.log(tolerance / (2 * kinds)) / math.log(follow)) + 1
    for done in range(0, rounds, WRITTEN_ROUNDS):
        for _ in range(WRITTEN_ROUNDS - 1):
            rank = passed_on(rank).groupBy("kind", "host").agg(F.sum("rank").alias("rank")).coalesce(few)
        before = rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("old"))
        turn = settle(passed_on(rank).select("*", old).unionByName(before).groupBy("kind", "host").agg(
            F.sum("rank").alias("rank"), F.sum("old").alias("old")).coalesce(few), "ranks")
        rank = turn.select("kind", "host", "rank")
        if (turn.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0) <= tolerance:
            break
    return rank


def url_filter(
    pages: DataFrame, rules: DataFrame, tolerance: float = 1e-6, follow: float = 0.85, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Returns ``id, host, path, rule, verdict, trust, distrust`` for every row.

    ``rules``: (action ``allow`` or ``block``, host, path). A rule fits its
    host and all subdomains where the path starts with the rule's; the longest
    wins. Other pages get the method's verdict for their host.

    Defined cases: a null url, or one without ``://``, has empty host and path,
    fits no rule and is allowed; null html has no links; a host that neither trust
    nor distrust reaches is allowed; rules of equal length: the one that sorts last;
    repeated rows are judged each, null ids are kept; without rules, rows or
    links the result is whole all the same; extra columns are ignored.

    Pages are reduced to host edges by partial counts before anything is
    shuffled; every fourth round is written, so a lost executor costs four rounds. One
    number for each of those comes to the driver: how far the ranks still move.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    narrow = settle(rows.select("id", "host", "path").withColumn("uid", F.monotonically_increasing_id()), "urls")
    judged = settle(apply_rules(narrow, rules), "ruled-urls")
    named = judged.where(F.col("host") != "")
    counts = named.groupBy("host").agg(
        F.count(F.lit(1)).alias("base"), F.count_if(F.col("action") == "allow").alias("trust"),
        F.count_if(F.col("action") == "block").alias("distrust"))
    counts = settle(counts, "host-counts")
    total = counts.agg(*(F.sum(c).alias(c) for c in ("base", "trust", "distrust"))).first()
    kinds = [k for k in ("base", "trust", "distrust") if total[k]]
    if kinds:
        seeds = counts.select("host", F.explode(F.create_map(*(
            x for k in kinds for x in (F.lit(k), F.col(k) / F.lit(float(total[k])))))).alias("kind", "seed")).where(F.col("seed") > 0)
        edges = settle(host_edges(rows), "host-edges")
        forward = [edges.select(F.lit(k).alias("kind"), "src", "dst", "n") for k in kinds if k != "distrust"]
        backward = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
        walked = backward
        for f in forward:
            walked = walked.unionByName(f)
        rank = propagate(walked, seeds, len(kinds), tolerance, follow)
        of = lambda k: F.round(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)), 12).alias(k)
        verdicts = settle(rank.groupBy("host").agg(of("base"), of("trust"), of("distrust")).select(
            F.col("host").alias("h"), "trust", "distrust",
            ((F.col("distrust") > F.col("trust")) & (F.col("distrust") > F.col("base"))).alias("bad")), "host-verdicts")
        judged = judged.join(verdicts, F.col("host") == F.col("h"), "left")
    else:
        judged = judged.withColumns({"trust": F.lit(0.0), "distrust": F.lit(0.0), "bad": F.lit(False)})
    own = F.when(F.coalesce("bad", F.lit(False)), "block").otherwise("allow")
    return judged.select("id", "host", "path", "rule", F.coalesce("action", own).alias("verdict"),
                         F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
